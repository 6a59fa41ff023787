from __future__ import annotations

import pytest
from frames import final_plan, rows
from pyspark.sql import functions as F

from tradewind.operators import governance, marts, quality
from tradewind.operators.rows import dedup
from tradewind.plans.lakehouse import expected_customers, expected_items


@pytest.fixture
def orders(frame):
    return frame([("a", 1, 5.0), ("a", 2, 1.0), ("b", None, -1.0), (None, 4, None)], "order_id string, customer int, total double")


RULES = [quality.is_complete("customer"), quality.is_unique("order_id"), quality.column_values("total", ">=", 0)]


def test_row_outcomes(orders):
    out = quality.evaluate_rows(orders, RULES)
    got = {(r.order_id, r.customer): (r[quality.FAILED_RULES], r[quality.RESULT]) for r in out.collect()}
    unique, complete, bound = 'IsUnique "order_id"', 'IsComplete "customer"', 'ColumnValues "total" >= 0'
    assert got[("a", 1)] == ([unique], "Failed")
    assert got[("a", 2)] == ([unique], "Failed")
    assert got[("b", None)] == ([complete, bound], "Failed")
    assert got[(None, 4)] == ([bound], "Failed")


def test_rule_outcomes(orders):
    got = {r.rule: (r.outcome, r.ratio) for r in quality.evaluate_rules(orders, RULES).collect()}
    assert got['IsComplete "customer"'] == ("Failed", 0.75)
    assert got['IsUnique "order_id"'] == ("Failed", 0.5)
    assert got['ColumnValues "total" >= 0'] == ("Failed", 0.5)


def test_no_rows_pass(orders):
    none = orders.limit(0)
    assert {r.outcome for r in quality.evaluate_rules(none, RULES).collect()} == {"Passed"}
    assert rows(quality.quality_score(quality.evaluate_rows(none, RULES))) == [(0, 0, 0, 100.0)]


def test_referential_with_repeated_and_null_keys(frame):
    items = frame([("p1",), ("p9",), (None,)], "product_id string")
    products = frame([("p1",), ("p1",), (None,)], "product_id string")
    rule = quality.referential("product_id", products, "product_id")
    out = quality.evaluate_rows(items, [rule])
    assert {r.product_id: r[quality.RESULT] for r in out.collect()} == {"p1": "Passed", "p9": "Failed", None: "Failed"}
    assert rows(quality.referential_fail(items, products, "product_id")) == [("p9",), (None,)]
    assert quality.evaluate_rules(items, [rule]).first().outcome == "Failed"
    lenient = quality.referential("product_id", products, "product_id", op=">=", value=0.3)
    assert quality.evaluate_rules(items, [lenient]).first().outcome == "Passed"


def test_quarantine_keeps_every_row(orders):
    outcomes = quality.evaluate_rows(orders, RULES[:1])
    passed, failed = quality.split_quarantine(outcomes, "why")
    assert passed.count() + failed.count() == orders.count()
    assert not [c for c in passed.columns if c.startswith("DataQualityRules")]
    assert quality.RESULT in passed.columns
    assert {r.dq_failure_reason for r in failed.collect()} == {"why"}
    assert rows(quality.quality_score(outcomes)) == [(3, 1, 4, 75.0)]


def test_uniqueness_does_not_gather_a_hot_value(spark):
    # A third of the rows share one value; it is counted before the shuffle.
    df = spark.range(9_000, numPartitions=4).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k")
    out = quality.evaluate_rows(df, [quality.is_unique("k")])
    text = final_plan(out)
    assert "Window" not in text and "partial_count" in text
    assert out.where(F.col(quality.RESULT) == "Failed").count() == 3_000


def test_hot_key_join_is_split(spark):
    """Without broadcast, AQE splits the partition of a key with a third of the rows."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        items = spark.range(300_000, numPartitions=8).selectExpr(
            "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS product_id", "cast(id AS string) AS pad"
        )
        # Both dimensions come hashed by the key: from an aggregate and from a window.
        products = spark.range(100_000).repartition(4).selectExpr("id AS product_id", "cast(id % 5 AS string) AS category")
        out = quality.evaluate_rows(items, [quality.referential("product_id", products, "product_id")])
        assert "skew=true" in final_plan(out)
        assert out.where(F.col(quality.RESULT) == "Passed").count() == 100_000 + 66_666
        joined = marts.items_with_category(items, dedup(products, ["product_id"]))
        assert "skew=true" in final_plan(joined)
        assert joined.where("category IS NOT NULL").count() == 100_000 + 66_666
        unique = quality.evaluate_rows(items, [quality.is_unique("product_id")])
        assert "skew=true" in final_plan(unique)
        assert unique.where(F.col(quality.RESULT) == "Failed").count() == 100_001
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_expect_counts_and_keeps(orders):
    out, seen = quality.expect(orders, has_customer="customer IS NOT NULL", positive="total > 0")
    assert out.count() == 4
    assert seen.get == {"rows": 4, "has_customer": 1, "positive": 2}


def test_expect_or_drop_drops_unknown(orders):
    assert quality.expect_or_drop(orders, "total > 0").count() == 2


def test_expect_or_fail(orders):
    assert quality.expect_or_fail(orders.where("total > 0"), "positive", "total > 0").count() == 2
    with pytest.raises(Exception, match="expectation positive violated"):
        quality.expect_or_fail(orders, "positive", "total > 0").collect()


def test_expected_customers_warns_about_the_null_id(frame):
    data = [(1, "A@EXAMPLE.com "), (1, "b@example.com"), (None, "c@example.com"), (None, "d@example.com"), (2, "bad")]
    kept, seen = expected_customers(frame(data, "customer_id int, email string"))
    assert rows(kept) == [(1, "a@example.com"), (None, "c@example.com")]
    assert seen.get["valid_customer_id"] == 1


def test_expected_items_abort(frame):
    items = frame([("o", "p", 1), ("o", "q", 0)], "order_id string, product_id string, quantity int")
    assert expected_items(items.where("quantity > 0")).count() == 1
    with pytest.raises(Exception, match="positive_quantity_enforced"):
        expected_items(items).collect()


def test_kpi_alert(frame):
    df = frame([(149,)], "orders int")
    assert rows(quality.kpi_alert(df, "orders", "<", 150)) == [("orders", 149.0, 150.0, True)]
    assert quality.kpi_alert(frame([(None,)], "orders int"), "orders", "<", 150).first().triggered is False


TAGS = [
    ("raw.customers.email", "sensitivity", "PII"),
    ("raw.customers", "sensitivity", "Public"),
    ("raw", "department", "engineering"),
]
GRANTS = [governance.Grant("analyst", "sensitivity", "Public"), governance.Grant("engineer", "department", "engineering")]


def test_tags_inherit_and_override():
    assert governance.effective_tags(TAGS, "raw.customers.email") == {"sensitivity": "PII", "department": "engineering"}
    assert governance.effective_tags(TAGS, "raw.customers.city") == {"sensitivity": "Public", "department": "engineering"}
    assert governance.effective_tags(TAGS, "raw.orders.status") == {"department": "engineering"}


def test_secure_select(frame):
    df = frame([(1, "a@b.com", "Rome")], "customer_id int, email string, city string")
    with pytest.raises(governance.AccessDenied, match="email"):
        governance.secure_select(df, "raw.customers", TAGS, GRANTS, "analyst")
    omitted = governance.secure_select(df, "raw.customers", TAGS, GRANTS, "analyst", deny="omit")
    assert omitted.columns == ["customer_id", "city"]
    assert governance.secure_select(df, "raw.customers", TAGS, GRANTS, "engineer").columns == df.columns
    with pytest.raises(governance.AccessDenied):
        governance.secure_select(df, "raw.customers", TAGS, GRANTS, "stranger", deny="omit")


def test_masked_view_and_function(spark, frame):
    df = frame([(1, "abc@b.com")], "id int, email string")
    name = governance.create_mask_function(spark)
    got = df.selectExpr(f"{name}(email, false) AS m", f"{name}(email, true) AS c").first()
    assert (got.m, got.c) == ("a**@b.com", "abc@b.com")
    governance.masked_view(spark, df, "v_masked", {"email": governance.mask_email})
    assert spark.sql("SELECT email FROM v_masked").first().email == "a**@b.com"
