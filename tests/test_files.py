from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from frames import rows
from pyspark.sql import functions as F

from tradewind import sinks, sources, workspace
from tradewind.plans import curation, lakehouse, warehouse
from tradewind.sources import fs
from tradewind.sources.fs import read_text, write_text
from tradewind.streaming import Source, evolve_schema, ingest_stream, run_incremental
from tradewind.streaming.incremental import _load


def put(path: str, *objects) -> None:
    """One JSON-lines file."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.writelines(json.dumps(o) + "\n" for o in objects)


@pytest.fixture
def root(spark):
    return workspace(spark, "test")


def test_partition_directories_become_columns(spark, root):
    put(f"{root}/orders/order_date=2026-06-01/a.json", {"order_id": "o1"})
    put(f"{root}/orders/order_date=2026-06-02/a.json", {"order_id": "o2", "discount_code": "VIP15"})
    df = sources.read_partitioned(spark, f"{root}/orders", "json", "order_id string, discount_code string")
    assert rows(df) == [("o1", None, dt.date(2026, 6, 1)), ("o2", "VIP15", dt.date(2026, 6, 2))]


def test_pruning_reaches_the_scan(spark, root):
    days = spark.range(40).selectExpr("id", "date_add(date'2026-06-01', cast(id % 4 AS int)) AS day")
    sinks.append_partitioned(days, root, "day")
    df = sources.read_partitioned(spark, root, "parquet", "id bigint, day date")
    pruned = sources.pruned_scan(df, "day", "2026-06-02", "2026-06-03")
    assert "PartitionFilters: [isnotnull(day" in pruned._jdf.queryExecution().executedPlan().toString()
    assert pruned.count() == 20
    full, part = sources.scan_cost(df).first(), sources.scan_cost(pruned).first()
    assert (full.rows, part.rows) == (40, 20) and part.bytes < full.bytes and part.files < full.files


def test_projected_scan_without_matching_days(spark, root):
    sinks.append_partitioned(spark.range(3).selectExpr("id", "date'2026-06-01' AS day"), root, "day")
    schema = "id bigint, day date"
    assert sources.projected_scan(spark, root, "day", "2026-05-30", "2026-06-02", schema).count() == 3
    assert sources.projected_scan(spark, root, "day", "2027-01-01", "2027-01-02", schema).count() == 0


def test_partition_gaps(frame):
    df = frame([(dt.date(2026, 6, 1),), (dt.date(2026, 6, 3),)], "day date")
    assert rows(sources.partition_gaps(df, "day", "2026-06-01", "2026-06-04")) == [(dt.date(2026, 6, 2),), (dt.date(2026, 6, 4),)]


def test_manifest(spark, root):
    sinks.append(spark.range(10).coalesce(1), f"{root}/data")
    part = sources.file_inventory(spark.read.parquet(f"{root}/data")).first()
    manifest = f"{root}/m.json"
    entries = [{"url": part.file_path, "mandatory": True, "meta": {"content_length": part.file_size + 1}}]
    entries.append({"url": f"{root}/data/absent.parquet", "mandatory": False})
    put(manifest, {"entries": entries})
    assert sources.read_manifest(spark, manifest).count() == 10
    assert {r.status for r in sources.manifest_check(spark, manifest).collect()} == {"length_mismatch", "missing"}
    entries[1]["mandatory"] = True
    put(f"{root}/m2.json", {"entries": entries})
    with pytest.raises(sources.ManifestError, match="absent.parquet"):
        sources.read_manifest(spark, f"{root}/m2.json")


def test_manifest_of_many_entries_asks_for_no_file(spark, root, monkeypatch):
    sinks.append(spark.range(0, 60, 1, 30), f"{root}/data")
    here = [r.file_path for r in sources.file_inventory(spark.read.parquet(f"{root}/data")).collect()]
    entries = [{"url": u, "mandatory": True} for u in here[::2]] + [{"url": f"{root}/data/none{i}.parquet", "mandatory": False} for i in range(10_000)]
    put(f"{root}/many.json", {"entries": entries})
    calls, real = [], fs.exists
    monkeypatch.setattr(fs, "exists", lambda s, p: calls.append(p) or real(s, p))
    assert sources.read_manifest(spark, f"{root}/many.json").count() == 30
    found = {r.status: r["count"] for r in sources.manifest_check(spark, f"{root}/many.json").groupBy("status").count().collect()}
    assert found == {"ok": 15, "missing": 10_000}
    assert len(calls) <= 4


def test_snapshot_and_partitioned_manifest(spark, root):
    manifest = sinks.publish_snapshot(spark.range(100), f"{root}/snap")
    assert sources.read_manifest(spark, manifest).count() == 100
    assert {r.status for r in sources.manifest_check(spark, manifest).collect()} == {"ok"}


def test_schema_drift(frame):
    df = frame([(1, "x")], "a int, c string")
    assert rows(sources.schema_drift(df, "a bigint, b string")) == [
        ("a", "bigint", "int", "retyped"),
        ("b", "string", None, "removed"),
        ("c", None, "string", "added"),
    ]


def test_load_errors_newest_first(spark, root):
    os.makedirs(f"{root}/in")
    for name, age in (("old.csv", 100), ("new.csv", 0)):
        with open(f"{root}/in/{name}", "w") as f:
            f.write("order_id,quantity\no1,2\no2,many\no3,few\n")
        at = dt.datetime.now().timestamp() - age
        os.utime(f"{root}/in/{name}", (at, at))
    got = sources.load_errors(spark, f"{root}/in", "order_id string, quantity int", n=3).collect()
    assert [r.file_name for r in got] == ["new.csv", "new.csv", "old.csv"]
    assert got[0].reason == "bad value in quantity" and got[0].raw_record == "o2,many"


def test_load_errors_json(spark, root):
    put(f"{root}/in/a.json", {"order_id": "o1", "quantity": 1}, {"order_id": "o2", "quantity": "many"})
    got = sources.load_errors(spark, f"{root}/in", "order_id string, quantity int", fmt="json").collect()
    assert [(r.file_name, r.reason) for r in got] == [("a.json", "bad value in quantity")]


def test_landing(spark, root):
    put(f"{root}/in/orders20260701.json", {"order_id": 1}, {"order_id": 2})
    put(f"{root}/in/orders_99999999.json", {"order_id": 3})
    put(f"{root}/in/orders.json", {"order_id": 4})
    landed, rejects = sources.land_by_filename_date(sources.read_jsonl(spark, f"{root}/in", "order_id bigint"), f"{root}/out")
    assert rows(landed) == [(1, "orders20260701.json", dt.date(2026, 7, 1)), (2, "orders20260701.json", dt.date(2026, 7, 1))]
    assert {r.order_id for r in rejects.collect()} == {3, 4}
    assert os.path.isdir(f"{root}/out/date=2026-07-01")


def test_overwrite_keeps_other_days(spark, frame, root):
    sinks.overwrite_partitions(frame([("d1", 1), ("d2", 2)], "day string, v int"), root, "day")
    sinks.overwrite_partitions(frame([("d2", 5)], "day string, v int"), root, "day")
    assert rows(spark.read.parquet(root).select("day", "v")) == [("d1", 1), ("d2", 5)]


def test_hot_day_is_written_by_several_tasks(spark, root):
    # Shuffle partitions of a day or so each, as a cluster sized for its data has.
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB", "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        days = spark.range(400_000, numPartitions=8).selectExpr(
            "xxhash64(id) AS v", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE 'd' || id % 40 END AS day"
        )
        sinks.append_partitioned(days, root, "day")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = {d: len([f for f in os.listdir(f"{root}/{d}") if f.endswith(".parquet")]) for d in os.listdir(root) if "day=" in d}
    assert files.pop("day=hot") > 1
    assert set(files.values()) == {1}
    assert spark.read.parquet(root).count() == 400_000


def test_external_table_finds_partitions(spark, frame, root):
    sinks.append_partitioned(frame([("2026-06-01", 1), ("2026-06-02", 2)], "day string, v int"), root, "day")
    table = sources.register_external(spark, "ext_test", root, "v int, day date", ["day"])
    assert table.where("day = date'2026-06-02'").first().v == 2
    assert table.count() == 2


def test_staging_reload_with_nothing_empties(spark, frame, root):
    df = frame([(1, "a")], "id int, v string")
    sinks.save_table(df, "stg_test", root)
    sinks.reload_staging(df.limit(0).select("v", "id"), "stg_test")
    assert spark.read.table("stg_test").count() == 0


def test_inserts_by_name_and_key(spark, frame, root):
    sinks.save_table(frame([(1, "a")], "id int, v string"), "dim_test", root)
    for _ in range(2):
        sinks.insert_new(frame([("b", 2), ("x", 1)], "v string, id int"), "dim_test", ["id"])
    sinks.add_rows(frame([(9,)], "id int"), "dim_test")
    assert rows(spark.read.table("dim_test")) == [(1, "a"), (2, "b"), (9, None)]


def test_refresh_recomputes_touched_groups_only(spark, frame, root):
    def agg(df):
        return df.groupBy("day").agg(F.countDistinct("k").alias("n"))

    base = frame([("d1", 1), ("d1", 2), ("d2", 1)], "day string, k int")
    sinks.overwrite_partitions(agg(base.where("day = 'd2'")), root, "day")
    # d1 is new, and a wrong d2 is left as it is because nothing changed there.
    sinks.overwrite_partitions(frame([("d2", 77)], "day string, n bigint"), root, "day")
    sinks.refresh_view(root, base, base.where("day = 'd1'"), agg, "day", "day")
    assert rows(spark.read.parquet(root).select("day", "n")) == [("d1", 2), ("d2", 77)]


# --- streams ----------------------------------------------------------------

CLICKS = "session_id string, customer_id bigint"


def test_stream_takes_each_file_once(spark, root):
    put(f"{root}/raw/a.json", {"session_id": "s1", "customer_id": 1})
    args = (spark, f"{root}/raw", CLICKS, f"{root}/out", f"{root}/ckpt")
    assert ingest_stream(*args).count() == 1
    assert ingest_stream(*args).count() == 1
    put(f"{root}/raw/b.json", {"session_id": "s2"})
    assert rows(ingest_stream(*args)) == [("s1", 1), ("s2", None)]


def test_schema_grows_between_runs(spark, root):
    args = (f"{root}/raw", f"{root}/schema.json")
    put(f"{root}/raw/a.json", {"session_id": "s1"})
    first = evolve_schema(spark, *args)
    ingest_stream(spark, f"{root}/raw", first, f"{root}/out", f"{root}/ckpt")
    put(f"{root}/raw/b.json", {"session_id": "s2", "device_type": "tablet"})
    second = evolve_schema(spark, *args)
    out = ingest_stream(spark, f"{root}/raw", second, f"{root}/out", f"{root}/ckpt")
    assert first.names == ["session_id"] and second.names == ["session_id", "device_type"]
    assert rows(out) == [("s1", None), ("s2", "tablet")]


def test_evolve_without_files(spark, root):
    os.makedirs(f"{root}/raw")
    assert evolve_schema(spark, f"{root}/raw", f"{root}/schema.json").names == []


def test_crashed_run_is_repeated_under_its_number(spark, root):
    source = Source("clicks", f"{root}/raw", spark.createDataFrame([], CLICKS).schema)
    seen = []

    def fail(frames, run):
        seen.append(("fail", run, frames["clicks"].count()))
        raise RuntimeError("executor gone")

    def work(frames, run):
        seen.append(("ok", run, frames["clicks"].count()))

    put(f"{root}/raw/a.json", {"session_id": "s1"})
    with pytest.raises(RuntimeError):
        run_incremental(spark, [source], f"{root}/lake", fail)
    put(f"{root}/raw/b.json", {"session_id": "s2"}, {"session_id": "s3"})
    assert run_incremental(spark, [source], f"{root}/lake", work) == 2
    assert seen == [("fail", 1, 1), ("ok", 1, 1), ("ok", 2, 2)]
    assert run_incremental(spark, [source], f"{root}/lake", work) is None
    assert len(seen) == 3
    assert _load(spark, f"{root}/lake/control/progress.json") == {"next_run": 4, "done_through": 3, "open": None}


def test_control_file_survives_a_cut_off_writer(spark, root):
    write_text(spark, f"{root}/c.json", "one")
    write_text(spark, f"{root}/c.json", "two")
    assert read_text(spark, f"{root}/c.json") == "two"
    os.rename(f"{root}/c.json", f"{root}/c.json.new")
    assert read_text(spark, f"{root}/c.json") == "two"
    assert read_text(spark, f"{root}/absent.json") is None


# --- the jobs ---------------------------------------------------------------


def raw_day(root: str, day: str, first: int, code: str | None = None) -> None:
    orders = [
        {"order_id": f"o{i}", "customer_id": i, "order_ts": f"{day}T10:00:00Z", "store_region": "north", "status": "placed"}
        for i in range(first, first + 3)
    ]
    if code:
        for o in orders:
            o["discount_code"] = code
    orders[2]["status"] = None
    put(f"{root}/orders/order_date={day}/orders-{first}.json", *orders)
    items = [
        {"order_id": o["order_id"], "product_id": "p1", "quantity": 2, "unit_price": 1.5, "line_total": 3.0} for o in orders
    ]
    items.append({"order_id": f"o{first}", "product_id": "p99", "quantity": 1, "unit_price": 1.0, "line_total": 1.0})
    put(f"{root}/order_items/order_date={day}/items-{first}.json", *items)


def raw_reference(root: str) -> None:
    os.makedirs(f"{root}/customers")
    os.makedirs(f"{root}/products")
    with open(f"{root}/customers/c.csv", "w") as f:
        f.write("customer_id,first_name,last_name,email,signup_date,city,segment\n")
        f.write("1,A,B, A@Shop.com ,2026-01-01,Rome,consumer\n1,A,B,new@shop.com,2026-02-01,Rome,consumer\n")
    with open(f"{root}/products/p.csv", "w") as f:
        f.write("product_id,product_name,category,unit_price,active_flag\np1,toy,Toys,1.5,true\n")


def test_curation_over_two_days(spark, root):
    layout = curation.Layout(f"{root}/raw", f"{root}/lake")
    raw_reference(layout.raw)
    raw_day(layout.raw, "2026-06-01", 0)
    assert curation.run(spark, layout) == 1
    raw_day(layout.raw, "2026-06-02", 10, "VIP15")
    assert curation.run(spark, layout) == 2
    assert curation.run(spark, layout) is None

    orders = spark.read.parquet(layout.curated("orders"))
    per_run = {r.run_id: r["count"] for r in orders.groupBy("run_id").count().collect()}
    assert per_run == {1: 2, 2: 2}
    codes = {(r.run_id, r.discount_code) for r in orders.collect()}
    assert codes == {(1, None), (2, "VIP15")}
    assert spark.read.parquet(layout.quarantine("orders")).count() == 2
    bad = spark.read.parquet(layout.quarantine("order_items"))
    assert {r.product_id for r in bad.collect()} == {"p99"} and bad.first().dq_failure_reason == curation.ITEMS_REASON
    revenue = spark.read.parquet(layout.daily_revenue)
    assert {(str(r.order_date), float(r.total_revenue)) for r in revenue.collect()} == {("2026-06-01", 7.0), ("2026-06-02", 7.0)}
    assert spark.read.parquet(layout.curated("customers")).first().email == "new@shop.com"
    scores = spark.read.parquet(layout.metrics)
    assert scores.where("context = 'orders_dq_check'").agg(F.sum("failed")).first()[0] == 2


def test_daily_revenue_of_a_very_large_day(spark, root):
    """Totals that fit a line each, and together pass ten digits before the point."""
    layout = curation.Layout(f"{root}/raw", f"{root}/lake", grain="year")
    raw_reference(layout.raw)
    for k in range(3):
        order = {"order_id": f"o{k}", "customer_id": 1, "order_ts": "2026-06-01T10:00:00Z", "store_region": "north", "status": "placed"}
        put(f"{layout.raw}/orders/order_date=2026-06-01/orders-{k}.json", order)
        item = {"order_id": f"o{k}", "product_id": "p1", "quantity": 1, "unit_price": 6e9, "line_total": 6e9 + 0.25}
        put(f"{layout.raw}/order_items/order_date=2026-06-01/items-{k}.json", item)
    assert curation.run(spark, layout) == 1
    assert [float(r.total_revenue) for r in spark.read.parquet(layout.daily_revenue).collect()] == [18000000000.75]


def test_warehouse_load_twice(spark, root):
    layout = curation.Layout(f"{root}/raw", f"{root}/lake")
    raw_reference(layout.raw)
    raw_day(layout.raw, "2026-06-01", 0)
    curation.run(spark, layout)
    curated = [spark.read.parquet(layout.curated(t)) for t in ("customers", "products", "orders", "order_items")]
    for _ in range(2):
        names = warehouse.load_star(spark, "wt_", f"{root}/wh", *curated)
    assert spark.read.table(names["fact_order_items"]).count() == 2
    assert spark.read.table(names["dim_date"]).count() == 1
    assert spark.read.table(names["dim_customer"]).count() == 1


def test_lakehouse_drops_the_directory_date(spark, root):
    raw_reference(f"{root}/raw")
    raw_day(f"{root}/raw", "2026-06-01", 0)
    gold = lakehouse.run(spark, f"{root}/raw", "lt_", f"{root}/lake")
    assert [(r.category, r.daily_revenue, r.total_items_sold, r.total_order_count) for r in gold.collect()] == [("Toys", 9.0, 6, 3)]


def test_old_files_arrive_late(spark, root):
    """A later delivery may be dated years back: its rows and its new column count."""
    import os

    from tradewind.streaming import ingest

    os.makedirs(f"{root}/late")
    for k, line in enumerate(['{"a": 1}', '{"a": 2, "b": 5}']):
        with open(f"{root}/late/{k}.json", "w") as f:
            f.write(line + "\n")
        if k:
            os.utime(f"{root}/late/{k}.json", (1e9, 1e9))
        schema = ingest.evolve_schema(spark, f"{root}/late", f"{root}/late-schema.json")
        got = ingest.ingest_stream(spark, f"{root}/late", schema, f"{root}/late-out", f"{root}/late-log")
    assert schema.names == ["a", "b"]
    assert sorted((r["a"], r["b"]) for r in got.collect()) == [("1", None), ("2", "5")]


def test_refresh_removes_vanished_groups(spark, frame, root):
    def agg(df):
        return df.groupBy("day").agg(F.countDistinct("k").alias("n"))

    base = frame([("a b:c", 1), ("d2", 1), (None, 1)], "day string, k int")
    sinks.overwrite_partitions(agg(base), root, "day")
    sinks.refresh_view(root, base.where("day = 'd2'"), base.where("day is null or day <> 'd2'"), agg, "day", "day")
    assert rows(spark.read.schema("n bigint, day string").parquet(root).select("day", "n")) == [("d2", 1)]


def test_csv_columns_by_name(spark, root):
    import os

    os.makedirs(root, exist_ok=True)
    with open(f"{root}/a.csv", "w") as f:
        f.write("b,x,A\n1,9,one\n")
    assert rows(sources.read_csv(spark, root, "a string, b int, c date")) == [("one", 1, None)]
    with open(f"{root}/b.csv", "w") as f:
        f.write("A,x,b\none,9,1\n")
    with pytest.raises(Exception, match="header|CSV"):
        sources.read_csv(spark, root, "a string, b int").collect()


def test_redelivered_order_counts_once(spark, root):
    """The same order again, with another status and another day, at day grain."""
    layout = curation.Layout(f"{root}/raw", f"{root}/lake")
    raw_reference(layout.raw)
    raw_day(layout.raw, "2026-06-01", 0)
    curation.run(spark, layout)
    raw_day(layout.raw, "2026-06-03", 0)
    curation.run(spark, layout)
    revenue = spark.read.parquet(layout.daily_revenue)
    assert {(str(r.order_date), float(r.total_revenue)) for r in revenue.collect()} == {("2026-06-03", 7.0)}
    assert spark.read.parquet(layout.current("orders")).count() == 2
    assert spark.read.parquet(layout.curated("orders")).count() == 4
    # Another order on the old day does not bring the old rows back.
    raw_day(layout.raw, "2026-06-01", 50)
    curation.run(spark, layout)
    revenue = spark.read.parquet(layout.daily_revenue)
    assert {(str(r.order_date), float(r.total_revenue)) for r in revenue.collect()} == {("2026-06-01", 7.0), ("2026-06-03", 7.0)}
    assert curation.current_customers(spark, layout).count() == 1


def test_star_load_takes_changes(spark, frame, root):
    """A second load with a new e-mail, a corrected quantity and an order on another day."""
    def load(email, quantity, day):
        return warehouse.load_star(
            spark, "wc_", root,
            frame([("1", "A", "B", email, "2026-01-01", "Rome", "x")], "customer_id string, first_name string, last_name string, email string, signup_date string, city string, segment string"),
            frame([("p1", "toy", "Toys", 1.5, True)], "product_id string, product_name string, category string, unit_price double, active_flag boolean"),
            frame([("o1", 1, day, "north", "Passed"), ("o2", 1, "2026-05-02 10:00:00", "north", "Passed")], "order_id string, customer_id int, order_ts string, store_region string, DataQualityEvaluationResult string").withColumn("order_ts", F.to_timestamp("order_ts")),
            frame([("o1", "p1", quantity, 1.5, 3.0), ("o2", "p1", 1, 1.5, 1.5)], "order_id string, product_id string, quantity int, unit_price double, line_total double"),
        )

    load("old@shop.com", 2, "2026-04-01 10:00:00")
    for _ in range(2):
        names = load("new@shop.com", 5, "2026-06-01 10:00:00")
    assert [r.email for r in spark.read.table(names["dim_customer"]).collect()] == ["new@shop.com"]
    fact = spark.read.table(names["fact_order_items"]).select("order_id", "quantity", "date_key", "date_month")
    assert rows(fact) == [("o1", 5, 20260601, 202606), ("o2", 1, 20260502, 202605)]


def test_upsert_leaves_unchanged_partitions_alone(spark, frame, root):
    """Rows that come as they are write nothing; a moved and a new one write their months
    only, with a feed of just these changes; known rows keep their numbers."""
    import glob

    ddl, path, name = "k string, v int, m int", f"{root}/upsert", "upsert_parts"
    sinks.save_table(frame([], f"{ddl}, id bigint").select("k", "v", "id", "m"), name, path, ["m"])

    def load(version, *lines):
        sinks.upsert_partitions(frame(lines, ddl), name, path, ["k"], "m", (f"{root}/feed/{version}", version), "id")
        return {m: sorted(glob.glob(f"{path}/m={m}/*.parquet")) for m in (1, 2, 3, 4)}

    def feed(version):
        return rows(spark.read.parquet(f"{root}/feed/{version}").select("_change_type", "k", "v", "m"))

    first = [("a", 1, 1), ("b", 2, 1), ("c", None, 2), ("d", 4, 3)]
    files = load(0, *first)
    assert sorted(feed(0), key=str) == sorted([("insert", *r) for r in first], key=str)
    assert load(1, *first) == files and feed(1) == []
    ids = {r.k: r.id for r in spark.read.table(name).collect()}
    assert sorted(ids.values()) == [1, 2, 3, 4]
    later = load(2, ("a", 1, 1), ("b", 2, 1), ("c", 7, 4), ("e", 5, 4))
    assert later[1] == files[1] and later[3] == files[3] and later[2] == [] and later[4]
    assert feed(2) == [("insert", "e", 5, 4), ("update_postimage", "c", 7, 4), ("update_preimage", "c", None, 2)]
    got = {r.k: (r.v, r.m, r.id) for r in spark.read.table(name).collect()}
    assert got == {"a": (1, 1, ids["a"]), "b": (2, 1, ids["b"]), "c": (7, 4, ids["c"]), "d": (4, 3, ids["d"]), "e": (5, 4, 5)}


def test_new_rows_leave_the_files_of_their_partition_alone(spark, frame, root):
    """Rows that come to a partition lie beside its others, which are not written again; a
    changed row writes its partition, with what is new there."""
    import glob

    ddl, path, name = "k string, v int, m int", f"{root}/come", "come_parts"
    sinks.save_table(frame([], f"{ddl}, id bigint").select("k", "v", "id", "m"), name, path, ["m"])

    def load(version, *lines):
        sinks.upsert_partitions(frame(lines, ddl), name, path, ["k"], "m", (f"{root}/come-feed/{version}", version), "id")
        return {m: set(glob.glob(f"{path}/m={m}/*.parquet")) for m in (1, 2)}

    first = [("b", 2, 1), ("d", 4, 2), ("c", 3, 1)]
    files = load(0, *first)
    assert rows(spark.read.table(name).select("k", "id")) == [("b", 1), ("c", 2), ("d", 3)]  # by partition, then by key
    later = load(1, *first, ("a", 1, 1))
    assert files[1] < later[1] and later[2] == files[2]
    assert load(1, *first, ("a", 1, 1)) == later  # repeated
    last = load(2, ("b", 9, 1), ("e", 5, 1), ("f", 6, 2))
    assert not last[1] & later[1] and files[2] < last[2]
    got = rows(spark.read.table(name).select("k", "v", "m"))
    assert got == [("a", 1, 1), ("b", 9, 1), ("c", 3, 1), ("d", 4, 2), ("e", 5, 1), ("f", 6, 2)]
    ids = {r.k: r.id for r in spark.read.table(name).collect()}
    assert {k: ids[k] for k in "abcd"} == {"a": 4, "b": 1, "c": 2, "d": 3} and {ids["e"], ids["f"]} == {5, 6}


def test_upsert_writes_aside_only_what_differs(spark, frame, root, monkeypatch):
    """Of many orders one is new, one brings a corrected line, one only a line more, and one
    has moved to another month: the others' lines are neither written aside nor joined."""
    from tradewind.sinks import tables

    ddl, path, name = "o string, p int, v int, m int", f"{root}/groups", "group_parts"
    sinks.save_table(frame([], f"{ddl}, id bigint").select("o", "p", "v", "id", "m"), name, path, ["m"])

    def load(version, lines):
        sinks.upsert_partitions(frame(lines, ddl), name, path, ["o", "p"], "m", (f"{root}/groups-feed/{version}", version), "id")
        return rows(spark.read.parquet(f"{root}/groups-feed/{version}").select("_change_type", "o", "p", "v", "m"))

    first = [(f"o{k}", p, None if k % 9 == 0 else k, 1 + k % 3) for k in range(60) for p in (1, 2)]
    assert len(load(0, first)) == 120
    ids = {(r.o, r.p): r.id for r in spark.read.table(name).collect()}
    aside = []
    write = tables.stored
    monkeypatch.setattr(tables, "stored", lambda df, label: aside.append((label, (out := write(df, label)).count())) or out)
    assert load(1, first) == [] and max(n for _, n in aside) == 0
    aside.clear()
    # o4 comes with its second line alone; o6 has left month 1 for one that no order was in.
    later = [r for r in first if r[0] not in ("o3", "o4", "o6", "o8")]
    later += [("o3", 1, 3, 1), ("o3", 2, 0, 1), ("o4", 2, 4, 2), ("o6", 1, 6, 7), ("o6", 2, 6, 7), ("o8", 1, 8, 3), ("o8", 2, 8, 3), ("o8", 3, 8, 3), ("new", 1, 5, 2)]
    want = [("insert", "new", 1, 5, 2), ("insert", "o8", 3, 8, 3), ("update_postimage", "o3", 2, 0, 1), ("update_postimage", "o6", 1, 6, 7), ("update_postimage", "o6", 2, 6, 7)]
    want += [("update_preimage", "o3", 2, 3, 1), ("update_preimage", "o6", 1, 6, 1), ("update_preimage", "o6", 2, 6, 1)]
    assert load(2, later) == want
    assert max(n for label, n in aside if label in ("unlike", "differ")) <= 10
    assert rows(spark.read.table(name).select("o", "p", "v", "m")) == rows(frame(later + [("o4", 1, 4, 2)], ddl))
    now = {(r.o, r.p): r.id for r in spark.read.table(name).collect()}
    assert {k: now[k] for k in ids} == ids and {now["new", 1], now["o8", 3]} == {121, 122}
    assert load(3, later) == []
