"""Row and rule outcomes of data-quality rules, quarantine, and expectations."""

from __future__ import annotations

import operator
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .joins import split_join

# The outcome columns readers of curated tables expect.
PASSED_RULES = "DataQualityRulesPass"
FAILED_RULES = "DataQualityRulesFail"
RESULT = "DataQualityEvaluationResult"

_OPS: dict[str, Callable] = {
    ">=": operator.ge,
    ">": operator.gt,
    "<=": operator.le,
    "<": operator.lt,
    "=": operator.eq,
    "!=": operator.ne,
}


@dataclass(frozen=True)
class Rule:
    """One rule: ``holds`` is its row test; ``op value`` bounds the share of rows
    that must hold for the rule as a whole."""

    name: str
    col: str
    kind: str
    holds: Callable[[str], Column] = field(repr=False, compare=False)
    op: str = "="
    value: float = 1.0
    ref: DataFrame | None = field(default=None, repr=False, compare=False)
    ref_col: str | None = None


def _exact(number: float) -> str:
    """The number as given, whole ones without a fraction: no two share a text."""
    return str(int(number)) if float(number).is_integer() else repr(number)


def is_complete(col: str) -> Rule:
    return Rule(f'IsComplete "{col}"', col, "row", lambda c: F.col(c).isNotNull())


def is_unique(col: str) -> Rule:
    """Every copy of a repeated value fails, nulls counted as one value."""
    return Rule(f'IsUnique "{col}"', col, "unique", lambda c: F.col(c).isNotNull())


def column_values(col: str, op: str, bound: float) -> Rule:
    """``col op bound``; null fails."""
    return Rule(
        f'ColumnValues "{col}" {op} {_exact(bound)}',
        col,
        "row",
        lambda c: F.coalesce(_OPS[op](F.col(c), F.lit(bound)), F.lit(False)),
    )


def referential(
    col: str, ref: DataFrame, ref_col: str, ref_name: str = "reference", op: str = "=", value: float = 1.0
) -> Rule:
    """``col`` must occur as ``ref_col`` in ``ref``; null fails."""
    return Rule(
        f'ReferentialIntegrity "{col}" "{ref_name}.{{{ref_col}}}" {op} {float(value)!r}',
        col,
        "reference",
        lambda c: F.col(c).isNotNull(),
        op,
        value,
        ref,
        ref_col,
    )


def referential_fail(df: DataFrame, ref: DataFrame, col: str, ref_col: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``col`` does not occur in ``ref``, nulls included."""
    keys = ref.select(F.col(ref_col or col).alias(col))
    return split_join(df, keys, col, "left_anti").select(*df.columns)


def _with_flags(df: DataFrame, rules: Sequence[Rule], keep: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, list[Column]]:
    """``df`` with one helper column per rule that needs other rows, and each
    rule's row test."""
    tests = []
    for i, rule in enumerate(rules):
        flag = f"_rule_{i}"
        if rule.kind == "unique":
            # Counted with map-side combining, so a value on a third of all rows
            # costs one task no more than another; a window would gather them.
            # The null-safe join key differs from the count's, so the join gets
            # exchanges of its own, which AQE can split.
            repeated = (
                df.groupBy(F.col(rule.col).alias(f"{flag}_key"))
                .agg(F.count(F.lit(1)).alias("_n"))
                .where("_n > 1")
                .select(f"{flag}_key", F.lit(True).alias(flag))
            )
            repeated = keep(repeated) if keep else repeated
            df = df.join(repeated, F.col(rule.col).eqNullSafe(F.col(f"{flag}_key")), "left").drop(f"{flag}_key")
            tests.append(F.col(flag).isNull())
        elif rule.kind == "reference":
            known = rule.ref.select(F.col(rule.ref_col).alias(rule.col)).dropna().distinct()
            df = split_join(df, known.withColumn(flag, F.lit(True)), rule.col, "left")
            tests.append(F.col(flag).isNotNull())
        else:
            tests.append(rule.holds(rule.col))
    return df, tests


def evaluate_rows(df: DataFrame, rules: Sequence[Rule], keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``df`` with the names of the rules each row passed and failed and the
    overall ``Passed``/``Failed``.

    ``keep`` writes the values that occur more than once: with their size known, a few of
    them need no shuffle of ``df``.
    """
    flagged, tests = _with_flags(df, rules, keep)

    all_hold = F.lit(True)
    for t in tests:
        all_hold = all_hold & t

    def names(wanted: bool) -> Column:
        picked = [F.when(t if wanted else ~t, F.lit(r.name)) for r, t in zip(rules, tests)]
        # Most rows pass all rules: what they get is the same for all, and not built for each.
        whole = F.array(*[F.lit(r.name) for r in rules if wanted]).cast("array<string>")
        return F.when(all_hold, whole).otherwise(F.filter(F.array(*picked).cast("array<string>"), lambda n: n.isNotNull()))

    return flagged.select(
        *df.columns,
        names(True).alias(PASSED_RULES),
        names(False).alias(FAILED_RULES),
        F.when(all_hold, F.lit("Passed")).otherwise(F.lit("Failed")).alias(RESULT),
    )


def evaluate_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: (rule, outcome, ratio), all measured in one aggregate.

    A rule over no rows holds.
    """
    flagged, tests = _with_flags(df, rules)
    measured = flagged.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(t).alias(f"_ok_{i}") for i, t in enumerate(tests)],
    )
    rows = F.col("_rows")

    def outcome(i: int, rule: Rule) -> Column:
        ratio = F.when(rows == 0, F.lit(1.0)).otherwise(F.col(f"_ok_{i}") / rows)
        passed = _OPS[rule.op](ratio, F.lit(float(rule.value)))
        return F.struct(
            F.lit(rule.name).alias("rule"),
            F.when(passed, F.lit("Passed")).otherwise(F.lit("Failed")).alias("outcome"),
            ratio.alias("ratio"),
        )

    return measured.select(F.inline(F.array(*[outcome(i, r) for i, r in enumerate(rules)])))


def row_failed() -> Column:
    return F.size(FAILED_RULES) > 0


def only_passed(df: DataFrame, col: str = RESULT) -> DataFrame:
    return df.where(F.col(col) == "Passed")


def split_quarantine(outcomes: DataFrame, reason: str) -> tuple[DataFrame, DataFrame]:
    """(passed rows without the rule lists, failed rows with ``reason``).

    Both are filters of ``outcomes``; hand in a stored or persisted frame.
    """
    from .rows import drop_prefixed, with_reason

    passed = drop_prefixed(outcomes.where(~row_failed()), "DataQualityRules")
    failed = with_reason(outcomes.where(row_failed()), reason)
    return passed, failed


def quality_score(outcomes: DataFrame) -> DataFrame:
    """(passed, failed, total, score): score is the passed share in percent, two
    digits, and 100 for no rows. One conditional aggregate."""
    total, passed = F.col("total"), F.col("passed")
    return outcomes.agg(
        F.count_if(~row_failed()).alias("passed"),
        F.count_if(row_failed()).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    ).withColumn("score", F.when(total == 0, F.lit(100.0)).otherwise(F.round(passed / total * 100, 2)))


def dq_metrics(outcomes: DataFrame, context: str) -> DataFrame:
    """:func:`quality_score` under the name of the check it belongs to."""
    return quality_score(outcomes).select(F.lit(context).alias("context"), "passed", "failed", "total", "score")


def holds(cond: str | Column) -> Column:
    """Whether ``cond`` is true; unknown counts as not holding."""
    cond = F.expr(cond) if isinstance(cond, str) else cond
    return F.coalesce(cond, F.lit(False))


def expect(df: DataFrame, **conditions: str | Column) -> tuple[DataFrame, Observation]:
    """Keep all rows and count, while they pass by, those that miss each condition.

    The counts are in ``observation.get`` after the first action.
    """
    seen = Observation()
    missed = [F.count_if(~holds(c)).alias(name) for name, c in conditions.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *missed), seen


def expectation_report(df: DataFrame, **conditions: str | Column) -> DataFrame:
    """The counts of :func:`expect` as a table: (expectation, rows, violations)."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(~holds(c)).alias(n) for n, c in conditions.items()]
    )
    lines = [F.struct(F.lit(n).alias("expectation"), F.col("_rows").alias("rows"), F.col(n).alias("violations")) for n in conditions]
    return counted.select(F.inline(F.array(*lines)))


def expect_or_drop(df: DataFrame, cond: str | Column) -> DataFrame:
    """Rows for which ``cond`` is true; unknown counts as not holding."""
    return df.where(holds(cond))


def expect_or_fail(df: DataFrame, name: str, cond: str | Column) -> DataFrame:
    """``df``, or an error in the first task that meets a row that misses ``cond``."""
    checked = F.when(holds(cond), F.lit(True)).otherwise(
        F.raise_error(F.lit(f"expectation {name} violated")).cast("boolean")
    )
    return df.where(checked)


def kpi_alert(df: DataFrame, col: str, op: str, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    """One line per row of ``df``: (*by, metric, value, threshold, triggered)."""
    value = F.col(col).cast("double")
    return df.select(
        *by,
        F.lit(col).alias("metric"),
        value.alias("value"),
        F.lit(float(threshold)).alias("threshold"),
        F.coalesce(_OPS[op](value, F.lit(float(threshold))), F.lit(False)).alias("triggered"),
    )
