"""Table profiles: shape, nulls, duplicates, ranges, common values, histograms
and the defect classes the cleaning looks for.

Each is one pass of partial aggregates (``common_values``: two); only results bounded by
the number of columns, values asked for, bins or grid points are ever gathered.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _text(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def profile_shape(df: DataFrame) -> DataFrame:
    """(column, type, rows, columns), one row per column."""
    kinds = F.array(
        *[F.struct(F.lit(c).alias("column"), F.lit(t).alias("type")) for c, t in df.dtypes]
    )
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.inline(kinds), "rows", F.lit(len(df.columns)).cast("long").alias("columns")
    )


def profile_nulls(df: DataFrame) -> DataFrame:
    """(column, null_count, null_pct), the percentage with two digits."""
    rows = F.col("_rows")
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(df.columns)],
    )
    lines = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"n_{i}").alias("null_count"),
            F.when(rows > 0, F.round(F.col(f"n_{i}") / rows * 100, 2)).alias("null_pct"),
        )
        for i, c in enumerate(df.columns)
    ]
    return counted.select(F.inline(F.array(*lines)))


def profile_duplicates(df: DataFrame) -> DataFrame:
    """(duplicate_rows): copies beyond the first of equal rows, nulls equal."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def profile_ranges(df: DataFrame) -> DataFrame:
    """(column, minimum, maximum, mean) of each numeric column, the mean with two digits."""
    cols = _numeric(df)
    found = df.agg(
        *[F.min(c).cast("double").alias(f"lo_{i}") for i, c in enumerate(cols)],
        *[F.max(c).cast("double").alias(f"hi_{i}") for i, c in enumerate(cols)],
        *[F.round(F.avg(c).cast("double"), 2).alias(f"avg_{i}") for i, c in enumerate(cols)],
    )
    lines = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"lo_{i}").alias("minimum"),
            F.col(f"hi_{i}").alias("maximum"),
            F.col(f"avg_{i}").alias("mean"),
        )
        for i, c in enumerate(cols)
    ]
    return found.select(F.inline(F.array(*lines)))


def profile_top_values(df: DataFrame, k: int = 10, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, value, rows, rank): the ``k`` commonest values of each text column,
    nulls excluded, equal counts in order of value. Counts every value there is; see
    :func:`common_values` for columns of many values."""
    return _ranked(_pairs(df, list(cols or _text(df))), k)


def _pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    each = [F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in cols]
    return df.select(F.inline(F.array(*each))).where("value IS NOT NULL")


def _ranked(pairs: DataFrame, k: int) -> DataFrame:
    counted = pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))
    # The rank filter lets each task keep k values per column before the shuffle.
    order = Window.partitionBy("column").orderBy(F.desc("rows"), "value")
    return counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def common_values(df: DataFrame, k: int = 10, cols: Sequence[str] | None = None, tracked: int = 4096) -> DataFrame:
    """The same as :func:`profile_top_values`, without shuffling every value.

    One pass keeps, in each task, a summary of ``tracked`` values a column with a bound for
    what it may have missed; the summaries are merged. One more counts the values that are
    named there, and no others. If the ``k``-th of them has more rows than any other value
    can have, the column is settled. Columns that are not, such as those whose values
    hardly repeat, are counted in full.
    """
    cols = list(cols or _text(df))
    # A null is a value to the summary.
    found = df.agg(F.count(F.lit(1)).alias("rows"), *[F.expr(f"approx_top_k(`{c}`, {tracked}, {tracked})").alias(f"top_{i}") for i, c in enumerate(cols)]).first()
    named, others = [], {}
    for i, c in enumerate(cols):
        top = found[f"top_{i}"] or []
        # A value is left out if it may be one of those the summary has dropped, whose rows
        # are within its error, or if the list is full.
        if sum(t["count"] for t in top) == found["rows"]:
            others[c] = 0
        else:
            others[c] = max(2 * math.ceil(3.5 * found["rows"] / tracked), min(t["count"] for t in top) if len(top) == tracked else 0)
        # Too few can pass the bound to settle a column of which fewer than k are above it.
        hopeful = others[c] == 0 or sum(t["count"] > others[c] for t in top if t["item"] is not None) >= k
        if hopeful:
            named += [(c, t["item"]) for t in top if t["item"] is not None]
        else:
            others[c] = None
    spark = df.sparkSession
    candidates = spark.createDataFrame(named, "column string, value string")
    tried = [c for c in cols if others[c] is not None]
    out = None
    if tried:
        counted = _ranked(_pairs(df, tried).join(candidates, ["column", "value"], "left_semi"), k)
        rows = counted.collect()  # k a column at most
        last = {c: min((r["rows"] for r in rows if r["column"] == c), default=0) for c in tried}
        enough = {c: sum(r["column"] == c for r in rows) == k for c in tried}
        settled = [c for c in tried if others[c] == 0 or (enough[c] and last[c] > others[c])]
        out = spark.createDataFrame([r for r in rows if r["column"] in settled], counted.schema)
        tried = settled
    rest = [c for c in cols if c not in tried]
    if not rest:
        return out
    full = profile_top_values(df, k, rest)
    return full if out is None else out.unionByName(full)


def _bounds(df: DataFrame, col: str) -> tuple[Column, Column]:
    """Smallest and largest value as scalar subqueries, each computed once."""
    values = df.select(F.col(col).cast("double").alias("v"))
    return values.agg(F.min("v")).scalar(), values.agg(F.max("v")).scalar()


def histogram(df: DataFrame, col: str, bins: int = 40) -> DataFrame:
    """(bin, lower, upper, rows): equal-width bins from the smallest to the largest
    value, the last one closed, empty ones included."""
    lo, hi = _bounds(df, col)
    ranged = df.select(F.col(col).cast("double").alias("v")).where("v IS NOT NULL")
    ranged = ranged.withColumns({"lo": lo, "hi": hi})
    v = F.col("v")
    edge = lambda i: F.col("lo") + i * ((F.col("hi") - F.col("lo")) / bins)
    raw = F.floor((v - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    guess = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")
    # The division may round across an edge; the edges themselves decide.
    placed = ranged.withColumn("_g", guess).withColumn(
        "bin",
        F.when((F.col("_g") > 0) & (v < edge(F.col("_g"))), F.col("_g") - 1)
        .when((F.col("_g") < bins - 1) & (v >= edge(F.col("_g") + 1)), F.col("_g") + 1)
        .otherwise(F.col("_g")),
    )
    # A constant column has all its rows in bin 0 of zero width.
    counted = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("rows"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).withColumns({"lo": lo, "hi": hi})
    return every.join(counted, "bin", "left").select(
        "bin",
        edge(F.col("bin")).alias("lower"),
        F.when(F.col("bin") == bins - 1, F.col("hi")).otherwise(edge(F.col("bin") + 1)).alias("upper"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )


def kde(df: DataFrame, col: str, points: int = 50) -> DataFrame:
    """(point, x, density): Gaussian density estimate on an even grid from the
    smallest to the largest value, bandwidth by Scott's rule.

    Each task adds its values' kernels into one running sum per grid point, so no
    value is shuffled and no (value, point) pairs are emitted. The five
    figures that fix the grid are read once on the driver.
    """
    values = df.select(F.col(col).cast("double").alias("v")).where("v IS NOT NULL")
    n, lo, hi, sd = values.agg(F.count("v"), F.min("v"), F.max("v"), F.stddev_samp("v")).first()
    schema = "point int, x double, density double"
    if not n or n < 2 or not sd:
        return df.sparkSession.createDataFrame([], schema)
    width = sd * n ** (-0.2)
    scale = 1.0 / (n * width * math.sqrt(2 * math.pi))
    grid = [lo + i * (hi - lo) / (points - 1) for i in range(points)]
    sums = [
        F.sum(F.exp(-0.5 * F.pow((F.col("v") - x) / width, 2))).alias(f"s_{i}") for i, x in enumerate(grid)
    ]
    lines = [
        F.struct(F.lit(i).alias("point"), F.lit(x).alias("x"), (F.col(f"s_{i}") * scale).alias("density"))
        for i, x in enumerate(grid)
    ]
    return values.agg(*sums).select(F.inline(F.array(*lines)))


def null_map(df: DataFrame, key: str, blocks: int = 20) -> DataFrame:
    """(column, block, rows, null_rate): share of nulls per column and block of rows.

    A block is one of ``blocks`` equal ranges of the integer ``key``, so no global
    sort is needed; rows without a key are block -1.
    """
    k = F.col(key).cast("long")
    lo = df.agg(F.min(k)).scalar()
    hi = df.agg(F.max(k)).scalar()
    block = F.floor((k - lo) * blocks / (hi - lo + 1)).cast("int")
    blocked = df.withColumn("_block", F.coalesce(block, F.lit(-1)))
    rates = blocked.groupBy("_block").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n_{i}") for i, c in enumerate(df.columns)],
    )
    lines = [
        F.struct(F.lit(c).alias("column"), (F.col(f"n_{i}") / F.col("_rows")).alias("null_rate"))
        for i, c in enumerate(df.columns)
    ]
    return rates.select(
        F.col("_block").alias("block"), F.col("_rows").alias("rows"), F.inline(F.array(*lines))
    ).select("column", "block", "rows", "null_rate")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """(rows, keys, repeated_keys, extra_rows, extra_pct) for the non-null values of ``key``."""
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    counted = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
    ).withColumn("extra_rows", F.col("rows") - F.col("keys"))
    return counted.withColumn(
        "extra_pct", F.when(F.col("rows") > 0, F.round(F.col("extra_rows") / F.col("rows") * 100, 2))
    )


def email_class(c: str | Column) -> Column:
    """null, empty, no_at, no_domain, padded or ok; the first that fits."""
    c = F.col(c) if isinstance(c, str) else c
    bare = F.trim(c)
    return (
        F.when(c.isNull(), "null")
        .when(bare == "", "empty")
        .when(~c.contains("@"), "no_at")
        .when(bare.endswith("@"), "no_domain")
        .when(bare != c, "padded")
        .otherwise("ok")
    )


def email_defects(df: DataFrame, col: str = "email") -> DataFrame:
    return df.groupBy(email_class(col).alias("email_class")).agg(F.count(F.lit(1)).alias("rows"))


def item_defects(items: DataFrame, products: DataFrame) -> DataFrame:
    """(rows, unknown_product, zero_quantity, negative_quantity) over all items.

    The items are counted per product first, so the join with the products sees
    each product once however often it was sold.
    """
    per_product = items.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("quantity") == 0).alias("zero"),
        F.count_if(F.col("quantity") < 0).alias("negative"),
    )
    known = products.select("product_id", F.lit(True).alias("_known")).dropna().distinct()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per_product.join(known, "product_id", "left").agg(
        total("n").alias("rows"),
        total(F.when(F.col("_known").isNull(), F.col("n"))).alias("unknown_product"),
        total("zero").alias("zero_quantity"),
        total("negative").alias("negative_quantity"),
    )
