"""Tables laid out along a space-filling curve, so that filters on any of its columns skip files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .files import stored

BITS = 6  # a column: 64 quantiles


def interleaved(places: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of whole numbers below ``2 ** bits`` in turns, the highest ones first."""
    n = len(places)
    if n * bits > 62:
        raise ValueError(f"{n} columns of {bits} bits do not fit into a long")
    parts = [F.shiftleft(F.shiftright(p, b).bitwiseAND(1), b * n + (n - 1 - i)) for i, p in enumerate(places) for b in range(bits)]
    return reduce(lambda x, y: x.bitwiseOR(y), parts)


def curve(df: DataFrame, cols: Sequence[str], bits: int = BITS) -> Column:
    """The place of a row on the curve through ``cols`` (numbers, dates or times): for each
    column its place among quantiles of ``df``, then their bits in turns. Nulls come first."""
    steps = 1 << bits
    numbers = [_number(df, c) for c in cols]
    cuts = df.agg(*[F.percentile_approx(x, [k / steps for k in range(1, steps)], 10_000).alias(f"c{i}") for i, x in enumerate(numbers)]).first()
    places = []
    for i, x in enumerate(numbers):
        bounds = sorted(set(cuts[f"c{i}"] or []))
        # The bounds are sorted, so the place is found by halving.
        places.append(F.when(x.isNull(), F.lit(0)).otherwise(_place(x, bounds, 0, len(bounds))).cast("long"))
    return interleaved(places, bits)


def _number(df: DataFrame, col: str) -> Column:
    kind = dict(df.dtypes)[col]
    c = F.col(col)
    if kind == "date":
        return F.unix_date(c).cast("double")
    return (F.unix_micros(c) if kind == "timestamp" else c).cast("double")


def _place(x: Column, bounds: list[float], low: int, high: int) -> Column:
    """How many of ``bounds[low:high]``, and those before, are at most ``x``."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(x < bounds[middle], _place(x, bounds, low, middle)).otherwise(_place(x, bounds, middle + 1, high))


def clustered_table(df: DataFrame, name: str, cols: Sequence[str], files: int, path: str | None = None) -> DataFrame:
    """Write ``df`` as the table ``name`` in about ``files`` files, rows in the order of the
    curve through ``cols``: each file has a narrow range of each of them, which the footers
    tell, so a scan with a filter on some of ``cols`` opens a part of the row groups. A place
    that many rows share is divided by a hash of the row."""
    rows = stored(df, "clustered")
    placed = rows.withColumn("_z", curve(rows, cols)).withColumn("_tie", F.xxhash64(*[f"`{c}`" for c in df.columns]))
    dealt = placed.repartitionByRange(files, "_z", "_tie").sortWithinPartitions("_z", *cols).drop("_z", "_tie")
    writer = dealt.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.read.table(name)
