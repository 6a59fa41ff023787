"""An equi-join that stays splittable when one key holds much of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pad(*on: str) -> Column:
    """Always 0, which the optimizer cannot know."""
    return F.pmod(F.hash(*on), F.lit(1))


def split_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` on the columns ``on``, which are unique in ``right``.

    A side that a window or an aggregate has just hashed by ``on`` is joined where
    it lies, and AQE splits a hot key only between two exchanges of the join's own.
    With one more column in the join key, always 0, both sides get such an exchange
    (if neither is small enough to be broadcast; then nothing changes). The extra
    exchange is one of the smaller side.
    """
    keys = [on] if isinstance(on, str) else list(on)
    a, b = left.withColumn("_pad", _pad(*keys)), right.withColumn("_pad", _pad(*keys))
    return a.join(b, [*keys, "_pad"], how).drop("_pad")
