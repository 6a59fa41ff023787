"""Scalar cleaning expressions. All are built-in functions, so they stay inside
whole-stage codegen and filters on their inputs still reach the scan."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fill(c: ColumnOrName, default: Any) -> Column:
    """``c``, or ``default`` where it is null."""
    return F.coalesce(_col(c), default if isinstance(default, Column) else F.lit(default))


def normalize_email(c: ColumnOrName) -> Column:
    return F.lower(F.trim(_col(c)))


def parse_ts(c: ColumnOrName) -> Column:
    """Timestamp of ISO text or of ``yyyy-MM-dd HH:mm:ss.SSSSSS``; null if neither."""
    return F.try_to_timestamp(_col(c))


def parse_date(c: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    """Date of text in ``fmt``; null if the text does not fit."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)).cast("date")


def order_day(c: ColumnOrName) -> Column:
    return F.to_date(_col(c))


def clamp_non_negative(c: ColumnOrName) -> Column:
    """0 for negative values. Null stays null, which ``greatest`` would lose."""
    c = _col(c)
    return F.when(c < 0, F.lit(0)).otherwise(c)


def money(c: ColumnOrName) -> Column:
    return F.round(_col(c), 2)


def date_key(c: ColumnOrName) -> Column:
    """The day of a date or timestamp as an int ``YYYYMMDD``."""
    c = _col(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def valid_email(c: ColumnOrName) -> Column:
    # Fixed value: the e-mail shape the pipeline's drop rule asks for.
    return _col(c).like("%_@__%.__%")
