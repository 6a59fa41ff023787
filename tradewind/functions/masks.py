"""E-mail masks. Whether the reader is entitled is an argument: a plain boolean
known on the driver, or a column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import ColumnOrName, _col

# Fixed value: what a reader without the role sees.
MASKED_EMAIL = "XXXX@XXXX.com"

# Fixed value: every character after the first that still has an "@" behind it.
_LOCAL_PART_TAIL = "(?<=.).(?=.*@)"


def mask_email(c: ColumnOrName, entitled: bool | Column = False) -> Column:
    """Star the local part but for its first character.

    Text without ``@`` and one-letter local parts come out unmasked, as the rule
    is written; :func:`mask_email_strict` closes that gap.
    """
    c = _col(c)
    return _unless(entitled, c, F.regexp_replace(c, _LOCAL_PART_TAIL, "*"))


def mask_email_strict(c: ColumnOrName, entitled: bool | Column = False) -> Column:
    """Like :func:`mask_email`, and stars entirely what that would leave readable."""
    c = _col(c)
    weak = mask_email(c)
    starred = F.regexp_replace(c, "[^@]", "*")
    local = F.regexp_replace(c, "^(.)(@.*)$", "*$2")
    safe = (
        F.when(~c.contains("@"), starred)
        .when(weak == c, F.when(c.rlike("^.@"), local).otherwise(starred))
        .otherwise(weak)
    )
    return _unless(entitled, c, safe)


def mask_for_role(c: ColumnOrName, entitled: bool | Column, constant: str = MASKED_EMAIL) -> Column:
    """``c`` for an entitled reader, ``constant`` (also in place of null) for others."""
    return _unless(entitled, _col(c), F.lit(constant))


def _unless(entitled: bool | Column, clear: Column, masked: Column) -> Column:
    if isinstance(entitled, bool):
        return clear if entitled else masked
    return F.when(entitled, clear).otherwise(masked)
