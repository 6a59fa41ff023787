"""Column expressions: cleaning, keys and masks."""

from .cleaning import (
    clamp_non_negative,
    date_key,
    fill,
    money,
    normalize_email,
    order_day,
    parse_date,
    parse_ts,
    valid_email,
)
from .masks import MASKED_EMAIL, mask_email, mask_email_strict, mask_for_role

__all__ = [
    "MASKED_EMAIL",
    "clamp_non_negative",
    "date_key",
    "fill",
    "mask_email",
    "mask_email_strict",
    "mask_for_role",
    "money",
    "normalize_email",
    "order_day",
    "parse_date",
    "parse_ts",
    "valid_email",
]
