"""Number parsing. Every parser is total: it never fails a job on bad text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Java also parses '1d', '1.5f', 'NaN' and 'Infinity' as doubles; none of them is a number here.
_DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_DECIMAL_PREFIX = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)"
_WHOLE = r"^\s*[+-]?\d+\s*$"


def lenient_long(value: Column) -> Column:
    """Number text to bigint, truncated toward zero; anything else, also NULL, gives 0."""
    text = value.cast("string")
    number = F.when(text.rlike(_DECIMAL), F.trim(F.regexp_replace(text, r"\s", "")))
    return F.coalesce(number.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def metric_long(value: Column, missing: str = "N/A") -> Column:
    """Counter text such as ``'1,234'`` to bigint.

    The ``missing`` marker gives 0. Malformed text gives NULL, so the caller can reject the row.
    """
    digits = F.regexp_replace(value, ",", "")
    return F.when(value == missing, F.lit(0).cast("bigint")).when(
        digits.rlike(_WHOLE), F.trim(digits).try_cast("bigint")
    )


def leading_number(value: Column) -> Column:
    """The number a text starts with, as double; NULL when it starts with none."""
    return F.nullif(
        F.regexp_extract(value.cast("string"), _DECIMAL_PREFIX, 1), F.lit("")
    ).try_cast("double")
