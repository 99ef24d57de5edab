"""Column expressions. All are built-in Spark functions, evaluated on the executors."""

from pubweave.functions.dates import parse_day_month_year, publication_date_parts
from pubweave.functions.numbers import leading_number, lenient_long, metric_long
from pubweave.functions.text import (
    country_name,
    decode_entities,
    element_text,
    last_comma_split,
    plain_text,
    strip,
)

__all__ = [
    "country_name",
    "decode_entities",
    "element_text",
    "last_comma_split",
    "leading_number",
    "lenient_long",
    "metric_long",
    "parse_day_month_year",
    "plain_text",
    "publication_date_parts",
    "strip",
]
