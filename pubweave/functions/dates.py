"""Publication dates such as ``5 March 2021``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

_SHAPE = r"^\d{1,2}\s+\p{L}+\s+\d{4}$"


def parse_day_month_year(value: Column, run_date: dt.date | Column) -> Column:
    """Parse day, full month name and year; text of another shape gives ``run_date``.

    ``run_date`` is an argument so that a repeated run gives the same rows.
    """
    fallback = run_date if isinstance(run_date, Column) else F.lit(run_date)
    text = F.when(value.rlike(_SHAPE), F.regexp_replace(value, r"\s+", " "))
    parsed = F.try_to_timestamp(text, F.lit("d MMMM yyyy")).cast("date")
    return F.coalesce(parsed, fallback.cast("date"))


def publication_date_parts(date: Column) -> dict[str, Column]:
    """The four date columns of an article."""
    return {
        "Date": F.date_format(date, "dd MMMM yyyy"),
        "Year": F.year(date),
        "Month": F.date_format(date, "MMMM"),
        "Day": F.dayofmonth(date),
    }
