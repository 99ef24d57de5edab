"""Cleaning of the merged collection before analysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pubweave.functions import lenient_long

NUMBER_COLUMNS = ("Day", "Year", "Downloads")


def locations_list(value: Column, dtype: T.DataType) -> Column:
    """``locations`` as a list: a missing or scalar value becomes a one-element list."""
    if isinstance(dtype, T.ArrayType):
        element = dtype.elementType.simpleString()
        return F.coalesce(value, F.array(F.lit(None).cast(element)))
    return F.array(value)


def whole_number(value: Column, dtype: T.DataType) -> Column:
    """``lenient_long``, without reading text where the column already holds whole numbers."""
    if isinstance(dtype, T.IntegralType):
        return F.coalesce(value.cast("bigint"), F.lit(0).cast("bigint"))
    return lenient_long(value)


def clean_articles(
    articles: DataFrame,
    numbers: tuple[str, ...] = NUMBER_COLUMNS,
    drop_unknown_year: bool = False,
) -> DataFrame:
    """Numbers that may be text become integers, ``locations`` becomes a list.

    A missing or unreadable number becomes 0, so articles without a year form the group ``Year = 0``
    unless ``drop_unknown_year`` is set. Only projections: no shuffle, and columns nobody reads
    later are still pruned from the scan.
    """
    present = {f.name: f.dataType for f in articles.schema.fields}
    cleaned = {n: whole_number(F.col(n), present[n]) for n in numbers if n in present}
    if "Year" in cleaned:
        cleaned["Year"] = F.coalesce(cleaned["Year"].try_cast("int"), F.lit(0))
    if "locations" in present:
        cleaned["locations"] = locations_list(F.col("locations"), present["locations"])
    result = articles.withColumns(cleaned)
    return result.filter(F.col("Year") != 0) if drop_unknown_year else result
