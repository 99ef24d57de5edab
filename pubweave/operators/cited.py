"""The most cited articles of each year."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from pubweave.functions import leading_number


def top_cited_per_year(articles: DataFrame, n: int = 5, tie_break: str = "doi") -> DataFrame:
    """``(Year, position, name, title, citations)``: the ``n`` most cited articles of each year.

    ``citations`` is the number the value starts with; articles without one come last, ties by
    ``tie_break``. The rank filter is applied in every task before the shuffle, so a year with
    a third of all articles sends at most ``n`` rows per task.
    """
    dtype = articles.schema["citations"].dataType
    is_number = isinstance(dtype, T.NumericType)
    number = F.col("citations").cast("double") if is_number else leading_number(F.col("citations"))
    best_first = Window.partitionBy("Year").orderBy(F.desc_nulls_last("citations"), F.asc(tie_break))
    cited = articles.select(
        "Year",
        "title",
        F.nanvl(number, F.lit(None)).alias("citations"),
        F.col(tie_break).alias(tie_break),
    )
    return (
        cited.withColumn("position", F.row_number().over(best_first))
        .filter(F.col("position") <= n)
        .select(
            "Year",
            "position",
            F.concat(F.lit("Article "), F.col("position")).alias("name"),
            "title",
            "citations",
        )
    )


def cited_by_year(top: DataFrame) -> DataFrame:
    """Nested form ``(Year, articles)`` of ``top_cited_per_year``, by year; lists are top-k long."""
    entry = F.struct("position", "name", "title", "citations")
    entries = F.array_sort(F.collect_list(entry))
    shown = F.transform(
        entries,
        lambda e: F.struct(
            e["name"].alias("name"), e["title"].alias("title"), e["citations"].alias("citations")
        ),
    )
    return top.groupBy("Year").agg(shown.alias("articles")).orderBy("Year")
