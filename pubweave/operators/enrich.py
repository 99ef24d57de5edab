"""Journal quartiles for articles: an as-of join with a bounded look-back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pubweave.functions import strip
from pubweave.storage import BROADCAST_BYTES, store


def journal_key(value: Column, on: str = "name") -> Column:
    """What a journal is compared by: its name without regard to case and runs of blanks, or the
    letters of its ISSN, without prefix and hyphen."""
    if on == "ISSN":
        return F.regexp_replace(F.regexp_replace(F.upper(value), "^.*ISSN", ""), "[^0-9X]", "")
    return F.lower(F.regexp_replace(strip(value), r"(?U)\s+", " "))


#: Up to this look-back the served years of an entry are listed; beyond it they would multiply the table.
LISTED_LOOKBACK = 16


def decided_quartiles(rankings: DataFrame, journal: str = "journal", on: str = "name") -> DataFrame:
    """``(journal, Year, Quartile)`` of the entries that count.

    The first ranking row of a journal and year, in table order, decides that year, among rows of equal
    position the one with the least quartile; an empty quartile counts as no entry.
    """
    quartile = F.coalesce(F.col("Quartile"), F.lit(""))
    return (
        rankings.filter(F.col("Year").isNotNull())
        .groupBy(journal_key(F.col(journal), on).alias("journal"), "Year")
        .agg(F.min(F.struct("pos", quartile.alias("Quartile")))["Quartile"].alias("Quartile"))
        .filter(F.col("Quartile") != "")
    )


def effective_quartiles(
    rankings: DataFrame, lookback: int = 10, journal: str = "journal", on: str = "name"
) -> DataFrame:
    """``(journal, Year, Quartile)`` valid in each year, at most one row per journal and year.

    An entry serves its own year and the ``lookback - 1`` years after it, the most recent entry first.
    Listing the served years turns the range condition into an equality, so the article side is joined
    once, without a regrouping. All steps are combined map-side.
    """
    decided = decided_quartiles(rankings, journal, on)
    served = F.explode(F.sequence(F.col("Year"), F.col("Year") + F.lit(lookback - 1)))
    return (
        decided.select("journal", served.alias("served"), F.struct("Year", "Quartile").alias("e"))
        .groupBy("journal", "served")
        .agg(F.max("e").alias("e"))
        .select("journal", F.col("served").alias("Year"), F.col("e.Quartile").alias("Quartile"))
    )


def asof_quartiles(
    wanted: DataFrame,
    rankings: DataFrame,
    lookback: int = 10,
    journal: str = "journal",
    on: str = "name",
) -> DataFrame:
    """The same for the ``(journal, Year)`` rows of ``wanted`` alone, by merging sorted sides.

    The distinct wanted years and the entries of a journal are put in one order, and each wanted year takes
    the last entry before it. Years go in ranges of ``lookback``, which are grouped by themselves: an entry
    is in its own range and the next one, so it comes twice, whatever the look-back.
    """
    decided = decided_quartiles(rankings, journal, on)
    span = F.floor(F.col("Year") / lookback)
    entry = F.struct("Year", "Quartile")
    entries = decided.select(
        "journal", "Year", F.explode(F.array(span, span + 1)).alias("span"), entry.alias("entry")
    )
    years = wanted.where("journal is not null and Year is not null").select("journal", "Year").distinct()
    both = entries.unionByName(
        years.select("journal", "Year", span.alias("span"), F.lit(None).cast(entries.schema["entry"].dataType).alias("entry"))
    )
    # Of one year the entry goes first, so that it serves its own year.
    order = Window.partitionBy("journal", "span").orderBy("Year", F.col("entry").isNull())
    last = F.last("entry", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("last", last).where(F.col("entry").isNull())
    return found.where(F.col("Year") - F.col("last.Year") < lookback).select(
        "journal", "Year", F.col("last.Quartile").alias("Quartile")
    )


def _journal_key(on: str) -> Column:
    key = journal_key(F.coalesce(F.col(f"publisher.{on}"), F.lit("")), on)
    return F.nullif(key, F.lit("")) if on == "ISSN" else key


def enrich_quartile(
    articles: DataFrame,
    rankings: DataFrame,
    lookback: int = 10,
    on: str = "name",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Fill ``publisher.Quartile``; one row per article, ``''`` where no quartile is found.

    A quartile already present and non-empty is kept. ``on`` names the publisher field that holds
    the journal key. The quartile table is broadcast only if its measured size allows; otherwise
    the shuffle join splits hot journals adaptively (the article side is the outer side).
    """
    if lookback <= LISTED_LOOKBACK:
        quartiles = effective_quartiles(rankings, lookback, on=on)
    else:
        wanted_years = articles.select(_journal_key(on).alias("journal"), "Year")
        quartiles = asof_quartiles(wanted_years, rankings, lookback, on=on)
    stored = store(quartiles, "quartiles")
    valid = stored.joinable(broadcast_bytes).select(
        F.col("journal").alias("_journal"),
        F.col("Year").alias("_year"),
        F.col("Quartile").alias("_found"),
    )
    present = F.nullif(F.col("publisher.Quartile"), F.lit(""))
    wanted = F.when(present.isNull(), _journal_key(on))
    empty = F.struct(
        *[F.lit(None).cast("string").alias(n) for n in ("name", "ISSN", "Quartile")]
    )
    quartile = F.coalesce(present, F.col("_found"), F.lit(""))
    return (
        articles.join(
            valid, (wanted == F.col("_journal")) & (F.col("Year") == F.col("_year")), "left"
        )
        .withColumn(
            "publisher",
            F.coalesce(F.col("publisher"), empty).withField("Quartile", quartile),
        )
        .drop("_journal", "_year", "_found")
    )
