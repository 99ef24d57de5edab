"""Counts by topic, long and wide."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from pubweave.storage import store

def year_topics(articles: DataFrame) -> DataFrame:
    """Distinct ``(Year, topic)``, by year."""
    return articles.select("Year", "topic").distinct().orderBy("Year", "topic")


def year_topic_counts(articles: DataFrame) -> DataFrame:
    """Articles per year and topic: ``(Year, topic, count)``."""
    return articles.groupBy("Year", "topic").count()


def unique_names(names: Sequence[str | None], taken: Sequence[str] = ()) -> list[str]:
    """Column names for topics: a missing topic is ``null``, an empty one ``(empty)``, and a name that is
    taken, in either case, gets `` (2)``, `` (3)`` and so on."""
    used = {t.lower() for t in taken}
    made = []
    for name in names:
        base = "null" if name is None else name or "(empty)"
        unique, k = base, 1
        while unique.lower() in used:
            k += 1
            unique = f"{base} ({k})"
        used.add(unique.lower())
        made.append(unique)
    return made


#: Topics of a wide table that isn't given its topics, and topics in one row of a sparse one.
WIDE_TOPICS = 2000
SPARSE_TOPICS = 4096


@dataclass
class SparsePivot:
    """A pivot with any number of topics. ``topics`` is the stored dictionary (number, topic), in the
    order of a wide table's columns. ``cells`` has a row per row value and block of
    ``SPARSE_TOPICS`` topics: ``numbers`` and ``counts``, two arrays; what is absent is 0."""

    topics: DataFrame
    cells: DataFrame


def sparse_pivot(counts: DataFrame, row: str) -> SparsePivot:
    """The sparse form of ``(row, topic, count)``. The topics are numbered without a task that sees them all,
    and never listed on the driver; a row value's counts lie in blocks, so none of its rows is unbounded."""
    counted = store(counts.select(row, "topic", "count"), "counts").table
    ordered = counted.select("topic").distinct().repartitionByRange(F.asc_nulls_last("topic"))
    placed = ordered.sortWithinPartitions(F.asc_nulls_last("topic")).withColumn("at", F.monotonically_increasing_id())
    placed = store(placed.withColumn("part", F.shiftright("at", 33)), "topics").table
    parts = placed.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("low"))
    # A row per range of topics.
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = parts.select("part", (F.coalesce(before, F.lit(0)) - F.col("low")).alias("shift"))
    numbered = placed.join(F.broadcast(shifts), "part").select(
        (F.col("at") + F.col("shift")).alias("number"), "topic"
    )
    topics = store(numbered, "topic-numbers")
    known = topics.joinable().withColumnRenamed("topic", "_topic")
    cells = (
        counted.join(known, F.col("topic").eqNullSafe(F.col("_topic")))
        .groupBy(row, F.floor(F.col("number") / SPARSE_TOPICS).alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("number", "count"))).alias("cells"))
        .select(row, "block", F.col("cells.number").alias("numbers"), F.col("cells.count").alias("counts"))
    )
    return SparsePivot(topics.table, cells)


def long_form(pivot: SparsePivot, row: str) -> DataFrame:
    """``(row, topic, count)`` of the cells that aren't 0."""
    cell = F.explode(F.arrays_zip("numbers", "counts")).alias("cell")
    cells = pivot.cells.select(row, cell).select(row, "cell.numbers", F.col("cell.counts").alias("count"))
    return cells.join(pivot.topics, cells["numbers"] == pivot.topics["number"]).select(row, "topic", "count")


def topic_pivot(counts: DataFrame, row: str, topics: Sequence[str | None] | None = None) -> DataFrame:
    """Wide form of ``(row, topic, count)``: a column per topic in ascending order, 0 for gaps.

    The pivot runs on the already counted rows. Without ``topics`` the counts are written out once
    and the topic names, which become the column names by ``unique_names``, are read from them: at most
    ``WIDE_TOPICS``. More are an error, to name the wanted ones or use ``sparse_pivot``, which has no bound.
    """
    if topics is None:
        counts = store(counts, "counts").table
        names = counts.select("topic").distinct().orderBy(F.asc_nulls_last("topic"))
        topics = [r[0] for r in names.limit(WIDE_TOPICS + 1).collect()]
        if len(topics) > WIDE_TOPICS:
            raise ValueError(f"more than {WIDE_TOPICS} topics: name some, or use sparse_pivot")
    wide = counts.groupBy(row).pivot("topic", list(topics)).agg(F.sum("count"))
    places = [f"c{k}" for k in range(len(topics))]
    wide = wide.toDF("row", *places).select(
        "row", *[F.coalesce(p, F.lit(0)).alias(p) for p in places]
    )
    return wide.orderBy("row").toDF(row, *unique_names(topics, [row]))


def year_topic_pivot(
    articles: DataFrame, topics: Sequence[str | None] | None = None
) -> DataFrame:
    """Year × topic table of article counts."""
    return topic_pivot(year_topic_counts(articles), "Year", topics)
