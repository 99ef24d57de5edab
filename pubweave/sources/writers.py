"""Writing article collections and result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pubweave.storage import child_names, path_exists

_VERSION = "version="
# Quotes are doubled, blanks stay, and a missing value (nothing) differs from an empty text ("").
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "",
    "emptyValue": '""',
}


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """A result table as CSV with a header row.

    ``single_file`` is for tables whose size is bounded by their definition (a top-k, a pivot):
    one task writes it. A keyword table is not bounded; its sorted part files keep the order.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_records(df: DataFrame, path: str, as_array: bool = False) -> None:
    """A result table as JSON records, one object per line.

    ``as_array`` writes one array in one file instead, for tables whose size is bounded by their definition
    (a top-k, a pivot); missing values are ``null`` there. Its order is that of ``df``.
    """
    if not as_array:
        df.write.mode("overwrite").json(path)
        return
    record = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    array = df.select(record.alias("r")).coalesce(1).agg(F.collect_list("r").alias("r"))
    text = F.to_json("r", {"ignoreNullFields": "false"})
    array.select(text.alias("value")).write.mode("overwrite").text(path)


def append_articles(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    partition_by: str | None = "topic",
    options: dict[str, str] | None = None,
) -> None:
    """Add records to a stored set, creating it if needed.

    ``partition_by`` stays a column of the files, because folder names can't tell an empty text from
    a missing one; the folders are named by a copy of it. The rebalance groups rows by partition
    value for few, large files, and splits a value that holds a large share of the rows over several
    tasks.
    """
    if partition_by is None:
        df.write.mode("append").format(format).options(**(options or {})).save(path)
        return
    folder = f"by_{partition_by}"
    out = df.withColumn(folder, F.col(partition_by)).hint("rebalance", folder)
    out.write.mode("append").format(format).options(**(options or {})).partitionBy(folder).save(path)


def _complete_versions(spark: SparkSession, root: str) -> list[int]:
    names = [n for n in child_names(spark, root) if n.startswith(_VERSION)]
    return sorted(
        int(n.removeprefix(_VERSION)) for n in names if path_exists(spark, f"{root}/{n}/_SUCCESS")
    )


def current_version(spark: SparkSession, root: str) -> str | None:
    """Path of the newest complete version below ``root``; NULL if there is none."""
    versions = _complete_versions(spark, root)
    return f"{root}/{_VERSION}{versions[-1]}" if versions else None


def rewrite_articles(df: DataFrame, root: str, format: str = "parquet") -> str:
    """Write the whole set as a new version below ``root`` and return its path.

    ``df`` may read the current version, which stays untouched. A version counts only once its
    success marker is there, so a failed job leaves the previous one current.
    """
    spark = df.sparkSession
    taken = [
        int(n.removeprefix(_VERSION))
        for n in child_names(spark, root)
        if n.startswith(_VERSION)
    ]
    path = f"{root}/{_VERSION}{max(taken, default=0) + 1}"
    df.write.mode("errorifexists").format(format).save(path)
    return path
