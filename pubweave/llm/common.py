"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import pubweave
from pubweave import storage

#: Spark's setting to delete the shuffle files of an execution when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: The six ASCII separators between words, as a regular-expression class.
SEPARATORS = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (column names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def column(name: str) -> Column:
    """A column by its whole name, also with dots or backticks in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def columns(df: DataFrame) -> list[Column]:
    return [column(c) for c in df.columns]


def tasks_for(df: DataFrame, total: int, each: int) -> int:
    """How many groups make ``total`` units into groups of about ``each``; at least one a core."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-total // each), 1)


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once a session: executors need not have it installed.

    Spark serves the archive itself; no shared folder is needed.
    """
    context = spark.sparkContext
    if getattr(context, "_pubweave_shipped", False):
        return
    root = Path(pubweave.__file__).parent if pubweave.__file__ else Path(pubweave.__path__[0])
    archive = Path(tempfile.mkdtemp(prefix="pubweave-")) / "pubweave.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for file in sorted(root.rglob("*.py")):
            packed.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._pubweave_shipped = True


def store(df: DataFrame, label: str) -> storage.Stored:
    """``df`` written below the checkpoint folder, without the shuffle files that it took.

    Later steps read the written table, so these files are of no use any more, and a job of many steps
    would otherwise hold those of all its steps at once.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        return storage.store(df, label)
    finally:
        conf.set(_CLEANUP, before)
