"""Cutting lineage, measuring small tables and looking at paths.

Intermediate results that must outlive an executor go to the checkpoint folder of the session,
which on a cluster is a shared folder. A folder of our own is chosen only for a local master.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.storagelevel import StorageLevel

BROADCAST_BYTES = 64 * 1024 * 1024
PARTITION_BYTES = 128 * 1024 * 1024
_ROW_OVERHEAD = 48
_VALUE_BYTES = 16


def checkpoint_root(spark: SparkSession) -> str:
    """The checkpoint folder of the session, set up if the context has none yet."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError(
                "spark.checkpoint.dir is not set: name a folder that all executors share"
            )
        folder = tempfile.mkdtemp(prefix="pubweave-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def work_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the checkpoint folder."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _row_bytes(schema: T.StructType) -> Column:
    """Estimated bytes of a row in memory: text lengths plus a charge per value."""
    total = F.lit(_ROW_OVERHEAD + _VALUE_BYTES * len(schema.fields)).cast("bigint")
    for field in schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            total = total + F.coalesce(F.octet_length(column), F.lit(0))
        elif field.dataType == T.ArrayType(T.StringType()):
            text = F.octet_length(F.array_join(column, "")) + F.size(column) * _VALUE_BYTES
            total = total + F.coalesce(text, F.lit(0))
    return total


@dataclass
class Stored:
    """A stored table and where it lies."""

    table: DataFrame
    path: str

    @cached_property
    def size(self) -> int:
        """Estimated bytes in memory, from one aggregation over the stored table."""
        total = F.coalesce(F.sum(_row_bytes(self.table.schema)), F.lit(0))
        return int(self.table.agg(total).first()[0])

    def joinable(self, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """The table, with a broadcast hint only if its measured size allows.

        Beyond the limit the join stays a shuffle join, in which adaptive execution splits hot
        keys: it can, because this side is a plain scan.
        """
        return F.broadcast(self.table) if self.size <= broadcast_bytes else self.table


def store(df: DataFrame, label: str) -> Stored:
    """Compute ``df`` once into a parquet table below the checkpoint folder.

    The table cuts the lineage, and later readers still prune columns.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return Stored(spark.read.schema(df.schema).parquet(path), path)


def spread(scan: DataFrame) -> DataFrame:
    """A scan with fewer splits than cores, spread over all cores.

    For row work that is heavy on the processor, such as pages. A scan of many splits, that is any
    large one, stays as it is. Use it on plain scans: asking a plan with shuffles for its
    partitions would run them.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def path_exists(spark: SparkSession, path: str) -> bool:
    target, fs = _hadoop_path(spark, path)
    return fs.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty if it is absent."""
    target, fs = _hadoop_path(spark, path)
    if not fs.exists(target):
        return []
    return [status.getPath().getName() for status in fs.listStatus(target)]


def bucket_count(spark: SparkSession, size_bytes: int) -> int:
    """Buckets of about ``PARTITION_BYTES``, at least one per core that can work at a time."""
    wanted = -(-size_bytes // PARTITION_BYTES)
    return max(1, min(max(wanted, spark.sparkContext.defaultParallelism), 100_000))


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table of our own that nothing reads any more."""
    target, fs = _hadoop_path(spark, path)
    fs.delete(target, True)


@contextmanager
def kept(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` written and cached for repeated reads; both copies go when the block ends.

    A lost executor costs only a re-read of the written table.
    """
    stored = store(df, label)
    cached = stored.table.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield cached
    finally:
        cached.unpersist()
        discard(df.sparkSession, stored.path)


@contextmanager
def shuffle_partitions(spark: SparkSession, count: int) -> Iterator[None]:
    """Shuffles of the block make ``count`` partitions, so that their results meet tables of as many
    buckets without another shuffle."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(count))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@dataclass
class Bucketed:
    """A stored table in ``buckets`` by ``key``."""

    table: DataFrame
    key: str
    buckets: int
    name: str
    path: str

    def discard(self) -> None:
        self.unlist()
        discard(self.table.sparkSession, self.path)

    def unlist(self) -> DataFrame:
        """Take the table out of the catalog; its files as a plain table."""
        spark, schema = self.table.sparkSession, self.table.schema
        spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        return spark.read.schema(schema).parquet(self.path)


def store_bucketed(df: DataFrame, key: str, buckets: int) -> Bucketed:
    """Write ``df``, whose partitions are already dealt by the hash of ``key`` into as many as there are
    buckets: a file each. Joins and groups by ``key`` then need no shuffle of the table."""
    spark = df.sparkSession
    name = f"pubweave_{uuid.uuid4().hex}"
    path = work_path(spark, name)
    df.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return Bucketed(spark.table(name), key, buckets, name, path)


@dataclass
class Dealt:
    """A table in buckets by a key, but for the rows of its hot keys, which lie apart.

    A key is hot if it has more rows than a bucket should have. So there are fewer hot keys than buckets,
    and what a join needs of the other side for them can be broadcast, whatever the table's size.
    """

    cold: Bucketed
    hot: Stored | None
    hot_keys: Stored | None

    def join(self, other: DataFrame) -> DataFrame:
        """Inner join with a table of one row per key, which stays in place if it lies in as many
        partitions by the key."""
        key = self.cold.key
        # Without the hint a side that is small enough would be broadcast, and that in each of many rounds.
        joined = self.cold.table.join(other.hint("shuffle_hash"), key)
        if self.hot is None:
            return joined
        few = F.broadcast(other.join(F.broadcast(self.hot_keys.table), key, "left_semi"))
        return joined.unionByName(self.hot.table.join(few, key))

    def discard(self) -> None:
        self.cold.discard()
        for part in (self.hot, self.hot_keys):
            if part is not None:
                discard(part.table.sparkSession, part.path)


def deal(df: DataFrame, key: str, buckets: int) -> Dealt:
    """``df``, a stored table, in buckets by ``key``, hot keys apart."""
    total = df.count()
    counts = df.groupBy(key).count().filter(F.col("count") > total / buckets)
    hot_keys = store(counts.select(key), "hot-keys")
    if hot_keys.table.isEmpty():
        discard(df.sparkSession, hot_keys.path)
        return Dealt(store_bucketed(df.repartition(buckets, key), key, buckets), None, None)
    few = F.broadcast(hot_keys.table)
    cold = df.join(few, key, "left_anti").repartition(buckets, key)
    return Dealt(
        store_bucketed(cold, key, buckets), store(df.join(few, key, "left_semi"), "hot"), hot_keys
    )


@contextmanager
def bucketed_by(df: DataFrame, key: str, size_bytes: int) -> Iterator[DataFrame]:
    """Like ``kept``, but bucketed and sorted by ``key``.

    Windowing by ``key`` then needs neither a shuffle nor a sort, round after round. Only for a
    key whose groups are bounded: a bucket is one task.
    """
    spark = df.sparkSession
    buckets = bucket_count(spark, size_bytes)
    name = f"pubweave_{uuid.uuid4().hex}"
    path = work_path(spark, name)
    (
        df.repartition(buckets, key)
        .write.bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(name)
    )
    cached = spark.table(name).sortWithinPartitions(key).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield cached
    finally:
        cached.unpersist()
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        discard(spark, path)
