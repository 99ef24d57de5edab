"""A Bloom index beside an appended set: which of its files may hold a key.

For each file of the set the index keeps the bits of its keys, in blocks of ``BLOCK_BITS``; a key sets
``PROBES`` bits of one block of its file. How many blocks a file has follows from its number of keys, as a
power of two, so that a block has about ``BITS_PER_KEY`` bits per key. The bits are made by Spark's bitmap
aggregates; a task makes those of whole blocks, of about ``TASK_KEYS`` keys in all, because their rows are
sorted in it. A few keys are then looked up in the blocks they fall into, and only files
in which all bits of some key are set are read for the exact comparison. A file without an index entry is
always read. So no record is lost or found in excess; the index only saves reading.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pubweave.storage import path_exists, store

BLOCK_BITS = 32768
BITS_PER_KEY = 16
PROBES = 5
#: Keys whose bits one task sets; it sorts ``PROBES`` rows for each.
TASK_KEYS = 500_000
#: Hidden from readers of the set by its underscore.
_INDEX = "_bloom"
_SCHEMA = "file string, blocks int, block int, bits binary"


def _hash(key: Column, seed: int) -> Column:
    """Null is a key like any other."""
    return F.xxhash64(F.coalesce(F.xxhash64(key), F.lit(0)), key.isNull(), F.lit(seed))


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(_hash(key, 0), blocks).cast("int")


def _probes(key: Column) -> Column:
    return F.array(*[F.pmod(_hash(key, k + 1), F.lit(BLOCK_BITS)) for k in range(PROBES)])


def _named(file: Column) -> Column:
    """One spelling of a file's address."""
    return F.regexp_replace(file, "^([a-zA-Z0-9]+):/+", "$1:/")


def _files(spark: SparkSession, path: str) -> DataFrame:
    """``file`` of the data files; the listing of Spark's own scan, escaped as in an address."""
    listed = spark.createDataFrame([(f,) for f in spark.read.parquet(path).inputFiles()], "file string")
    return listed.select(_named(F.col("file")).alias("file"))


def _indexed(spark: SparkSession, path: str) -> DataFrame:
    where = f"{path}/{_INDEX}"
    if not path_exists(spark, where):
        return spark.createDataFrame([], _SCHEMA)
    return spark.read.schema(_SCHEMA).parquet(where)


def index_files(spark: SparkSession, path: str, schema: T.StructType, key: str = "doi") -> int:
    """Index the files that the index lacks; how many there were."""
    if not path_exists(spark, path):
        return 0
    known = _indexed(spark, path).select("file").distinct()
    missing = [unquote(r[0]) for r in _files(spark, path).join(known, "file", "left_anti").collect()]
    if not missing:
        return 0
    keys = spark.read.schema(schema).parquet(*missing).select(
        _named(F.col("_metadata.file_path")).alias("file"), F.col(f"`{key}`").alias("key")
    )
    wanted = F.ceil(F.count(F.lit(1)) * BITS_PER_KEY / BLOCK_BITS)
    sizes = store(
        keys.groupBy("file")
        .agg(
            F.pow(F.lit(2), F.ceil(F.log2(wanted))).cast("int").alias("blocks"),
            F.count(F.lit(1)).alias("keys"),
        )
        .withColumn("number", F.monotonically_increasing_id()),
        "bloom-sizes",
    )
    total = sizes.table.agg(F.sum("keys")).first()[0] or 0
    # Numbers stand for the files in what is shuffled and sorted. Copies of a key go before its block becomes a
    # task's.
    placed = keys.join(sizes.joinable(), "file").select(
        "number", _block(F.col("key"), F.col("blocks")).alias("block"), _probes(F.col("key")).alias("probes")
    )
    dealt = placed.distinct().repartition(max(1, -(-total // TASK_KEYS)), "number", "block")
    bits = (
        dealt.select("number", "block", F.explode("probes").alias("bit"))
        .groupBy("number", "block")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .join(F.broadcast(sizes.table.select("number", "file", "blocks")), "number")
        .select("file", "blocks", "block", "bits")
    )
    bits.write.mode("append").parquet(f"{path}/{_INDEX}")
    return len(missing)


def _is_set(bits: Column, bit: Column) -> Column:
    octet = F.conv(F.hex(F.substring(bits, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(octet, (bit % 8).cast("int")) == 1


def files_with(keys: DataFrame, path: str, key: str = "doi") -> list[str]:
    """The files under ``path`` that may hold one of the keys, and all that aren't indexed."""
    spark = keys.sparkSession
    if not path_exists(spark, path):
        return []
    index = _indexed(spark, path)
    known = index.select("file", "blocks").distinct()
    sizes = index.select("blocks").distinct()
    wanted = keys.select(F.col(f"`{key}`").alias("key")).distinct()
    # A few sizes, all of them powers of two.
    probes = wanted.crossJoin(F.broadcast(sizes)).select(
        "blocks", _block(F.col("key"), F.col("blocks")).alias("block"), _probes(F.col("key")).alias("probes")
    )
    met = index.join(probes, ["blocks", "block"])
    hit = met.where(F.forall("probes", lambda b: _is_set(F.col("bits"), b))).select("file").distinct()
    ruled_out = known.select("file").join(hit, "file", "left_anti")
    return [unquote(r[0]) for r in _files(spark, path).join(ruled_out, "file", "left_anti").collect()]


def read_files_of(new: DataFrame, path: str, schema: T.StructType, key: str = "doi") -> DataFrame:
    """The stored records in files that may hold a key of ``new``, the null key included."""
    spark = new.sparkSession
    files = files_with(new, path, key)
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files).select(*[F.col(f"`{n}`") for n in schema.names])
