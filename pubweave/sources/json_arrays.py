"""Reading large files that each hold one JSON array of objects, or one object, by many tasks.

A file is cut at every ``}``, by Spark's own splitting of text, so a file of any size is read by many tasks.
Which of the cuts end a record is only known from what stands before them: whether the place is inside of
a string, and how deep. Each piece is therefore summed up first (its quotes, and its depth for either case),
the sums of whole blocks of a file are added up in their order, and then the pieces of each block, each by
itself, know their state. Pieces between two ends are a record; one that crosses blocks is put together in
the same way as any other.

Records come without order, as from any read. A text that isn't valid JSON becomes a row of NULLs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from pubweave.storage import store

_FILE = ["file", "block"]


def _outside(text: Column, inside: bool) -> Column:
    """What of a text without escapes stands outside of strings, if it starts inside of one or not."""
    own = F.regexp_replace(text, '^[^"]*"?', "") if inside else text
    return F.regexp_replace(own, '"[^"]*("|$)', "")


def _depth(text: Column) -> Column:
    """How much deeper it is at the end of a text."""
    opened = F.length(text) - F.length(F.translate(text, "{[", ""))
    closed = F.length(text) - F.length(F.translate(text, "}]", ""))
    return opened - closed


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``block``, ``k``, ``text``, and what a piece with its ``}`` does: ``quotes``, whether it turns
    inside to outside, and the change of depth if it starts ``outside`` or ``inside`` of a string."""
    read = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("k"),
        F.col("value").alias("text"),
    )
    plain = F.regexp_replace("text", r"(?s)\\.", "")
    quotes = (F.length(plain) - F.length(F.translate(plain, '"', ""))) % 2
    # The cut is a closing one if the piece ends outside of a string. After the last one there is none;
    # there a depth too low does no harm.
    return read.withColumn("quotes", quotes).select(
        *_FILE,
        "k",
        "text",
        "quotes",
        (_depth(_outside(plain, False)) - F.when(F.col("quotes") == 0, 1).otherwise(0)).alias("outside"),
        (_depth(_outside(plain, True)) - F.when(F.col("quotes") == 1, 1).otherwise(0)).alias("inside"),
    )


def _before(column: str, order: str, *by: str) -> Column:
    window = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(window), F.lit(0))


def read_json_arrays(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The objects of all files under ``path``, each an array of objects or one object, by ``schema``."""
    pieces = store(_pieces(spark, path), "json-pieces").table
    parity = pieces.withColumn("inside_now", _before("quotes", "k", *_FILE) % 2)

    # A block's sums, for either state at its start, and then its state from the blocks before it.
    starts_inside = {s: (F.col("inside_now") + s) % 2 == 1 for s in (0, 1)}
    change = {s: F.when(c, F.col("inside")).otherwise(F.col("outside")) for s, c in starts_inside.items()}
    blocks = parity.groupBy(*_FILE).agg(
        (F.sum("quotes") % 2).alias("quotes"),
        *[F.sum(change[s]).alias(f"depth{s}") for s in (0, 1)],
        F.min(F.struct("k", F.regexp_extract("text", r"^\s*(\S)", 1).alias("c"))).alias("first"),
    )
    state = (
        blocks.withColumn("state", (_before("quotes", "block", "file") % 2).cast("int"))
        .withColumn("depth", F.when(F.col("state") == 1, F.col("depth1")).otherwise(F.col("depth0")))
        .withColumn("start", _before("depth", "block", "file"))
        .withColumn("base", F.first(F.col("first.c")).over(Window.partitionBy("file").orderBy("block")))
        .select(*_FILE, "state", "start", F.when(F.col("base") == "[", 1).otherwise(0).alias("level"))
    )
    # One row per block.
    state = store(state, "json-blocks").joinable()
    known = parity.join(state, _FILE)
    own = (F.col("inside_now") + F.col("state")) % 2 == 1
    changed = known.withColumn("change", F.when(own, F.col("inside")).otherwise(F.col("outside")))
    ends_outside = (F.col("inside_now") + F.col("state") + F.col("quotes")) % 2 == 0
    depth = F.col("start") + _before("change", "k", *_FILE) + F.col("change")
    ended = changed.withColumn("ends", (ends_outside & (depth == F.col("level"))).cast("int"))
    ended = ended.withColumn("record", _before("ends", "k", *_FILE))
    counts = ended.groupBy(*_FILE).agg(F.sum("ends").alias("n"))
    numbers = store(counts.select(*_FILE, _before("n", "block", "file").alias("shift")), "json-records").joinable()
    placed = ended.join(numbers, _FILE).withColumn("record", F.col("record") + F.col("shift"))
    records = placed.groupBy("file", "record").agg(
        F.max("ends").alias("whole"),
        F.array_join(F.sort_array(F.collect_list(F.struct("block", "k", "text")))["text"], "}").alias("text"),
    )
    # What follows the last end of a file is no record.
    text = F.concat(F.regexp_replace("text", r"^[\s\[,]+", ""), F.lit("}"))
    return records.where("whole = 1").select(F.from_json(text, schema).alias("r")).select("r.*")
