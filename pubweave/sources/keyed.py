"""A set of records with one record per key, in buckets by the hash of the key.

An upsert reads and rewrites only the buckets that the new keys fall into; all other files stay as they
are. A manifest names the folder of each bucket. It is written last, as a new version that counts once it is
complete, so a run that fails leaves the set as it was, and readers of the old version keep its files until
``vacuum``. One writer at a time: a version that exists already is an error.

The driver sees the names of buckets and their folders, at most as many as there are buckets.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pubweave.operators.ingest import merge_articles
from pubweave.storage import child_names, discard, path_exists, store

BUCKETS = 256
_MANIFESTS = "manifests"
_DATA = "data"
_VERSION = "version="
_BUCKET = "bucket"


_ROWS = "buckets int, bucket int, folder string, records long"


@dataclass(frozen=True)
class Manifest:
    """``folders`` and ``records``, the number of them, by bucket."""

    version: int
    buckets: int
    folders: dict[int, str]
    records: dict[int, int]

    @property
    def total(self) -> int:
        return sum(self.records.values())


@dataclass(frozen=True)
class Upserted:
    """The buckets that were rewritten, and the records of the set before and after."""

    touched: list[int]
    before: int
    after: int


def current_manifest(spark: SparkSession, root: str) -> Manifest | None:
    """The newest complete manifest; NULL if there is none."""
    names = [n for n in child_names(spark, f"{root}/{_MANIFESTS}") if n.startswith(_VERSION)]
    for version in sorted((int(n.removeprefix(_VERSION)) for n in names), reverse=True):
        path = f"{root}/{_MANIFESTS}/{_VERSION}{version}"
        if path_exists(spark, f"{path}/_SUCCESS"):
            rows = spark.read.schema(_ROWS).json(path).collect()
            known = [r for r in rows if r.bucket is not None]
            folders, records = {r.bucket: r.folder for r in known}, {r.bucket: r.records for r in known}
            return Manifest(version, rows[0].buckets, folders, records)
    return None


def _write_manifest(spark: SparkSession, root: str, manifest: Manifest) -> None:
    rows = [(manifest.buckets, b, f, manifest.records[b]) for b, f in sorted(manifest.folders.items())]
    table = spark.createDataFrame(rows or [(manifest.buckets, None, None, None)], _ROWS).coalesce(1)
    table.write.mode("errorifexists").json(f"{root}/{_MANIFESTS}/{_VERSION}{manifest.version}")


def _folders(root: str, manifest: Manifest, wanted: list[int]) -> list[str]:
    return [f"{root}/{_DATA}/{manifest.folders[b]}" for b in wanted if b in manifest.folders]


def _read(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths).select(*[F.col(f"`{n}`") for n in schema.names])


def read_keyed(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The records of the newest version; an absent set is empty."""
    manifest = current_manifest(spark, root)
    return _read(spark, _folders(root, manifest, list(manifest.folders)) if manifest else [], schema)


def _bucket_of(key: Column, record: Column, buckets: int, keep_unkeyed: bool) -> Column:
    """Records without a key lie by what they hold if each of them stays, else together."""
    lacking = F.xxhash64(F.to_json(record)) if keep_unkeyed else F.lit(0).cast("long")
    hashed = F.when(key.isNull(), lacking).otherwise(F.xxhash64(key))
    return F.pmod(hashed, F.lit(buckets)).cast("int")


def read_buckets_of(
    new: DataFrame, root: str, schema: T.StructType, key: str = "doi"
) -> DataFrame:
    """The stored records in the buckets of the keys of ``new``: all that can have one of these keys."""
    spark = new.sparkSession
    manifest = current_manifest(spark, root)
    if manifest is None:
        return _read(spark, [], schema)
    place = _bucket_of(F.col(key), F.struct(key), manifest.buckets, False)
    touched = new.where(F.col(key).isNotNull()).select(place.alias(_BUCKET)).distinct().collect()
    return _read(spark, _folders(root, manifest, sorted(r[0] for r in touched)), schema)


def upsert(
    new: DataFrame,
    root: str,
    schema: T.StructType,
    key: str = "doi",
    order: str = "seq",
    keep_unkeyed: bool = False,
    buckets: int = BUCKETS,
) -> Upserted:
    """Merge ``new`` into the set under ``root``, the last record of a key winning by ``order``.

    The counts come from what was written, so a retried task counts once. ``order`` need not be a column of the set. ``buckets`` counts for a new set only. Records without a key
    count as one key, or with ``keep_unkeyed`` each stays.
    """
    spark = new.sparkSession
    manifest = current_manifest(spark, root)
    version = _last_version(spark, root) + 1
    count = manifest.buckets if manifest else buckets
    record = F.struct(*[F.col(f"`{n}`") for n in schema.names])
    own = [F.col(f"`{n}`") for n in schema.names]
    place = _bucket_of(F.col(f"`{key}`"), record, count, keep_unkeyed).alias(_BUCKET)
    incoming = store(new.select(record.alias("record"), F.col(order).alias("order"), place), "incoming")
    touched = sorted(r[0] for r in incoming.table.select(_BUCKET).distinct().collect())
    kept, records = (manifest.folders, manifest.records) if manifest else ({}, {})
    if touched:
        known = _read(spark, _folders(root, manifest, touched) if manifest else [], schema)
        no_order = F.lit(None).cast(incoming.table.schema["order"].dataType)
        merged = merge_articles(
            known.select(F.col(f"`{key}`").alias("key"), record.alias("record"), no_order.alias("order")),
            incoming.table.select(F.col(f"record.`{key}`").alias("key"), "record", "order"),
            key="key",
            order="order",
            keep_unkeyed=keep_unkeyed,
        )
        folder, name = f"{version:08d}-{uuid.uuid4().hex}", _BUCKET
        while name in {n.lower() for n in schema.names}:
            name += "_"
        written = merged.select("record.*").select(*own, place.alias(name)).hint("rebalance", name)
        written.write.partitionBy(name).parquet(f"{root}/{_DATA}/{folder}")
        kept = kept | {b: f"{folder}/{name}={b}" for b in touched}
        stored = spark.read.schema(T.StructType([T.StructField(name, T.IntegerType())]))
        counts = stored.parquet(f"{root}/{_DATA}/{folder}").groupBy(name).count().collect()
        records = records | {r[0]: r[1] for r in counts}
    made = Manifest(version, count, kept, records)
    _write_manifest(spark, root, made)
    discard(spark, incoming.path)
    return Upserted(touched, manifest.total if manifest else 0, made.total)


def _last_version(spark: SparkSession, root: str) -> int:
    names = [n for n in child_names(spark, f"{root}/{_MANIFESTS}") if n.startswith(_VERSION)]
    return max((int(n.removeprefix(_VERSION)) for n in names), default=0)


def vacuum(spark: SparkSession, root: str) -> list[str]:
    """Delete the folders of versions of which the newest manifest uses no bucket; their names."""
    manifest = current_manifest(spark, root)
    if manifest is None:
        return []
    used = {f.split("/")[0] for f in manifest.folders.values()}
    unused = [n for n in child_names(spark, f"{root}/{_DATA}") if n not in used]
    for name in unused:
        discard(spark, f"{root}/{_DATA}/{name}")
    return unused
