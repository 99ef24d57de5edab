"""Adding a crawl to the collection: which records are new, and one record per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pubweave.storage import BROADCAST_BYTES, store


def new_only(
    new: DataFrame,
    existing: DataFrame,
    key: str = "doi",
    null_safe: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Records of ``new`` whose key is not in ``existing``; duplicates within ``new`` stay.

    A record without a key is always new, or, with ``null_safe``, new only if no stored record
    lacks the key. The distinct new keys are written once and measured; the stored keys are only
    compared with them, so the work on the stored set is one scan of its keys, broadcast against if
    the new keys are few. Otherwise both sides are shuffled, and a key (or NULL) with very many
    records is split by adaptive execution: it is the outer side, and the other has each key once.
    """
    wanted = new.select(F.col(key).alias("_wanted")).distinct()
    stored_keys = existing.select(F.col(key).alias("_known"))
    if not null_safe:
        wanted = wanted.filter(F.col("_wanted").isNotNull())
        stored_keys = stored_keys.filter(F.col("_known").isNotNull())
    wanted = store(wanted, "new-keys")

    def same(a: Column, b: Column) -> Column:
        return a.eqNullSafe(b) if null_safe else a == b

    few = wanted.joinable(broadcast_bytes)
    met = stored_keys.join(few, same(F.col("_known"), F.col("_wanted")), "left_semi").distinct()
    # At most the new keys, so their measured size bounds this side too: few are broadcast as they are.
    if wanted.size <= broadcast_bytes:
        known = F.broadcast(met)
    else:
        known = store(met, "known-keys").joinable(broadcast_bytes)
    return new.join(known, same(new[key], known["_known"]), "left_anti")


def union_all(*sources: DataFrame) -> DataFrame:
    """All rows of sources whose columns may differ; absent columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def merge_articles(
    existing: DataFrame,
    new: DataFrame,
    key: str = "doi",
    order: str = "seq",
    keep_unkeyed: bool = False,
) -> DataFrame:
    """One record per key: the last one wins, ``new`` counting as later than ``existing``.

    ``order`` is the position within each input. The result keeps the winner's columns and adds
    ``first_position``, a sortable (batch, position) of the key's first record: the winner stands
    where its key appeared first. Records without a key count as one key, or with ``keep_unkeyed``
    each stays.

    Winner and first position come from one aggregation, combined map-side, so the many copies
    of a hot key shrink to one row per task before the shuffle.
    """
    batches = union_all(
        existing.withColumn("_batch", F.lit(0)), new.withColumn("_batch", F.lit(1))
    )
    columns = [c for c in batches.columns if c != "_batch"]
    position = F.struct(F.col("_batch").alias("batch"), F.col(order).alias("position"))
    placed = batches.select(
        F.col(key).alias("_key"), position.alias("_position"), F.struct(*columns).alias("_record")
    )
    keyed = placed.filter(F.col("_key").isNotNull()) if keep_unkeyed else placed
    merged = (
        keyed.groupBy("_key")
        .agg(
            F.max_by("_record", "_position").alias("_record"),
            F.min("_position").alias("first_position"),
        )
        .select("_record.*", "first_position")
    )
    if not keep_unkeyed:
        return merged
    unkeyed = placed.filter(F.col("_key").isNull())
    return merged.unionByName(
        unkeyed.select("_record.*", F.col("_position").alias("first_position"))
    )


def ingest_report(existing: DataFrame, new: DataFrame, key: str = "doi") -> DataFrame:
    """One row ``(found, inserted, total)``: records crawled, records with an unknown key, and
    distinct keys after the merge. One pass over the keys, one combined aggregation."""
    keys = existing.select(F.col(key).alias("_key"), F.lit(0).alias("_found")).unionAll(
        new.select(F.col(key), F.lit(1))
    )
    per_key = keys.groupBy("_key").agg(
        F.sum("_found").alias("found"), F.count(F.lit(1)).alias("records")
    )
    unknown = F.when(F.col("records") == F.col("found"), F.col("found")).otherwise(F.lit(0))
    counts = {"found": F.sum("found"), "inserted": F.sum(unknown), "total": F.count(F.lit(1))}
    return per_key.agg(
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(n) for n, c in counts.items()]
    )
