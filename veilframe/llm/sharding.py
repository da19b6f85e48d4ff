"""Rendezvous (highest random weight) sharding, with DataFrame functions alone.

Each record key is hashed together with each shard number; the shard of the best score gets the record.
A shard more can only win records for itself, a shard fewer only frees its own, and a weight changed
moves records to or from that shard alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.llm.common import cut

#: Slots of a shard are numbered in so many parts, so that no task numbers a whole shard.
SLOT_PARTS = 1024


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The number of the shard, of ``len(weights)``, that wins ``key``; a shard without weight wins nothing.

    Score: -ln(u) / weight with u uniform from the 53 upper bits of ``xxhash64(key, shard)``, least
    first. Where all weights are equal that is the largest hash, compared as an integer. Ties go to the lower shard.
    """
    live = [(s, w) for s, w in enumerate(weights) if w > 0]
    if not live:
        raise ValueError("no shard has a weight")
    upper = lambda s: F.shiftrightunsigned(F.xxhash64(key, F.lit(s).cast("long")), 11)
    if len(live) == 1:
        return F.lit(live[0][0])
    if len({w for _, w in live}) == 1:
        best = F.greatest(*[F.struct(upper(s).alias("h"), F.lit(-s).alias("s")) for s, _ in live])
        return -best["s"]
    best = F.least(*[F.struct((-F.ln((upper(s) + 0.5) / F.lit(float(1 << 53))) / w).alias("h"), F.lit(s).alias("s")) for s, w in live])
    return best["s"]


def record_key(id_col: str, text_col: str) -> Column:
    """What decides a record's shard: its id or, without one, its text's checksum and size."""
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return F.when(F.col(id_col).isNotNull(), F.xxhash64(id_col)).otherwise(F.xxhash64(F.crc32(raw), (F.octet_length(raw) + 16).cast("long")))


def assign_shards(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, size, text_crc32, law, shard, slot, grown_shard`` of every row; slots are gapless from 0 in each shard.

    The id and the weights alone decide the shard (rows without an id: their checksum and size), so
    repeated rows share one. Size: the text's UTF-8 bytes and 16 more; a null text counts as empty,
    with checksum 0. Ties in the numbering are equal rows. An empty table gives an empty result;
    other columns are not looked at.
    """
    bytes_ = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col), record_key(id_col, text_col).alias("key"), (F.octet_length(bytes_) + 16).cast("long").alias("size"), F.crc32(bytes_).alias("text_crc32"))
    rows = rows.select("*", rendezvous(F.col("key"), weights).cast("int").alias("shard"), (rendezvous(F.col("key"), grown) if grown else F.lit(None)).cast("int").alias("grown_shard"))
    rows = cut(rows.withColumn("slot_part", F.pmod(F.xxhash64("key", "text_crc32", "size"), F.lit(SLOT_PARTS)).cast("int")).drop("key"))
    before = Window.partitionBy("shard").orderBy("slot_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("shard", "slot_part").count().withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    within = Window.partitionBy("shard", "slot_part").orderBy(id_col, "size", "text_crc32")
    numbered = rows.withColumn("no", F.row_number().over(within)).join(parts.drop("count"), ["shard", "slot_part"])
    slot = (F.col("before") + F.col("no") - 1).cast("long").alias("slot")
    return numbered.select(id_col, "size", "text_crc32", F.lit("key").alias("law"), "shard", slot, "grown_shard")


def write_shards(docs: DataFrame, weights: Sequence[float], path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the rows with all their columns as one Parquet folder for each shard (``shard=N``).

    The shards are those of ``assign_shards``, for rows without an id too. A ``shard`` column of the input is replaced.
    """
    docs.withColumn("shard", rendezvous(record_key(id_col, text_col), weights)).write.partitionBy("shard").parquet(path)
