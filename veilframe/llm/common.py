"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only where a local master leaves it unset (as in tests) is a temporary one made.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if found:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(found)
        return found
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="veilframe-checkpoint-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder; survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read from there: nothing then holds on to the shuffles that made it."""
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def sweep(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of finished steps now: it does so when the driver collects its garbage, which may come late."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of whatever store its path names; nothing if there is none."""
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


#: Keys that are sent to every task at most, and the rows that such a key has at least.
HOT_KEYS, HOT_ROWS = 10_000, 1_000


def with_unique(rows: DataFrame, unique: DataFrame, keys: list[str], n: str, total: int, spread: Column) -> DataFrame:
    """``rows`` with what ``unique`` has for their key; every key of ``rows`` stands there once, with the number ``n`` of its rows.

    Keys of more than one in ``HOT_KEYS`` of the ``total`` rows, so fewer than ``HOT_KEYS``, are broadcast, and
    their rows dealt by ``spread``; only the others' rows come together by key.
    """
    values = [c for c in unique.columns if c not in (*keys, n)]
    hot = unique.where(F.col(n) > max(HOT_ROWS, total // HOT_KEYS)).select(*keys, F.struct(*values).alias("__hot"))
    marked = rows.join(F.broadcast(hot), keys, "left")
    marked = marked.withColumn("__place", F.when(F.col("__hot").isNull(), F.xxhash64(*keys)).otherwise(F.xxhash64(*keys, spread)))
    common = unique.select(*keys, F.xxhash64(*keys).alias("__place"), F.struct(*values).alias("__common"))
    found = marked.join(common, [*keys, "__place"], "left").withColumn("__found", F.coalesce("__hot", "__common"))
    return found.select(*rows.columns, *[F.col(f"__found.{v}").alias(v) for v in values])


def held_out(doc_id: str, mod: int, rest: int):
    """crc32 of the id as text, modulo ``mod``, equals ``rest``. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % mod == rest


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
