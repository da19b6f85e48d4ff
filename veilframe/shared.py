"""Where and how intermediate results are kept."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilframe.functions.values import is_missing


def scratch(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, set as Spark's own; only a local master may leave that unset."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="veilframe-checkpoint-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """A checkpoint in the shared folder; survives lost executors."""
    scratch(df.sparkSession)
    return df.checkpoint()


def numbered(df: DataFrame, order: list[str], name: str, first: int = 1) -> DataFrame:
    """Rows numbered from ``first`` in the order of ``order``, without bringing them into one task.

    Rows are dealt by range and sorted; each range's numbers start where the ranges before it end. The
    ranges are checkpointed, so that they are the same whenever they are read.
    """
    dealt = cut(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))
    counts = dealt.groupBy("__range").count()
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))  # a row for each range
    within = Window.partitionBy("__range").orderBy(*order)
    ranked = dealt.withColumn("__no", F.row_number().over(within)).join(F.broadcast(starts), "__range")
    return ranked.withColumn(name, F.col("__start") + F.col("__no") - 1 + first).drop("__range", "__start", "__no")


#: Keys that are sent to every task at most, and the rows that such a key has at least.
HOT_KEYS, HOT_ROWS = 10_000, 1_000


def looked_up(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """``df`` left-joined with ``mapping(__from, __to, __n)``, where ``__n`` says how many rows have the value.

    Values of more than one in ``HOT_KEYS`` of these rows, so fewer than ``HOT_KEYS`` of them, are broadcast, and their rows
    dealt by all columns, as those of missing values are; only rows of other values come together by value.
    """
    mapping = cut(mapping)
    total = mapping.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    often = F.col("__n") > max(HOT_ROWS, total // HOT_KEYS)
    hot = mapping.where(often).select(F.col("__from").alias(column), F.struct("__to").alias("__hot"))
    marked = df.join(F.broadcast(hot), column, "left").select(*[F.col(c) for c in df.columns], "__hot")
    spread = F.col("__hot").isNotNull() | is_missing(F.col(column))
    marked = marked.withColumn("__place", F.when(spread, F.xxhash64(*[F.col(c).cast("string") for c in df.columns])).otherwise(F.xxhash64(column)))
    rest = mapping.where(~often).select("__from", F.col("__to").alias("__rest"), F.xxhash64("__from").alias("__place"))
    key = F.when(~spread, F.col(column))
    joined = marked.withColumn("__key", key).join(rest.withColumnRenamed("__from", "__key"), ["__key", "__place"], "left")
    return joined.withColumn("__to", F.coalesce("__hot.__to", "__rest")).select(*[F.col(c) for c in df.columns], "__to")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of whatever store its path names; nothing if there is none."""
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)
