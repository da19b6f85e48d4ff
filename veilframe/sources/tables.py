"""Tables in and out: CSV with a header, all columns text, and Parquet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.errors import PipelineError, from_os_error
from veilframe.functions.values import trimmed
from veilframe.sources.store import Store, join


def find_csv(store: Store, folder: str) -> str:
    """The one CSV file of a folder that is not empty."""
    if not store.is_folder(folder):
        raise PipelineError("DATA_DIR_MISSING", "The data folder does not exist", folder)
    found = [name for name, size in store.files(folder, ".csv") if size]
    if not found:
        raise PipelineError("DATA_NO_CSV", "No CSV file was found", folder)
    if len(found) > 1:
        raise PipelineError("DATA_MISSING", "Exactly one CSV file is expected", ", ".join(found))
    return join(folder, found[0])


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text; doubled quotes in a quoted field are one; short rows end in nulls; blank rows are left out."""
    df = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("nullValue", None).option("emptyValue", "").csv(str(path))
    filled = [F.coalesce(trimmed(F.col(f"`{c}`")), F.lit("")) != "" for c in df.columns]
    return df.where(reduce(lambda a, b: a | b, filled)) if filled else df


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(str(path)) if str(path).rstrip("/").endswith(".parquet") else read_csv(spark, path)


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """Part files with a header each, in the folder ``path``; ``single`` gives one file, for results that one task can write."""
    path = str(path)
    if not single:
        df.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
        return
    store, parts = Store(df.sparkSession), f"{path}.parts"
    try:
        df.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(parts)
        ((part, _),) = [f for f in store.files(parts) if f[0].startswith("part-")]
        if store.is_folder(path):
            store.remove(path)
        store.move(join(parts, part), path)
    except OSError as e:
        raise from_os_error(e, writing=True) from e
    finally:
        store.remove(parts)
