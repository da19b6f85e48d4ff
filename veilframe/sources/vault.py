"""The token vault as a table of buckets: each run adds a delta of its new values, and only the buckets that it touches are read."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.config import Tokenization
from veilframe.operators import tokenize
from veilframe.shared import cut
from veilframe.sources.store import Store

#: Buckets of a column's values, by hash, and deltas after which they are put together.
BUCKETS, DELTAS = 64, 16
TABLE = "value string, token string, id long, column string, bucket int"


def bucket(value) -> object:
    return F.pmod(F.xxhash64(value), F.lit(BUCKETS)).cast("int")


class Vault:
    """``run=N`` holds what run N added, and ``run=N.json`` commits it: the highest number of each column, the folder, and whether it holds all before it too.

    ``before``: the number of the run at hand; what was committed under it or later is not seen, so that a run that is made again
    starts from the same vault and gives the same tokens.
    """

    def __init__(self, spark: SparkSession, path: str, before: int | None = None) -> None:
        self.spark, self.path, self.store = spark, str(path).rstrip("/"), Store(spark)
        found = [int(n[4:-5]) for n, _ in self.store.files(self.path, ".json") if n.startswith("run=") and n[4:-5].isdigit()]
        found = sorted(n for n in found if before is None or n < before)
        marks = {n: json.loads(self.store.read(f"{self.path}/run={n}.json")) for n in found}
        whole = max((n for n, m in marks.items() if m["whole"]), default=-1)
        self.runs = {n: marks[n]["folder"] for n in found if n >= whole}
        self.no = before if before is not None else (found[-1] + 1 if found else 1)
        self.last: dict[str, int] = {}
        for n in self.runs:
            self.last |= marks[n]["last"]
        self.new: list[DataFrame] = []

    def rows(self, column: str | None = None, buckets: list[int] | None = None) -> DataFrame:
        """``column, value, token, id``, of some buckets; the folders of others are not read."""
        if not self.runs:
            return tokenize.empty_vault(self.spark)
        found = self.spark.read.schema(TABLE).option("basePath", self.path).parquet(*[f"{self.path}/{f}" for f in self.runs.values()])
        if column is not None:
            found = found.where(F.col("column") == column)
        if buckets is not None:
            found = found.where(F.col("bucket").isin(buckets))
        return found.select("column", "value", "token", "id")

    def tokenize(self, df: DataFrame, t: Tokenization, order_by: str | None = None) -> DataFrame:
        """The frame with tokens in ``t.column``; new values wait for ``commit``."""
        seen = cut(tokenize.seen_values(df, t.column, order_by))
        touched = [r[0] for r in seen.select(bucket(F.col("value")).alias("b")).distinct().collect()]  # BUCKETS at most
        last = self.last.get(t.column, 0)
        new, mapping = tokenize.tokens_of(seen, t, self.rows(t.column, touched), last)
        n = new.agg(F.max("id")).first()[0]
        if n is not None:
            self.last[t.column] = n
            self.new.append(new)
        return tokenize.replaced(df, t.column, mapping)

    def _write(self, rows: DataFrame, no: int, folder: str, whole: bool) -> None:
        rows = rows.withColumn("bucket", bucket(F.col("value"))).repartition("column", "bucket")
        rows.write.mode("overwrite").partitionBy("column", "bucket").parquet(f"{self.path}/{folder}")
        self.store.write(f"{self.path}/run={no}.json", json.dumps({"whole": whole, "folder": folder, "last": self.last}))

    def commit(self) -> None:
        """Writes the new values alone; a run without any writes nothing."""
        if self.new:
            rows = self.new[0]
            for more in self.new[1:]:
                rows = rows.unionByName(more)
            self._write(rows, self.no, f"run={self.no}", False)
            self.runs[self.no] = f"run={self.no}"
            self.new, self.no = [], self.no + 1

    def compact(self) -> None:
        """Puts all deltas before the run at hand together, in the place of the last of them, once there are over ``DELTAS``."""
        if len(self.runs) <= DELTAS:
            return
        last, old = max(self.runs), dict(self.runs)
        self._write(self.rows(), last, f"run={last}-whole", True)
        self.runs = {last: f"run={last}-whole"}
        for n, folder in old.items():  # no reader that starts now sees them
            if n != last:
                self.store.remove(f"{self.path}/run={n}.json")
            self.store.remove(f"{self.path}/{folder}")

    def adopt(self, body: Mapping[str, Any]) -> None:
        """Takes over a vault that was kept as JSON, as a delta of its own."""
        rows = tokenize.vault_from_json(self.spark, body)
        for r in rows.groupBy("column").agg(F.max("id").alias("id")).collect():
            self.last[r["column"]] = max(r["id"], self.last.get(r["column"], 0))
            self.new = [rows]
        self.commit()  # as many rows as the JSON file had
