"""Tokens in place of values, and the vault that remembers them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.config import Tokenization
from veilframe.functions.values import is_missing
from veilframe.shared import cut, looked_up, numbered

VAULT = "column string, value string, token string, id long"


def empty_vault(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], VAULT)


def seen_values(df: DataFrame, column: str, order_by: str | None = None) -> DataFrame:
    """``value, at, n``: where each value that is not missing first appears, and how often it does; without an order, by the scan."""
    order = F.col(order_by) if order_by else F.monotonically_increasing_id()
    values = df.where(~is_missing(F.col(column))).select(F.col(column).alias("value"), order.alias("at"))
    return values.groupBy("value").agg(F.min("at").alias("at"), F.count("*").alias("n"))


def tokens_of(seen: DataFrame, t: Tokenization, known: DataFrame, last: int) -> tuple[DataFrame, DataFrame]:
    """New vault rows for the ``seen_values`` that ``known`` lacks, numbered after ``last``; and ``value, token, n`` of all that were seen."""
    new = numbered(seen.join(known.select("value"), "value", "left_anti"), ["at", "value"], "id", last + 1)
    token = F.format_string(f"%s%0{t.digits}d", F.lit(t.prefix), F.col("id"))
    new = cut(new.select(F.lit(t.column).alias("column"), "value", token.alias("token"), F.col("id").cast("long").alias("id"), "n"))
    mapping = seen.join(known.select("value", "token"), "value").select("value", "token", "n").unionByName(new.select("value", "token", "n"))
    return new.drop("n"), mapping


def tokenize(df: DataFrame, t: Tokenization, vault: DataFrame, order_by: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The frame with tokens in ``t.column``, and the vault with the new values added.

    New values are numbered in the order of their first appearance by ``order_by``, after those of the
    column that the vault holds; without an order, in that of the scan. Missing values stay.
    """
    own = cut(vault.where(F.col("column") == t.column))
    last = own.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    new, mapping = tokens_of(cut(seen_values(df, t.column, order_by)), t, own, last)
    return replaced(df, t.column, mapping), vault.unionByName(new).select("column", "value", "token", "id")


def detokenize(df: DataFrame, column: str, vault: DataFrame) -> DataFrame:
    """The frame with the vault's values in place of its tokens; other values stay."""
    seen = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("token")).agg(F.count("*").alias("n"))
    mapping = seen.join(vault.where(F.col("column") == column).select("token", "value"), "token", "left")
    return replaced(df, column, mapping.select(F.col("token").alias("value"), F.col("value").alias("token"), "n"))


def replaced(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """The frame with the tokens of ``mapping(value, token, n)`` for the column's values; what has none stays. Rows of a hot value are not brought together."""
    found = looked_up(df, column, mapping.select(F.col("value").alias("__from"), F.col("token").alias("__to"), F.col("n").alias("__n")))
    return found.select(*[F.coalesce("__to", F.col(c)).alias(c) if c == column else F.col(c) for c in df.columns])


def vault_to_json(vault: DataFrame) -> dict[str, dict[str, dict[str, str]]]:
    """``{column: {forward: {value: token}, reverse: {token: value}}}``, for vaults that fit the driver."""
    out: dict[str, dict[str, dict[str, str]]] = {}
    for r in vault.orderBy("column", "id").toLocalIterator():
        own = out.setdefault(r["column"], {"forward": {}, "reverse": {}})
        own["forward"][r["value"]] = r["token"]
        own["reverse"][r["token"]] = r["value"]
    return out


def vault_from_json(spark: SparkSession, body: Mapping[str, Mapping[str, Mapping[str, str]]]) -> DataFrame:
    rows = [(c, v, t, i) for c, own in body.items() for i, (v, t) in enumerate(own.get("forward", {}).items(), 1)]
    return spark.createDataFrame(rows, VAULT)
