"""Column-level transforms of a frame, in the order in which a run applies them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.config import Config, Encrypt, Fpe, Masking
from veilframe.errors import require
from veilframe.functions import ciphers, masking, values


def suppress(df: DataFrame, columns: list[str]) -> DataFrame:
    require(df.columns, columns)
    return df.drop(*columns)


def hash_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    require(df.columns, columns)
    return df.withColumns({c: values.hash_hex(F.col(c)) for c in columns}) if columns else df


def salted_hash_columns(df: DataFrame, salts: Mapping[str, str]) -> DataFrame:
    require(df.columns, list(salts))
    return df.withColumns({c: values.salted_hash_hex(F.col(c), s) for c, s in salts.items()}) if salts else df


def mask_columns(df: DataFrame, entries: list[Masking], derived: bool = True) -> DataFrame:
    for m in entries:
        require(df.columns, [m.column])
        df = df.withColumn(m.column, masking.mask(F.col(m.column), m, derived))
    return df


def cloak_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    require(df.columns, columns)
    return df.withColumns({c: values.cloak(F.col(c)) for c in columns}) if columns else df


def fpe_columns(df: DataFrame, entries: list[Fpe], keys: Mapping[str, str]) -> DataFrame:
    for e in entries:
        require(df.columns, [e.column])
        change = ciphers.pan_column if e.format == "pan" else ciphers.digits_column
        df = df.withColumn(e.column, change(F.col(e.column), keys[e.column]))
    return df


def encrypt_columns(df: DataFrame, entries: list[Encrypt], symmetric: Mapping[str, str], fpe: Mapping[str, str]) -> DataFrame:
    for e in entries:
        require(df.columns, [e.column])
        c = F.col(e.column)
        changed = ciphers.general_column(c, fpe[e.column], e.column) if e.format_preserving else ciphers.xor_column(c, symmetric[e.column], e.column)
        df = df.withColumn(e.column, changed)
    return df


def before_tokens(df: DataFrame, cfg: Config, salts: Mapping[str, str]) -> DataFrame:
    """Suppression, hashing, masking and cloaking: row by row, on batch and streaming frames alike."""
    df = suppress(df, list(cfg.suppress))
    df = salted_hash_columns(df, {c: salts[c] for c in cfg.hashing_with_salt})
    df = hash_columns(df, list(cfg.hashing_without_salt))
    df = mask_columns(df, list(cfg.masking), cfg.derived_patterns)
    return cloak_columns(df, list(cfg.charcloak))


def after_tokens(df: DataFrame, cfg: Config, keys: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Format-preserving and keystream encryption: row by row, on batch and streaming frames alike."""
    df = fpe_columns(df, list(cfg.fpe), keys["fpe_keys"])
    return encrypt_columns(df, list(cfg.encrypt), keys["symmetric_keys"], keys["fpe_encrypt_keys"])
