"""The same transforms on streams. Row-local ones are the batch expressions; tokens and class sizes need each batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from veilframe.config import Config, Tokenization
from veilframe.operators import columns
from veilframe.plans.anonymizer import Model
from veilframe.shared import cut
from veilframe.sources.vault import Vault


def row_local(stream: DataFrame, cfg: Config, salts: Mapping[str, str], keys: Mapping[str, Mapping[str, str]], model: Model | None = None) -> DataFrame:
    """Suppressed, hashed, masked, cloaked and encrypted columns, and the generalization of a fitted model."""
    out = columns.after_tokens(columns.before_tokens(stream, cfg, salts), cfg, keys)
    return model.generalize(out) if model is not None else out


class TokenSink:
    """For ``foreachBatch``: tokenizes each batch against a vault of deltas, then hands it on.

    A batch writes the values that it adds under its own number and sees what was committed under lower ones, so that a batch that
    is run again starts from the same vault and gives the same tokens.
    """

    def __init__(self, entries: list[Tokenization], vault_path: str, write: Callable[[DataFrame, int], None], order_by: str | None = None) -> None:
        self.entries, self.path, self.write, self.order_by = entries, vault_path, write, order_by

    def __call__(self, batch: DataFrame, no: int) -> None:
        vault = Vault(batch.sparkSession, self.path, before=no)
        vault.compact()
        batch = cut(batch)
        out = batch
        for t in self.entries:
            out = vault.tokenize(out, t, self.order_by)
        vault.commit()
        self.write(out, no)


def suppressing_sink(model: Model, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: each batch generalized, with the classes that are too small in it suppressed.

    Classes are those of the batch alone: a class that never has k rows in one batch is always suppressed.
    """
    return lambda batch, no: write(model.transform(batch), no)
