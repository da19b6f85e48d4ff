"""A whole run over a folder with ``config/`` and ``data/``: transforms, search, generalization, reports."""

from __future__ import annotations

import json
import logging
import sys
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from veilframe.config import Config, find_config, load_config
from veilframe.errors import PipelineError, from_os_error, require
from veilframe.functions.values import random_hex
from veilframe.operators import columns, tokenize
from veilframe.operators.hierarchy import read_hierarchy
from veilframe.plans.anonymizer import Anonymizer
from veilframe.shared import cut
from veilframe.sources import state, tables
from veilframe.sources.store import Store, join
from veilframe.sources.vault import Vault

KEY_FILES = ("fpe_keys", "symmetric_keys", "fpe_encrypt_keys")
VAULT = "token_vault"
SAMPLE_ROWS = 10
LOG = "output/pipeline.log"
log = logging.getLogger("veilframe")


@dataclass
class State:
    """What a run keeps for the next one: the vault and the keys, in any store. Salts are new for every run.

    Where there is no vault yet, a ``token_vault.json`` is taken over.
    """

    vault: Vault
    keys: dict[str, dict[str, str]]
    salts: dict[str, str]

    @classmethod
    def load(cls, store: Store, folder: str, cfg: Config) -> State:
        vault = Vault(store.spark, join(folder, VAULT))
        if not vault.runs and (body := state.read_json(store, join(folder, "token_vault.json"))):
            vault.adopt(body)
        keys = {name: state.read_strings(store, join(folder, f"{name}.json")) for name in KEY_FILES}
        for e in cfg.fpe:
            keys["fpe_keys"].setdefault(e.column, random_hex(16))
        for e in cfg.encrypt:
            keys["fpe_encrypt_keys" if e.format_preserving else "symmetric_keys"].setdefault(e.column, random_hex(16))
        return cls(vault, keys, {c: random_hex(32) for c in cfg.hashing_with_salt})

    def save(self, store: Store, folder: str, json_vault: bool = False) -> None:
        """The run's new tokens and all keys. ``json_vault``: the vault as a JSON file too, if it fits the driver."""
        self.vault.commit()
        self.vault.compact()
        if json_vault:
            state.write_json(store, join(folder, "token_vault.json"), tokenize.vault_to_json(self.vault.rows()))
        for name, own in self.keys.items():
            state.write_json(store, join(folder, f"{name}.json"), own)


def preprocess(df: DataFrame, cfg: Config, kept: State, order_by: str | None = None) -> DataFrame:
    """All column transforms in their fixed order; tokens are added to ``kept``."""
    df = columns.before_tokens(df, cfg, kept.salts)
    if cfg.tokenization:
        require(df.columns, [t.column for t in cfg.tokenization])
        for t in cfg.tokenization:
            df = kept.vault.tokenize(df, t, order_by)
    return columns.after_tokens(df, cfg, kept.keys)


def run(spark: SparkSession, root: str, single_file: bool = False, json_vault: bool = False) -> dict[str, Any]:
    """Over ``root`` in any store that Spark's paths name. Returns what goes into ``outputs`` of the status; raises ``PipelineError``.

    ``single_file`` is for results that one task can write.
    """
    root, store = str(root), Store(spark)
    cfg = load_config(store, find_config(store, join(root, "config")))
    log.info("[config] loaded %s", cfg.source)
    out = join(root, "output")
    store.make(out)
    keep = join(root, cfg.output_directory)
    df = tables.read_csv(spark, tables.find_csv(store, join(root, "data")))
    kept = State.load(store, keep, cfg)
    df = preprocess(df, cfg, kept)
    kept.save(store, keep, json_vault)
    log.info("[preprocess] done")
    # salts and random letters must be the same for search and output, and the CSV is parsed once
    df = cut(df)
    own = {c: read_hierarchy(spark, join(root, p)) for c, p in cfg.hierarchies.items()}
    model, result = Anonymizer(cfg, own).fit_transform(df)
    best = model.found.best
    log.info("[search] best node %s of %d evaluated", list(best.node), len(model.found.evaluated))
    target = join(out, cfg.output_path)
    tables.write_csv(result, target, single_file)
    stats = {str(size): n for size, n in sorted(model.class_sizes.items())}
    top = [s.payload() for s in model.found.top]
    state.write_json(store, join(out, "equivalence_class_stats.json"), stats)
    state.write_json(store, join(out, "top_ola2_nodes.json"), top)
    log.info("[generalization] written to %s", target)
    sample = [json.loads(r) for r in tables.read_csv(spark, target).limit(SAMPLE_ROWS).toJSON().collect()]
    return {  # fixed values: the names of the fields, which readers of the status rely on
        "source_config": cfg.source,
        "enable_k_anonymity": cfg.enable_k_anonymity,
        "output_path": cfg.output_path,
        "detected_csv_count": 1,
        "rows_per_chunk": model.total,
        "chunk_count": df.rdd.getNumPartitions(),
        "numerical_qi_count": len(cfg.numerical),
        "encoding_map_count": 0,
        "dynamic_min_max_count": len(cfg.numerical),
        "quasi_identifier_count": len(model.qis),
        "max_equivalence_classes": cfg.max_equivalence_classes,
        "initial_ri": list(model.initial),
        "final_rf": list(best.node),
        "lowest_dm_star": best.dm_star,
        "num_equivalence_classes": best.classes,
        "equivalence_class_stats": stats,
        "top_ola2_nodes": top,
        "total_records": model.total,
        "final_output_path": target,
        "sample_generalized_rows": sample,
    }


def status_of(spark: SparkSession, root: str, single_file: bool = False, json_vault: bool = False) -> dict[str, Any]:
    """A run with its errors caught: the body of ``status.json``."""
    error: PipelineError
    try:
        return {"status": "success", "phase": "done", "outputs": run(spark, root, single_file, json_vault), "log_file": LOG}
    except PipelineError as e:
        error = e
    except OSError as e:
        error = from_os_error(e)
    except Exception as e:  # noqa: BLE001  the status file is what callers read
        log.exception("[error]")
        error = PipelineError("INTERNAL_ERROR", "An unexpected error occurred", f"{type(e).__name__}: {e}"[:2000])
    log.error("[error] %s", error)
    return {"status": "error", "error": error.payload(), "log_file": LOG}


class _Lines(logging.Handler):
    def __init__(self) -> None:
        super().__init__()
        self.lines: list[str] = []

    def emit(self, record: logging.LogRecord) -> None:
        self.lines.append(self.format(record))


def main(argv: list[str] | None = None) -> int:
    """``python -m veilframe [--single-file] [--json-vault] [ROOT]``: runs, writes ``output/status.json`` and the log; 0 on success, else 1."""
    args = sys.argv[1:] if argv is None else argv
    single_file, json_vault = "--single-file" in args, "--json-vault" in args
    root = next((a for a in args if not a.startswith("--")), ".")
    kept = _Lines()
    handlers: list[logging.Handler] = [logging.StreamHandler(), kept]
    for h in handlers:
        h.setFormatter(logging.Formatter("[+%(relativeCreated)d ms] [%(levelname)s] %(message)s"))
        log.addHandler(h)
    log.setLevel(logging.INFO)
    try:
        spark = SparkSession.builder.appName("veilframe").getOrCreate()
        status = status_of(spark, root, single_file, json_vault)
        store = Store(spark)
        state.write_json(store, join(root, "output/status.json"), status)
        store.write(join(root, LOG), "\n".join([*kept.lines, ""]))
    finally:
        for h in handlers:
            log.removeHandler(h)
            h.close()
    return 0 if status["status"] == "success" else 1
