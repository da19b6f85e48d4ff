"""The JSON configuration and its defaults."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from veilframe.errors import PipelineError
from veilframe.sources.store import Store, join


def _bad(message: str, details: str) -> PipelineError:
    return PipelineError("PREPROCESS_CONFIG_INVALID", message, details)


@dataclass(frozen=True)
class NumericQi:
    """A numeric quasi-identifier. All but the column are accepted for compatibility and have no effect."""

    column: str
    scale: bool = False
    s: int = 0
    encode: bool = False
    type: str = "int"


@dataclass(frozen=True)
class Tokenization:
    column: str
    prefix: str = "TK-"
    digits: int = 6

    @classmethod
    def parse(cls, entry: Any) -> Tokenization:
        if not isinstance(entry, Mapping) or not isinstance(entry.get("column"), str):
            raise _bad("A tokenization entry must be an object with a column", "tokenization")
        digits = entry.get("digits", 6)
        if isinstance(digits, bool) or not isinstance(digits, int):
            digits = 6
        if digits <= 0:
            raise _bad("digits must be positive", entry["column"])
        prefix = entry.get("prefix", "TK-")
        return cls(entry["column"], prefix if isinstance(prefix, str) else "TK-", digits)


@dataclass(frozen=True)
class Fpe:
    column: str
    format: str = "pan"

    @classmethod
    def parse(cls, entry: Any) -> Fpe:
        if not isinstance(entry, Mapping) or not isinstance(entry.get("column"), str):
            raise _bad("An fpe entry must be an object with a column", "fpe")
        kind = str(entry.get("format", "pan")).lower()
        if kind not in ("pan", "digits"):
            raise _bad("format must be pan or digits", entry["column"])
        return cls(entry["column"], kind)


@dataclass(frozen=True)
class Encrypt:
    column: str
    format_preserving: bool = False

    @classmethod
    def parse(cls, entry: Any) -> Encrypt:
        if isinstance(entry, str):
            return cls(entry)
        if not isinstance(entry, Mapping) or len(entry) != 1:
            raise _bad("An encrypt entry must be a column or an object with one column as its key", "encrypt")
        ((column, options),) = entry.items()
        return cls(column, isinstance(options, Mapping) and options.get("format_preserving") is True)


@dataclass(frozen=True)
class Pattern:
    """A literal ``regex``, or one derived from ``type`` (before, after, in_between) and its anchors."""

    char: str
    regex: str | None = None
    type: str = ""
    delimiter: str | None = None
    start: str | None = None
    end: str | None = None
    length: int | None = None
    groups: tuple[tuple[int, str], ...] = ()


@dataclass(frozen=True)
class Masking:
    column: str
    char: str = "*"
    positions: tuple[int, ...] = ()
    patterns: tuple[Pattern, ...] = ()
    order: tuple[str, ...] = ("characters", "regex", "class")
    class_mode: str | None = None
    class_letter: str = "X"
    class_digit: str = "0"

    @classmethod
    def parse(cls, entry: Any) -> Masking:
        if not isinstance(entry, Mapping) or not isinstance(entry.get("column"), str):
            raise _bad("A masking entry must be an object with a column", "masking")
        column = entry["column"]

        def text(source: Mapping, key: str) -> str | None:
            return source[key] if isinstance(source.get(key), str) else None

        char = text(entry, "masking_char" if "masking_char" in entry else "masking_character")
        if char == "":
            raise _bad("masking_char cannot be empty", column)
        char = (char or "*")[0]
        positions = entry.get("characters_to_mask") if isinstance(entry.get("characters_to_mask"), list) else []
        if any(isinstance(p, bool) or not isinstance(p, int) for p in positions):
            raise _bad("characters_to_mask must be integers", column)
        patterns = []
        for p in entry.get("regex_patterns") if isinstance(entry.get("regex_patterns"), list) else []:
            if not isinstance(p, Mapping):
                raise _bad("A regex_patterns entry must be an object", column)
            groups = p.get("mask_groups") if isinstance(p.get("mask_groups"), Mapping) else {}
            length = p.get("length") if isinstance(p.get("length"), int) and not isinstance(p.get("length"), bool) else None
            patterns.append(
                Pattern(
                    char=(text(p, "masking_char") or char)[0],
                    regex=text(p, "regex"),
                    type=(text(p, "type") or "").lower(),
                    delimiter=text(p, "delimiter"),
                    start=text(p, "start"),
                    end=text(p, "end"),
                    length=None if length is None else max(length, 0),
                    groups=tuple((int(k), m) for k, m in sorted(groups.items()) if k.isdecimal() and isinstance(m, str)),
                )
            )
        order = entry.get("apply_order")
        return cls(
            column,
            char,
            tuple(p for p in positions if p > 0),
            tuple(patterns),
            tuple(x for x in order if isinstance(x, str)) if isinstance(order, list) else ("characters", "regex", "class"),
            text(entry, "class_masking_mode"),
            (text(entry, "class_mask_letter") or "X")[0],
            (text(entry, "class_mask_digit") or "0")[0],
        )


@dataclass(frozen=True)
class Config:
    """Everything a run needs. ``max_equivalence_classes`` bounds the first search; None leaves it unbounded.

    Some choices go beyond the JSON file's core: ``exhaustive`` ranks every passing node, ``max_nodes`` bounds
    how many the search evaluates, ``hierarchies`` names a table for a column (below the root unless absolute),
    ``categorical_scoring`` is "index" or "hierarchy", and ``derived_patterns`` False leaves
    patterns without a length unapplied.
    """

    k: int = 2
    suppression_limit: float = 0.0
    output_path: str = "generalized.csv"
    output_directory: str = "output"
    suppress: tuple[str, ...] = ()
    hashing_with_salt: tuple[str, ...] = ()
    hashing_without_salt: tuple[str, ...] = ()
    masking: tuple[Masking, ...] = ()
    charcloak: tuple[str, ...] = ()
    tokenization: tuple[Tokenization, ...] = ()
    fpe: tuple[Fpe, ...] = ()
    encrypt: tuple[Encrypt, ...] = ()
    numerical: tuple[NumericQi, ...] = ()
    categorical: tuple[str, ...] = ()
    size: Mapping[str, int] = field(default_factory=dict)
    max_equivalence_classes: int | None = None
    exhaustive: bool = False
    max_nodes: int | None = None
    hierarchies: Mapping[str, str] = field(default_factory=dict)
    categorical_scoring: str = "index"
    derived_patterns: bool = True
    source: str = ""
    enable_k_anonymity: bool = True


def find_config(store: Store, folder: str) -> str:
    """The first ``*.json`` of a folder by name."""
    found = store.files(folder, ".json")
    if not found:
        raise PipelineError("CONFIG_NOT_FOUND", "No JSON configuration was found", str(folder))
    return join(folder, found[0][0])


def parse_config(body: Mapping[str, Any], source: str = "") -> Config:
    name = body.get("data_type")
    if not isinstance(name, str):
        raise PipelineError("CONFIG_MISSING_FIELD", "data_type is missing", "data_type")
    section = body.get(name)
    if not isinstance(section, Mapping):
        raise PipelineError("CONFIG_MISSING_FIELD", f"Section '{name}' is missing", name)

    def get(key: str, kind: type, default: Any) -> Any:
        return section[key] if isinstance(section.get(key), kind) else default

    def strings(key: str) -> tuple[str, ...]:
        return tuple(x for x in get(key, list, []) if isinstance(x, str))

    def whole(x: Any) -> bool:
        return isinstance(x, int) and not isinstance(x, bool)

    k = get("k_anonymize", dict, {}).get("k", 2)
    qis = get("quasi_identifiers", dict, {})
    numerical = []
    for entry in qis.get("numerical") or []:
        if isinstance(entry, Mapping) and isinstance(entry.get("column"), str):
            numerical.append(NumericQi(entry["column"], entry.get("scale") is True, entry.get("s") if whole(entry.get("s")) else 0, entry.get("encode") is True, str(entry.get("type", "int"))))
    categorical = [e["column"] if isinstance(e, Mapping) else e for e in qis.get("categorical") or [] if isinstance(e, str) or isinstance(e, Mapping) and isinstance(e.get("column"), str)]
    limit = section.get("suppression_limit", 0.0)
    limit = float(limit) if isinstance(limit, (int, float)) and not isinstance(limit, bool) else 0.0
    if not 0 <= limit <= 1:
        raise PipelineError("CONFIG_INVALID_VALUE", "suppression_limit must be from 0 to 1", str(limit))
    classes = section.get("max_equivalence_classes")
    return Config(
        k=max(k if whole(k) else 2, 1),
        suppression_limit=limit,
        output_path=get("output_path", str, "generalized.csv"),
        output_directory=get("output_directory", str, "output"),
        suppress=strings("suppress"),
        hashing_with_salt=strings("hashing_with_salt"),
        hashing_without_salt=strings("hashing_without_salt"),
        masking=tuple(map(Masking.parse, get("masking", list, []))),
        charcloak=strings("charcloak"),
        tokenization=tuple(map(Tokenization.parse, get("tokenization", list, []))),
        fpe=tuple(map(Fpe.parse, get("fpe", list, []))),
        encrypt=tuple(map(Encrypt.parse, get("encrypt", list, []))),
        numerical=tuple(numerical),
        categorical=tuple(categorical),
        size={c: max(n, 1) for c, n in get("size", dict, {}).items() if whole(n)},
        max_equivalence_classes=classes if whole(classes) else None,
        exhaustive=section.get("exhaustive_search") is True,
        hierarchies={c: p for c, p in get("hierarchies", dict, {}).items() if isinstance(p, str)},
        max_nodes=section["max_nodes"] if whole(section.get("max_nodes")) and section["max_nodes"] > 0 else None,
        categorical_scoring="hierarchy" if section.get("categorical_scoring") == "hierarchy" else "index",
        derived_patterns=section.get("regex_compat") != "reference",
        source=source,
    )


def load_config(store: Store, path: str) -> Config:
    try:
        body = json.loads(store.read(path) or "")
    except ValueError as e:
        raise PipelineError("CONFIG_PARSE_ERROR", "The configuration is not valid JSON", str(e)) from e
    return parse_config(body if isinstance(body, Mapping) else {}, str(path))
