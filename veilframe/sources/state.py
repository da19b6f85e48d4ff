"""Small JSON files beside a run, in any store: keys, reports, the status."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from veilframe.errors import PipelineError, from_os_error
from veilframe.sources.store import Store


def read_json(store: Store, path: str) -> dict[str, Any]:
    """An object; empty if there is no such file."""
    try:
        text = store.read(path)
    except OSError as e:
        raise from_os_error(e) from e
    try:
        body = {} if text is None else json.loads(text)
    except ValueError as e:
        raise PipelineError("CONFIG_PARSE_ERROR", f"{path.rpartition('/')[2]} is not valid JSON", str(e)) from e
    return body if isinstance(body, dict) else {}


def read_strings(store: Store, path: str) -> dict[str, str]:
    """The string values of an object; others are dropped."""
    return {k: v for k, v in read_json(store, path).items() if isinstance(v, str)}


def write_json(store: Store, path: str, body: Mapping[str, Any] | list[Any]) -> None:
    """Committed by a rename."""
    try:
        store.write(path, json.dumps(body, indent=2, ensure_ascii=False))
    except OSError as e:
        raise from_os_error(e, writing=True) from e
