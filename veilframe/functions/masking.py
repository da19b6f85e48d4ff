"""The masking transform: positions, patterns and classes, in a configured order."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from veilframe.config import Masking, Pattern
from veilframe.functions.patterns import to_java
from veilframe.functions.values import cloak, guarded, mask_beside, mask_class, mask_groups, mask_positions, mask_regex


def derived_regex(p: Pattern) -> str:
    """The pattern that a type and its anchors stand for; empty if they are incomplete."""
    if p.type == "before" and p.delimiter is not None:
        return f"^.+?(?={re.escape(p.delimiter)})"
    if p.type == "after" and p.delimiter is not None:
        return f"(?<={re.escape(p.delimiter)}).+$"
    if p.type == "in_between" and p.start is not None and p.end is not None:
        ahead = ".+$" if p.end == "$" else f".+?(?={re.escape(p.end)})"
        return f"(?<={re.escape(p.start)}){ahead}"
    return ""


def python_regex(source: str) -> regex.Pattern | None:
    try:
        return regex.compile(re.sub(r"\\z", r"\\Z", source))
    except regex.error:
        return None


def groups_masked(match: regex.Match, groups: tuple[tuple[int, str], ...], char: str) -> str:
    """A match with its groups masked, each at the first place where its text stands in the match."""
    whole = match[0]
    for no, mode in groups:
        if no > match.re.groups or match[no] is None:
            continue
        own = match[no]
        if mode == "full":
            whole = whole.replace(own, char * len(own), 1)
        elif mode == "partial" and len(own) > 1:
            whole = whole.replace(own, own[0] + char * (len(own) - 1), 1)
    return whole


def _by_text(change: Callable[[str], str]) -> Callable[[Column], Column]:
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        at, texts = pd.factorize(s)
        return pd.Series(np.append(np.array([change(x) for x in texts], object), None)[at], dtype=object)

    return run


def mask_pattern(c: Column, p: Pattern, derived: bool = True) -> Column:
    """One pattern over a text column; a pattern that does not compile changes nothing."""
    if p.length and p.delimiter and p.type in ("before", "after"):
        beside = mask_beside(c, p.type == "after", p.delimiter, p.length, p.char)
        return F.when(beside != c, beside).otherwise(_mask_matches(c, p, derived))
    return _mask_matches(c, p, derived)


def _mask_matches(c: Column, p: Pattern, derived: bool) -> Column:
    """In expressions where Java has a form of the pattern and no match is empty; else text by text in Python."""
    if p.regex is None and not derived:
        return c
    source = p.regex if p.regex is not None else derived_regex(p)
    if not source:
        return c
    java = to_java(source)
    if java is None or not java.least:
        compiled = python_regex(source)
        if compiled is None:
            return c
        if p.groups:
            return _by_text(lambda x: compiled.sub(lambda m: groups_masked(m, p.groups, p.char), x))(c)
        return _by_text(lambda x: compiled.sub(lambda m: p.char * len(m[0]), x))(c)
    if p.groups:
        return mask_groups(c, java, p.groups, p.char)
    masked = mask_regex(c, java, p.char)
    if p.regex is None and p.type == "in_between":
        spaced = mask_regex(c, r"(?<=\s).+$", p.char)
        masked = F.when(c.rlike(java.source), masked).when(F.contains(c, F.lit(" ")), spaced).otherwise(c)
    return masked


def mask(c: Column, m: Masking, derived: bool = True) -> Column:
    """All steps of a masking entry; missing values stay as they are."""

    def run(x: Column) -> Column:
        for step in m.order:
            if step == "characters":
                x = mask_positions(x, m.positions, m.char)
            elif step == "regex":
                for p in m.patterns:
                    x = mask_pattern(x, p, derived)
            elif step == "class" and m.class_mode == "random_class":
                x = cloak(x)
            elif step == "class" and m.class_mode == "fixed_class":
                x = mask_class(x, m.class_letter, m.class_digit)
        return x

    return guarded(c, run)
