"""Expressions on single cells: missing values, numbers, hashing, masking, cloaking. All planned by Catalyst."""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilframe.functions.patterns import Java, literal, to_java

NUMERIC = r"^(tinyint|smallint|int|bigint|float|double|decimal.*)$"
NUMBER_LETTERS = "0123456789+-.eE"
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: White space that is trimmed from cells.
BLANK = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def trimmed(c: Column) -> Column:
    return F.trim(c, F.lit(BLANK))


def is_missing(c: Column) -> Column:
    """Null, blank, or ``nan`` in any case."""
    return c.isNull() | F.lower(trimmed(c)).isin("", "nan")


def guarded(c: Column, change: Callable[[Column], Column]) -> Column:
    """``change(c)``, but missing values as they are."""
    return F.when(is_missing(c), c).otherwise(change(c))


def number(c: Column) -> Column:
    """A cell as a double; null for anything but a finite decimal number. Type letters after one are no part of it.

    Columns of a numeric type are not parsed (the type is known when the plan is made); text is trimmed of
    other than plain white space only where it does not read as a number at once.
    """

    def read(t: Column, otherwise: Column) -> Column:
        return F.when(F.translate(t, NUMBER_LETTERS, "") == "", t.try_cast("double")).otherwise(otherwise)

    text = c.cast("string")
    x = F.when(F.typeof(c).rlike(NUMERIC), c.try_cast("double")).otherwise(read(text, read(trimmed(text), F.lit(None).cast("double"))))
    return F.when(F.abs(x) < float("inf"), x)


def random_hex(size: int) -> str:
    """A new salt (32 bytes) or key (16 bytes) as lower-case hex."""
    return secrets.token_hex(size)


def hash_hex(c: Column) -> Column:
    return guarded(c, lambda x: F.sha2(x, 256))


def salted_hash_hex(c: Column, salt: str) -> Column:
    return guarded(c, lambda x: F.sha2(F.concat(F.lit(salt), x), 256))


def mask_positions(c: Column, positions: tuple[int, ...], char: str = "*") -> Column:
    """Characters at 1-based positions; those outside the text are left out."""
    for p in positions:
        c = F.when(F.length(c) >= p, F.overlay(c, F.lit(char), p, 1)).otherwise(c)
    return c


def mask_class(c: Column, letter: str = "X", digit: str = "0") -> Column:
    return F.translate(c, DIGITS + UPPER + LOWER, digit * 10 + letter * 52)


#: A private character that sets matches apart from what lies between them.
MARK = "\ue000"


def quoted(text: str) -> str:
    """As the replacement of a pattern, itself."""
    return "".join(f"\\{ch}" if ch in "\\$" else ch for ch in text)


def pieces(c: Column, source: str) -> Column:
    """What lies between the matches of a Java pattern, at even places, and the matches, at odd ones. No match may be empty.

    The pattern runs once over a text, and the marks that it sets are split off; a text that has such a mark is matched twice instead.
    """
    apart = F.split(F.regexp_replace(c, source, f"{MARK}$0{MARK}"), MARK, -1)
    found = F.regexp_extract_all(c, F.lit(source), F.lit(0))
    twice = F.flatten(F.zip_with(F.split(c, source, -1), found, lambda part, m: F.array(part, F.coalesce(m, F.lit("")))))
    return F.when(F.contains(c, F.lit(MARK)), twice).otherwise(apart)


def mask_regex(c: Column, pattern: str | Java, char: str = "*") -> Column:
    """Every match, as many mask characters as it is long; for patterns whose matches are never empty.

    A set of characters, repeated or not, is masked one by one, a pattern of one length by a text of that length: one replacement each.
    """
    java = to_java(pattern) if isinstance(pattern, str) else pattern
    if java is None or not java.least:
        raise ValueError(f"the pattern may match nothing, or is none: {pattern}")
    if java.single is not None:
        return F.regexp_replace(c, java.single, quoted(char))
    if java.least == java.most:
        return F.regexp_replace(c, java.source, quoted(char) * java.least)
    mask = lambda x, i: F.when(i % 2 == 1, F.repeat(F.lit(char), F.length(x))).otherwise(x)
    return F.array_join(F.transform(pieces(c, java.source), mask), "")


def mask_groups(c: Column, java: Java, groups: tuple[tuple[int, str], ...], char: str = "*") -> Column:
    """Matches with their groups masked, each at the first place where its text stands in the match as masked so far.

    ``full``: the whole group; ``partial``: all but its first character, if it has more. Groups that the pattern lacks, or that
    took no part in a match, change nothing.
    """
    own = [(F.regexp_extract_all(c, F.lit(java.source), F.lit(no)), mode) for no, mode in groups if no <= java.groups and mode in ("full", "partial")]

    def one(x: Column, i: Column) -> Column:
        out = x
        for texts, mode in own:
            text = F.get(texts, F.shiftright(i - 1, 1))
            n = F.length(text)
            masked = F.repeat(F.lit(char), n) if mode == "full" else F.concat(F.substring(text, F.lit(1), F.lit(1)), F.repeat(F.lit(char), n - 1))
            at = F.call_function("instr", out, text)
            changed = F.concat(F.substring(out, F.lit(1), at - 1), masked, F.substring(out, at + n, F.length(out)))
            out = F.when((n > (0 if mode == "full" else 1)) & (at > 0), changed).otherwise(out)
        return F.when(i % 2 == 1, out).otherwise(x)

    return F.array_join(F.transform(pieces(c, java.source), one), "")


ANYTHING = r"[\x00-\x{10FFFF}]"


def mask_beside(c: Column, after: bool, delimiter: str, length: int, char: str = "*") -> Column:
    """``length`` characters before or after every occurrence of the delimiter, as far as the text goes.

    A character is masked by looking for a delimiter that near. Occurrences are found from the left and do not overlap; where a delimiter
    can overlap itself, they are first written in private characters, and what is not masked of them is written back.
    """

    def beside(x: Column, ahead: str) -> Column:
        """Looks ahead, in the text read backwards for what is after: Java looks behind by half characters."""
        near = f"{ANYTHING}(?={ANYTHING}{{0,{length - 1}}}{ahead})"
        return F.reverse(F.regexp_replace(F.reverse(x), near, quoted(char))) if after else F.regexp_replace(x, near, quoted(char))

    plain = "".join(map(literal, delimiter))
    direct = beside(c, "".join(map(literal, delimiter[::-1])) if after else plain)
    if not any(delimiter[:k] == delimiter[-k:] for k in range(1, len(delimiter))):
        return direct
    own = "".join(chr(0xE100 + i) for i in range(len(delimiter)))
    written = F.translate(beside(F.regexp_replace(c, plain, own), own[-1] if after else own[0]), own, delimiter)
    return F.when(c.rlike(f"[{own[0]}-{own[-1]}]"), direct).otherwise(written)


def cloak(c: Column) -> Column:
    """Each ASCII digit, upper and lower letter becomes a random one of its kind, drawn anew for every cell."""

    def draw(ch: Column) -> Column:
        pick = lambda of: F.substring(F.lit(of), (F.floor(F.rand() * len(of)) + 1).cast("int"), F.lit(1))
        return F.when(ch.between("0", "9"), pick(DIGITS)).when(ch.between("A", "Z"), pick(UPPER)).when(ch.between("a", "z"), pick(LOWER)).otherwise(ch)

    return guarded(c, lambda x: F.array_join(F.transform(F.split(x, ""), draw), ""))
