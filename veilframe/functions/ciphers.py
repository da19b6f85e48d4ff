"""Keyed transforms that Spark has no function for: format-preserving and keystream encryption, as Arrow UDFs."""

from __future__ import annotations

import hashlib
import hmac
import math
import re
import struct
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from veilframe.functions.values import DIGITS, LOWER, UPPER, guarded

# Fixed values of the cipher.
ROUNDS = 10
PAN = re.compile(r"([A-Z]{5})([0-9]{4})([A-Z])")
RUNS = re.compile(r"[A-Z]+|[a-z]+|[0-9]+")


@lru_cache(maxsize=4096)
def derive_key(master: str, context: str) -> bytes:
    """The first half of HMAC-SHA256 under the key's text."""
    return hmac.new(master.encode(), context.encode(), hashlib.sha256).digest()[:16]


@lru_cache(maxsize=64)
def _keyed(key: bytes) -> hmac.HMAC:
    """The hash with its key taken in, to be copied for each message."""
    return hmac.new(key, digestmod=hashlib.sha1)


@lru_cache(maxsize=1 << 16)
def _digits(key: bytes, radix: int, no: int, other: tuple[int, ...], n: int) -> tuple[int, ...]:
    """``n`` digits for a round, from HMAC-SHA1 blocks; each block is keyed on by the one before.

    Short texts have few different halves, so what was worked out is kept.
    """
    per_block = max(1, int(20 * math.log(256) / math.log(radix)))
    message = struct.pack(f"<{1 + len(other)}I", no, *other)
    out: list[int] = []
    block = 0
    while len(out) < n:
        h = _keyed(key).copy()
        h.update(message + struct.pack("<I", block))
        digest = h.digest()
        value = int.from_bytes(digest, "big")
        for _ in range(min(per_block, n - len(out))):
            value, d = divmod(value, radix)
            out.append(d)
        message, block = digest, block + 1
    return tuple(out)


def _encode(text: str, alphabet: str) -> list[int]:
    if len(alphabet) < 2 or len(set(alphabet)) < len(alphabet):
        raise ValueError("an alphabet needs two different characters or more")
    index = {c: i for i, c in enumerate(alphabet)}
    try:
        return [index[c] for c in text]
    except KeyError as e:
        raise ValueError(f"{e.args[0]!r} is not in the alphabet") from e


def fpe_encrypt(key: bytes, text: str, alphabet: str) -> str:
    """A Feistel network over the two halves of a text. A text of one character is only ever shifted."""
    v, radix = _encode(text, alphabet), len(alphabet)
    left, right = v[: len(v) // 2], v[len(v) // 2 :]
    for no in range(ROUNDS):
        left, right = right, [(a + d) % radix for a, d in zip(left, _digits(key, radix, no, tuple(right), len(left)))]
    return "".join(alphabet[i] for i in left + right)


def fpe_decrypt(key: bytes, text: str, alphabet: str) -> str:
    v, radix = _encode(text, alphabet), len(alphabet)
    left, right = v[: len(v) // 2], v[len(v) // 2 :]
    for no in reversed(range(ROUNDS)):
        left, right = [(c - d) % radix for c, d in zip(right, _digits(key, radix, no, tuple(left), len(right)))], left
    return "".join(alphabet[i] for i in left + right)


def unchecked(cipher: Callable[[bytes, str, str], str], key: bytes, text: str, alphabet: str) -> str:
    """The cipher's result, or the text itself where it does not fit the alphabet."""
    try:
        return cipher(key, text, alphabet)
    except ValueError:
        return text


def fpe_pan(value: str, master: str, cipher: Callable[[bytes, str, str], str] = fpe_encrypt) -> str:
    """Five letters, four digits and a letter, each part under its own key; anything else unchanged."""
    m = PAN.fullmatch(value)
    if not m:
        return value
    parts = zip(m.groups(), ("pan_letters", "pan_digits", "pan_suffix"), (UPPER, DIGITS, UPPER))
    return "".join(cipher(derive_key(master, context), part, alphabet) for part, context, alphabet in parts)


def fpe_digits(value: str, master: str, cipher: Callable[[bytes, str, str], str] = fpe_encrypt) -> str:
    """A text of digits alone, under a key for its length; anything else unchanged."""
    if not value or not value.isascii() or not value.isdigit():
        return value
    return cipher(derive_key(master, f"digits_len_{len(value)}"), value, DIGITS)


def fpe_general(value: str, master: str, column: str, cipher: Callable[[bytes, str, str], str] = fpe_encrypt) -> str:
    """Each run of upper letters, lower letters or digits under a key for its kind and length; the rest unchanged."""

    def run(m: re.Match) -> str:
        kind, alphabet = next((k, a) for k, a in (("upper", UPPER), ("lower", LOWER), ("digit", DIGITS)) if m[0][0] in a)
        return cipher(derive_key(master, f"{column}:{kind}:{len(m[0])}"), m[0], alphabet)

    return RUNS.sub(run, value)


@lru_cache(maxsize=64)
def _keystream(master: str, column: str, blocks: int) -> bytes:
    return b"".join(derive_key(master, f"{column}:{i}") for i in range(blocks))


def xor_encrypt(value: str, master: str, column: str) -> str:
    """``ENC$`` and the hex of the text under a keystream of the column.

    The keystream is the same for all rows: equal texts give equal results, and two results together
    give away where their texts differ. It hides values from view, no more.
    """
    raw = value.encode()
    blocks = 1 << max(0, (-(-len(raw) // 16) - 1).bit_length())
    return "ENC$" + bytes(a ^ b for a, b in zip(raw, _keystream(master, column, blocks))).hex()


def xor_decrypt(value: str, master: str, column: str) -> str:
    raw = bytes.fromhex(value.removeprefix("ENC$"))
    blocks = 1 << max(0, (-(-len(raw) // 16) - 1).bit_length())
    return bytes(a ^ b for a, b in zip(raw, _keystream(master, column, blocks))).decode()


def _texts(values: np.ndarray, alphabet: str) -> list[str]:
    """Lines of places in the alphabet as texts."""
    letters = np.array(list(alphabet))
    return letters[values].view(f"<U{values.shape[1]}")[:, 0].tolist() if values.size else [""] * len(values)


def _places(texts: list[str], alphabet: str) -> np.ndarray:
    """Texts of one length, of the letters of an alphabet that is a run of code points, as lines of places in it."""
    return np.array(texts).view(np.uint32).reshape(len(texts), -1) - ord(alphabet[0])


@lru_cache(maxsize=64)
def _pads(key: bytes) -> tuple:
    """SHA-1 with the inner and the outer pad of HMAC taken in, to be copied for each message."""
    key = (hashlib.sha1(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    return tuple(hashlib.sha1(bytes(k ^ pad for k in key)) for pad in (0x36, 0x5C))


def _hmacs(key: bytes, messages: Iterable[bytes]) -> bytes:
    """The HMAC-SHA1 of each message, one after the other."""
    inner, outer = _pads(key)
    out = []
    for m in messages:
        i, o = inner.copy(), outer.copy()
        i.update(m)
        o.update(i.digest())
        out.append(o.digest())
    return b"".join(out)


def _taken(digests: bytes, radix: int, n: int) -> np.ndarray:
    """The last ``n`` places of each digest in the radix, the lowest first: long division by as many places as a word holds."""
    words = list(np.frombuffer(digests, ">u4").reshape(-1, 5).T.astype(np.uint64))
    at_once = max(1, int(32 * math.log(2) / math.log(radix) - 1e-9))
    out = np.empty((len(words[0]), n), np.int64)
    for first in range(0, n, at_once):
        count = min(at_once, n - first)
        by, rest = np.uint64(radix**count), np.zeros(len(words[0]), np.uint64)
        for w in range(5):
            words[w], rest = np.divmod(rest << np.uint64(32) | words[w], by)
        for at in range(first, first + count):
            rest, out[:, at] = np.divmod(rest, np.uint64(radix))
    return out


def _round(key: bytes, radix: int, no: int, other: np.ndarray, n: int) -> np.ndarray:
    """The digits of a round for each line, as ``_digits`` has them; the blocks of all lines are divided together.

    Halves of few places, which a batch has often, are worked out once and gathered.
    """
    if not n or not other.shape[1]:
        return np.tile(np.array(_digits(key, radix, no, (), n), np.int64), (len(other), 1))
    at = None
    if radix ** other.shape[1] <= 4 * len(other):
        code = other @ (radix ** np.arange(other.shape[1], dtype=np.int64))
        _, first, at = np.unique(code, return_index=True, return_inverse=True)
        other = other[first]
    lines = np.empty((len(other), 1 + other.shape[1]), "<u4")
    lines[:, 0], lines[:, 1:] = no, other
    per_block = max(1, int(20 * math.log(256) / math.log(radix)))
    raw, size, out = lines.tobytes(), 4 * lines.shape[1], []
    for block in range(-(-n // per_block)):
        tail = struct.pack("<I", block)
        raw = _hmacs(key, (raw[i : i + size] + tail for i in range(0, len(raw), size)))
        size = 20
        out.append(_taken(raw, radix, min(per_block, n - block * per_block)))
    table = np.concatenate(out, 1)
    return table if at is None else table[at.reshape(-1)]


def fpe_batch(key: bytes, texts: list[str], alphabet: str, decrypt: bool = False) -> list[str]:
    """``fpe_encrypt`` or ``fpe_decrypt`` of texts of one length, all of whose letters are in an alphabet that is a run of code points."""
    if not texts or not texts[0]:
        return texts
    v, radix = _places(texts, alphabet).astype(np.int64), len(alphabet)
    left, right = v[:, : v.shape[1] // 2], v[:, v.shape[1] // 2 :]
    for no in reversed(range(ROUNDS)) if decrypt else range(ROUNDS):
        if decrypt:
            left, right = (right - _round(key, radix, no, left, right.shape[1])) % radix, left
        else:
            left, right = right, (left + _round(key, radix, no, right, left.shape[1])) % radix
    return _texts(np.concatenate([left, right], 1), alphabet)


#: A part of a text to be changed: where it begins, its key's context and its alphabet.
Part = tuple[int, str, str, str]


def pan_parts(value: str) -> list[Part]:
    m = PAN.fullmatch(value)
    return [(m.start(i), m[i], context, alphabet) for i, (context, alphabet) in enumerate((("pan_letters", UPPER), ("pan_digits", DIGITS), ("pan_suffix", UPPER)), 1)] if m else []


def digit_parts(value: str) -> list[Part]:
    return [(0, value, f"digits_len_{len(value)}", DIGITS)] if value and value.isascii() and value.isdigit() else []


def general_parts(column: str) -> Callable[[str], list[Part]]:
    def parts(value: str) -> list[Part]:
        out = []
        for m in RUNS.finditer(value):
            kind, alphabet = next((k, a) for k, a in (("upper", UPPER), ("lower", LOWER), ("digit", DIGITS)) if m[0][0] in a)
            out.append((m.start(), m[0], f"{column}:{kind}:{len(m[0])}", alphabet))
        return out

    return parts


def changed(values: list[str], master: str, parts: Callable[[str], list[Part]], decrypt: bool = False) -> list[str]:
    """Each text with its parts under the cipher; parts of one key and length are worked out together."""
    together: dict[tuple[str, str, int], list[tuple[int, int, str]]] = {}
    out = list(values)
    for row, value in enumerate(values):
        for at, text, context, alphabet in parts(value):
            together.setdefault((context, alphabet, len(text)), []).append((row, at, text))
    for (context, alphabet, n), own in together.items():
        for (row, at, _), text in zip(own, fpe_batch(derive_key(master, context), [t for _, _, t in own], alphabet, decrypt)):
            out[row] = out[row][:at] + text + out[row][at + n :]
    return out


def _column(c: Column, master: str, parts: Callable[[str], list[Part]], decrypt: bool) -> Column:
    """The different texts of a batch are changed together, each once."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        at, texts = pd.factorize(s)
        return pd.Series(np.append(np.array(changed(list(texts), master, parts, decrypt), object), None)[at], dtype=object)

    return guarded(c, run)


def pan_column(c: Column, master: str, decrypt: bool = False) -> Column:
    return _column(c, master, pan_parts, decrypt)


def digits_column(c: Column, master: str, decrypt: bool = False) -> Column:
    return _column(c, master, digit_parts, decrypt)


def general_column(c: Column, master: str, column: str, decrypt: bool = False) -> Column:
    return _column(c, master, general_parts(column), decrypt)


#: Blocks of 16 bytes of a keystream that stand in the plan; those of longer texts are worked out in the row.
BLOCKS = 64


def _hmac256(master: str, message: Column) -> Column:
    """HMAC-SHA256 as hex: the hash over the outer pad and the hash over the inner pad and the message."""
    key = master.encode()
    key = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(k ^ pad for k in key)) for pad in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message.cast("binary")), 256))), 256)


def _signed(hex_: Column) -> Column:
    """Sixteen hex digits or fewer as a long."""
    return F.conv(hex_, 16, -10).cast("long")


def _xor_hex(hex_: Column, master: str, column: str) -> Column:
    """The hex digits of a text under the keystream of a column, eight bytes at a time."""
    stream = _keystream(master, column, BLOCKS)
    ready = F.lit([int.from_bytes(stream[i : i + 8], "big", signed=True) for i in range(0, len(stream), 8)]).cast("array<long>")

    def eight(i: Column) -> Column:
        part = F.substring(hex_, i * 16 + 1, F.lit(16))
        block = _hmac256(master, F.concat(F.lit(f"{column}:"), F.shiftright(i, 1).cast("string")))
        later = _signed(F.substring(block, (i % 2) * 16 + 1, F.lit(16)))
        key = F.when(i < 2 * BLOCKS, F.get(ready, i)).otherwise(later)
        n = F.length(part)
        mixed = _signed(part).bitwiseXOR(F.call_function("shiftrightunsigned", key, 64 - 4 * n))
        return F.lower(F.lpad(F.hex(mixed), n, "0"))

    count = F.ceil(F.length(hex_) / 16).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), count - 1), eight), "")


def xor_column(c: Column, master: str, column: str, decrypt: bool = False) -> Column:
    """``xor_encrypt`` or its way back, as expressions. What is no result of it comes back as null."""
    if decrypt:
        body = F.regexp_replace(c, r"\AENC\$", "")
        return guarded(c, lambda _: F.when(F.length(body) > 0, F.try_to_binary(_xor_hex(body, master, column), F.lit("hex")).cast("string")).otherwise(F.lit("")))
    return guarded(c, lambda x: F.concat(F.lit("ENC$"), _xor_hex(F.hex(x.cast("binary")), master, column)))


def register(spark: SparkSession) -> None:
    """``fpe_digits``, ``fpe_pan`` (value, key) and ``fpe_general``, ``xor_encrypt``, ``xor_decrypt`` (value, key, column) for SQL."""

    def many(parts: Callable[[str], Callable[[str], list[Part]]]):
        def run(values: pd.Series, keys: pd.Series, columns: pd.Series) -> pd.Series:
            out = pd.Series([None] * len(values), dtype=object)
            frame = pd.DataFrame({"v": values, "k": keys, "c": columns})[values.notna().to_numpy()]
            for (key, column), own in frame.groupby(["k", "c"], sort=False):
                at, texts = pd.factorize(own["v"])
                out.loc[own.index] = np.array(changed(list(texts), key, parts(column)), object)[at]
            return out

        return run

    def two(parts: Callable[[str], list[Part]]):
        run = many(lambda _: parts)

        @F.pandas_udf("string")
        def f(v: pd.Series, key: pd.Series) -> pd.Series:
            return run(v, key, pd.Series([""] * len(v), index=v.index))

        return f

    general = many(general_parts)

    @F.pandas_udf("string")
    def three(v: pd.Series, key: pd.Series, column: pd.Series) -> pd.Series:
        return general(v, key, column)

    def xor(change: Callable[[str, str, str], str]):
        @F.pandas_udf("string")
        def f(v: pd.Series, key: pd.Series, column: pd.Series) -> pd.Series:
            frame = pd.DataFrame({"v": v, "k": key, "c": column})
            known = {t: None if t[0] is None else change(*t) for t in frame.drop_duplicates().itertuples(index=False, name=None)}
            return pd.Series([known[t] for t in frame.itertuples(index=False, name=None)], dtype=object)

        return f

    for name, f in (("fpe_digits", two(digit_parts)), ("fpe_pan", two(pan_parts)), ("fpe_general", three), ("xor_encrypt", xor(xor_encrypt)), ("xor_decrypt", xor(xor_decrypt))):
        spark.udf.register(name, f)
