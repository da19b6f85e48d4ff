"""DuckDB SQL of the sharding query: XXH64 of longs in 128-bit arithmetic, CRC-32 by a byte table."""

from __future__ import annotations

# The primes of XXH64 and the polynomial of CRC-32.
P1, P2, P3, P4, P5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261
CRC_POLYNOMIAL = 0xEDB88320

_MOD = "18446744073709551616::UHUGEINT"


def _mul(a: str, b: int) -> str:
    return f"((({a})::UHUGEINT * {b}::UHUGEINT) % {_MOD})::UBIGINT"


def _add(a: str, b: int) -> str:
    return f"((({a})::UHUGEINT + {b}::UHUGEINT) % {_MOD})::UBIGINT"


def _rotl(a: str, r: int) -> str:
    return f"(({_mul(a, 1 << r)}) | (({a}) >> {64 - r}))"


def _hash_long(source: str, value: str, seed: str, out: str, keep: str, name: str) -> list[str]:
    """CTEs that add to ``source`` a column ``out``: the hash of the UBIGINT column ``value`` under ``seed``."""
    steps = [
        ("k", _mul(value, P2)),
        ("k", _mul(_rotl("k", 31), P1)),
        ("k", f"xor({_add(seed, P5 + 8)}, k)"),
        ("k", _add(_mul(_rotl("k", 27), P1), P4)),
        ("k", _mul("xor(k, k >> 33)", P2)),
        ("k", _mul("xor(k, k >> 29)", P3)),
        (out, "xor(k, k >> 32)"),
    ]
    ctes, at = [], source
    for i, (col, sql) in enumerate(steps):
        ctes.append(f"{name}{i} AS (SELECT {keep}, {sql} AS {col} FROM {at})")
        at = f"{name}{i}"
    return ctes


def _crc_table() -> str:
    table = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ CRC_POLYNOMIAL * (c & 1)
        table.append(f"{c:08x}")
    return "".join(table)


def sharding_sql(shards: int, slot_parts: int) -> str:
    """Slots follow the Spark query: by part, then by doc_id."""
    unsigned = "((doc_id::HUGEINT + 18446744073709551616) % 18446744073709551616)::UBIGINT"
    # the key is xxhash64(doc_id); shard scores and parts hash it as a long again
    ctes = [
        "base AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents)",
        f"ids AS (SELECT r, {unsigned} AS v FROM base)",
        *_hash_long("ids", "v", "42::UBIGINT", "key", "r, v", "a"),
        *_hash_long("a6", "key", "42::UBIGINT", "kk", "r, key", "b"),
        f"cand AS (SELECT r, kk, s::UBIGINT AS s FROM b6, range({shards + 1}) AS x(s))",
        *_hash_long("cand", "s", "kk", "h", "r, s, kk", "c"),
        f"won AS (SELECT r, arg_max(s, (h >> 11) * 64 + (63 - s)) FILTER (s < {shards}) AS shard, arg_max(s, (h >> 11) * 64 + (63 - s)) AS grown FROM c6 GROUP BY r)",
        "bytes AS (SELECT r, doc_id, hex(encode(t)) AS hx, octet_length(encode(t)) AS n FROM base)",
        f"""crc AS (SELECT r, doc_id, n + 16 AS size, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(n), lambda i: ('0x' || substr(hx, (2 * i + 1)::BIGINT, 2))::UBIGINT)),
            lambda c, b: xor(c >> 8, ('0x' || substr('{_crc_table()}', (8 * (xor(c, b) & 255) + 1)::BIGINT, 8))::UBIGINT)), 4294967295::UBIGINT) AS crc FROM bytes)""",
        "joined AS (SELECT crc.r, doc_id, size, crc, shard, grown, kk FROM crc JOIN won USING (r) JOIN b6 USING (r))",
        *_hash_long("joined", "crc", "kk", "k2", "r, doc_id, size, crc, shard, grown, kk", "d"),
        *_hash_long("(SELECT r, doc_id, size::UBIGINT AS size, crc, shard, grown, k2 FROM d6)", "size", "k2", "k3", "r, doc_id, size, crc, shard, grown, k2", "e"),
        # a signed long's non-negative remainder by a power of two is that of its bits
        f"parts AS (SELECT *, k3 % {slot_parts} AS part FROM e6)",
    ]
    return f"""WITH {", ".join(ctes)}
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
       (row_number() OVER (PARTITION BY shard ORDER BY part, doc_id, size, crc) - 1)::BIGINT AS slot, grown::INTEGER AS grown_shard
FROM parts"""
