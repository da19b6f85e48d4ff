"""CRC-32 in DuckDB SQL."""

from __future__ import annotations

from veilframe.llm.sharding_sql import _crc_table


def crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of the UTF-8 bytes of the string expression ``text``."""
    bytes_ = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), (2 * i + 1)::BIGINT, 2))::UBIGINT)"
    step = f"xor(c >> 8, ('0x' || substr('{_crc_table()}', (8 * (xor(c, b) & 255) + 1)::BIGINT, 8))::UBIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {bytes_}), lambda c, b: {step}), 4294967295::UBIGINT)"
