"""Variable-byte integer coding as Spark column expressions.

Layout (fixed by the index format, byte for byte): 7 bits per byte, least
significant group first, high bit set on every byte but the last. Zero is
one byte ``00`` (an encoder that emits no byte for zero loses doc 0;
here doc 0 is an ordinary document).

Encoding happens per posting inside codegen'd projections (``varbyte_hex``);
decoding works on one block payload at a time with array functions, so a
block's work is bounded by the block size. ``encode_codes`` and
``decode_codes`` do the same for whole Arrow batches inside tasks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Enough groups for any non-negative BIGINT (63 bits / 7 bits per byte).
_MAX_BYTES = 9


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def varbyte_size(x: Column | str) -> Column:
    """Bytes needed for the varbyte code of a non-negative integer (BIGINT)."""
    x = _col(x)
    expr = F.when(x < F.lit(1 << 7), F.lit(1))
    for k in range(2, _MAX_BYTES):
        expr = expr.when(x < F.lit(1 << (7 * k)), F.lit(k))
    return expr.otherwise(F.lit(_MAX_BYTES)).cast("bigint")


def varbyte_hex(x: Column | str) -> Column:
    """Upper-case hex string of the varbyte code of a non-negative integer."""
    x = _col(x).cast("bigint")
    parts = []
    for k in range(_MAX_BYTES):
        group = F.shiftright(x, 7 * k).bitwiseAND(F.lit(0x7F))
        more = x >= F.lit(1 << (7 * (k + 1))) if k + 1 < _MAX_BYTES else F.lit(False)
        byte = F.when(more, group.bitwiseOR(F.lit(0x80))).otherwise(group)
        hex_byte = F.lpad(F.hex(byte), 2, "0")
        parts.append(hex_byte if k == 0 else F.when(x >= F.lit(1 << (7 * k)), hex_byte).otherwise(F.lit("")))
    return F.concat(*parts)


# One varbyte code in hex: continuation bytes (high bit set: first hex digit
# 8-F) followed by one final byte (first hex digit 0-7). A payload cut short
# after continuation bytes yields its tail as a last, partial code.
_CODE_HEX = r"(?:[89A-F][0-9A-F])*[0-7][0-9A-F]|(?:[89A-F][0-9A-F])+$"


def varbyte_decode(payload: Column | str) -> Column:
    """ARRAY<BIGINT> of all integers coded back to back in a BINARY payload."""
    codes = F.regexp_extract_all(F.hex(_col(payload)), F.lit(_CODE_HEX), 0)

    def value(code: Column) -> Column:
        n_bytes = F.length(code) / 2
        return F.aggregate(
            F.sequence(F.lit(0), n_bytes.cast("int") - 1),
            F.lit(0).cast("bigint"),
            lambda acc, k: acc.bitwiseOR(
                F.call_function(
                    "shiftleft",
                    F.conv(F.substring(code, k * 2 + 1, 2), 16, 10).cast("bigint").bitwiseAND(F.lit(0x7F)),
                    k * 7,
                )
            ),
        )

    return F.transform(codes, value)


def hex_concat(hex_parts: Column) -> Column:
    """BINARY from an ARRAY<STRING> of hex pieces, concatenated in order."""
    return F.unhex(F.array_join(hex_parts, ""))


def encode_codes(values: np.ndarray, with_bytes: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The codes of non-negative integers one after the other, and where each
    ends."""
    sizes = np.ones(len(values), np.int64)
    for k in range(1, _MAX_BYTES):
        larger = values >= 1 << (7 * k)
        if not larger.any():
            break
        sizes += larger
    ends = np.cumsum(sizes)
    if not with_bytes:
        return np.zeros(0, np.uint8), ends
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    at, rest, left = ends - sizes, values, sizes
    while len(at):
        more = left > 1
        out[at] = (rest & 0x7F) | (more.astype(np.int64) << 7)
        at, rest, left = at[more] + 1, rest[more] >> 7, left[more] - 1
    return out, ends


def decode_codes(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Integers coded in payloads of ``sizes`` bytes, and how many each payload
    has; a payload that is cut short ends with a partial code."""
    final = data < 0x80
    ends_of = np.cumsum(sizes)
    final[ends_of[sizes > 0] - 1] = True
    ends = np.flatnonzero(final)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    values, left, shift = (data[starts] & 0x7F).astype(np.int64), ends - starts, 0
    rows = np.flatnonzero(left)
    while len(rows) and shift < 56:
        shift += 7
        values[rows] |= (data[starts[rows] + shift // 7] & 0x7F).astype(np.int64) << shift
        rows = rows[left[rows] > shift // 7]
    before = np.concatenate([[0], np.cumsum(final)])
    return values, before[ends_of] - before[ends_of - sizes]
