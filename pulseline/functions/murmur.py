"""Murmur2 of a key's UTF-8 bytes and the session → partition rule (FN-5, FN-6).

Written as one Catalyst expression (higher-order array functions over the
key's bytes) so it runs inside the JVM next to the scan; no Python per row.

32-bit unsigned arithmetic is carried in BIGINT: every intermediate is kept
in [0, 2^32) and the multiplier is below 2^31, so ``x * M`` stays below 2^63
and cannot overflow (ANSI mode would raise); ``& 0xFFFFFFFF`` takes it mod 2^32.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values — the Murmur2 (32-bit) constants used for key hashing.
MURMUR_SEED = 0x9747B28C
MURMUR_M = 0x5BD1E995
MURMUR_R = 24

_MASK32 = 0xFFFFFFFF


def _mul(x: str) -> str:
    """SQL text for ``(x * M) mod 2^32`` with x in [0, 2^32)."""
    return f"((({x}) * {MURMUR_M}) & {_MASK32})"


def _xorshift(x: str, r: int) -> str:
    return f"(({x}) ^ shiftright(({x}), {r}))"


def _chain(first: str, *steps: str) -> str:
    """Evaluate ``first`` once, then each step on the previous value ``x``.

    Single-element ``transform`` binds an intermediate to a lambda variable,
    so an expression used twice by the next step is not evaluated twice.
    """
    out = f"array({first})"
    for step in steps:
        out = f"transform({out}, x -> {step})"
    return f"element_at({out}, 1)"


def _murmur2_sql(key_sql: str) -> str:
    # hx: hex text of the key's UTF-8 bytes (2 characters per byte), bound once
    n = "CAST(length(hx) DIV 2 AS INT)"
    nblocks = f"CAST({n} DIV 4 AS INT)"

    def hex_int(start: str, chars: int) -> str:
        return f"CAST(conv(substr(hx, {start}, {chars}), 16, 10) AS BIGINT)"

    # each 4-byte block is read with one conversion (big-endian) and
    # byte-swapped to the little-endian value the hash consumes
    be = hex_int("8 * j + 1", 8)
    blocks = (f"transform(slice(sequence(0, greatest({nblocks} - 1, 0)), 1, {nblocks}), "
              f"j -> {_chain_inline(be)})")
    # per-block mixing is independent of the running hash: k*m, k^(k>>>r), k*m
    mixed = (f"transform(transform(transform({blocks}, k -> {_mul('k')}), "
             f"k -> {_xorshift('k', MURMUR_R)}), k -> {_mul('k')})")
    folded = (f"aggregate({mixed}, CAST(({MURMUR_SEED} ^ {n}) & {_MASK32} AS BIGINT), "
              f"(h, k) -> ({_mul('h')}) ^ k)")
    off = f"({nblocks} * 8)"       # hex offset of the tail
    rem = f"({n} & 3)"

    def tail_byte(i: int) -> str:
        return f"IF({rem} > {i}, {hex_int(f'{off} + {2 * i + 1}', 2)}, 0)"

    tail = (f"(shiftleft({tail_byte(2)}, 16) ^ shiftleft({tail_byte(1)}, 8) ^ {tail_byte(0)})")
    final = _chain(
        f"IF({rem} >= 1, ({folded}) ^ {tail}, {folded})",
        f"IF({rem} >= 1, {_mul('x')}, x)",
        _xorshift("x", 13),
        _mul("x"),
        _xorshift("x", 15),
        "CAST(IF(x >= 2147483648, x - 4294967296, x) AS INT)",
    )
    return f"element_at(transform(array(hex(encode({key_sql}, 'UTF-8'))), hx -> {final}), 1)"


def _chain_inline(v: str) -> str:
    """Byte-swap a 32-bit big-endian value (bound once as ``w``)."""
    swap = ("(shiftleft(w & 255, 24) | shiftleft(shiftright(w, 8) & 255, 16) "
            "| shiftleft(shiftright(w, 16) & 255, 8) | (shiftright(w, 24) & 255))")
    return f"element_at(transform(array({v}), w -> {swap}), 1)"


def murmur2(key: str) -> Column:
    """Signed 32-bit Murmur2 of the UTF-8 bytes of column ``key`` (FN-5); null → null."""
    ref = "`" + key.replace("`", "``") + "`"
    return F.when(F.col(key).isNull(), F.lit(None).cast("int")).otherwise(
        F.expr(_murmur2_sql(ref)))


def session_partition_id(key: str, num_partitions: int) -> Column:
    """Topic partition of a session key: ``abs(murmur2) % n``; null key or n ≤ 0 → 0 (FN-6).

    ``abs`` is taken in BIGINT, so the result is always in [0, n).
    """
    if num_partitions <= 0:
        return F.lit(0)
    h = murmur2(key).cast("bigint")
    return F.when(F.col(key).isNull(), F.lit(0)).otherwise(
        (F.abs(h) % F.lit(num_partitions)).cast("int"))
