"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue (operator 3).

The adjacent pairs of a pre-token lie in buckets, one per merge rank, that
hold positions of the linked list of parts. A bitmap over the ranks, with a
second level over its words, yields the lowest waiting rank by
find-first-set. Entries are not removed when a neighbour merges: a popped
position whose part has gone, or whose pair has another rank by now, is
skipped. Short pre-tokens that a batch of texts brings share one queue, so a
rank is worked off for all of them in one array step; a long one has its own, in
work near linear in its length, so a pre-token of a million bytes needs no
other path.

Defined results: a null text encodes like an empty one, to no ids; null or
empty ids decode to no bytes.
"""

from __future__ import annotations

import base64
import gc
import struct
from array import array
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from pulseline.llm.common import arrow_udf, row_slices, text_bytes

WORD = 8  # a bitmap word holds 2**WORD ranks
LOW = (1 << WORD) - 1
# when more distinct pre-tokens than this are kept in a worker, they are dropped
CACHED = 300_000
LONG = 64     # bytes; longer pre-tokens are merged one by one
SLICE = 8 << 20  # bytes of text encoded together
TAKEN = DECODED = 1 << 14  # pre-tokens gathered, ids decoded together


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a vocabulary file: per line the base64 of a token and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one pre-token: always the lowest-ranked pair, leftmost first."""
    n = len(piece)
    if n == 1:
        return [ranks[piece]]
    find = ranks.get
    follow = list(range(1, n + 2))      # start of the next part; n ends the list
    before = list(range(-1, n))
    rank_at = [find(piece[i:i + 2], -1) for i in range(n - 1)]  # rank of the pair that begins here
    rank_at += [-1, -1]
    buckets: dict[int, list[int]] = {}
    words: dict[int, int] = {}
    top = 0
    for i, r in enumerate(rank_at):
        if r >= 0:
            if r in buckets:
                buckets[r].append(i)
            else:
                buckets[r] = [i]
                w = r >> WORD
                words[w] = words.get(w, 0) | 1 << (r & LOW)
                top |= 1 << w
    while top:
        w = (top & -top).bit_length() - 1
        bits = words[w]
        r = (w << WORD) + (bits & -bits).bit_length() - 1
        waiting = buckets.pop(r)
        bits &= bits - 1
        words[w] = bits
        if not bits:
            top &= top - 1
        if len(waiting) > 1:
            waiting.sort()
        for k, i in enumerate(waiting):
            if rank_at[i] != r:
                continue  # stale
            j = follow[i]
            end = follow[j]
            h = before[i]
            rank_at[j] = rank_at[i] = -1
            follow[i] = end
            before[end] = i
            lowest = r
            if end < n:
                q = find(piece[i:follow[end]], -1)
                if q >= 0:
                    rank_at[i] = q
                    if q in buckets:
                        buckets[q].append(i)
                    else:
                        buckets[q] = [i]
                        v = q >> WORD
                        words[v] = words.get(v, 0) | 1 << (q & LOW)
                        top |= 1 << v
                    if q < lowest:
                        lowest = q
            if h >= 0:
                rank_at[h] = q = find(piece[h:end], -1)
                if q >= 0:
                    if q in buckets:
                        buckets[q].append(h)
                    else:
                        buckets[q] = [h]
                        v = q >> WORD
                        words[v] = words.get(v, 0) | 1 << (q & LOW)
                        top |= 1 << v
                    if q < lowest:
                        lowest = q
            if lowest < r and k + 1 < len(waiting):  # a lower rank came up: it goes first
                buckets[r] = waiting[k + 1:]
                words[w] |= 1 << (r & LOW)
                top |= 1 << w
                break
    out, i = [], 0
    while i < n:
        j = follow[i]
        out.append(ranks[piece[i:j]])
        i = j
    return out


class Merger:
    """The same queue over many pre-tokens at once.

    The parts of all pre-tokens lie in one linked list; a bucket holds array
    pieces of positions, and a rank is worked off for all pre-tokens in one
    step. Of a bucket only the leftmost position of each pre-token is merged
    per step, the others wait, so a lower rank that comes up goes first.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.none = max(ranks.values(), default=-1) + 1  # no token: stands beyond the ends
        self.base = self.none + 1
        found: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    found[a * self.base + b] = rank
        self.pairs = np.array(sorted(found), np.int64)
        self.rank = np.array([found[k] for k in self.pairs.tolist()], np.int32)
        self.byte = np.array([ranks.get(bytes([b]), self.none) for b in range(256)], np.int32)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the token that joins a and b, or -1."""
        key = a * np.int64(self.base) + b
        at = self.pairs.searchsorted(key)
        at[at == len(self.pairs)] = 0
        return np.where(self.pairs[at] == key, self.rank[at], np.int32(-1))

    def __call__(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of every pre-token as little-endian 32-bit bytes."""
        size = np.array([len(p) for p in pieces])
        n = int(size.sum())
        token = np.empty(n + 1, np.int32)
        token[:n] = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        token[n] = self.none
        owner = np.repeat(np.arange(len(pieces), dtype=np.int32), size)
        ends = np.cumsum(size)
        follow, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
        follow[ends - 1] = n            # n: beyond the ends
        before[ends - size] = n
        alive = np.ones(n, bool)
        rank_at = np.full(n + 1, -1, np.int32)
        rank_at[:n] = self._rank(token[:n], token[follow[:n]])
        buckets: dict[int, list[np.ndarray]] = {}
        words = [0] * (self.none // (1 << WORD) + 1)
        top = 0

        def push(rank: np.ndarray, at: np.ndarray) -> None:
            nonlocal top
            order = rank.argsort(kind="stable")
            rank, at = rank[order], at[order]
            cuts = [0, *(np.flatnonzero(rank[1:] != rank[:-1]) + 1).tolist(), len(rank)]
            for q, lo, hi in zip(rank[cuts[:-1]].tolist(), cuts, cuts[1:]):
                if q in buckets:
                    buckets[q].append(at[lo:hi])
                else:
                    buckets[q] = [at[lo:hi]]
                    words[q >> WORD] |= 1 << (q & LOW)
                    top |= 1 << (q >> WORD)

        first = np.flatnonzero(rank_at >= 0).astype(np.int32)
        if len(first):
            push(rank_at[first], first)
        while top:
            w = (top & -top).bit_length() - 1
            bits = words[w]
            r = (w << WORD) + (bits & -bits).bit_length() - 1
            words[w] = bits & (bits - 1)
            if not words[w]:
                top &= top - 1
            at = buckets.pop(r)
            at = at[0] if len(at) == 1 else np.concatenate(at)
            at = at[rank_at[at] == r]  # the others are stale
            if not len(at):
                continue
            if len(at) > 1:
                at.sort()
                mine = owner[at]
                again = mine[1:] == mine[:-1]
                if again.any():
                    later = np.concatenate([[False], again])
                    buckets[r] = [at[later]]
                    words[w] |= 1 << (r & LOW)
                    top |= 1 << w
                    at = at[~later]
            gone = follow[at]
            end, head = follow[gone], before[at]
            token[at] = r
            alive[gone] = False
            rank_at[gone] = -1
            follow[at] = end
            before[end] = at
            both = np.concatenate([at, head])
            after = np.concatenate([token[end], np.full(len(at), r, np.int32)])
            rank = self._rank(token[both], after)
            rank_at[both] = rank
            good = np.flatnonzero(rank >= 0)
            if len(good):
                push(rank[good], both[good])
        ids = token[:n][alive].astype("<i4").tobytes()
        cuts = (4 * np.concatenate([[0], np.cumsum(np.bincount(owner[alive], minlength=len(pieces)))])).tolist()
        return [ids[lo:hi] for lo, hi in zip(cuts, cuts[1:])]


class _Numbers(dict):
    """A number for every pre-token, in order of its first occurrence."""

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        return number


class Codec:
    """Encoder and decoder of one vocabulary; one per Python worker.

    Pre-tokens become numbers; the ids of pre-token k are
    ``flat[start[k]:start[k] + size[k]]``. Texts are then ids by array
    operations, and each distinct pre-token is merged once while it is kept.
    """

    def __init__(self, data: bytes, pattern: str):
        import regex

        self.ranks = read_ranks(data)
        self.split = regex.compile(pattern).findall
        self.merger = Merger(self.ranks)
        self._forget()
        tokens = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.width = np.array([len(t) for t in tokens], np.int32)
        self.first = np.concatenate([[0], np.cumsum(self.width, dtype=np.int64)])[:-1]
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def _forget(self) -> None:
        self.numbers = _Numbers()
        self.flat, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)

    def _learn(self, pieces: list[str]) -> None:
        """Ids of the pre-tokens that got the next numbers."""
        raws = [p.encode() for p in pieces]
        whole = self.ranks.get
        ids = [whole(raw) for raw in raws]
        ids = [None if i is None else struct.pack("<i", i) for i in ids]
        for k, raw in enumerate(raws):
            if ids[k] is None and len(raw) > LONG:
                merged = merge(raw, self.ranks)
                ids[k] = struct.pack(f"<{len(merged)}i", *merged)
        short = [k for k, i in enumerate(ids) if i is None]
        if short:
            for k, i in zip(short, self.merger([raws[k] for k in short])):
                ids[k] = i
        size = np.array([len(i) for i in ids], np.int64) // 4
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), "<i4")])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each text has."""
        if len(self.numbers) > CACHED:
            self._forget()
        before, number = len(self.numbers), self.numbers.__getitem__
        rows = [array("i", map(number, self.split(text))) for text in texts]
        if len(self.numbers) > before:
            self._learn(list(islice(self.numbers, before, None)))
        count = np.array([int(self.size[np.frombuffer(r, np.int32)].sum()) if r else 0 for r in rows], np.int64)
        pieces = np.frombuffer(b"".join(rows), np.int32)
        out = [np.zeros(0, np.int32)]
        for lo in range(0, len(pieces), TAKEN):
            part = pieces[lo:lo + TAKEN]
            size = self.size[part]
            ends = np.cumsum(size)
            out.append(self.flat[np.arange(int(ends[-1])) + np.repeat(self.start[part] - (ends - size), size)])
        return np.concatenate(out), count

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids, end to end."""
        out = []
        for lo in range(0, len(ids), DECODED):
            part = ids[lo:lo + DECODED]
            width = self.width[part]
            ends = np.cumsum(width)
            at = np.arange(int(ends[-1])) + np.repeat(self.first[part] - (ends - width), width)
            out.append(self.bytes[at].tobytes())
        return b"".join(out)


_CODECS: dict[int, Codec] = {}


def codec(data: bytes, pattern: str) -> Codec:
    key = hash((data, pattern))
    if key not in _CODECS:
        _CODECS[key] = Codec(data, pattern)
    return _CODECS[key]


def _encoded(texts: pa.Array, one: Codec) -> pa.ListArray:
    _, offsets = text_bytes(texts)
    flats, counts = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
    collects = gc.isenabled()
    gc.disable()  # nothing here makes cycles, and the collector would walk all kept pre-tokens
    try:
        for lo, hi in row_slices(np.diff(offsets), SLICE):
            flat, count = one.encode([t or "" for t in texts.slice(lo, hi - lo).to_pylist()])
            flats.append(flat)
            counts.append(count)
    finally:
        if collects:
            gc.enable()
    ends = np.cumsum(np.concatenate(counts))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flats), pa.int32()))


def _decoded(lists: pa.ListArray, one: Codec) -> pa.Array:
    size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    cuts = np.concatenate([[0], np.cumsum(one.width[flat], dtype=np.int64)])[ends]
    return pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(one.decode(flat))])


def encode(text: Column, data: bytes, pattern: str) -> Column:
    """Ids (array of int) of a whole text, each match of ``pattern`` merged on its own."""
    return arrow_udf(lambda texts: _encoded(texts, codec(data, pattern)), "array<int>")(text)


def decode(ids: Column, data: bytes, pattern: str) -> Column:
    """Bytes (binary) of an array of ids."""
    return arrow_udf(lambda lists: _decoded(lists, codec(data, pattern)), "binary")(ids)


def round_trip(text: Column, data: bytes, pattern: str) -> Column:
    """A struct of a text's ``ids`` and the ``bytes`` that they decode to, in one pass."""

    def run(texts: pa.Array) -> pa.Array:
        one = codec(data, pattern)
        ids = _encoded(texts, one)
        return pa.StructArray.from_arrays([ids, _decoded(ids, one)], names=["ids", "bytes"])

    return arrow_udf(run, "struct<ids: array<int>, bytes: binary>")(text)
