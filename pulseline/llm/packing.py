"""Cost-balanced packing of documents into training sequences (operator 4).

Every input partition packs its own documents while they stream through, so
nothing is shuffled. A document's ids are cut into full sequences first; the
remainders of a bounded run of documents are then packed together: in
descending length, each goes to the sequence with the lowest estimated cost
(linear plus quadratic attention cost of the pieces in it) among those with
room. A remainder that fits nowhere whole is cut over the free places that
are left, so only the last sequence of a run is not full.

Defined results: a null or empty text is a document of the end id alone. A
null ``doc_id`` is kept as null. Repeated rows are packed like any others.
Equal lengths are taken in input order, equal costs by sequence number.
"""

from __future__ import annotations

import heapq
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseline.llm.common import ship_package

# remainders packed together; bounds the buffer to RUN * sequence length ids
RUN = 4096
# pieces and ids per output batch
OUT_ROWS = 1000
OUT_IDS = 500_000

PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long")

_ENCODERS: dict[int, object] = {}


@dataclass(frozen=True)
class Vocabulary:
    """A byte-level ``tokenizers`` file, read once on the driver: its tokens end
    to end with their sizes and ranks, its added tokens, and the file itself."""

    tokens: bytes
    sizes: bytes     # uint16 each
    ranks: bytes     # int32 each
    added: tuple[str, ...]
    spec: str
    pattern: str
    ranked: bool     # whether merging by rank gives the file's own ids

    @staticmethod
    def read(spec: str, pattern: str) -> Vocabulary:
        data = json.loads(spec)
        added = tuple(t["content"] for t in data["added_tokens"])
        byte_of = _byte_letters()
        ranked = _merges_by_rank(data, added, pattern)
        plain = {bytes(byte_of[c] for c in token): rank
                 for token, rank in data["model"]["vocab"].items() if token not in added} if ranked else {}
        return Vocabulary(b"".join(plain), np.array([len(t) for t in plain], np.uint16).tobytes(),
                          np.array(list(plain.values()), np.int32).tobytes(), added, spec, pattern, ranked)


# Fixed value: what a byte-level step without a pattern of its own splits by.
BYTE_LEVEL_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def _merges_by_rank(data: dict, added: tuple[str, ...], pattern: str) -> bool:
    """Whether a file merges in the order of its ids, changes no text before and splits by ``pattern``.

    Every token is then a byte or the result of exactly one merge, and an
    earlier merge has the smaller id.
    """
    model, split = data["model"], data.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or data.get("normalizer") or any(model.get(k) for k in (
            "dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback")):
        return False
    if (split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True)
            or pattern != BYTE_LEVEL_PATTERN):
        return False
    vocab, letters = model["vocab"], _byte_letters()
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    ids = [vocab.get(token, -1) for token in merged]
    bytes_first = max((vocab.get(c, len(vocab)) for c in letters), default=0)
    tokens = {t for t in vocab if t not in added}
    return (all(a < b for a, b in zip([bytes_first, *ids], ids)) and tokens == {*letters, *merged})


class _Encoder:
    """Token ids of whole texts under the vocabulary of a ``tokenizers`` file.

    The merge loop of byte-level BPE runs in tiktoken over the ranks read from
    the same file, several times faster; its ids are the same. Texts that hold
    one of the file's added tokens go through ``tokenizers`` itself, and so do
    all texts under a file that does not merge by rank.
    """

    def __init__(self, vocabulary: Vocabulary):
        import tiktoken

        self.added, self.spec, self.full = vocabulary.added, vocabulary.spec, None
        self.fast = None
        if not vocabulary.ranked:
            return
        ends = np.cumsum(np.frombuffer(vocabulary.sizes, np.uint16), dtype=np.int64).tolist()
        ranks = np.frombuffer(vocabulary.ranks, np.int32).tolist()
        tokens = (vocabulary.tokens[a:b] for a, b in zip([0, *ends], ends))
        self.fast = tiktoken.Encoding("pack", pat_str=vocabulary.pattern,
                                      mergeable_ranks=dict(zip(tokens, ranks)), special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if self.fast is None or any(t in text for t in self.added):
            if self.full is None:  # large, and rarely needed
                from tokenizers import Tokenizer

                self.full = Tokenizer.from_str(self.spec)
                self.full.no_truncation()  # whole texts, whatever the file asks for
                self.full.no_padding()
            return self.full.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def _byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabulary files use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters.update({chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))})
    return letters


def encoder(vocabulary: Vocabulary) -> _Encoder:
    """The worker's encoder for a vocabulary, built once per Python worker."""
    key = hash((vocabulary.spec, vocabulary.pattern))
    if key not in _ENCODERS:
        _ENCODERS[key] = _Encoder(vocabulary)
    return _ENCODERS[key]


class _Places:
    """Sequences by free room: the cheapest with at least a given room is found
    by a tree of minima over the rooms 0..capacity."""

    def __init__(self, count: int, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.heaps: dict[int, list] = {capacity: [(0.0, s) for s in range(count)]}
        self.least: list = [None] * (2 * self.size)
        self._mend(capacity)

    def _mend(self, room: int) -> None:
        heap = self.heaps.get(room)
        at = room + self.size
        self.least[at] = (*heap[0], room) if heap else None
        while at > 1:
            at >>= 1
            a, b = self.least[2 * at], self.least[2 * at + 1]
            self.least[at] = a if b is None or (a is not None and a <= b) else b

    def add(self, cost: float, seq: int, room: int) -> None:
        heapq.heappush(self.heaps.setdefault(room, []), (cost, seq))
        self._mend(room)

    def take(self, need: int):
        """Remove and return (cost, sequence, room) of the cheapest with ``need`` room."""
        lo, hi, best = need + self.size, 2 * self.size, None
        while lo < hi:
            if lo & 1:
                x = self.least[lo]
                best = x if best is None or (x is not None and x < best) else best
                lo += 1
            if hi & 1:
                hi -= 1
                x = self.least[hi]
                best = x if best is None or (x is not None and x < best) else best
            lo >>= 1
            hi >>= 1
        if best is not None:
            cost, seq, room = best
            heapq.heappop(self.heaps[room])
            self._mend(room)
        return best


def pack_run(lengths, capacity: int, linear: float = 1.0, quadratic: float | None = None):
    """Place pieces of the given lengths (< capacity): list of (piece, start, length, sequence, offset).

    The number of sequences is the least that can hold all ids. The cost of a
    sequence is the sum over its pieces of ``linear * n + quadratic * n**2``
    (attention runs within a document); ``quadratic`` is 1/capacity unless given.
    """
    quadratic = 1.0 / capacity if quadratic is None else quadratic
    price = lambda n: linear * n + quadratic * n * n
    total = int(sum(lengths))
    count = -(-total // capacity)
    places, used, out, rest = _Places(count, capacity), [0] * count, [], []
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    for i in order:
        n = int(lengths[i])
        found = places.take(n)
        if found is None:
            rest.append(i)
            continue
        cost, seq, room = found
        out.append((i, 0, n, seq, used[seq]))
        used[seq] += n
        places.add(cost + price(n), seq, room - n)
    for i in rest:  # cut over the largest free places
        start, n = 0, int(lengths[i])
        while start < n:
            need = n - start
            found = None
            for room in sorted((r for r, h in places.heaps.items() if h and r), reverse=True):
                found = places.take(room)
                break
            cost, seq, room = found
            part = min(need, room)
            out.append((i, start, part, seq, used[seq]))
            used[seq] += part
            places.add(cost + price(part), seq, room - part)
            start += part
    return out, count


def pack_documents(df: DataFrame, spec: str, pattern: str, key: str = "doc_id",
                   text: str = "text", capacity: int = 2048, end_id: int = 1,
                   linear: float = 1.0, quadratic: float | None = None,
                   run: int = RUN) -> DataFrame:
    """Pieces of all documents with their place in the packed sequences.

    ``spec`` is the content of a ``tokenizers`` JSON file and ``pattern`` its
    splitting pattern; a file that is not plain byte-level BPE merged in the
    order of its ids, split by that pattern, is encoded by ``tokenizers``. ``ids`` holds the piece's ids
    as little-endian unsigned 32-bit integers. ``sequence_id`` is unique over
    the input: the partition number in the high bits, then a count.
    """
    ship_package(df.sparkSession)
    vocabulary = Vocabulary.read(spec, pattern)
    narrow = df.select(F.col(key).cast("long").alias("doc_id"),
                       F.col(text).cast("string").alias("text"),
                       F.spark_partition_id().cast("long").alias("part"))

    def pack(batches):
        encode = encoder(vocabulary)
        made, waiting = 0, []  # waiting: (doc, start, ids, doc_tokens)
        rows, weight, base = [], 0, 0

        def flush():
            nonlocal rows, weight
            cols = list(zip(*rows)) if rows else [()] * 7
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary() if k == 3 else pa.int64()) for k, c in enumerate(cols)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
            rows, weight = [], 0
            pa.default_memory_pool().release_unused()
            return batch

        def settle():
            nonlocal made, waiting
            placed, count = pack_run([len(w[2]) for w in waiting], capacity, linear, quadratic)
            for i, start, n, seq, offset in placed:
                doc, first, ids, tokens = waiting[i]
                yield (doc, first + start, n, ids[start:start + n].tobytes(), tokens,
                       base + made + seq, offset)
            made += count
            waiting = []

        for batch in batches:
            if len(batch):
                base = batch.column("part")[0].as_py() << 36
            for doc, txt in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.array([*encode(txt or ""), end_id], "<u4")
                tokens = len(ids)
                whole = tokens - tokens % capacity
                for start in range(0, whole, capacity):
                    rows.append((doc, start, capacity, ids[start:start + capacity].tobytes(),
                                 tokens, base + made, 0))
                    made += 1
                    weight += capacity
                if whole < tokens:
                    waiting.append((doc, whole, ids[whole:], tokens))
                    if len(waiting) >= run:
                        for row in settle():
                            rows.append(row)
                            if len(rows) >= OUT_ROWS:
                                yield flush()
                if len(rows) >= OUT_ROWS or weight >= OUT_IDS:
                    yield flush()
        for row in settle():
            rows.append(row)
            if len(rows) >= OUT_ROWS:
                yield flush()
        if rows:
            yield flush()

    return narrow.mapInArrow(pack, PIECES)
