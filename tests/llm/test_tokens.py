"""BPE, packing and sharding against the public libraries and plain versions."""

import hashlib
import json
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pulseline.llm import bpe, catalog, packing, sharding
from pulseline.llm.common import table

SF = "/root/testdata/sf0.001"
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def codec():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        return bpe.Codec(file.read(), PATTERN)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in table(spark, SF, "documents").select("doc_id", "text").collect()}


def ids(raw):
    return np.frombuffer(raw, "<i4").tolist()


def encoded(codec, words):
    flat, count = codec.encode(words)
    return [part.tolist() for part in np.split(flat, np.cumsum(count)[:-1])]


def test_shared_queue_equals_the_library(codec, library):
    rng = random.Random(3)
    words = ["".join(rng.choice("aaabé 中!0n\n\t'sd") for _ in range(rng.randint(0, 70))) for _ in range(1500)]
    words += ["a" * k for k in range(1, 70)] + ["ab" * k for k in range(1, 40)]
    assert encoded(codec, words) == [library.encode_ordinary(w) for w in words]


def test_long_pieces_equal_the_library(codec, library):
    rng = random.Random(5)
    for piece in ["a" * 20_000, "na" * 9_001, "".join(rng.choice("abcdefgh") for _ in range(60_000)), "é" * 3000]:
        assert bpe.merge(piece.encode(), codec.ranks) == library._encode_single_piece(piece.encode())


def test_lower_rank_that_comes_up_goes_first():
    # joining b and c (rank 300) makes a·bc, which is token abc of rank 290
    ranks = {bytes([b]): b for b in range(256)}
    ranks.update({b"abc": 290, b"bc": 300, b"bca": 310, b"cb": 295})
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    merger = bpe.Merger(ranks)
    for text in ["abc", "abcabc", "bcabc", "aabcbcabca", "abcbc" * 12]:
        want = library._encode_single_piece(text.encode())
        assert bpe.merge(text.encode(), ranks) == want
        assert ids(merger([b"x", text.encode()])[1]) == want


def test_forgetting_does_not_change_ids(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 5)
    monkeypatch.setattr(bpe, "TAKEN", 2)
    words = [f"word{i % 7} other{i}" for i in range(40)]
    assert [encoded(codec, [w])[0] for w in words] == [library.encode_ordinary(w) for w in words]


def test_bpe_query(spark, library, texts):
    for r in catalog.op3_bpe(spark, SF).collect():
        want = library.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_bpe_nulls_and_round_trip(spark):
    data = open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb").read()
    rows = [(1, None), (2, ""), (3, "x" * 100_000), (4, "<|endoftext|> é中   \r\n"), (4, "a"), (None, "b")]
    df = spark.createDataFrame(rows, "ids long, text string")
    out = df.withColumn("e", bpe.encode(F.col("text"), data, PATTERN)).withColumn("d", bpe.decode(F.col("e"), data, PATTERN))
    got = {(r.ids, r.text): (len(r.e), bytes(r.d).decode()) for r in out.collect()}
    assert len(got) == len(rows) and all(d == (t or "") for (_, t), (_, d) in got.items())
    assert got[(1, None)][0] == 0 and got[(2, "")][0] == 0
    assert df.limit(0).withColumn("e", bpe.encode(F.col("text"), data, PATTERN)).count() == 0


def check_packing(pieces, texts, capacity=2048, tok=None):
    tok = tok or Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs, seqs = defaultdict(list), defaultdict(list)
    for r in pieces:
        docs[r.doc_id].append(r)
        seqs[r.sequence_id].append((r.offset, r.length))
    assert set(docs) == set(texts)
    for key, text in texts.items():
        want = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(docs[key], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(want[at:at + r.length].tobytes())
            at += r.length
        assert at == len(want)
    padding = total = 0
    for spans in seqs.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
        total += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding / total


def test_packing_query(spark, texts):
    assert check_packing(catalog.op4_pack(spark, SF).collect(), texts) < 0.02


def test_packing_edge_cases(spark):
    spec = open(public_tokenizers.path("byte_bpe_50k.json")).read()
    texts = {1: None, 2: "", 3: "word " * 30_000, 4: "a <|endoftext|> b", 5: "x" * 9000, None: "no id"}
    df = spark.createDataFrame([(k, t, 1) for k, t in texts.items()], "doc_id long, text string, start int")
    out = packing.pack_documents(df, spec, PATTERN).withColumn("ids_crc32", F.crc32("ids"))
    check_packing(out.collect(), texts)
    assert packing.pack_documents(df.limit(0), spec, PATTERN).count() == 0


def other_files():
    """The given tokenizer file with one thing changed that changes ids."""
    spec = open(public_tokenizers.path("byte_bpe_50k.json")).read()

    def changed(change):
        data = json.loads(spec)
        change(data)
        return json.dumps(data)

    def swap(data):   # two tokens exchange their ids; their merges stay where they are
        vocab = data["model"]["vocab"]
        vocab["he"], vocab["Ġt"] = vocab["Ġt"], vocab["he"]

    return {"ids": changed(swap), "prefix": changed(lambda d: d["pre_tokenizer"].update(add_prefix_space=True)),
            "lower": changed(lambda d: d.update(normalizer={"type": "Lowercase"})),
            "merges": changed(lambda d: d["model"].update(merges=d["model"]["merges"][:300])),
            "whole": changed(lambda d: d["model"].update(ignore_merges=True)),
            "cut": changed(lambda d: d.update(normalizer={"type": "NFC"}, truncation={
                "direction": "Right", "max_length": 9, "strategy": "LongestFirst", "stride": 0}))}


@pytest.mark.parametrize("name", ["ids", "prefix", "lower", "merges", "whole", "cut"])
def test_packing_by_a_file_that_does_not_merge_by_rank(name):
    spec, text = other_files()[name], "The weather, then THE heat: cafe\u0301 " * 30
    vocabulary = packing.Vocabulary.read(spec, PATTERN)
    assert not vocabulary.ranked
    tok = Tokenizer.from_str(spec)
    tok.no_truncation()
    assert list(packing.encoder(vocabulary)(text)) == tok.encode(text, add_special_tokens=False).ids


def test_the_given_file_merges_by_rank():
    spec = open(public_tokenizers.path("byte_bpe_50k.json")).read()
    assert packing.Vocabulary.read(spec, PATTERN).ranked
    assert not packing.Vocabulary.read(spec, r"\S+|\s+").ranked


def test_packing_a_column_by_another_file(spark):
    df = spark.createDataFrame([(1, "The heat"), (2, None), (3, "the " * 3000)], "doc_id long, text string")
    spec = other_files()["lower"]
    out = packing.pack_documents(df, spec, PATTERN).withColumn("ids_crc32", F.crc32("ids"))
    check_packing(out.collect(), {r.doc_id: r.text for r in df.collect()}, tok=Tokenizer.from_str(spec))


def test_pack_run_is_cost_balanced():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 400, 3000).tolist()
    placed, count = packing.pack_run(lengths, 2048)
    cost, used, seen = np.zeros(count), np.zeros(count, int), defaultdict(int)
    for i, start, n, seq, offset in placed:
        assert offset == used[seq]
        used[seq] += n
        cost[seq] += n + n * n / 2048
        seen[i] += n
    assert count == -(-sum(lengths) // 2048) and (used <= 2048).all()
    assert [seen[i] for i in range(len(lengths))] == lengths
    assert cost[:-1].std() / cost.mean() < 0.1
    assert packing.pack_run([], 2048) == ([], 0)


def test_pack_run_splits_into_runs(spark):
    spec = open(public_tokenizers.path("byte_bpe_50k.json")).read()
    texts = {i: f"some words {i} " * (i % 50) for i in range(200)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    out = packing.pack_documents(df, spec, PATTERN, run=16).withColumn("ids_crc32", F.crc32("ids"))
    check_packing(out.collect(), texts)


def plain_jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash():
    keys = np.random.default_rng(1).integers(0, 2**63, 2000).astype(np.uint64)
    for shards in (1, 2, 16, 17, 1000):
        got = sharding.jump_hash(keys, shards)
        assert got.tolist() == [plain_jump(int(k), shards) for k in keys]
    a, b = sharding.jump_hash(keys, 16), sharding.jump_hash(keys, 17)
    assert ((a == b) | (b == 16)).all() and 0.03 < (a != b).mean() < 0.09


def check_shards(rows, shards=16):
    slots, homes = defaultdict(list), {}
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "key" and r.grown_shard in (r.shard, shards) and 0 <= r.shard < shards
        assert homes.setdefault(r.doc_id, r.shard) == r.shard
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shard_query(spark, texts):
    rows = catalog.op5_shard(spark, SF).collect()
    check_shards(rows)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))


def test_shard_edge_cases(spark):
    rows = [(i % 3, "same é", i) for i in range(60)] + [(None, None, 1), (None, "", 2), (7, "long " * 50_000, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int").repartition(4)
    got = sharding.shard_manifest(df).collect()
    assert len(got) == len(rows)
    check_shards(got)
    assert {r.size for r in got if r.doc_id is None} == {1}
    assert sharding.shard_manifest(df.limit(0)).count() == 0
    assert sharding.with_shard(df.drop("shard"), "doc_id", 5).columns == ["doc_id", "text", "shard"]
