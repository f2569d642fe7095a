"""Near duplicates, vector links and components against brute force."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from pulseline.llm import catalog, embedding_dedup, near_dedup
from pulseline.llm.common import table
from pulseline.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    links += [(1000 + i, 1001 + i) for i in range(70)] + [(2000, 2000 + i) for i in range(1, 50)] + [(5, 5)]
    want = components({n for a, b in links if a != b for n in (a, b)}, links)
    df = spark.createDataFrame(links, "a long, b long")
    assert {r.node: r.component for r in connected_components(df).collect()} == want
    assert connected_components(df.limit(0)).count() == 0


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) or frozenset([tuple(words)])


def check_groups(rows, texts, k):
    sets = {i: shingles(t, k) for i, t in texts.items()}
    keys = [i for i in sets if i is not None and sets[i]]
    links = [(a, b) for x, a in enumerate(keys) for b in keys[:x]
             if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = components([i for i in sets if i is not None], links)
    assert len(rows) == len(texts)
    for r in rows:
        assert r.n_shingles == len(sets[r.doc_id])
        if r.doc_id is not None:
            assert r.component_id == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    return links


def test_near_duplicates_query(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    assert check_groups(catalog.op7_near_duplicates(spark, SF).collect(), texts, 2)


def test_near_duplicates_edge_cases(spark):
    rng = random.Random(4)
    base = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    texts = {1: None, 2: "", 3: " \n", 4: "One", 5: "one", 6: "one two", 7: "ONE  two\n", 8: " ".join(base), 9: "x " * 30_000}
    for i in range(10, 60):  # near copies of near copies: chains
        base = list(base)
        base[rng.randrange(len(base))] = f"n{i}"
        texts[i] = " ".join(base)
    for i in range(60, 90):  # exact copies, and one passage inside other texts
        texts[i] = texts[8].upper() if i % 2 else " ".join(f"p{i}-{j}" for j in range(60)) + " " + texts[8]
    texts[None] = texts[8]
    df = spark.createDataFrame([(k, t, "x") for k, t in texts.items()], "doc_id long, text string, n string")
    found = near_dedup.near_duplicates(df, near_dedup.Params(words=2)).collect()
    assert check_groups(found, texts, 2)
    lone = [r for r in found if r.doc_id is None]
    assert lone[0].component_id is None and lone[0].kept
    twice = near_dedup.near_duplicates(df.filter("doc_id < 12").unionByName(df.filter("doc_id < 12")), near_dedup.Params(words=2))
    assert check_groups({r.doc_id: r for r in twice.collect()}.values(), {k: t for k, t in texts.items() if k and k < 12}, 2)
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def test_pairs_across_components_of_a_bucket(spark):
    """A chain whose bucket heads reach only part of it keeps all its links."""
    rng = random.Random(9)
    texts, words = {}, [f"w{i}" for i in range(200)]
    for i in range(120):
        texts[1000 - i] = " ".join(words)
        for _ in range(3):
            words[rng.randrange(200)] = f"c{i}-{rng.randrange(99)}"
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check_groups(near_dedup.near_duplicates(df, near_dedup.Params(words=2)).collect(), texts, 2)


def test_sketch_estimates_and_merges():
    p = near_dedup.Params()
    rng = np.random.default_rng(1)
    errors = []
    for similarity in (0.2, 0.5, 0.8, 0.95):
        for size in (60, 900):
            both = int(size * similarity)
            pool = rng.integers(0, 2**63, 2 * size).astype(np.uint64)
            a, b = pool[:size], np.concatenate([pool[:both], pool[size:2 * size - both]])
            true = both / (2 * size - both)
            ra, rb = near_dedup.sketch(a, p), near_dedup.sketch(b, p)
            union = near_dedup.sketch(np.union1d(a, b), p)
            assert (np.maximum(ra, rb) == union).all()
            found = near_dedup.estimate(ra[None], rb[None], np.array([float(size)]), np.array([float(size)]), p)[0]
            errors.append(abs(found - true))
    assert max(errors) < 0.12 and np.mean(errors) < 0.05


def test_shingle_sets_do_not_depend_on_slices(monkeypatch):
    texts = pa.array(["a b c", None, "B a b", "", "a", "x " * 50])
    whole = near_dedup.shingle_sets(texts, 2)
    monkeypatch.setattr(near_dedup, "SLICE", 3)
    again = near_dedup.shingle_sets(texts, 2)
    assert all((x == y).all() for x, y in zip(whole, again)) and [len(s) for s in whole] == [2, 0, 2, 0, 1, 1]


def check_vectors(rows, vectors, cosine=0.9):
    ok = [i for i, v in vectors.items() if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {i: np.array(vectors[i], float) / np.linalg.norm(np.array(vectors[i], float)) for i in ok}
    links = [(a, b) for x, a in enumerate(ok) for b in ok[:x] if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine]
    want, n = components(list(vectors), links), defaultdict(int)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    assert len(rows) == len(vectors)
    for r in rows:
        assert (r.n_links, r.component_id, r.kept) == (n[r.vec_id], want[r.vec_id], want[r.vec_id] == r.vec_id)


def clustered(rng, n, dim=12):
    centres = rng.normal(size=(6, dim))
    out = {}
    for i in range(n):
        way = i % 4
        if way == 0:
            out[i] = rng.normal(size=dim).tolist()
        elif way == 1:  # a large tight group
            out[i] = (centres[0] + rng.normal(size=dim) * 0.05).tolist()
        elif way == 2:  # loose groups around the limit
            out[i] = (centres[1 + i % 5] + rng.normal(size=dim) * 0.35).tolist()
        else:           # copies
            out[i] = centres[5].tolist()
    return out


@pytest.mark.parametrize("item, block", [("float", 8192), ("double", 40)])
def test_vector_links(spark, item, block):
    vectors = {i: [float(np.float32(x)) for x in v] for i, v in clustered(np.random.default_rng(3), 700).items()}
    vectors.update({5000: None, 5001: [], 5002: [0.0] * 12, 5003: [None] + [1.0] * 11, 5004: [float("nan")] * 12,
                    5005: [float("inf")] + [1.0] * 11, 5006: [1.0, 0.0], 5007: [2.0, 0.1], 5008: [1e-20] * 12, 5009: [3.0] * 12})
    df = spark.createDataFrame([(i, v, 1) for i, v in vectors.items()], f"vec_id long, embedding array<{item}>, n int")
    check_vectors(embedding_dedup.near_duplicate_vectors(df, block=block).collect(), vectors)


def test_tight_groups_meet_only_what_is_near(spark, monkeypatch):
    """Mixed vectors: half in tight groups, half in random directions."""
    rng = np.random.default_rng(1)
    n, dim = 6_000, 64
    centres = rng.normal(size=(20, dim))
    tight = centres / np.linalg.norm(centres, axis=1, keepdims=True)
    x = np.concatenate([tight[np.arange(n // 2) % 20] + 0.02 * rng.normal(size=(n // 2, dim)), rng.normal(size=(n - n // 2, dim))])
    sent = {}
    real = embedding_dedup.staged
    monkeypatch.setattr(embedding_dedup, "staged", lambda df, name: sent.setdefault(name, real(df, name)))
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    rows = embedding_dedup.near_duplicate_vectors(df, block=500).collect()
    assert sum(r.n_links for r in rows) == 20 * 150 * 149 and sum(r.kept for r in rows) == 20 + n // 2
    cells = {r.rep: r.cell for r in sent["cells"].collect()}
    visits = sent["visits"].collect()
    blocks = 20 + -(-n // 2 // 500)
    grouped = [v for v in visits if cells[v.rep] >= 0]
    assert sum(c >= 0 for c in cells.values()) == n // 2
    assert len(grouped) < 0.05 * (n // 2) * blocks and len(visits) < 3.5 * n


def test_two_full_blocks_need_memory_in_proportion(monkeypatch):
    import tracemalloc
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1, 16)) + 0.02 * rng.normal(size=(2 * embedding_dedup.BLOCK, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    left, right = x[:embedding_dedup.BLOCK], x[embedding_dedup.BLOCK:]
    w = np.ones(embedding_dedup.BLOCK)
    tracemalloc.start()
    n, links = embedding_dedup.meet(left, right, w, w, False, 0.9)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (n == embedding_dedup.BLOCK).all() and (links.heads(np.arange(len(n))) == 0).all()
    assert peak < 300e6


def test_a_text_id_fails_instead_of_vanishing(spark):
    from pulseline.llm import line_dedup, sharding
    docs = spark.createDataFrame([("a-1", "some text")], "doc_id string, text string")
    vectors = spark.createDataFrame([("a-1", [1.0, 0.0])], "vec_id string, embedding array<float>")
    for run in (lambda: near_dedup.near_duplicates(docs), lambda: sharding.shard_manifest(docs).collect(),
                lambda: line_dedup.drop_repeated_lines(docs).collect(),
                lambda: embedding_dedup.near_duplicate_vectors(vectors).collect()):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            run()


def test_vector_query(spark):
    vectors = {r.vec_id: list(r.embedding) for r in table(spark, SF, "embeddings").collect()}
    check_vectors(catalog.op9_embedding_links(spark, SF).collect(), vectors)


def test_vectors_without_id_and_repeated(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.01])], "vec_id long, embedding array<float>")
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicate_vectors(df).collect()))
    assert got == [(0, 0, None, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]
    assert embedding_dedup.near_duplicate_vectors(df.limit(0)).count() == 0


def test_block_links_equal_brute_force():
    rng = random.Random(3)
    base = list(range(60))
    sets = [np.array(sorted(set(rng.sample(base, rng.randint(44, 60)) + [rng.randrange(10**6) for _ in range(rng.randint(0, 9))])), np.uint64)
            for _ in range(50)]
    component = np.array([rng.randrange(6) for _ in sets])
    left, right = np.arange(0, 20), np.arange(10, 50)
    found = near_dedup.block_links(sets, component, left, right, 80)
    want = {(i, component[j]) for i in left for j in right if component[i] != component[j]
            and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert {(i, component[j]) for i, j in found} == want and len(found) == len(want) > 5


@pytest.mark.parametrize("small, block, items", [(2, 7, 1 << 21), (2, 1024, 900), (2, 1024, 1 << 21), (10_000, 1024, 1)])
def test_bucket_paths_agree(spark, monkeypatch, small, block, items):
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "BLOCK_ITEMS", items)
    rng = random.Random(6)
    base, texts = [f"w{i}" for i in range(90)], {}
    for i in range(130):
        words = list(base)
        for _ in range(rng.randint(1, 9)):
            words[rng.randrange(90)] = f"c{rng.randrange(400)}"
        texts[i] = " ".join(words)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check_groups(near_dedup.near_duplicates(df, near_dedup.Params(words=2)).collect(), texts, 2)


def test_id_filter_has_no_false_negatives(spark):
    ids = spark.range(0, 200_000, 7).withColumnRenamed("id", "rep")
    words = near_dedup._id_bits(ids, "rep", 1 << 20)
    found = spark.range(200_000).filter(near_dedup._maybe_in(words, "id"))
    assert found.filter("id % 7 = 0").count() == ids.count()
    assert found.count() < 1.01 * ids.count()
    assert not near_dedup._id_bits(ids.limit(0), "rep", 1 << 20).any()
