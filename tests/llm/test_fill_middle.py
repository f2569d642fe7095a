"""Fill-in-middle against a plain version, and the rank index against the positions themselves."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulseline.llm import fill_middle

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(key, text, p=fill_middle.Params()):
    text = text or ""
    tokens = TOKEN.findall(text)
    if key is None:
        return len(tokens), "plain", None, None, text
    digest = hashlib.sha256(f"{p.seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= p.rate:
        return len(tokens), "plain", None, None, text
    x, y, z = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < p.spm:
        return len(tokens), "spm", len(x), len(y), f"<S>{z}<P>{x}<M>{y}"
    return len(tokens), "psm", len(x), len(y), f"<P>{x}<S>{z}<M>{y}"


TEXTS = [None, "", " ", "\n \t", "word", " word", "word ", "a b  c\n\nd\x0be\x0cf\rg ", "é中 𝄞 x   y", "with <P> marker",
         "<S>", "<M> x", "< P> <p> <", "$1 \\2 $ (a) < <S < >", "x" * 100_000, "many words " * 30_000, " " * 70_000 + "end",
         "tail" + " " * 70_000, "a <\nb <P c"]


def check(spark, rows, params):
    docs = spark.createDataFrame([(k, t, "x", 0, "y") for k, t in rows], "doc_id long, text string, form string, n int, output string")
    out = fill_middle.fill_in_middle(docs, params=params)
    got = out.select("*", fill_middle.restore(F.col("output"), F.col("form")).alias("back")).collect()
    assert len(got) == len(rows)
    want = sorted((str(k), *map(str, plain(k, t, params)), t or "") for k, t in rows)
    assert sorted((str(r.doc_id), str(r.n), r.form, str(r.prefix_chars), str(r.middle_chars), r.output, r.back) for r in got) == want
    return {r.form for r in got}


def test_against_a_plain_version(spark):
    rows = [(k * 100 + i, t) for i, t in enumerate(TEXTS) for k in range(6)] + [(None, "a b"), (7, "a b"), (7, "a b"), (-3, "a b c")]
    assert check(spark, rows, fill_middle.Params()) == {"plain", "spm", "psm"}
    assert check(spark, rows, fill_middle.Params(seed=1, rate=100, spm=0)) == {"plain", "psm"}
    assert check(spark, [], fill_middle.Params()) == set()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\x0baé中𝄞<P>", max_size=40), max_size=8))
def test_boundaries(texts):
    import pyarrow as pa
    raw, offsets = fill_middle.text_bytes(pa.array(texts, pa.string()))
    positions, rank = fill_middle.boundaries(raw, offsets)
    want = []
    for t, at in zip(texts, offsets.tolist()):
        want.append(at)
        for m in TOKEN.finditer(t):
            want.append(at + len(t[:m.end()].encode()))
    assert positions.tolist() == want
    assert np.diff(rank).tolist() == [1 + len(TOKEN.findall(t)) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=1500), st.integers(0, 126))
def test_index_is_exact_and_its_residuals_bounded(steps, error):
    positions = np.cumsum(np.array(steps, np.int64)) if steps else np.zeros(0, np.int64)
    index = fill_middle.RankIndex(positions, error)
    ranks = np.arange(len(positions))
    assert index.position(ranks).tolist() == positions.tolist()
    assert np.abs(index.residual.astype(int)).max(initial=0) <= error + 1


def test_segments_are_far_fewer_than_boundaries():
    steps = np.random.default_rng(3).integers(1, 12, 200_000)
    index = fill_middle.RankIndex(np.cumsum(steps))
    assert len(index.first) < 2_000 and index.residual.dtype == np.int8
    line = fill_middle.RankIndex(np.arange(0, 10_000_000, 5))
    assert len(line.first) == 1 and not line.residual.any()
    with pytest.raises(ValueError):
        fill_middle.RankIndex(np.arange(3), 127)


def test_key_alone_decides_and_ids_may_be_text(spark):
    docs = spark.createDataFrame([("a-1", "one two three four"), ("b", "one two")], "doc_id string, text string")
    got = {r.doc_id: r.output for r in fill_middle.fill_in_middle(docs, params=fill_middle.Params(rate=100)).collect()}
    assert got == {k: plain(k, t, fill_middle.Params(rate=100))[4] for k, t in [("a-1", "one two three four"), ("b", "one two")]}
    again = fill_middle.fill_in_middle(docs.repartition(3), params=fill_middle.Params(rate=100)).collect()
    assert {r.doc_id: r.output for r in again} == got
