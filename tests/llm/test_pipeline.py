"""The pipeline's stages."""

import corpus_pipeline
import pytest

from pulseline.llm import near_dedup, secrets
from pulseline.llm.common import staged, table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), "test")
        out.append(docs)
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").distinct().collect()}


def test_stages(spark, outputs):
    docs = table(spark, SF, "documents")
    before = [docs, *outputs]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "quality classifier", "near duplicates", "secrets", "packing"]
    for a, b in zip(before, outputs[:-1]):
        assert b.columns == a.columns and ids(b) <= ids(a)
    good = {r.doc_id for r in table(spark, SF, "labels").filter("quality = 1").collect()}
    long = {r.doc_id for r in docs.collect() if len((r.text or "").split()) >= 50}
    assert len(good & long & ids(outputs[1])) > 0.97 * len(good & long)      # clean ones stay
    bad = {r.doc_id for r in table(spark, SF, "labels").filter("quality = 0").collect()}
    assert len(bad & ids(outputs[1])) < 0.1 * len(bad)
    assert ids(outputs[4]) == ids(outputs[3]) == ids(outputs[2])


def test_one_of_each_group_stays(outputs):
    groups = near_dedup.near_duplicates(outputs[1]).collect()
    assert ids(outputs[2]) == {r.component_id for r in groups}
    assert all(r.kept for r in near_dedup.near_duplicates(outputs[2]).collect())


def test_secrets_are_masked(outputs):
    spans = {r.doc_id for r in secrets.find_secrets(outputs[2]).filter("spans <> ''").collect()}
    after = {r.doc_id: r for r in outputs[3].collect()}
    before = {r.doc_id: r for r in outputs[2].collect()}
    assert spans
    for key, row in after.items():
        assert (row.text != before[key].text) == (key in spans) and row.n_chars == len(row.text)
        assert (row.lang, row.source) == (before[key].lang, before[key].source)
    assert secrets.find_secrets(outputs[3]).filter("n_access + n_hex > 0").count() == 0


def test_odd_rows(spark):
    words = " ".join(f"word{i}" for i in range(80))
    rows = [(1, words, "x"), (1, words, "x"), (2, words, "x"), (None, words, "x"), (None, words, "x"), (4, None, "x"), (5, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    out = corpus_pipeline.without_copies(spark, docs, SF)
    assert out.columns == docs.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "4", "5", "None", "None"]
    assert corpus_pipeline.without_secrets(spark, docs, SF).count() == len(rows)
    a, b, c = (" ".join(f"{x}{i}" for i in range(80)) for x in "abc")
    mixed = [(3, a), (5, a), (5, b), (9, c), (7, None), (7, ""), (5, b), (None, a), (11, c + " more"), (2, "d e")]
    docs = spark.createDataFrame(mixed, "doc_id long, text string")
    out = [tuple(r) for r in corpus_pipeline.without_copies(spark, docs, SF).collect()]
    assert sorted(out, key=str) == sorted([(3, a), (5, b), (9, c), (7, None), (7, ""), (None, a), (2, "d e")], key=str)
    docs = spark.createDataFrame([(3, a), (5, a), (9, c), (None, a)], "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in corpus_pipeline.without_copies(spark, docs, SF).collect()) == ["3", "9", "None"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
