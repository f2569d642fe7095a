"""Compression score and language identification."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from pulseline.llm import catalog, language_id, quality_classifier
from pulseline.llm.common import table

SF = "/root/testdata/sf0.01"


def test_score_on_held_out_labels(spark):
    found = {r.doc_id: r for r in catalog.op8_quality_score(spark, SF).collect()}
    labels = table(spark, SF, "labels").collect()
    assert len(found) == table(spark, SF, "documents").count()
    for r in found.values():
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    right = [found[x.doc_id].predicted == x.quality for x in labels if found[x.doc_id].held_out]
    assert np.mean(right) > 0.93


def test_score_edge_cases(spark):
    docs = spark.createDataFrame([(i, ("good words here " if i % 2 else "### bad $$$ ") * 30, i) for i in range(60)]
                                 + [(100, None, 1), (101, "", 1), (None, "good words here", 1), (102, "good words here " * 20_000, 1)],
                                 "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    model = quality_classifier.fit(docs, labels)
    out = docs.select("doc_id", quality_classifier.score(docs.text, model).alias("s")).collect()
    scores = {r.doc_id: r.s for r in out}
    assert scores[100] == scores[101] and min(scores[i] for i in range(1, 60, 2)) > max(scores[i] for i in range(0, 60, 2))
    assert scores[102] > 0.3
    kept = quality_classifier.filter_documents(docs, model)
    assert kept.columns == docs.columns and kept.filter("doc_id < 60").count() == 30


@pytest.mark.parametrize("quality, low, high", [(1, 0.9, 1.0), (0, 0.0, 0.1)])
def test_score_with_one_class(quality, low, high):
    model = quality_classifier.learn([b"some text"] * 20, np.full(20, quality == 1))
    assert low <= quality_classifier.scores(model, [b"", b"text"])[0] <= high


def test_score_without_labels(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = quality_classifier.fit(docs, labels)
    assert quality_classifier.scores(model, [b"x"]).tolist() == [0.5]


def substrings(text):
    return {text[i:j] for i in range(len(text)) for j in range(i + 1, len(text) + 1)}


def test_automaton_holds_exactly_the_substrings():
    text = [2, 3, 3, 2, 3, 4, 2, 3, 3]
    moves = language_id.suffix_automaton(text)

    def accepts(word):
        state = 0
        for s in word:
            if s not in moves[state]:
                return False
            state = moves[state][s]
        return True

    known = substrings(tuple(text))
    assert all(accepts(w) for w in known)
    assert all(accepts((a, b, c)) == ((a, b, c) in known) for a in range(5) for b in range(5) for c in range(5))


def plain_phrases(text, training):
    """Longest matches, one after the other; segments begin a phrase."""
    known, count = substrings(tuple(training)), 0
    for at in range(0, len(text), language_id.SEGMENT):
        part = tuple(text[at:at + language_id.SEGMENT])
        i = 0
        while i < len(part):
            j = i + 1
            while j <= len(part) and part[i:j] in known:
                j += 1
            count += 1
            i = max(j - 1, i + 1)
    return count


def test_phrases_equal_the_plain_parse():
    rng = np.random.default_rng(4)
    texts = {"aa": ["".join(rng.choice(list("abc "), 60))], "bb": ["".join(rng.choice(list("abd "), 60))]}
    model = language_id.learn(texts)
    parser = language_id.Parser(model)
    rows = [language_id._symbols(parser.table, "".join(rng.choice(list("abcd "), n)).encode()) for n in (1, 7, 300, 40)]
    found = parser.phrases(rows)
    for r, row in enumerate(rows):
        for k, training in enumerate(model.texts):
            known = set(training)
            if all(s in known for s in row.tolist()):
                assert found[r, k] == plain_phrases(row.tolist(), list(training))


def test_language_on_held_out_rows(spark):
    docs = {r.doc_id: r.lang for r in table(spark, SF, "documents").select("doc_id", "lang").collect()}
    found = catalog.op6_language(spark, SF).collect()
    assert len(found) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in found)
    assert np.mean([r.lang_pred == docs[r.doc_id] for r in found if r.held_out]) > 0.97


def test_language_edge_cases():
    model = language_id.learn({"en": ["the cat and the dog"], "fr": ["le chat et le chien"], "xx": ["123"]})
    assert model.languages == ("en", "fr")
    parser = language_id.Parser(model)
    names, scores = parser.predict(pa.array([None, "", "12 .", "THE DOG", "le chien", "the " * 50_000, "中文"]))
    assert names[:6] == ["und", "und", "und", "en", "fr", "en"] and names[6] in model.languages
    assert scores[:3].tolist() == [0, 0, 0] and all(0 <= s <= 1 for s in scores)
    empty = language_id.Parser(language_id.learn({}))
    assert empty.predict(pa.array(["text", None]))[0] == ["und", "und"]
    assert parser.predict(pa.array([], pa.string()))[0] == []


# first letter and number of letters of several scripts
SCRIPTS = [("a", 26), ("α", 17), ("а", 32), ("ա", 38), ("א", 27), ("ა", 33), ("가", 900), ("一", 2500), ("あ", 80)]


def invented(rng, n_words):
    """36 languages, four of each script, with 300 words of their own."""
    out = {}
    for k in range(36):
        first, size = SCRIPTS[k % len(SCRIPTS)]
        letters = [c for c in map(chr, range(ord(first), ord(first) + size)) if c.isalpha()]
        words = ["".join(rng.choice(letters, rng.integers(1, 9))) for _ in range(300)]
        out[f"l{k:02}"] = [" ".join(rng.choice(words, n)) for n in n_words]
    return out


def test_many_languages_learn_as_much_as_few():
    samples = invented(np.random.default_rng(6), (4000, 8000))
    model = language_id.learn(samples)
    assert len(model.languages) == 36 and {len(t) for t in model.texts} == {language_id.SYMBOLS}
    assert set(model.letters) == {c.lower() for texts in samples.values() for c in "".join(texts) if c.isalpha()}
    assert not any(language_id.UNSEEN in t for t in model.texts)
    few = language_id.learn({"l00": samples["l00"]})
    letter = lambda m, t: ["" if s < 2 else m.letters[s - 2] for s in t]
    assert letter(few, few.texts[0]) == letter(model, model.texts[0])


def test_many_languages_and_scripts():
    rng = np.random.default_rng(7)
    samples = invented(rng, (60, 60, 30))
    parser = language_id.Parser(language_id.learn({k: v[:2] for k, v in samples.items()}))
    names, _ = parser.predict(pa.array([v[2].upper() for v in samples.values()]))
    assert names == list(samples)
    # the sparse table holds the transitions of each automaton, and no other
    texts = language_id.learn({k: v[:2] for k, v in samples.items()}).texts
    for root, text in zip(parser.roots.tolist(), texts):
        moves = language_id.suffix_automaton(text)
        for state in rng.choice(len(moves), 40):
            cell = parser.base[root + state] + np.arange(parser.width)
            held = np.flatnonzero(parser.owner[cell] == root + state).tolist()
            assert {s: parser.target[cell[s]] - root for s in held} == moves[state]


def test_unseen_letters_match_nothing():
    model = language_id.learn({"aa": ["abc ẞß İ Σς"], "bb": ["bcd"]})
    parser = language_id.Parser(model)
    row = language_id._symbols(parser.table, "ქართული".encode())
    assert set(row.tolist()) == {language_id.UNSEEN} and parser.phrases([row]).tolist() == [[8, 8]]


def test_language_fit_ignores_other_rows(spark):
    rows = [(i, "abc abc abc", "aa") for i in range(30)] + [(None, "zzz", "zz"), (40, None, "yy"), (41, "qq", None)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ("aa",)
