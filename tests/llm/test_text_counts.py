"""Counts of whole texts and the learned quality rules."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulseline.llm import quality_rules, textstats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += line in seen and bool(WORD.search(line))
        seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


def counted(texts):
    found = textstats.count(pa.array(texts, pa.string()))
    return list(zip(*(found[c].tolist() for c in
                      ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n\t #中", max_size=60), max_size=6))
def test_counts_equal_the_plain_version(texts):
    assert counted(texts) == [plain(t) for t in texts]


def test_long_words_long_texts_and_nulls():
    texts = [None, "", " \n ", "x" * 300 + " " + "x" * 300 + " " + "x" * 299, "a b c " * 50_000,
             "same\nsame\n\n\nsame", "a\x85b c d"]
    assert counted(texts) == [plain(t or "") for t in texts]


def test_slices_do_not_change_counts(monkeypatch):
    texts = ["a b c a b c", "", "b c", "a b c d"] * 20
    whole = counted(texts)
    monkeypatch.setattr(textstats, "SLICE", 5)
    assert counted(texts) == whole


def test_words_do_not_run_over_rows():
    assert counted(["ab", "cd", "ab cd"]) == [plain("ab"), plain("cd"), plain("ab cd")]


def rule_table(n=600, seed=1):
    rng = np.random.default_rng(seed)
    x = {name: rng.random(n) for name in quality_rules.FEATURES}
    bad = (x["symbol_share"] > 0.7) & (x["word_length"] < 0.5)
    return x, bad | (x["exclaim_share"] > 0.95)


def test_rules_cover_the_bad_rows():
    x, bad = rule_table()
    rules = quality_rules.learn(x, bad)
    hit = np.zeros(len(bad), bool)
    for rule in rules:
        hit |= quality_rules._covers(rule, x)
    assert 1 <= len(rules) <= quality_rules.MAX_RULES
    assert (hit == bad).mean() > 0.97 and (hit & ~bad).mean() < 0.01


@pytest.mark.parametrize("value", [True, False])
def test_one_class_needs_no_rules(value):
    x, bad = rule_table()
    rules = quality_rules.learn(x, np.full(len(bad), value))
    assert rules == []


def test_rules_in_spark(spark):
    good = " ".join(f"word{i}" for i in range(80))
    junk = " ".join(f"w{i}***" for i in range(80))
    rows = [(i, junk if i % 4 == 0 else good + f" {i}", "x") for i in range(120)]
    rows += [(900, None, "x"), (901, "", "x"), (902, "a b c " * 40, "x"), (None, good, "x"), (1, good + " 1", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    labels = spark.createDataFrame([(i, 0 if i % 4 == 0 else 1) for i in range(100)] + [(1, 1), (None, 0), (5, None)],
                                   "doc_id long, quality int")
    rules = quality_rules.fit(docs, labels)
    out = quality_rules.judge(docs, rules).collect()
    assert len(out) == len(rows)
    for r in out:
        if r.doc_id is not None and r.doc_id < 900:
            assert r.kept == (r.doc_id % 4 != 0) and not r.base_failed
        elif r.doc_id is not None:
            assert r.base_failed and not r.kept
    kept = quality_rules.filter_documents(docs, rules)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in out if r.kept)
    none = quality_rules.fit(docs.limit(0), labels)
    assert none == [] and quality_rules.judge(docs.limit(0), none).count() == 0
