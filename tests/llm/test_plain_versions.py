"""Verdicts, links and labels against plain evaluations of what the operators state."""

import random
import re

import numpy as np
import pytest

from pulseline.llm import catalog, html_text, quality_rules, secrets
from pulseline.llm.common import table

SF = "/root/testdata/sf0.001"
share = lambda a, b: a / b if b else 0.0
FEATURES = {
    "symbol_share": lambda r: share(r.n_symbols, r.word_chars), "upper_share": lambda r: share(r.n_upper, r.word_chars),
    "exclaim_share": lambda r: share(r.n_exclaim, r.word_chars), "digit_share": lambda r: share(r.n_digits, r.word_chars),
    "repeat_share": lambda r: share(r.n_repeat_words, r.n_words), "echo_share": lambda r: share(r.n_echo_words, r.n_words),
    "dup_line_share": lambda r: share(r.n_dup_lines, r.n_lines), "word_length": lambda r: share(r.word_chars, r.n_words),
    "line_words": lambda r: share(r.n_words, r.n_lines),
}


def test_verdict_is_the_first_rule_that_holds(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    rules = quality_rules.fit(docs, table(spark, sf, "labels"))
    assert rules
    rows = quality_rules.judge(docs, rules).collect()
    want = {}
    for r in rows:
        base = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        hit = any(all((FEATURES[c.feature](r) >= c.threshold) == c.above for c in rule) for rule in rules)
        assert r.base_failed == base and r.kept == (not base and not hit)
        want[r.doc_id] = (r.base_failed, r.kept)
    assert any(not b and not k for b, k in want.values()) and any(k for _, k in want.values())
    assert {r.doc_id: (r.base_failed, r.kept) for r in catalog.op1_quality_rules(spark, sf).collect()} == want


def test_only_labelled_texts_are_counted_to_learn(spark, monkeypatch):
    plans = []
    real = quality_rules.staged
    monkeypatch.setattr(quality_rules, "staged", lambda df, name: (plans.append(
        df._jdf.queryExecution().executedPlan().toString()), real(df, name))[1])
    quality_rules.fit(table(spark, SF, "documents"), table(spark, SF, "labels"))
    assert len(plans) == 1 and "Join" in plans[0] and "Python" not in plans[0]


def parts_of(text):
    """(kind, start, end) of all parts, and the innermost block of a span."""
    found = []
    for k, (pattern, group, least) in enumerate(secrets.PARTS.values()):
        for m in re.finditer(pattern, text, re.ASCII):
            if len(m.group(group)) >= least:
                found.append((k, m.start(), m.end()))
    blocks = [(m.start(), m.end()) for m in re.finditer(r"\{[^{}]*+\}", text)]
    return found, blocks


def plain_spans(text, scope=secrets.SCOPE):
    found, blocks = parts_of(text)
    names = list(secrets.PARTS)
    base = [p for p in found if p[0] < 3]
    weak = [p for p in found if p[0] >= 3 and not any(b[1] <= p[1] and p[2] <= b[2] for b in base)]

    def block(p):
        before = [b for b in blocks if b[0] <= p[1]]
        return before[-1][0] if before and p[2] <= before[-1][1] else None

    def near(p, kinds, own=False):
        for q in base + weak:
            if q[0] in kinds and (own or q[0] >= 3 or q[1] >= p[2] or p[1] >= q[2]):
                if q[1] - p[2] <= scope and p[1] - q[2] <= scope or block(p) is not None and block(p) == block(q):
                    return True
        return False

    ids, keys = (1, 3), (0, 2, 4)
    out = list(base)
    for p in weak:
        if p[0] == 3 and near(p, keys) or p[0] == 4 and near(p, ids) or p[0] == 5 and near(p, ids, True) and near(p, keys, True):
            out.append(p)
    return ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted((a, k, b) for k, a, b in out))


def random_text(rng):
    pick = {
        "access": lambda: "AKIA" + "".join(rng.choices("ABCDEFGH12345", k=rng.randint(12, 22))),
        "ident": lambda: "".join(rng.choices("QWERTYUIOP1234567", k=rng.randint(14, 70))),
        "blob": lambda: "".join(rng.choices("aBcD3f+/_-Gh1", k=rng.randint(28, 60))),
        "hex": lambda: "".join(rng.choices("0123456789abcdef", k=rng.randint(20, 40))),
        "assign": lambda: rng.choice(["password = ", "token:", 'api_key="', "SECRET="]) + "".join(rng.choices("abcXYZ019", k=rng.randint(4, 12))),
        "url": lambda: "https://host.example/" + rng.choice(["", "x?token=abcdef1", "AKIA" + "B" * 16, "p/" + "aB3" * 12]),
        "gap": lambda: " ".join(rng.choices(["word", "text", "é", "中"], k=rng.choice([1, 3, 30, 90]))),
        "brace": lambda: rng.choice(["{", "}", "{ ", " }"]),
    }
    kinds = rng.choices(list(pick), weights=[2, 3, 3, 1, 1, 3, 6, 4], k=rng.randint(1, 14))
    return rng.choice([" ", "\n", " , "]).join(pick[k]() for k in kinds)


def test_links_equal_a_plain_linker(spark):
    rng = random.Random(8)
    texts = [random_text(rng) for _ in range(500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = {r.doc_id: r.spans for r in secrets.find_secrets(docs).collect()}
    want = {i: plain_spans(t) for i, t in enumerate(texts)}
    assert rows == want
    kinds = " ".join(want.values())
    assert all(kinds.count(k) > 10 for k in ("ident:", "blob:", "endpoint:"))
    # candidates left alone as well
    assert sum(len(parts_of(t)[0]) for t in texts) > sum(s.count(":") // 2 for s in want.values()) + 100
    masked = {r.doc_id: r.text for r in secrets.mask_secrets(docs).collect()}
    assert all((masked[i] != texts[i]) == bool(want[i]) for i in masked)


def test_registered_secrets(spark):
    docs = table(spark, SF, "documents").collect()
    rows = {r.doc_id: r for r in catalog.op2_secrets(spark, SF).collect()}
    assert {i: r.spans for i, r in rows.items()} == {d.doc_id: plain_spans(d.text or "") for d in docs}


def test_article_without_named_containers(spark):
    """Every container a plain div, no class, id or role: the network has only shape and words."""
    from tests.llm.test_html import article
    pages = [r.html for r in table(spark, "/root/testdata/sf0.01", "pages").orderBy("page_id").collect()]
    model = html_text.learn(pages[:150])

    def bare(page):
        page = re.sub(r"<(/?)(?:article|main|nav|footer|header|aside|section|form)\b", r"<\1div", page)
        return re.sub(r"\s(?:class|id|role)\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]+)", "", page)

    rest = pages[150:]
    found = html_text.main_texts(model, [bare(p) for p in rest])
    assert np.mean([f == article(p) for f, p in zip(found, rest)]) > 0.9


@pytest.mark.parametrize("name", ["op3_bpe", "op13_fill_middle"])
def test_one_row_a_document(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() == table(spark, SF, "documents").count()
