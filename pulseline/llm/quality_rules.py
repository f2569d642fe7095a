"""Quality rules as a learned decision list (operator 1).

Sequential covering over labelled statistics: each rule is grown one
threshold condition at a time by information gain on part of the sample,
pruned on the rest, and its rows are removed before the next rule. The
result is an ordered list of readable conjunctions that becomes one Spark
conditional expression: the first rule that holds rejects, a row that no
rule covers is kept.

Defined results: a null text has no words and fails the base rule. Without
labelled rows, or without rejected ones, the list is empty and keeps all
that pass the base rule. A document labelled twice counts as bad if any
label says so.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseline.llm.common import staged
from pulseline.llm.textstats import COUNTS, text_counts

# labelled documents the rules are learned from, at most
SAMPLE = 20_000
# a rule must be this precise on the rows it was pruned on
PRECISION = 0.9
MAX_CONDITIONS = 4
MAX_RULES = 16
CUTS = 48  # candidate thresholds per feature

# name -> Spark SQL over the counts; a share of nothing is 0
FEATURES = {
    "symbol_share": "coalesce(try_divide(n_symbols, word_chars), 0D)",
    "upper_share": "coalesce(try_divide(n_upper, word_chars), 0D)",
    "exclaim_share": "coalesce(try_divide(n_exclaim, word_chars), 0D)",
    "digit_share": "coalesce(try_divide(n_digits, word_chars), 0D)",
    "repeat_share": "coalesce(try_divide(n_repeat_words, n_words), 0D)",
    "echo_share": "coalesce(try_divide(n_echo_words, n_words), 0D)",
    "dup_line_share": "coalesce(try_divide(n_dup_lines, n_lines), 0D)",
    "word_length": "coalesce(try_divide(word_chars, n_words), 0D)",
    "line_words": "coalesce(try_divide(n_words, n_lines), 0D)",
}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool       # feature >= threshold, else feature < threshold
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        values = x[self.feature]
        return values >= self.threshold if self.above else values < self.threshold

    def sql(self) -> str:
        return f"({FEATURES[self.feature]}) {'>=' if self.above else '<'} {self.threshold!r}D"


Rule = tuple[Condition, ...]


def base_failed() -> Column:
    """Too short, or mostly repeated three-word windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id`` and the counts of the whole text."""
    return (docs.select("doc_id", text_counts(F.col(text).cast("string")).alias("c"))
                .select("doc_id", *[F.col(f"c.{c}").alias(c) for c in COUNTS]))


def _covers(rule: Rule, x: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(x.values()))), bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Add the condition with the highest gain until no good row is covered."""
    rule: list[Condition] = []
    live = np.ones(len(bad), bool)
    while len(rule) < MAX_CONDITIONS:
        p0, n0 = (live & bad).sum(), (live & ~bad).sum()
        if not p0 or not n0:
            break
        before = np.log2(p0 / (p0 + n0))
        best, gain = None, 0.0
        for name, values in x.items():
            seen = np.sort(np.unique(values[live]))
            if len(seen) < 2:
                continue
            cuts = (seen[1:] + seen[:-1]) / 2
            cuts = np.unique(cuts[np.linspace(0, len(cuts) - 1, CUTS).astype(int)])
            cuts = np.unique(np.concatenate([cuts, np.quantile(values[live & bad], np.linspace(0, 1, 17))]))
            for cut in cuts.tolist():
                for above in (True, False):
                    hit = live & (values >= cut if above else values < cut)
                    p, n = (hit & bad).sum(), (hit & ~bad).sum()
                    if p and p + n < p0 + n0:
                        g = p * (np.log2(p / (p + n)) - before)
                        if g > gain + 1e-12:
                            best, gain = Condition(name, above, cut), g
        if best is None:
            break
        rule.append(best)
        live &= best.holds(x)
    return tuple(rule)


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The first conditions of the rule that are worth most on other rows."""
    best, worth = rule, -2.0
    for k in range(1, len(rule) + 1):
        hit = _covers(rule[:k], x)
        p, n = (hit & bad).sum(), (hit & ~bad).sum()
        value = (p - n) / (p + n) if p + n else -1.0
        if value > worth + 1e-12:
            best, worth = rule[:k], value
    return best


def learn(x: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """The ordered rules for bad rows; every third row of the sample prunes."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    third = np.arange(len(bad)) % 3 == 2
    for _ in range(MAX_RULES):
        grow, prune = left & ~third, left & third
        part = lambda rows: {k: v[rows] for k, v in x.items()}
        if not (bad & grow).any():
            break
        rule = _grow(part(grow), bad[grow])
        if not rule:
            break
        rule = _prune(rule, part(prune), bad[prune])
        hit = _covers(rule, x) & left
        good, wrong = (hit & bad).sum(), (hit & ~bad).sum()
        if good < 2 or good < PRECISION * (good + wrong):
            break
        rules.append(rule)
        left &= ~hit
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Kept or not, as one ordered conditional over the counts."""
    out = None
    for rule in rules:
        holds = F.expr(" AND ".join(c.sql() for c in rule))
        out = F.when(holds, False) if out is None else out.when(holds, False)
    return F.lit(True) if out is None else out.otherwise(True)


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """Whole documents with a quality label, at most ``rows``, chosen by a hash of the id.

    The chosen labels are broadcast: ``rows`` bounds them to a few hundred KB.
    """
    chosen = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
                    .groupBy("doc_id").agg(F.min("quality").alias("quality"))
                    .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return docs.join(F.broadcast(chosen), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> list[Rule]:
    """Learn the rules from a bounded sample of labelled documents that pass the base rule."""
    narrow = docs.select("doc_id", "text")
    # written first, so that only these texts are counted, and once
    labelled = staged(labelled_sample(narrow, labels, rows), "labelled")
    found = labelled.select("doc_id", "quality", text_counts(F.col("text").cast("string")).alias("c"))
    found = found.select("doc_id", "quality", "c.*").filter(~base_failed())
    sample = (found.select("doc_id", "quality", *[F.expr(sql).alias(name) for name, sql in FEATURES.items()])
                   .orderBy(F.xxhash64("doc_id"), "doc_id", *FEATURES).limit(rows).toPandas())
    x = {name: sample[name].to_numpy(float) for name in FEATURES}
    return learn(x, sample["quality"].to_numpy() == 0)


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` of every document."""
    counted = with_counts(docs, text)
    return (counted.withColumn("base_failed", base_failed())
                   .withColumn("kept", ~F.col("base_failed") & verdict(rules)))


def filter_documents(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """The kept rows of ``docs``, all their columns unchanged."""
    names = docs.columns
    packed = docs.select(F.struct("*").alias("row"),
                         text_counts(F.col(text).cast("string")).alias("c"))
    kept = packed.select("row", "c.*").filter(~base_failed() & verdict(rules))
    return kept.select("row.*").toDF(*names)
