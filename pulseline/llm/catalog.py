"""Registered queries of the numbered operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseline.llm import (bpe, embedding_dedup, fill_middle, hard_negatives, html_text, language_id, line_dedup,
                           near_dedup, packing, quality_classifier, quality_rules, secrets, sharding)
from pulseline.llm.common import table


def _read(path: str) -> bytes:
    """A vocabulary file (1 to 2 MB), read on the driver and shipped with the tasks."""
    with open(path, "rb") as file:
        return file.read()


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the learned rules for every document."""
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op3_bpe(spark: SparkSession, sf_dir: str,
            path: str = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")) -> DataFrame:
    """Encode and decode every document; digests of both."""
    data, pattern = _read(path), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents")
    coded = docs.select("doc_id", bpe.round_trip(F.col("text"), data, pattern).alias("c"))
    return coded.select("doc_id", F.size("c.ids").cast("long").alias("n_tokens"),
                        F.sha2(F.concat_ws(",", F.col("c.ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2("c.bytes", 256).alias("decoded_sha256"))


def op4_pack(spark: SparkSession, sf_dir: str,
             path: str = public_tokenizers.path("byte_bpe_50k.json")) -> DataFrame:
    """Place of every piece of every document in the packed sequences."""
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"),
                                    _read(path).decode(), public_tokenizers.PATTERN)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op5_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.shard_manifest(table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs)
    found = docs.select("doc_id", (~language_id.learnable()).alias("held_out"),
                        language_id.detect(F.col("text"), model).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share four fifths of their two-word shingles."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), near_dedup.Params(words=2))


def op8_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", quality_classifier.held_out().alias("held_out"),
                         quality_classifier.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality_classifier.THRESHOLD).cast("int"))


def op9_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors with cosine 0.9 or more."""
    return embedding_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    texts = pages.select("page_id", "url", html_text.main_text(F.col("html"), html_text.fit(pages)).alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, the label of every seventh moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), label=moved)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines it shares with two others or more."""
    found = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in its fill-in-middle form, and the text rebuilt from it."""
    found = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                        F.sha2("output", 256).alias("output_sha256"),
                        F.sha2(fill_middle.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_secrets": op2_secrets,
    "op3_bpe": op3_bpe,
    "op4_pack": op4_pack,
    "op5_shard": op5_shard,
    "op6_language": op6_language,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_quality_score": op8_quality_score,
    "op9_embedding_links": op9_embedding_links,
    "op10_main_text": op10_main_text,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_line_dedup": op12_line_dedup,
    "op13_fill_middle": op13_fill_middle,
}
# smallest id reachable over links(a, b), both directions, from nodes(id)
_REACH = """reach AS (
    SELECT id, id AS component_id FROM nodes
    UNION SELECT l.b, r.component_id FROM reach r JOIN links l ON r.id = l.a),
  groups AS (SELECT id, min(component_id) AS component_id FROM reach GROUP BY id)"""

ORACLE: dict[str, str] = {}

ORACLE["op7_near_duplicates"] = rf"""WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
  sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w
      ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words),
  items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
  pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k, any_value(x.n) AS na, any_value(y.n) AS nb
    FROM items x JOIN items y ON x.item = y.item AND x.doc_id <> y.doc_id GROUP BY 1, 2),
  links AS (SELECT a, b FROM pairs WHERE 100 * k >= 80 * (na + nb - k)),
  nodes AS (SELECT doc_id AS id FROM documents), {_REACH}
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN groups ON doc_id = id"""

ORACLE["op9_embedding_links"] = f"""WITH RECURSIVE v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
  sound AS (SELECT * FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
  links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM sound x JOIN sound y
    ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.9),
  nodes AS (SELECT vec_id AS id FROM v),
  n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a), {_REACH}
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN groups ON vec_id = id LEFT JOIN n ON vec_id = a"""

ORACLE["op11_hard_negatives"] = """WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  q AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM v),
  s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
      CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
    FROM q a JOIN q b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0),
  p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
  AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5"""

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE["op12_line_dedup"] = f"""WITH t AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
  l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM t),
  k AS (SELECT *, translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
  often AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
  j AS (SELECT k.*, coalesce(k.doc_id < o.last, FALSE) AS gone FROM k LEFT JOIN often o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id"""

_DRAW = "CAST('0x' || substr(h, {}, 8) AS UBIGINT)"

ORACLE["op13_fill_middle"] = rf"""WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS h,
      regexp_extract_all(coalesce(text, ''), '[ 	-]*[^ 	-]+|[ 	-]+') AS w FROM documents),
  f AS (SELECT *, CAST(len(w) AS BIGINT) AS n,
      CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {_DRAW.format(17)} % 100 >= 50
        THEN 'plain' WHEN {_DRAW.format(25)} % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
      CAST({_DRAW.format(1)} % (len(w) + 1) AS BIGINT) AS x, CAST({_DRAW.format(9)} % (len(w) + 1) AS BIGINT) AS y FROM d),
  c AS (SELECT doc_id, t, n, form, array_to_string(w[1:least(x, y)], '') AS p,
      array_to_string(w[least(x, y) + 1:greatest(x, y)], '') AS m, array_to_string(w[greatest(x, y) + 1:], '') AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM c"""
