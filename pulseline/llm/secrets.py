"""Secret scan with multipart credential linking (operator 2), in DataFrame functions only.

Patterns find the parts of credentials in each text: the base kinds
(assignments, access ids, long hex runs), which are always reported, and weak
candidates (other upper-case identifiers, mixed base64 runs, service URLs),
which mean nothing alone. An interval join on (document, scope bin) reports a
weak candidate only when its complement lies within the scope or in the same
``{…}`` block (the innermost one, of any length): an identifier needs a secret,
a secret needs an identifier, an endpoint needs both, which it may hold itself.
Weak candidates wholly inside a base part are no candidates.

Positions come from the gaps that ``split`` leaves between the matches of a
pattern: a running sum over (gap, match) lengths. Matches are exploded to
narrow rows, so a text with very many parts is rows like any other, and a bin
holds no more parts than a scope has room for.

Defined results: a null text is an empty one and has no spans. Rows are told
apart by their place in the input, so repeated or null ids do no harm; each
row gets its own result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseline.llm.common import staged

SCOPE = 256  # code points between complementary parts, at most
MASK = "[SECRET]"

_WORD = "[A-Za-z0-9+/_-]"
# kind -> (pattern, group whose length decides, least length); base kinds first
PARTS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
    "ident": (r"(?<![A-Za-z0-9])(?=[0-9]*[A-Z])(?=[A-Z]*[0-9])[A-Z0-9]{16,}+(?![A-Za-z0-9])", 0, 16),
    "blob": (rf"(?<!{_WORD})(?=[A-Za-z+/_-]*[0-9])(?=[0-9a-z+/_-]*[A-Z])(?=[0-9A-Z+/_-]*[a-z]){_WORD}{{32,}}", 0, 32),
    "endpoint": (r"""(?:https?|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3)://[^\x20\x09-\x0D"'<>]+""", 0, 8),
}
BLOCK = (r"\{[^{}]*+\}", 0, 2)
BASE = ("assign", "access", "hex")
KINDS = tuple(PARTS)
IDENTIFIERS = ("access", "ident")
SECRETS = ("assign", "hex", "blob")


def _marks(text: Column, kind: str) -> Column:
    """Matches of one kind as (kind, place, gap before, length, kept)."""
    pattern, group, least = PARTS.get(kind, BLOCK)
    number = [*KINDS, "block"].index(kind)
    pat = F.lit(pattern)
    whole = F.regexp_extract_all(text, pat, F.lit(0))
    size = F.transform(whole, lambda m: F.length(m))
    tested = size if group == 0 else F.transform(F.regexp_extract_all(text, pat, F.lit(group)), lambda m: F.length(m))
    gap = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    found = F.transform(
        F.arrays_zip(gap.alias("gap"), size.alias("size"), tested.alias("tested")),
        lambda z, i: F.struct(F.lit(number).alias("kind"), i.alias("place"), z["gap"].alias("gap"),
                              z["size"].alias("size"), (z["tested"] >= least).alias("kept")))
    found = F.filter(found, lambda m: m["size"].isNotNull())  # the last gap has no match
    return F.when(F.regexp_like(text, pat), found).otherwise(F.array().cast(
        "array<struct<kind:int,place:int,gap:int,size:int,kept:boolean>>"))


def _all_marks(text: Column) -> Column:
    return F.concat(*[_marks(text, k) for k in (*KINDS, "block")])


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per match in ``docs`` (which has a ``row_id``): ``row_id, kind, start, end, block``.

    Spans are in code points, the end exclusive; failing matches are dropped.
    ``block`` is the start of the block around the match, null outside blocks.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return _placed(docs.select("row_id", _all_marks(content).alias("marks")))


def _placed(marks: DataFrame) -> DataFrame:
    rows = (marks.filter(F.size("marks") > 0).select("row_id", F.explode("marks").alias("m"))
                 .select("row_id", "m.*"))
    upto = (Window.partitionBy("row_id", "kind").orderBy("place")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    end = F.sum(F.col("gap").cast("long") + F.col("size")).over(upto)
    spans = (rows.withColumn("end", end).filter("kept")
                 .select("row_id", "kind", (F.col("end") - F.col("size")).alias("start"), "end"))
    before = (Window.partitionBy("row_id").orderBy("start", F.col("kind").desc())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    is_block = F.col("kind") == len(KINDS)
    last = F.last(F.when(is_block, F.struct("start", "end")), ignorenulls=True).over(before)
    return (spans.withColumn("last", last).filter(~is_block)
                 .select("row_id", "kind", "start", "end",
                         F.when(F.col("end") <= F.col("last.end"), F.col("last.start")).alias("block")))


def _kind_in(kinds) -> Column:
    return F.col("kind").isin([KINDS.index(k) for k in kinds])


def _right(parts: DataFrame) -> DataFrame:
    return parts.select(*[F.col(c).alias(f"r_{c}") for c in ("row_id", "kind", "start", "end", "block")])


def _bins(frm: str, to: str, width: int, reach: int = 0) -> Column:
    return F.explode(F.sequence(F.floor((F.col(frm) - reach) / width), F.floor((F.col(to) + reach) / width)))


def _outside(weak: DataFrame, base: DataFrame) -> DataFrame:
    """Rows of ``weak`` that do not lie wholly inside a part of ``base``."""
    left = weak.withColumn("bin", F.floor(F.col("start") / SCOPE))
    right = _right(base).withColumn("r_bin", _bins("r_start", "r_end", SCOPE))
    inside = ((F.col("row_id") == F.col("r_row_id")) & (F.col("bin") == F.col("r_bin"))
              & (F.col("r_start") <= F.col("start")) & (F.col("end") <= F.col("r_end")))
    return left.join(right, inside, "left_anti").select(*weak.columns)


def _near(weak: DataFrame, parts: DataFrame, scope: int, own: bool = False) -> DataFrame:
    """Rows of ``weak`` with a part at most ``scope`` away, by an interval join on bins, or in their block.

    A base part that overlaps the row counts only where ``own`` is set.
    """
    width = max(scope, SCOPE)
    left = weak.withColumn("bin", _bins("start", "end", width, scope))
    right = _right(parts).withColumn("r_bin", _bins("r_start", "r_end", width))
    apart = (F.lit(own) | (F.col("r_kind") >= len(BASE))
             | (F.col("r_start") >= F.col("end")) | (F.col("start") >= F.col("r_end")))
    close = ((F.col("row_id") == F.col("r_row_id")) & (F.col("bin") == F.col("r_bin")) & apart
             & (F.col("r_start") - F.col("end") <= scope) & (F.col("start") - F.col("r_end") <= scope))
    hit = left.join(right, close, "left_semi").select(*weak.columns)
    same = (F.col("row_id") == F.col("r_row_id")) & (F.col("block") == F.col("r_block")) & apart
    return hit.unionByName(weak.join(_right(parts), same, "left_semi")).distinct()


def link(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The reported spans: all base parts, and weak ones with their complement in scope.

    The parts are written once, as every branch below reads them.
    """
    parts = staged(parts, "parts")
    base = parts.filter(_kind_in(BASE))
    weak = staged(_outside(parts.filter(~_kind_in(BASE)), base), "weak")
    every = base.unionByName(weak)
    ids, keys = every.filter(_kind_in(IDENTIFIERS)), every.filter(_kind_in(SECRETS))
    linked = (_near(weak.filter(_kind_in(["ident"])), keys, scope)
              .unionByName(_near(weak.filter(_kind_in(["blob"])), ids, scope))
              .unionByName(_near(_near(weak.filter(_kind_in(["endpoint"])), ids, scope, own=True), keys, scope, own=True)))
    return base.unionByName(linked)


def _joined(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _grouped(spans: DataFrame) -> DataFrame:
    return spans.groupBy("row_id").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("found"))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: its key, the counts of the base kinds and all reported spans."""
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    marked = staged(docs.select(F.col(key).alias("doc_id"), F.monotonically_increasing_id().alias("row_id"),
                                _all_marks(content).alias("marks")), "secrets")
    spans = _grouped(link(_placed(marked.select("row_id", "marks"))))
    rows = marked.select("doc_id", "row_id").join(spans, "row_id", "left")
    found = F.coalesce(F.col("found"), F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    base = F.filter("found", lambda s: s["kind"] < len(BASE))
    return (rows.withColumn("found", found)
                .select("doc_id", *[count(k) for k in BASE], _joined(base).alias("base_spans"),
                        _joined(F.col("found")).alias("spans")))


def mask_secrets(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with every reported span replaced by ``[SECRET]``; all other columns unchanged.

    A column named ``length`` follows where a text changed. The patterns run
    once over every text, while the rows are written with what they found;
    rows without any part then pass straight through, the others are joined
    with their spans.
    """
    names = docs.columns
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    marked = staged(docs.select(F.monotonically_increasing_id().alias("row_id"), F.struct("*").alias("row"),
                                _all_marks(content).alias("marks")), "marked")
    # blocks alone are no parts
    has_part = F.exists("marks", lambda m: m["kind"] < len(KINDS))
    dirty = marked.filter(has_part)
    spans = staged(_grouped(link(_placed(dirty.select("row_id", "marks")))), "spans")
    rows = dirty.select("row_id", "row").join(spans, "row_id", "left")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    old = F.col("row")[text]

    def cut(state, span):
        gap = F.substring(old, (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        ahead = span["start"] >= state["at"]
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"),
                        F.when(ahead, F.concat(state["out"], gap, F.lit(MASK))).otherwise(state["out"]).alias("out"))

    new = F.aggregate("found", start, cut,
                      lambda s: F.concat(s["out"], F.substring(old, (s["at"] + 1).cast("int"), F.length(old))))
    rows = rows.select(F.when(F.col("found").isNull(), old).otherwise(new).alias("masked"), "row",
                       F.col("found").isNotNull().alias("changed"))

    def column(name: str) -> Column:
        if name == text:
            return F.col("masked")
        if name == length:
            kind = docs.schema[name].dataType
            return F.when(F.col("changed"), F.length("masked").cast(kind)).otherwise(F.col("row")[name])
        return F.col("row")[name]

    clean = marked.filter(~has_part).select("row.*").toDF(*names)
    return clean.unionByName(rows.select(*[column(n) for n in names]).toDF(*names))
