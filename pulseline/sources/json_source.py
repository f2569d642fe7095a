"""JSON heartbeat requests (SRC-1) and their decode (DEC-1).

Every field is read as text and converted with ``try_cast``: the request
binding is lenient (``"7"`` is a valid long, ``1.5e3`` binds as 1500,
unknown keys are ignored, an absent or null primitive takes its default),
while a value that cannot be converted at all makes the whole request
undecodable, like a malformed document. A boolean binds from true / false in
any case and from whole numbers (0 is false); an empty text for a primitive
counts as absent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseline.functions.parallel import spread_small_input
from pulseline.functions.scalars import PRIMITIVE_DEFAULTS, millis_to_ts
from pulseline.schemas import JSON_FIELDS

_CORRUPT = "_corrupt_record"

# target type of each storage column after binding
_TYPES = {"timestamp_ms": "bigint", "video_start_time_ms": "double",
          "playback_failed": "boolean", "rebuffer_duration_ms": "double",
          "playback_duration_ms": "double"}

# Primitive fields are read as text (lenient binding by ``try_cast``); text
# fields as VARIANT, so that an object or array given for one is recognised
# (a text field binds scalars only) while scalars still bind as their text.
REQUEST_TEXT_SCHEMA = T.StructType(
    [T.StructField(json_name, T.StringType() if col in _TYPES else T.VariantType())
     for json_name, col in JSON_FIELDS]
    + [T.StructField(_CORRUPT, T.StringType())])

def read_json_heartbeats(spark: SparkSession, path: str, streaming: bool = False,
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """One JSON document per line → column ``body`` (text source, no inference).

    A stream also carries ``file_time`` and ``file_path``, the arrival order of its files.
    """
    if streaming:
        reader = spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.load(path).select(
            F.col("value").alias("body"), F.col("_metadata.file_modification_time").alias("file_time"),
            F.col("_metadata.file_path").alias("file_path"))
    return spark.read.text(path).withColumnRenamed("value", "body")


def decode_json(df: DataFrame, body_col: str = "body", spread: bool = False) -> DataFrame:
    """Bind JSON request text to heartbeat columns (DEC-1, FN-1, FN-4).

    Adds the storage columns, ``timestamp_ms``, ``ts`` and ``decode_error``:
    null when the document bound, otherwise ``"malformed JSON"`` or the list
    of fields whose value had the wrong type. ``spread=True`` first gives a
    small scanned input one partition per core (``spread_small_input``).
    """
    req = F.from_json(F.col(body_col), REQUEST_TEXT_SCHEMA,
                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    src = spread_small_input(df) if spread else df
    parsed = _once(src, {"__req": req})
    # step 1: raw text of every field (each read once)
    raw_cols = {}
    for json_name, col in JSON_FIELDS:
        field = F.col(f"__req.{json_name}")
        if col in _TYPES:
            raw_cols[f"__raw_{col}"] = F.nullif(F.trim(field), F.lit(""))
        else:
            raw_cols[f"__raw_{col}"] = F.try_variant_get(field, "$", "string")
    raw_cols["__malformed"] = F.col("__req").isNull() | F.col(f"__req.{_CORRUPT}").isNotNull()
    step1 = _once(parsed, raw_cols)
    # step 2: typed values; an object or array shows in its text, so only such text is looked at closer
    typed = {}
    for json_name, col in JSON_FIELDS:
        if col not in _TYPES:
            raw, kind = F.col(f"__raw_{col}"), F.schema_of_variant(F.col(f"__req.{json_name}"))
            typed[f"__nested_{col}"] = (raw.startswith("{") | raw.startswith("[")) & (
                kind.startswith("OBJECT") | kind.startswith("ARRAY"))
    for col, t in _TYPES.items():
        raw = F.col(f"__raw_{col}")
        if t == "bigint":  # a fractional number for a long binds truncated toward zero
            value = F.coalesce(raw.try_cast(t), raw.try_cast("double").try_cast(t))
        elif t == "boolean":
            value = (F.when(F.lower(raw).isin("true", "false"), F.lower(raw) == "true")
                      .when(raw.rlike("^-?[0-9]+$"), ~raw.rlike("^-?0+$")))
        else:
            value = raw.try_cast(t)
        typed[f"__typed_{col}"] = value
    step2 = _once(step1, typed)
    # step 3: defaults for absent primitives, type mismatches, final columns
    cols = {}
    mismatches = []
    for json_name, col in JSON_FIELDS:
        raw = F.col(f"__raw_{col}")
        if col in _TYPES:
            tv = F.col(f"__typed_{col}")
            value, t = PRIMITIVE_DEFAULTS[col]
            cols[col] = F.coalesce(tv, F.lit(value).cast(t))
            mismatches.append(F.when(raw.isNotNull() & tv.isNull(),
                                     F.lit(f"{json_name}: type mismatch")))
        else:
            cols[col] = raw
            mismatches.append(F.when(F.coalesce(F.col(f"__nested_{col}"), F.lit(False)),
                                     F.lit(f"{json_name}: type mismatch")))
    mismatch = F.concat_ws("; ", *mismatches)       # leaves nulls out
    step3 = step2.withColumns(cols)
    error = (F.when(F.col("__malformed"), F.lit("malformed JSON"))
              .when(mismatch != "", mismatch))
    out = step3.withColumn("decode_error", error).withColumn("ts", millis_to_ts("timestamp_ms"))
    helpers = [c for c in out.columns if c.startswith("__")]
    return out.drop(*helpers)


def _once(df: DataFrame, cols: dict) -> DataFrame:
    """``df`` with columns that are computed once per row.

    They come from a generator (one output row per input row), so filters on
    what is derived from them (accept / reject) are not pushed below it with
    the whole expression inlined once per reference.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in cols.items()]))))
