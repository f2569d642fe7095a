"""Continuous series over time: rates, held gauges, counter increases (AGG-12, AGG-14…AGG-16).

A dashboard evaluates its expressions at every step, also where nothing
happened: a rate is then 0 and a gauge keeps its last reading. ``time_grid``
yields the steps of the data's own time range, one row per block of steps
first, so that the steps are made in parallel.

Values are carried along time by blocks (``last_before``): inside a block by a
window on (keys, block), between blocks through the last value of each block,
which is carried the same way one level up. No window holds more than
``BLOCK`` positions of a key, except the topmost, which holds one row per
``BLOCK**LEVELS`` positions.

Times are whole milliseconds; windows and steps are aligned to the epoch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseline.functions.scalars import millis_to_ts, ts_to_millis
from pulseline.operators.kpi import kpi_timeseries
from pulseline.operators.reports import OVERFLOW_ALERT_THRESHOLD, _seconds

BLOCK = 4_096     # positions in a block
LEVELS = 2        # levels of blocks below the topmost window

GAUGES = ["avg_vst_ms", "pfr", "rebuffering_ratio"]


def _number(ts: str | Column, step_ms: int) -> Column:
    """Number of the step that holds ``ts``, counted from the epoch."""
    return F.floor(ts_to_millis(ts) / F.lit(step_ms)).cast("bigint")


def _time(number: Column, step_ms: int) -> Column:
    return millis_to_ts(number * F.lit(step_ms))


def time_grid(numbers: DataFrame, column: str, block: int = BLOCK) -> DataFrame:
    """All whole numbers from the least to the greatest of ``column``; none for an empty input.

    One row per block is made first and spread over the tasks; the steps of a
    block are made where the block lies.
    """
    n = F.col(column)
    ends = numbers.agg(F.min(n).alias("lo"), F.max(n).alias("hi")).filter(F.col("lo").isNotNull())
    whole = lambda c: F.floor(F.col(c) / F.lit(block)).cast("bigint")
    blocks = ends.select("lo", "hi", F.explode(F.sequence(whole("lo"), whole("hi"))).alias("b")).repartition("b")
    first = F.greatest(F.col("b") * block, F.col("lo"))
    last = F.least(F.col("b") * block + (block - 1), F.col("hi"))
    return blocks.select(F.explode(F.sequence(first, last)).alias(column))


def last_before(rows: DataFrame, position: str, value: str, name: str, keys=(),
                inclusive: bool = False, block: int = BLOCK, levels: int = LEVELS) -> DataFrame:
    """``rows`` with ``name``: the last non-null ``value`` of the keys at a smaller ``position``.

    ``inclusive`` counts the row's own value too. Positions are whole numbers,
    unique per key; ``name`` is null where nothing comes before.
    """
    bounds = (Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    if levels == 0:
        line = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(position).rowsBetween(*bounds)
        return rows.withColumn(name, F.last(value, ignorenulls=True).over(line))
    up = f"__block{levels}"
    placed = rows.withColumn(up, F.floor(F.col(position) / F.lit(block)).cast("bigint"))
    line = Window.partitionBy(*keys, up).orderBy(position).rowsBetween(*bounds)
    inside = placed.withColumn(name, F.last(value, ignorenulls=True).over(line))
    tails = placed.groupBy(*keys, up).agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col(position))).alias("__tail"))
    carried = last_before(tails, up, "__tail", "__carried", keys, False, block, levels - 1)
    same = F.col(f"r.{up}") == F.col(f"c.{up}")
    for k in keys:
        same = same & F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}"))
    out = inside.alias("r").join(carried.alias("c"), same, "left")
    kept = [F.col(f"r.{c}") for c in rows.columns]
    return out.select(*kept, F.coalesce(F.col(f"r.{name}"), F.col("c.__carried")).alias(name))


def rate_series(rows: DataFrame, counts: dict[str, Column], ts: str = "ts",
                window: str = "1 minute", step: str = "15 seconds") -> DataFrame:
    """Rates over the ``window`` that ends at each ``step``, zeros included (AGG-12, AGG-14).

    ``counts`` maps a name to the condition of the rows it counts; each gives
    the columns ``name`` and ``name_per_s``. Rows are counted once, per step;
    a step's count then goes to the windows that hold it. The series runs from
    the first window that holds a row to the last. Rows without time are not
    counted; ``window`` must be a multiple of ``step``.
    """
    width, step_ms = _seconds(window) * 1000, _seconds(step) * 1000
    if width % step_ms:
        raise ValueError(f"{window} is not a multiple of {step}")
    names = list(counts)
    panes = (rows.filter(F.col(ts).isNotNull())
                 .groupBy(_number(ts, step_ms).alias("__pane"))
                 .agg(*[F.count_if(c).alias(n) for n, c in counts.items()]))
    # windows by the number of their first pane
    inside = F.sequence(F.col("__pane") - (width // step_ms - 1), F.col("__pane"))
    windows = (panes.select(F.explode(inside).alias("__from"), *names)
                    .groupBy("__from").agg(*[F.sum(n).alias(n) for n in names]))
    full = time_grid(windows, "__from").join(windows, "__from", "left")
    count = {n: F.coalesce(F.col(n), F.lit(0).cast("bigint")) for n in names}
    return full.select(
        _time(F.col("__from"), step_ms).alias("window_start"),
        _time(F.col("__from") + width // step_ms, step_ms).alias("window_end"),
        *[c.alias(n) for n, c in count.items()],
        *[(c / F.lit(width / 1000)).alias(f"{n}_per_s") for n, c in count.items()])


def gauge_series(readings: DataFrame, gauges, ts: str = "window_start", step: str = "1 minute") -> DataFrame:
    """``step_start``, the gauges and ``fresh`` at every step, a gauge holding its last reading (AGG-15).

    ``readings`` has at most one row per step; the series runs from the first
    to the last of them. A reading without time is ignored.
    """
    step_ms = _seconds(step) * 1000
    found = readings.filter(F.col(ts).isNotNull()).select(
        _number(ts, step_ms).alias("__n"), F.struct(*gauges).alias("__reading"))
    full = time_grid(found, "__n").join(found, "__n", "left")
    held = last_before(full, "__n", "__reading", "__held", inclusive=True)
    return held.select(_time(F.col("__n"), step_ms).alias("step_start"),
                       *[F.col(f"__held.{g}").alias(g) for g in gauges],
                       F.col("__reading").isNotNull().alias("fresh"))


def kpi_series(hb: DataFrame, step: str = "1 minute") -> DataFrame:
    """KPI gauges at every step; steps without events show the last KPIs and are not ``fresh``."""
    return gauge_series(kpi_timeseries(hb.filter(F.col("ts").isNotNull()), step), GAUGES, step=step)


def counter_increase(samples: DataFrame, series: str = "series", ts: str = "ts", value: str = "value",
                     window: str = "1 minute") -> DataFrame:
    """Increase of sampled counters per window, summed over the series (AGG-16).

    A counter only grows until its process restarts and it begins at 0 again:
    a sample below the one before it counts in full (``resets`` tells how
    many), any other by the difference. The first sample of a series counts
    nothing. An increase belongs to the window of the later sample; nothing is
    extrapolated to the ends of the window. Of samples of one series at the
    same millisecond the greatest counts; samples without value or time are
    ignored, a null series is one of its own. Only windows with samples are
    returned.
    """
    width = _seconds(window) * 1000
    # frequent repeats are combined before the shuffle: one row per millisecond and series
    one = (samples.filter(F.col(value).isNotNull() & F.col(ts).isNotNull())
                  .groupBy(F.col(series).alias("__s"), ts_to_millis(ts).alias("__ms"))
                  .agg(F.max(value).alias("__v")))
    # blocks of a minute or more keep a hot series in many tasks
    both = last_before(one, "__ms", "__v", "__before", ["__s"], block=max(width, 60_000))
    fell = F.col("__v") < F.col("__before")
    step = (F.when(F.col("__before").isNull(), F.lit(0)).when(fell, F.col("__v"))
             .otherwise(F.col("__v") - F.col("__before")))
    number = F.floor(F.col("__ms") / F.lit(width)).cast("bigint")
    agg = both.groupBy(number.alias("__w")).agg(
        F.sum(step).alias("increase"), F.count_if(fell).alias("resets"), F.count(F.lit(1)).alias("samples"))
    return agg.select(_time(F.col("__w"), width).alias("window_start"),
                      _time(F.col("__w") + 1, width).alias("window_end"), "increase", "resets", "samples")


def increase_alerts(increases: DataFrame, threshold: float = OVERFLOW_ALERT_THRESHOLD) -> DataFrame:
    """Windows whose counter increase exceeds the threshold (AGG-16)."""
    return increases.filter(F.col("increase") > threshold)
