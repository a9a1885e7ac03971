"""Event studies: align events to trading days, fit a market model, cumulate abnormal returns.

Days are numbered within each entity over the days that it shares with the
benchmark.  Alignment takes two running lookups by window functions over the
union of events and days, once in each direction, so the work grows with the
rows of an entity, not with their square.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ESTIMATION = (-120, -20)
MIN_POINTS = 30


def common_days(stock: DataFrame, market: DataFrame) -> DataFrame:
    """(entity, day, r, m, idx): days with both returns, numbered from 0 for each entity."""
    both = stock.select("entity", "day", F.col("daily_return").alias("r")).filter("r IS NOT NULL")
    both = both.join(market.select("day", F.col("daily_return").alias("m")).filter("m IS NOT NULL"), "day")
    return both.withColumn("idx", F.row_number().over(Window.partitionBy("entity").orderBy("day")) - 1)


def aligned(events: DataFrame, days: DataFrame, max_gap: int = 7) -> DataFrame:
    """Events (event_id, entity, event_date) with trade_day, idx and alignment.

    The first day at or after the event within the gap, else the last before
    within it, else no day and the reason ``no_trade_date_within_gap``.
    """
    marks = events.select("entity", F.col("event_date").alias("day"), "event_id", F.lit(None).cast("int").alias("idx"), F.lit(0).alias("kind"))
    marks = marks.unionByName(days.select("entity", "day", F.lit(None).cast(events.schema["event_id"].dataType).alias("event_id"), "idx", F.lit(1).alias("kind")))
    # a frame up to the last row would be read anew for each row, so the next day is the last one of the opposite order
    forth = Window.partitionBy("entity").orderBy("day", "kind").rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy("entity").orderBy(F.desc("day"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, 0)
    point = F.when(F.col("kind") == 1, F.struct("day", "idx"))
    nearest = marks.withColumns(
        {
            "next": F.last(point, ignorenulls=True).over(back),
            "prev": F.last(point, ignorenulls=True).over(forth),
        }
    ).filter("kind = 0")
    near_next = F.datediff("next.day", "day") <= max_gap
    near_prev = F.datediff("day", "prev.day") <= max_gap
    chosen = F.when(near_next, F.col("next")).when(near_prev, F.col("prev"))
    how = (
        F.when(near_next & (F.col("next.day") == F.col("day")), "exact")
        .when(near_next, "aligned_next_trade_date")
        .when(near_prev, "aligned_prev_trade_date")
        .otherwise("no_trade_date_within_gap")
    )
    return nearest.select("event_id", "entity", F.col("day").alias("event_date"), chosen.day.alias("trade_day"), chosen.idx.alias("idx"), how.alias("alignment"))


def _fits(r: np.ndarray, m: np.ndarray, has: np.ndarray, min_points: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Points, alpha and beta of each row's values where ``has``; NaN below ``min_points`` or where all m are equal."""
    n = has.sum(axis=1)
    count, first, every = np.maximum(n, 1), has.argmax(axis=1), np.arange(len(has))

    def centered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        from_first = np.where(has, x - x[every, first][:, None], 0.0)  # equal values are exactly 0
        mean = from_first.sum(axis=1) / count
        return np.where(has, from_first - mean[:, None], 0.0), x[every, first] + mean

    (cr, mean_r), (cm, mean_m) = centered(r), centered(m)
    spread, fit = (cm * cm).sum(axis=1), (cr * cm).sum(axis=1)
    beta = np.where((n >= min_points) & (spread > 0), fit / np.where(spread > 0, spread, 1.0), np.nan)
    return n, mean_r - beta * mean_m, beta


def _by_day(days: DataFrame, window: tuple[int, int], min_points: int, windows: tuple[int, ...] = ()) -> DataFrame:
    """(entity, idx, estimation_points, alpha, beta) and counts and sums of r and m over [day, day + w] as _n, _r and _m of w.

    alpha and beta: least squares of r on m over the window before each day,
    null below ``min_points``.  An entity's series is one array, of 40 bytes a
    day; frames of some thousand days at a time are views of it.
    """
    kinds = dict(days.dtypes)
    sums = [f"_{x}{w}" for w in windows for x in "nrm"]
    schema = f"entity {kinds['entity']}, idx {kinds['idx']}, estimation_points long, alpha double, beta double" + "".join(f", {c} {'long' if c[1] == 'n' else 'double'}" for c in sums)
    low, high, rows = *window, 4096

    def of_entity(table: pa.Table) -> pa.Table:
        idx, r0, m0 = (table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("idx", "r", "m"))
        at = idx - idx.min()
        before, size, reach = max(-low, 0), int(at.max()) + 1, max(high, *windows, 0) if windows else max(high, 0)
        r, m, has = np.zeros(before + size + reach), np.zeros(before + size + reach), np.zeros(before + size + reach, bool)
        r[at + before], m[at + before], has[at + before] = r0, m0, True
        frames = [np.lib.stride_tricks.sliding_window_view(x, high - low + 1) for x in (r, m, has)]
        parts = [_fits(*(x[(at[k : k + rows] + before + low)] for x in frames), min_points) for k in range(0, len(at), rows)]
        points, alpha, beta = (np.concatenate(x) for x in zip(*parts))
        out = [table.column("entity"), table.column("idx"), pa.array(points, pa.int64()), pa.array(alpha, mask=np.isnan(beta)), pa.array(beta, mask=np.isnan(beta))]
        for w in windows:
            places = [at + before + k for k in range(w + 1)]
            out += [pa.array(sum(has[p].astype(np.int64) for p in places)), pa.array(sum(r[p] for p in places)), pa.array(sum(m[p] for p in places))]
        return pa.table(out, names=["entity", "idx", "estimation_points", "alpha", "beta", *sums])

    return days.select("entity", "idx", "r", "m").groupBy("entity").applyInArrow(of_entity, schema)


def _cars(windows: tuple[int, ...]) -> list:
    """Sums of r - (alpha + beta m) over [day, day + w], null where days are missing."""
    return [F.when(F.col(f"_n{w}") == w + 1, F.col(f"_r{w}") - (w + 1) * F.col("alpha") - F.col("beta") * F.col(f"_m{w}")).alias(f"car_w{w}") for w in windows]


def _of(events: DataFrame, days: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events on a day, and the days of their entities."""
    placed = events.filter("idx IS NOT NULL")
    return placed, days.join(placed.select("entity").distinct(), "entity", "left_semi")


def studied(events: DataFrame, days: DataFrame, window: tuple[int, int] = ESTIMATION, min_points: int = MIN_POINTS, windows: tuple[int, ...] = (1, 3, 5)) -> DataFrame:
    """Events (event_id, entity, idx, ...) with estimation_points, alpha, beta and car_w* of their day.

    All that a study needs is computed for each day from one sort by entity, so
    the work grows with days, and events only look their day up.
    """
    placed, known = _of(events, days)
    table = _by_day(known, window, min_points, windows)
    table = table.select("entity", "idx", "estimation_points", "alpha", "beta", *_cars(windows))
    return placed.join(table, ["entity", "idx"])


def market_model(events: DataFrame, days: DataFrame, window: tuple[int, int] = ESTIMATION, min_points: int = MIN_POINTS) -> DataFrame:
    """(event_id, entity, estimation_points, alpha, beta): least squares of r on m over the estimation window."""
    placed, known = _of(events, days)
    return placed.join(_by_day(known, window, min_points), ["entity", "idx"]).filter("estimation_points > 0").select("event_id", "entity", "estimation_points", "alpha", "beta")


def abnormal_returns(events: DataFrame, days: DataFrame, model: DataFrame, windows: tuple[int, ...] = (1, 3, 5)) -> DataFrame:
    """(event_id, entity, car_w*): sums of r - (alpha + beta m) over [t, t + w], null where days are missing."""
    placed, known = _of(events, days)
    keys = [c for c in ("event_id", "entity") if c in model.columns]
    own = placed.join(model.filter("beta IS NOT NULL").select(*keys, "alpha", "beta"), keys)
    sums = _by_day(known, ESTIMATION, MIN_POINTS, windows).drop("estimation_points", "alpha", "beta")
    return own.join(sums, ["entity", "idx"]).select("event_id", "entity", *_cars(windows))


def outcomes(events: DataFrame, days: DataFrame) -> DataFrame:
    """(reason, n): why aligned events have no study, or how they were aligned."""
    found = events.join(studied(events, days).select("event_id", "entity", "beta", "estimation_points"), ["event_id", "entity"], "left")
    reason = F.when(F.col("idx").isNull(), F.col("alignment")).when(F.coalesce("estimation_points", F.lit(0)) < MIN_POINTS, "insufficient_estimation_points").when(F.col("beta").isNull(), "no_market_variance").otherwise(F.concat(F.lit("studied_"), "alignment"))
    return found.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def report(rows: DataFrame, groupings: list[str], metrics: list[str]) -> DataFrame:
    """(grouping, bucket, metric, n, mean, t_stat): each metric over all rows and by each grouping column, in one pass."""
    cells = F.array(F.struct(F.lit("all").alias("grouping"), F.lit("all").alias("bucket")), *[F.struct(F.lit(g).alias("grouping"), F.col(g).cast("string").alias("bucket")) for g in groupings])
    values = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in metrics])
    long = rows.select(F.explode(cells).alias("g"), values.alias("vs")).select("g.*", F.explode("vs").alias("x")).select("grouping", "bucket", "x.metric", "x.v")
    return mean_and_t(long, ["grouping", "bucket", "metric"], "v")


def mean_and_t(df: DataFrame, by: list[str], metric: str) -> DataFrame:
    """Mean, t-statistic (null below two values or without spread) and count by group."""
    n, sd = F.count(metric), F.stddev_samp(metric)
    return df.groupBy(*by).agg(n.alias("n"), F.avg(metric).alias("mean"), F.when((n >= 2) & (sd > 0), F.avg(metric) / (sd / F.sqrt(n))).alias("t_stat"))


def bucket3(x):
    """low below 33, mid below 66, high."""
    return F.when(x < 33, "low").when(x < 66, "mid").otherwise("high")
