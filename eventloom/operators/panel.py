"""Daily panels of an entity's series: returns, volatility, volume ratios, forward labels.

Every frame counts rows of the entity's series, not calendar days; a missing
return shortens a frame's sample.  All columns come from one pass over an
entity's series as arrays, since a window would read each frame anew by rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import rounded

HORIZONS, FORWARD = (5, 20, 60), (1, 3, 5)


def simple_returns(series: DataFrame, entity: str = "entity", day: str = "day", close: str = "close") -> DataFrame:
    """``series`` with ``daily_return``: close over the close before, null after a missing or zero one."""
    before = F.lag(F.col(close)).over(Window.partitionBy(entity).orderBy(day))
    return series.withColumn("daily_return", F.when(before != 0, F.col(close) / before - 1))


def _shifted(x: np.ndarray, k: int, empty: float) -> np.ndarray:
    """The values k rows ahead, ``empty`` where there is no row."""
    if k >= 0:
        return np.concatenate([x[k:], np.full(min(k, len(x)), empty)])
    return np.concatenate([np.full(min(-k, len(x)), empty), x[:k]])


def _folded(x: np.ndarray, first: int, last: int, empty: float, f) -> np.ndarray:
    """f over the rows from ``first`` to ``last`` around each row, in their order."""
    out = _shifted(x, first, empty)
    for k in range(first + 1, last + 1):
        out = f(out, _shifted(x, k, empty))
    return out


def _features(r: np.ndarray, volume: np.ndarray, least: int, base: tuple[int, int]) -> dict[str, np.ndarray]:
    """Unrounded columns of one series by name; NaN is null in and out."""
    has, held = ~np.isnan(r), ~np.isnan(volume)
    growth = np.where(has, 1 + r, 1.0)
    x = np.where(has, r, 0.0)
    x = np.where(has, x - (x[has.argmax()] if len(x) else 0.0), 0.0)  # spread doesn't depend on it, and equal returns are 0
    count = lambda first, last: _folded(has.astype(float), first, last, 0.0, np.add)
    compound = lambda first, last: np.where(count(first, last) >= least, _folded(growth, first, last, 1.0, np.multiply) - 1, np.nan)
    out = {}
    for n in HORIZONS:
        points = count(1 - n, 0)
        mean = _folded(x, 1 - n, 0, 0.0, np.add) / np.maximum(points, 1)
        squares = np.zeros(len(x))
        for k in range(1 - n, 1):
            squares += np.where(_shifted(has.astype(float), k, 0.0) > 0, (_shifted(x, k, 0.0) - mean) ** 2, 0.0)
        out[f"trailing_return_{n}d"] = compound(1 - n, 0)
        out[f"volatility_{n}d"] = np.where(points > 1, np.sqrt(squares / np.maximum(points - 1, 1)), np.nan)
    ups = _folded((np.where(has, r, 0.0) > 0).astype(float), -19, 0, 0.0, np.add)
    out["up_days_20d"] = ups if least > 1 else np.where(count(-19, 0) > 0, ups, np.nan)
    total, n = _folded(np.where(held, volume, 0.0), *base, 0.0, np.add), _folded(held.astype(float), *base, 0.0, np.add)
    mean = np.where(n > 0, total / np.maximum(n, 1), np.nan)
    out["volume_ratio"] = np.where(mean != 0, volume / np.where(mean != 0, mean, 1.0), np.nan)
    for n in FORWARD:
        out[f"forward_return_{n}d"] = compound(1, n)
    return out


def daily_panel(series: DataFrame, variant: str = "previous", entity: str = "entity", day: str = "day", change: str | None = None) -> DataFrame:
    """Features and forward labels of each (entity, day) of a series with close and volume.

    With ``change``, a column of changes in percent, these are the returns, and
    close isn't read.

    variant ``previous``: the volume ratio is to the 4 rows before, and one
    return is enough.  ``rolling``: the ratio is to 20 rows with the current
    one, compounds need two returns (so the 1-row forward one is always null),
    and up days are 0 rather than null.
    """
    least = 2 if variant == "rolling" else 1
    panel = simple_returns(series, entity, day) if change is None else series.withColumn("daily_return", F.col(change) / 100)
    added = [f"{kind}_{n}d" for n in HORIZONS for kind in ("trailing_return", "volatility")] + ["up_days_20d", "volume_ratio"] + [f"forward_return_{n}d" for n in FORWARD]
    panel = panel.drop(*added)
    base = (-19, 0) if variant == "rolling" else (-4, -1)
    floats = lambda c: c.cast(pa.float64()).combine_chunks().to_numpy(zero_copy_only=False)

    def of_entity(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, [(day, "ascending")], null_placement="at_start"))
        found = _features(floats(table.column("daily_return")), floats(table.column("volume")), least, base)
        for c in added:
            table = table.append_column(c, pa.array(found[c], pa.float64(), from_pandas=True))
        return table

    schema = T.StructType([*panel.schema.fields, *[T.StructField(c, T.DoubleType()) for c in added]])
    out = panel.groupBy(entity).applyInArrow(of_entity, schema)
    return out.withColumns({c: rounded(F.col(c), 6) for c in (*added, "daily_return") if c != "up_days_20d"} | {"up_days_20d": F.col("up_days_20d").cast("long")})


def board_limit(code: Column) -> Column:
    """Daily price limit of a listing code by its prefix or exchange suffix."""
    return F.when(code.endswith(".BJ"), 0.30).when(code.rlike("^(30|68)"), 0.20).otherwise(0.10)


def limit_flags(df: DataFrame, code: str, change: str) -> DataFrame:
    """``df`` with is_limit_up and is_limit_down: change in percent within 0.3 of the limit."""
    edge = board_limit(F.col(code)) * 100 - 0.3
    return df.withColumns({"is_limit_up": F.col(change) >= edge, "is_limit_down": F.col(change) <= -edge})


def joined_panel(quotes: DataFrame, basics: DataFrame, factors: DataFrame, entity: str = "entity", day: str = "day", change: str = "pct_chg", volume: str = "volume") -> DataFrame:
    """The panel of changes of quotes, with each day's basics (valuations, their own volume ratio) and adjustment factor joined.

    Entities and days are those of the quotes; what the other tables lack is null.
    """
    panel = daily_panel(quotes.withColumnRenamed(volume, "volume"), "previous", entity, day, change).drop("volume_ratio").withColumnRenamed("volume", volume)
    limits = limit_flags(panel, "code", change) if "code" in quotes.columns else panel
    return limits.join(basics, [entity, day], "left").join(factors, [entity, day], "left")
