"""Daily aggregates: clusters, sentiment by channel, market environment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import money, rounded


def cluster_daily(reports: DataFrame) -> DataFrame:
    """Reports (cluster, day, source, sentiment -1/0/1) by cluster and day.

    Growth is over the calendar day before with +1 smoothing; entropy is
    Shannon's of the three sentiments.
    """
    daily = reports.groupBy("cluster", "day").agg(
        F.count(F.lit(1)).alias("reports"),
        F.countDistinct("source").alias("media"),
        F.count_if(F.col("sentiment") > 0).alias("positive"),
        F.count_if(F.col("sentiment") == 0).alias("neutral"),
        F.count_if(F.col("sentiment") < 0).alias("negative"),
    )
    before = daily.select("cluster", F.date_add("day", 1).alias("day"), F.col("reports").alias("reports_before"))
    out = daily.join(before, ["cluster", "day"], "left")
    prev = F.coalesce("reports_before", F.lit(0))
    total = F.lit(0.0)
    for c in ("positive", "neutral", "negative"):
        share = F.col(c) / F.col("reports")
        total = total - F.when(F.col(c) > 0, share * F.log(share)).otherwise(0.0)
    return out.withColumns({"growth": rounded((F.col("reports") - prev) / (prev + 1), 6), "entropy": rounded(total, 6)}).drop("reports_before")


def cluster_totals(reports: DataFrame) -> DataFrame:
    """Reports, active days, media coverage and span of each cluster."""
    return reports.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("reports"), F.countDistinct("day").alias("active_days"), F.countDistinct("source").alias("media"), F.min("day").alias("first_day"), F.max("day").alias("last_day")
    )


def sentiment_daily(reports: DataFrame) -> DataFrame:
    """Reports (cluster, day, channel, source, score -1/0/1) by cluster, day and channel.

    ``dominant_share`` is the largest sentiment count of the channel over all
    channels' reports of the day; growth is over the channel's previous
    observed day; ``streak`` counts consecutive calendar days up to this one.
    """
    score = F.col("score")
    by_channel = reports.groupBy("cluster", "day", "channel").agg(
        F.count(F.lit(1)).alias("reports"),
        F.countDistinct("source").alias("sources"),
        F.sum(score).alias("total"),
        F.count_if(score > 0).alias("positive"),
        F.count_if(score == 0).alias("neutral"),
        F.count_if(score < 0).alias("negative"),
        F.sum(score * score).alias("squares"),
    )
    day = Window.partitionBy("cluster", "day")
    mean = F.col("total") / F.col("reports")
    past = Window.partitionBy("cluster", "channel").orderBy("day")
    out = by_channel.withColumns(
        {
            "mean_score": mean,
            "day_reports": F.sum("reports").over(day),
            "stance_range": F.max(mean).over(day) - F.min(mean).over(day),
            "reports_before": F.lag("reports").over(past),
            "island": F.date_sub("day", F.row_number().over(past)),
        }
    )
    run = Window.partitionBy("cluster", "channel", "island").orderBy("day")
    spread = F.sqrt(F.greatest(F.col("squares") / F.col("reports") - mean * mean, F.lit(0.0)))
    before = F.col("reports_before")
    return out.select(
        "cluster", "day", "channel", "reports", "sources", "positive", "neutral", "negative",
        rounded(mean, 6).alias("mean_score"), rounded(spread, 6).alias("spread"),
        rounded(F.greatest("positive", "neutral", "negative") / F.col("day_reports"), 6).alias("dominant_share"),
        rounded(F.col("stance_range"), 6).alias("stance_range"),
        rounded(F.when(before > 0, (F.col("reports") - before) / before), 6).alias("growth"),
        F.row_number().over(run).alias("streak"),
    )


def market_environment(quotes: DataFrame, benchmark: DataFrame, top: int = 10) -> DataFrame:
    """Breadth of each day over quotes (entity, day, group, daily_return, amount), its hottest groups, the benchmark's state.

    Benchmark: return over 5 and volatility over 20 of the quotes' days that it has.
    """
    r = F.col("daily_return")
    breadth = quotes.groupBy("day").agg(
        F.count_if(r > 0).alias("up"), F.count_if(r < 0).alias("down"), F.count_if(r == 0).alias("flat"),
        F.count_if(r >= 0.097).alias("limit_up"), F.count_if(r <= -0.097).alias("limit_down"), F.sum(money(F.col("amount"))).cast("double").alias("amount"),
    )
    groups = quotes.filter(r.isNotNull() & (F.col("group") != "")).groupBy("day", "group").agg(F.avg("daily_return").alias("avg_return"), F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("day").orderBy(F.desc(rounded(F.col("avg_return"), 6)), "group"))
    hot = groups.withColumn("rank", rank).filter(F.col("rank") <= top)
    hot = hot.groupBy("day").agg(F.array_sort(F.collect_list(F.struct("rank", "group", rounded(F.col("avg_return"), 6).alias("avg_return"), "n"))).alias("hot_groups"))
    state = benchmark.join(breadth.select("day"), "day", "left_semi").filter("daily_return IS NOT NULL")
    past = Window.partitionBy(F.lit(1)).orderBy("day")  # one row a day: a few thousand rows in all
    state = state.select(
        "day", rounded(F.product(1 + r).over(past.rowsBetween(-4, 0)) - 1, 6).alias("benchmark_return_5d"), rounded(F.stddev_samp(r).over(past.rowsBetween(-19, 0)), 6).alias("benchmark_volatility_20d")
    )
    out = breadth.join(hot, "day", "left").join(state, "day", "left")
    risk = F.coalesce(F.col("down") / F.nullif(F.col("up") + F.col("down"), F.lit(0)), F.lit(0.5))
    return out.withColumn("risk_score", rounded(risk, 6))
