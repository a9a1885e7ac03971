"""Event detection and classification: a decision list over keyword hits, and labels by hit counts.

Rows are documents with source, title, content, publish_time, url and
symbol_or_subject.  Everything is a column expression; the only shuffles count
equal documents of the batch and join the counts above one back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.keywords import Scan, scanner, words_of
from .rules import RulePack


def _starts(source: Column, prefixes) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | source.startswith(p)
    return out


def with_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with dedup_key and how many rows of the batch share it.

    Counts are made from the keys alone; only keys that occur more than once
    meet the documents again, so texts aren't sorted by key.
    """
    keyed = docs.withColumn("dedup_key", T.dedup_key(F.col("title"), F.col("content")))
    shared = keyed.groupBy("dedup_key").agg(F.count(F.lit(1)).cast("int").alias("duplicate_group_size")).filter("duplicate_group_size > 1")
    return keyed.join(shared, "dedup_key", "left").withColumn("duplicate_group_size", F.coalesce("duplicate_group_size", F.lit(1))).select(*docs.columns, "dedup_key", "duplicate_group_size")


def with_words(docs: DataFrame, *packs: object) -> DataFrame:
    """``docs`` with _words: the packs' keywords in title and in title and content, from one pass over each text."""
    if "_words" in docs.columns:
        return docs
    return docs.withColumn("_words", scanner(set().union(*map(words_of, packs)), joined=2)(F.array("title", "content")))


def title_words() -> Scan:
    """The keywords of the title, as found by ``with_words``."""
    return Scan(F.col("_words")[0])


def full_words() -> Scan:
    """The keywords of title and content."""
    return Scan(F.col("_words")[2])


def detected(docs: DataFrame, pack: RulePack) -> DataFrame:
    """``docs`` (with duplicate_group_size) with is_event, filter_reason and score: the first exit that holds decides."""
    title, source, full = title_words(), F.coalesce("source", F.lit("")), full_words()
    asked = list(docs.columns)
    docs = with_words(docs, pack)
    event = T.hits(full, pack.event)
    strong = F.size(F.filter(event, lambda k: ~k.isin(*pack.generic_hits) if pack.generic_hits else F.lit(True))) + T.n_hits(full, pack.company_action) > 0
    listing = T.any_hit(title, pack.listing_title) & ~T.any_hit(title, pack.listing_excluded)
    signal = strong | listing
    announced = _starts(source, pack.announcement_sources)
    bonus = F.least("duplicate_group_size", F.lit(pack.duplicate_cap))
    actions = T.n_hits(full, pack.company_action)
    policy, hard = T.any_hit(title, pack.policy_title), T.any_hit(full, pack.regulator_hard)
    only_token = (F.size(event) > 0) & (F.size(F.array_except(event, T.words(pack.regulator_token))) == 0)
    score = F.size(event) + bonus
    exits = [
        ("non_financial_noise", T.any_hit(full, pack.non_event), 0),
        ("routine_disclosure_without_signal", T.any_hit(full, pack.weak) & (F.size(event) == 0), 1),
        ("routine_announcement_without_signal", T.any_hit(full, pack.routine) & ~signal, 1),
        ("announcement_template_without_signal", T.any_hit(full, pack.template) & ~signal, 1),
        ("generic_announcement_without_signal", announced & ~signal, 1),
        ("event_signal_detected", announced & (actions > 0), F.greatest(F.lit(pack.threshold), actions + bonus)),
        ("government_narrative_without_action", _starts(source, pack.government_sources) & T.any_hit(title, pack.narrative_title) & ~policy & ~T.any_hit(title, pack.macro_title), 1),
        ("csrc_routine_without_policy_action", _starts(source, pack.regulator_sources) & (T.any_hit(title, pack.regulator_routine_title) | only_token) & ~hard & ~policy, 1),
    ]
    result = None
    for reason, holds, points in exits:
        found = F.struct(F.lit(reason).alias("reason"), F.lit(reason == "event_signal_detected").alias("is_event"), F.lit(points).cast("int").alias("score") if isinstance(points, int) else points.cast("int").alias("score"))
        result = F.when(holds, found) if result is None else result.when(holds, found)
    rest = F.struct(F.when(score >= pack.threshold, "event_signal_detected").otherwise("insufficient_signal").alias("reason"), (score >= pack.threshold).alias("is_event"), score.cast("int").alias("score"))
    return docs.withColumn("_d", result.otherwise(rest)).select(*asked, F.col("_d.is_event").alias("is_event"), F.col("_d.reason").alias("filter_reason"), F.col("_d.score").alias("score"))


def classified(docs: DataFrame, pack: RulePack) -> DataFrame:
    """``docs`` with the labels and scores of structured events."""
    title, full = title_words(), full_words()
    asked = list(docs.columns)
    docs = with_words(docs, pack)
    good, bad, neutral = pack.sentiments
    up, down = T.n_hits(full, pack.positive), T.n_hits(full, pack.negative)
    weight = F.coalesce(*[F.when(F.contains("source", F.lit(k)), w) for k, w in pack.source_weights], F.lit(0.6)) if pack.source_weights else F.lit(0.6)
    labels = docs.withColumns(
        {
            "subject_type": T.best_label(full, pack.subject, pack.subject_default),
            "industry_type": T.best_label(full, pack.industry, pack.industry_default) if pack.industry else F.lit(pack.industry_default),
            "predictability_type": T.best_label(full, pack.predictability, pack.predictability_default),
            "duration_type": T.best_label(full, pack.duration, pack.duration_default),
            "sentiment": F.when(up > down, good).when(down > up, bad).otherwise(neutral),
            "heat_score": F.least((weight * 40).cast("int") + F.least(T.n_hits(title, pack.emphasis) * 12, F.lit(24)) + F.least(F.col("duplicate_group_size") * 12, F.lit(36)), F.lit(100)),
            "novelty_score": F.greatest(F.lit(20), 90 - (F.col("duplicate_group_size") - 1) * 15),
            "amount_yuan": T.amount_yuan(F.concat_ws(" ", "title", "content")),
        }
    )
    base = F.coalesce(*[F.when(F.col("subject_type") == k, v) for k, v in pack.intensity_base.items()], F.lit(55)) if pack.intensity_base else F.lit(55)
    bonus = F.when(F.col("predictability_type") == pack.surprise, 8).otherwise(0) + F.when(T.any_hit(full, pack.shock), 6).otherwise(0) + F.when(T.any_hit(full, pack.policy_bonus), 4).otherwise(0)
    event_id = F.concat(F.lit("EVT-"), F.substring(F.md5(F.concat_ws("|", F.date_format("publish_time", "yyyy-MM-dd HH:mm:ss"), "source", "title").cast("binary")), 1, 10))
    return labels.withColumns({"intensity_score": F.least(base + bonus, F.lit(100)), "event_id": event_id}).select(*asked, *(c for c in labels.columns if c not in docs.columns), "intensity_score", "event_id")


def first_of_keys(found: DataFrame, order: str) -> DataFrame:
    """The first row of each dedup key by a unique column; an order of two or more fields is a struct column."""
    first = found.groupBy("dedup_key").agg(F.min(order).alias(order))
    return found.join(first, ["dedup_key", order], "left_semi")


def structured_events(docs: DataFrame, pack: RulePack, order: str) -> DataFrame:
    """Events of a batch with their labels, the first by ``order`` of those that share a dedup key."""
    return classified(first_of_keys(detected(with_duplicates(docs), pack).filter("is_event"), order), pack)
