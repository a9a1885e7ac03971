"""The delivery status: published checks of nine tables as data, each table read once, and checks observed while a table is written."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from . import quality
from .quality import filled


@dataclass(frozen=True)
class TableChecks:
    """Least rows; columns to fill (column to (ok, warn)); shares of rows (metric to (SQL condition, ok, warn)); aggregates (metric to (SQL aggregate, bound, kind)); the label group of enumerated columns; the column of snapshots of which the latest counts."""

    least: int
    fills: dict = field(default_factory=dict)
    shares: dict = field(default_factory=dict)
    counts: dict = field(default_factory=dict)
    labels: dict = field(default_factory=dict)
    snapshot: str | None = None


_EVENT_COLUMNS = ("event_subject_type", "event_subject_subtype", "source_type", "authority_level", "duration_type", "predictability_type", "sentiment", "event_stage", "shock_source_type", "region_scope", "impact_scope")

# Tables, metrics and bounds of the delivery checks.
PUBLISHED = {
    "raw_documents": TableChecks(1000, counts={"source_count": ("count(DISTINCT source)", 8, "least"), "duplicate_urls": ("count(*) - count(DISTINCT url)", 0, "most")}),
    "label_dictionary": TableChecks(1, counts={"label_groups": ("count(DISTINCT label_group)", 10, "blocks")}),
    "structured_events": TableChecks(300, fills=dict.fromkeys(_EVENT_COLUMNS, (0.98, 0.90)), labels={c: c for c in _EVENT_COLUMNS}),
    "company_profiles": TableChecks(
        50, snapshot="snapshot_date",
        fills={"region": (0.80, 0.50), "list_date": (0.90, 0.60), "state_owned_flag": (0.70, 0.40), "employees": (0.60, 0.30), "total_shares": (0.80, 0.50), "float_shares": (0.80, 0.50), "core_products": (0.90, 0.70)},
    ),
    "stock_daily_quotes": TableChecks(
        10000, counts={"symbol_count": ("count(DISTINCT ts_code)", 50, "least")},
        fills={"open": (0.98, 0.90), "high": (0.98, 0.90), "low": (0.98, 0.90), "amount": (0.90, 0.50), "turnover_rate": (0.90, 0.50), "adj_factor": (0.90, 0.50)},
        shares={"limit_flag_rows": ("is_limit_up OR is_limit_down", 0.001, 0.0001), "non_sina_source_rows": ("data_source <> 'sina'", 0.50, 0.01)},
    ),
    "market_environment_daily": TableChecks(500, fills={"index_return_1d": (0.70, 0.50), "market_turnover": (0.90, 0.70), "northbound_net_flow": (0.80, 0.20), "sector_hotness": (0.90, 0.70)}),
    "sentiment_propagation_daily": TableChecks(300, fills={"heat_score": (0.80, 0.50), "heat_growth_rate": (0.50, 0.25), "heat_duration_days": (0.80, 0.50), "disagreement_score": (0.50, 0.25), "sentiment_std": (0.50, 0.25)}),
    "company_relations": TableChecks(
        200, shares={"directed_edge_ratio": ("direction = 'directed'", 0.35, 0.15)},
        counts={"relation_type_count": ("count(DISTINCT relation_type)", 5, "least"), "manual_override_ratio": ("count_if(is_manual_override) / count(*)", 0.80, "most")},
    ),
    "event_company_links": TableChecks(
        300, counts={"covered_events": ("count(DISTINCT structured_event_id)", 150, "least"), "covered_companies": ("count(DISTINCT company_id)", 50, "least"), "avg_final_link_score": ("round(avg(final_link_score), 4)", 0.35, "least")},
    ),
}


def table_status(df: DataFrame | None, area: str, checks: TableChecks, dictionary: DataFrame | None, like: DataFrame) -> DataFrame:
    """(area, metric, value, target, status) of one table; ``df`` None is a missing one, of which only its absence is told, ``like`` gives the session."""
    if df is None:
        return quality.presence({area: None, "": like.limit(0)}, {area: checks.least}).filter(F.col("area") == area)
    rows = df if checks.snapshot is None else quality.latest_snapshot(df, checks.snapshot)
    ratios = quality.fills(checks.fills) | {m: (F.expr(c), ok, warn) for m, (c, ok, warn) in checks.shares.items()}
    counts = {m: (F.expr(a), bound, kind) for m, (a, bound, kind) in checks.counts.items()}
    if checks.snapshot is not None:
        counts["latest_snapshot"] = (F.count(checks.snapshot) > 0).cast("int"), 1, "blocks"
    parts = [quality.presence({area: df}, {area: checks.least})]
    if ratios or counts:
        parts.append(quality.checks(rows, area, ratios, counts))
    if checks.labels and dictionary is not None:
        parts.append(quality.dictionary_checks(rows, area, checks.labels, dictionary))
    return reduce(DataFrame.unionByName, parts)


def delivery_status(tables: dict[str, DataFrame | None], checks: dict[str, TableChecks] = PUBLISHED) -> DataFrame:
    """All checks of all tables."""
    like = next(df for df in tables.values() if df is not None)
    dictionary = tables.get("label_dictionary")
    return reduce(DataFrame.unionByName, [table_status(tables.get(area), area, c, dictionary, like) for area, c in checks.items()])


def observed(df: DataFrame, area: str, checks: TableChecks) -> tuple[DataFrame, Observation]:
    """``df`` whose next action also counts rows, filled cells and shares, so that writing and checking are one pass.

    ``observed_status`` turns the observation into check rows; distinct counts
    need a shuffle and stay with ``delivery_status``.
    """
    watch = Observation(f"delivery-{area}")
    conditions = {f"{c}_fill": filled(c) for c in checks.fills} | {m: F.coalesce(F.expr(c), F.lit(False)) for m, (c, _, _) in checks.shares.items()}
    return df.observe(watch, F.count(F.lit(1)).alias("rows"), *(F.count_if(c).alias(m) for m, c in conditions.items())), watch


def observed_status(watch: Observation, area: str, checks: TableChecks) -> list[tuple[str, str, float, float, str]]:
    """(area, metric, value, target, status) rows of an observed write."""
    got = watch.get
    rows = got["rows"]
    out = [(area, "row_count", float(rows), float(checks.least), "OK" if rows >= checks.least else "BLOCK")]
    bounds = {f"{c}_fill": b for c, b in checks.fills.items()} | {m: (ok, warn) for m, (_, ok, warn) in checks.shares.items()}
    for metric, (ok, warn) in bounds.items():
        share = got[metric] / rows if rows else 0.0
        out.append((area, metric, share, ok, "OK" if share >= ok else "WARN" if share >= warn else "BLOCK"))
    return out
