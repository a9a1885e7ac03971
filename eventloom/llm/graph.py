"""Connected components with tables of the shared folder between the rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.graph import connected
from .common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(v, c): each vertex of ``edges`` (a, b long) with the smallest vertex that it reaches."""
    return connected(edges, lambda df: scratch.put(df, "component"))
