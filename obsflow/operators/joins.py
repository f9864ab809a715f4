"""Join helpers: fact-to-dimension joins and key-set comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension is broadcast only after its row count has been checked against this bound;
# beyond it the join is left to a shuffle (and to AQE, which may still broadcast it once
# the runtime size is known).
MAX_BROADCAST_ROWS = 2_000_000


def bounded_broadcast(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Return ``dim`` with a broadcast hint only if it holds at most ``max_rows`` rows.

    The check is one count over the (small) dimension; the fact side is never counted.
    """
    n = dim.limit(max_rows + 1).count()
    return F.broadcast(dim) if n <= max_rows else dim


def lookup_join(fact: DataFrame, dim: DataFrame, keys: Sequence[str] | str, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Left outer equi-join fact → dimension that keeps unmatched facts (JN-1, JN-2)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return fact.join(bounded_broadcast(dim, max_rows), keys, "left")


def anti_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key is absent from ``right`` (set difference on keys)."""
    return left.join(right.select(*keys).distinct(), list(keys), "left_anti")


def semi_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key is present in ``right``."""
    return left.join(right.select(*keys).distinct(), list(keys), "left_semi")
