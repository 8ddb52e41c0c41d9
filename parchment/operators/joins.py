"""Join helpers: broadcast only behind a proven size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side with at most this many rows may be broadcast (query tables, term
# lists, anchors, dimension tables).  Beyond it the join stays a shuffle join
# and AQE may still convert it at run time from measured sizes.
MAX_BROADCAST_ROWS = 200_000


def row_count_at_most(df: DataFrame, bound: int) -> bool:
    """True when ``df`` has at most ``bound`` rows (reads at most bound+1 rows)."""
    return df.limit(bound + 1).count() <= bound


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` if its row count is proven small, else ``df`` unchanged."""
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df


def narrow_side(df: DataFrame) -> DataFrame:
    """The side of a join that is hashed where both are shuffled: the other one, which holds texts or vectors, is
    never sorted, so it does not spill."""
    return df.hint("shuffle_hash")
