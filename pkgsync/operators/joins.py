"""Join helpers: broadcast only behind a checked size bound."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A hash of a join's key columns, the first column of the key.
KEY_HASH = "_key"

# A small side (catalogue, repository ledger, offset tables) stays far below this.
DEFAULT_MAX_BROADCAST_ROWS = 200_000


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Return ``broadcast(df)`` when it has at most ``max_rows`` rows, else ``df``.

    The check reads at most ``max_rows + 1`` rows (a bounded job), so it is cheap
    for the small sides it is meant for.  Beyond the bound the join falls back to
    whatever Catalyst and AQE choose (sort-merge, or a runtime broadcast when the
    shuffle statistics show the side is small after all).
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def hashed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with ``KEY_HASH``, an int by which its rows are sorted first in a join or aggregate on ``[KEY_HASH, *keys]``.

    Names of one repository have long beginnings in common, and a sort by such texts compares them over and over; by the
    int it is a radix sort, and texts are only compared where ints are equal.  The key columns stay part of the key, so
    rows meet as they would without it, nulls included.
    """
    # First, since Spark takes the order of a join's keys from a ``distinct`` below it.
    return df.drop(KEY_HASH).select(F.hash(*keys).alias(KEY_HASH), "*")
