"""Writers for repository-partitioned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def by_repository(df: DataFrame, sort_cols: list[str] | tuple = ()) -> DataFrame:
    """Prepare ``df`` for ``write.partitionBy("repository")``.

    The ``rebalance`` hint hash-partitions on the repository, so a task writes
    one repository folder rather than one file into every folder; AQE then
    splits a partition far above the advisory size (a repository holding most
    rows is written by many tasks) and merges small ones.  Unlike a range
    partitioning there is no sampling pass, so the input -- often a multi-join
    plan -- is computed once.  ``sort_cols`` order rows inside each file
    (tight min/max statistics for later filters).
    """
    out = df.hint("rebalance", "repository")
    return out.sortWithinPartitions(*sort_cols) if sort_cols else out
