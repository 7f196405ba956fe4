"""Skew-safe ranking within groups.

``row_number() OVER (PARTITION BY g ORDER BY k)`` sends a whole group to one
task.  When one repository holds a third of all packages that task holds a
third of the data.  ``index_within`` gives the same 0-based index with the work
spread over range partitions:

1. range-partition on ``(g, k)`` and sort within partitions -- each partition is
   a contiguous slice of the global order, sized by sampling, so a large group
   spans many partitions;
2. tag rows with their partition id and ``monotonically_increasing_id`` and
   cut lineage with a reliable ``checkpoint()`` (both tags are only stable for
   one materialisation);
3. per (group, partition): row count and the first id -- at most
   ``#groups + #partitions`` rows, a proven bound;
4. a running sum over that small table gives each slice its offset inside the
   group; one broadcast join puts offsets back on the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root
from .joins import bounded_broadcast


def index_within(df: DataFrame, group_cols: list[str], order_cols: list[str], name: str = "idx",
                 num_partitions: int | None = None) -> DataFrame:
    """Add ``name``: 0-based position of each row inside its group, in ``order_cols`` order.

    ``(group_cols + order_cols)`` must be unique (ties would get an arbitrary order).
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    keys = list(group_cols) + list(order_cols)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    slices = tagged.groupBy(*group_cols, "_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    w = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_offset", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    # #slices <= #groups + #partitions; size checked before broadcasting.
    slices = bounded_broadcast(slices.select(*group_cols, "_pid", "_offset", "_first"))
    return (
        tagged.join(slices, [*group_cols, "_pid"], "inner")
        .withColumn(name, (F.col("_offset") + F.col("_mid") - F.col("_first")).cast("bigint"))
        .drop("_pid", "_mid", "_first", "_offset")
    )
