"""Row numbers within a few very large groups, and running sums over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from muster.session import cut


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "place") -> DataFrame:
    """Number rows from 1 within each group in the given order.

    A row_number window would sort each group in one task. Here the rows are
    range-partitioned by (group, order), so a large group spreads over many
    partitions; each partition numbers its own stretch and adds the count of
    the stretches before it. The partitioned rows are checkpointed, so a
    partition's number stays the same when a task is run again.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = cut(
        df.repartitionByRange(parts, *group, *order).withColumn("_stretch", F.spark_partition_id())
    )
    # At most one row per (group, partition).
    before = Window.partitionBy(*group).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        spread.groupBy(*group, "_stretch")
        .agg(F.count("*").alias("_rows"))
        .select(*group, "_stretch", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy(*group, "_stretch").orderBy(*order)
    return (
        spread.withColumn("_row", F.row_number().over(within))
        .join(offsets, [*group, "_stretch"])
        .withColumn(name, F.col("_row") + F.col("_offset"))
        .drop("_row", "_offset", "_stretch")
    )


def running_sums(df: DataFrame, order: str, value: str, name: str, total: str) -> DataFrame:
    """Add the sum of ``value`` up to each row in the order of a column of distinct
    values, and over all rows.

    Two levels: rows are range-partitioned, each stretch is summed on its own, and a
    row adds the sums of the stretches before its own, one number a partition. No
    task sees more than its stretch. The partitioned rows are checkpointed.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = cut(df.repartitionByRange(parts, order).withColumn("_stretch", F.spark_partition_id()))
    sums = spread.groupBy("_stretch").agg(F.sum(value).alias("_sum"))
    every = sums.agg(F.collect_list(F.struct("_stretch", "_sum")))
    within = Window.partitionBy("_stretch").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = spread.withColumn("_within", F.sum(value).over(within)).withColumn("_sums", every.scalar())

    def added(pick):
        return F.aggregate(F.filter("_sums", pick), F.lit(0).cast("long"), lambda acc, s: acc + s["_sum"])

    return rows.withColumns({
        name: F.col("_within") + added(lambda s: s["_stretch"] < F.col("_stretch")), total: added(lambda s: F.lit(True)),
    }).drop("_stretch", "_within", "_sums")
