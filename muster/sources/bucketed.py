"""History kept in buckets by unit.

History and workload are stored once in equal buckets by unit, each sorted by unit and
time. Their join on (unit, time) and the newest logons of a unit then run bucket by
bucket, without an exchange. A unit's rows lie in one bucket, so this suits histories
in which no unit holds a large share of all rows; ``expected.read_history`` over plain
tables cuts such a unit down before its rows move.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from muster.operators import expected

#: A join on (unit, time) may use tables bucketed by unit alone.
SETTING = "spark.sql.requireAllClusterKeysForCoPartition"


def store(df: DataFrame, name: str, *, buckets: int, key: str = "unid", order: Sequence[str] = ("unid", "cdts")) -> None:
    """Write a table of the catalog in buckets, one file a bucket; a table of that name must not exist."""
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(*order).mode("errorifexists").saveAsTable(name)


def read_history(spark: SparkSession, history: str, workload: str, **rules) -> DataFrame:
    """``expected.read_history`` over two stored tables of equally many buckets. Sets SETTING for the session."""
    spark.conf.set(SETTING, "false")
    return expected.read_history(spark.table(history), spark.table(workload), **rules)
