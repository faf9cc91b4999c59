"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: str = "8", name: str = "muster", shuffle_partitions: int = 8,
                  settings: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # Generated code for the test views can pass the 8,000 bytecodes above
        # which the JVM leaves a method uncompiled.
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names. Only a local session may go without:
    it gets a folder of its own, where a cluster's executors would not find it."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir() is None:
        if not (context.master or "").split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="muster-checkpoint-"))
    return context.getCheckpointDir()


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager)


TASK_ROWS = 250_000  # rows of one task that sorts and keeps tables of them


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Number of tasks that take ``TASK_ROWS`` rows at most, if keys allow. A shuffle into a given
    number is not joined into larger parts by adaptive execution, whose measure is compressed bytes."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def small_table(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A handful of fixed rows as a DataFrame, built without Python workers."""
    structs = [F.struct(*[F.lit(value).alias(name) for name, value in zip(names, row)]) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))
