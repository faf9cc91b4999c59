"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from muster.session import cut  # noqa: F401  (reliable checkpoint in the shared folder)

WORD = r"[^\x20\x09-\x0D]+"
GAPS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def map_batches(df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], dict]]) -> DataFrame:
    """Run a batch function over Arrow batches. ``make`` is called once per task
    and returns the function; it answers with a list or array per column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(work(batch), schema=types)

    types = to_arrow_schema(_parse_datatype_string(schema))
    return df.mapInArrow(run, schema)


def each_group(df: DataFrame, keys: list[str], schema: str, work: Callable[[dict], dict]) -> DataFrame:
    """Run ``work`` once per key over numpy columns. Rows are dealt by key and sorted,
    and a task streams them, so it holds one key's rows and one batch. For keys whose
    rows are bounded. ``work`` gets and returns a dict of columns; binary and list
    columns come as arrow arrays."""
    types = to_arrow_schema(_parse_datatype_string(schema))
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def tasks(table: pa.Table) -> Iterator[pa.RecordBatch]:
            marks = [table.column(k).to_numpy() for k in keys]
            change = np.any([m[1:] != m[:-1] for m in marks], axis=0)
            edges = [0, *(np.flatnonzero(change) + 1).tolist(), table.num_rows]
            columns = {}
            for name in names:
                column = table.column(name).combine_chunks()
                plain = pa.types.is_primitive(column.type)
                columns[name] = column.to_numpy(zero_copy_only=False) if plain else column
            out: dict[str, list] = {f.name: [] for f in types}
            for a, b in zip(edges, edges[1:]):
                found = work({n: c[a:b] if isinstance(c, np.ndarray) else c.slice(a, b - a) for n, c in columns.items()})
                for name, column in found.items():
                    out[name].append(column)
            yield pa.RecordBatch.from_pydict({n: np.concatenate(c) for n, c in out.items()}, schema=types)

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held)
            last = np.all([table.column(k).to_numpy() == table.column(k)[-1].as_py() for k in keys], axis=0)
            keep = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            if keep:
                yield from tasks(table.slice(0, keep))
                held = table.slice(keep).combine_chunks().to_batches()
        if held:
            yield from tasks(pa.Table.from_batches(held))

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def release(df: DataFrame) -> None:
    """Let Spark drop the shuffle files of what has been written and forgotten: it
    does so when the driver collects its garbage, which may be long after."""
    for _ in range(2):
        gc.collect()
        time.sleep(0.3)  # references are given back by a thread
        df.sparkSession.sparkContext._jvm.System.gc()
