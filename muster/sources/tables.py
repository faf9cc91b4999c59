"""Readers: delimited text, Parquet and database tables into the schemas."""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muster.functions import codes
from muster.sources import quality
from muster.sources.quality import Gate, Measures
from muster.sources.schemas import HEADINGS, NULLABLE_TEXT, SCHEMAS


def snake(heading: str) -> str:
    name = re.sub(r"[^0-9a-z]+", "_", heading.strip().lower()).strip("_")
    return HEADINGS.get(name, name)


def _typed(column: F.Column, kind: T.DataType) -> F.Column:
    if isinstance(kind, T.TimestampNTZType):
        return codes.time_of(column.cast("string"))
    if isinstance(kind, (T.IntegerType, T.LongType)):
        return codes.whole_number(column.cast("string")).cast(kind)
    if isinstance(kind, T.BooleanType):
        return column.cast("string").try_cast("boolean")
    return column.cast(kind)


def conform(df: DataFrame, table: str, *more: F.Column) -> DataFrame:
    """Rename, type and select the columns of a table, and ``more`` columns; blank text is ''."""
    found = {snake(name): name for name in df.columns}
    schema = SCHEMAS[table]
    missing = [field.name for field in schema if field.name not in found]
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    keep = set(NULLABLE_TEXT.get(table, []))
    columns = []
    for field in schema:
        column = F.col(f"`{found[field.name]}`")
        if df.schema[found[field.name]].dataType != field.dataType:
            column = _typed(column, field.dataType)
        if isinstance(field.dataType, T.StringType):
            column = F.nullif(column, F.lit("")) if field.name in keep else codes.blank(column)
        columns.append(column.alias(field.name))
    return df.select(*columns, *more)


def header_groups(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files by their headings, in a stated order. One line of each file is read, of
    up to 100 files in one job."""
    files = sorted(spark.read.text(path).inputFiles())
    # input files are named as addresses, in which a space is written %20
    files = [unquote(name) for name in files]
    groups: dict[tuple[str, ...], list[str]] = {}
    for first in range(0, len(files), 100):
        part = files[first:first + 100]
        lines = [spark.read.text(name).limit(1).select(F.lit(i).alias("file"), "value") for i, name in enumerate(part)]
        found = {r.file: r.value for r in reduce(DataFrame.unionByName, lines).collect()}
        for i, name in enumerate(part):
            # an empty file has no header and no rows
            if (found.get(i) or "").strip():
                groups.setdefault(tuple(next(csv.reader([found[i].lstrip("\ufeff")]))), []).append(name)
    return groups


MALFORMED = "_malformed"


def _read_groups(spark: SparkSession, path: str, table: str) -> list[DataFrame]:
    """The rows of each group of files with equal headings, typed by name, with the text of
    a malformed row, its file and its first field. Every column is read as text, then typed,
    so no inference pass runs over the data."""
    parts = []
    for headings, files in header_groups(spark, path).items():
        schema = T.StructType([T.StructField(name, T.StringType()) for name in (*headings, MALFORMED)])
        raw = spark.read.schema(schema).option("header", True).option("nullValue", "NA").option("mode", "PERMISSIVE")
        # All fields are parsed, whatever is asked for, or a row would be whole to one query and not to another.
        raw = raw.option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False).csv(files)
        field = F.col(f"`{headings[0]}`")
        # Always true: Spark refuses to read the text of malformed rows alone, as a count would.
        raw = raw.where(F.length(F.coalesce(field, F.lit(""))) >= 0)
        parts.append(conform(raw, table, F.col(MALFORMED), F.col("_metadata.file_path").alias("_file"),
                             field.alias("_field"), F.lit(len(headings)).alias("_fields")))
    if not parts:
        empty = T.StructType([*SCHEMAS[table], *(T.StructField(n, T.StringType()) for n in (MALFORMED, "_file", "_field")),
                              T.StructField("_fields", T.IntegerType())])
        parts.append(spark.createDataFrame([], empty))
    return parts


def load_csv(spark: SparkSession, path: str, table: str, measures: Measures | None = None) -> DataFrame:
    """Delimited text with a header in each file. Files may have their columns in
    different orders, and columns the table does not need; each file is read by its own
    header. A row with more or fewer fields than its header stays out: ``quarantine``
    has it, and ``measures`` the number of such rows."""
    parts = []
    for part in _read_groups(spark, path, table):
        if measures:
            part = measures.observe(part, table, malformed=F.count(MALFORMED))
        parts.append(part.where(F.col(MALFORMED).isNull()).select(*SCHEMAS[table].names))
    return reduce(DataFrame.unionByName, parts)


def quarantine(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The rows ``load_csv`` leaves out: table, file, reason and the row's text."""
    def reason(fields: F.Column) -> F.Column:
        return F.concat(F.lit("not "), fields.cast("string"), F.lit(" fields, first "), F.coalesce("_field", F.lit("none")))

    parts = [
        part.where(F.col(MALFORMED).isNotNull()).select(
            F.lit(table).alias("table"), F.col("_file").alias("file"), reason(F.col("_fields")).alias("reason"),
            F.col(MALFORMED).alias("record"))
        for part in _read_groups(spark, path, table)
    ]
    return reduce(DataFrame.unionByName, parts)


def load_parquet(spark: SparkSession, path: str, table: str) -> DataFrame:
    return conform(spark.read.parquet(path), table)


def load_database(spark: SparkSession, url: str, source: str, table: str,
                  split: Mapping[str, str] | None = None,
                  options: Mapping[str, str] | None = None) -> DataFrame:
    """Database table. ``split`` holds partitionColumn, lowerBound, upperBound
    and numPartitions, so a large table is read by many tasks; filters and
    column choices made later are pushed into the database."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", source)
    return conform(reader.options(**(split or {})).options(**(options or {})).load(), table)


READERS = {"csv": load_csv, "parquet": load_parquet}


def load(spark: SparkSession, paths: Mapping[str, str], kind: str = "csv", *, gates: Mapping[str, Gate] = quality.GATES,
         measures: Measures | None = None) -> dict[str, DataFrame]:
    """Named tables from a mapping of table name to path, each behind its gate."""
    def read(table: str, path: str) -> DataFrame:
        if kind == "csv":
            return load_csv(spark, path, table, measures)
        return READERS[kind](spark, path, table)

    return {table: quality.checked(read(table, path), table, gates=gates, measures=measures) for table, path in paths.items()}


def active_vehicle_types(types: DataFrame) -> DataFrame:
    return types.where(F.col("active") == 1).select("vehicle", "vehicle_type")


def vehicle_types(register: DataFrame) -> DataFrame:
    """Vehicles of the register that were not deleted."""
    return register.where(F.col("deleted_status") == 0).select(
        "name", "external_key", "vehicle_type_external_key"
    )


def shifts(inventory: DataFrame) -> DataFrame:
    """Active shifts. Row order is left to the writer: see publish.ordered."""
    return inventory.where(F.col("active_inactive") == "Active")


def stored_assignments(stored: DataFrame) -> DataFrame:
    return stored.select("grouped_unit_name", "lut_key", "expected_vehicle_type_key")


def sheet_assignments(aircraft: DataFrame) -> DataFrame:
    """Aircraft rows of the workbook sheet, exported as a table."""
    return aircraft.select("generic", "expected_unit_type", "default_vehicle")
