"""Joins and set operations between history, shifts, fleet and types.

No broadcast is forced: the planner broadcasts a side only where its size is
known to be under spark.sql.autoBroadcastJoinThreshold, and adaptive execution
splits skewed partitions of the sort-merge joins that remain. Where very few keys
hold all rows, ``split_join`` deals them out by counted sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.functions import codes, fixed


def history_shifts(history: DataFrame, shifts: DataFrame) -> DataFrame:
    """Logons of the given shifts' units."""
    return history.join(shifts, history["unid"] == shifts["unit_name"], "inner").drop("unit_name")


def history_types(history: DataFrame, types: DataFrame) -> DataFrame:
    """Logons with the vehicle's type, null where it is not known.

    Rows without a vehicle match nothing. A second key, of their own values,
    deals them out, or a sort-merge join would send them all to one task.
    """
    dealt = F.coalesce("carid", F.concat(F.lit("none "), F.xxhash64(*history.columns).cast("string")))
    keyed = history.withColumn("_dealt", dealt)
    same = (keyed["_dealt"] == types["vehicle"]) & (keyed["carid"] == types["vehicle"])
    return keyed.join(types, same, "left").drop("vehicle", "_dealt")


def shifts_history_outer(history: DataFrame, shifts: DataFrame) -> DataFrame:
    """As history_shifts, and units without a logon stay."""
    return (
        history.withColumnRenamed("unid", "_unid")
        .join(shifts, F.col("_unid") == F.col("unit_name"), "right")
        .drop("_unid")
        .withColumnRenamed("unit_name", "unid")
    )


def history_workload(history: DataFrame, workload: DataFrame) -> DataFrame:
    return history.join(workload, ["unid", "cdts"], "inner")


def keyed_inner(history: DataFrame, shifts: DataFrame) -> DataFrame:
    """Logons of the given units with a known vehicle."""
    return history_shifts(history, shifts).where(F.col("carid").isNotNull())


def routine_fleet(vehicles: DataFrame, fleet: DataFrame) -> DataFrame:
    return vehicles.join(fleet, vehicles["carid"] == fleet["vehicle_id"], "left").drop("vehicle_id")


def config_lookup(vehicles: DataFrame, mapping: DataFrame,
                  columns: Sequence[str] = fixed.CONFIG_COLUMNS) -> DataFrame:
    """Unit type by lower-cased configuration; missing values match missing ones."""
    lowered = vehicles.withColumns({name: F.lower(name) for name in columns})
    keys = mapping.select(*[F.lower(name).alias(f"_{name}") for name in columns], "unit_type")
    same = F.lit(True)
    for name in columns:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    return lowered.join(keys, same, "left").drop(*[f"_{name}" for name in columns])


def legacy_types(vehicles: DataFrame, legacy: DataFrame) -> DataFrame:
    listed = legacy.select("ehs_number", "updated")
    return vehicles.join(listed, vehicles["carid"] == listed["ehs_number"], "left").drop("ehs_number")


def semi_in(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose value is among the keys. Keys are reduced to distinct ones
    first, so a key that repeats very often shrinks before the shuffle, which
    then serves the join too."""
    wanted = keys.select(F.col(key).alias("_key")).distinct()
    return df.join(wanted, F.col(column) == F.col("_key"), "left_semi")


def anti_missing(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose value is not among the keys; missing values stay."""
    known = keys.select(F.col(key).alias("_key")).distinct()
    return df.join(known, F.col(column) == F.col("_key"), "left_anti")


def anti_pairs(df: DataFrame, pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(pairs.select(*keys).distinct(), list(keys), "left_anti")


def suffix_join(left: DataFrame, right: DataFrame, key: str,
                suffixes: tuple[str, str] = ("_c", "_d")) -> DataFrame:
    """Left join with the shared measures side by side."""
    rest = [name for name in left.columns if name != key]
    mine = left.select(key, *[F.col(name).alias(name + suffixes[0]) for name in rest])
    theirs = right.select(key, *[F.col(name).alias(name + suffixes[1]) for name in rest])
    return mine.join(theirs, key, "left")


def default_by_kind(history: DataFrame, defaults: Sequence[tuple[str, str]] = fixed.UNIT_KIND_DEFAULTS) -> DataFrame:
    """Logons with the type assumed for their unit letter; other letters drop.

    The table is a handful of constants, so it is a map expression, no join.
    """
    table = F.create_map(*[F.lit(part) for pair in defaults for part in pair])
    return history.withColumn(
        "assumed_type", F.try_element_at(table, codes.unit_letter(F.col("unid")))
    ).where(F.col("assumed_type").isNotNull())


def split_join(large: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner",
               by: Sequence[str] | None = None) -> DataFrame:
    """Inner or left join of a large table with a small one on few keys.

    Rows are counted by key first, in a pass over the keys that combines where the rows
    lie. A key with more rows than a task's even share is cut into so many pieces: its
    rows are dealt by a hash of all columns, or of those in ``by``, and the small table's
    rows for it are repeated, once a piece. Fewer keys than tasks can be that large, so
    their list is short. Rows of equal hash stay together; aggregate them before.
    """
    parts = int(large.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.xxhash64(*keys)
    counts = large.groupBy(key.alias("key")).agg(F.count("*").alias("n"))
    counts = counts.withColumn("share", F.lit(counts.agg(F.sum("n")).scalar()) / parts).where("n > share")
    pieces = {row.key: row.pieces for row in counts.select("key", F.ceil(F.col("n") / F.col("share")).alias("pieces")).collect()}
    if not pieces:
        return large.join(small, list(keys), how)
    many = F.create_map(*[F.lit(v) for pair in pieces.items() for v in pair])
    dealt = large.withColumn("_pieces", F.coalesce(F.try_element_at(many, key), F.lit(1)))
    dealt = dealt.withColumn("_piece", F.pmod(F.xxhash64(*(by or large.columns), F.lit("piece")), "_pieces")).drop("_pieces")
    count = F.coalesce(F.try_element_at(many, key), F.lit(1))
    repeated = small.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), count.cast("long") - 1)))
    return dealt.join(repeated, [*keys, "_piece"], how).drop("_piece")


def group_default(rows: DataFrame, dominant: DataFrame) -> DataFrame:
    """Rows with the dominant type of their group and kind: very few keys for all rows."""
    return split_join(rows, dominant, ["dgroup", "kind"])


def score_join(rows: DataFrame, predictions: DataFrame) -> DataFrame:
    return rows.join(predictions, "unid", "left")


def union_same(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other)
    return first


def union_fill(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Append tables; columns a table lacks are null."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct() if columns else df.distinct()
