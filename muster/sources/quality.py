"""Checks on loaded tables.

``checked`` puts a table's gate into its plan: it counts while the rows are read, in
the same pass, and stops the job at a row that breaks a rule. ``violations`` counts
on their own, for a report.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Gate:
    """Columns that may not be empty, and keys of which the first row counts, or that
    may not repeat at all (``doubled`` is ``first`` or ``stop``)."""

    filled: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    doubled: str = "first"


#: What every load of these tables has to satisfy.
GATES = {
    "fleet_assets": Gate(filled=("vehicle_id",)),
    "legacy_vehicles": Gate(filled=("ehs_number",), keys=("ehs_number", "name")),
}
#: The same, and no key of a register may repeat.
STRICT = {
    "fleet_assets": Gate(("vehicle_id",), ("vehicle_id",), "stop"),
    "legacy_vehicles": Gate(("ehs_number",), ("ehs_number", "name"), "stop"),
    "vehicle_register": Gate(("name",), ("name",), "stop"),
    "shift_inventory": Gate(("unit_name",), ("unit_name",), "stop"),
    "stored_expected": Gate(("lut_key",), ("lut_key",), "stop"),
}


class Measures:
    """What was counted while tables were read: rows, empty columns, repeated keys and,
    for text files, malformed rows. The counts of a table are those of the first job that
    read it to the end; ``of`` waits for that job."""

    def __init__(self):
        self._taken: dict[str, list[Observation]] = {}

    def observe(self, df: DataFrame, table: str, **counts: Column) -> DataFrame:
        taken = Observation()
        self._taken.setdefault(table, []).append(taken)
        return df.observe(taken, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(name) for name, c in counts.items()])

    def of(self, table: str) -> dict[str, int]:
        """Counts by name; parts of a table that were read apart add up."""
        total: dict[str, int] = {}
        for taken in self._taken[table]:
            for name, count in taken.get.items():
                total[name] = total.get(name, 0) + count
        return total


def empty_key(column: str) -> Column:
    return F.count_if(F.col(column).isNull() | (F.col(column) == ""))


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row with a violation count per rule."""
    return df.agg(*[rule.cast("bigint").alias(name) for name, rule in rules.items()])


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of key values that occur more than once, counted in two steps so
    a very frequent key is first reduced where it lies."""
    return df.groupBy(*keys).count().agg(F.count_if(F.col("count") > 1).alias("repeated_keys"))


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [name for name in required if name not in df.columns]


def require(df: DataFrame, rules: Mapping[str, Column], table: str) -> DataFrame:
    """Strict form: the rows unchanged, or an error naming the broken rule.

    The checks are per-row conditions, so no extra pass is needed: the scan
    that first meets a bad row fails.
    """
    for name, broken in rules.items():
        guard = F.when(broken, F.raise_error(F.lit(f"{table}: {name}")).cast("boolean")).otherwise(True)
        df = df.where(guard)
    return df


def dedupe_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in a stated order.

    ``min_by`` keeps one row per key on the map side, so a key with very many
    copies does not gather in one task as a row_number window would.
    """
    rest = [name for name in df.columns if name not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*[F.col(name) for name in order]))
    return df.groupBy(*keys).agg(first.alias("_first")).select(*keys, "_first.*")


def checked(df: DataFrame, table: str, *, gates: Mapping[str, Gate] = GATES, measures: Measures | None = None) -> DataFrame:
    """The rows of ``table`` behind its gate; a table without one comes back as it is.

    A row with an empty column stops the job with the rule's name. Of rows with equal
    keys the one of the smallest other columns stays, known values before missing ones,
    or the job stops. Equal keys are brought together once, for both; nothing is read
    twice. ``measures`` takes the counts.
    """
    gate = gates.get(table)
    if gate is None:
        return df
    if measures:
        empty = {f"empty_{name}": empty_key(name) for name in gate.filled}
        df = measures.observe(df, table, rows=F.count("*"), **empty)
    df = require(df, {f"empty {name}": F.col(name).isNull() | (F.col(name) == "") for name in gate.filled}, table)
    if not gate.keys:
        return df
    columns = df.columns
    rest = [name for name in columns if name not in gate.keys]
    order = [e for name in rest for e in (F.col(name).isNull(), F.col(name))]
    first = F.min_by(F.struct(*rest), F.struct(*order)) if rest else F.lit(None)
    found = df.groupBy(*gate.keys).agg(first.alias("_first"), F.count("*").alias("_copies"))
    if measures:
        found = measures.observe(found, table, repeated_keys=F.count_if(F.col("_copies") > 1))
    if gate.doubled == "stop":
        found = require(found, {f"repeated {', '.join(gate.keys)}": F.col("_copies") > 1}, table)
    return found.select(*gate.keys, *([F.col("_first.*")] if rest else [])).select(*columns)
