"""Production form of the expected type: calculate, update, test."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from muster.functions import fixed
from muster.operators import evaluate, expected, filters, publish
from muster.session import cut
from muster.sources import tables, versions


def rows(history: DataFrame, workload: DataFrame, inventory: DataFrame, register: DataFrame, *,
         apply_filter: bool = False) -> DataFrame:
    """Logons of all active units with type key, default type and grouped unit.

    At most 90 logons per unit. They are checkpointed, as counting, defaults,
    splitting and every setting of a test read them again.
    """
    shifts = filters.crew_shift_filter(tables.shifts(inventory), apply_filter=apply_filter)
    return cut(
        expected.production_rows(expected.read_history(history, workload), shifts, tables.vehicle_types(register))
    )


def assignments(production: DataFrame, *, k: int = 7, threshold: float = 0.5) -> DataFrame:
    types = expected.production_types(production, [(k, threshold)])
    return publish.assignment_keys(production, types)


def update(production: DataFrame, stored: DataFrame, *, k: int = 7, threshold: float = 0.5) -> DataFrame:
    """Change set against the stored table; publish.stored_after applies it."""
    return publish.expected_changes(
        assignments(production, k=k, threshold=threshold), tables.stored_assignments(stored)
    )


def write_update(production: DataFrame, stored: DataFrame, path: str, *, k: int = 7,
                 threshold: float = 0.5) -> DataFrame:
    """Write the stored table with the change set applied as a new version.

    ``path`` must not exist yet: the version it is made from stays as it is. The
    result is the new version read again; an update against it is empty.
    """
    changes = cut(update(production, stored, k=k, threshold=threshold))
    publish.write_parquet(publish.stored_after(tables.stored_assignments(stored), changes), path, mode="errorifexists")
    return production.sparkSession.read.parquet(path)


def commit_update(production: DataFrame, store: versions.Versions, *, k: int = 7, threshold: float = 0.5) -> versions.Version:
    """Change the newest version of a store and commit the result as the next one.

    Refused with ``StaleVersion`` if another update is committed meanwhile; called again
    it starts from that one. An update without changes commits nothing.
    """
    newest = store.current()
    if newest is None:
        raise ValueError("the store has no version to update")
    changes = cut(update(production, newest.rows, k=k, threshold=threshold))
    if changes.isEmpty():
        return newest
    return store.commit(publish.stored_after(tables.stored_assignments(newest.rows), changes), newest.number)


def test(production: DataFrame, inventory: DataFrame, *, as_of: dt.date, days: int = 30,
         settings: Sequence[tuple[int, float]] = fixed.SWEEP_SETTINGS, apply_filter: bool = False) -> dict[str, DataFrame]:
    """Match counts of all settings over the last days, in total and by day.

    ``apply_filter`` as for ``rows``: a unit the crew filter dropped stays out.
    """
    cutoff = dt.datetime.combine(as_of - dt.timedelta(days=days), dt.time())
    shifts = filters.crew_shift_filter(tables.shifts(inventory), apply_filter=apply_filter)
    scored = evaluate.holdout_rows(production, shifts, cutoff=cutoff, settings=settings)
    return {
        "total": evaluate.match_metrics(scored, "k", "threshold"),
        "daily": evaluate.daily_metrics(scored),
    }
