"""Which vehicles are SUVs in real use?"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from muster.operators import fleet, publish
from muster.sources import quality


def run(history: DataFrame, shifts: DataFrame, assets: DataFrame, *, as_of: dt.date,
        since: dt.date = dt.date(2019, 1, 1)) -> DataFrame:
    assets = quality.checked(assets, "fleet_assets")
    return publish.stage_vehicles(
        fleet.suv_assignments(history, shifts, assets, as_of=as_of, since=since), as_of=as_of
    )
