"""Stand-ins for the fleet tables, written as SQL over the test tables.

The text is read by Spark and by DuckDB alike, so both sides of a check start
from the same rows. Names in braces are other views or test tables.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


# Two characters per class of vehicle: twelve of ambulances (four digits), then
# SUVs, transports, devices, aircraft and others.
MARKS = "  " * 12 + "4 4 2 2 2 9 C-T-"


def vehicle(v: str) -> str:
    """Vehicle id of a number. Filters on the id are pushed below the view and
    repeat this text, so it is kept short."""
    return f"trim(substr('{MARKS}', CAST(1 + {v} % 20 * 2 AS INT), 2)) || CAST(1000 + {v} AS STRING)"


def block(c: str) -> str:
    return f"CAST(floor({c} / 12) AS BIGINT)"


def unit(c: str) -> str:
    """Unit code of a number and its region: keys 12b and 12b+1 are A/B twins."""
    return f"""substr(r_name, 1, 4) || '-' || CAST(1 + {block(c)} % 9 AS STRING)
        || substr('ABABTPABWLHV', CAST(1 + {c} % 12 AS INT), 1)
        || CAST({block(c)} * 6 + CAST(floor({c} % 12 / 2) AS BIGINT) AS STRING)"""


def by_slot(c: str, values: list[str]) -> str:
    cases = " ".join(f"WHEN {slot} THEN '{value}'" for slot, value in enumerate(values))
    return f"CASE {c} % {len(values)} {cases} END"


KINDS = ["ALS", "ALS", "BLS", "BLS", "BNAT", "PRU", "ALSr", "EMR", "WING", "COMP", "HELI", "OTHER"]
AGENCIES = ["AHSETX", "AHSSCC", "AHSCTX", "AHSCCC", "AHSNTX", "AHSNCC", "AHSATX", "OTHER"]

VIEWS = {
    "unit_history": f"""
        SELECT {unit('user_id')} AS unid,
            CASE WHEN value < 1.5 THEN NULL ELSE {vehicle('v')} END AS carid,
            ts AS cdts2,
            replace(replace(replace(substr(CAST(ts AS STRING), 1, 19), '-', ''), ':', ''), ' ', '') AS cdts
        FROM (SELECT user_id, ts, value, CAST(floor(user_id / 25) AS BIGINT) * 50
                + CASE WHEN value < 30 THEN user_id * 7 % 60
                  ELSE CAST(substr(props, 7, length(props) - 7) AS BIGINT) END AS v FROM {{events}}) e
        JOIN {{region}} ON r_regionkey = {block('user_id')} % 5""",
    "unit_workload": f"""
        SELECT {unit('user_id')} AS unid,
            replace(replace(replace(substr(CAST(ts AS STRING), 1, 19), '-', ''), ':', ''), ' ', '') AS cdts,
            CASE WHEN event_type = 'error' THEN 'OFF' ELSE 'LO' END AS unit_status,
            CAST(floor(value * 400) AS BIGINT) AS time_active
        FROM {{events}} JOIN {{region}} ON r_regionkey = {block('user_id')} % 5""",
    "shift_inventory": f"""
        SELECT c_custkey AS shift_no, {unit('c_custkey')} AS unit_name,
            CASE WHEN c_acctbal < 0 THEN 'Inactive' ELSE 'Active' END AS active_inactive,
            CASE WHEN c_acctbal > 9000 THEN '2024-01-15' WHEN c_acctbal > 8000 THEN '2031-12-31'
                ELSE '' END AS effective_end,
            CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Direct Delivery' WHEN 'BUILDING' THEN 'Direct Delivery'
                WHEN 'FURNITURE' THEN 'Contracted - Private' WHEN 'HOUSEHOLD' THEN 'Contracted - First Nation'
                ELSE 'Contracted - Municipal/Not-for-Profit' END AS service_type,
            n_name AS service,
            CASE WHEN c_custkey % 12 = 11 AND c_acctbal < 2000 THEN 'PLANE' ELSE {by_slot('c_custkey', KINDS)} END
                AS cad_unit_type,
            {by_slot(block('c_custkey'), AGENCIES)} AS agency,
            CASE WHEN c_custkey % 12 = 10 THEN 'Air Crew' ELSE 'Crew' END AS type,
            'D' || CAST(c_nationkey AS STRING) AS district,
            CASE WHEN c_custkey % 2 = 0 THEN 'Weekend' ELSE 'Daily' END AS days
        FROM {{customer}} JOIN {{nation}} ON n_nationkey = c_nationkey
        JOIN {{region}} ON r_regionkey = {block('c_custkey')} % 5""",
    "vehicle_types": f"""
        SELECT {vehicle('p_partkey')} AS vehicle,
            CASE WHEN p_partkey % 20 < 12 THEN CASE WHEN p_size <= 30 THEN 'SC113' WHEN p_size <= 40 THEN 'SC114'
                    WHEN p_size <= 46 THEN 'DS013' ELSE 'SC013' END
                WHEN p_partkey % 20 < 14 THEN 'AA002S'
                WHEN p_partkey % 20 < 17 THEN CASE WHEN p_size <= 35 THEN 'AA002N' ELSE 'WA002N' END
                WHEN p_partkey % 20 = 17 THEN 'GhostVehicle'
                WHEN p_partkey % 20 = 18 THEN CASE WHEN p_size <= 25 THEN 'SS002A.450' ELSE 'SS002H.250' END
                ELSE 'AA002S' END AS vehicle_type,
            CASE WHEN p_size = 50 THEN 0 ELSE 1 END AS active
        FROM {{part}}""",
    # Some ambulances listed under a second type.
    "shared_types": """
        SELECT vehicle, vehicle_type FROM {vehicle_types} WHERE active = 1
        UNION ALL
        SELECT vehicle, CASE vehicle_type WHEN 'SC113' THEN 'SC114' WHEN 'SC114' THEN 'DS013' ELSE 'SC113' END
        FROM {vehicle_types} WHERE active = 1 AND length(vehicle) = 4 AND (vehicle LIKE '%1' OR vehicle LIKE '%4' OR vehicle LIKE '%7')""",
    "vehicle_register": """
        SELECT vehicle AS name, 'V_' || vehicle AS external_key,
            CASE WHEN vehicle_type = 'WA002N' THEN 'UT_WA002N4'
                WHEN substr(vehicle_type, 1, 5) = 'SS002' THEN 'UT_Air_' || vehicle_type
                ELSE 'UT_' || vehicle_type END AS vehicle_type_external_key,
            1 - active AS deleted_status
        FROM {vehicle_types}""",
    "fleet_assets": f"""
        SELECT CASE WHEN p_partkey = 19 THEN 'test123' ELSE {vehicle('p_partkey')} END AS vehicle_id, p_size <> 49 AS is_active,
            CASE p_brand WHEN 'Brand#1' THEN 'Decommissioned 2014' WHEN 'Brand#2' THEN 'Trailer - Utility'
                WHEN 'Brand#11' THEN 'Suv - Tahoe' WHEN 'Brand#12' THEN 'Decom 2013'
                ELSE CASE WHEN p_partkey % 20 < 12 THEN 'AMB III' ELSE 'Support' END END AS classification,
            CASE p_brand WHEN 'Brand#3' THEN 'Decom 2015' WHEN 'Brand#4' THEN 'Admin' WHEN 'Brand#5' THEN 'PRU kit'
                ELSE CASE WHEN p_type = 'ECONOMY' THEN 'BLS' ELSE 'ALS' END END AS stock_level,
            CASE WHEN p_brand = 'Brand#6' THEN 'golf cart' WHEN p_brand = 'Brand#13' THEN 'Small SUV'
                ELSE 'Van ' || CAST(p_size % 3 AS STRING) END AS vehicle_type,
            CASE WHEN p_brand = 'Brand#7' THEN '2015-06-30' ELSE '' END AS decommission_date,
            CASE p_brand WHEN 'Brand#8' THEN 'Chevrolet TAHOE' WHEN 'Brand#9' THEN 'Ford Explorer' ELSE 'E450' END AS model,
            CASE WHEN p_brand = 'Brand#10' THEN 'EMS Community care' ELSE 'EMS' END AS division,
            CASE WHEN p_size % 2 = 0 THEN 'Single' ELSE 'DUAL' END AS stretcher_config,
            CASE WHEN p_type = 'SMALL' THEN 'Manual' ELSE 'Power' END AS stretcher_type,
            CASE WHEN p_size > 45 THEN '150' ELSE '164' END AS pt_comp_size,
            CASE WHEN p_size < 25 THEN 'Fixed' ELSE 'Folding' END AS seating_config,
            CASE WHEN p_size % 5 = 0 THEN '' ELSE 'Side' END AS seating_config2,
            CASE WHEN p_size > 40 THEN '2023-06-15' WHEN p_size < 5 THEN '' ELSE '2010-03-01' END AS in_service_date,
            1975 + p_size AS year
        FROM {{part}}""",
    "config_mapping": """
        SELECT DISTINCT lower(vehicle_type) AS vehicle_type, lower(stock_level) AS stock_level,
            lower(stretcher_config) AS stretcher_config, lower(stretcher_type) AS stretcher_type,
            lower(pt_comp_size) AS pt_comp_size, lower(seating_config) AS seating_config,
            lower(seating_config2) AS seating_config2,
            CASE WHEN pt_comp_size = '150' THEN 'SC114' WHEN stretcher_type = 'Manual' THEN 'UNKNOWN'
                ELSE 'SC113' END AS unit_type
        FROM {fleet_assets}
        WHERE substr(classification, 1, 3) = 'AMB' AND stock_level <> 'BLS'""",
    # As exported: some vehicles stand in the list twice, some under an old name.
    "legacy_export": f"""
        SELECT {vehicle('s_suppkey')} AS ehs_number,
            CASE WHEN s_suppkey % 6 = 0 THEN 'Old ' || s_name ELSE {vehicle('s_suppkey')} END AS name,
            CASE s_nationkey % 4 WHEN 1 THEN 'SC113' WHEN 3 THEN 'DS013' ELSE NULL END AS updated
        FROM {{supplier}}
        UNION ALL
        SELECT {vehicle('s_suppkey')}, CASE WHEN s_suppkey % 6 = 0 THEN 'Old ' || s_name ELSE {vehicle('s_suppkey')} END,
            CASE s_nationkey % 3 WHEN 1 THEN 'SC114' ELSE NULL END
        FROM {{supplier}} WHERE s_suppkey % 3 = 0""",
    "legacy_listing": f"""
        SELECT {vehicle('l_partkey')} AS ehs_number, 'Vehicle ' || CAST(l_partkey % 7 AS STRING) AS name,
            l_returnflag || l_linestatus AS updated, l_shipdate AS listed_at, l_orderkey AS list_no
        FROM {{lineitem}}""",
    "checked_types": """
        SELECT vehicle, vehicle_type AS checked_type FROM {vehicle_types}
        WHERE vehicle_type IN ('SC113', 'DS013') AND active = 1""",
    "vehicle_history": "SELECT vehicle AS carid FROM {vehicle_types}",
    "active_vehicles": "SELECT DISTINCT carid AS name FROM {unit_history} WHERE carid IS NOT NULL",
    "stored_expected": """
        SELECT unit_name AS grouped_unit_name, 'LUT_' || unit_name AS lut_key,
            CASE WHEN effective_end = '2024-01-15' THEN NULL WHEN cad_unit_type IN ('BNAT', 'ALS') THEN 'UT_SC113'
                WHEN cad_unit_type = 'COMP' THEN 'UT_AA002S' ELSE 'UT_SC002' END AS expected_vehicle_type_key
        FROM {shift_inventory} WHERE service_type <> 'Contracted - Municipal/Not-for-Profit'""",
    "aircraft_expected": """
        SELECT unit_name AS generic,
            CASE WHEN active_inactive = 'Inactive' THEN NULL ELSE 'SS002H.250' END AS expected_unit_type,
            'C-' || CAST(shift_no AS STRING) AS default_vehicle
        FROM {shift_inventory} WHERE cad_unit_type = 'HELI'""",
    "long_history": f"""
        SELECT {unit('l_suppkey')} AS unid, {vehicle('v')} AS carid, l_shipdate AS cdts2
        FROM (SELECT l_suppkey, l_shipdate,
                CASE WHEN l_discount < 0.065 THEN l_suppkey * 10 + l_linenumber ELSE l_partkey END AS v
              FROM {{lineitem}}) l
        JOIN {{region}} ON r_regionkey = {block('l_suppkey')} % 5""",
    "survey_answers": f"""
        SELECT {vehicle('p_partkey')} AS ehs_number,
            CASE p_type WHEN 'ECONOMY' THEN 'ALS' WHEN 'STANDARD' THEN 'BLS' WHEN 'MEDIUM' THEN 'NICU'
                WHEN 'PROMO' THEN 'Bariatric Level 2' WHEN 'LARGE' THEN 'Other' ELSE 'als' END AS stock_level,
            {by_slot('p_size', ['Single', 'Dual', 'Other', ''])} AS stretcher_config,
            {by_slot('p_size', ['Centre', 'Side', 'Center'])} AS stretcher_mount_position,
            {by_slot('p_size', ['Manual', 'Power', 'Auto', 'Other', ''])} AS stretcher_load_type,
            CASE WHEN p_brand = 'Brand#1' THEN '' ELSE p_name END AS stretcher_type,
            CAST(p_size AS STRING) AS max_fixed_seats_incl_driver,
            {by_slot('p_size', ['2.5', '4', '', '-1', 'two'])} AS max_folding_seats,
            {by_slot('p_size', ['Yes', 'No', 'Maybe'])} AS bariatric_level_1_capable,
            {by_slot('p_size', ['Yes', '', 'No', 'no'])} AS fits_isolette
        FROM {{part}}""",
    "transport_answers": f"""
        SELECT {vehicle('p_partkey')} AS ehs_number,
            {by_slot('p_size', ['0', '1', '10', '11', '', '2.0', 'one'])} AS max_stretchers,
            {by_slot('p_size', ['3', '-1', '', '10.5'])} AS max_wheelchairs,
            {by_slot('p_size', ['20', '21', '7', ''])} AS max_ambulatory_patients,
            {by_slot('p_size', ['Yes', 'No', 'yes', '', 'Both'])} AS mixed_use
        FROM {{part}}""",
}


def _names(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{([a-z]\w*)\}", text)))


class Tables:
    """The views over one folder of test tables, as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name in BASE:
                built = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            elif name in VIEWS:
                text = VIEWS[name]
                built = self.spark.sql(text, **{used: getattr(self, used) for used in _names(text)})
            else:
                raise AttributeError(name)
            self._built[name] = built
        return self._built[name]


# Views only the SQL twins use; the queries build these rows with operators.
SQL_VIEWS: dict[str, str] = {}


@lru_cache(maxsize=None)
def _needs(name: str) -> tuple[str, ...]:
    text = VIEWS.get(name) or SQL_VIEWS[name]
    order: list[str] = []
    for used in _names(text):
        if used not in BASE:
            order += [n for n in (*_needs(used), used) if n not in order]
    return tuple(order)


def statement(body: str) -> str:
    """SQL for DuckDB: the views the body names as common table expressions."""
    order: list[str] = []
    for used in _names(body):
        if used not in BASE:
            order += [n for n in (*_needs(used), used) if n not in order]
    plain = lambda text: re.sub(r"\{([a-z]\w*)\}", r"\1", text)
    parts = [f"{name} AS ({plain(VIEWS.get(name) or SQL_VIEWS[name])})" for name in order]
    body = plain(body).strip()
    if not parts:
        return body
    if body.upper().startswith("WITH RECURSIVE"):
        return "WITH RECURSIVE " + ", ".join(parts) + ", " + body[len("WITH RECURSIVE"):]
    if body.upper().startswith("WITH"):
        return "WITH " + ", ".join(parts) + ", " + body[4:]
    return "WITH " + ", ".join(parts) + " " + body
