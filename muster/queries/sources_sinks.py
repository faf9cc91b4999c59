"""Sources, checks, filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from muster.functions import codes
from muster.operators import expected, filters, fleet
from muster.plans import production
from muster.queries.registry import AS_OF, query
from muster.queries.views import SQL_VIEWS
from muster.sources import quality, tables

SQL_VIEWS.update(
    {
        "running_shifts": """
            SELECT * FROM {shift_inventory} WHERE active_inactive = 'Active'
            AND (effective_end = '' OR CAST(effective_end AS DATE) > DATE '2024-02-01')""",
        "contracted_shifts": "SELECT * FROM {running_shifts} WHERE service_type LIKE 'Contracted - %'",
        "direct_shifts": "SELECT * FROM {running_shifts} WHERE service_type = 'Direct Delivery'",
        "serving_fleet": """
            SELECT * FROM {fleet_assets} WHERE is_active AND classification NOT LIKE 'Decom%'
            AND decommission_date = '' AND stock_level NOT LIKE 'Decom%' AND classification NOT LIKE 'Trailer%'
            AND lower(vehicle_type) NOT LIKE 'golf%' AND vehicle_id NOT IN ('Spare', 'test123', 'test(ALS)')""",
        "worked_history": """
            SELECT * FROM (
                SELECT h.unid, h.cdts, h.carid, h.cdts2, w.unit_status, w.time_active,
                    row_number() OVER (PARTITION BY h.unid ORDER BY h.cdts2 DESC, h.carid, h.cdts) AS row_no
                FROM {unit_history} h JOIN {unit_workload} w ON h.unid = w.unid AND h.cdts = w.cdts
                WHERE h.carid IS NOT NULL AND substr(h.cdts, 1, 8) > '20181001' AND w.unit_status = 'LO'
                    AND w.time_active >= 10800)
            WHERE row_no <= 90""",
    }
)

FLEET = "vehicle_id, is_active, classification, stock_level, vehicle_type, decommission_date, model, division, year"


@query("load_tables", "SELECT unid, coalesce(carid, '-') AS carid, cdts2, cdts FROM {unit_history}")
def _(t):
    return tables.conform(t.unit_history, "unit_history").na.fill("-", ["carid"])


@query("load_mapping", "SELECT * FROM {config_mapping}")
def _(t):
    return tables.conform(t.config_mapping, "config_mapping")


@query("load_sheet", "SELECT generic, expected_unit_type, default_vehicle FROM {aircraft_expected}")
def _(t):
    return tables.sheet_assignments(tables.conform(t.aircraft_expected, "aircraft_expected"))


@query("read_history", "SELECT unid, cdts, carid, cdts2, unit_status, time_active, row_no FROM {worked_history}")
def _(t):
    return expected.read_history(t.unit_history, t.unit_workload).withColumn("row_no", F.col("row_no").cast("bigint"))


@query(
    "read_vehicle_types",
    "SELECT name, external_key, vehicle_type_external_key FROM {vehicle_register} WHERE deleted_status = 0",
)
def _(t):
    return tables.vehicle_types(t.vehicle_register)


@query("read_shifts", "SELECT * FROM {shift_inventory} WHERE active_inactive = 'Active' ORDER BY unit_name")
def _(t):
    return tables.shifts(t.shift_inventory).orderBy("unit_name")


@query("read_expected", "SELECT grouped_unit_name, lut_key, expected_vehicle_type_key FROM {stored_expected}")
def _(t):
    return tables.stored_assignments(t.stored_expected)


@query("active_vehicle_types", "SELECT vehicle, vehicle_type FROM {vehicle_types} WHERE active = 1")
def _(t):
    return tables.active_vehicle_types(t.vehicle_types)


@query(
    "quality_gates",
    """SELECT 'fleet_assets' AS source, CAST(count(*) FILTER (WHERE vehicle_id IS NULL OR vehicle_id = '') AS BIGINT)
            AS empty_key, CAST(count(*) FILTER (WHERE classification = '') AS BIGINT) AS blank_class,
            (SELECT count(*) FROM (SELECT vehicle_id FROM {fleet_assets} GROUP BY 1 HAVING count(*) > 1))
            AS repeated_keys FROM {fleet_assets}
       UNION ALL SELECT 'legacy_listing', count(*) FILTER (WHERE ehs_number IS NULL OR ehs_number = ''),
            count(*) FILTER (WHERE updated = ''),
            (SELECT count(*) FROM (SELECT ehs_number, name FROM {legacy_listing} GROUP BY 1, 2 HAVING count(*) > 1))
            FROM {legacy_listing}
       UNION ALL SELECT 'unit_history', count(*) FILTER (WHERE carid IS NULL OR carid = ''),
            count(*) FILTER (WHERE unid = ''),
            (SELECT count(*) FROM (SELECT unid, cdts2 FROM {unit_history} GROUP BY 1, 2 HAVING count(*) > 1))
            FROM {unit_history}""",
)
def _(t):
    def gate(df, name, key, text, keys):
        counts = quality.violations(
            df, {"empty_key": quality.empty_key(key), "blank_class": F.count_if(F.col(text) == "")}
        )
        repeats = quality.repeated_keys(df, keys).scalar()
        return counts.select(F.lit(name).alias("source"), "empty_key", "blank_class", repeats.alias("repeated_keys"))

    return (
        gate(t.fleet_assets, "fleet_assets", "vehicle_id", "classification", ["vehicle_id"])
        .union(gate(t.legacy_listing, "legacy_listing", "ehs_number", "updated", ["ehs_number", "name"]))
        .union(gate(t.unit_history, "unit_history", "carid", "unid", ["unid", "cdts2"]))
    )


@query(
    "dedupe_by_key",
    """SELECT ehs_number, name, updated, listed_at, list_no FROM (
         SELECT *, row_number() OVER (PARTITION BY ehs_number, name ORDER BY listed_at, list_no, updated) AS r
         FROM {legacy_listing}) WHERE r = 1""",
)
def _(t):
    return quality.dedupe_by_key(t.legacy_listing, ["ehs_number", "name"], ["listed_at", "list_no", "updated"])


@query("numeric_vehicles", "SELECT unid, carid, cdts2 FROM {unit_history} WHERE regexp_full_match(carid, '[0-9]+')")
def _(t):
    return filters.numeric_vehicles(t.unit_history).select("unid", "carid", "cdts2")


@query("in_service_fleet", f"SELECT {FLEET} FROM {{serving_fleet}}")
def _(t):
    return filters.in_service_fleet(t.fleet_assets).select(*FLEET.split(", "))


@query(
    "in_service_fleet_legacy",
    f"""SELECT {FLEET} FROM {{fleet_assets}} WHERE classification NOT LIKE 'Decommis%' AND decommission_date = ''
        AND stock_level NOT LIKE 'Decommis%' AND classification NOT LIKE 'Trailer%'
        AND vehicle_type NOT ILIKE 'golf%' AND vehicle_id NOT IN ('Spare', 'test123', 'test(ALS)')""",
)
def _(t):
    return filters.in_service_fleet_legacy(t.fleet_assets).select(*FLEET.split(", "))


@query(
    "road_units",
    """SELECT unid, carid, cdts2 FROM {unit_history} WHERE unid NOT LIKE 'XV%' AND unid NOT LIKE 'FRD%'
       AND NOT regexp_matches(unid, '-[0-9][XYVUROKJIGF][0-9]+$') AND NOT regexp_matches(unid, '^[A-Z]{4}[0-9]$')""",
)
def _(t):
    return filters.road_units(t.unit_history).select("unid", "carid", "cdts2")


@query("active_shifts", "SELECT * FROM {running_shifts}")
def _(t):
    return filters.active_shifts(t.shift_inventory, as_of=AS_OF)


@query(
    "service_split",
    """SELECT *, 'contr' AS service_class FROM {contracted_shifts}
       UNION ALL SELECT *, 'direct' FROM {direct_shifts}""",
)
def _(t):
    return filters.service_split(t.shift_inventory, as_of=AS_OF)


@query(
    "recent_fleet",
    f"""SELECT {FLEET} FROM {{fleet_assets}} WHERE vehicle_id IN (SELECT name FROM {{active_vehicles}})
        OR try_cast(in_service_date AS DATE) > DATE '2023-02-01' OR year >= 2023""",
)
def _(t):
    return filters.recent_fleet(t.fleet_assets, t.active_vehicles, as_of=AS_OF).select(*FLEET.split(", "))


@query(
    "fleet_suvs",
    f"""SELECT {FLEET} FROM {{serving_fleet}} WHERE model ILIKE '%tahoe%' OR model ILIKE '%explorer%'
        OR model ILIKE '%yukon%' OR classification ILIKE '%suv%' OR vehicle_type ILIKE '%suv%'
        OR division ILIKE '%community care%' OR stock_level ILIKE '%pru%' OR stock_level ILIKE '%admin%'
        OR stock_level ILIKE '%community%'""",
)
def _(t):
    return filters.fleet_suvs(filters.in_service_fleet(t.fleet_assets)).select(*FLEET.split(", "))


@query(
    "suv_units",
    """SELECT unid, carid, cdts2 FROM {unit_history} WHERE regexp_matches(unid, '-[0-9][PSDMLW][0-9]+$')
       AND length(carid) <> 4 AND NOT regexp_matches(carid, '^9[0-9][0-9]$')""",
)
def _(t):
    return filters.suv_units(t.unit_history).select("unid", "carid", "cdts2")


@query(
    "ambulance_units",
    """SELECT unid, carid, cdts2 FROM {unit_history}
       WHERE regexp_matches(unid, '-[0-9][AB][0-9]+$') AND length(carid) <= 4""",
)
def _(t):
    return filters.short_vehicles(filters.ambulance_units(t.unit_history)).select("unid", "carid", "cdts2")


@query(
    "ground_units",
    """SELECT *, regexp_replace(unit_name, '-([0-9])[AB]([0-9]+)$', '-\\1_\\2') AS generic FROM {shift_inventory}
       WHERE active_inactive = 'Active'
       AND cad_unit_type IN ('ALS', 'BLS', 'PRU', 'ENAT', 'BNAT', 'EMR', 'WING', 'ALSr')""",
)
def _(t):
    return filters.ground_units(t.shift_inventory)


@query(
    "air_units",
    """SELECT *, unit_name AS generic FROM {shift_inventory}
       WHERE active_inactive = 'Active' AND cad_unit_type IN ('HELI', 'FLIGHT')""",
)
def _(t):
    return filters.air_units(t.shift_inventory)


@query(
    "planned_units",
    """SELECT * FROM {shift_inventory}
       WHERE (agency IN ('AHSETX', 'AHSCTX', 'AHSNTX', 'AHSATX') AND type <> 'Air Crew')
          OR (agency IN ('AHSSCC', 'AHSCCC', 'AHSNCC') AND left(unit_name, 4) NOT IN ('AMER', 'EURO'))""",
)
def _(t):
    return filters.planned_units(t.shift_inventory, cities=["AMER", "EURO"])


@query(
    "crew_shift_filter",
    """SELECT * FROM {shift_inventory} WHERE CASE WHEN unit_name IN ('AFRI-1A0', 'AFRI-1B0') THEN days = 'Weekend'
       ELSE cad_unit_type IN ('ALS','BLS','PRU','ENAT','BNAT','EMR','HELI','WING','FLIGHT','ALSr','COMP','SUPER',
       'DELTA','ECHO','MIKE') END""",
)
def _(t):
    return filters.crew_shift_filter(t.shift_inventory, weekend_units=["AFRI-1A0", "AFRI-1B0"])


@query(
    "known_pairs",
    """SELECT h.unid, h.carid, h.cdts2, v.vehicle_type FROM {unit_history} h
       JOIN {vehicle_types} v ON h.carid = v.vehicle AND v.active = 1""",
)
def _(t):
    from muster.operators import joins

    typed = joins.history_types(t.unit_history, tables.active_vehicle_types(t.vehicle_types))
    return filters.known_pairs(typed, "carid", "vehicle_type").select("unid", "carid", "cdts2", "vehicle_type")


@query(
    "mapping_seed",
    """SELECT lower(vehicle_type) AS vehicle_type, lower(stock_level) AS stock_level,
         lower(stretcher_config) AS stretcher_config, lower(stretcher_type) AS stretcher_type,
         lower(pt_comp_size) AS pt_comp_size, lower(seating_config) AS seating_config,
         lower(seating_config2) AS seating_config2
       FROM {serving_fleet} WHERE classification LIKE 'AMB%' GROUP BY ALL""",
)
def _(t):
    return fleet.mapping_seed(t.fleet_assets)


SCALARS = """
    SELECT unit_name, regexp_replace(unit_name, '-([0-9])[AB]([0-9]+)$', '-\\1_\\2') AS generic,
        CASE WHEN regexp_matches(unit_name, '^[A-Z]{4}-[0-9][AB][0-9]+$')
            THEN left(unit_name, 6) || '_' || substr(unit_name, 8) ELSE unit_name END AS grouped,
        CASE substr(unit_name, 7, 1) WHEN 'A' THEN left(unit_name, 6) || 'B' || substr(unit_name, 8)
            WHEN 'B' THEN left(unit_name, 6) || 'A' || substr(unit_name, 8) END AS twin,
        substr(unit_name, 7, 1) AS letter, left(unit_name, 4) AS dgroup,
        CASE WHEN regexp_matches(unit_name, '^[A-Z]{4}') THEN left(unit_name, 4) END AS capitals,
        CASE substr(unit_name, 7, 1) WHEN 'A' THEN 'AMB' WHEN 'B' THEN 'AMB' WHEN 'T' THEN 'NAT' WHEN 'P' THEN 'SUV'
            WHEN 'L' THEN 'SUV' END AS unit_class,
        regexp_replace(service_type, '[^A-Za-z0-9._]', '.', 'g') AS label,
        CAST(nullif(effective_end, '') AS DATE) AS ends_on
    FROM {shift_inventory}"""


@query("scalar_units", SCALARS)
def _(t):
    name = F.col("unit_name")
    return t.shift_inventory.select(
        name, codes.generic_unit(name).alias("generic"), codes.grouped_unit(name).alias("grouped"),
        codes.twin_unit(name).alias("twin"), codes.unit_letter(name).alias("letter"),
        codes.dispatch_group(name).alias("dgroup"), codes.capital_group(name).alias("capitals"),
        codes.unit_class(name).alias("unit_class"), codes.path_label(F.col("service_type")).alias("label"),
        codes.date_of(F.col("effective_end")).alias("ends_on"),
    )


@query(
    "scalar_vehicles",
    """SELECT h.carid, CAST(trunc(try_cast(h.carid AS DOUBLE)) AS BIGINT) AS number, length(h.carid) AS id_length,
         strptime(h.cdts, '%Y%m%d%H%M%S') AS logged_at, year(h.cdts2) * 100 + month(h.cdts2) AS month_no,
         date_trunc('day', h.cdts2) AS day_start
       FROM {unit_history} h""",
)
def _(t):
    return t.unit_history.select(
        "carid", codes.whole_number(F.col("carid")).alias("number"),
        F.length("carid").cast("bigint").alias("id_length"),
        F.try_to_timestamp("cdts", F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz").alias("logged_at"),
        (F.year("cdts2") * 100 + F.month("cdts2")).cast("bigint").alias("month_no"),
        F.date_trunc("day", "cdts2").cast("timestamp_ntz").alias("day_start"),
    )
