"""Joins, vehicle use, fleet types, SUVs and contractors."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from muster.operators import contractors, filters, fleet, forms, joins, publish, usage
from muster.plans import ambulance, contractor, suv
from muster.queries.registry import AS_OF, query
from muster.queries.views import SQL_VIEWS
from muster.sources import quality, tables

SQL_VIEWS.update(
    {
        "legacy_vehicles": "SELECT ehs_number, name, min(updated) AS updated FROM {legacy_export} GROUP BY 1, 2",
        "ambulance_logons": """
            SELECT h.unid, h.carid, h.cdts2, h.cdts FROM {unit_history} h
            WHERE regexp_full_match(carid, '[0-9]+') AND length(carid) <= 4
              AND regexp_matches(unid, '-[0-9][AB][0-9]+$')
              AND unid IN (SELECT unit_name FROM {direct_shifts})""",
        "group_usage": """
            SELECT left(unid, 4) AS dgroup, carid, count(*) AS n, max(cdts2) AS last_logon
            FROM {ambulance_logons} GROUP BY 1, 2""",
        "routine": """
            SELECT carid, string_agg(dgroup, ';' ORDER BY dgroup) AS dgroups, CAST(sum(n) AS BIGINT) AS n
            FROM {group_usage} WHERE n > 1 GROUP BY carid""",
        "routine_typed": """
            SELECT r.carid, r.n, m.unit_type, o.updated
            FROM {routine} r
            LEFT JOIN {serving_fleet} f ON r.carid = f.vehicle_id
            LEFT JOIN {config_mapping} m ON lower(f.vehicle_type) = m.vehicle_type
                AND lower(f.stock_level) = m.stock_level AND lower(f.stretcher_config) = m.stretcher_config
                AND lower(f.stretcher_type) = m.stretcher_type AND lower(f.pt_comp_size) = m.pt_comp_size
                AND lower(f.seating_config) = m.seating_config AND lower(f.seating_config2) = m.seating_config2
            LEFT JOIN {legacy_vehicles} o ON r.carid = o.ehs_number""",
        "type_choice": """
            SELECT carid AS vehicle, CASE WHEN updated IS NULL THEN unit_type ELSE updated END AS vehicle_type,
                CASE WHEN updated IS NOT NULL THEN 'valid' WHEN unit_type = 'UNKNOWN' THEN 'gap'
                    WHEN unit_type IS NULL THEN 'unmapped' ELSE 'valid' END AS outcome
            FROM {routine_typed}""",
        "valid_types": """
            SELECT vehicle, vehicle_type FROM {type_choice} WHERE outcome = 'valid'
            UNION ALL SELECT vehicle, checked_type FROM {type_choice} JOIN {checked_types} USING (vehicle)
            WHERE outcome = 'gap'""",
        "suv_list": """
            SELECT vehicle_id FROM {serving_fleet} WHERE (model ILIKE '%tahoe%' OR model ILIKE '%explorer%'
                OR model ILIKE '%yukon%' OR classification ILIKE '%suv%' OR vehicle_type ILIKE '%suv%'
                OR division ILIKE '%community care%' OR stock_level ILIKE '%pru%' OR stock_level ILIKE '%admin%'
                OR stock_level ILIKE '%community%') AND length(vehicle_id) <> 4""",
        "suv_logons": """
            SELECT * FROM {unit_history} WHERE regexp_matches(unid, '-[0-9][PSDMLW][0-9]+$') AND length(carid) <> 4
                AND NOT regexp_matches(carid, '^9[0-9][0-9]$') AND unid IN (SELECT unit_name FROM {running_shifts})""",
        "suv_types": """
            SELECT vehicle_id AS vehicle, 'AA002S' AS vehicle_type FROM {suv_list}
            UNION ALL SELECT carid, 'AA002S' FROM {suv_logons} WHERE CAST(cdts2 AS DATE) > DATE '2024-01-10'
                AND carid NOT IN (SELECT vehicle_id FROM {suv_list}) GROUP BY carid HAVING count(*) > 1""",
        "road_shifts": """
            SELECT * FROM {running_shifts} WHERE NOT regexp_matches(unit_name, '[0-9][XYVUROKJIGF][0-9]+$')""",
        "road_logons": """
            SELECT * FROM {unit_history} WHERE carid IS NOT NULL
            AND NOT regexp_matches(carid, '[0-9][XYVUROKJIGF][0-9]+$')""",
        "contr_logons": """
            SELECT h.unid, h.carid, h.cdts2, s.service FROM {road_logons} h
            JOIN {road_shifts} s ON h.unid = s.unit_name WHERE s.service_type LIKE 'Contracted - %'""",
        "direct_logons": """
            SELECT h.unid, h.carid, h.cdts2, s.service FROM {road_logons} h
            JOIN {road_shifts} s ON h.unid = s.unit_name WHERE s.service_type = 'Direct Delivery'""",
        "service_pairs": """
            SELECT service, carid, count(*) AS n, CAST(max(cdts2) AS DATE) AS last_logon,
                string_agg(DISTINCT unid, ';' ORDER BY unid) AS units
            FROM {contr_logons} GROUP BY 1, 2""",
        "omitted": """
            SELECT c.carid FROM (SELECT carid, count(*) AS n FROM {contr_logons} GROUP BY 1) c
            JOIN (SELECT carid, count(*) AS n FROM {direct_logons} GROUP BY 1) d ON c.carid = d.carid AND d.n > c.n
            UNION SELECT * FROM (VALUES ('10095'), ('993'), ('114'))""",
        "losing": """
            SELECT p.carid, p.service FROM {service_pairs} p
            WHERE n <> (SELECT max(n) FROM {service_pairs} q WHERE q.carid = p.carid)""",
        "contractor_list": """
            SELECT p.service, p.carid, p.n, p.last_logon, p.units,
                (SELECT min(l.unid) FROM {contr_logons} l WHERE l.carid = p.carid AND l.service = p.service
                    AND CAST(l.cdts2 AS DATE) = p.last_logon) AS last_unit,
                CASE WHEN p.carid IN (SELECT ehs_number FROM {legacy_vehicles}) THEN 0 ELSE 1 END AS is_new
            FROM {service_pairs} p
            WHERE NOT EXISTS (SELECT 1 FROM {losing} x WHERE x.carid = p.carid AND x.service = p.service)
                AND p.carid NOT IN (SELECT carid FROM {omitted})""",
        "classed": """
            SELECT carid, unid AS top_unit, CASE WHEN l IN ('A', 'B') THEN 'AMB' WHEN l = 'T' THEN 'NAT'
                WHEN l IN ('P', 'L', 'S', 'M', 'D') THEN 'SUV' END AS unit_class
            FROM (SELECT carid, unid, substr(unid, 7, 1) AS l,
                    row_number() OVER (PARTITION BY carid ORDER BY count(*) DESC, unid) AS r
                  FROM {contr_logons} GROUP BY carid, unid) WHERE r = 1""",
    }
)


def group_usage(t):
    return usage.usage_counts(ambulance.uses(t.unit_history, t.shift_inventory, as_of=AS_OF))


def contracted(t):
    return contractor.contracted_uses(t.unit_history, t.shift_inventory, as_of=AS_OF)


def direct(t):
    return contractor.direct_uses(t.unit_history, t.shift_inventory, as_of=AS_OF)


# Joins and set operations ------------------------------------------------


@query(
    "history_shifts",
    """SELECT h.unid, h.carid, h.cdts2, s.service, s.cad_unit_type FROM {unit_history} h
       JOIN {shift_inventory} s ON h.unid = s.unit_name""",
)
def _(t):
    return joins.history_shifts(t.unit_history, t.shift_inventory).select(
        "unid", "carid", "cdts2", "service", "cad_unit_type"
    )


@query(
    "history_types",
    """SELECT h.unid, h.carid, h.cdts2, v.vehicle_type FROM {unit_history} h
       LEFT JOIN (SELECT * FROM {vehicle_types} WHERE active = 1) v ON h.carid = v.vehicle""",
)
def _(t):
    return joins.history_types(t.unit_history, tables.active_vehicle_types(t.vehicle_types)).select(
        "unid", "carid", "cdts2", "vehicle_type"
    )


@query(
    "shifts_history_outer",
    """SELECT s.unit_name AS unid, h.carid, h.cdts2, s.service FROM {unit_history} h
       RIGHT JOIN {shift_inventory} s ON h.unid = s.unit_name""",
)
def _(t):
    return joins.shifts_history_outer(t.unit_history, t.shift_inventory).select("unid", "carid", "cdts2", "service")


@query(
    "history_workload",
    """SELECT h.unid, h.carid, h.cdts, w.unit_status, w.time_active FROM {unit_history} h
       JOIN {unit_workload} w ON h.unid = w.unid AND h.cdts = w.cdts""",
)
def _(t):
    return joins.history_workload(t.unit_history, t.unit_workload).select(
        "unid", "carid", "cdts", "unit_status", "time_active"
    )


@query(
    "keyed_inner",
    """SELECT unid, carid, service, count(*) AS n, max(cdts2) AS last_logon FROM {contr_logons} GROUP BY 1, 2, 3""",
)
def _(t):
    return contracted(t)


@query(
    "routine_fleet",
    """SELECT r.carid, r.dgroups, r.n, f.classification, f.stock_level, f.vehicle_type
       FROM {routine} r LEFT JOIN {serving_fleet} f ON r.carid = f.vehicle_id""",
)
def _(t):
    routine = usage.routine_vehicles(group_usage(t))
    return joins.routine_fleet(routine, filters.in_service_fleet(t.fleet_assets)).select(
        "carid", "dgroups", "n", "classification", "stock_level", "vehicle_type"
    )


@query(
    "config_lookup",
    """SELECT f.vehicle_id, lower(f.stock_level) AS stock_level, m.unit_type FROM {serving_fleet} f
       LEFT JOIN {config_mapping} m ON lower(f.vehicle_type) = m.vehicle_type
         AND lower(f.stock_level) = m.stock_level AND lower(f.stretcher_config) = m.stretcher_config
         AND lower(f.stretcher_type) = m.stretcher_type AND lower(f.pt_comp_size) = m.pt_comp_size
         AND lower(f.seating_config) = m.seating_config AND lower(f.seating_config2) = m.seating_config2""",
)
def _(t):
    return joins.config_lookup(filters.in_service_fleet(t.fleet_assets), t.config_mapping).select(
        "vehicle_id", "stock_level", "unit_type"
    )


@query(
    "legacy_types",
    "SELECT r.carid, r.n, o.updated FROM {routine} r LEFT JOIN {legacy_vehicles} o ON r.carid = o.ehs_number",
)
def _(t):
    legacy = quality.checked(t.legacy_export, "legacy_vehicles")
    return joins.legacy_types(usage.routine_vehicles(group_usage(t)), legacy).select("carid", "n", "updated")


@query("semi_in", "SELECT unid, carid, cdts2 FROM {unit_history} WHERE unid IN (SELECT unit_name FROM {direct_shifts})")
def _(t):
    shifts = filters.direct_shifts(t.shift_inventory, as_of=AS_OF)
    return joins.semi_in(t.unit_history, "unid", shifts, "unit_name").select("unid", "carid", "cdts2")


@query(
    "anti_missing",
    """SELECT unit_name AS id, 'silent_unit' AS kind FROM {shift_inventory} s
         WHERE NOT EXISTS (SELECT 1 FROM {unit_history} h WHERE h.unid = s.unit_name)
       UNION ALL SELECT carid, 'unused_vehicle' FROM {vehicle_history} v
         WHERE NOT EXISTS (SELECT 1 FROM {unit_history} h WHERE h.carid = v.carid)
       UNION ALL SELECT vehicle_id, 'new_vehicle' FROM {fleet_assets}
         WHERE vehicle_id NOT IN (SELECT name FROM {legacy_vehicles})
       UNION ALL SELECT ehs_number, 'lost_vehicle' FROM {legacy_vehicles}
         WHERE name NOT IN (SELECT vehicle_id FROM {serving_fleet})""",
)
def _(t):
    def named(df, column, kind):
        return df.select(F.col(column).alias("id"), F.lit(kind).alias("kind"))

    legacy = quality.checked(t.legacy_export, "legacy_vehicles")
    serving = filters.in_service_fleet(t.fleet_assets)
    return joins.union_same(
        named(joins.anti_missing(t.shift_inventory, "unit_name", t.unit_history, "unid"), "unit_name", "silent_unit"),
        named(joins.anti_missing(t.vehicle_history, "carid", t.unit_history, "carid"), "carid", "unused_vehicle"),
        named(fleet.new_vehicles(t.fleet_assets, legacy), "vehicle_id", "new_vehicle"),
        named(fleet.lost_vehicles(legacy, serving), "ehs_number", "lost_vehicle"),
    )


@query(
    "anti_pairs",
    """SELECT service, carid, n FROM {service_pairs} p
       WHERE NOT EXISTS (SELECT 1 FROM {losing} x WHERE x.carid = p.carid AND x.service = p.service)""",
)
def _(t):
    pairs = usage.vehicle_summary(contracted(t), "service")
    return joins.anti_pairs(pairs, contractors.losing_services(pairs), ["carid", "service"]).select(
        "service", "carid", "n"
    )


@query(
    "suffix_join",
    """WITH c AS (SELECT carid, count(*) AS n, CAST(max(cdts2) AS DATE) AS last_logon,
              string_agg(DISTINCT unid, ';' ORDER BY unid) AS units FROM {contr_logons} GROUP BY 1),
            d AS (SELECT carid, count(*) AS n, CAST(max(cdts2) AS DATE) AS last_logon,
              string_agg(DISTINCT unid, ';' ORDER BY unid) AS units FROM {direct_logons} GROUP BY 1)
       SELECT c.carid, c.n AS n_c, c.last_logon AS last_logon_c, c.units AS units_c,
         d.n AS n_d, d.last_logon AS last_logon_d, d.units AS units_d FROM c JOIN d ON c.carid = d.carid""",
)
def _(t):
    return contractors.shared_with_direct(contracted(t), direct(t))


@query("attach_group_max",
       """SELECT service, carid, n, last_logon, max(n) OVER (PARTITION BY carid) AS max_n,
            max(last_logon) OVER (PARTITION BY carid) AS max_last FROM {service_pairs}""")
def _(t):
    pairs = usage.vehicle_summary(contracted(t), "service").drop("units")
    return contractors.attach_group_max(pairs)


@query("union_same", "SELECT vehicle, vehicle_type FROM {valid_types} UNION ALL SELECT vehicle, vehicle_type FROM {suv_types}")
def _(t):
    choice = fleet.vehicle_type_choice(described(t))
    return joins.union_same(fleet.apply_overrides(choice, t.checked_types), suv_types(t))


@query(
    "union_fill",
    """SELECT carid, dgroups, n, CAST(NULL AS STRING) AS vehicle_type FROM {routine}
       UNION ALL SELECT vehicle, NULL, NULL, vehicle_type FROM {suv_types}""",
)
def _(t):
    listed = suv_types(t).withColumnRenamed("vehicle", "carid")
    return joins.union_fill(usage.routine_vehicles(group_usage(t)), listed)


@query("unit_uses", "SELECT unid, carid, count(*) AS n, max(cdts2) AS last_logon FROM {unit_history} GROUP BY 1, 2")
def _(t):
    return usage.unit_uses(t.unit_history)


@query("distinct_rows", "SELECT DISTINCT carid, unid FROM {unit_history}")
def _(t):
    return joins.distinct_rows(t.unit_history, "carid", "unid")


# Vehicle use -------------------------------------------------------------


@query("usage_counts", "SELECT dgroup, carid, n, last_logon FROM {group_usage}")
def _(t):
    return group_usage(t).orderBy(*usage.usage_order())


@query(
    "usage_ecdf",
    """SELECT g.n, count(*) AS pairs, (SELECT count(*) FROM {group_usage} u WHERE u.n <= g.n)
         / (SELECT count(*) FROM {group_usage}) AS share FROM {group_usage} g GROUP BY g.n""",
)
def _(t):
    return usage.usage_ecdf(group_usage(t))


@query("routine_vehicles", "SELECT carid, dgroups, n FROM {routine}")
def _(t):
    return usage.routine_vehicles(group_usage(t))


@query(
    "rare_vehicles",
    """SELECT carid, string_agg(dgroup, ';' ORDER BY dgroup) AS dgroups, CAST(sum(n) AS BIGINT) AS n
       FROM {group_usage} WHERE n = 1 AND carid NOT IN (SELECT carid FROM {routine}) GROUP BY carid""",
)
def _(t):
    return usage.rare_vehicles(group_usage(t))


@query(
    "recent_usage",
    """SELECT carid, count(*) AS n FROM {suv_logons} WHERE CAST(cdts2 AS DATE) > DATE '2024-01-10'
       GROUP BY carid HAVING count(*) > 1""",
)
def _(t):
    used = fleet.suv_uses(t.unit_history, t.shift_inventory, as_of=AS_OF, since=dt.date(2024, 1, 10))
    return usage.recent_usage(used)


@query(
    "vehicle_summary",
    """SELECT carid, count(*) AS n, CAST(max(cdts2) AS DATE) AS last_logon,
         string_agg(DISTINCT unid, ';' ORDER BY unid) AS units FROM {direct_logons} GROUP BY carid""",
)
def _(t):
    return usage.vehicle_summary(direct(t))


@query(
    "infrequent_vehicles",
    """SELECT carid, count(*) AS n, CAST(max(cdts2) AS DATE) AS last_logon,
         string_agg(DISTINCT unid, ';' ORDER BY unid) AS units,
         CAST(trunc(try_cast(carid AS DOUBLE)) AS BIGINT) AS sort_id
       FROM {contr_logons} GROUP BY carid HAVING count(*) < 5 ORDER BY sort_id""",
)
def _(t):
    return usage.infrequent_vehicles(contracted(t)).orderBy("sort_id")


@query(
    "multi_group_vehicles",
    """SELECT left(unid, 4) AS dgroup, carid, count(*) AS n, CAST(max(cdts2) AS DATE) AS last_logon,
         string_agg(DISTINCT unid, ';' ORDER BY unid) AS units,
         string_agg(DISTINCT service, ';' ORDER BY service) AS services
       FROM {contr_logons} WHERE carid IN (SELECT carid FROM {contr_logons} GROUP BY 1
         HAVING count(DISTINCT left(unid, 4)) > 1) GROUP BY 1, 2""",
)
def _(t):
    return contractors.multi_group_vehicles(contracted(t))


@query(
    "multi_service_vehicles",
    """SELECT service, carid, n, last_logon, units FROM {service_pairs}
       WHERE carid IN (SELECT carid FROM {contr_logons} GROUP BY 1 HAVING count(DISTINCT service) > 1)""",
)
def _(t):
    return contractors.multi_service_vehicles(contracted(t))


@query(
    "fleet_known_vehicles",
    """SELECT carid, count(*) AS n, CAST(max(cdts2) AS DATE) AS last_logon,
         string_agg(DISTINCT unid, ';' ORDER BY unid) AS units
       FROM {contr_logons} WHERE carid IN (SELECT vehicle_id FROM {serving_fleet}) GROUP BY carid""",
)
def _(t):
    return contractors.fleet_known_vehicles(contracted(t), filters.in_service_fleet(t.fleet_assets))


@query("direct_majority", "SELECT carid FROM {omitted}")
def _(t):
    return contractors.direct_majority(contracted(t), direct(t))


@query("losing_services", "SELECT carid, service FROM {losing}")
def _(t):
    return contractors.losing_services(usage.vehicle_summary(contracted(t), "service"))


@query("contractor_vehicles", "SELECT * FROM {contractor_list}")
def _(t):
    return contractor.vehicles(t.unit_history, t.shift_inventory, t.legacy_export, as_of=AS_OF)


@query("contractor_table", "SELECT * FROM {contractor_list} ORDER BY service")
def _(t):
    listed = contractor.vehicles(t.unit_history, t.shift_inventory, t.legacy_export, as_of=AS_OF)
    return publish.ordered(listed, "service", "carid")


@query("alternate_unit",
       """SELECT unit_name, CASE WHEN l = 'A' THEN left(unit_name, 6) || 'B' || substr(unit_name, 8)
            WHEN l = 'B' THEN left(unit_name, 6) || 'A' || substr(unit_name, 8) END AS alt
          FROM (SELECT *, substr(unit_name, 7, 1) AS l FROM {road_shifts} WHERE service_type LIKE 'Contracted - %') s
          WHERE NOT EXISTS (SELECT 1 FROM {unit_history} h WHERE h.unid = s.unit_name)
            AND NOT EXISTS (SELECT 1 FROM {unit_history} h WHERE l IN ('A', 'B') AND left(h.unid, 6) = left(s.unit_name, 6)
                AND substr(h.unid, 8) = substr(s.unit_name, 8) AND substr(h.unid, 7, 1) IN ('A', 'B'))""")
def _(t):
    return contractors.alternate_unit(
        contractor.contracted_units(t.shift_inventory, as_of=AS_OF), t.unit_history
    ).select("unit_name", "alt")


@query(
    "vehicle_class",
    """SELECT carid, top_unit, unit_class, CASE WHEN unit_class IS NULL THEN 'unknown unit letter'
         WHEN unit_class = 'AMB' AND length(carid) <> 4 THEN 'unusual ambulance id'
         WHEN unit_class = 'NAT' AND length(carid) = 4 AND left(carid, 1) <> '8' THEN 'unusual transport id'
         WHEN unit_class = 'SUV' AND length(carid) = 4 AND left(carid, 1) NOT IN ('8', '1') THEN 'unusual SUV id'
         ELSE '' END AS warning FROM {classed}""",
)
def _(t):
    return contractors.vehicle_class(contracted(t))


@query("class_counts", "SELECT unit_class, count(*) AS vehicles FROM {classed} GROUP BY 1")
def _(t):
    return contractors.class_counts(contractors.vehicle_class(contracted(t)))


# Types of fleet vehicles -------------------------------------------------


def described(t):
    return ambulance.described(
        t.unit_history, t.shift_inventory, t.fleet_assets, t.config_mapping, t.legacy_export, as_of=AS_OF
    )


def suv_types(t):
    return fleet.suv_assignments(
        t.unit_history, t.shift_inventory, t.fleet_assets, as_of=AS_OF, since=dt.date(2024, 1, 10)
    )


@query("vehicle_type_choice", "SELECT vehicle, vehicle_type, outcome FROM {type_choice}")
def _(t):
    return fleet.vehicle_type_choice(described(t))


@query("apply_overrides", "SELECT vehicle, vehicle_type FROM {valid_types}")
def _(t):
    return fleet.apply_overrides(fleet.vehicle_type_choice(described(t)), t.checked_types)


@query("suv_assignments", "SELECT vehicle, vehicle_type FROM {suv_types}")
def _(t):
    return suv_types(t)


@query(
    "stage_vehicles",
    """SELECT vehicle, vehicle_type, 'true' AS active, DATE '2024-02-01' AS effective_start FROM {valid_types}
       UNION ALL SELECT vehicle, vehicle_type, 'true', DATE '2024-02-01' FROM {suv_types}""",
)
def _(t):
    cars = ambulance.run(
        t.unit_history, t.shift_inventory, t.fleet_assets, t.config_mapping, t.legacy_export, t.checked_types,
        as_of=AS_OF,
    )
    suvs = suv.run(t.unit_history, t.shift_inventory, t.fleet_assets, as_of=AS_OF, since=dt.date(2024, 1, 10))
    return joins.union_same(cars["staging"], suvs)


# Survey ------------------------------------------------------------------

AMB_FIELDS = [
    "ehs_number", "last_logon_date", "last_logon_unit", "stock_level", "stretcher_config", "stretcher_mount_position",
    "stretcher_load_type", "stretcher_type", "max_fixed_seats_incl_driver", "max_folding_seats",
    "bariatric_level_1_capable", "fits_isolette", "comments",
]
NAT_FIELDS = [
    "vehicle_number", "last_logon_date", "last_logon_unit", "max_stretchers", "max_wheelchairs",
    "max_ambulatory_patients", "mixed_use", "mixed_use_configurations", "comments",
]


def _form_sql(unit_class: str, fields: list[str], examples: str) -> str:
    blanks = ", ".join("''" for _ in fields[3:])
    return f"""
        SELECT s.service, true AS is_example, e.*, s.service AS form
        FROM (SELECT DISTINCT service FROM {{contractor_list}}) s, (VALUES {examples}) e({', '.join(fields)})
        UNION ALL
        SELECT l.service, false, l.carid, CAST(l.last_logon AS STRING), l.last_unit, {blanks}, l.service
        FROM {{contractor_list}} l JOIN {{classed}} c ON l.carid = c.carid AND c.unit_class = '{unit_class}'"""


@query(
    "survey_forms",
    _form_sql(
        "AMB", AMB_FIELDS,
        """('Example1','2019-04-15','CALG-1A1','ALS','Single','Center','Power','Stryker Power-PRO XT','5','1','Yes','Yes',''),
           ('Example2','2019-04-15','CALG-1B2','BLS','Dual','Side','Manual','Ferno 35X','3','1','No','No',''),
           ('Example3','2019-04-15','CALG-1A3','Bariatric Level 2','Single','Center','Manual','Stryker MX-PRO Bariatric','4','1','Yes','No',''),
           ('Example4','2019-04-15','CALG-1A4','NICU','Single','Center','Power','Stryker Power-PRO IT','4','1','No','Yes','')""",
    ),
)
def _(t):
    return contractor.run(t.unit_history, t.shift_inventory, t.legacy_export, as_of=AS_OF)["ambulance_form"]


@query(
    "survey_forms_transport",
    _form_sql(
        "NAT", NAT_FIELDS,
        """('Example1','2019-04-15','CALG-1T1','2','0','0','No','',''),
           ('Example2','2019-04-15','CALG-1T2','1','2','4','Yes','1 wheelchair + 3 ambulatory / 1 stretcher + 1 ambulatory / 1 stretcher + 1 wheelchair','')""",
    ),
)
def _(t):
    return contractor.run(t.unit_history, t.shift_inventory, t.legacy_export, as_of=AS_OF)["transport_form"]


@query(
    "survey_check",
    """SELECT ehs_number, concat_ws(';',
         CASE WHEN stock_level NOT IN ('', 'ALS', 'BLS', 'Bariatric Level 2', 'NICU', 'PICU', 'Other') THEN 'stock_level' END,
         CASE WHEN stretcher_config NOT IN ('', 'Single', 'Dual', 'Other') THEN 'stretcher_config' END,
         CASE WHEN stretcher_mount_position NOT IN ('', 'Centre', 'Side', 'Other') THEN 'stretcher_mount_position' END,
         CASE WHEN stretcher_load_type NOT IN ('', 'Manual', 'Power', 'Other') THEN 'stretcher_load_type' END,
         CASE WHEN stretcher_type = '' THEN 'stretcher_type' END,
         CASE WHEN NOT regexp_full_match(max_fixed_seats_incl_driver, '|[0-9]|10') THEN 'max_fixed_seats' END,
         CASE WHEN NOT regexp_full_match(max_folding_seats, '|[0-9]|10') THEN 'max_folding_seats' END,
         CASE WHEN bariatric_level_1_capable NOT IN ('', 'Yes', 'No') THEN 'bariatric_level_1_capable' END,
         CASE WHEN fits_isolette NOT IN ('', 'Yes', 'No') THEN 'fits_isolette' END) AS violations
       FROM {survey_answers}""",
)
def _(t):
    checked = forms.survey_check(t.survey_answers, forms.ambulance_rules())
    return checked.select("ehs_number", F.array_join("violations", ";").alias("violations"))


@query(
    "survey_check_transport",
    """SELECT ehs_number, concat_ws(';',
         CASE WHEN NOT regexp_full_match(max_stretchers, '|([0-9]|10)([.]0)?') THEN 'max_stretchers' END,
         CASE WHEN NOT regexp_full_match(max_wheelchairs, '|([0-9]|10)([.]0)?') THEN 'max_wheelchairs' END,
         CASE WHEN NOT regexp_full_match(max_ambulatory_patients, '|(1?[0-9]|20)([.]0)?') THEN 'max_ambulatory_patients' END,
         CASE WHEN mixed_use NOT IN ('', 'Yes', 'No') THEN 'mixed_use' END) AS violations
       FROM {transport_answers}""",
)
def _(t):
    checked = forms.survey_check(t.transport_answers, forms.transport_rules())
    return checked.select("ehs_number", F.array_join("violations", ";").alias("violations"))
