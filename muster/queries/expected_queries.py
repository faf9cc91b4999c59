"""Type changes, expected types, default vehicles and their evaluation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from muster.functions import codes, fixed
from muster.operators import assign, evaluate, expected, joins, publish, study, usage
from muster.plans import expected as expected_plan
from muster.plans import production
from muster.queries.registry import query
from muster.queries.views import SQL_VIEWS
from muster.sources import tables

CITIES = ["AMER", "EURO"]
CUTOFF = dt.datetime(2024, 1, 20)
SWEEP_DAY = dt.date(2024, 2, 19)

# The fixed values are written out here, so that a change of the library's shows.
RANK = """WHEN vehicle_type = 'AA002S' THEN 2 WHEN vehicle_type = 'AA002N' THEN 3 WHEN vehicle_type = 'AA004N' THEN 4
    WHEN vehicle_type = 'WA002N' THEN 5 WHEN vehicle_type = 'SC002N' THEN 6 WHEN vehicle_type = 'SW002N' THEN 7
    WHEN vehicle_type = 'SW004N' THEN 8 WHEN vehicle_type = 'SS001' THEN 9 WHEN vehicle_type = 'SS002' THEN 10
    WHEN vehicle_type = 'SS004' THEN 11 WHEN vehicle_type = 'SS005' THEN 12 WHEN vehicle_type = 'SS012' THEN 13
    WHEN vehicle_type = 'SC013' THEN 14 WHEN vehicle_type = 'SS014' THEN 15 WHEN vehicle_type = 'SC015' THEN 16
    WHEN vehicle_type = 'SC113' THEN 17 WHEN vehicle_type = 'SC114' THEN 18 WHEN vehicle_type = 'DS004' THEN 19
    WHEN vehicle_type = 'DS013' THEN 20 WHEN vehicle_type = 'DS014' THEN 21 WHEN vehicle_type = 'DS016' THEN 22"""
SETTINGS = """(1, CAST(0.5 AS DOUBLE)), (7, CAST(0.25 AS DOUBLE)), (7, CAST(0.5 AS DOUBLE)), (7, CAST(0.75 AS DOUBLE)),
    (14, CAST(0.25 AS DOUBLE)), (14, CAST(0.5 AS DOUBLE)), (14, CAST(0.75 AS DOUBLE)),
    (28, CAST(0.25 AS DOUBLE)), (28, CAST(0.5 AS DOUBLE)), (28, CAST(0.75 AS DOUBLE))"""
NUMBER = "CAST(trunc(try_cast(carid AS DOUBLE)) AS BIGINT)"


def default_sql(kind: str) -> str:
    """First true test wins: ids, then dispatch kinds."""
    return f"""CASE
        WHEN ({NUMBER} BETWEEN 5000 AND 8999) OR ({NUMBER} BETWEEN 20000 AND 39999) THEN 'UT_AA002N'
        WHEN {NUMBER} BETWEEN 1000 AND 4999 THEN 'UT_SC002'
        WHEN ({NUMBER} BETWEEN 40000 AND 49999) OR ({NUMBER} BETWEEN 10000 AND 19998) THEN 'UT_AA002S'
        WHEN ({NUMBER} BETWEEN 900 AND 999) OR ({NUMBER} BETWEEN 9000 AND 9999) THEN 'UT_GhostVehicle'
        WHEN {kind} IN ('BNAT', 'ENAT') THEN 'UT_AA002N'
        WHEN {kind} IN ('ALS', 'BLS', 'BLSr', 'ALSr', 'WING') THEN 'UT_SC002'
        WHEN {kind} IN ('DELTA', 'COMP', 'SUPER', 'ECHO', 'MIKE', 'PRU', 'FRU', 'BPRU', 'ITTEST', 'EMR') THEN 'UT_AA002S'
        WHEN {kind} IN ('DISP', 'SEGWAY', 'ATV', 'FOOT', 'BIKE', 'CART', 'TRAIN', 'BUS', 'MASS', 'HOSP')
            THEN 'UT_GhostVehicle'
        WHEN {kind} = 'FLIGHT' THEN 'UT_SS002A.450' WHEN {kind} = 'HELI' THEN 'UT_SS002H.250'
        WHEN {kind} IN ('OTHER', 'Other') THEN 'UT_GhostVehicle' ELSE 'Undefined' END"""


GROUPED = """CASE WHEN regexp_matches(unid, '^[A-Z]{4}-[0-9][AB][0-9]+$')
    THEN left(unid, 6) || '_' || substr(unid, 8) ELSE unid END"""

# Struct-free ordering of parsed types for ORDER BY.
STRETCHER = """WHEN 'SS00' THEN 1 WHEN 'SC00' THEN 2 WHEN 'DS00' THEN 3 WHEN 'SW00' THEN 3.5
    WHEN 'SS01' THEN 4 WHEN 'SC01' THEN 5 WHEN 'DS01' THEN 6 WHEN 'SW01' THEN 6.5
    WHEN 'SS10' THEN 7 WHEN 'SC10' THEN 8 WHEN 'DS10' THEN 9 WHEN 'SW10' THEN 9.5
    WHEN 'SS11' THEN 10 WHEN 'SC11' THEN 11 WHEN 'DS11' THEN 12 WHEN 'SW11' THEN 12.5"""
PARSED = f"""
    CASE substr(code, 6, 1) WHEN 'S' THEN 1 WHEN 'N' THEN 2 WHEN '' THEN 3 WHEN 'H' THEN 4 WHEN 'A' THEN 5 ELSE 0 END
        AS class_score,
    CAST(CASE left(code, 4) {STRETCHER} ELSE 0 END AS DOUBLE) AS stretcher,
    CASE WHEN left(code, 2) IN ('SW', 'WA') THEN try_cast(substr(code, 7) AS DOUBLE) ELSE 0 END AS wheelchairs,
    try_cast(substr(code, 5, 1) AS DOUBLE) AS capacity,
    CASE WHEN substr(code, 6, 1) IN ('H', 'A') THEN try_cast(substr(code, 7) AS DOUBLE) ELSE 0 END AS air_speed"""
CODE = "regexp_replace(regexp_replace(vehicle_type_external_key, '^UT_Air_', ''), '^UT_', '')"


def decision_sql(source: str, keys: str, threshold: float) -> str:
    """Majority, else lowest ranked repeated type, over counts (keys, vehicle_type, n)."""
    return f"""
        SELECT {keys}, CASE WHEN top_n / total > CAST({threshold} AS DOUBLE) THEN top_type ELSE low_type END AS expected_type,
            CASE WHEN top_n / total > CAST({threshold} AS DOUBLE) THEN 'majority' WHEN low_rank IS NOT NULL THEN 'lowest'
                WHEN top_n > 1 THEN 'unranked' ELSE 'none' END AS reason, total AS logons
        FROM (SELECT {keys}, CAST(sum(n) AS BIGINT) AS total, max(n) AS top_n,
                first(vehicle_type ORDER BY n DESC, vehicle_type ASC NULLS FIRST) AS top_type,
                min(rank) FILTER (WHERE n > 1) AS low_rank,
                first(vehicle_type ORDER BY rank) FILTER (WHERE n > 1 AND rank IS NOT NULL) AS low_type
              FROM (SELECT *, CASE WHEN vehicle_type IS NULL THEN 1 {RANK} END AS rank FROM {source})
              GROUP BY {keys})"""


SQL_VIEWS.update(
    {
        "ground_history": """
            SELECT h.unid, h.carid, h.cdts2, v.vehicle_type,
                regexp_replace(h.unid, '-([0-9])[AB]([0-9]+)$', '-\\1_\\2') AS generic
            FROM {unit_history} h JOIN {shift_inventory} s ON h.unid = s.unit_name
            LEFT JOIN (SELECT * FROM {vehicle_types} WHERE active = 1) v ON h.carid = v.vehicle
            WHERE s.active_inactive = 'Active'
                AND s.cad_unit_type IN ('ALS', 'BLS', 'PRU', 'ENAT', 'BNAT', 'EMR', 'WING', 'ALSr')""",
        "recent_30": """
            SELECT h.* FROM {ground_history} h JOIN (
                SELECT generic, min(cdts2) AS cutoff FROM (
                    SELECT generic, cdts2, row_number() OVER (PARTITION BY generic ORDER BY cdts2 DESC) AS r
                    FROM {ground_history}) WHERE r <= 30 GROUP BY generic) c
            ON h.generic = c.generic AND h.cdts2 >= c.cutoff""",
        "recent_counts": "SELECT generic, vehicle_type, count(*) AS n FROM {recent_30} GROUP BY 1, 2",
        "unit_types": decision_sql("{recent_counts}", "generic", 0.6),
        # One-by-one walk over the units in turn; the list holds the vehicles taken.
        "walk": """
            SELECT generic, default_vehicle FROM (
              WITH RECURSIVE likes AS (
                SELECT r.generic, list(r.carid ORDER BY r.n DESC, r.carid) AS wanted FROM (
                  SELECT generic, carid, vehicle_type, count(*) AS n FROM {recent_30}
                  WHERE carid IS NOT NULL GROUP BY 1, 2, 3) r
                JOIN {unit_types} u ON r.generic = u.generic AND r.vehicle_type = u.expected_type GROUP BY r.generic),
              turns AS (
                SELECT l.generic, l.wanted, row_number() OVER (ORDER BY f.first_id, l.generic) AS turn
                FROM likes l JOIN (SELECT generic, min(carid) AS first_id FROM {ground_history} GROUP BY 1) f
                  ON l.generic = f.generic),
              steps AS (
                SELECT CAST(0 AS BIGINT) AS turn, CAST('' AS STRING) AS generic, CAST(NULL AS STRING) AS default_vehicle,
                  CAST([] AS STRING[]) AS taken
                UNION ALL
                SELECT t.turn, t.generic, [x for x in t.wanted if NOT list_contains(s.taken, x)][1],
                  list_concat(s.taken, [x for x in t.wanted if NOT list_contains(s.taken, x)][1:1])
                FROM steps s JOIN turns t ON t.turn = s.turn + 1)
              SELECT generic, default_vehicle FROM steps WHERE turn > 0)
            WHERE default_vehicle IS NOT NULL""",
        "assigned": """
            SELECT u.generic, u.expected_type,
              CASE WHEN u.expected_type IS NULL THEN NULL ELSE coalesce(w.default_vehicle, q.vehicle, m.most_used) END
                AS default_vehicle,
              CASE WHEN u.expected_type IS NULL THEN 'none' WHEN w.default_vehicle IS NOT NULL THEN 'own'
                WHEN q.vehicle IS NOT NULL THEN 'free' ELSE 'duplicate' END AS source
            FROM {unit_types} u LEFT JOIN {walk} w ON u.generic = w.generic
            LEFT JOIN (
              SELECT a.generic, b.vehicle FROM (
                SELECT t.generic, t.expected_type,
                  row_number() OVER (PARTITION BY t.expected_type ORDER BY f.first_id, t.generic) AS place
                FROM {unit_types} t JOIN (SELECT generic, min(carid) AS first_id FROM {ground_history} GROUP BY 1) f
                  ON t.generic = f.generic
                WHERE t.expected_type IS NOT NULL AND t.generic NOT IN (SELECT generic FROM {walk})) a
              JOIN (
                SELECT vehicle, vehicle_type, row_number() OVER (PARTITION BY vehicle_type ORDER BY vehicle) AS place
                FROM {vehicle_types} WHERE active = 1 AND vehicle NOT IN (SELECT default_vehicle FROM {walk})) b
              ON a.expected_type = b.vehicle_type AND a.place = b.place) q ON u.generic = q.generic
            LEFT JOIN (
              SELECT generic, first(carid ORDER BY n DESC, carid) AS most_used FROM (
                SELECT generic, carid, count(*) AS n FROM {ground_history} WHERE carid IS NOT NULL GROUP BY 1, 2)
              GROUP BY generic) m ON u.generic = m.generic""",
        "study": """
            SELECT CAST(h.cdts2 AS DATE) AS date, h.unid, h.carid, v.vehicle_type, s.district,
                regexp_replace(h.unid, '-([0-9])[AB]([0-9]+)$', '-\\1_\\2') AS generic,
                substr(h.unid, 7, 1) AS letter, left(h.unid, 4) AS dgroup,
                CASE WHEN substr(h.unid, 7, 1) IN ('A', 'B') THEN 'A/B' ELSE substr(h.unid, 7, 1) END AS kind
            FROM {long_history} h JOIN {shift_inventory} s ON h.unid = s.unit_name
            JOIN {vehicle_types} v ON h.carid = v.vehicle AND v.active = 1
            WHERE s.active_inactive = 'Active'
                AND s.cad_unit_type IN ('ALS', 'BLS', 'ENAT', 'BNAT', 'EMR', 'WING', 'ALSr')
                AND ((agency IN ('AHSETX', 'AHSCTX', 'AHSNTX', 'AHSATX') AND s.type <> 'Air Crew')
                  OR (agency IN ('AHSSCC', 'AHSCCC', 'AHSNCC') AND left(unit_name, 4) NOT IN ('AMER', 'EURO')))""",
        "ordered_study": """
            SELECT generic, vehicle_type AS curr, lag(vehicle_type) OVER w AS prev, row_number() OVER w AS place
            FROM {study} WINDOW w AS (PARTITION BY generic ORDER BY date, carid, vehicle_type)""",
        "transitions": """
            SELECT curr, prev, count(*) AS n FROM {ordered_study} WHERE prev IS NOT NULL GROUP BY 1, 2""",
        "runs": """
            SELECT generic, curr AS vehicle_type, count(*) AS length FROM (
                SELECT *, place - row_number() OVER (PARTITION BY generic, curr ORDER BY place) AS island
                FROM {ordered_study} WHERE prev IS NOT NULL) GROUP BY generic, curr, island""",
        "dominant": """
            SELECT dgroup, kind, vehicle_type AS dominant, n FROM (
                SELECT dgroup, kind, vehicle_type, count(*) AS n,
                    row_number() OVER (PARTITION BY dgroup, kind ORDER BY count(*) DESC, vehicle_type) AS r
                FROM {study} GROUP BY 1, 2, 3) WHERE r = 1""",
        "production_rows": f"""
            SELECT s.unit_name AS unid, h.carid, h.cdts2, s.cad_unit_type, r.vehicle_type_external_key,
                {default_sql('s.cad_unit_type').replace('carid', 'h.carid')} AS default_type,
                {GROUPED.replace('unid', 's.unit_name')} AS grouped_unit
            FROM (SELECT * FROM {{shift_inventory}} WHERE active_inactive = 'Active') s
            LEFT JOIN {{worked_history}} h ON h.unid = s.unit_name
            LEFT JOIN (SELECT * FROM {{vehicle_register}} WHERE deleted_status = 0) r ON h.carid = r.name""",
        "train_rows": f"""
            SELECT unid, carid, cdts2, vehicle_type_external_key, default_type, grouped_unit, 0 AS appended
            FROM {{production_rows}} WHERE cdts2 <= TIMESTAMP '2024-01-20'
            UNION ALL
            SELECT s.unit_name, NULL, NULL, NULL, {default_sql('s.cad_unit_type').replace('carid', "CAST(NULL AS STRING)")},
                {GROUPED.replace('unid', 's.unit_name')}, 1
            FROM {{shift_inventory}} s WHERE active_inactive = 'Active' AND unit_name NOT IN (
                SELECT unid FROM {{production_rows}} WHERE cdts2 <= TIMESTAMP '2024-01-20')""",
    }
)


def production_sql(source: str, settings: str) -> str:
    """Expected type per grouped unit and setting, straight from the rule."""
    return f"""
        SELECT g.grouped_unit, g.k, g.threshold,
            CASE WHEN c.top_n / c.total > g.threshold THEN c.top_type ELSE coalesce(c.low_type, g.default_type) END
                AS expected_type,
            CASE WHEN c.top_n / c.total > g.threshold THEN 'majority' WHEN c.low_type IS NOT NULL THEN 'lowest'
                ELSE 'default' END AS reason
        FROM (SELECT grouped_unit, k, threshold, first(default_type ORDER BY appended, carid IS NOT NULL, carid, unid)
                AS default_type
              FROM {source}, (VALUES {settings}) s(k, threshold) GROUP BY 1, 2, 3) g
        LEFT JOIN (
            SELECT grouped_unit, k, sum(n) AS total, max(n) AS top_n,
                first(vehicle_type_external_key ORDER BY n DESC, vehicle_type_external_key) AS top_type,
                first(vehicle_type_external_key ORDER BY class_score, stretcher, wheelchairs NULLS FIRST,
                    capacity NULLS FIRST, air_speed NULLS FIRST, code) FILTER (WHERE n > 1) AS low_type
            FROM (SELECT *, {PARSED} FROM (
                SELECT grouped_unit, k, vehicle_type_external_key, {CODE} AS code, count(*) AS n
                FROM (SELECT *, rank() OVER (PARTITION BY grouped_unit ORDER BY cdts2 DESC) AS recency
                      FROM {source} WHERE cdts2 IS NOT NULL) r,
                     (SELECT DISTINCT k FROM (VALUES {settings}) s(k, threshold)) ks
                WHERE recency <= k AND vehicle_type_external_key IS NOT NULL
                GROUP BY 1, 2, 3, 4))
            GROUP BY 1, 2) c ON g.grouped_unit = c.grouped_unit AND g.k = c.k"""


ONE_SETTING = "(7, CAST(0.5 AS DOUBLE))"
SQL_VIEWS.update(
    {
        "keyed_units": f"""
            SELECT DISTINCT 'LUT_' || r.unid AS external_key, t.expected_type AS expected_vehicle_type_key,
                r.grouped_unit, r.unid
            FROM {{production_rows}} r JOIN (
                {production_sql("(SELECT *, 0 AS appended FROM {production_rows})", ONE_SETTING)}) t
            ON r.grouped_unit = t.grouped_unit""",
        "swept": f"""
            SELECT x.unid, x.day, x.vehicle_type_external_key, x.k, x.threshold, p.expected_type, x.n
            FROM (SELECT unid, CAST(cdts2 AS DATE) AS day, vehicle_type_external_key, k, threshold, count(*) AS n
                  FROM {{production_rows}}, (VALUES {SETTINGS}) s(k, threshold)
                  WHERE cdts2 > TIMESTAMP '2024-01-20' GROUP BY ALL) x
            LEFT JOIN (
              SELECT DISTINCT r.unid, t.k, t.threshold, t.expected_type FROM {{train_rows}} r JOIN (
                {production_sql("{train_rows}", SETTINGS)}) t
              ON r.grouped_unit = t.grouped_unit WHERE t.expected_type <> 'Undefined') p
            ON x.unid = p.unid AND x.k = p.k AND x.threshold = p.threshold""",
    }
)


def active_types(t):
    return tables.active_vehicle_types(t.vehicle_types)


def recent_ground(t):
    return expected_plan.recent_ground(t.unit_history, t.shift_inventory, active_types(t))


def study_cells(t):
    return expected_plan.study(t.long_history, t.shift_inventory, active_types(t), cities=CITIES)


def production_rows(t):
    return production.rows(t.unit_history, t.unit_workload, t.shift_inventory, t.vehicle_register)


# Type changes ------------------------------------------------------------


@query(
    "study_cells",
    """SELECT date, unid, generic, carid, vehicle_type, district, letter, dgroup, count(*) AS n
       FROM {study} GROUP BY ALL""",
)
def _(t):
    return study_cells(t)


@query("type_frequency", "SELECT vehicle_type, count(*) AS n FROM {study} GROUP BY 1")
def _(t):
    return study.type_frequency(study_cells(t))


@query("types_per_unit", "SELECT generic, count(DISTINCT vehicle_type) AS types FROM {study} GROUP BY 1")
def _(t):
    return study.types_per_unit(study_cells(t))


@query("types_per_unit_later", "SELECT generic, count(DISTINCT curr) AS types FROM {ordered_study} WHERE prev IS NOT NULL GROUP BY 1")
def _(t):
    return study.types_per_unit_later(study.type_runs(study_cells(t), rows=t.long_history.count()))


@query(
    "types_per_unit_histogram",
    """SELECT types, count(*) AS units FROM (SELECT generic, count(DISTINCT vehicle_type) AS types FROM {study}
       GROUP BY 1) GROUP BY 1""",
)
def _(t):
    return study.types_per_unit_histogram(study_cells(t))


@query("types_per_group", "SELECT dgroup, kind, count(DISTINCT vehicle_type) AS types FROM {study} GROUP BY 1, 2")
def _(t):
    return study.types_per_group(study_cells(t))


@query(
    "types_per_group_histogram",
    """SELECT types, count(*) AS groups FROM (SELECT dgroup, kind, count(DISTINCT vehicle_type) AS types FROM {study}
       GROUP BY 1, 2) GROUP BY 1""",
)
def _(t):
    return study.types_per_group_histogram(study_cells(t))


@query("dominant_type", "SELECT dgroup, kind, dominant, n FROM {dominant}")
def _(t):
    return study.dominant_type(study_cells(t))


@query(
    "type_transitions",
    "SELECT curr, prev, n FROM {transitions}",
)
def _(t):
    return study.type_transitions(study_cells(t), rows=t.long_history.count())


MATRIX_TYPES = ["AA002N", "AA002S", "DS013", "GhostVehicle", "SC013", "SC113", "SC114", "SS002A.450", "SS002H.250", "WA002N"]


@query(
    "transition_matrix",
    "SELECT curr, "
    + ", ".join(
        f"coalesce(round_even(max(n) FILTER (WHERE prev = '{name}') / sum(n), 3), 0) * 100 AS \"{name.replace('.', '_')}\""
        for name in MATRIX_TYPES
    )
    + " FROM {transitions} GROUP BY curr",
)
def _(t):
    matrix = study.transition_matrix(study.type_transitions(study_cells(t), rows=t.long_history.count()), MATRIX_TYPES)
    return matrix.toDF(*[name.replace(".", "_") for name in matrix.columns])


@query(
    "transition_share",
    """SELECT curr, prev, n, CAST(sum(n) OVER (PARTITION BY curr) AS BIGINT) AS total,
         n / sum(n) OVER (PARTITION BY curr) AS share FROM {transitions}""",
)
def _(t):
    return study.transition_share(study.type_transitions(study_cells(t), rows=t.long_history.count()))


@query(
    "change_rate",
    """SELECT count(*) FILTER (WHERE curr <> prev) AS changes, count(*) AS steps,
         count(*) FILTER (WHERE curr <> prev) / count(*) * 100 AS percent
       FROM {ordered_study} WHERE prev IS NOT NULL""",
)
def _(t):
    return study.change_rate(study.type_transitions(study_cells(t), rows=t.long_history.count()))


@query("type_runs", "SELECT generic, vehicle_type, length FROM {runs}")
def _(t):
    return study.type_runs(study_cells(t), rows=t.long_history.count())


@query("long_runs", "SELECT generic, vehicle_type, length FROM {runs} WHERE length > 5")
def _(t):
    return study.long_runs(study.type_runs(study_cells(t), rows=t.long_history.count()))


@query("run_histogram", "SELECT CAST(length // 5 * 5 AS BIGINT) AS from_length, count(*) AS runs FROM {runs} GROUP BY 1")
def _(t):
    return study.run_histogram(study.type_runs(study_cells(t), rows=t.long_history.count()))


@query(
    "default_by_kind",
    """SELECT unid, date, carid, vehicle_type, CASE letter WHEN 'T' THEN 'AA002N' ELSE 'SC113' END AS assumed_type,
         count(*) AS n FROM {study} WHERE letter IN ('A', 'B', 'T', 'W', 'C') GROUP BY ALL""",
)
def _(t):
    return joins.default_by_kind(study_cells(t)).select(
        "unid", "date", "carid", "vehicle_type", "assumed_type", "n"
    )


@query(
    "group_default",
    """SELECT s.unid, s.date, s.carid, s.vehicle_type, d.dominant, count(*) AS n FROM {study} s
       JOIN {dominant} d ON s.dgroup = d.dgroup AND s.kind = d.kind GROUP BY ALL""",
)
def _(t):
    cells = study_cells(t)
    return joins.group_default(study.with_kind(cells), study.dominant_type(cells).drop("n")).select(
        "unid", "date", "carid", "vehicle_type", "dominant", "n"
    )


@query(
    "rule_accuracy",
    """WITH l AS (SELECT count(*) FILTER (WHERE vehicle_type = CASE letter WHEN 'T' THEN 'AA002N' ELSE 'SC113' END) AS m,
           count(*) AS s FROM {study} WHERE letter IN ('A', 'B', 'T', 'W', 'C')),
       g AS (SELECT count(*) FILTER (WHERE s.vehicle_type = d.dominant) AS m, count(*) AS s
           FROM {study} s JOIN {dominant} d ON s.dgroup = d.dgroup AND s.kind = d.kind)
       SELECT 'letter' AS rule, m AS matches, s AS shifts, m / s AS share, m / s AS reference_share FROM l
       UNION ALL SELECT 'group', g.m, g.s, g.m / g.s, g.m / (SELECT s FROM l) FROM g""",
)
def _(t):
    return study.rule_accuracy(study_cells(t))


# Expected types ----------------------------------------------------------


@query("last_k_logons", "SELECT generic, unid, carid, cdts2, vehicle_type FROM {recent_30}")
def _(t):
    return recent_ground(t).select("generic", "unid", "carid", "cdts2", "vehicle_type")


@query(
    "newest_n_rows",
    """SELECT unid, carid, cdts2, row_no FROM (SELECT *, row_number() OVER (PARTITION BY unid ORDER BY cdts2 DESC, carid)
         AS row_no FROM {unit_history}) WHERE row_no <= 90""",
)
def _(t):
    return expected.newest_n_rows(t.unit_history, 90).select(
        "unid", "carid", "cdts2", F.col("row_no").cast("bigint").alias("row_no")
    )


@query(
    "most_used_vehicle",
    """SELECT generic, first(carid ORDER BY n DESC, carid) AS most_used, max(n) AS n FROM (
         SELECT generic, carid, count(*) AS n FROM {ground_history} WHERE carid IS NOT NULL GROUP BY 1, 2) GROUP BY 1""",
)
def _(t):
    return usage.most_used_vehicle(expected_plan.ground_uses(t.unit_history, t.shift_inventory))


@query("expected_type", "SELECT generic, expected_type, reason, logons FROM {unit_types}")
def _(t):
    return expected.expected_type(recent_ground(t))


@query(
    "expected_type_by_day",
    decision_sql(
        """(SELECT s.generic, s.vehicle_type, count(*) AS n FROM {study} s JOIN (
              SELECT generic, min(date) AS cutoff FROM (
                SELECT generic, date, row_number() OVER (PARTITION BY generic ORDER BY date DESC) AS r FROM {study})
              WHERE r <= 30 GROUP BY 1) c ON s.generic = c.generic AND s.date >= c.cutoff GROUP BY 1, 2)""",
        "generic", 0.5,
    ),
)
def _(t):
    return expected.expected_type_by_day(study_cells(t))


@query(
    "type_rank_table",
    "SELECT vehicle_type, CASE " + RANK + " END AS place, count(*) AS vehicles FROM {vehicle_types} GROUP BY 1, 2",
)
def _(t):
    ranks = expected.type_rank_table(t.spark)
    counts = t.vehicle_types.groupBy("vehicle_type").agg(F.count("*").alias("vehicles"))
    return counts.join(ranks, "vehicle_type", "left").select("vehicle_type", "place", "vehicles")


@query(
    "type_rank_parsed",
    f"""SELECT *, (left(code, 2) IN ('SW', 'WA') OR substr(code, 6, 1) IN ('H', 'A')) AND substr(code, 7) = '' AS gap
        FROM (SELECT name, code, CAST(class_score AS DOUBLE) AS class_score, stretcher,
            CAST(wheelchairs AS DOUBLE) AS wheelchairs, capacity, CAST(air_speed AS DOUBLE) AS air_speed
          FROM (SELECT *, {PARSED} FROM (SELECT name, {CODE} AS code FROM {{vehicle_register}})))""",
)
def _(t):
    key = F.col("vehicle_type_external_key")
    ranked = t.vehicle_register.select("name", codes.type_rank_key(key).alias("r"), codes.type_code_gap(key).alias("gap"))
    return ranked.select("name", "r.*", "gap")


@query(
    "default_type",
    f"SELECT carid, cad_unit_type, {default_sql('cad_unit_type')} AS default_type, count(*) AS n FROM ("
    "SELECT h.carid, s.cad_unit_type FROM {shift_inventory} s LEFT JOIN {unit_history} h ON h.unid = s.unit_name)"
    " GROUP BY 1, 2",
)
def _(t):
    # Logons are counted before they meet the shifts; a unit without one is one row.
    uses = joins.shifts_history_outer(usage.unit_uses(t.unit_history), t.shift_inventory)
    pairs = uses.groupBy("carid", "cad_unit_type").agg(F.sum(F.coalesce("n", F.lit(1))).alias("n"))
    return pairs.withColumn(
        "default_type", codes.default_type(F.col("carid"), F.col("cad_unit_type"))
    )


@query(
    "generic_unit",
    """SELECT regexp_replace(unit_name, '-([0-9])[AB]([0-9]+)$', '-\\1_\\2') AS generic, count(*) AS units
       FROM {shift_inventory} GROUP BY 1""",
)
def _(t):
    generic = codes.generic_unit(F.col("unit_name")).alias("generic")
    return t.shift_inventory.groupBy(generic).agg(F.count("*").alias("units"))


@query("default_vehicle", "SELECT generic, default_vehicle FROM {walk}")
def _(t):
    return expected_plan.first_pass(t.unit_history, t.shift_inventory, active_types(t))["taken"]


@query("default_vehicle_fill", "SELECT generic, expected_type, default_vehicle, source FROM {assigned}")
def _(t):
    return expected_plan.ground_assignments(
        t.unit_history, t.shift_inventory, active_types(t)
    )


@query(
    "default_vehicle_shared",
    """WITH RECURSIVE waiting AS (
         SELECT t.generic, t.expected_type, row_number() OVER (ORDER BY f.first_id NULLS FIRST, t.generic) AS turn
         FROM {unit_types} t JOIN (SELECT generic, min(carid) AS first_id FROM {ground_history} GROUP BY 1) f
           ON t.generic = f.generic
         WHERE t.expected_type IS NOT NULL AND t.generic NOT IN (SELECT generic FROM {walk})),
       stock AS (
         SELECT vehicle_type, list(vehicle ORDER BY vehicle) AS vehicles FROM {shared_types}
         WHERE vehicle NOT IN (SELECT default_vehicle FROM {walk}) GROUP BY 1),
       steps AS (
         SELECT CAST(0 AS BIGINT) AS turn, CAST('' AS STRING) AS generic, CAST(NULL AS STRING) AS default_vehicle,
           CAST([] AS STRING[]) AS taken
         UNION ALL
         SELECT w.turn, w.generic, [x for x in k.vehicles if NOT list_contains(p.taken, x)][1],
           list_concat(p.taken, coalesce([x for x in k.vehicles if NOT list_contains(p.taken, x)][1:1], []))
         FROM steps p JOIN waiting w ON w.turn = p.turn + 1 LEFT JOIN stock k ON k.vehicle_type = w.expected_type)
       SELECT generic, default_vehicle FROM steps WHERE default_vehicle IS NOT NULL""",
)
def _(t):
    done = expected_plan.first_pass(t.unit_history, t.shift_inventory, active_types(t))
    filled = assign.default_vehicle_fill(done["types"], done["taken"], done["order"], done["uses"], t.shared_types)
    return filled.where("source = 'free'").select("generic", "default_vehicle")


@query(
    "expected_table",
    """SELECT generic, expected_type AS expected_unit_type, default_vehicle,
         'UT_' || expected_type AS expected_unit_type_key,
         CASE WHEN left(default_vehicle, 2) = 'C-' THEN 'UT_Air_' ELSE 'UT_' END || default_vehicle AS default_vehicle_key
       FROM (SELECT generic, expected_type, default_vehicle FROM {assigned}
             UNION ALL SELECT generic, expected_unit_type, default_vehicle FROM {aircraft_expected})
       WHERE expected_type IS NOT NULL""",
)
def _(t):
    return expected_plan.run(
        t.unit_history, t.shift_inventory, active_types(t), t.aircraft_expected
    )


# Production form ---------------------------------------------------------


@query(
    "production_types",
    production_sql("(SELECT *, 0 AS appended FROM {production_rows})", ONE_SETTING),
)
def _(t):
    return expected.production_types(production_rows(t))


@query(
    "assignment_keys",
    "SELECT * FROM {keyed_units} WHERE expected_vehicle_type_key <> 'Undefined'",
)
def _(t):
    return production.assignments(production_rows(t))


@query(
    "undefined_types",
    "SELECT external_key, grouped_unit FROM {keyed_units} WHERE expected_vehicle_type_key = 'Undefined'",
)
def _(t):
    rows = production_rows(t)
    return publish.undefined_types(rows, expected.production_types(rows))


CHANGES = """
    SELECT CASE WHEN o.lut_key IS NULL THEN 'insert' ELSE 'update' END AS action, k.grouped_unit, k.external_key,
      k.expected_vehicle_type_key, o.expected_vehicle_type_key AS old_type
    FROM (SELECT * FROM {keyed_units} WHERE expected_vehicle_type_key <> 'Undefined') k
    LEFT JOIN {stored_expected} o ON k.external_key = o.lut_key
    WHERE o.lut_key IS NULL OR o.expected_vehicle_type_key IS NULL
      OR o.expected_vehicle_type_key <> k.expected_vehicle_type_key"""


@query("expected_changes", CHANGES)
def _(t):
    return production.update(production_rows(t), t.stored_expected)


@query(
    "stored_after",
    f"""SELECT grouped_unit_name, lut_key, coalesce(
            (SELECT c.expected_vehicle_type_key FROM ({CHANGES}) c WHERE c.external_key = s.lut_key),
            expected_vehicle_type_key) AS expected_vehicle_type_key FROM {{stored_expected}} s
        UNION ALL SELECT grouped_unit, external_key, expected_vehicle_type_key FROM ({CHANGES}) WHERE action = 'insert'""",
)
def _(t):
    return publish.stored_after(t.stored_expected, production.update(production_rows(t), t.stored_expected))


# Evaluation --------------------------------------------------------------


def sweep(t):
    return production.test(production_rows(t), t.shift_inventory, as_of=SWEEP_DAY)


def scored(t, settings=fixed.SWEEP_SETTINGS):
    return evaluate.holdout_rows(
        production_rows(t), tables.shifts(t.shift_inventory), cutoff=CUTOFF, settings=settings
    )


COUNTS = """CAST(sum(n) AS BIGINT) AS logons,
    CAST(coalesce(sum(n) FILTER (WHERE vehicle_type_external_key = expected_type), 0) AS BIGINT) AS matches,
    CAST(coalesce(sum(n) FILTER (WHERE vehicle_type_external_key <> expected_type), 0) AS BIGINT) AS mismatches,
    CAST(coalesce(sum(n) FILTER (WHERE vehicle_type_external_key IS NULL), 0) AS BIGINT) AS unknown_vehicle,
    CAST(coalesce(sum(n) FILTER (WHERE expected_type IS NULL), 0) AS BIGINT) AS undefined_type"""
PERCENTS = ", ".join(
    f"round_even({part} / logons * 100, 2) AS {part}_percent"
    for part in ["matches", "mismatches", "unknown_vehicle", "undefined_type"]
)


@query(
    "score_join",
    """SELECT unid, day, vehicle_type_external_key, expected_type, n FROM {swept}
       WHERE k = 7 AND threshold = CAST(0.5 AS DOUBLE)""",
)
def _(t):
    return scored(t, [(7, 0.5)]).select("unid", "day", "vehicle_type_external_key", "expected_type", "n")


@query("holdout_eval", f"SELECT k, threshold, {COUNTS} FROM {{swept}} WHERE k = 7 AND threshold = CAST(0.5 AS DOUBLE) GROUP BY 1, 2")
def _(t):
    return evaluate.match_counts(scored(t, [(7, 0.5)]), "k", "threshold")


@query("match_metrics", f"SELECT *, {PERCENTS} FROM (SELECT day, {COUNTS} FROM {{swept}} GROUP BY 1)")
def _(t):
    return evaluate.match_metrics(scored(t), "day")


@query("param_sweep", f"SELECT *, {PERCENTS} FROM (SELECT k, threshold, {COUNTS} FROM {{swept}} GROUP BY 1, 2)")
def _(t):
    return sweep(t)["total"]


@query(
    "daily_metrics",
    f"""WITH m AS (SELECT k, threshold, day, {COUNTS} FROM {{swept}} GROUP BY 1, 2, 3),
        s AS (SELECT k, threshold, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day
              FROM m GROUP BY 1, 2)
        SELECT s.k, s.threshold, s.day, coalesce(logons, 0) AS logons, coalesce(matches, 0) AS matches,
          coalesce(mismatches, 0) AS mismatches, round_even(matches / logons * 100, 2) AS matches_percent,
          round_even(mismatches / logons * 100, 2) AS mismatches_percent
        FROM s LEFT JOIN m ON s.k = m.k AND s.threshold = m.threshold AND s.day = m.day""",
)
def _(t):
    return sweep(t)["daily"]


@query(
    "backtest_monthly",
    """WITH bounds AS (SELECT min(date) AS a, max(date) AS b FROM {study}),
       steps AS (SELECT i AS step, CAST(a + CAST(i * 28 AS INTEGER) AS DATE) AS s
                 FROM bounds, unnest(generate_series(1, (b - a) // 28)) g(i)),
       ranked AS (SELECT p.step, t.generic, t.vehicle_type,
                    rank() OVER (PARTITION BY p.step, t.generic ORDER BY t.date DESC) AS r
                  FROM steps p JOIN {study} t ON t.date <= p.s),
       counts AS (SELECT step, generic, vehicle_type, count(*) AS n FROM ranked WHERE r <= 30 GROUP BY 1, 2, 3),
       learnt AS (""" + decision_sql("counts", "step, generic", 0.5) + """),
       scored AS (SELECT p.step, count(*) AS shifts, count(*) FILTER (WHERE t.vehicle_type = l.expected_type) AS matches
                  FROM steps p JOIN {study} t ON t.date > p.s AND t.date <= p.s + 28
                  JOIN learnt l ON l.step = p.step AND l.generic = t.generic GROUP BY 1)
       SELECT p.step, p.s AS learnt_to, coalesce(shifts, 0) AS shifts, coalesce(matches, 0) AS matches,
         CAST(sum(coalesce(shifts, 0)) OVER (ORDER BY p.step) AS BIGINT) AS total_shifts,
         CAST(sum(coalesce(matches, 0)) OVER (ORDER BY p.step) AS BIGINT) AS total_matches,
         sum(coalesce(matches, 0)) OVER (ORDER BY p.step) / nullif(sum(coalesce(shifts, 0)) OVER (ORDER BY p.step), 0)
           AS share
       FROM steps p LEFT JOIN scored c ON p.step = c.step""",
)
def _(t):
    return evaluate.backtest_monthly(study_cells(t), rows=t.long_history.count())
