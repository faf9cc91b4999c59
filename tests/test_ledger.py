import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows, values
from muster.functions import codes
from muster.operators import contractors, evaluate, expected, filters, fleet, forms, joins, publish, study, usage
from muster.plans import expected as expected_plan
from muster.plans import production

DAY = dt.datetime(2024, 1, 1)
LOGONS = "generic string, vehicle_type string, cdts2 timestamp_ntz"


def logons(table, types, generic="U"):
    return table(LOGONS, *[(generic, name, DAY + dt.timedelta(days=i)) for i, name in enumerate(types)])


def decided(df, threshold=0.6):
    return rows(expected.expected_type(df, threshold=threshold), "expected_type", "reason")


def test_ties_with_the_kth_logon_stay(table):
    times = [3, 2, 2, 1]
    df = table("generic string, cdts2 timestamp_ntz", *[("U", DAY + dt.timedelta(days=d)) for d in times])
    assert expected.last_k_logons(df, 2).count() == 3
    cells = table("generic string, date date, vehicle_type string, n bigint",
                  *[("U", dt.date(2024, 1, d), "SC113", n) for d, n in [(3, 1), (2, 2), (1, 1)]])
    assert values(expected.expected_type_by_day(cells, k=2), "logons") == [3]


def test_majority_is_strict(table):
    assert decided(logons(table, ["SC113"] * 3 + ["SC114"] * 2)) == [("SC113", "lowest")]
    assert decided(logons(table, ["SC114"] * 3 + ["SC113"] * 2)) == [("SC113", "lowest")]
    assert decided(logons(table, ["SC114"] * 4 + ["SC113"])) == [("SC114", "majority")]


def test_fallback(table):
    assert decided(logons(table, ["SC114", "SC114", "AA002N", "AA002N", "AA002S"])) == [("AA002N", "lowest")]
    assert decided(logons(table, ["SC114", "AA002N", "AA002S"])) == [(None, "none")]
    assert decided(logons(table, ["X", "X", "Y", "Y"])) == [(None, "unranked")]


def test_unknown_type_can_win_and_ranks_lowest(table):
    assert decided(logons(table, [None] * 4 + ["SC113"])) == [(None, "majority")]
    assert decided(logons(table, [None] * 2 + ["SC113"] * 2)) == [(None, "lowest")]


def test_recent_logons_equals_join_first(table):
    history = table("unid string, carid string, cdts2 timestamp_ntz",
                    *[(u, str(i % 4), DAY + dt.timedelta(hours=(i * 7) % 13)) for i in range(60)
                      for u in ("CALG-1A2", "CALG-1B2")], ("EDMO-1A1", "1", DAY))
    shifts = table("unit_name string, generic string", ("CALG-1A2", "CALG-1_2"), ("CALG-1B2", "CALG-1_2"))
    types = table("vehicle string, vehicle_type string", ("0", "SC113"), ("1", "SC114"))
    plain = joins.history_types(expected.last_k_logons(joins.history_shifts(history, shifts), 5), types)
    names = ["generic", "unid", "carid", "cdts2", "vehicle_type"]
    assert rows(expected.recent_logons(history, shifts, types, 5), *names) == rows(plain, *names)


def test_production_default_and_unknown_types(table):
    columns = ("unid string, cad_unit_type string, carid string, cdts2 timestamp_ntz, "
               "vehicle_type_external_key string, appended int")
    times = [DAY + dt.timedelta(days=i) for i in range(9)]
    df = expected.with_defaults(table(
        columns,
        # The newest two logons have no type, so k = 2 leaves nothing: default by the lowest id.
        ("CALG-1A1", "ALS", "5000", times[0], "UT_SC113", 0), ("CALG-1A1", "ALS", "1000", times[1], None, 0),
        ("CALG-1B1", "ALS", "6000", times[2], None, 0),
        # No vehicle sorts first, so the kind decides for the group.
        ("CALG-1A2", "EMR", "5000", times[0], "UT_X", 0), ("CALG-1B2", "ALS", None, None, None, 0),
        # An added row comes last.
        ("CALG-1A3", "EMR", "5000", times[0], "UT_X", 0), ("CALG-1B3", "ALS", None, None, None, 1),
        # Repeated types keep their full key.
        *[("CALG-1T9", "BNAT", "1", t, k, 0) for t, k in zip(times, ["UT_SC113", "UT_SC113", "UT_SC114", "UT_SC114"])],
        ("CALG-1X1", "PLANE", None, None, None, 0),
    ))
    got = {r[0]: r[1:] for r in rows(expected.production_types(df, [(2, 0.5)]), "grouped_unit", "expected_type", "reason")}
    assert got["CALG-1_1"] == ("UT_SC002", "default")
    assert got["CALG-1_2"] == ("UT_X", "majority") and got["CALG-1_3"] == ("UT_X", "majority")
    assert got["CALG-1T9"] == ("UT_SC114", "majority")
    assert got["CALG-1X1"] == ("Undefined", "default")
    defaults = {r[0]: r[1] for r in rows(expected.group_defaults(df), "grouped_unit", "default_type")}
    assert defaults["CALG-1_2"] == "UT_SC002" and defaults["CALG-1_3"] == "UT_AA002N"
    four = expected.production_types(df, [(4, 0.5)]).where("grouped_unit = 'CALG-1T9'")
    assert rows(four, "expected_type", "reason") == [("UT_SC113", "lowest")]


def test_crew_filter_can_be_the_identity(table):
    df = table("unit_name string, days string, cad_unit_type string",
               ("PICT-5A1", "Weekend", "X"), ("PICT-5A1", "Daily", "ALS"), ("A", "Daily", "ALS"), ("B", "Daily", "DISP"))
    assert filters.crew_shift_filter(df).count() == 2
    assert filters.crew_shift_filter(df, apply_filter=False).count() == 4


def test_runs_drop_the_first_shift(table):
    df = table("generic string, date date, carid string, vehicle_type string, n bigint",
               *[("U", dt.date(2024, 1, 28 + i) if i < 3 else dt.date(2024, 2, i), "1", name, 1)
                 for i, name in enumerate(["a", "a", "a", "b", "a"])],
               ("V", dt.date(2024, 1, 1), "1", "a", 1))
    assert sorted(r[0] for r in study.type_runs(df).select("length").collect()) == [1, 1, 2]
    steps = rows(study.type_transitions(df), "curr", "prev", "n")
    assert steps == [("a", "a", 2), ("a", "b", 1), ("b", "a", 1)]
    assert rows(study.change_rate(study.type_transitions(df))) == [(2, 4, 50.0)]


def test_rule_accuracy_keeps_the_reference_ratio(table):
    df = table("dgroup string, letter string, vehicle_type string, n bigint",
               ("CALG", "A", "SC113", 6), ("CALG", "B", "SC114", 4), ("CALG", "P", "AA002S", 10))
    got = {r[0]: r[1:] for r in rows(study.rule_accuracy(df))}
    assert got["letter"] == (6, 10, 0.6, 0.6)
    assert got["group"] == (16, 20, 0.8, 1.6)


def test_type_choice_outcomes_and_overrides(table):
    df = table("carid string, unit_type string, updated string",
               ("1", "SC113", None), ("2", "UNKNOWN", "DS013"), ("3", "UNKNOWN", None), ("4", None, None), ("5", "UNKNOWN", None))
    choice = fleet.vehicle_type_choice(df)
    assert values(choice.orderBy("vehicle"), "outcome") == ["gap", "gap", "unmapped", "valid", "valid"]
    checked = table("vehicle string, checked_type string", ("3", "SC113"), ("1", "never"))
    assert rows(fleet.apply_overrides(choice, checked)) == [("1", "SC113"), ("2", "DS013"), ("3", "SC113")]


def test_missing_values_in_joins(table):
    left = table("k string", ("a",), (None,))
    right = table("key string", ("a",), (None,))
    assert rows(joins.anti_missing(left, "k", right, "key")) == [(None,)]
    vehicles = table("carid string, x string", ("1", None), ("2", "Q"))
    mapping = table("x string, unit_type string", (None, "blank"), ("q", "known"))
    found = joins.config_lookup(vehicles, mapping, ["x"])
    assert rows(found, "carid", "unit_type") == [("1", "blank"), ("2", "known")]


def test_road_units(table):
    df = table("unid string", ("XV1",), ("FRD2",), ("CALG-1X3",), ("CALG1X3",), ("CALG1",), ("CALG-1A1",), (None,))
    assert rows(filters.road_units(df)) == [("CALG-1A1",), ("CALG1X3",), (None,)]
    assert rows(filters.road_units(df, dash=False)) == [("CALG-1A1",), (None,)]


def test_shift_end_and_services(table):
    df = table("active_inactive string, effective_end string, service_type string",
               ("Active", "", "Direct Delivery"), ("Active", "2024-01-31", "Direct Delivery"),
               ("Active", "2024-02-02", "Contracted - Air"), ("Inactive", "", "Direct Delivery"), ("Active", None, "Other"))
    as_of = dt.date(2024, 2, 1)
    assert filters.active_shifts(df, as_of=as_of).count() == 3
    assert sorted(values(filters.service_split(df, as_of=as_of), "service_class")) == ["contr", "direct"]


def test_suv_units_and_recent_usage(table):
    df = table("unid string, carid string, cdts2 timestamp_ntz",
               ("CALG-1P1", "41012", DAY), ("CALG-1P1", "41012", DAY), ("CALG-1P1", "1012", DAY), ("CALG-1P1", "912", DAY),
               ("CALG-1A1", "41012", DAY), ("CALG-1P1", "7", DAY))
    suv = filters.suv_units(df)
    assert suv.count() == 3
    assert rows(usage.recent_usage(usage.uses_since(suv, dt.date(2023, 12, 31)))) == [("41012", 2)]
    assert usage.recent_usage(usage.uses_since(suv, dt.date(2024, 1, 1))).count() == 0


def test_contractors(table):
    schema = "unid string, carid string, n bigint, last_logon timestamp_ntz, service string"
    late = DAY + dt.timedelta(days=3)
    contracted = table(schema, ("CALG-1A2", "1", 5, late, "S1"), ("CALG-1A1", "1", 2, late, "S1"), ("EDMO-1A1", "1", 3, DAY, "S2"),
                       ("EDMO-1T1", "2", 4, DAY, "S1"), ("CALG-1T1", "2", 4, DAY, "S2"), ("CALG-1A1", "993", 9, DAY, "S1"),
                       ("CALG-1Z1", "3", 1, DAY, "S1"))
    direct = table(schema, ("CALG-9A1", "3", 2, DAY, "D"), ("CALG-9A1", "2", 8, DAY, "D"))
    legacy = table("ehs_number string", ("1",))
    got = rows(contractors.contractor_vehicles(contracted, direct, legacy))
    assert got == [
        ("S1", "1", 7, late.date(), "CALG-1A1;CALG-1A2", "CALG-1A1", 0),
        ("S1", "2", 4, DAY.date(), "EDMO-1T1", "EDMO-1T1", 1),
        ("S2", "2", 4, DAY.date(), "CALG-1T1", "CALG-1T1", 1),
    ]
    pairs = usage.vehicle_summary(contracted, "service")
    assert rows(contractors.losing_services(pairs)) == [("1", "S2")]
    assert values(contractors.direct_majority(contracted, direct), "carid") == ["10095", "114", "3", "993"]
    classes = {r[0]: r[1:] for r in rows(contractors.vehicle_class(contracted))}
    assert classes["1"] == ("CALG-1A2", "AMB", "unusual ambulance id")
    assert classes["2"] == ("CALG-1T1", "NAT", "")
    assert classes["3"] == ("CALG-1Z1", None, "unknown unit letter")
    assert {r.dgroup for r in contractors.multi_group_vehicles(contracted).collect()} == {"CALG", "EDMO"}


def test_changes_and_snapshot(table):
    new = table("external_key string, expected_vehicle_type_key string, grouped_unit string, unid string",
                *[(f"LUT_{u}", k, u, u) for u, k in [("a", "T1"), ("b", "T2"), ("c", "T3"), ("d", "T4")]])
    stored = table("grouped_unit_name string, lut_key string, expected_vehicle_type_key string",
                   ("a", "LUT_a", "T1"), ("b", "LUT_b", "T9"), ("c", "LUT_c", None), ("z", "LUT_z", "T5"))
    changes = publish.expected_changes(new, stored)
    assert rows(changes, "action", "external_key") == [("insert", "LUT_d"), ("update", "LUT_b"), ("update", "LUT_c")]
    after = rows(publish.stored_after(stored, changes), "lut_key", "expected_vehicle_type_key")
    assert after == [("LUT_a", "T1"), ("LUT_b", "T2"), ("LUT_c", "T3"), ("LUT_d", "T4"), ("LUT_z", "T5")]
    assert publish.expected_changes(new, publish.stored_after(stored, changes)).count() == 0


def test_daily_metrics_fill_days(table):
    df = table("k int, threshold double, day date, vehicle_type_external_key string, expected_type string, n bigint",
               (7, 0.5, dt.date(2024, 1, 1), "a", "a", 1), (7, 0.5, dt.date(2024, 1, 1), None, "a", 2),
               (7, 0.5, dt.date(2024, 1, 3), "a", "b", 3), (7, 0.5, dt.date(2024, 1, 3), "a", None, 5))
    assert rows(evaluate.daily_metrics(df), "logons", "matches", "mismatches", "matches_percent") == [
        (0, 0, 0, None), (3, 1, 0, 33.33), (8, 0, 3, 0.0)]
    assert rows(evaluate.match_counts(df)) == [(11, 1, 3, 2, 5)]


def test_expected_table_keys(table):
    df = table("generic string, expected_type string, default_vehicle string", ("u", "SC113", "12"), ("v", "SS002H.250", "C-1"), ("w", None, "3"))
    assert rows(publish.expected_table(df), "expected_unit_type_key", "default_vehicle_key") == [
        ("UT_SC113", "UT_12"), ("UT_SS002H.250", "UT_Air_C-1")]


def test_survey_rules(table):
    names = [forms.field(h) for h in ("Max Stretchers", "Max Wheelchairs", "Max Ambulatory Patients", "Mixed Use")]
    df = table(", ".join(f"{n} string" for n in names), ("0", "10", "20", "Yes"), ("11", "2.5", "21", "maybe"), ("", None, "20.0", ""))
    got = [r.violations for r in forms.survey_check(df, forms.transport_rules()).collect()]
    assert got == [[], ["max_stretchers", "max_wheelchairs", "max_ambulatory_patients", "mixed_use"], []]


def test_recent_fleet(table):
    df = table("vehicle_id string, in_service_date string, year int", ("1", "", 2000), ("2", "2023-06-01", 2000), ("3", "", 2023), ("4", "", None))
    active = table("name string", ("4",), ("9",))
    assert values(filters.recent_fleet(df, active, as_of=dt.date(2024, 2, 1)), "vehicle_id") == ["2", "3", "4"]


def test_fleet_suv_words(table):
    df = table("model string, classification string, vehicle_type string, division string, stock_level string",
               ("GMC YUKON", "", "", "", ""), ("", "Suv", "", "", ""), ("", "", "supervisor", "", ""), ("", "", "", "community care", ""),
               ("", "", "", "", "PRU"), (None, None, None, None, None))
    assert filters.fleet_suvs(df).count() == 4
    assert filters.fleet_suvs(df, types=["supervisor"]).count() == 5


def test_long_codes_stay_whole(table):
    unit = "CALG-1A" + "7" * 120
    found = table("unit string", (unit,)).select(codes.grouped_unit(F.col("unit")), codes.generic_unit(F.col("unit"))).first()
    assert set(found) == {"CALG-1_" + "7" * 120}


def test_a_type_without_a_column_stops_the_matrix(table):
    steps = table("curr string, prev string, n bigint", ("a", "a", 2), ("a", "b", 1))
    assert rows(study.transition_matrix(steps, ["a", "b"]))[0][1:] == pytest.approx((66.7, 33.3))
    with pytest.raises(Exception, match="without a column"):
        study.transition_matrix(steps, ["a"]).collect()


def test_runs_over_whole_slices(table):
    days = [("a", 3, 30), ("a", 4, 2), ("b", 4, 3), ("a", 4, 4), ("c", 4, 5), ("c", 5, 1), ("c", 6, 1), ("b", 6, 2)]
    df = table("generic string, date date, carid string, vehicle_type string, n bigint",
               *[("U", dt.date(2024, m, d), "1", name, 2) for name, m, d in days])
    assert rows(study.type_runs(df), "vehicle_type", "length") == [("a", 2), ("a", 3), ("b", 2), ("b", 2), ("c", 6)]


def test_logons_without_a_vehicle_keep_a_null_type(table):
    history = table("unid string, carid string", *[("U", None)] * 3, ("U", "1"), ("U", "2"))
    types = table("vehicle string, vehicle_type string", ("1", "SC113"), (None, "X"))
    got = joins.history_types(history, types)
    assert got.columns == ["unid", "carid", "vehicle_type"]
    assert rows(got) == [("U", "1", "SC113"), ("U", "2", None)] + [("U", None, None)] * 3


def test_update_is_written_once(spark, table, tmp_path, monkeypatch):
    stored = table("grouped_unit_name string, lut_key string, expected_vehicle_type_key string",
                   ("g1", "LUT_u1", "UT_A"), ("g2", "LUT_u2", None), ("g3", "LUT_u3", "UT_C"))
    wanted = table("external_key string, expected_vehicle_type_key string, grouped_unit string, unid string",
                   ("LUT_u1", "UT_B", "g1", "u1"), ("LUT_u2", "UT_A", "g2", "u2"), ("LUT_u4", "UT_D", "g4", "u4"))
    monkeypatch.setattr(production, "assignments", lambda rows, **_: rows)
    version = str(tmp_path / "v2")
    after = production.write_update(wanted, stored, version)
    assert rows(after) == [("g1", "LUT_u1", "UT_B"), ("g2", "LUT_u2", "UT_A"), ("g3", "LUT_u3", "UT_C"), ("g4", "LUT_u4", "UT_D")]
    assert production.update(wanted, after).count() == 0
    with pytest.raises(Exception, match="already exists"):
        production.write_update(wanted, stored, version)


def test_fleet_is_compared_by_legacy_name(table):
    legacy = table("ehs_number string, name string, updated string", ("1", "1", None), ("2", "Old 2", None), ("3", None, None))
    assets = table("vehicle_id string, year int", ("1", 2000), ("2", 2001), ("9", 2002))
    assert rows(fleet.new_vehicles(assets, legacy), "vehicle_id") == [("2",), ("9",)]
    assert rows(fleet.lost_vehicles(legacy, assets), "ehs_number") == [("2",), ("3",)]


def test_split_join_deals_out_a_large_key(spark, table):
    large = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "big").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.lit("x").alias("j"), F.col("id").alias("v"))
    small = table("k string, j string, w int", ("big", "x", 1), ("k1", "x", 2), ("k2", "x", 3), ("k2", "x", 4), ("k3", "y", 5))
    for how in ("inner", "left"):
        plain = large.join(small, ["k", "j"], how)
        assert rows(joins.split_join(large, small, ["k", "j"], how), "v", "w") == rows(plain, "v", "w")
    limit, before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.shuffle.partitions")
    # as on a cluster: more tasks than large keys, and partitions left as they are
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "64",
                "spark.sql.adaptive.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = joins.split_join(large, small, ["k", "j"], "left")
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        # an even share is 30,000 / 64; a hash puts a few pieces together
        assert sizes[-1] < 30_000 / 64 * 6
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_shares_without_a_window_over_all_rows(table):
    counts = table("dgroup string, carid string, n bigint", *[("G", str(i), i % 9 + 1) for i in range(100)])
    ecdf = usage.usage_ecdf(counts)
    got = rows(ecdf, "n", "pairs", "share")
    assert got[-1][2] == 1.0 and [r[1] for r in got] == [12, 11, 11, 11, 11, 11, 11, 11, 11]
    assert [r[2] for r in got][:2] == [0.12, 0.23]
    windows = [line for line in ecdf._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window" in line]
    assert len(windows) == 1 and "_stretch" in windows[0]


def test_one_call_gives_the_whole_study(table):
    units = [("CALG-1A1", "CALG-1_1"), ("CALG-1T2", "CALG-1T2")]
    days = [dt.datetime(2024, 1, 1) + dt.timedelta(days=i) for i in range(70)]
    history = table("unid string, carid string, cdts2 timestamp_ntz", *[(u, str(i // 7 % 2), d) for i, d in enumerate(days) for u, _ in units])
    shifts = table("unit_name string, generic string, active_inactive string, cad_unit_type string, agency string, type string, district string",
                   *[(u, g, "Active", "ALS", "AHSETX", "Crew", "D1") for u, g in units])
    types = table("vehicle string, vehicle_type string", ("0", "SC113"), ("1", "AA002N"))
    report = expected_plan.study_report(history, shifts, types, matrix=["SC113", "AA002N"])
    assert rows(report["type_frequency"], "vehicle_type", "n") == [("AA002N", 70), ("SC113", 70)]
    assert rows(report["change_rate"]) == [(18, 138, pytest.approx(100 * 18 / 138))]
    assert rows(report["run_lengths"]) == [(5, 20)]
    assert report["monthly_update"].count() == 2 and report["transition_matrix"].count() == 2
    assert all(df.count() > 0 for df in report.values())
