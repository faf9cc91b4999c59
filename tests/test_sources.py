import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows, values
from muster.functions import fixed
from muster.operators import forms, publish
from muster.session import cut, shared_folder, small_table
from muster.sources import quality, tables


def test_csv_load(spark, tmp_path):
    path = tmp_path / "history.csv"
    path.write_text("CARID,UNID,CDTS2,CDTS,Extra\n0012,CALG-1A1,2019-05-01 07:00:00,20190501070000MD,x\n,CALG-1A2,bad,,y\nNA,,2019-05-02 00:00:00,,z\n")
    df = tables.load(spark, {"unit_history": str(path)})["unit_history"]
    assert df.columns == ["unid", "carid", "cdts2", "cdts"]
    assert rows(df) == [
        ("", None, dt.datetime(2019, 5, 2), ""),
        ("CALG-1A1", "0012", dt.datetime(2019, 5, 1, 7), "20190501070000MD"),
        ("CALG-1A2", None, None, ""),
    ]


def test_only_a_local_session_goes_without_a_shared_folder():
    class Context:
        master = "spark://somewhere:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_headings_of_the_fleet_file(spark, tmp_path):
    path = tmp_path / "fleet.csv"
    path.write_text(
        "AHS.Vehicle.ID,IsActive,Classification,StockLevel,VehicleType,DecommisionDate,Model,Division,StretcherConfig,"
        "StretcherType,PtCompSize,SeatingConfig,SeatingConfig2,InServicedate,Year\n"
        "test123,TRUE,AMB III,ALS,Van,,E450,EMS,Single,Power,164,Fixed,,2019-01-01,2018\n"
    )
    row = tables.load_csv(spark, str(path), "fleet_assets").collect()[0]
    assert (row.vehicle_id, row.is_active, row.decommission_date, row.year) == ("test123", True, "", 2018)
    with pytest.raises(ValueError, match="missing columns"):
        tables.load_csv(spark, str(path), "unit_history")


def test_quality(spark, table):
    df = table("id string, name string", ("1", "a"), ("1", "a"), ("", "b"), (None, "c"))
    assert rows(quality.violations(df, {"empty": quality.empty_key("id")})) == [(2,)]
    assert values(quality.repeated_keys(df, ["id", "name"]), "repeated_keys") == [1]
    assert quality.missing_columns(df, ["id", "x"]) == ["x"]
    bad = quality.require(df, {"empty key": F.coalesce(F.col("id"), F.lit("")) == ""}, "legacy")
    with pytest.raises(Exception, match="legacy: empty key"):
        bad.collect()
    assert quality.require(df.where("id = '1'"), {"empty key": F.col("id") == ""}, "legacy").count() == 2


def test_dedupe_takes_the_first(table):
    df = table("k string, v string, at int", ("a", "x", 2), ("a", "y", 1), ("b", "z", 1), ("b", "w", 1))
    assert rows(quality.dedupe_by_key(df, ["k"], ["at", "v"]), "k", "v") == [("a", "y"), ("b", "w")]


def test_readers_of_database_tables(table):
    register = table("name string, external_key string, vehicle_type_external_key string, deleted_status int", ("1", "k", "UT_SC113", 0), ("2", "k", None, 1))
    assert rows(tables.vehicle_types(register)) == [("1", "k", "UT_SC113")]
    types = table("vehicle string, vehicle_type string, active int", ("1", "SC113", 1), ("2", "SC113", 0))
    assert rows(tables.active_vehicle_types(types)) == [("1", "SC113")]


def test_forms_are_written_per_service(spark, table, tmp_path):
    vehicles = table("service string, carid string, last_logon date, last_unit string, unit_class string",
                     ("A & B", "1001", dt.date(2024, 1, 2), "CALG-1A1", "AMB"), ("C", "7", dt.date(2024, 1, 3), "CALG-1T1", "NAT"))
    form = forms.ambulance_form(vehicles)
    assert form.count() == 4 * 2 + 1
    forms.write_forms(form, fixed.AMBULANCE_FORM, str(tmp_path / "form"))
    back = spark.read.option("header", True).csv(str(tmp_path / "form"))
    assert {r.form for r in back.select("form").distinct().collect()} == {"A...B", "C"}
    assert [c for c in back.columns if c not in ("form", "service")] == fixed.AMBULANCE_FORM
    numbers = [r["EHS Number"] for r in back.where("form = 'A...B'").collect()]
    assert sorted(numbers) == ["1001", "Example1", "Example2", "Example3", "Example4"]
    assert forms.transport_form(vehicles).where("NOT is_example").count() == 1


def test_services_of_equal_labels_keep_their_forms_apart(table):
    vehicles = table("service string, carid string, last_logon date, last_unit string, unit_class string",
                     ("A & B", "1001", dt.date(2024, 1, 2), "CALG-1A1", "AMB"), ("A + B", "7", dt.date(2024, 1, 3), "CALG-1A2", "AMB"))
    form = forms.ambulance_form(vehicles).where("NOT is_example")
    assert rows(form, "service", "form", "ehs_number") == [("A & B", "A...B", "1001"), ("A + B", "A...B-2", "7")]


def test_writers(spark, table, tmp_path):
    staged = publish.stage_vehicles(table("vehicle string, vehicle_type string", ("1", "SC113")), as_of=dt.date(2024, 2, 1))
    publish.write_csv(staged, str(tmp_path / "staging"))
    assert rows(spark.read.option("header", True).csv(str(tmp_path / "staging"))) == [("1", "SC113", "true", "2024-02-01")]
    publish.write_parquet(staged, str(tmp_path / "p"), by=("vehicle_type",))
    assert spark.read.parquet(str(tmp_path / "p")).where("vehicle_type = 'SC113'").count() == 1


def test_checkpoints_go_to_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named
    assert named in spark.sparkContext.getCheckpointDir()
    assert rows(cut(small_table(spark, ["a", "b"], [(1, None), (2, "x")]))) == [(1, None), (2, "x")]
