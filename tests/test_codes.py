import datetime as dt

import pytest
from pyspark.sql import functions as F

from muster.functions import codes, fixed


def one(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0].v


def text(value):
    return F.lit(value).cast("string")


@pytest.mark.parametrize("unit,generic", [("CALG-1A2", "CALG-1_2"), ("CALG-1B2", "CALG-1_2"), ("CALG-1T1", "CALG-1T1")])
def test_generic(spark, unit, generic):
    assert one(spark, codes.generic_unit(F.lit(unit))) == generic
    assert one(spark, codes.grouped_unit(F.lit(unit))) == generic


@pytest.mark.parametrize("unit,twin", [("CALG-1A2", "CALG-1B2"), ("CALG-1B2", "CALG-1A2"), ("CALG-1T1", None)])
def test_twin(spark, unit, twin):
    assert one(spark, codes.twin_unit(F.lit(unit))) == twin


@pytest.mark.parametrize(
    "letter,name",
    [("A", "AMB"), ("B", "AMB"), ("T", "NAT"), ("P", "SUV"), ("L", "SUV"), ("S", "SUV"), ("M", "SUV"), ("D", "SUV"), ("W", None)],
)
def test_unit_class(spark, letter, name):
    assert one(spark, codes.unit_class(F.lit(f"CALG-1{letter}1"))) == name


@pytest.mark.parametrize(
    "vehicle,kind,expected",
    [
        ("899", "ALS", "UT_SC002"), ("900", "ALS", "UT_GhostVehicle"), ("999", "ALS", "UT_GhostVehicle"),
        ("1000", "BNAT", "UT_SC002"), ("4999", "BNAT", "UT_SC002"), ("5000", "ALS", "UT_AA002N"),
        ("9000", "ALS", "UT_GhostVehicle"), ("10000", "ALS", "UT_AA002S"), ("19998", "ALS", "UT_AA002S"),
        ("19999", "BNAT", "UT_AA002N"), ("20000", "ALS", "UT_AA002N"), ("40000", "ALS", "UT_AA002S"),
        ("50000", "PRU", "UT_AA002S"), ("C-12", "HELI", "UT_SS002H.250"), ("C-12", "FLIGHT", "UT_SS002A.450"),
        (None, "Other", "UT_GhostVehicle"), (None, "PLANE", "Undefined"), (None, None, "Undefined"),
        ("1000.7", "ALS", "UT_SC002"), (None, "DISP", "UT_GhostVehicle"),
    ],
)
def test_default_type(spark, vehicle, kind, expected):
    assert one(spark, codes.default_type(text(vehicle), text(kind))) == expected


@pytest.mark.parametrize(
    "key,bare", [("UT_SC113", "SC113"), ("UT_Air_SS002A.450", "SS002A.450"), ("SC113", "SC113"), (None, None)]
)
def test_bare_type(spark, key, bare):
    assert one(spark, codes.bare_type(text(key))) == bare


def test_type_order(spark):
    # SUV, transports by stretcher, ambulances by stretcher, helicopter, aeroplane.
    keys = ["UT_AA002S", "UT_AA002N", "UT_SC002N", "UT_SW002N3", "UT_SS001", "UT_SC013", "UT_SC113", "UT_SC114",
            "UT_DS013", "UT_Air_SS002H.250", "UT_Air_SS002A.450"]
    expected = ["UT_AA002S", "UT_AA002N", "UT_SC002N", "UT_SW002N3", "UT_SS001", "UT_SC013", "UT_DS013", "UT_SC113",
                "UT_SC114", "UT_Air_SS002H.250", "UT_Air_SS002A.450"]
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    assert [r.key for r in df.orderBy(codes.type_rank_key(F.col("key"))).collect()] == expected
    first = df.orderBy(codes.type_rank_key(F.col("key"), fixed.CLASS_SCORES_FIRST_RUN)).collect()
    assert first[0].key == "UT_Air_SS002A.450"  # the first run never scored letter A


def test_type_code_gap(spark):
    gap = [one(spark, codes.type_code_gap(F.lit(k))) for k in ["UT_SW002N", "UT_WA002N4", "UT_SC113", "UT_Air_SS002A"]]
    assert gap == [True, False, False, True]


def test_listed_rank(spark):
    assert one(spark, codes.listed_rank(text(None))) == 1
    assert one(spark, codes.listed_rank(text(None), null_ranks_lowest=False)) is None
    assert one(spark, codes.listed_rank(text("AA002S"))) == 2
    assert one(spark, codes.listed_rank(text("DS016"))) == 22
    assert one(spark, codes.listed_rank(text("nope"))) is None


def test_text_and_dates(spark):
    assert one(spark, codes.capital_group(F.lit("CALG-1A1"))) == "CALG"
    assert one(spark, codes.capital_group(F.lit("Calg-1A1"))) is None
    assert one(spark, codes.dispatch_group(F.lit("CAL"))) is None
    assert one(spark, codes.date_of(F.lit("2019-05-06"))) == dt.date(2019, 5, 6)
    assert one(spark, codes.date_of(F.lit("soon"))) is None
    assert one(spark, codes.whole_number(F.lit("12.7"))) == 12
    assert one(spark, codes.whole_number(F.lit("C-12"))) is None
    assert one(spark, codes.path_label(F.lit("Smith & Sons"))) == "Smith...Sons"
    assert one(spark, codes.path_label(F.lit("1st"))) == "X1st"
    assert one(spark, codes.percent(F.lit(1), F.lit(8))) == 12.5
    assert one(spark, codes.percent(F.lit(1), F.lit(0))) is None
