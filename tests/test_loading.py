"""Loading: gates, files of unlike headers, malformed rows, workbook sheets, stored versions, bucketed history."""

import datetime as dt
import io
import zipfile

import pytest

from helpers import rows
from muster.operators import expected
from muster.plans import ambulance, production
from muster.sources import bucketed, quality, tables, workbook
from muster.sources.versions import StaleVersion, Versions

LEGACY = "EHS.NUMBER,NAME,UPDATED\n"
FLEET = ("AHS.Vehicle.ID,IsActive,Classification,StockLevel,VehicleType,DecommisionDate,Model,Division,StretcherConfig,"
         "StretcherType,PtCompSize,SeatingConfig,SeatingConfig2,InServicedate,Year\n")


def test_an_empty_key_stops_the_load(spark, tmp_path):
    (tmp_path / "legacy.csv").write_text(LEGACY + "1,A,SC113\n,B,\n")
    (tmp_path / "fleet.csv").write_text(FLEET + ",TRUE" + "," * 13 + "\n")
    loaded = tables.load(spark, {"legacy_vehicles": str(tmp_path / "legacy.csv"), "fleet_assets": str(tmp_path / "fleet.csv")})
    with pytest.raises(Exception, match="legacy_vehicles: empty ehs_number"):
        loaded["legacy_vehicles"].collect()
    with pytest.raises(Exception, match="fleet_assets: empty vehicle_id"):
        loaded["fleet_assets"].count()


def test_a_doubled_key_stops_a_strict_load(spark, tmp_path):
    (tmp_path / "legacy.csv").write_text(LEGACY + "1,A,SC113\n1,A,\n1,B,SC114\n")
    path = {"legacy_vehicles": str(tmp_path / "legacy.csv")}
    with pytest.raises(Exception, match="legacy_vehicles: repeated ehs_number, name"):
        tables.load(spark, path, gates=quality.STRICT)["legacy_vehicles"].collect()
    assert rows(tables.load(spark, path)["legacy_vehicles"]) == [("1", "A", "SC113"), ("1", "B", "SC114")]
    assert tables.load(spark, path, gates={})["legacy_vehicles"].count() == 3


def test_counts_are_taken_while_loading(spark, tmp_path):
    (tmp_path / "legacy.csv").write_text(LEGACY + "1,A,SC113\n1,A,\n2,B\n2,B,,x\n2,B,DS013\n")
    measures = quality.Measures()
    loaded = tables.load(spark, {"legacy_vehicles": str(tmp_path / "legacy.csv")}, measures=measures)
    assert rows(loaded["legacy_vehicles"]) == [("1", "A", "SC113"), ("2", "B", "DS013")]
    assert measures.of("legacy_vehicles") == {"malformed": 2, "rows": 3, "empty_ehs_number": 0, "repeated_keys": 1}


def test_a_doubled_legacy_vehicle_gives_one_row(spark, table):
    legacy = table("ehs_number string, name string, updated string", ("7", "7", None), ("7", "7", "DS013"), ("7", "7", "SC113"))
    history = table("unid string, carid string, cdts2 timestamp_ntz", *[("CALG-1A1", "7", dt.datetime(2024, 1, d)) for d in (1, 2)])
    shifts = table("unit_name string, active_inactive string, effective_end string, service_type string",
                   ("CALG-1A1", "Active", "", "Direct Delivery"))
    text = ("classification", "stock_level", "vehicle_type", "decommission_date", "stretcher_config", "stretcher_type",
            "pt_comp_size", "seating_config", "seating_config2")
    assets = table("vehicle_id string, is_active boolean, " + ", ".join(f"{c} string" for c in text), ("7", True, *[""] * 9))
    mapping = table(", ".join(f"{c} string" for c in text if c not in ("classification", "decommission_date")) + ", unit_type string")
    got = ambulance.described(history, shifts, assets, mapping, legacy, as_of=dt.date(2024, 2, 1))
    assert rows(got, "carid", "n", "updated") == [("7", 2, "DS013")]
    with pytest.raises(Exception, match="legacy_vehicles: empty ehs_number"):
        bad = legacy.union(table("a string, b string, c string", ("", "x", None)))
        ambulance.described(history, shifts, assets, mapping, bad, as_of=dt.date(2024, 2, 1)).collect()


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    folder = tmp_path / "history parts"
    folder.mkdir()
    (folder / "a.csv").write_text("CARID,UNID,CDTS2,CDTS\n1,U,2019-05-01 07:00:00,x\n")
    (folder / "b.csv").write_text("CDTS,Extra,UNID,CARID,CDTS2\ny,\"q, r\",V,2,2019-05-02 07:00:00\nz,,W,NA,\n")
    (folder / "c.csv").write_text("")
    (folder / "d.csv").write_text("CARID,UNID,CDTS2,CDTS\n3,X,,only\n4,Y\n5,Z,2019-05-01 07:00:00,x,extra\n")
    loaded = tables.load(spark, {"unit_history": str(folder)})["unit_history"]
    assert loaded.columns == ["unid", "carid", "cdts2", "cdts"]
    assert rows(loaded) == [
        ("U", "1", dt.datetime(2019, 5, 1, 7), "x"), ("V", "2", dt.datetime(2019, 5, 2, 7), "y"),
        ("W", None, None, "z"), ("X", "3", None, "only"),
    ]
    assert loaded.count() == 4 and rows(loaded, "unid") == [("U",), ("V",), ("W",), ("X",)]
    bad = tables.quarantine(spark, str(folder), "unit_history")
    assert bad.count() == 2
    assert bad.columns == ["table", "file", "reason", "record"]
    got = rows(bad, "table", "reason", "record")
    assert got == [("unit_history", "not 4 fields, first 4", "4,Y"),
                   ("unit_history", "not 4 fields, first 5", "5,Z,2019-05-01 07:00:00,x,extra")]
    assert all(r.file.endswith("d.csv") for r in bad.collect())


def test_a_file_without_a_needed_column_stops(spark, tmp_path):
    (tmp_path / "a.csv").write_text("CARID,UNID,CDTS2,CDTS\n1,U,,x\n")
    (tmp_path / "b.csv").write_text("CARID,CDTS2,CDTS\n1,,x\n")
    with pytest.raises(ValueError, match="unit_history: missing columns .'unid'"):
        tables.load(spark, {"unit_history": str(tmp_path)})
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "empty.csv").write_text("")
    assert tables.load_csv(spark, str(tmp_path / "none"), "unit_history").collect() == []


def book(sheets, shared=()):
    """A workbook of sheets given as XML rows."""
    out = io.BytesIO()
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(out, "w") as z:
        entries = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{entries}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i, _ in enumerate(sheets, 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="r">{links}</Relationships>')
        if shared:
            z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">{"".join(shared)}</sst>')
        for i, content in enumerate(sheets.values(), 1):
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{main}"><sheetData>{content}</sheetData></worksheet>')
    return out.getvalue()


SHARED = ["<si><t>generic</t></si>", "<si><t>ExpectedUnitType</t></si>", "<si><r><t>Default</t></r><r><t>Vehicle</t></r></si>",
          "<si><t>CALG-1X1</t></si>", "<si><t>SS002A.450</t></si>"]
EXPECTED = """
<row r="2"><c r="B2" t="s"><v>0</v></c><c r="C2" t="inlineStr"><is><t>Remark</t></is></c><c r="D2" t="s"><v>1</v></c><c r="AA2" t="s"><v>2</v></c></row>
<row r="3"><c r="B3" t="s"><v>3</v></c><c r="D3" t="s"><v>4</v></c><c r="AA3" t="str"><v>C-GABC</v></c></row>
<row r="4"><c r="B4"/></row>
<row r="5"><c r="B5" t="inlineStr"><is><t>CALG-1X2</t></is></c><c r="C5" t="b"><v>1</v></c><c r="D5" t="e"><v>#N/A</v></c><c r="AA5"><v>1012.0</v></c></row>
"""


@pytest.fixture
def aircraft(tmp_path):
    path = tmp_path / "Aircraft.xlsx"
    path.write_bytes(book({"Notes": "<row><c><v>1</v></c></row>", "Expected": EXPECTED}, SHARED))
    return str(path)


def test_workbook_sheet(spark, aircraft):
    got = workbook.load_sheet(spark, aircraft, "Expected", "aircraft_expected")
    assert rows(tables.sheet_assignments(got)) == [("CALG-1X1", "SS002A.450", "C-GABC"), ("CALG-1X2", None, "1012")]
    with pytest.raises(Exception, match="no sheet 'Other'"):
        workbook.load_sheet(spark, aircraft, "Other", "aircraft_expected").collect()
    with pytest.raises(Exception, match="missing columns"):
        workbook.load_sheet(spark, aircraft, "Notes", "aircraft_expected").collect()


def test_workbook_format(spark, aircraft):
    spark.dataSource.register(workbook.WorkbookSource)
    df = spark.read.format("workbook").option("sheet", "Expected").load(aircraft)
    assert df.columns == ["generic", "remark", "expected_unit_type", "default_vehicle"]
    assert rows(df) == [("CALG-1X1", None, "SS002A.450", "C-GABC"), ("CALG-1X2", "TRUE", None, "1012")]
    assert rows(tables.conform(df, "aircraft_expected"))[0] == ("CALG-1X1", "SS002A.450", "C-GABC")


STORED = "grouped_unit_name string, lut_key string, expected_vehicle_type_key string"


def test_one_of_two_concurrent_updates_is_refused(spark, table, tmp_path, monkeypatch):
    monkeypatch.setattr(production, "assignments", lambda rows, **_: rows)
    wanted = "external_key string, expected_vehicle_type_key string, grouped_unit string, unid string"
    first, second = (table(wanted, ("LUT_u1", kind, "g1", "u1")) for kind in ("UT_B", "UT_C"))
    store, other = Versions(spark, str(tmp_path / "store")), Versions(spark, str(tmp_path / "store"))
    assert store.current() is None
    with pytest.raises(ValueError, match="no version"):
        production.commit_update(first, store)
    store.commit(table(STORED, ("g1", "LUT_u1", "UT_A")), 0)
    started = other.current()
    assert production.commit_update(first, store).number == 2
    with pytest.raises(StaleVersion):
        other.commit(started.rows, started.number)
    assert rows(other.current().rows) == [("g1", "LUT_u1", "UT_B")]
    assert production.commit_update(second, other).number == 3
    assert production.commit_update(second, other).number == 3  # nothing to change
    assert [rows(store.read(n))[0][2] for n in store.numbers()] == ["UT_A", "UT_B", "UT_C"]


def test_the_rename_decides_when_both_are_about_to_commit(spark, table, tmp_path, monkeypatch):
    """Both writers have seen the same newest version and have written their rows."""
    store, other = Versions(spark, str(tmp_path / "store")), Versions(spark, str(tmp_path / "store"))
    store.commit(table(STORED, ("g1", "LUT_u1", "UT_A")), 0)
    monkeypatch.setattr(Versions, "_refuse_unless_newest", lambda self, base: None)
    store.commit(table(STORED, ("g1", "LUT_u1", "UT_B")), 1)
    with pytest.raises(StaleVersion, match="another writer"):
        other.commit(table(STORED, ("g1", "LUT_u1", "UT_C")), 1)
    assert store.numbers() == [1, 2] and rows(other.current().rows) == [("g1", "LUT_u1", "UT_B")]


def test_bucketed_history_needs_no_exchange(spark, table):
    times = [dt.datetime(2024, 1, 1) + dt.timedelta(hours=i) for i in range(200)]
    code = lambda t: t.strftime("%Y%m%d%H%M%S")
    history = table("unid string, carid string, cdts2 timestamp_ntz, cdts string",
                    *[(f"U{i % 3}", str(i % 7) if i % 11 else None, t, code(t)) for i, t in enumerate(times)])
    workload = table("unid string, cdts string, unit_status string, time_active bigint",
                     *[(f"U{i % 3}", code(t), "LO" if i % 5 else "OFF", 20_000) for i, t in enumerate(times)])
    bucketed.store(history, "stored_history", buckets=4)
    bucketed.store(workload, "stored_workload", buckets=4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = bucketed.read_history(spark, "stored_history", "stored_workload", newest=20)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
        assert rows(got) == rows(expected.read_history(history, workload, newest=20), *got.columns)
        assert got.count() == 60
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.unset(bucketed.SETTING)
        spark.sql("DROP TABLE stored_history")
        spark.sql("DROP TABLE stored_workload")
