"""Table schemas. Ids are text; a loader may find more columns and drops them."""

from __future__ import annotations

from pyspark.sql import types as T


KINDS = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _table(text: str) -> T.StructType:
    """Schema from 'name type, name type'; needs no running session."""
    fields = [entry.split() for entry in text.split(", ")]
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in fields])


SCHEMAS = {
    "fleet_assets": _table(
        "vehicle_id string, is_active boolean, classification string, stock_level string, "
        "vehicle_type string, decommission_date string, model string, division string, "
        "stretcher_config string, stretcher_type string, pt_comp_size string, "
        "seating_config string, seating_config2 string, in_service_date string, year int"
    ),
    "legacy_vehicles": _table("ehs_number string, name string, updated string"),
    "shift_inventory": _table(
        "shift_no bigint, unit_name string, active_inactive string, effective_end string, "
        "service_type string, service string, cad_unit_type string, agency string, "
        "type string, district string, days string"
    ),
    "unit_history": _table(
        "unid string, carid string, cdts2 timestamp_ntz, cdts string"
    ),
    "unit_workload": _table("unid string, cdts string, unit_status string, time_active bigint"),
    "vehicle_history": _table("carid string"),
    "vehicle_types": _table("vehicle string, vehicle_type string, active int"),
    "vehicle_register": _table(
        "name string, external_key string, vehicle_type_external_key string, deleted_status int"
    ),
    "config_mapping": _table(
        "vehicle_type string, stock_level string, stretcher_config string, stretcher_type string, "
        "pt_comp_size string, seating_config string, seating_config2 string, unit_type string"
    ),
    "stored_expected": _table(
        "grouped_unit_name string, lut_key string, expected_vehicle_type_key string"
    ),
    "aircraft_expected": _table("generic string, expected_unit_type string, default_vehicle string"),
    "active_vehicles": _table("name string"),
}

# Headings of the exported files whose snake_case form is not obvious.
HEADINGS = {
    "ahs_vehicle_id": "vehicle_id",
    "isactive": "is_active",
    "vehicletype": "vehicle_type",
    "stocklevel": "stock_level",
    "decommisiondate": "decommission_date",
    "stretcherconfig": "stretcher_config",
    "stretchertype": "stretcher_type",
    "ptcompsize": "pt_comp_size",
    "seatingconfig": "seating_config",
    "seatingconfig2": "seating_config2",
    "inservicedate": "in_service_date",
    "unittype": "unit_type",
    "expectedunittype": "expected_unit_type",
    "defaultvehicle": "default_vehicle",
    "externalkey": "external_key",
    "vehicletypeexternalkey": "vehicle_type_external_key",
    "deletedstatus": "deleted_status",
}

# Text columns where a missing value carries meaning and must stay null.
NULLABLE_TEXT = {
    "legacy_vehicles": ["updated"],
    "unit_history": ["carid"],
    "vehicle_types": ["vehicle_type"],
    "vehicle_register": ["vehicle_type_external_key"],
    "stored_expected": ["expected_vehicle_type_key"],
    "aircraft_expected": ["expected_unit_type", "default_vehicle"],
    "config_mapping": ["unit_type"],
}
