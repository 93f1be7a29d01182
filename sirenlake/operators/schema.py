"""Names and types of the dispatch data model, plus plan-time schema checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names of the published call files.
RAW_COLUMNS = [
    "_id", "call_id_hash", "service", "priority", "priority_desc", "call_quarter", "call_year",
    "description_short", "city_code", "city_name", "geoid",
    "census_block_group_center__x", "census_block_group_center__y",
]

# Spellings of file headers (upper case) and the raw column each one feeds.
HEADER_ALIASES = {
    "CAD_INCIDENT_ID": "call_id_hash",
    "INCIDENT_ID": "call_id_hash",
    "SERVICE_TYPE": "service",
    "PRIORITY": "priority",
    "PRIORITY_DESC": "priority_desc",
    "INITIAL_PRIORITY": "priority",
    "INITIAL_PRIORITY_DESC": "priority_desc",
    "DESCRIPTION_SHORT": "description_short",
    "CALL_TYPE": "description_short",
    "INCIDENT_TYPE": "description_short",
    "CALL_CREATE_TIME": "call_create_time",
    "INCIDENT_DATE": "call_create_time",
    "CREATE_TIME_INCIDENT": "call_create_time",
    "CITY_CODE": "city_code",
    "CITY_NAME": "city_name",
    "GEOID": "geoid",
    "CENSUS_BLOCK_GROUP_CENTER__X": "census_block_group_center__x",
    "CENSUS_BLOCK_GROUP_CENTER__Y": "census_block_group_center__y",
    "LONGITUDE": "census_block_group_center__x",
    "LATITUDE": "census_block_group_center__y",
    "RESPONSE_TIME_SEC": "response_time_sec",
    "UNIT_DISPATCH_TIME": "unit_dispatch_time",
    "UNIT_ON_SCENE_TIME": "unit_on_scene_time",
}

# Raw name -> canonical name.
CANONICAL_NAMES = {
    "call_id_hash": "incident_id",
    "service": "service_type",
    "priority": "priority_code",
    "priority_desc": "priority_description",
    "call_quarter": "quarter",
    "call_year": "year",
    "description_short": "call_type",
    "geoid": "census_block_group",
    "census_block_group_center__x": "longitude",
    "census_block_group_center__y": "latitude",
}

# Columns that count towards completeness; the last three may be absent.
CORE_COLUMNS = [
    "incident_id", "service_type", "priority_code", "priority_description", "quarter", "year",
    "call_type", "city_code", "city_name",
]
GEO_COLUMNS = ["census_block_group", "longitude", "latitude"]
QUALITY_COLUMNS = CORE_COLUMNS + GEO_COLUMNS

CANONICAL_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("incident_id", "service_type", "priority_code", "priority_description", "quarter")]
    + [T.StructField("year", T.ShortType())]
    + [T.StructField(c, T.StringType()) for c in ("call_type", "city_code", "city_name", "census_block_group")]
    + [T.StructField("longitude", T.DoubleType()), T.StructField("latitude", T.DoubleType())]
)

# Storage type per raw column.
STORAGE_TYPES = {
    "call_id_hash": "string", "service": "string", "priority": "string", "priority_desc": "string",
    "call_quarter": "tinyint", "call_year": "smallint", "description_short": "string",
    "city_code": "string", "city_name": "string", "geoid": "string",
    "census_block_group_center__x": "float", "census_block_group_center__y": "float",
    "response_time_sec": "float",
}

# Older spellings that may carry a canonical column's values, in order of preference.
COLUMN_ALIASES = {
    "priority_code": ["priority", "PRIORITY"],
    "priority_description": ["priority_desc", "PRIORITY_DESC"],
    "quarter": ["CALL_QUARTER", "call_quarter"],
    "year": ["CALL_YEAR", "call_year"],
    "call_type": ["description_short", "DESCRIPTION_SHORT"],
    "service_type": ["SERVICE", "service"],
    "longitude": ["census_block_group_center__x"],
    "latitude": ["census_block_group_center__y"],
    "city_code": ["CITY_CODE"],
    "city_name": ["CITY_NAME"],
}


def _family(t: T.DataType) -> str:
    if isinstance(t, T.IntegralType):
        return "integer"
    if isinstance(t, T.FractionalType):
        return "fraction"
    return t.typeName()


def schema_conformance(df: DataFrame, contract: T.StructType = CANONICAL_SCHEMA) -> dict:
    """Missing, extra and wrongly typed columns (types are compared by family); reads no data."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in contract.fields}
    wrong = [
        {"column": c, "expected": want[c].simpleString(), "actual": have[c].simpleString()}
        for c in want
        if c in have and _family(want[c]) != _family(have[c])
    ]
    missing = sorted(set(want) - set(have))
    return {
        "missing_columns": missing,
        "extra_columns": sorted(set(have) - set(want)),
        "dtype_mismatches": wrong,
        "is_valid": not missing and not wrong,
    }


def require_columns(df: DataFrame, columns: list[str], label: str) -> None:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"{label}: missing columns {absent}")
