"""Declared schema of the incident data and the fixed values the label rules use.

Raw extracts carry human-readable column names with spaces and punctuation; inside
the engine every column has a snake_case name. The mapping is kept here so the
source layer renames once and nothing downstream needs back-ticks.
"""
from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference's for identical results)
# ---------------------------------------------------------------------------

# Raw column name -> internal name. Current-era names.
RAW_TO_INTERNAL = {
    "Report ID": "report_id",
    "Report Version": "report_version",
    "Same Incident ID": "same_incident_id",
    "Same Vehicle ID": "same_vehicle_id",
    "Highest Injury Severity Alleged": "injury_text",
    "Any Air Bags Deployed?": "airbag_text",
    "Was Any Vehicle Towed?": "towed_text",
    "Were All Passengers Belted?": "belted_text",
    "Automation System Engaged?": "system_engaged",
    "Roadway Type": "roadway_type",
    "Roadway-Wet Surface Condition": "roadway_wet",
    "Roadway-Work Zone": "roadway_work_zone",
    "Roadway-Traffic Incident": "roadway_incident",
    "Weather - Clear": "weather_clear",
    "Weather - Rain": "weather_rain",
    "Weather - Snow": "weather_snow",
    "Weather - Fog/Smoke/Haze": "weather_fog",
    "Weather - Severe Wind": "weather_severe_wind",
    "Weather - Cloudy": "weather_cloudy",
    "Weather - Unk - See Narrative": "weather_unknown",
    "Crash With": "crash_with",
    "SV Pre-Crash Movement": "sv_movement",
    "CP Pre-Crash Movement": "cp_movement",
    "SV Precrash Speed (MPH)": "sv_speed_mph",
    "Report Month": "report_month",
    "VIN Decoded": "vin_decoded",
    "VIN": "vin",
    "Serial Number": "serial_number",
    "Address": "address",
    "Investigating Officer Name": "officer_name",
    "Investigating Officer Email": "officer_email",
    "Investigating Officer Phone": "officer_phone",
    "Narrative": "narrative",
}

# Archived-era column names that must be renamed to the current-era names.
ARCHIVED_RENAME = {
    "SV Any Air Bags Deployed?": "Any Air Bags Deployed?",
    "SV Was Vehicle Towed?": "Was Any Vehicle Towed?",
    "SV Were All Passengers Belted?": "Were All Passengers Belted?",
    "Weather - Fog/Smoke": "Weather - Fog/Smoke/Haze",
    "Weather - Unknown": "Weather - Unk - See Narrative",
    "VIN - Unknown": "VIN Decoded",
}

# Text tokens a CSV reader treats as missing (pandas read_csv defaults).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# yes_flag vocabulary (compared after trim + lower).
YES_TOKENS = ["y", "yes", "true", "1"]
NO_TOKENS = ["n", "no", "false", "0", "not applicable"]
YES_PHRASE = "yes subject vehicle"
NO_PHRASE = "no subject vehicle"

# Injury text (trimmed, lower-cased) -> ordered rank 0..4.
INJURY_RANK = {
    "no injuries reported": 0,
    "no apparent injury": 0,
    "minor": 1,
    "moderate": 2,
    "serious": 3,
    "fatality": 4,
    "no injured reported": 0,
    "property damage. no injured reported": 0,
    "minor w/o hospitalization": 1,
    "minor w/ hospitalization": 1,
    "moderate w/o hospitalization": 2,
    "moderate w/ hospitalization": 2,
    "serious w/o hospitalization": 3,
    "serious w/ hospitalization": 3,
}
INJURY_FALLBACK_WORD = "fatality"
INJURY_FALLBACK_RANK = 4
INJURY_SEVERE_MIN_RANK = 2

SINGLE_PREFIX = "SINGLE_"
UNKNOWN_CATEGORY = "Unknown"
MISSING_SUFFIX = "__is_missing"

# Columns never given a missingness indicator nor imputed (internal names).
SKIP_INDICATOR = [
    "incident_key", "report_id", "report_version", "same_incident_id",
    "same_vehicle_id", "narrative", "vin", "serial_number", "address",
    "officer_name", "officer_email", "officer_phone",
    "severe", "severity_known", "injury_flag", "airbag_flag", "towed_flag",
    "injury_rank",
]

# Context features used by the models (internal names, reference order).
CONTEXT_FEATURES = [
    "system_engaged",
    "automation_level",
    "roadway_type",
    "roadway_wet",
    "roadway_work_zone",
    "roadway_incident",
    "weather_clear",
    "weather_rain",
    "weather_snow",
    "weather_fog",
    "weather_severe_wind",
    "weather_cloudy",
    "crash_with",
    "sv_movement",
    "cp_movement",
    "sv_speed_mph",
    "report_month",
]
TABULAR_FEATURES = [c for c in CONTEXT_FEATURES if c != "automation_level"]

# Columns profiled per cluster / per miss list.
PROFILE_COLS = ["roadway_type", "crash_with", "sv_movement", "cp_movement"]

LEVELS = ["ADS", "L2"]
ERAS = ["current", "archived"]

# ---------------------------------------------------------------------------
# Declared types of the report schema (replaces whole-column type inference)
# ---------------------------------------------------------------------------

#: Fixed value: what stripping a text removes at its ends.
WHITESPACE = " \t\n\x0b\x0c\r"

NUMERIC_RAW = {"report_version": T.DoubleType(), "sv_speed_mph": T.DoubleType(),
               "report_month": T.IntegerType()}


def report_schema() -> T.StructType:
    """Declared types for the internal report columns (strings unless numeric)."""
    fields = []
    for internal in RAW_TO_INTERNAL.values():
        fields.append(T.StructField(internal, NUMERIC_RAW.get(internal, T.StringType()), True))
    fields.append(T.StructField("automation_level", T.StringType(), False))
    fields.append(T.StructField("era", T.StringType(), False))
    return T.StructType(fields)


NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC_TYPES)


def numeric_columns(schema: T.StructType, cols=None) -> list[str]:
    names = cols if cols is not None else schema.fieldNames()
    types = {f.name: f.dataType for f in schema.fields}
    return [c for c in names if is_numeric(types[c])]
