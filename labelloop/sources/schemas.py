"""Schemas of the reference's data model (FIXTURES.md §1)."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: the 23 observation columns, in the reference's order -----
_DOUBLE = T.DoubleType()
_STRING = T.StringType()
OBSERVATION_COLUMNS = (
    ("Date", T.DateType()), ("Location", _STRING), ("MinTemp", _DOUBLE), ("MaxTemp", _DOUBLE),
    ("Rainfall", _DOUBLE), ("Evaporation", _DOUBLE), ("Sunshine", _DOUBLE), ("WindGustDir", _STRING),
    ("WindGustSpeed", _DOUBLE), ("WindDir9am", _STRING), ("WindDir3pm", _STRING),
    ("WindSpeed9am", _DOUBLE), ("WindSpeed3pm", _DOUBLE), ("Humidity9am", _DOUBLE),
    ("Humidity3pm", _DOUBLE), ("Pressure9am", _DOUBLE), ("Pressure3pm", _DOUBLE),
    ("Cloud9am", _DOUBLE), ("Cloud3pm", _DOUBLE), ("Temp9am", _DOUBLE), ("Temp3pm", _DOUBLE),
    ("RainToday", _STRING), ("RainTomorrow", _STRING),
)
# ---------------------------------------------------------------------------

TARGET_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in OBSERVATION_COLUMNS])
# The raw file as read: every column a string, parsed later with try_* casts.
RAW_SCHEMA = T.StructType([T.StructField(n, _STRING, True) for n, _ in OBSERVATION_COLUMNS])

PREDICTION_LOG_V2 = ("logged_at_utc", "feature_date", "target_date", "location", "use_latest",
                     "station_name", "rain_probability", "predicted_rain")
PREDICTION_LOG_V1 = ("logged_at_utc", "target_date", "location", "use_latest", "station_name",
                     "rain_probability", "predicted_rain")
