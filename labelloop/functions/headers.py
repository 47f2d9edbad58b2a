"""Header normalisation and alias pick (B11) for observation files.

Headers of one file become a ``map<normalised header, position>``; a target
column is the value at the first candidate alias present, so picking runs as
``coalesce(try_element_at(map, alias1), try_element_at(map, alias2), …)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's semantics) -------------------
# Normalisation: lower-case, the two degree-sign spellings become "c", then
# space, "(", ")" and "/" are removed.
DEGREE_SPELLINGS = ("â°", "°")
REMOVED_CHARS = " ()/"

# Target column → header aliases tried in order (monthly observation files).
FEATURE_ALIASES = {
    "MinTemp": ("Minimum temperature (°C)", "Minimum temperature (Ã‚Â°C)"),
    "MaxTemp": ("Maximum temperature (°C)", "Maximum temperature (Ã‚Â°C)"),
    "Rainfall": ("Rainfall (mm)",),
    "Evaporation": ("Evaporation (mm)",),
    "Sunshine": ("Sunshine (hours)",),
    "WindGustDir": ("Direction of maximum wind gust",),
    "WindGustSpeed": ("Speed of maximum wind gust (km/h)",),
    "WindDir9am": ("9am wind direction",),
    "WindDir3pm": ("3pm wind direction",),
    "WindSpeed9am": ("9am wind speed (km/h)",),
    "WindSpeed3pm": ("3pm wind speed (km/h)",),
    "Humidity9am": ("9am relative humidity (%)",),
    "Humidity3pm": ("3pm relative humidity (%)",),
    "Pressure9am": ("9am MSL pressure (hPa)",),
    "Pressure3pm": ("3pm MSL pressure (hPa)",),
    "Cloud9am": ("9am cloud amount (oktas)",),
    "Cloud3pm": ("3pm cloud amount (oktas)",),
    "Temp9am": ("9am Temperature (°C)", "9am Temperature (Ã‚Â°C)"),
    "Temp3pm": ("3pm Temperature (°C)", "3pm Temperature (Ã‚Â°C)"),
}
DATE_ALIASES = ("Date",)
# ---------------------------------------------------------------------------


def normalise_header(c) -> Column:
    """B11 as a column expression (also usable on a column of header strings)."""
    col = F.lower(F.col(c) if isinstance(c, str) else c)
    for spelling in DEGREE_SPELLINGS:
        col = F.replace(col, F.lit(spelling), F.lit("c"))
    for ch in REMOVED_CHARS:
        col = F.replace(col, F.lit(ch), F.lit(""))
    return col


def normalise_text(s: str) -> str:
    """Same rule for Python strings (aliases are literals known at plan time)."""
    s = s.lower()
    for spelling in DEGREE_SPELLINGS:
        s = s.replace(spelling, "c")
    for ch in REMOVED_CHARS:
        s = s.replace(ch, "")
    return s


def pick(header_map: Column, aliases) -> Column:
    """First alias present in ``header_map`` (normalised header → value); else NULL."""
    return F.coalesce(*[F.try_element_at(header_map, F.lit(normalise_text(a))) for a in aliases])
