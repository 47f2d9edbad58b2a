"""Column-level cleaning rules.

Every function returns a ``Column`` built from native Spark expressions, so the
rules stay inside whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's semantics) -------------------
# Strings the reference's CSV reader treats as missing (the pandas defaults).
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
             "nan", "null")
# The 16 measured columns coerced to numbers, in the reference's order.
NUMERIC_COLUMNS = ("MinTemp", "MaxTemp", "Rainfall", "Evaporation", "Sunshine",
                   "WindGustSpeed", "WindSpeed9am", "WindSpeed3pm", "Humidity9am",
                   "Humidity3pm", "Pressure9am", "Pressure3pm", "Cloud9am", "Cloud3pm",
                   "Temp9am", "Temp3pm")
# Outlier ceilings: values strictly above become missing.
OUTLIER_CEILINGS = {"WindSpeed9am": 100.0, "Evaporation": 140.0, "Rainfall": 350.0}
# Label spellings that count as the positive class (after trim + lower).
POSITIVE_LABELS = ("yes", "1", "true")
# Decision threshold on the positive-class probability.
DEFAULT_THRESHOLD = 0.5
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def na_to_null(c) -> Column:
    """String column with the reader's missing-value tokens turned into NULL."""
    col = _c(c)
    return F.when(col.isin(*NA_TOKENS), F.lit(None).cast("string")).otherwise(col)


def safe_double(c) -> Column:
    """Strip, parse as double; blank, unparsable and NaN all become NULL."""
    col = _c(c).cast("string")
    value = F.trim(col).try_cast("double")
    return F.nanvl(value, F.lit(None).cast("double"))


def coerce_numeric(df: DataFrame, columns: Iterable[str] = NUMERIC_COLUMNS) -> DataFrame:
    """B2: tolerant numeric coercion of the named columns that are present."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    return df.withColumns({c: safe_double(c) for c in present})


def null_outliers(df: DataFrame, ceilings: Mapping[str, float] = OUTLIER_CEILINGS) -> DataFrame:
    """Values strictly above the ceiling become NULL (ceiling itself is kept)."""
    present = {c: t for c, t in ceilings.items() if c in df.columns}
    return df.withColumns({
        c: F.when(F.col(c) > F.lit(float(t)), F.lit(None).cast("double")).otherwise(F.col(c))
        for c, t in present.items()
    }) if present else df


def label_text(c) -> Column:
    """G1: a label as it is compared, without case and the blanks around it."""
    return F.lower(F.trim(_c(c).cast("string")))


def binary_label(c, positives: Iterable[str] = POSITIVE_LABELS) -> Column:
    """Trim + lower in the positive set → 1, any other text → 0, NULL stays NULL."""
    norm = label_text(c)
    return F.when(norm.isNull(), F.lit(None).cast("int")) \
        .otherwise(norm.isin(*positives).cast("int"))


def decide(prob, threshold: float = DEFAULT_THRESHOLD) -> Column:
    """Probability → 0/1 class with ``p >= threshold``."""
    return (_c(prob) >= F.lit(float(threshold))).cast("int")


def rain_today(rainfall) -> Column:
    """B13: 'Yes' when the measurement is > 0, otherwise (incl. missing) 'No'."""
    return F.when(_c(rainfall) > 0, F.lit("Yes")).otherwise(F.lit("No"))


def label_from_measure(measure) -> Column:
    """> 0 → 1, present → 0, missing → NULL."""
    m = _c(measure)
    return F.when(m.isNull(), F.lit(None).cast("int")).when(m > 0, F.lit(1)).otherwise(F.lit(0))


def cyclic(c, period: float, fn: str = "sin") -> Column:
    """Sin or cos of 2πx/period."""
    angle = _c(c).cast("double") / F.lit(float(period)) * F.lit(2.0 * math.pi)
    return F.sin(angle) if fn == "sin" else F.cos(angle)
