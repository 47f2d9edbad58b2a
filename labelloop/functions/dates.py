"""Date handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values ----------------------------------------------------------
# Tried in order after Spark's own ISO-8601 parsing (which already accepts naive
# and offset timestamps mixed in one column).  Where day and month could stand
# either way round, MONTH_FIRST reads 03/04 as 4 March and still takes 13/04,
# which has one reading only, as 13 April; DAY_FIRST is the other way round.
_NUMERIC = ("{a}/{b}/yyyy", "{a}/{b}/yyyy H:mm[:ss]", "{a}-{b}-yyyy", "{a}.{b}.yyyy", "{a}/{b}/yy")
_ISO_LIKE = ("yyyy-M-d", "yyyy/M/d", "yyyy-MM-dd HH:mm:ss", "yyyy/M/d H:mm[:ss]", "yyyyMMdd")
_TEXTUAL = tuple(t.format(m=m) for m in ("MMM", "MMMM") for t in (
    "{m} d, yyyy", "{m} d yyyy", "d {m} yyyy", "d {m}, yyyy", "d-{m}-yyyy", "{m} d, yyyy H:mm[:ss]", "d {m} yyyy H:mm[:ss]"))
_WEEKDAY = r"(?i)^(mon|tues?|wed(nes)?|thu(rs)?|fri|sat(ur)?|sun)(day)?\.?,?\s+"


def _formats(first: str, second: str) -> tuple[str, ...]:
    return (*_ISO_LIKE, *(t.format(a=first, b=second) for t in _NUMERIC), *(t.format(a=second, b=first) for t in _NUMERIC))


MONTH_FIRST, DAY_FIRST = _formats("M", "d"), _formats("d", "M")
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c, formats: Sequence[str] = MONTH_FIRST) -> Column:
    """First successful parse wins; unparsable → NULL (never raises).

    Ambiguous numeric dates are month-first; pass ``DAY_FIRST`` for the other order."""
    s = F.trim(_c(c).cast("string"))
    words = F.regexp_replace(s, _WEEKDAY, "")
    named = F.coalesce(*[F.try_to_timestamp(words, F.lit(f)) for f in _TEXTUAL])
    plain = F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in formats])
    return F.coalesce(F.try_to_timestamp(s), F.when(s.rlike("[A-Za-z]{3}"), named).otherwise(plain))


def parse_date(c, formats: Sequence[str] = MONTH_FIRST) -> Column:
    """Date part of :func:`parse_timestamp` (timestamps are UTC in this package)."""
    col = _c(c)
    return F.to_date(parse_timestamp(col, formats))


def add_calendar_features(df: DataFrame, date_col: str = "Date", drop: bool = True,
                          doy_col: str = "Dayofyear", month_col: str = "Month") -> DataFrame:
    """Day-of-year and month; rows whose date fails to parse are dropped."""
    from pyspark.sql import types as T
    dtype = df.schema[date_col].dataType
    as_date = F.to_date(F.col(date_col)) if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)) \
        else parse_date(date_col)          # typed dates need no text parsing
    parsed = df.withColumn("__d", as_date).filter(F.col("__d").isNotNull())
    out = parsed.withColumns({doy_col: F.dayofyear("__d"), month_col: F.month("__d")})
    out = out.drop("__d")
    return out.drop(date_col) if drop else out


def target_from_feature(feature_date) -> Column:
    """Target date = feature date + 1 day."""
    return F.date_add(_c(feature_date), 1)


def backfill_feature_date(feature_date, target_date) -> Column:
    """Missing feature date inferred as target date − 1 day."""
    return F.coalesce(_c(feature_date), F.date_sub(_c(target_date), 1))


def month_key(d) -> Column:
    """yyyyMM bucket key (partition column of the observation landing table)."""
    return F.date_format(_c(d), "yyyyMM")
