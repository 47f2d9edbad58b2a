"""The driver tables seen through the reference's data model (FIXTURES.md §2).

``obs``, ``pred_log`` and ``trials`` are plain projections of the driver
tables.  ``truth`` and ``scored`` are *operators* (latest observation per key,
last-wins dedupe, delayed-truth join), so they are built here from this
package's operators, while the oracle gets the SQL text of FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloop.functions.dates import backfill_feature_date, target_from_feature
from labelloop.functions.values import decide, safe_double
from labelloop.operators.dedup import last_per_key
from labelloop.operators.joins import attach_truth

# ---- fixed values (FIXTURES.md §2) -----------------------------------------
STATION_MODULUS = 49          # user_id % 49 → station code S0..S48
UNOBSERVED_STATIONS = ("S0", "S7")
HISTORY_HORIZON = "2024-01-20"  # obs_date <= horizon is history, later is new
ORDERS_PER_STUDY = 200         # consecutive order keys of one priority form a study (about 40 trials)
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _station(user_id) -> F.Column:
    return F.concat(F.lit("S"), (F.col(user_id) % STATION_MODULUS).cast("string"))


def _day_after(d: str) -> F.Column:
    return F.date_add(F.lit(d).cast("date"), 1).cast("timestamp_ntz")


def obs(spark: SparkSession, sf_dir: str, until: str | None = None) -> DataFrame:
    """Observation rows; ``until`` keeps days <= that date.  The bound is put on
    the raw ``ts`` (``ts < until + 1 day``, same rows as ``obs_date <= until``)
    so it reaches the parquet scan as a pushed filter."""
    e = table(spark, sf_dir, "events")
    if until is not None:
        e = e.filter(F.col("ts") < _day_after(until))
    return e.select(
        "event_id", "ts",
        F.to_date("ts").alias("obs_date"),
        _station("user_id").alias("location"),
        F.when(F.col("event_id") % 7 == 0, F.lit("NA"))
         .when(F.col("value") < 20, F.lit("0"))
         .otherwise(F.col("value").cast("string")).alias("rainfall_txt"),
        F.when(F.col("event_id") % 13 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("event_type")).alias("wind_dir"),
        (F.regexp_extract("props", "([0-9]+)", 1).cast("double") * F.lit(1.2)).alias("wind_speed9am"),
        F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("string"))
         .when(F.col("value") > 60, F.lit(" Yes "))
         .otherwise(F.lit("No")).alias("rain_tomorrow"),
    )


def pred_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    raw_p = F.col("value") / F.lit(150.0)
    return e.select(
        "event_id", F.col("ts").alias("logged_at"),
        F.when(F.col("event_id") % 5 == 0, F.lit(None).cast("date"))
         .otherwise(F.to_date("ts")).alias("feature_date"),
        target_from_feature(F.to_date("ts")).alias("target_date"),
        _station("user_id").alias("location"),
        F.least(raw_p, F.lit(1.0)).alias("rain_probability"),
        decide(raw_p).alias("predicted_rain"),
    )


def truth(spark: SparkSession, sf_dir: str, obs_df: DataFrame | None = None) -> DataFrame:
    """Last observation per (location, date): E4 over ``obs``, rainfall via B8."""
    o = obs_df if obs_df is not None else obs(spark, sf_dir)
    latest = last_per_key(o.select("location", "obs_date", "ts", "event_id", "rainfall_txt"),
                          keys=["location", "obs_date"], order_cols=["ts", "event_id"])
    return latest.filter(~F.col("location").isin(*UNOBSERVED_STATIONS)).select(
        "location", "obs_date", safe_double("rainfall_txt").alias("rainfall"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 dedupe of the log, B14 backfill, C1 + B16 truth join."""
    p = last_per_key(pred_log(spark, sf_dir), keys=["location", "target_date"],
                     order_cols=["logged_at", "event_id"])
    p = p.withColumn("feature_date", backfill_feature_date("feature_date", "target_date"))
    out = attach_truth(p, truth(spark, sf_dir))
    return out.select("event_id", "logged_at", "feature_date", "target_date", "location",
                      "rain_probability", "predicted_rain", "observed_rainfall_mm",
                      "truth_available", "y_true")


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a trial: the orders of one priority among ``ORDERS_PER_STUDY``
    consecutive keys are one study, numbered in key order, so studies stay
    small and their number grows with the table."""
    o = table(spark, sf_dir, "orders")
    part = F.floor(F.col("o_orderkey") / F.lit(float(ORDERS_PER_STUDY))).cast("bigint")
    t = o.select(F.concat(F.col("o_orderpriority"), F.lit("/"), part.cast("string")).alias("study"),
                 F.col("o_orderkey").alias("k"), (F.col("o_totalprice") / F.lit(600000.0)).alias("v"))
    n = F.row_number().over(Window.partitionBy("study").orderBy("k")).cast("bigint")
    return t.select("study", n.alias("n"), F.when(F.col("k") % 10 == 0, F.lit(None).cast("double"))
                    .otherwise(F.col("v")).alias("value"))


FEATURE_MAP = {"Date": "obs_date", "Location": "location", "Rainfall": "rainfall_txt",
               "WindDir9am": "wind_dir", "WindSpeed9am": "wind_speed9am", "RainTomorrow": "rain_tomorrow"}


def feature_rows(o: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """B12 + B2 + B13 + B17: observation rows → the 23-column feature row
    (plus the ``keep`` columns, e.g. a row id)."""
    from labelloop.functions.values import coerce_numeric, rain_today
    from labelloop.operators.cleaning import conform, select_by_alias
    from labelloop.sources.schemas import TARGET_SCHEMA
    picked = coerce_numeric(select_by_alias(o, {**FEATURE_MAP, **{k: k for k in keep}}))
    target = T.StructType(TARGET_SCHEMA.fields + [picked.schema[k] for k in keep])
    return conform(picked.withColumn("RainToday", rain_today("Rainfall")), target)


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training history: feature rows observed up to the horizon."""
    return feature_rows(obs(spark, sf_dir, until=HISTORY_HORIZON))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature row of every observed (location, date): the last observation wins."""
    o = last_per_key(obs(spark, sf_dir), ["location", "obs_date"], ["ts", "event_id"])
    return feature_rows(o)


# ---- oracle text: the FIXTURES.md views, inlined as CTEs -------------------
FIXTURE_SQL = {
    "obs": """
SELECT event_id, ts, CAST(ts AS DATE) AS obs_date,
       CONCAT('S', CAST(user_id % 49 AS STRING)) AS location,
       CASE WHEN event_id % 7 = 0 THEN 'NA' WHEN value < 20 THEN '0' ELSE CAST(value AS STRING) END AS rainfall_txt,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_type END AS wind_dir,
       CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) * 1.2e0 AS wind_speed9am,
       CASE WHEN event_id % 11 = 0 THEN NULL WHEN value > 60 THEN ' Yes ' ELSE 'No' END AS rain_tomorrow
FROM events""",
    "pred_log": """
SELECT event_id, ts AS logged_at,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS feature_date,
       CAST(CAST(ts AS DATE) + INTERVAL 1 DAY AS DATE) AS target_date,
       CONCAT('S', CAST(user_id % 49 AS STRING)) AS location,
       LEAST(value / 150e0, 1e0) AS rain_probability,
       CASE WHEN value / 150e0 >= 0.5e0 THEN 1 ELSE 0 END AS predicted_rain
FROM events""",
    "truth": """
SELECT location, obs_date, TRY_CAST(rainfall_txt AS DOUBLE) AS rainfall
FROM (SELECT o.*, ROW_NUMBER() OVER (PARTITION BY location, obs_date ORDER BY ts DESC, event_id DESC) AS rn FROM obs o) t
WHERE rn = 1 AND location NOT IN ('S0', 'S7')""",
    "scored": """
SELECT p.event_id, p.logged_at, COALESCE(p.feature_date, CAST(p.target_date - INTERVAL 1 DAY AS DATE)) AS feature_date,
       p.target_date, p.location, p.rain_probability, p.predicted_rain,
       t.rainfall AS observed_rainfall_mm, t.rainfall IS NOT NULL AS truth_available,
       CASE WHEN t.rainfall IS NULL THEN NULL WHEN t.rainfall > 0 THEN 1 ELSE 0 END AS y_true
FROM (SELECT q.*, ROW_NUMBER() OVER (PARTITION BY location, target_date ORDER BY logged_at DESC, event_id DESC) AS rn FROM pred_log q) p
LEFT JOIN truth t ON p.location = t.location AND p.target_date = t.obs_date
WHERE p.rn = 1""",
    "trials": """
SELECT study, ROW_NUMBER() OVER (PARTITION BY study ORDER BY k) AS n, CASE WHEN k % 10 = 0 THEN NULL ELSE v END AS value
FROM (SELECT CONCAT(o_orderpriority, '/', CAST(CAST(FLOOR(o_orderkey / 200e0) AS BIGINT) AS STRING)) AS study,
             o_orderkey AS k, o_totalprice / 600000e0 AS v FROM orders) t""",
}


def with_fixtures(body: str, recursive: bool = False, **ctes: str) -> str:
    """Oracle SQL: fixture views + query-specific CTEs, then ``body``."""
    parts = [f"{name} AS ({sql.strip()})" for name, sql in FIXTURE_SQL.items()]
    parts += [f"{name} AS ({sql.strip()})" for name, sql in ctes.items()]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(parts) + "\n" + body.strip()


# ---- oracle text of the retrain set
_NULL_D = ("MinTemp", "MaxTemp", "Evaporation", "Sunshine", "WindGustSpeed", "WindSpeed3pm", "Humidity9am",
           "Humidity3pm", "Pressure9am", "Pressure3pm", "Cloud9am", "Cloud3pm", "Temp9am", "Temp3pm")
_NULL_S = ("WindGustDir", "WindDir3pm")


def _feature_sql(src: str, label: str = "rain_tomorrow") -> str:
    nulls = ", ".join([f"CAST(NULL AS DOUBLE) AS {c}" for c in _NULL_D] +
                      [f"CAST(NULL AS VARCHAR) AS {c}" for c in _NULL_S])
    return (f"SELECT obs_date AS Date, location AS Location, ROUND(TRY_CAST(rainfall_txt AS DOUBLE), 6) AS Rainfall, "
            f"wind_dir AS WindDir9am, ROUND(wind_speed9am, 6) AS WindSpeed9am, "
            f"CASE WHEN TRY_CAST(rainfall_txt AS DOUBLE) > 0 THEN 'Yes' ELSE 'No' END AS RainToday, "
            f"{label} AS RainTomorrow, {nulls} FROM {src}")


_LASTOBS = ("SELECT * FROM (SELECT o.*, ROW_NUMBER() OVER (PARTITION BY location, obs_date ORDER BY ts DESC, "
            "event_id DESC) AS rn FROM obs o) t WHERE rn = 1")


def _newl(cut: str, snapshot: str = "TRUE") -> str:
    return (f"SELECT * FROM (SELECT s.*, ROW_NUMBER() OVER (PARTITION BY location, feature_date ORDER BY logged_at "
            f"DESC, event_id DESC) AS rn FROM scored s WHERE truth_available AND y_true IS NOT NULL AND location IS NOT "
            f"NULL AND feature_date IS NOT NULL AND feature_date > ({cut}) AND {snapshot}) t WHERE rn = 1")


_I4_CTES = dict(
    hist=_feature_sql(f"(SELECT * FROM obs WHERE obs_date <= DATE '{HISTORY_HORIZON}') h0"),
    newl=_newl("SELECT max(Date) FROM hist"),
    newk="SELECT * FROM newl n WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.Date = n.feature_date "
         "AND h.Location = n.location)",
    lastobs=_LASTOBS,
    added=_feature_sql("(SELECT o.*, CASE WHEN n.y_true = 1 THEN 'Yes' ELSE 'No' END AS lab FROM lastobs o "
                       "JOIN newk n ON o.location = n.location AND o.obs_date = n.feature_date) a", label="lab"),
)
