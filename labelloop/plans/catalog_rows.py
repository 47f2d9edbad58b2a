"""Catalog part 1: cleaning, joins, dedupe, set and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloop.functions import dates as D
from labelloop.functions import values as V
from labelloop.functions.headers import normalise_header, pick
from labelloop.operators import cleaning as C
from labelloop.operators import dedup as E
from labelloop.operators import joins as J
from labelloop.operators.trials import best_trial, patience_stop
from labelloop.plans import fixtures as fx
from labelloop.plans.catalog import r6, register
from labelloop.plans.fixtures import HISTORY_HORIZON, with_fixtures as W
from labelloop.session import scratch_path
from labelloop.sources.keyed import KeyedTable
from labelloop.sources.sinks import read_document
from labelloop.sources.stations import lookup_dimension

H = HISTORY_HORIZON
SCORED_COLS = ("event_id, logged_at, feature_date, target_date, location, ROUND(rain_probability, 6) AS "
               "rain_probability, predicted_rain, ROUND(observed_rainfall_mm, 6) AS observed_rainfall_mm, "
               "truth_available, y_true")


def _scored_out(df: DataFrame) -> DataFrame:
    return df.select("event_id", "logged_at", "feature_date", "target_date", "location",
                     r6("rain_probability").alias("rain_probability"), "predicted_rain",
                     r6("observed_rainfall_mm").alias("observed_rainfall_mm"),
                     "truth_available", "y_true")


# ------------------------------------------------------------------ A10
@register("a10_station_lookup", """
SELECT c.c_custkey, c.c_nationkey AS station_key, d.n_name AS station_name, d.n_name IS NOT NULL AS is_known
FROM customer c LEFT JOIN (SELECT n_nationkey, n_name FROM nation WHERE n_nationkey > 2) d
  ON c.c_nationkey = d.n_nationkey""")
def a10_station_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = fx.table(spark, sf_dir, "nation").filter(F.col("n_nationkey") > 2) \
        .select(F.col("n_nationkey").alias("station_key"), F.col("n_name").alias("station_name"))
    cust = fx.table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("station_key"))
    return lookup_dimension(cust, dim, "station_key", "station_name").select(
        "c_custkey", "station_key", "station_name", "is_known")


# ------------------------------------------------------------------ B
@register("b1_drop_unlabelled", W("SELECT * FROM obs WHERE rain_tomorrow IS NOT NULL"))
def b1(spark, sf_dir):
    return C.drop_unlabelled(fx.obs(spark, sf_dir), "rain_tomorrow")


@register("b2_numeric_coercion", W("""
SELECT event_id, ROUND(TRY_CAST(TRIM(rainfall_txt) AS DOUBLE), 6) AS Rainfall,
       ROUND(wind_speed9am, 6) AS WindSpeed9am, wind_dir FROM obs"""))
def b2(spark, sf_dir):
    o = fx.obs(spark, sf_dir).select("event_id", F.col("rainfall_txt").alias("Rainfall"),
                                     F.col("wind_speed9am").alias("WindSpeed9am"), "wind_dir")
    out = V.coerce_numeric(o)
    return out.select("event_id", r6("Rainfall").alias("Rainfall"),
                      r6("WindSpeed9am").alias("WindSpeed9am"), "wind_dir")


@register("b3_outlier_null", W("""
SELECT event_id,
  ROUND(CASE WHEN TRY_CAST(rainfall_txt AS DOUBLE) > 350 THEN NULL ELSE TRY_CAST(rainfall_txt AS DOUBLE) END, 6) AS Rainfall,
  ROUND(CASE WHEN wind_speed9am > 100 THEN NULL ELSE wind_speed9am END, 6) AS WindSpeed9am FROM obs"""))
def b3(spark, sf_dir):
    o = fx.obs(spark, sf_dir).select("event_id", F.col("rainfall_txt").alias("Rainfall"),
                                     F.col("wind_speed9am").alias("WindSpeed9am"))
    out = V.null_outliers(V.coerce_numeric(o))
    return out.select("event_id", r6("Rainfall").alias("Rainfall"), r6("WindSpeed9am").alias("WindSpeed9am"))


# Texts with one reading and with two: the latter are month-first.
_B4_TEXT = """CASE event_id % 7 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(ts, '%d/%m/%Y')
  WHEN 2 THEN strftime(ts, '%Y-%m-%d') WHEN 3 THEN strftime(ts, '%m/%d/%Y') WHEN 4 THEN strftime(ts, '%B %d, %Y')
  WHEN 5 THEN strftime(ts, '%d %b %Y') ELSE 'not a date' END"""
_B4_DATE = "COALESCE(TRY_CAST(raw_text AS TIMESTAMP), " + ", ".join(
    f"TRY_STRPTIME(raw_text, '{f}')" for f in ("%m/%d/%Y", "%d/%m/%Y", "%B %d, %Y", "%d %b %Y")) + ")"


@register("b4_parse_dates", W(f"""
SELECT event_id, raw_text, CAST({_B4_DATE} AS DATE) AS parsed_date
FROM (SELECT event_id, {_B4_TEXT} AS raw_text FROM events) t WHERE {_B4_DATE} IS NOT NULL"""))
def b4(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events")
    raw = F.lit("not a date")
    for k, form in enumerate(("yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy", "yyyy-MM-dd", "MM/dd/yyyy", "MMMM dd, yyyy", "dd MMM yyyy")):
        raw = F.when(F.col("event_id") % 7 == k, F.date_format("ts", form)).otherwise(raw)
    t = e.select("event_id", raw.alias("raw_text")).withColumn("parsed_date", D.parse_date("raw_text"))
    return t.dropna(subset=["parsed_date"])


@register("b5_calendar_features", W("""
SELECT event_id, CAST(dayofyear(obs_date) AS INTEGER) AS Dayofyear, CAST(month(obs_date) AS INTEGER) AS Month
FROM obs"""))
def b5(spark, sf_dir):
    o = fx.obs(spark, sf_dir).select("event_id", F.col("obs_date").cast("string").alias("Date"))
    return D.add_calendar_features(o, "Date")


@register("b6_label_binarise", W("""
SELECT event_id, CASE WHEN lower(trim(rain_tomorrow)) IN ('yes', '1', 'true') THEN 1 ELSE 0 END AS label
FROM obs WHERE rain_tomorrow IS NOT NULL"""))
def b6(spark, sf_dir):
    o = C.drop_unlabelled(fx.obs(spark, sf_dir), "rain_tomorrow")
    return o.select("event_id", V.binary_label("rain_tomorrow").alias("label"))


def _b7_sql() -> str:
    na = ", ".join("'" + t.replace("'", "''") + "'" for t in V.NA_TOKENS)

    def text(c):
        v = f"CASE WHEN {c} IN ({na}) THEN NULL ELSE {c} END"
        return (f"SELECT '{c}' AS column_name, CASE WHEN COUNT({v}) = COUNT(TRY_CAST(TRIM({v}) AS DOUBLE)) "
                f"THEN 'numeric' ELSE 'categorical' END AS role FROM obs")
    typed = {"event_id": "numeric", "ts": "temporal", "obs_date": "temporal", "wind_speed9am": "numeric"}
    parts = [f"SELECT '{c}' AS column_name, '{r}' AS role" for c, r in typed.items()]
    parts += [text(c) for c in ("location", "rainfall_txt", "wind_dir", "rain_tomorrow")]
    return W("\nUNION ALL\n".join(parts))


@register("b7_feature_roles", _b7_sql())
def b7(spark, sf_dir):
    """B7 over the observation rows: roles inferred from the values."""
    return C.feature_roles(fx.obs(spark, sf_dir)).select("column_name", "role")


_B8_TEXT = """CASE event_id % 6 WHEN 0 THEN '' WHEN 1 THEN ' ' || CAST(value AS STRING) || ' '
  WHEN 2 THEN 'nan' WHEN 3 THEN 'n/a?' WHEN 4 THEN '1e2' ELSE CAST(value AS STRING) END"""


@register("b8_safe_float", f"""
SELECT event_id, ROUND(CASE WHEN isnan(x) THEN NULL ELSE x END, 6) AS parsed
FROM (SELECT event_id, TRY_CAST(TRIM({_B8_TEXT}) AS DOUBLE) AS x FROM events) t""")
def b8(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events")
    k = F.col("event_id") % 6
    v = F.col("value").cast("string")
    txt = (F.when(k == 0, F.lit("")).when(k == 1, F.concat(F.lit(" "), v, F.lit(" ")))
           .when(k == 2, F.lit("nan")).when(k == 3, F.lit("n/a?")).when(k == 4, F.lit("1e2")).otherwise(v))
    return e.select("event_id", r6(V.safe_double(txt)).alias("parsed"))


@register("b9_decision_threshold", W("""
SELECT event_id, CASE WHEN rain_probability >= 0.5e0 THEN 1 ELSE 0 END AS predicted FROM pred_log"""))
def b9(spark, sf_dir):
    return fx.pred_log(spark, sf_dir).select("event_id", V.decide("rain_probability").alias("predicted"))


@register("b10_contract_fallback", W(f"""
SELECT CAST(COUNT(*) AS BIGINT) AS total_rows, CAST(0 AS BIGINT) AS added_rows
FROM obs WHERE obs_date <= DATE '{H}'"""))
def b10(spark, sf_dir):
    """The retrain builder's contract — a scored log lacking ``y_true``
    takes the fallback branch, so the output is the history alone."""
    from labelloop.plans.jobs import build_retrain_set
    hist = fx.obs(spark, sf_dir, until=H)
    broken = fx.scored(spark, sf_dir).drop("y_true")
    _, meta = build_retrain_set(hist, broken, fx.obs(spark, sf_dir))
    return meta.select("total_rows", "added_rows")


_B11_TEXT = """CASE p_partkey % 3 WHEN 0 THEN p_type || ' (°C)' WHEN 1 THEN p_name || ' (â°C)'
  ELSE p_brand || ' speed (km/h)' END"""


@register("b11_header_normalise", f"""
SELECT p_partkey, replace(replace(replace(replace(replace(replace(lower({_B11_TEXT}),
  'â°', 'c'), '°', 'c'), ' ', ''), '(', ''), ')', ''), '/', '') AS normalised FROM part""")
def b11(spark, sf_dir):
    p = fx.table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 3
    txt = (F.when(k == 0, F.concat("p_type", F.lit(" (°C)")))
           .when(k == 1, F.concat("p_name", F.lit(" (â°C)")))
           .otherwise(F.concat("p_brand", F.lit(" speed (km/h)"))))
    return p.select("p_partkey", normalise_header(txt).alias("normalised"))


_NULL_DOUBLES = ("MinTemp", "MaxTemp", "Evaporation", "Sunshine", "WindGustSpeed", "WindSpeed3pm",
                 "Humidity9am", "Humidity3pm", "Pressure9am", "Pressure3pm", "Cloud9am", "Cloud3pm",
                 "Temp9am", "Temp3pm")


def _b12_sql() -> str:
    nulls = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in _NULL_DOUBLES)
    return W(f"""
SELECT obs_date AS Date, location AS Location, ROUND(TRY_CAST(rainfall_txt AS DOUBLE), 6) AS Rainfall,
       CAST(NULL AS VARCHAR) AS WindGustDir, wind_dir AS WindDir9am, CAST(NULL AS VARCHAR) AS WindDir3pm,
       ROUND(wind_speed9am, 6) AS WindSpeed9am,
       CASE WHEN TRY_CAST(rainfall_txt AS DOUBLE) > 0 THEN 'Yes' ELSE 'No' END AS RainToday,
       rain_tomorrow AS RainTomorrow, {nulls}
FROM obs""")


@register("b12_feature_row", _b12_sql())
def b12(spark, sf_dir):
    """B12 + B13 + B17: observation → 23-column feature row by alias."""
    out = fx.feature_rows(fx.obs(spark, sf_dir))
    return out.withColumns({"Rainfall": r6("Rainfall"), "WindSpeed9am": r6("WindSpeed9am")})


@register("b13_rain_today", W("""
SELECT location, obs_date, CASE WHEN rainfall > 0 THEN 'Yes' ELSE 'No' END AS RainToday FROM truth"""))
def b13(spark, sf_dir):
    return fx.truth(spark, sf_dir).select("location", "obs_date", V.rain_today("rainfall").alias("RainToday"))


@register("b14_date_arithmetic", W("""
SELECT event_id, COALESCE(feature_date, CAST(target_date - INTERVAL 1 DAY AS DATE)) AS feature_date,
       CAST(COALESCE(feature_date, CAST(target_date - INTERVAL 1 DAY AS DATE)) + INTERVAL 1 DAY AS DATE) AS next_day
FROM pred_log"""))
def b14(spark, sf_dir):
    p = fx.pred_log(spark, sf_dir)
    f = D.backfill_feature_date("feature_date", "target_date")
    return p.select("event_id", f.alias("feature_date"), D.target_from_feature(f).alias("next_day"))


@register("b15_key_completeness", W("""
SELECT event_id, feature_date, location FROM pred_log WHERE feature_date IS NOT NULL AND location IS NOT NULL"""))
def b15(spark, sf_dir):
    return C.complete_keys(fx.pred_log(spark, sf_dir), ["feature_date", "location"]) \
        .select("event_id", "feature_date", "location")


@register("b16_three_valued_label", W("""
SELECT location, obs_date, ROUND(rainfall, 6) AS rainfall, rainfall IS NOT NULL AS truth_available,
       CASE WHEN rainfall IS NULL THEN NULL WHEN rainfall > 0 THEN 1 ELSE 0 END AS y_true FROM truth"""))
def b16(spark, sf_dir):
    t = fx.truth(spark, sf_dir)
    return t.select("location", "obs_date", r6("rainfall").alias("rainfall"),
                    F.col("rainfall").isNotNull().alias("truth_available"),
                    V.label_from_measure("rainfall").alias("y_true"))


@register("b17_conform_schema", W("""
SELECT event_id, logged_at, feature_date, target_date, location, ROUND(rain_probability, 6) AS rain_probability,
       predicted_rain, CAST(NULL AS DOUBLE) AS observed_rainfall_mm, CAST(NULL AS BOOLEAN) AS truth_available,
       CAST(NULL AS INTEGER) AS y_true FROM pred_log"""))
def b17(spark, sf_dir):
    target = T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("logged_at", T.TimestampNTZType()),
        T.StructField("feature_date", T.DateType()), T.StructField("target_date", T.DateType()),
        T.StructField("location", T.StringType()), T.StructField("rain_probability", T.DoubleType()),
        T.StructField("predicted_rain", T.IntegerType()),
        T.StructField("observed_rainfall_mm", T.DoubleType()),
        T.StructField("truth_available", T.BooleanType()), T.StructField("y_true", T.IntegerType())])
    out = C.conform(fx.pred_log(spark, sf_dir), target)
    return out.withColumn("rain_probability", r6("rain_probability"))


@register("b18_month_key", W("""
SELECT strftime(obs_date, '%Y%m') AS month_key, CAST(COUNT(*) AS BIGINT) AS n FROM obs GROUP BY 1"""))
def b18(spark, sf_dir):
    o = fx.obs(spark, sf_dir)
    return o.groupBy(D.month_key("obs_date").alias("month_key")).agg(F.count(F.lit(1)).alias("n"))


_PAYLOAD_SCHEMA = T.StructType([T.StructField("Date", T.DateType()), T.StructField("Location", T.StringType()),
                                T.StructField("WindSpeed9am", T.DoubleType()),
                                T.StructField("WindDir9am", T.StringType())])


@register("b19_payload_parse", W("""
SELECT obs_date AS Date, location AS Location, ROUND(wind_speed9am, 6) AS WindSpeed9am, wind_dir AS WindDir9am
FROM obs WHERE event_id % 9 <> 0"""))
def b19(spark, sf_dir):
    o = fx.obs(spark, sf_dir)
    loc = F.when(F.col("event_id") % 9 == 0, F.lit("null")).otherwise(
        F.concat(F.lit('"'), F.col("location"), F.lit('"')))
    wd = F.when(F.col("wind_dir").isNull(), F.lit("null")).otherwise(
        F.concat(F.lit('"'), F.col("wind_dir"), F.lit('"')))
    text = F.concat(F.lit('{"Date": "'), F.col("obs_date").cast("string"), F.lit('", "Location": '), loc,
                    F.lit(', "WindSpeed9am": '), F.col("wind_speed9am").cast("string"),
                    F.lit(', "WindDir9am": '), wd, F.lit("}"))
    accepted, _ = C.parse_payload(o.select(text.alias("payload")), "payload", _PAYLOAD_SCHEMA,
                                  ["Date", "Location"])
    return accepted.withColumn("WindSpeed9am", r6("WindSpeed9am"))


@register("b20_labelled_rows", W(f"SELECT {SCORED_COLS} FROM scored WHERE truth_available AND y_true IS NOT NULL"))
def b20(spark, sf_dir):
    return _scored_out(C.labelled_rows(fx.scored(spark, sf_dir)))


# ------------------------------------------------------------------ C
@register("c1_delayed_truth_join", W(f"SELECT {SCORED_COLS} FROM scored"))
def c1(spark, sf_dir):
    from labelloop.plans.jobs import score_log
    return _scored_out(score_log(fx.pred_log(spark, sf_dir), fx.truth(spark, sf_dir)))


def _keyed(spark, rows: DataFrame, keys: list[str], date_col: str, name: str) -> KeyedTable:
    table = KeyedTable(spark, scratch_path(spark, name), rows.schema, keys, date_col)
    table.append(rows)
    return table


@register("c1_keyed_truth", W(f"SELECT {SCORED_COLS} FROM scored WHERE target_date > DATE '{H}'"))
def c1_keyed(spark, sf_dir):
    """C1 for new predictions against truth stored by month and key: only their months are read, and truth is not shuffled."""
    from labelloop.plans.jobs import score_log
    truth = _keyed(spark, fx.truth(spark, sf_dir), ["location", "obs_date"], "obs_date", "keyed-truth")
    new = fx.pred_log(spark, sf_dir).filter(F.col("target_date") > F.lit(H).cast("date"))
    return _scored_out(score_log(new, truth.for_dates(new, "target_date")))


@register("c2_keyed_history", W(f"""
SELECT s.event_id, s.feature_date, s.location FROM scored s
WHERE s.truth_available AND s.y_true IS NOT NULL AND s.feature_date > DATE '2024-01-15' AND NOT EXISTS (
  SELECT 1 FROM obs h WHERE h.obs_date <= DATE '{H}' AND h.obs_date = s.feature_date AND h.location = s.location)"""))
def c2_keyed(spark, sf_dir):
    """C2 against the stored history, for the rows of its last days and after."""
    s = C.labelled_rows(fx.scored(spark, sf_dir)).filter(F.col("feature_date") > F.lit("2024-01-15").cast("date"))
    known = fx.obs(spark, sf_dir, until=H).select("location", "obs_date").distinct()
    hist = _keyed(spark, known, ["location", "obs_date"], "obs_date", "keyed-history")
    return J.exclude_known(s, hist.for_dates(s, "feature_date"), ["feature_date", "location"], ["obs_date", "location"]) \
        .select("event_id", "feature_date", "location")


@register("c2_anti_known_keys", W(f"""
SELECT s.event_id, s.feature_date, s.location FROM scored s
WHERE s.truth_available AND s.y_true IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM obs h WHERE h.obs_date <= DATE '{H}' AND h.obs_date = s.feature_date AND h.location = s.location)"""))
def c2(spark, sf_dir):
    s = C.labelled_rows(fx.scored(spark, sf_dir))
    hist = fx.obs(spark, sf_dir, until=H)
    return J.exclude_known(s, hist, ["feature_date", "location"], ["obs_date", "location"]) \
        .select("event_id", "feature_date", "location")


@register("c3_feature_join", W("""
SELECT s.event_id, s.location, s.feature_date, s.y_true, ROUND(o.wind_speed9am, 6) AS wind_speed9am, o.wind_dir
FROM scored s JOIN (SELECT * FROM (SELECT o.*, ROW_NUMBER() OVER (PARTITION BY location, obs_date
    ORDER BY ts DESC, event_id DESC) AS rn FROM obs o) x WHERE rn = 1) o
  ON s.location = o.location AND s.feature_date = o.obs_date
WHERE s.truth_available AND s.y_true IS NOT NULL"""))
def c3(spark, sf_dir):
    s = C.labelled_rows(fx.scored(spark, sf_dir))
    day = E.last_per_key(fx.obs(spark, sf_dir), ["location", "obs_date"], ["ts", "event_id"]) \
        .select(F.col("location").alias("o_loc"), "obs_date", "wind_speed9am", "wind_dir")
    j = J.join_features(s, day, ["location", "feature_date"], ["o_loc", "obs_date"])
    return j.select("event_id", "location", "feature_date", "y_true",
                    r6("wind_speed9am").alias("wind_speed9am"), "wind_dir")


@register("c4_scalar_cutoff", W(f"""
SELECT event_id, feature_date FROM scored
WHERE truth_available AND y_true IS NOT NULL
  AND feature_date > (SELECT max(obs_date) FROM obs WHERE obs_date <= DATE '{H}')"""))
def c4(spark, sf_dir):
    s = C.labelled_rows(fx.scored(spark, sf_dir))
    hist = fx.obs(spark, sf_dir, until=H)
    return J.after_cutoff(s, "feature_date", hist.select(F.max("obs_date"))).select("event_id", "feature_date")


# ------------------------------------------------------------------ E
@register("e1_last_wins_dedupe", W("""
SELECT event_id, logged_at, feature_date, target_date, location, ROUND(rain_probability, 6) AS rain_probability,
       predicted_rain FROM (SELECT q.*, ROW_NUMBER() OVER (PARTITION BY location, target_date
       ORDER BY logged_at DESC, event_id DESC) AS rn FROM pred_log q) t WHERE rn = 1"""))
def e1(spark, sf_dir):
    out = E.last_per_key(fx.pred_log(spark, sf_dir), ["location", "target_date"], ["logged_at", "event_id"])
    return out.withColumn("rain_probability", r6("rain_probability"))


@register("e2_dedupe_feature_date", W("""
SELECT event_id, location, feature_date, y_true FROM (SELECT s.*, ROW_NUMBER() OVER (PARTITION BY location,
  feature_date ORDER BY logged_at DESC, event_id DESC) AS rn FROM scored s WHERE truth_available AND y_true IS NOT NULL) t
WHERE rn = 1"""))
def e2(spark, sf_dir):
    s = C.labelled_rows(fx.scored(spark, sf_dir))
    return E.last_per_key(s, ["location", "feature_date"], ["logged_at", "event_id"]) \
        .select("event_id", "location", "feature_date", "y_true")


@register("e3_last_n", W(f"SELECT {SCORED_COLS} FROM scored ORDER BY logged_at DESC, event_id DESC LIMIT 200"))
def e3(spark, sf_dir):
    return _scored_out(E.last_n(fx.scored(spark, sf_dir), 200, ["logged_at", "event_id"]))


@register("e4_latest_per_station", W("""
SELECT location, event_id, ts, obs_date, rainfall_txt FROM (SELECT o.*, ROW_NUMBER() OVER (PARTITION BY location
  ORDER BY obs_date DESC, ts DESC, event_id DESC) AS rn FROM obs o) t WHERE rn = 1"""))
def e4(spark, sf_dir):
    o = fx.obs(spark, sf_dir).select("location", "event_id", "ts", "obs_date", "rainfall_txt")
    return E.last_per_key(o, ["location"], ["obs_date", "ts", "event_id"])


@register("e5_latest_date_rows", W("""
SELECT event_id, obs_date, location FROM obs WHERE obs_date = (SELECT max(obs_date) FROM obs)"""))
def e5(spark, sf_dir):
    o = fx.obs(spark, sf_dir).select("event_id", "obs_date", "location")
    return E.rows_at_latest(o, "obs_date", mode="all")


@register("e5_latest_date_one", W("""
SELECT event_id, obs_date, location FROM obs ORDER BY obs_date DESC, location ASC, event_id ASC LIMIT 1"""))
def e5_one(spark, sf_dir):
    o = fx.obs(spark, sf_dir).select("event_id", "obs_date", "location")
    return E.rows_at_latest(o, "obs_date", tie_break=["location", "event_id"], mode="one")


@register("e6_rank_top5", W("""
SELECT location, ROUND(accuracy, 6) AS accuracy FROM (
  SELECT location, SUM(CASE WHEN y_true = predicted_rain THEN 1 ELSE 0 END) * 1e0 / COUNT(*) AS accuracy
  FROM scored WHERE truth_available AND y_true IS NOT NULL GROUP BY location) t
ORDER BY accuracy DESC, location ASC LIMIT 5"""))
def e6(spark, sf_dir):
    from labelloop.operators.metrics import evaluate
    s = C.labelled_rows(fx.scored(spark, sf_dir))
    m = evaluate(s, y="y_true", pred="predicted_rain", groups=["location"])
    ranked = E.top_k(m.select("location", r6("accuracy").alias("accuracy")), "accuracy", 5, ["location"])
    return ranked


@register("e7_patience_stop", W("""
SELECT w.study, ROUND(w.best, 6) AS best_value, w.stop AS stopped_at, COALESCE(w.stop, m.last_n) AS trials_run
FROM walk w JOIN (SELECT study, max(n) AS last_n FROM trials GROUP BY study) m
  ON w.study = m.study AND w.n = m.last_n""", recursive=True, walk="""
SELECT study, CAST(0 AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS best, 0 AS cnt, CAST(NULL AS BIGINT) AS stop
FROM (SELECT DISTINCT study FROM trials) s
UNION ALL
SELECT w.study, t.n,
  CASE WHEN w.stop IS NOT NULL OR t.value IS NULL THEN w.best
       WHEN w.best IS NULL OR t.value - w.best > 1e-4 THEN t.value ELSE w.best END,
  CASE WHEN w.stop IS NOT NULL OR t.value IS NULL THEN w.cnt
       WHEN w.best IS NULL OR t.value - w.best > 1e-4 THEN 0 ELSE w.cnt + 1 END,
  CASE WHEN w.stop IS NOT NULL THEN w.stop WHEN t.value IS NULL THEN NULL
       WHEN w.best IS NULL OR t.value - w.best > 1e-4 THEN NULL
       WHEN w.cnt + 1 >= 10 THEN t.n ELSE NULL END
FROM walk w JOIN trials t ON t.study = w.study AND t.n = w.n + 1"""))
def e7(spark, sf_dir):
    out = patience_stop(fx.trials(spark, sf_dir))
    return out.withColumn("best_value", r6("best_value"))


@register("e8_best_trial", W("""
SELECT study AS study_name, ROUND(value, 6) AS best_value, n AS best_trial FROM trials WHERE value IS NOT NULL
ORDER BY value DESC, study ASC, n ASC LIMIT 1"""))
def e8(spark, sf_dir):
    return best_trial(fx.trials(spark, sf_dir)).withColumn("best_value", r6("best_value"))


# ------------------------------------------------------------------ F
@register("f1_union_by_name", W(f"""
SELECT obs_date AS Date, location AS Location, ROUND(wind_speed9am, 6) AS WindSpeed9am, 'history' AS source
FROM obs WHERE obs_date <= DATE '{H}'
UNION ALL
SELECT s.feature_date AS Date, s.location AS Location, CAST(NULL AS DOUBLE) AS WindSpeed9am, 'added' AS source
FROM scored s WHERE s.truth_available AND s.y_true IS NOT NULL AND s.feature_date > DATE '{H}'"""))
def f1(spark, sf_dir):
    hist = fx.obs(spark, sf_dir, until=H).select(
        F.col("obs_date").alias("Date"), F.col("location").alias("Location"),
        r6("wind_speed9am").alias("WindSpeed9am"), F.lit("history").alias("source"))
    added = C.labelled_rows(fx.scored(spark, sf_dir)).filter(F.col("feature_date") > F.lit(H).cast("date")) \
        .select(F.lit("added").alias("source"), F.col("location").alias("Location"),
                F.col("feature_date").alias("Date"))
    return hist.unionByName(added, allowMissingColumns=True)


# ------------------------------------------------------------------ G
@register("g1_string_functions", W("""
SELECT event_id, lower(trim(rain_tomorrow)) AS label_norm, replace(wind_dir, 'i', '') AS no_i,
       split(location, 'S')[2] AS station_no, contains(COALESCE(wind_dir, ''), 'c') AS has_c,
       concat_ws('|', location, wind_dir) AS joined FROM obs"""))
def g1(spark, sf_dir):
    o = fx.obs(spark, sf_dir)
    return o.select("event_id", V.label_text("rain_tomorrow").alias("label_norm"),
                    F.replace("wind_dir", F.lit("i"), F.lit("")).alias("no_i"),
                    F.get(F.split("location", "S"), 1).alias("station_no"),
                    F.contains(F.coalesce("wind_dir", F.lit("")), F.lit("c")).alias("has_c"),
                    F.concat_ws("|", "location", "wind_dir").alias("joined"))


@register("g2_date_functions", W("""
SELECT event_id, CAST(ts AS DATE) AS day, CAST(dayofyear(ts) AS INTEGER) AS doy, CAST(month(ts) AS INTEGER) AS mon,
       strftime(ts, '%Y%m') AS ym, CAST(CAST(ts AS DATE) + INTERVAL 1 DAY AS DATE) AS next_day,
       CAST(CAST(ts AS DATE) - INTERVAL 1 DAY AS DATE) AS prev_day, strftime(ts, '%Y-%m-%d') AS iso FROM obs"""))
def g2(spark, sf_dir):
    o = fx.obs(spark, sf_dir)
    d = F.to_date("ts")
    return o.select("event_id", d.alias("day"), F.dayofyear("ts").alias("doy"), F.month("ts").alias("mon"),
                    D.month_key("ts").alias("ym"), F.date_add(d, 1).alias("next_day"),
                    F.date_sub(d, 1).alias("prev_day"), F.date_format(d, "yyyy-MM-dd").alias("iso"))


@register("g3_cyclic_math", W("""
SELECT event_id, ROUND(sin(dayofyear(obs_date) / 365e0 * 2 * pi()), 6) AS doy_sin,
       ROUND(cos(dayofyear(obs_date) / 365e0 * 2 * pi()), 6) AS doy_cos,
       ROUND(sin(month(obs_date) / 12e0 * 2 * pi()), 6) AS month_sin,
       ROUND(cos(month(obs_date) / 12e0 * 2 * pi()), 6) AS month_cos,
       COALESCE(isnan(TRY_CAST(rainfall_txt AS DOUBLE)), false) AS is_nan FROM obs"""))
def g3(spark, sf_dir):
    o = fx.obs(spark, sf_dir)
    return o.select("event_id", r6(V.cyclic(F.dayofyear("obs_date"), 365, "sin")).alias("doy_sin"),
                    r6(V.cyclic(F.dayofyear("obs_date"), 365, "cos")).alias("doy_cos"),
                    r6(V.cyclic(F.month("obs_date"), 12, "sin")).alias("month_sin"),
                    r6(V.cyclic(F.month("obs_date"), 12, "cos")).alias("month_cos"),
                    F.isnan(F.col("rainfall_txt").try_cast("double")).alias("is_nan"))


@register("g4_null_functions", W("""
SELECT event_id, feature_date IS NULL AS was_missing, feature_date IS NOT NULL AS present,
       COALESCE(feature_date, CAST(target_date - INTERVAL 1 DAY AS DATE)) AS filled FROM pred_log"""))
def g4(spark, sf_dir):
    p = fx.pred_log(spark, sf_dir)
    return p.select("event_id", F.isnull("feature_date").alias("was_missing"),
                    F.col("feature_date").isNotNull().alias("present"),
                    D.backfill_feature_date("feature_date", "target_date").alias("filled"))


@register("g5_map_lookup", """
SELECT p_partkey, p_brand AS brand, p_type AS type, CAST(NULL AS VARCHAR) AS colour FROM part""")
def g5(spark, sf_dir):
    p = fx.table(spark, sf_dir, "part")
    headers = F.transform(F.array(F.lit("Brand "), F.lit("TYPE")), normalise_header)
    m = F.map_from_arrays(headers, F.array("p_brand", "p_type"))
    return p.select("p_partkey", pick(m, ["maker", "Brand"]).alias("brand"), pick(m, ["Type"]).alias("type"), pick(m, ["Colour"]).alias("colour"))


_G6_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("location", T.StringType()),
                           T.StructField("target_date", T.DateType()), T.StructField("y_true", T.IntegerType()),
                           T.StructField("truth_available", T.BooleanType())])


@register("g6_json_round_trip", W("""
SELECT event_id, location, target_date, y_true, truth_available FROM scored"""))
def g6(spark, sf_dir):
    s = fx.scored(spark, sf_dir)
    path = scratch_path(spark, "json")
    s.select(*_G6_SCHEMA.fieldNames()).write.json(path)
    return read_document(spark, path, _G6_SCHEMA)
