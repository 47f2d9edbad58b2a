"""Catalog part 3: sources and sinks.

Each query lands data derived from the driver tables in a fresh folder under
``spark.checkpoint.dir`` and reads it back through the reader under test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloop.functions.dates import parse_date
from labelloop.functions.values import NA_TOKENS, safe_double
from labelloop.plans import catalog_jobs, catalog_rows  # noqa: F401  (oracles reused below)
from labelloop.plans import fixtures as fx
from labelloop.plans.catalog import ORACLE, QUERIES, r6, register
from labelloop.plans.fixtures import with_fixtures as W
from labelloop.session import scratch_path
from labelloop.sources import delimited as DL
from labelloop.sources import sinks as S
from labelloop.sources.observation_files import DEFAULT_ALIASES, read_observation_files, write_observation_files
from labelloop.sources.schemas import PREDICTION_LOG_V2

_NA_SQL = ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)


@register("a1_delimited_scan", W(f"""
SELECT event_id, CAST(obs_date AS VARCHAR) AS obs_date, location,
       CASE WHEN rainfall_txt IN ({_NA_SQL}) THEN NULL ELSE rainfall_txt END AS rainfall_txt,
       wind_dir, rain_tomorrow FROM obs"""))
def a1(spark, sf_dir):
    path = scratch_path(spark, "a1-csv")
    o = fx.obs(spark, sf_dir).select("event_id", "obs_date", "location", "rainfall_txt", "wind_dir",
                                     "rain_tomorrow")
    (o.write.mode("overwrite").option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    back = DL.read_delimited(spark, path, columns=o.columns)
    return back.withColumn("event_id", F.col("event_id").cast("bigint"))


@register("a2_pruned_scan", "SELECT CAST(ts AS DATE) AS Date FROM events")
def a2(spark, sf_dir):
    return DL.scan_columns(fx.table(spark, sf_dir, "events"), ["ts"]).select(F.to_date("ts").alias("Date"))


_LOG_HEADER = ",".join(PREDICTION_LOG_V2)


def _log_line() -> F.Column:
    k = F.col("event_id") % 17
    ts = F.col("logged_at")
    naive = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    shifted = F.concat(F.date_format(ts + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))
    logged = F.when(F.col("event_id") % 2 == 0, naive).otherwise(shifted)
    fd = F.coalesce(F.col("feature_date").cast("string"), F.lit(""))
    station = F.concat(F.lit('"St '), F.col("event_id").cast("string"), F.lit(', Inc"'))
    common_tail = [F.col("location"), F.lit("False"), station, F.col("rain_probability").cast("string"),
                   F.col("predicted_rain").cast("string")]
    v2 = F.concat_ws(",", logged, fd, F.col("target_date").cast("string"), *common_tail)
    v1 = F.concat_ws(",", logged, F.col("target_date").cast("string"), *common_tail)
    short = F.concat_ws(",", logged, fd, F.col("target_date").cast("string"), *common_tail[:3])
    return (F.when(k == 0, short).when(k == 1, v1).when(k == 2, F.concat(v2, F.lit(",extra")))
            .otherwise(v2))


@register("a3_ragged_log_reader", W("""
SELECT event_id, strftime(logged_at, '%Y-%m-%d %H:%M:%S') AS logged_at,
       CASE WHEN event_id % 17 = 1 THEN NULL ELSE feature_date END AS feature_date, target_date, location,
       ROUND(rain_probability, 6) AS rain_probability, predicted_rain
FROM pred_log WHERE event_id % 17 <> 0"""))
def a3(spark, sf_dir):
    path = scratch_path(spark, "a3-log")
    p = fx.pred_log(spark, sf_dir)
    (p.select(_log_line().alias(_LOG_HEADER)).write.mode("overwrite").option("header", True)
     .option("sep", "\u0001").option("quote", "\u0000").option("escapeQuotes", False)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    typed = DL.type_log(DL.read_prediction_log(spark, path))
    return typed.select(F.regexp_extract("station_name", r"St (\d+)", 1).cast("bigint").alias("event_id"),
                        F.date_format("logged_at", "yyyy-MM-dd HH:mm:ss").alias("logged_at"),
                        "feature_date", "target_date", "location", r6("rain_probability").alias("rain_probability"),
                        "predicted_rain")


def _obs_files_fixture(spark, sf_dir, root: str) -> None:
    o = fx.obs(spark, sf_dir)
    shard = (F.col("event_id") % 3).cast("int")
    base = ["Date", "Id", "Rainfall (mm)", "9am wind speed (km/h)", "9am wind direction"]
    h0 = ",".join([""] + base + ["Minimum temperature (°C)", "Evaporation (mm)"])
    h1 = ",".join([""] + base + ["Minimum temperature (Ã‚Â°C)", "Evaporation (mm)"])
    h2 = ",".join([""] + base)
    pre = F.concat(F.lit("Daily Weather Observations for "), F.col("location"), F.lit("\n"),
                   F.lit("Prepared from the events table, month "), F.date_format("obs_date", "yyyyMM"), F.lit("\n"))
    header = F.concat(pre, F.when(shard == 0, F.lit(h0)).when(shard == 1, F.concat(F.lit("\n"), F.lit(h1)))
                      .otherwise(F.lit(h2)))
    cells = [F.lit(""), F.col("obs_date").cast("string"), F.col("event_id").cast("string"), F.col("rainfall_txt"),
             F.col("wind_speed9am").cast("string"), F.coalesce(F.col("wind_dir"), F.lit(""))]
    extra = [(F.col("event_id") % 40).cast("string"), (F.col("wind_speed9am") / F.lit(2.0)).cast("string")]
    line = F.when(shard == 2, F.concat_ws(",", *cells)).otherwise(F.concat_ws(",", *cells, *extra))
    staged = o.withColumn("__month", F.date_format("obs_date", "yyyyMM")).withColumn("__shard", shard)
    write_observation_files(staged, root, "location", "__month", "__shard", header, line, ["ts", "event_id"])


@register("a4_observation_files", W("""
SELECT location, obs_date AS Date, event_id AS Id, ROUND(TRY_CAST(rainfall_txt AS DOUBLE), 6) AS Rainfall,
       ROUND(wind_speed9am, 6) AS WindSpeed9am, wind_dir AS WindDir9am,
       CASE WHEN event_id % 3 = 2 THEN NULL ELSE CAST(event_id % 40 AS DOUBLE) END AS MinTemp,
       CASE WHEN event_id % 3 = 2 THEN NULL ELSE ROUND(wind_speed9am / 2e0, 6) END AS Evaporation FROM obs"""))
def a4(spark, sf_dir):
    root = scratch_path(spark, "a4-obs")
    _obs_files_fixture(spark, sf_dir, root)
    aliases = dict(DEFAULT_ALIASES, Id=("Id",))
    rows = read_observation_files(spark, root, aliases)
    return rows.select(F.col("location").cast("string").alias("location"), parse_date("Date").alias("Date"),
                       F.col("Id").cast("bigint").alias("Id"), r6(safe_double("Rainfall")).alias("Rainfall"),
                       r6(safe_double("WindSpeed9am")).alias("WindSpeed9am"), "WindDir9am",
                       r6(safe_double("MinTemp")).alias("MinTemp"), r6(safe_double("Evaporation")).alias("Evaporation"))


def _round_trip(spark, name: str, df: DataFrame) -> DataFrame:
    path = scratch_path(spark, name)
    S.write_table(df, path)
    return S.read_table(spark, path)


def _reuse(name: str, source: str, fn):
    """Register a sink query whose oracle is the source query's oracle."""
    register(name, ORACLE.get(source))(fn)


def a5(spark, sf_dir):
    return _round_trip(spark, "a5-processed", QUERIES["b12_feature_row"](spark, sf_dir))


def a6(spark, sf_dir):
    path = scratch_path(spark, "a6-log")
    p = fx.pred_log(spark, sf_dir).withColumn("rain_probability", r6("rain_probability"))
    cut = F.lit("2024-01-15").cast("date")
    S.append_log(p.filter(F.col("target_date") <= cut), path)
    S.append_log(p.filter(~(F.col("target_date") <= cut)), path)
    return S.read_table(spark, path)


_LIVE_SCHEMA = T.StructType([
    T.StructField("status", T.StringType()), T.StructField("accuracy_live", T.DoubleType()),
    T.StructField("precision_live", T.DoubleType()), T.StructField("recall_live", T.DoubleType()),
    T.StructField("f1_live", T.DoubleType()), T.StructField("roc_auc_live", T.DoubleType()),
    T.StructField("scored_rows", T.LongType()), T.StructField("positives_true", T.LongType()),
    T.StructField("window", T.LongType())])


def a7(spark, sf_dir):
    path = scratch_path(spark, "a7-doc")
    S.write_document(QUERIES["i3_live_metrics"](spark, sf_dir), path)
    return S.read_document(spark, path, _LIVE_SCHEMA)


def a8(spark, sf_dir):
    return _round_trip(spark, "a8-retrain", QUERIES["i4_retrain_set"](spark, sf_dir))


def a9(spark, sf_dir):
    path = scratch_path(spark, "a9-ranked")
    ranked = QUERIES["e6_rank_top5"](spark, sf_dir)
    S.write_ranked_csv(ranked, path, [F.col("accuracy").desc(), F.col("location")])
    return S.read_ranked_csv(spark, path, T.StructType([T.StructField("location", T.StringType()),
                                                        T.StructField("accuracy", T.DoubleType())]))


def register_sinks() -> None:
    _reuse("a5_processed_round_trip", "b12_feature_row", a5)
    register("a6_append_log", W("""
SELECT event_id, logged_at, feature_date, target_date, location, ROUND(rain_probability, 6) AS rain_probability,
       predicted_rain FROM pred_log"""))(a6)
    _reuse("a7_metrics_document", "i3_live_metrics", a7)
    _reuse("a8_retrain_set_sink", "i4_retrain_set", a8)
    _reuse("a9_ranked_csv", "e6_rank_top5", a9)


register_sinks()
