"""Catalog part 5: feature engineering and neighbour operators."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloop.functions.values import safe_double
from labelloop.operators import features as FE
from labelloop.operators.neighbours import knn_vote, smote
from labelloop.operators.split import stratified_split
from labelloop.plans import fixtures as fx
from labelloop.plans.catalog import r6, register
from labelloop.plans.fixtures import HISTORY_HORIZON as H, with_fixtures as W

_NUM = (f"SELECT event_id, obs_date, obs_date <= DATE '{H}' AS is_train, wind_dir, wind_speed9am, "
        f"CASE WHEN isnan(TRY_CAST(rainfall_txt AS DOUBLE)) THEN NULL ELSE TRY_CAST(rainfall_txt AS DOUBLE) END AS rainfall "
        f"FROM obs")


def _num(spark, sf_dir) -> DataFrame:
    o = fx.obs(spark, sf_dir)
    return o.select("event_id", "obs_date", (F.col("obs_date") <= F.lit(H).cast("date")).alias("is_train"),
                    "wind_dir", "wind_speed9am", safe_double("rainfall_txt").alias("rainfall"))


@register("h1_mean_impute", W("""
SELECT event_id, ROUND(COALESCE(rainfall, (SELECT AVG(rainfall) FROM num WHERE is_train)), 6) AS rainfall,
       ROUND(COALESCE(wind_speed9am, (SELECT AVG(wind_speed9am) FROM num WHERE is_train)), 6) AS wind_speed9am
FROM num""", num=_NUM))
def h1(spark, sf_dir):
    x = _num(spark, sf_dir)
    means = FE.fit_means(x.filter("is_train"), ["rainfall", "wind_speed9am"])
    out = FE.fill(x, means)
    return out.select("event_id", r6("rainfall").alias("rainfall"), r6("wind_speed9am").alias("wind_speed9am"))


@register("h1_imputer_stage", W("""
SELECT event_id, ROUND(COALESCE(rainfall, (SELECT AVG(rainfall) FROM num WHERE is_train)), 6) AS rainfall_imp
FROM num""", num=_NUM))
def h1_stage(spark, sf_dir):
    """H1 through Spark ML's Imputer (fit on the training rows only)."""
    x = _num(spark, sf_dir)
    model = FE.mean_imputer(["rainfall"], "_imp").fit(x.filter("is_train"))
    return model.transform(x).select("event_id", r6("rainfall_imp").alias("rainfall_imp"))


@register("h2_mode_impute", W("""
SELECT event_id, COALESCE(wind_dir, (SELECT wind_dir FROM num WHERE is_train AND wind_dir IS NOT NULL
  GROUP BY wind_dir ORDER BY COUNT(*) DESC, wind_dir ASC LIMIT 1)) AS wind_dir FROM num""", num=_NUM))
def h2(spark, sf_dir):
    x = _num(spark, sf_dir)
    modes = FE.fit_modes(x.filter("is_train"), ["wind_dir"])
    return FE.fill(x, modes).select("event_id", "wind_dir")


@register("h3_per_split_impute", W("""
SELECT n.event_id, ROUND(COALESCE(n.rainfall, s.m_rain), 6) AS rainfall, COALESCE(n.wind_dir, md.wind_dir) AS wind_dir
FROM num n JOIN (SELECT is_train, AVG(rainfall) AS m_rain FROM num GROUP BY is_train) s ON n.is_train = s.is_train
JOIN (SELECT is_train, wind_dir FROM (SELECT is_train, wind_dir, ROW_NUMBER() OVER (PARTITION BY is_train
      ORDER BY COUNT(*) DESC, wind_dir ASC) AS rn FROM num WHERE wind_dir IS NOT NULL GROUP BY is_train, wind_dir) t
      WHERE rn = 1) md ON n.is_train = md.is_train""", num=_NUM))
def h3(spark, sf_dir):
    x = FE.impute_per_split(_num(spark, sf_dir), "is_train", numeric=["rainfall"], categorical=["wind_dir"])
    return x.select("event_id", r6("rainfall").alias("rainfall"), "wind_dir")


_CATS = f"SELECT DISTINCT CAST(obs_date AS VARCHAR) AS c FROM obs WHERE obs_date <= DATE '{H}'"


@register("h4_one_hot_unknown", W("""
SELECT o.event_id, (SELECT CAST(COUNT(*) AS INTEGER) FROM cats d WHERE d.c < CAST(o.obs_date AS VARCHAR)) AS slot,
       (SELECT CAST(COUNT(*) AS INTEGER) FROM cats) AS n_slots
FROM obs o WHERE CAST(o.obs_date AS VARCHAR) IN (SELECT c FROM cats)
UNION ALL
SELECT o.event_id, CAST(NULL AS INTEGER), (SELECT CAST(COUNT(*) AS INTEGER) FROM cats)
FROM obs o WHERE CAST(o.obs_date AS VARCHAR) NOT IN (SELECT c FROM cats)""", cats=_CATS))
def h4(spark, sf_dir):
    """H4: one-hot of the observation day fitted on history days; later days
    are unseen categories and encode as all zeros."""
    x = fx.obs(spark, sf_dir).select("event_id", "obs_date", F.col("obs_date").cast("string").alias("day"))
    model = Pipeline(stages=FE.one_hot_stages(["day"])).fit(x.filter(F.col("obs_date") <= F.lit(H).cast("date")))
    arr = vector_to_array(F.col("day_ohe"))
    pos = F.array_position(arr, 1.0)
    return model.transform(x).select("event_id", F.when(pos > 0, pos - 1).cast("int").alias("slot"),
                                     F.size(arr).cast("int").alias("n_slots"))


@register("h5_cyclic_stage", W("""
SELECT event_id, ROUND(sin(dayofyear(obs_date) / 365e0 * 2 * pi()), 6) AS Dayofyear_sin,
       ROUND(cos(dayofyear(obs_date) / 365e0 * 2 * pi()), 6) AS Dayofyear_cos,
       ROUND(sin(month(obs_date) / 12e0 * 2 * pi()), 6) AS Month_sin,
       ROUND(cos(month(obs_date) / 12e0 * 2 * pi()), 6) AS Month_cos FROM obs"""))
def h5(spark, sf_dir):
    x = fx.obs(spark, sf_dir).select("event_id", F.dayofyear("obs_date").alias("Dayofyear"),
                                     F.month("obs_date").alias("Month"))
    out = FE.cyclic_stage().transform(x)
    return out.select("event_id", *[r6(c).alias(c) for c in ("Dayofyear_sin", "Dayofyear_cos",
                                                               "Month_sin", "Month_cos")])


_H6_SQL = W("""
SELECT event_id,
  CASE WHEN wd = c0 THEN 1e0 ELSE 0e0 END AS f0, CASE WHEN wd = c1 THEN 1e0 ELSE 0e0 END AS f1,
  CASE WHEN wd = c2 THEN 1e0 ELSE 0e0 END AS f2, CASE WHEN wd = c3 THEN 1e0 ELSE 0e0 END AS f3,
  CASE WHEN wd = c4 THEN 1e0 ELSE 0e0 END AS f4,
  ROUND(COALESCE(rainfall, (SELECT AVG(rainfall) FROM num WHERE is_train)), 6) AS f5,
  ROUND(COALESCE(wind_speed9am, (SELECT AVG(wind_speed9am) FROM num WHERE is_train)), 6) AS f6,
  ROUND(sin(dayofyear(obs_date) / 365e0 * 2 * pi()), 6) AS f7, ROUND(cos(dayofyear(obs_date) / 365e0 * 2 * pi()), 6) AS f8,
  ROUND(sin(month(obs_date) / 12e0 * 2 * pi()), 6) AS f9, ROUND(cos(month(obs_date) / 12e0 * 2 * pi()), 6) AS f10
FROM (SELECT n.*, COALESCE(n.wind_dir, (SELECT wind_dir FROM num WHERE is_train AND wind_dir IS NOT NULL
        GROUP BY wind_dir ORDER BY COUNT(*) DESC, wind_dir ASC LIMIT 1)) AS wd FROM num n) x,
     (SELECT MAX(CASE WHEN r = 1 THEN c END) AS c0, MAX(CASE WHEN r = 2 THEN c END) AS c1,
             MAX(CASE WHEN r = 3 THEN c END) AS c2, MAX(CASE WHEN r = 4 THEN c END) AS c3,
             MAX(CASE WHEN r = 5 THEN c END) AS c4
      FROM (SELECT c, ROW_NUMBER() OVER (ORDER BY c) AS r FROM (SELECT DISTINCT COALESCE(wind_dir,
            (SELECT wind_dir FROM num WHERE is_train AND wind_dir IS NOT NULL GROUP BY wind_dir
             ORDER BY COUNT(*) DESC, wind_dir ASC LIMIT 1)) AS c FROM num WHERE is_train) d) k) levels""", num=_NUM)


@register("h6_assembled_features", _H6_SQL)
def h6(spark, sf_dir):
    """H6: modes filled, then mean imputation + one-hot (5 wind-direction
    levels) + cyclic calendar terms assembled into one vector, fitted on the
    history rows; exported densely as f0..f10 with vector_to_array."""
    x = _num(spark, sf_dir).withColumns({"Dayofyear": F.dayofyear("obs_date"), "Month": F.month("obs_date")})
    train = x.filter("is_train")
    modes = FE.fit_modes(train, ["wind_dir"])
    model = FE.preprocessing_pipeline(["wind_dir"], ["rainfall", "wind_speed9am"]).fit(FE.fill(train, modes))
    arr = vector_to_array("features")
    out = model.transform(FE.fill(x, modes)).select("event_id", arr.alias("__f"))
    return out.select("event_id", *[r6(F.get("__f", i)).alias(f"f{i}") for i in range(11)])


@register("h7_scale_by_std", W("""
SELECT event_id, ROUND(wind_speed9am / (SELECT STDDEV_POP(wind_speed9am) FROM num WHERE is_train), 6) AS scaled,
       ROUND((wind_speed9am - (SELECT AVG(wind_speed9am) FROM num WHERE is_train))
             / (SELECT STDDEV_POP(wind_speed9am) FROM num WHERE is_train), 6) AS centred FROM num""", num=_NUM))
def h7(spark, sf_dir):
    x = _num(spark, sf_dir)
    train = x.filter("is_train")
    s = FE.fit_scale(train, ["wind_speed9am"])
    m = FE.fit_means(train, ["wind_speed9am"])
    both = x.select("event_id", F.col("wind_speed9am").alias("scaled"), F.col("wind_speed9am").alias("centred"))
    out = FE.scale(FE.scale(both, {"scaled": s["wind_speed9am"]}), {"centred": s["wind_speed9am"]}, {"centred": m["wind_speed9am"]})
    return out.select("event_id", r6("scaled").alias("scaled"), r6("centred").alias("centred"))


@register("h14_balanced_weights", W("""
SELECT event_id, label, ROUND((SELECT COUNT(*) FROM lab) / (2e0 * COUNT(*) OVER (PARTITION BY label)), 6) AS weight
FROM lab""", lab="SELECT event_id, CASE WHEN lower(trim(rain_tomorrow)) IN ('yes', '1', 'true') THEN 1 ELSE 0 END AS label "
                 "FROM obs WHERE rain_tomorrow IS NOT NULL"))
def h14(spark, sf_dir):
    from labelloop.functions.values import binary_label
    o = fx.obs(spark, sf_dir).dropna(subset=["rain_tomorrow"])
    lab = o.select("event_id", binary_label("rain_tomorrow").alias("label"))
    return FE.balanced_weights(lab, "label").select("event_id", "label", r6("weight").alias("weight"))


# ------------------------------------------------------------------ neighbours
_EMB_SPLIT = ("SELECT vec_id, embedding, CASE WHEN label = 5 THEN 1 ELSE 0 END AS y, "
              "CASE WHEN ROW_NUMBER() OVER (PARTITION BY label ORDER BY md5('42' || CAST(vec_id AS VARCHAR)), vec_id) "
              "<= ROUND(COUNT(*) OVER (PARTITION BY label) * 0.2e0) THEN 'test' ELSE 'train' END AS split FROM embeddings")
_SQD = "list_sum(list_transform(list_zip({a}, {b}), lambda x: (x[1]::DOUBLE - x[2]::DOUBLE) * (x[1]::DOUBLE - x[2]::DOUBLE)))"


def _emb(spark, sf_dir) -> DataFrame:
    e = fx.table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", "label", (F.col("label") == 5).cast("int").alias("y"))
    return stratified_split(e, "label", "vec_id", 0.2, 42)


@register("h18_knn_vote", W("""
SELECT query_id AS vec_id, ROUND(AVG(y * 1e0), 6) AS probability,
       CASE WHEN AVG(y * 1e0) >= 0.5e0 THEN 1 ELSE 0 END AS prediction
FROM (SELECT q.vec_id AS query_id, t.y, ROW_NUMBER() OVER (PARTITION BY q.vec_id
        ORDER BY """ + _SQD.format(a="q.embedding", b="t.embedding") + """, t.vec_id) AS rn
      FROM es q JOIN es t ON q.split = 'test' AND t.split = 'train') p
WHERE rn <= 7 GROUP BY query_id""", es=_EMB_SPLIT))
def h18(spark, sf_dir):
    e = _emb(spark, sf_dir)
    train = e.filter(F.col("split") == "train")
    test = e.filter(F.col("split") == "test")
    v = knn_vote(train, test, "y", 7, id_col="vec_id", vec_col="embedding")
    return v.select(F.col("query_id").alias("vec_id"), r6("probability").alias("probability"), "prediction")


_SMOTE_SQL = """
SELECT b.vec_id AS base_id, g.copy, n.nid AS neighbour_id, ROUND(g.gap, 6) AS gap,
       ROUND(list_sum(list_transform(list_zip(b.embedding, t.embedding),
             lambda x: x[1]::DOUBLE + g.gap * (x[2]::DOUBLE - x[1]::DOUBLE))), 6) AS vec_sum
FROM gen g JOIN mins b ON b.vec_id = g.vec_id
JOIN nn n ON n.qid = g.vec_id AND n.rk = g.pick
JOIN mins t ON t.vec_id = n.nid"""
_SMOTE_CTES = dict(
    mins="SELECT vec_id, embedding FROM embeddings WHERE label = 5",
    cnt="SELECT CAST(SUM(CASE WHEN label = 5 THEN 1 ELSE 0 END) AS BIGINT) AS n_min, "
        "CAST(SUM(CASE WHEN label <> 5 THEN 1 ELSE 0 END) AS BIGINT) AS n_maj "
        "FROM embeddings",
    nn="SELECT * FROM (SELECT q.vec_id AS qid, t.vec_id AS nid, ROW_NUMBER() OVER (PARTITION BY q.vec_id ORDER BY "
       + _SQD.format(a="q.embedding", b="t.embedding") + ", t.vec_id) AS rk FROM mins q JOIN mins t ON q.vec_id <> t.vec_id) x "
       "WHERE rk <= 5",
    ranked="SELECT vec_id, ROW_NUMBER() OVER (ORDER BY md5('42' || CAST(vec_id AS VARCHAR)), vec_id) AS r FROM mins",
    copies="SELECT r.vec_id, (c.n_maj - c.n_min) // c.n_min + CASE WHEN r.r <= (c.n_maj - c.n_min) % c.n_min THEN 1 ELSE 0 END "
           "AS c FROM ranked r CROSS JOIN cnt c",
    gen0="SELECT vec_id, copy FROM copies, range(1, c + 1) AS t(copy) WHERE c > 0",
    gen="SELECT vec_id, copy, CAST(('0x' || substr(md5('42|' || CAST(vec_id AS VARCHAR) || '|' || CAST(copy AS VARCHAR)), 1, 8))::BIGINT "
        "% 5 + 1 AS INTEGER) AS pick, ('0x' || substr(md5('42|' || CAST(vec_id AS VARCHAR) || '|' || CAST(copy AS VARCHAR) || '|u'), "
        "1, 8))::BIGINT / 4294967296e0 AS gap FROM gen0",
)


@register("h11_smote", W(_SMOTE_SQL, **_SMOTE_CTES))
def h11(spark, sf_dir):
    e = fx.table(spark, sf_dir, "embeddings").select("vec_id", "embedding", (F.col("label") == 5).cast("int").alias("y"))
    s = smote(e, "y", id_col="vec_id", vec_col="embedding", k=5, seed=42)
    return s.select("base_id", "copy", "neighbour_id", r6("gap").alias("gap"),
                    r6(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x)).alias("vec_sum"))
