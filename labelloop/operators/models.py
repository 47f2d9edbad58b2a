"""Classifiers, scoring, cross-validation and model benchmarks (H10, H12, H13,
H15–H17, H19, H22, H24).

A model is one Spark ML ``PipelineModel`` (preprocessing + optional scaler +
classifier), so it is persisted and reloaded as a unit (H24).  Optional SMOTE
(H11) runs on the assembled training vectors of each fit only — never on
rows that are scored for evaluation.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import ElementwiseProduct, SQLTransformer
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloop.functions.values import DEFAULT_THRESHOLD
from labelloop.operators.boosting import BoostedTreesModel, fit_many, margins
from labelloop.operators.features import CYCLIC_PERIODS, fit_modes, preprocessing_pipeline
from labelloop.operators.metrics import evaluate
from labelloop.operators.neighbours import smote
from labelloop.session import Held, cut_lineage, shuffles_dropped

# ---- fixed values ----------------------------------------------------------
FOREST_DEFAULTS = {"numTrees": 300}
TREE_DEFAULTS = {"maxDepth": 10, "minInstancesPerNode": 10}   # ≈ min_samples_split = 20
LOGISTIC_DEFAULTS = {"maxIter": 1000}
FOLD_ROWS = 10_000_000     # training rows of the folds that are prepared side by side: more would only hold more memory and disk at once
SMOTE_FOLDS = 2            # folds with SMOTE that are prepared side by side at most: the plans of its many steps fill the driver
PART_ROWS = 250_000        # most rows of a partition of training vectors, on average: learners keep and pass over whole partitions
# ---------------------------------------------------------------------------

MODEL_KINDS = ("lr", "dt", "rf", "gbt", "svc")


def make_classifier(kind: str, label: str = "label", features: str = "features", weight: str | None = None,
                    seed: int = 42, **params):
    """One Spark ML classifier by short name (boosted trees are :mod:`labelloop.operators.boosting`)."""
    common = {"labelCol": label, "featuresCol": features}
    if kind == "rf":
        p = {**FOREST_DEFAULTS, **params}
        w = {"weightCol": weight} if weight else {}
        return RandomForestClassifier(**common, seed=seed, **w, **p)
    if kind == "dt":
        p = {**TREE_DEFAULTS, **params}
        w = {"weightCol": weight} if weight else {}
        return DecisionTreeClassifier(**common, seed=seed, **w, **p)
    if kind == "lr":
        p = {**LOGISTIC_DEFAULTS, **params}
        w = {"weightCol": weight} if weight else {}
        return LogisticRegression(**common, **w, **p)
    if kind == "svc":
        w = {"weightCol": weight} if weight else {}
        return LinearSVC(**common, **w, **params)
    raise ValueError(f"unknown model kind {kind!r}")


@dataclass
class ModelSpec:
    """What to fit: feature roles, the classifier and the optional steps."""
    categorical: Sequence[str]
    numeric: Sequence[str]
    kind: str = "gbt"
    params: dict = field(default_factory=dict)
    label: str = "label"
    scale: bool = True            # H7: divide by std, no centring (keeps one-hot sparse)
    oversample: bool = False      # H11 inside each fit
    id_col: str = "row_id"        # key used by SMOTE's seeded draws
    weight: str | None = None     # H14 class weights


@dataclass
class Prepared:
    """Training rows as vectors: fitted preprocessing ``stages``, the stored rows
    (``vector``, ``label``; balanced if asked for) and the columns that had no value to fit on."""
    stages: list
    rows: DataFrame
    vector: str
    dropped: tuple[str, ...] = ()
    own: Held | None = None     # holds the rows where they are not a checkpoint

    def drop(self) -> None:
        """Delete the rows: once the last classifier is fitted on them."""
        if self.own:
            self.own.drop()


def prepare(train: DataFrame, spec: ModelSpec, stored: bool = False) -> Prepared:
    """Fit preprocessing (+ scaler) on ``train`` and store the vectors it gives, with SMOTE rows if asked for.

    The training rows are stored once before they are passed over (modes, means,
    levels, deviations, vectors), if they are not ``stored``.  A column without any value in them cannot be
    imputed and is left out.  The vectors are dealt to as many partitions as their number asks for.  SMOTE's rows and what it
    keeps on the way (neighbours, blocks, shuffles) are many times the training rows: they are
    written compressed and deleted as soon as they are not needed, the balanced rows by :meth:`Prepared.drop`."""
    train = train.select(*dict.fromkeys([*spec.categorical, *spec.numeric, *CYCLIC_PERIODS, spec.label,
                                         *([spec.id_col] if spec.oversample else []),
                                         *([spec.weight] if spec.weight else [])]))
    train = train if stored else cut_lineage(train)
    present = train.agg(*[F.count(F.col(c)).alias(c) for c in spec.categorical],
                        *[F.count(F.when(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")), 1)).alias(c) for c in spec.numeric],
                        F.count(F.lit(1)).alias("__rows")).first().asDict()
    dropped = tuple(c for c in (*spec.categorical, *spec.numeric) if not present[c])
    cats = [c for c in spec.categorical if c not in dropped]
    stages, data = [], train
    if cats:
        # H2 fill as a persisted stage: the training modes travel with the model
        modes = fit_modes(train, cats)
        fills = ", ".join(
            f"coalesce(`{c}`, {_sql_str(modes[c])}) AS `{c}_filled`" for c in cats)
        stages.append(SQLTransformer(statement=f"SELECT *, {fills} FROM __THIS__"))
        data = stages[-1].transform(data)
    prep = preprocessing_pipeline([f"{c}_filled" for c in cats], [c for c in spec.numeric if c not in dropped]).fit(data)
    stages += list(prep.stages)
    data = prep.transform(data)
    vector = "features"
    if spec.scale:
        scaler = population_scaler(data, "features", "features_scaled")
        stages.append(scaler)
        data = scaler.transform(data)
        vector = "features_scaled"
    parts = math.ceil(present["__rows"] / PART_ROWS)
    if parts > train.rdd.getNumPartitions():
        data = data.repartition(parts)
    keep = [F.col(vector), F.col(spec.label).cast("double").alias(spec.label), *([F.col(spec.weight)] if spec.weight else [])]
    rows = data.select(*keep)
    if not spec.oversample:
        return Prepared(stages, cut_lineage(rows), vector, dropped)
    held, own = Held(train.sparkSession), Held(train.sparkSession) if spec.kind == "gbt" else None
    with shuffles_dropped(train.sparkSession):
        base = held.stored(data.select(F.col(spec.id_col).cast("bigint").alias("id"), vector_to_array(vector).alias("vec"),
                                       F.col(spec.label).cast("int").alias("y")))
        synth = smote(base, "y", id_col="id", vec_col="vec", held=held)
        rows = base.select(array_to_vector("vec").alias(vector), F.col("y").cast("double").alias(spec.label)).unionByName(
            synth.select(array_to_vector("vec").alias(vector), F.col("label").cast("double").alias(spec.label)))
        rows = own.stored(rows) if own else cut_lineage(rows)   # other learners keep whole partitions, which files would be packed into
        held.drop()
    return Prepared(stages, rows, vector, dropped, own)


def fit_prepared(prepared: Prepared, spec: ModelSpec) -> PipelineModel:
    """Fit the classifier of ``spec`` on prepared rows; the model includes the preprocessing."""
    if spec.kind == "gbt":
        trees = fit_many(boosting_rows(prepared, spec, 0), [(0, spec.params)])[0]
        return PipelineModel(stages=[*prepared.stages, BoostedTreesModel.of(trees, prepared.vector)])
    clf = make_classifier(spec.kind, label=spec.label, features=prepared.vector, weight=spec.weight, **spec.params)
    return PipelineModel(stages=[*prepared.stages, fit_classifier(clf, prepared.rows)])


def fit_classifier(clf, rows: DataFrame):
    """The fitted classifier without its training summary, which nothing here reads: it holds the session, and in a
    session in which something was observed (``Observation``) a model that holds it cannot be sent to tasks."""
    model = clf.fit(rows)
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(rows.sparkSession._jvm.scala.Option.empty())
    return model


def boosting_rows(prepared: Prepared, spec: ModelSpec, group: int) -> DataFrame:
    """Prepared rows as (g, y, w, x)."""
    weight = F.col(spec.weight).cast("double") if spec.weight else F.lit(1.0)
    return prepared.rows.select(F.lit(group).alias("g"), F.col(spec.label).cast("double").alias("y"), weight.alias("w"),
                                vector_to_array(prepared.vector).alias("x"))


def fit_model(train: DataFrame, spec: ModelSpec) -> PipelineModel:
    """Fit preprocessing (+ scaler) on ``train``, optionally oversample the
    assembled training vectors, fit the classifier; return one PipelineModel."""
    ready = prepare(train, spec)
    model = fit_prepared(ready, spec)
    ready.drop()
    return model


def population_scaler(data: DataFrame, input_col: str, output_col: str) -> ElementwiseProduct:
    """H7 inside a pipeline: divide every feature by its population standard
    deviation, no centring (keeps one-hot vectors sparse); a zero deviation
    scales by 1, so constant features pass through.  Fitted with one
    ``Summarizer`` pass; the scale vector has one entry per feature."""
    row = data.select(Summarizer.metrics("std", "count").summary(F.col(input_col)).alias("s")).first()
    n = float(row["s"]["count"])
    corr = math.sqrt((n - 1.0) / n) if n > 1 else 1.0
    scale = [1.0 / (sd * corr) if sd and sd * corr > 0 else 1.0 for sd in row["s"]["std"].toArray()]
    return ElementwiseProduct(scalingVec=Vectors.dense(scale), inputCol=input_col, outputCol=output_col)


def _sql_str(v) -> str:
    if v is None:
        return "CAST(NULL AS STRING)"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def score(model: PipelineModel, df: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Probability of the positive class and the class at ``p >= threshold``
    (a linear SVC, which has no probability, is scored on its raw margin > 0)."""
    out = model.transform(df)   # a whole pipeline, or a classifier on prepared vectors
    if "probability" in out.columns:
        p = F.get(vector_to_array("probability"), 1)
        return out.withColumn("score", p).withColumn("predicted", (p >= threshold).cast("int"))
    margin = F.get(vector_to_array("rawPrediction"), 1)
    return out.withColumn("score", margin).withColumn("predicted", (margin > 0).cast("int"))


@dataclass
class Fold:
    """One fold, ready for any number of classifiers: prepared training rows and stored held-out vectors."""
    name: object
    train: Prepared
    held: DataFrame
    kind: str = "int"     # type of the name


def prepare_folds(df: DataFrame, spec: ModelSpec, fold_col: str = "fold", parallelism: int = 4) -> list[Fold]:
    """Store the rows once, then fit preprocessing (and SMOTE) once per fold on the other folds.

    At most ``parallelism`` folds are prepared side by side, ``SMOTE_FOLDS`` with SMOTE, and not more than have ``FOLD_ROWS`` rows.
    Who is done with the folds drops them (:func:`drop_folds`)."""
    held = Held(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        df = held.stored(df)
        names = sorted(r[0] for r in df.select(fold_col).distinct().collect())   # k small values

        def one(f):
            train = prepare(df.filter(F.col(fold_col) != f), spec, stored=True)
            out = PipelineModel(stages=train.stages).transform(df.filter(F.col(fold_col) == f))
            out = out.select(train.vector, F.col(spec.label).cast("int").alias("y"))
            return Fold(f, train, train.own.stored(out) if train.own else cut_lineage(out), df.schema[fold_col].dataType.simpleString())

        most = min(parallelism, SMOTE_FOLDS if spec.oversample else parallelism, FOLD_ROWS // max(1, df.count()))
        with ThreadPoolExecutor(max_workers=max(1, most)) as pool:
            folds = list(pool.map(one, names))
        held.drop()
    return folds


def drop_folds(folds: Sequence[Fold]) -> None:
    for fold in folds:
        fold.train.drop()


def evaluate_folds(folds: Sequence[Fold], spec: ModelSpec, fold_col: str = "fold", parallelism: int = 4,
                   threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """H10 on prepared folds: one classifier per fold; out-of-fold scores evaluated per fold (D13 + D14)."""
    if spec.kind == "gbt":
        return evaluate_settings(folds, spec, [spec.params], fold_col, threshold).drop("setting")

    def one(fold: Fold) -> DataFrame:
        clf = make_classifier(spec.kind, label=spec.label, features=fold.train.vector, weight=spec.weight, **spec.params)
        held = score(fit_classifier(clf, fold.train.rows), fold.held, threshold)
        return held.select(F.lit(fold.name).alias(fold_col), "y", "predicted", "score")

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(folds)))) as pool:
        parts = list(pool.map(one, folds))
    return evaluate(reduce(DataFrame.unionByName, parts), y="y", pred="predicted", score="score", groups=[fold_col])


def evaluate_settings(folds: Sequence[Fold], spec: ModelSpec, params: Sequence[dict], fold_col: str = "fold",
                      threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """H10 / H20 for boosted trees: (setting, fold, metrics); every setting on every fold is fitted in one pass,
    and all out-of-fold scores are evaluated in another."""
    rows = reduce(DataFrame.unionByName, [boosting_rows(f.train, spec, i) for i, f in enumerate(folds)])
    found = fit_many(rows, [(i, p) for p in params for i in range(len(folds))])
    trees = {(s, i): found[s * len(folds) + i] for s in range(len(params)) for i in range(len(folds))}
    held = reduce(DataFrame.unionByName, [
        f.held.select(F.lit(i).alias("g"), F.col("y").cast("int").alias("y"), vector_to_array(f.train.vector).alias("x")) for i, f in enumerate(folds)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for g, part in batch.groupby("g"):
                x = np.stack(part["x"].to_numpy())
                for s in range(len(params)):
                    p = 1 / (1 + np.exp(-margins(trees[s, int(g)], x)))
                    yield pd.DataFrame({"setting": s, "g": g, "y": part["y"], "predicted": (p >= threshold).astype(int), "score": p})

    names = rows.sparkSession.createDataFrame([(i, f.name) for i, f in enumerate(folds)], ["g", fold_col]).withColumn("g", F.col("g").cast("int"))
    scored = held.mapInPandas(run, "setting int, g int, y int, predicted int, score double")
    per = evaluate(cut_lineage(scored), y="y", pred="predicted", score="score", groups=["setting", "g"])
    kind = folds[0].kind if folds else "int"
    return per.join(F.broadcast(names), "g").drop("g").withColumn(fold_col, F.col(fold_col).cast(kind)).select(
        "setting", fold_col, *[c for c in per.columns if c not in ("setting", "g")])   # a row per fold


def cross_validate(df: DataFrame, spec: ModelSpec, fold_col: str = "fold", parallelism: int = 4,
                   threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """One fit per fold on the other folds; out-of-fold scores unioned and
    evaluated per fold (D13 + D14).  At most ``parallelism`` fits run at a time."""
    folds = prepare_folds(df, spec, fold_col, parallelism)
    found = evaluate_folds(folds, spec, fold_col, parallelism, threshold)
    drop_folds(folds)
    return found


def benchmark(df: DataFrame, base: ModelSpec, kinds: Sequence[str] = MODEL_KINDS,
              params: dict[str, dict] | None = None, fold_col: str = "fold") -> DataFrame:
    """The same folds for several classifiers → one row per model with the
    mean of each fold metric, ranked by ROC AUC (E6)."""
    folds, rows = prepare_folds(df, base, fold_col), []
    for kind in kinds:
        spec = replace(base, kind=kind, params=(params or {}).get(kind, {}))
        m = evaluate_folds(folds, spec, fold_col)
        rows.append(m.agg(F.count(F.lit(1)).alias("folds"), *[F.avg(c).alias(c) for c in ("accuracy", "precision", "recall", "f1", "roc_auc")])
                    .withColumn("model", F.lit(kind)))
    out = reduce(DataFrame.unionByName, rows)
    return out.orderBy(F.col("roc_auc").desc_nulls_last(), "model")


def save_model(model: PipelineModel, path: str) -> str:
    """Persist the whole pipeline (overwriting the target path)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)

