"""Classifiers on top of the feature pipelines.

Each trainer returns a fitted ``PipelineModel`` whose output has a
``proba`` column (probability of the positive class, 1 = good).  Spark ML
does the fitting on executors; the driver only holds model parameters.

- logistic regression: sklearn's C maps to regParam = 1 / (C * n) with
  elasticNetParam 0 and no standardization (the pipeline already scales);
- random forest: max_samples -> subsamplingRate, min_samples_leaf ->
  minInstancesPerNode, max_features -> featureSubsetStrategy; class weights
  through ``weightCol`` (default {0: 1, 1: 5} as in the source; {0: 5, 1: 1}
  is the one that matches the cost matrix);
- kernel SVM: an RBF kernel is approximated by random Fourier features
  (Rahimi & Recht 2007), then ``LinearSVC``; probabilities by Platt scaling
  fitted on out-of-fold margins.  An approximation, not the exact dual solver.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression, LogisticRegressionModel,
                                       RandomForestClassifier)
from pyspark.ml.common import _py2java
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from credspark import constants as K
from credspark.operators.batch_fits import side_by_side
from credspark.operators.pipelines import build_baseline, build_pipeline
from credspark.operators.splits import with_weights
from credspark.session import written


class ProbaColumn(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """``proba`` = P(class 1) from a probability vector column."""
    probabilityCol = Param(Params._dummy(), "probabilityCol", "probability vector", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, probabilityCol="probability"):
        super().__init__()
        self._setDefault(probabilityCol="probability")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("proba", vector_to_array(F.col(self.getOrDefault("probabilityCol")))[1])


#: Bytes of features that a task of a solver's pass holds where there are as many, and those of all fits at once.
TASK_BYTES, FITS_BYTES = 128 << 20, 1 << 30


def gathered(x: DataFrame, rows: int, width: int) -> DataFrame:
    """``x`` in few tasks where it is small: a solver makes a job of every iteration, and over at most four tasks
    that job is one stage.  Larger tables keep their tasks."""
    return x.coalesce(max(1, math.ceil(rows * width * 8 / TASK_BYTES)))


def at_once(rows: int, width: int, most: int) -> int:
    """How many fits on ``rows`` by ``width`` numbers may hold their rows at the same time, ``most`` at most."""
    return max(1, min(most, FITS_BYTES // max(rows * width * 8, 1)))


def _fit(stages, train: DataFrame) -> PipelineModel:
    """Fit the feature stages, persist what the estimator reads of the encoded
    rows (it passes over them many times; lost blocks are recomputed from
    lineage), fit the estimator on it, release it."""
    prep = Pipeline(stages=stages[:-2]).fit(train)
    weight = [stages[-2].getWeightCol()] if stages[-2].isSet("weightCol") else []
    x = prep.transform(train).select(K.TARGET, "features", *weight).persist()
    try:
        est = stages[-2].fit(x)
    finally:
        x.unpersist()
    return PipelineModel(stages=[*prep.stages, est, stages[-1]])


def logistic(C: float = 1.0, n: int = 1, max_iter: int = 1000, weight_col: str | None = None) -> LogisticRegression:
    # tol 1e-4 is the stopping tolerance of the solver the source used
    lr = LogisticRegression(featuresCol="features", labelCol=K.TARGET, regParam=1.0 / (C * max(n, 1)),
                            elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=1e-4)
    if weight_col:
        lr.setWeightCol(weight_col)
    return lr


Resampler = Callable[[DataFrame], DataFrame]  # encoded rows (row_id, class, features) -> rebalanced rows


def train_logistic(train: DataFrame, C: float = 1.0, class_weight=None, max_iter: int = 1000,
                   kind: str = "lrc", resample: Resampler | None = None) -> PipelineModel:
    """``resample`` rebalances the encoded training rows only; it excludes ``class_weight``."""
    if resample and class_weight:
        raise ValueError("give a class weight or a resampler, not both")
    if class_weight:
        train = with_weights(train, class_weight)
    prep = build_pipeline(kind, keep_cols=[K.ROW_ID, K.TARGET] + (["weight"] if class_weight else [])).fit(train)
    x = prep.transform(train)
    return fit_logistic(prep, resample(x) if resample else x, C, max_iter, "weight" if class_weight else None)


def fit_logistic(prep: PipelineModel, x: DataFrame, C: float = 1.0, max_iter: int = 1000,
                 weight_col: str | None = None) -> PipelineModel:
    """A regression on the encoded rows ``x``, behind the stages that encode them."""
    x = x.select(K.TARGET, "features", *([weight_col] if weight_col else [])).persist()
    try:
        n = x.count()  # materializes the cache the solver reads
        lr = logistic(C, n, max_iter, weight_col).fit(gathered(x, n, len(_feature_names(prep))))
    finally:
        x.unpersist()
    return PipelineModel(stages=[*prep.stages, lr, ProbaColumn()])


def given_logistic(coefficients) -> LogisticRegressionModel:
    """The regression model of given coefficients, the intercept last."""
    jvm = _active()._jvm
    values = _py2java(_active().sparkContext, Vectors.dense([float(v) for v in coefficients[:-1]]))
    java = jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        f"LogisticRegression_{uuid.uuid4().hex[:12]}", values, float(coefficients[-1]))
    return LogisticRegressionModel(java).setFeaturesCol("features")


class LogisticFit:
    """``train_logistic`` without class weights as a value, so that many fits can see that they may share their passes.
    ``kind`` None: behind the baseline pipeline of the rows' own columns."""

    def __init__(self, kind: str | None = "lrc", C: float = 1.0):
        self.kind, self.C = kind, C

    def pipeline(self, df: DataFrame) -> Pipeline:
        return build_pipeline(self.kind) if self.kind else build_baseline(df)

    def __call__(self, df: DataFrame) -> PipelineModel:
        prep = self.pipeline(df).fit(df)
        return fit_logistic(prep, prep.transform(df), self.C)


def forest(num_trees: int = 100, max_depth: int = 8, min_leaf: int = 1, subsample: float = 1.0,
           max_features: str = "sqrt", seed: int = 42, weight_col: str | None = None) -> RandomForestClassifier:
    rf = RandomForestClassifier(featuresCol="features", labelCol=K.TARGET, numTrees=num_trees, maxDepth=max_depth,
                                minInstancesPerNode=min_leaf, subsamplingRate=subsample,
                                featureSubsetStrategy=str(max_features), seed=seed)
    if weight_col:
        rf.setWeightCol(weight_col)
    return rf


def train_forest(train: DataFrame, class_weight=None, num_trees: int = 100, max_depth: int = 8,
                 min_leaf: int = 1, subsample: float = 1.0, max_features: str = "sqrt", seed: int = 42,
                 kind: str = "rfc") -> PipelineModel:
    class_weight = {0: 1.0, 1: 5.0} if class_weight is None else class_weight
    if class_weight:
        train = with_weights(train, class_weight)
    prep = build_pipeline(kind, keep_cols=[K.ROW_ID, K.TARGET] + (["weight"] if class_weight else []))
    rf = forest(num_trees, max_depth, min_leaf, subsample, max_features, seed, "weight" if class_weight else None)
    return _fit([*prep.getStages(), rf, ProbaColumn()], train)


def train_boosted_trees(train: DataFrame, max_iter: int = 50, max_depth: int = 4, step: float = 0.1,
                        subsample: float = 1.0, seed: int = 42, kind: str = "rfc") -> PipelineModel:
    prep = build_pipeline(kind)
    gbt = GBTClassifier(featuresCol="features", labelCol=K.TARGET, maxIter=max_iter, maxDepth=max_depth,
                        stepSize=step, subsamplingRate=subsample, seed=seed)
    return _fit([*prep.getStages(), gbt, ProbaColumn()], train)


# ------------------------------------------------------------- kernel SVM

def _rff_udf(weights: np.ndarray, bias: np.ndarray):
    scale = np.sqrt(2.0 / len(bias))

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def rff(x: pd.Series) -> pd.Series:
        if len(x) == 0:
            return pd.Series([], dtype=object)
        m = np.stack(x.to_numpy())
        z = scale * np.cos(m @ weights.T + bias)
        return pd.Series(list(z))

    return rff


class FourierFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2 gamma), b ~ U(0, 2 pi); seeded,
    the projection kept in the stage's params.  Arrow-batched numpy."""
    inputCol = Param(Params._dummy(), "inputCol", "features vector", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "output vector", TypeConverters.toString)
    projection = Param(Params._dummy(), "projection", "W and b (JSON)", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="rff", projection="{}"):
        super().__init__()
        self._setDefault(inputCol="features", outputCol="rff", projection="{}")
        self._set(**self._input_kwargs)

    @staticmethod
    def make(n_in: int, n_out: int = 200, gamma: float = 0.1, seed: int = 42) -> "FourierFeatures":
        rng = np.random.default_rng(seed)
        w = rng.normal(0.0, np.sqrt(2.0 * gamma), size=(n_out, n_in))
        b = rng.uniform(0.0, 2 * np.pi, size=n_out)
        return FourierFeatures(projection=json.dumps({"w": w.tolist(), "b": b.tolist()}))

    def _transform(self, df: DataFrame) -> DataFrame:
        p = json.loads(self.getOrDefault("projection"))
        udf = _rff_udf(np.array(p["w"]), np.array(p["b"]))
        arr = vector_to_array(F.col(self.getOrDefault("inputCol")))
        return df.withColumn(self.getOrDefault("outputCol"), array_to_vector(udf(arr)))


class MarginFeature(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """SVM margin (second raw score) as a one-element vector for calibration."""
    inputCol = Param(Params._dummy(), "inputCol", "raw prediction", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol="svm_raw"):
        super().__init__()
        self._setDefault(inputCol="svm_raw")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        m = vector_to_array(F.col(self.getOrDefault("inputCol")))[1]
        return df.withColumn("margin", array_to_vector(F.array(m)))


def linear_svm(features: str, C: float, n: int, max_iter: int = 50, tol: float = 1e-4,
               weight_col: str | None = None) -> LinearSVC:
    est = LinearSVC(featuresCol=features, labelCol=K.TARGET, regParam=1.0 / (C * max(n, 1)), maxIter=max_iter, tol=tol,
                    standardization=False, rawPredictionCol="svm_raw", predictionCol="svm_pred")
    return est.setWeightCol(weight_col) if weight_col else est


def train_kernel_svm(train: DataFrame, C: float = 1.0, gamma: float = 0.1, n_components: int = 200,
                     kernel: str = "rbf", calib_folds: int = 3, seed: int = 42, kind: str = "svc", max_iter: int = 50,
                     fold_col: str | None = None, tol: float = 1e-4, class_weight=None,
                     resample: Resampler | None = None) -> PipelineModel:
    """Linear SVM on random Fourier features (or raw features for kernel='linear'),
    calibrated by Platt scaling on out-of-fold margins.  A class weight or a
    resampler (of the encoded training rows) may balance the classes."""
    from credspark.operators.splits import kfold_assign
    if kernel not in ("rbf", "linear"):
        raise ValueError(f"unknown kernel {kernel!r}")
    if resample and class_weight:
        raise ValueError("give a class weight or a resampler, not both")
    if class_weight:
        train = with_weights(train, class_weight)
    extra = (["weight"] if class_weight else []) + ([fold_col] if fold_col else [])
    prep = build_pipeline(kind, keep_cols=[K.ROW_ID, K.TARGET, *extra]).fit(train)
    x = prep.transform(train)
    x = (resample(x) if resample else x).select(K.ROW_ID, K.TARGET, "features", *extra)
    # folds are dealt on the few encoded columns, before each row becomes n_components numbers
    if fold_col is None:
        x = kfold_assign(written(x, "encoded"), calib_folds, seed)
        fold_col = "fold"
    x = written(x, "folds")
    n_in = len(x.select("features").first()["features"])
    stages = []
    feat, width = "features", n_in
    if kernel == "rbf":
        stages.append(FourierFeatures.make(n_in, n_components, gamma, seed))
        feat, width = "rff", n_components
    xf = (PipelineModel(stages=stages).transform(x) if stages else x).select(
        K.TARGET, fold_col, feat, *(["weight"] if class_weight else []))
    # read by k + 1 fits, each of which keeps its own blocks: what does not fit beside them is computed again, never
    # written to the executors' disks
    xf = xf.persist(StorageLevel.MEMORY_ONLY)
    try:
        n = xf.count()

        def fitted(f: int | None):
            rows = xf if f is None else xf.filter(F.col(fold_col) != f)
            m = linear_svm(feat, C, n, max_iter, tol, "weight" if class_weight else None).fit(gathered(rows, n, width))
            if f is None:
                return m
            return written(MarginFeature().transform(m.transform(xf.filter(F.col(fold_col) == f)))
                           .select("margin", K.TARGET), "margins")

        *parts, final = side_by_side(train.sparkSession, fitted, [*range(calib_folds), None],
                                     at_once(n, width, calib_folds + 1))
    finally:
        xf.unpersist()
    oof = parts[0]
    for p in parts[1:]:
        oof = oof.unionByName(p)
    platt = LogisticRegression(featuresCol="margin", labelCol=K.TARGET, regParam=0.0,
                               rawPredictionCol="platt_raw", predictionCol="platt_pred",
                               probabilityCol="probability").fit(gathered(oof, n, 1))
    return PipelineModel(stages=[*prep.stages, *stages, final, MarginFeature(), platt, ProbaColumn()])


# ------------------------------------------------------- scores and ranks

def linear_score(df: DataFrame, coefficients: dict[str, float], intercept: float = 0.0,
                 name: str = "proba") -> DataFrame:
    """sigmoid(intercept + sum w_j x_j) from given coefficients."""
    z = F.lit(float(intercept))
    for c, w in coefficients.items():
        z = z + F.lit(float(w)) * F.col(c).cast("double")
    return df.withColumn(name, F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))


def _feature_names(model: PipelineModel) -> list[str]:
    for st in model.stages:
        if hasattr(st, "feature_columns"):
            return st.feature_columns()
    raise ValueError("no encoding stage in the model")


def coefficient_ranking(model: PipelineModel, spark=None) -> DataFrame:
    """(feature, coefficient, abs_coefficient, rank) of a fitted logistic model."""
    lr = [s for s in model.stages if hasattr(s, "coefficients")][-1]
    names = _feature_names(model)
    rows = [(n, float(c)) for n, c in zip(names, lr.coefficients.toArray())]
    spark = spark or _active()
    df = spark.createDataFrame(rows, "feature string, coefficient double")
    df = df.select("*", F.abs("coefficient").alias("abs_coefficient"))
    by_size = Window.orderBy(F.desc("abs_coefficient"), "feature")  # one row per feature of a model
    return df.select("*", F.row_number().over(by_size).alias("rank")).orderBy("rank")


def importance_ranking(model: PipelineModel, spark=None) -> DataFrame:
    """(feature, importance) of a fitted tree ensemble, most important first."""
    tree = [s for s in model.stages if hasattr(s, "featureImportances")][-1]
    names = _feature_names(model)
    rows = [(n, float(v)) for n, v in zip(names, tree.featureImportances.toArray())]
    spark = spark or _active()
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def _active():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()


def carrying(model: PipelineModel, name: str) -> PipelineModel:
    """``model`` whose encoding stage lets the column ``name`` through."""
    stages = []
    for st in model.stages:
        if st.hasParam("keepCols"):
            st = st.copy({st.getParam("keepCols"): [*st.getOrDefault("keepCols"), name]})
        stages.append(st)
    return PipelineModel(stages=stages)


def score_models(models: dict[str, PipelineModel], df: DataFrame) -> DataFrame:
    """Row id, label and proba_<name> of each model: the models run one after the other over the same rows.

    The row and the probabilities so far travel in one struct beside the columns
    that a model reads, so no model's columns meet another's, and there is one
    scan and no join on the row id (columns that no model reads are pruned)."""
    cur = df.select("*", F.struct(F.struct("*").alias("row")).alias("_credspark_carry"))
    carry = ["row"]
    for name, m in models.items():
        p = carrying(m, "_credspark_carry").transform(cur).select(
            "_credspark_carry", F.col("proba").alias(f"_credspark_{name}"))
        kept = [F.col(f"_credspark_carry.{c}").alias(c) for c in carry]
        carry = [*carry, f"proba_{name}"]
        cur = p.select("_credspark_carry.row.*",
                       F.struct(*kept, F.col(f"_credspark_{name}").alias(f"proba_{name}")).alias("_credspark_carry"))
    return cur.select(K.ROW_ID, K.TARGET, *[F.col(f"_credspark_carry.{c}").alias(c) for c in carry[1:]])


def train_all(train: DataFrame, seed: int = 42, forest_trees: int = 100, svm_components: int = 200
              ) -> dict[str, PipelineModel]:
    """The three models, each with its own feature pipeline, on the train side only; side by side where the train
    side is small."""
    fits = {
        "lrc": lambda: train_logistic(train),
        "rfc": lambda: train_forest(train, num_trees=forest_trees, seed=seed),
        "svc": lambda: train_kernel_svm(train, n_components=svm_components, seed=seed),
    }
    models = side_by_side(train.sparkSession, lambda name: fits[name](), list(fits),
                          at_once(train.count(), svm_components, len(fits)))
    return dict(zip(fits, models))
