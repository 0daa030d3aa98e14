"""Supervised and unsupervised encoders as Spark ML Estimators.

Every fit is ONE grouped aggregate over the training side (all encoded
columns at once, via unpivot) producing per-level statistics.  Columns with at
most MAP_LEVELS levels become maps kept in the model's parameters (a checked
bound) and are applied in the projection, without a join.  The state of the
other columns is a table at every size, written to the shared checkpoint folder
at fit, saved beside the model's parameters, and applied by one join whatever
the number of columns.  One-hot encoding collects its levels, because they are
the output's columns; a column with more than ONEHOT_LEVELS is refused by name.

Because these are ``Estimator`` / ``Model`` stages, they sit *inside* the
``Pipeline`` handed to ``CrossValidator``: fold scores never see the
held-out fold's targets.

Formulas (defaults as parameters):
- one-hot: one column per training level named ``<col>_<level>``; unseen -> all 0;
- WOE: ln(((pos+a)/(P+2a)) / ((neg+a)/(N+2a))), a = 1; levels seen once,
  unseen and missing -> 0;
- target: prior*(1-w) + mean*w, w = 1/(1+exp(-(n-k)/s)), k = 20; unseen and
  missing -> prior (Micci-Barreca 2001 smoothing);
- count: relative frequency; unseen -> 0;
- ordinal: 1.. in order of first appearance (smallest row id); unseen -1, missing -2;
- standard scaling with the population std; std 0 -> divide by 1.
"""

from __future__ import annotations

import json
import os
import re
import zlib

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credspark import constants as K
from credspark.operators.ranks import row_numbers
from credspark.session import materialize, written

def safe_name(s: str) -> str:
    """Column-safe name; comparison signs are spelled out so that levels such
    as '< 500 DM' and '>= 500 DM' stay distinct."""
    s = s.replace("<", "lt").replace(">", "gt").replace("=", "eq")
    return re.sub(r"[^0-9A-Za-z_]+", "_", s)


def onehot_names(col: str, levels: list[str]) -> list[str]:
    """One name per level; levels whose safe names are equal get a checksum of the level appended."""
    plain = [safe_name(f"{col}_{v}") for v in levels]
    return [n if plain.count(n) == 1 else f"{n}_{zlib.crc32(v.encode()):08x}" for n, v in zip(plain, levels)]


# ----------------------------------------------------------- state tables

#: A column of at most so many levels is applied as a map in the projection; the others by one join.
MAP_LEVELS = 256
#: One-hot levels of one column at most: each is an output column.
ONEHOT_LEVELS = 10_000
KINDS = ("woe", "target", "count", "ordinal")
STATE_SCHEMA = "kind string, column_name string, level string, value double"
UNSEEN = {"woe": (0.0, 0.0), "count": (0.0, 0.0), "ordinal": (-1.0, -2.0)}  # (unseen, missing); target: the prior


def unseen_missing(kind: str, prior: float) -> tuple[float, float]:
    return UNSEEN.get(kind, (prior, prior))


def level_stats(df: DataFrame, cols: list[str], label: str = K.TARGET, id_col: str = K.ROW_ID) -> DataFrame:
    """(column_name, level, n, pos, first) of every level of every column: one pass, computed once."""
    y = F.col(label).cast("double") if label in df.columns else F.lit(0.0)
    rid = F.col(id_col) if id_col in df.columns else F.lit(0)
    long = df.select(y.alias("_y"), rid.alias("_rid"), *[F.col(f"`{c}`").cast("string").alias(c) for c in cols])
    return materialize(long.unpivot(["_y", "_rid"], cols, "column_name", "level").filter(F.col("level").isNotNull())
                       .groupBy("column_name", "level").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("pos"),
                                                            F.min("_rid").alias("first")))


def level_counts(stats: DataFrame) -> dict[str, int]:
    """Levels of each column (one row for each column)."""
    return {r["column_name"]: r["k"] for r in stats.groupBy("column_name").agg(F.count(F.lit(1)).alias("k")).collect()}


def states_from_stats(spec: dict, stats: DataFrame, nn: int, p: float, regularization: float = 1.0,
                      min_samples_leaf: int = 20) -> DataFrame | None:
    """(kind, column_name, level, value) of every encoder of ``spec`` from per-level statistics
    (column_name, level, n, pos, first)."""
    a, s = regularization, float(spec.get("target_smoothing", 1.0))
    prior = p / nn if nn else 0.0
    n, pos = F.col("n").cast("double"), F.col("pos")
    w = F.lit(1.0) / (F.lit(1.0) + F.exp(-(n - float(min_samples_leaf)) / s))
    values = {
        "woe": F.when(n == 1, F.lit(0.0)).otherwise(
            F.ln(((pos + a) / (p + 2 * a)) / ((n - pos + a) / (nn - p + 2 * a)))),
        "target": F.lit(prior) * (1 - w) + (pos / n) * w,
        "count": n / float(max(nn, 1)),
    }
    out = None
    for kind in KINDS:
        if not spec.get(kind):
            continue
        mine = stats.filter(F.col("column_name").isin(spec[kind]))
        if kind == "ordinal":
            part = row_numbers(mine.select("column_name", "level", "first"), "first", ["column_name"],
                               tie_cols=["level"], name="value")
            part = part.select("column_name", "level", F.col("value").cast("double").alias("value"))
        else:
            part = mine.select("column_name", "level", values[kind].alias("value"))
        part = part.select(F.lit(kind).alias("kind"), "column_name", "level", "value")
        out = part if out is None else out.unionByName(part)
    return out


def split_states(spec: dict, stats: DataFrame, counts: dict[str, int], nn: int, p: float, regularization: float = 1.0,
                 min_samples_leaf: int = 20) -> tuple[dict, DataFrame]:
    """The fitted state in two parts: maps {kind: {column: {level: value}}} of the columns with at most
    MAP_LEVELS levels, and a written table (kind, column_name, level, value) of the others."""
    spark = stats.sparkSession
    few = {k: [c for c in spec.get(k, []) if counts.get(c, 0) <= MAP_LEVELS] for k in KINDS}
    many = {k: [c for c in spec.get(k, []) if counts.get(c, 0) > MAP_LEVELS] for k in KINDS}
    rest = {k: v for k, v in spec.items() if k not in KINDS}
    maps: dict = {k: {c: {} for c in few[k]} for k in KINDS if few[k]}
    small = stats.filter(F.col("column_name").isin(sorted({c for v in few.values() for c in v})))
    valued = states_from_stats({**rest, **few, "ordinal": []}, small, nn, p, regularization, min_samples_leaf)
    if valued is not None:      # at most MAP_LEVELS rows for each column
        for r in valued.collect():
            maps[r["kind"]][r["column_name"]][r["level"]] = r["value"]
    if few["ordinal"]:
        for r in small.filter(F.col("column_name").isin(few["ordinal"])).orderBy("first", "level").collect():
            seen = maps["ordinal"][r["column_name"]]
            seen[r["level"]] = len(seen) + 1.0
    table = states_from_stats({**rest, **many}, stats, nn, p, regularization, min_samples_leaf)
    return maps, spark.createDataFrame([], STATE_SCHEMA) if table is None else written(table, "encoders")


def apply_states(df: DataFrame, maps: dict, state: DataFrame | None, spec: dict, prior: float) -> DataFrame:
    """Replace each encoded column by its value.  Columns with a map need no join.  One other column is
    joined on its level; more of them by one join in long form: the rows are written once with a number
    each, their levels unpivoted, joined and put together by the number again."""
    joined = [(kind, c) for kind in KINDS for c in spec.get(kind, []) if c not in maps.get(kind, {})]
    values = {}
    for kind in KINDS:
        for c in spec.get(kind, []):
            if c in maps.get(kind, {}):
                pairs = [F.lit(x) for level, v in maps[kind][c].items() for x in (level, v)]
                values[c] = F.try_element_at(F.create_map(*pairs), F.col(f"`{c}`").cast("string")) if pairs \
                    else F.lit(None).cast("double")
    out, drop = df, []
    if len(joined) == 1:
        kind, c = joined[0]
        s = state.filter((F.col("kind") == kind) & (F.col("column_name") == c)).select(
            F.col("level").alias("_credspark_level"), F.col("value").alias("_credspark_value"))
        out = out.join(s, F.col(f"`{c}`").cast("string") == F.col("_credspark_level"), "left")
        values[c], drop = F.col("_credspark_value"), ["_credspark_level", "_credspark_value"]
    elif joined:
        out = written(out.withColumn("_credspark_row", F.monotonically_increasing_id()), "encoding")
        levels = F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(c).alias("column_name"),
                                    F.col(f"`{c}`").cast("string").alias("level")) for kind, c in joined])
        keys = out.select("_credspark_row", F.inline(levels)).filter(F.col("level").isNotNull())
        hit = keys.join(state, ["kind", "column_name", "level"]).groupBy("_credspark_row").agg(
            F.map_from_entries(F.collect_list(F.struct(F.concat_ws("/", "kind", "column_name"), "value")))
            .alias("_credspark_values"))     # one entry for each joined column of a row
        out = out.join(hit, "_credspark_row", "left")
        for kind, c in joined:
            values[c] = F.try_element_at("_credspark_values", F.lit(f"{kind}/{c}"))
        drop = ["_credspark_row", "_credspark_values"]

    def encoded(kind: str, c: str) -> Column:
        unseen, missing = unseen_missing(kind, prior)
        return F.when(F.col(f"`{c}`").isNull(), F.lit(missing)).otherwise(F.coalesce(values[c], F.lit(unseen)))

    kinds = {c: kind for kind in KINDS for c in spec.get(kind, [])}
    return out.select(*[encoded(kinds[c], c).alias(c) if c in kinds else F.col(f"`{c}`") for c in out.columns
                        if c not in drop])


def onehot_levels(stats: DataFrame, counts: dict[str, int], cols: list[str]) -> dict[str, list[str]]:
    """Levels per column in order of first appearance: the names of the columns to come."""
    for c in cols:
        if counts.get(c, 0) > ONEHOT_LEVELS:
            raise ValueError(f"column {c!r} has {counts[c]} levels; one-hot encoding makes a column of each and takes "
                             f"{ONEHOT_LEVELS} at most: use another encoder for it")
    levels: dict[str, list[str]] = {c: [] for c in cols}
    for r in stats.filter(F.col("column_name").isin(cols)).orderBy("first", "level").collect():
        levels[r["column_name"]].append(r["level"])
    return levels


class StateWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.state.write.parquet(os.path.join(path, "state"))


class StateReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        model.state = self.sparkSession.read.parquet(os.path.join(path, "state"))
        return model


class StateTable:
    """A model whose fitted state is the DataFrame ``state``, saved beside the parameters."""

    state: DataFrame | None = None

    def write(self) -> MLWriter:
        return StateWriter(self)

    def save(self, path: str) -> None:
        self.write().save(path)

    @classmethod
    def read(cls) -> MLReader:
        return StateReader(cls)

    @classmethod
    def load(cls, path: str):
        return cls.read().load(path)


# ------------------------------------------------------------ ML stages

class _StateParams(HasInputCols, HasLabelCol):
    kind = Param(Params._dummy(), "kind", "woe | target | count | ordinal", TypeConverters.toString)
    regularization = Param(Params._dummy(), "regularization", "WOE additive regularization", TypeConverters.toFloat)
    smoothing = Param(Params._dummy(), "smoothing", "target-encoder smoothing", TypeConverters.toFloat)
    minSamplesLeaf = Param(Params._dummy(), "minSamplesLeaf", "target-encoder k", TypeConverters.toInt)
    idCol = Param(Params._dummy(), "idCol", "row id for first-appearance order", TypeConverters.toString)


class CategoryEncoder(Estimator, _StateParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, kind="woe", inputCols=None, labelCol=K.TARGET, regularization=1.0, smoothing=1.0,
                 minSamplesLeaf=20, idCol=K.ROW_ID):
        super().__init__()
        self._setDefault(kind="woe", labelCol=K.TARGET, regularization=1.0, smoothing=1.0, minSamplesLeaf=20,
                         idCol=K.ROW_ID)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame):
        kind, cols, label = self.getOrDefault("kind"), self.getInputCols(), self.getLabelCol()
        if kind not in KINDS:
            raise ValueError(f"unknown encoder kind {kind}")
        spec = {kind: cols, "target_smoothing": self.getOrDefault("smoothing")}
        stats = level_stats(df, cols, label, self.getOrDefault("idCol"))
        y = F.col(label).cast("double") if label in df.columns else F.lit(0.0)
        nn, p = df.agg(F.count(F.lit(1)), F.sum(y)).first()
        maps, state = split_states(spec, stats, level_counts(stats), nn, p or 0.0, self.getOrDefault("regularization"),
                                   self.getOrDefault("minSamplesLeaf"))
        model = CategoryEncoderModel(kind=kind, inputCols=cols, prior=(p or 0.0) / nn if nn else 0.0,
                                     maps=json.dumps(maps))
        model.state = state
        return model


class CategoryEncoderModel(StateTable, Model, HasInputCols, MLReadable, MLWritable):
    kind = Param(Params._dummy(), "kind", "encoder kind", TypeConverters.toString)
    prior = Param(Params._dummy(), "prior", "target mean", TypeConverters.toFloat)
    maps = Param(Params._dummy(), "maps", "values of columns with few levels (JSON)", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, kind="woe", inputCols=None, prior=0.0, maps="{}"):
        super().__init__()
        self._setDefault(prior=0.0, maps="{}")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return apply_states(df, json.loads(self.getOrDefault("maps")), self.state,
                            {self.getOrDefault("kind"): self.getInputCols()}, self.getOrDefault("prior"))


class OneHotAllEncoder(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """One column per training level (all levels kept: no drop-last)."""
    idCol = Param(Params._dummy(), "idCol", "row id for first-appearance order", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, idCol=K.ROW_ID):
        super().__init__()
        self._setDefault(idCol=K.ROW_ID)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame):
        stats = level_stats(df, self.getInputCols(), id_col=self.getOrDefault("idCol"))
        levels = onehot_levels(stats, level_counts(stats), self.getInputCols())
        return OneHotAllModel(inputCols=self.getInputCols(), levels=json.dumps(levels))


class OneHotAllModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    levels = Param(Params._dummy(), "levels", "levels per column (JSON)", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, levels="{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def output_columns(self) -> list[str]:
        lv = json.loads(self.getOrDefault("levels"))
        return [n for c in self.getInputCols() for n in onehot_names(c, lv.get(c, []))]

    def _transform(self, df: DataFrame) -> DataFrame:
        lv = json.loads(self.getOrDefault("levels"))
        return df.select(*[c for c in df.columns if c not in self.getInputCols()],
                         *onehot_exprs(self.getInputCols(), lv))


def onehot_exprs(cols: list[str], levels: dict[str, list[str]]) -> list[Column]:
    """0/1 column per level; unseen and missing values give all zeros."""
    return [F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("int"), F.lit(0)).alias(n)
            for c in cols for v, n in zip(levels.get(c, []), onehot_names(c, levels.get(c, [])))]


class PopulationScaler(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / population std, fitted in one aggregate; std 0 -> divide by 1."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame):
        cols = self.getInputCols()
        row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
                     *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)]).first()
        stats = {c: [row[f"m{i}"], row[f"s{i}"]] for i, c in enumerate(cols)}
        return PopulationScalerModel(inputCols=cols, stats=json.dumps(stats))


class PopulationScalerModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    stats = Param(Params._dummy(), "stats", "mean and std per column (JSON)", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, stats="{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        st = json.loads(self.getOrDefault("stats"))
        cols = self.getInputCols()
        out = []
        for c in df.columns:
            if c in cols:
                m, s = st[c]
                s = s if s not in (None, 0.0) else 1.0
                out.append(((F.col(c).cast("double") - F.lit(m)) / F.lit(s)).alias(c))
            else:
                out.append(F.col(c))
        return df.select(*out)


class FeatureEngineerTransformer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    duplicateChecking = Param(Params._dummy(), "duplicateChecking", "copy two columns", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, duplicateChecking=False):
        super().__init__()
        self._setDefault(duplicateChecking=False)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        from credspark.operators.features import feature_engineer
        return feature_engineer(df, self.getOrDefault("duplicateChecking"))


class SelectColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Keep the named columns (passthrough + encoded), drop the rest."""
    outputCols = Param(Params._dummy(), "outputCols", "columns to keep", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f"`{c}`") for c in self.getOrDefault("outputCols") if c in df.columns])


# ---------------------------------------------------------- functional API

def encode_onehot(train: DataFrame, df: DataFrame, cols: list[str]) -> DataFrame:
    return OneHotAllEncoder(inputCols=cols).fit(train).transform(df)


def encode_woe(train: DataFrame, df: DataFrame, cols: list[str], regularization: float = 1.0,
               label: str = K.TARGET) -> DataFrame:
    return CategoryEncoder(kind="woe", inputCols=cols, regularization=regularization, labelCol=label) \
        .fit(train).transform(df)


def encode_target(train: DataFrame, df: DataFrame, cols: list[str], smoothing: float = 1.0,
                  min_samples_leaf: int = 20, label: str = K.TARGET) -> DataFrame:
    return CategoryEncoder(kind="target", inputCols=cols, smoothing=smoothing, minSamplesLeaf=min_samples_leaf,
                           labelCol=label).fit(train).transform(df)


def encode_count(train: DataFrame, df: DataFrame, cols: list[str]) -> DataFrame:
    return CategoryEncoder(kind="count", inputCols=cols).fit(train).transform(df)


def encode_ordinal(train: DataFrame, df: DataFrame, cols: list[str], id_col: str = K.ROW_ID) -> DataFrame:
    return CategoryEncoder(kind="ordinal", inputCols=cols, idCol=id_col).fit(train).transform(df)


def scale_standard(train: DataFrame, df: DataFrame, cols: list[str]) -> DataFrame:
    return PopulationScaler(inputCols=cols).fit(train).transform(df)


def select_passthrough(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols)
