"""Feature pipelines: engineering + per-column encoders + assembly.

``EncodingPlan`` is the counterpart of a column transformer with
``remainder='drop'``: it fits every encoder of a spec on the training side
and its model emits the kept id/label columns, the encoded feature columns
and (optionally) one ``features`` vector for an ML estimator.  Built from
these, ``build_pipeline(kind)`` returns a ``pyspark.ml.Pipeline`` that can
be given whole to ``CrossValidator`` (encoders refit inside every fold).
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable, MLReadable, MLWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credspark import constants as K
from credspark.operators.encoders import (KINDS, STATE_SCHEMA, FeatureEngineerTransformer, StateTable, apply_states,
                                          level_counts, level_stats, onehot_exprs, onehot_levels, onehot_names,
                                          split_states)


class EncodingPlan(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    spec = Param(Params._dummy(), "spec", "encoder spec (JSON)", TypeConverters.toString)
    keepCols = Param(Params._dummy(), "keepCols", "non-feature columns kept", TypeConverters.toListString)
    assemble = Param(Params._dummy(), "assemble", "add a features vector", TypeConverters.toBoolean)
    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, spec="{}", keepCols=None, assemble=True, labelCol=K.TARGET):
        super().__init__()
        self._setDefault(keepCols=[K.ROW_ID, K.TARGET], assemble=True, labelCol=K.TARGET)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame):
        """Two aggregates whatever the spec: per-(column, level) statistics of every
        categorical column at once, and one row of totals and scaler moments."""
        spec = json.loads(self.getOrDefault("spec"))
        label = self.getOrDefault("labelCol")
        scale = spec.get("scale", [])
        y = F.col(label).cast("double") if label in df.columns else F.lit(0.0)
        tot = df.agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("pos"),
                     *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(scale)],
                     *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(scale)]).first()
        nn, p = tot["n"], tot["pos"] or 0.0
        fitted: dict = {"prior": p / nn if nn else 0.0}
        if scale:
            fitted["scale"] = {c: [tot[f"m{i}"], tot[f"s{i}"]] for i, c in enumerate(scale)}
        cats = list(dict.fromkeys(c for k in ("onehot", *KINDS) for c in spec.get(k, [])))
        state = df.sparkSession.createDataFrame([], STATE_SCHEMA)
        if cats:
            stats = level_stats(df, cats, label)
            counts = level_counts(stats)
            if spec.get("onehot"):
                fitted["onehot"] = onehot_levels(stats, counts, spec["onehot"])
            fitted["maps"], state = split_states(spec, stats, counts, nn, p)
        model = EncodingPlanModel(spec=json.dumps(spec), fitted=json.dumps(fitted),
                                  keepCols=self.getOrDefault("keepCols"), assemble=self.getOrDefault("assemble"))
        model.state = state
        return model


class EncodingPlanModel(StateTable, Model, MLReadable, MLWritable):
    spec = Param(Params._dummy(), "spec", "encoder spec (JSON)", TypeConverters.toString)
    fitted = Param(Params._dummy(), "fitted", "fitted states (JSON)", TypeConverters.toString)
    keepCols = Param(Params._dummy(), "keepCols", "non-feature columns kept", TypeConverters.toListString)
    assemble = Param(Params._dummy(), "assemble", "add a features vector", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, spec="{}", fitted="{}", keepCols=None, assemble=True):
        super().__init__()
        self._set(**self._input_kwargs)

    def feature_columns(self) -> list[str]:
        spec, fitted = json.loads(self.getOrDefault("spec")), json.loads(self.getOrDefault("fitted"))
        cols = [n for c in spec.get("onehot", []) for n in onehot_names(c, fitted.get("onehot", {}).get(c, []))]
        for part in ("woe", "scale", "target", "count", "ordinal", "passthrough"):
            cols += spec.get(part, [])
        return cols

    def _transform(self, df: DataFrame) -> DataFrame:
        spec, fitted = json.loads(self.getOrDefault("spec")), json.loads(self.getOrDefault("fitted"))
        out = apply_states(df, fitted.get("maps", {}), self.state, spec, fitted["prior"])
        sel = []
        scale = fitted.get("scale", {})
        keep = [c for c in self.getOrDefault("keepCols") if c in df.columns]
        sel += [F.col(c) for c in keep]
        sel += onehot_exprs(spec.get("onehot", []), fitted.get("onehot", {}))
        for part in ("woe", "scale", "target", "count", "ordinal", "passthrough"):
            for c in spec.get(part, []):
                if part == "scale":
                    m, s = scale[c]
                    s = s if s not in (None, 0.0) else 1.0
                    sel.append(((F.col(c).cast("double") - F.lit(m)) / F.lit(s)).alias(c))
                else:
                    sel.append(F.col(c).cast("double").alias(c))
        out = out.select(*sel)
        if self.getOrDefault("assemble"):
            out = VectorAssembler(inputCols=self.feature_columns(), outputCol="features",
                                  handleInvalid="keep").transform(out)
        return out


def spec_for(kind: str) -> dict:
    s = dict(K.PIPELINE_COLUMNS[kind])
    return {k: v for k, v in s.items() if k != "duplicate_checking"}


def build_pipeline(kind: str, keep_cols: list[str] | None = None, assemble: bool = True,
                   label: str = K.TARGET) -> Pipeline:
    """Feature engineering + the model's encoders, ready for an estimator."""
    keep = keep_cols or [K.ROW_ID, label]
    dup = K.PIPELINE_COLUMNS[kind]["duplicate_checking"]
    return Pipeline(stages=[FeatureEngineerTransformer(duplicateChecking=dup),
                            EncodingPlan(spec=json.dumps(spec_for(kind)), keepCols=keep, assemble=assemble,
                                         labelCol=label)])


def baseline_spec(df: DataFrame, exclude: list[str] | None = None) -> dict:
    """One-hot every string column, scale every numeric column (by dtype)."""
    exclude = set(exclude or [K.ROW_ID, K.TARGET])
    cat, num = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, T.StringType):
            cat.append(f.name)
        elif isinstance(f.dataType, T.NumericType):
            num.append(f.name)
    return {"onehot": cat, "scale": num}


def build_baseline(df: DataFrame, keep_cols: list[str] | None = None, assemble: bool = True) -> Pipeline:
    keep = keep_cols or [K.ROW_ID, K.TARGET]
    return Pipeline(stages=[EncodingPlan(spec=json.dumps(baseline_spec(df, keep)), keepCols=keep,
                                         assemble=assemble)])
