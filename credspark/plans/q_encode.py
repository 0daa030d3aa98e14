"""Catalog: encoders and feature pipelines.

Each query fits on the hash-split train side and encodes the held-out
side; results are compared in long form (row_id, feature, value) because
one-hot column names depend on the fitted levels.
"""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from credspark import constants as K
from credspark.operators import encoders as EC
from credspark.operators import features as FE
from credspark.operators.pipelines import EncodingPlan, baseline_spec, spec_for
from credspark.plans.common import apps, held_out, sql, train_side
from credspark.plans.q_features import engineered_view

Q: dict = {}
S: dict = {}


def _split_fe(spark, d, dup=False):
    fe = FE.feature_engineer(apps(spark, d), dup)
    return train_side(fe), held_out(fe)


def _long(df, cols):
    wide = df.select("row_id", *[F.col(f"`{c}`").cast("double").alias(c) for c in cols])
    return wide.unpivot(["row_id"], cols, "feature", "value").select(
        "row_id", "feature", F.round("value", 6).alias("value"))


# ------------------------------------------------------------- SQL parts

def _views(dup=False):
    from credspark.plans.common import TEST_PRED, TRAIN_PRED
    fe = engineered_view(dup)
    return (f", fe AS ({fe}), tr AS (SELECT * FROM fe WHERE {TRAIN_PRED}),"
            f" te AS (SELECT * FROM fe WHERE {TEST_PRED})"
            ", tot AS (SELECT CAST(sum(class) AS DOUBLE) AS P, count(*) AS NN, avg(CAST(class AS DOUBLE)) AS prior"
            " FROM tr)")


def onehot_sql(c):
    lv = (f"(SELECT level, row_number() OVER (ORDER BY min(row_id), level) AS rk FROM"
          f" (SELECT CAST({c} AS VARCHAR) AS level, row_id FROM tr WHERE {c} IS NOT NULL) GROUP BY level)")
    return (f"SELECT te.row_id, regexp_replace(replace(replace(replace('{c}_' || lv.level, '<', 'lt'), '>', 'gt'), '=', 'eq'),"
            f" '[^0-9A-Za-z_]+', '_', 'g') AS feature,"
            f" CAST(CASE WHEN CAST(te.{c} AS VARCHAR) = lv.level THEN 1 ELSE 0 END AS DOUBLE) AS value"
            f" FROM te CROSS JOIN {lv} lv")


def _lookup_sql(c, stat_sql, unseen, missing):
    return (f"SELECT te.row_id, '{c}' AS feature, CASE WHEN te.{c} IS NULL THEN {missing}"
            f" ELSE coalesce(s.v, {unseen}) END AS value FROM te LEFT JOIN ({stat_sql}) s"
            f" ON CAST(te.{c} AS VARCHAR) = s.level")


def woe_sql(c, a=1.0):
    st = (f"SELECT CAST({c} AS VARCHAR) AS level, CASE WHEN count(*) = 1 THEN 0.0 ELSE"
          f" ln(((sum(class) + {a}) / (any_value(P) + {2 * a})) / ((count(*) - sum(class) + {a})"
          f" / (any_value(NN) - any_value(P) + {2 * a}))) END AS v FROM tr, tot WHERE {c} IS NOT NULL GROUP BY 1")
    return _lookup_sql(c, st, "0.0", "0.0")


def target_sql(c, s=1.0, k=20):
    w = f"(1.0 / (1.0 + exp(-(count(*) - {float(k)}) / {float(s)})))"
    st = (f"SELECT CAST({c} AS VARCHAR) AS level, any_value(prior) * (1 - {w}) + avg(CAST(class AS DOUBLE)) * {w}"
          f" AS v FROM tr, tot WHERE {c} IS NOT NULL GROUP BY 1")
    return _lookup_sql(c, st, "(SELECT prior FROM tot)", "(SELECT prior FROM tot)")


def count_sql(c):
    st = (f"SELECT CAST({c} AS VARCHAR) AS level, count(*) / any_value(CAST(NN AS DOUBLE)) AS v FROM tr, tot"
          f" WHERE {c} IS NOT NULL GROUP BY 1")
    return _lookup_sql(c, st, "0.0", "0.0")


def ordinal_sql(c):
    st = (f"SELECT level, CAST(row_number() OVER (ORDER BY min(row_id), level) AS DOUBLE) AS v FROM"
          f" (SELECT CAST({c} AS VARCHAR) AS level, row_id FROM tr WHERE {c} IS NOT NULL) GROUP BY level")
    return _lookup_sql(c, st, "-1.0", "-2.0")


def scale_sql(c):
    return (f"SELECT te.row_id, '{c}' AS feature, (CAST(te.{c} AS DOUBLE) - st.m) / CASE WHEN st.s IS NULL OR st.s = 0"
            f" THEN 1.0 ELSE st.s END AS value FROM te CROSS JOIN (SELECT avg(CAST({c} AS DOUBLE)) AS m,"
            f" stddev_pop(CAST({c} AS DOUBLE)) AS s FROM tr) st")


def pass_sql(c):
    return f"SELECT row_id, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM te"


def spec_sql(spec: dict, dup: bool = False) -> str:
    parts = [onehot_sql(c) for c in spec.get("onehot", [])]
    parts += [woe_sql(c) for c in spec.get("woe", [])]
    parts += [scale_sql(c) for c in spec.get("scale", [])]
    parts += [target_sql(c, spec.get("target_smoothing", 1.0)) for c in spec.get("target", [])]
    parts += [count_sql(c) for c in spec.get("count", [])]
    parts += [ordinal_sql(c) for c in spec.get("ordinal", [])]
    parts += [pass_sql(c) for c in spec.get("passthrough", [])]
    return sql(_views(dup) + ", u AS (" + " UNION ALL ".join(parts) + ")"
               " SELECT row_id, feature, round(value, 6) AS value FROM u")


# ----------------------------------------------------------- single encoders

ONEHOT_COLS = ["purpose", "housing", "present_residence_since", "age_group"]


def q_encode_onehot(spark, d):
    tr, te = _split_fe(spark, d)
    m = EC.OneHotAllEncoder(inputCols=ONEHOT_COLS).fit(tr)
    return _long(m.transform(te), m.output_columns())


Q["encode_onehot"] = q_encode_onehot
S["encode_onehot"] = spec_sql({"onehot": ONEHOT_COLS})

WOE_COLS = K.PIPELINE_COLUMNS["lrc"]["woe"]


def q_encode_woe(spark, d):
    tr, te = _split_fe(spark, d)
    return _long(EC.encode_woe(tr, te, WOE_COLS), WOE_COLS)


Q["encode_woe"] = q_encode_woe
S["encode_woe"] = spec_sql({"woe": WOE_COLS})

TARGET_COLS = ["job", "housing", "property"]


def q_encode_target(spark, d):
    tr, te = _split_fe(spark, d)
    return _long(EC.encode_target(tr, te, TARGET_COLS, smoothing=1.0), TARGET_COLS)


Q["encode_target"] = q_encode_target
S["encode_target"] = spec_sql({"target": TARGET_COLS, "target_smoothing": 1.0})


def q_encode_target_s5(spark, d):
    tr, te = _split_fe(spark, d)
    return _long(EC.encode_target(tr, te, ["property", "purpose"], smoothing=5.0), ["property", "purpose"])


Q["encode_target_smoothing5"] = q_encode_target_s5
S["encode_target_smoothing5"] = spec_sql({"target": ["property", "purpose"], "target_smoothing": 5.0})

COUNT_COLS = K.PIPELINE_COLUMNS["lrc"]["count"]


def q_encode_count(spark, d):
    tr, te = _split_fe(spark, d)
    return _long(EC.encode_count(tr, te, COUNT_COLS), COUNT_COLS)


Q["encode_count"] = q_encode_count
S["encode_count"] = spec_sql({"count": COUNT_COLS})

ORD_COLS = ["installment_rate_pct_of_disp_income", "job", "checking_account_status", "age_group"]


def q_encode_ordinal(spark, d):
    tr, te = _split_fe(spark, d)
    return _long(EC.encode_ordinal(tr, te, ORD_COLS), ORD_COLS)


Q["encode_ordinal"] = q_encode_ordinal
S["encode_ordinal"] = spec_sql({"ordinal": ORD_COLS})

SCALE_COLS = ["credit_log", "duration_to_age_ratio", "savings_amount"]


def q_scale_standard(spark, d):
    tr, te = _split_fe(spark, d)
    return _long(EC.scale_standard(tr, te, SCALE_COLS), SCALE_COLS)


Q["scale_standard"] = q_scale_standard
S["scale_standard"] = spec_sql({"scale": SCALE_COLS})

PASS_COLS = K.PIPELINE_COLUMNS["rfc"]["passthrough"]


def q_select_passthrough(spark, d):
    _, te = _split_fe(spark, d)
    return _long(EC.select_passthrough(te, ["row_id"] + PASS_COLS), PASS_COLS)


Q["select_passthrough"] = q_select_passthrough
S["select_passthrough"] = spec_sql({"passthrough": PASS_COLS})


# --------------------------------------------------------------- pipelines

def _pipeline_query(kind):
    def q(spark, d):
        dup = K.PIPELINE_COLUMNS[kind]["duplicate_checking"]
        tr, te = _split_fe(spark, d, dup)
        m = EncodingPlan(spec=json.dumps(spec_for(kind)), keepCols=["row_id"], assemble=False).fit(tr)
        return _long(m.transform(te), m.feature_columns())
    return q


for _k in ("svc", "lrc", "rfc"):
    Q[f"pipeline_{_k}"] = _pipeline_query(_k)
    S[f"pipeline_{_k}"] = spec_sql(spec_for(_k), K.PIPELINE_COLUMNS[_k]["duplicate_checking"])


def q_pipeline_baseline(spark, d):
    a = apps(spark, d).drop("savings_amount")
    tr, te = train_side(a), held_out(a)
    spec = baseline_spec(a, ["row_id", "class"])
    m = EncodingPlan(spec=json.dumps(spec), keepCols=["row_id"], assemble=False).fit(tr)
    return _long(m.transform(te), m.feature_columns())


def _baseline_sql():
    from credspark.sources.fixtures import APPLICATION_COLUMNS
    cols = [c for c in APPLICATION_COLUMNS if c not in ("row_id", "class", "savings_amount")]
    cat = [c for c in cols if c in K.CODEBOOK or c == "checking_account_status"]
    num = [c for c in cols if c not in cat]
    from credspark.plans.common import TEST_PRED, TRAIN_PRED
    views = (f", tr AS (SELECT * FROM applications WHERE {TRAIN_PRED}), te AS (SELECT * FROM applications"
             f" WHERE {TEST_PRED})")
    parts = [onehot_sql(c) for c in cat] + [scale_sql(c) for c in num]
    return sql(views + ", u AS (" + " UNION ALL ".join(parts) + ") SELECT row_id, feature, round(value, 6) AS value"
               " FROM u")


Q["pipeline_baseline"] = q_pipeline_baseline
S["pipeline_baseline"] = _baseline_sql()
