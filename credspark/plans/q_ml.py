"""Catalog: training, tuning, inspection and resampling.

Trained-model outputs depend on solver details, so most of these are
rows-only; the operators that work on given scores (linear score, threshold
tuning over folds, search convergence, diagnosis rules) have SQL twins.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from credspark import constants as K
from credspark.functions.hashing import duck_md5_bucket
from credspark.operators import ensemble as EN
from credspark.operators import evaluate as EV
from credspark.operators import features as FE
from credspark.operators import models as M
from credspark.operators import resample as RS
from credspark.operators import splits as SP
from credspark.operators import tuning as TU
from credspark.operators.pipelines import build_pipeline
from credspark.plans.common import apps, held_out, r, round_doubles, scored_test, sides, sql, train_side  # noqa: F401
from credspark.plans.q_eval import GRID_COUNTS, auc_sql
from credspark.session import materialize, scratch, written
from credspark.sources import registry as RG
from credspark.sources.fixtures import APPLICATION_COLUMNS, scored

Q: dict = {}
S: dict = {}


_sides = sides


def _preds(model, te):
    return round_doubles(model.transform(te).select(K.ROW_ID, K.TARGET, "proba"))


def q_train_logistic(spark, d):
    tr, te = _sides(spark, d)
    return _preds(M.train_logistic(tr, C=1.0), te)


def q_train_forest(spark, d):
    tr, te = _sides(spark, d)
    return _preds(M.train_forest(tr), te)


def q_train_kernel_svm(spark, d):
    tr, te = _sides(spark, d)
    return _preds(M.train_kernel_svm(tr), te)


def q_train_boosted_trees(spark, d):
    tr, te = _sides(spark, d)
    return _preds(M.train_boosted_trees(tr), te)


Q["train_logistic"] = q_train_logistic
Q["train_forest"] = q_train_forest
Q["train_kernel_svm"] = q_train_kernel_svm
Q["train_boosted_trees"] = q_train_boosted_trees

LIN = {"credit_log": -0.35, "duration_log": -0.6, "no_checking": 0.9, "monthly_burden_log": 0.1, "age_years": 0.015}
LIN_B = 4.0


def q_linear_score(spark, d):
    fe = FE.feature_engineer(apps(spark, d))
    return round_doubles(M.linear_score(fe, LIN, LIN_B).select(K.ROW_ID, "proba"))


def _lin_sql():
    from credspark.plans.q_features import engineered_view
    z = f"CAST({LIN_B!r} AS DOUBLE)" + "".join(f" + CAST({w!r} AS DOUBLE) * CAST({c} AS DOUBLE)" for c, w in LIN.items())
    return sql(f", fe AS ({engineered_view()}) SELECT row_id, {r(f'1.0 / (1.0 + exp(-({z})))')} AS proba FROM fe")


Q["linear_score"] = q_linear_score
S["linear_score"] = _lin_sql()


def q_coefficient_ranking(spark, d):
    tr, _ = _sides(spark, d)
    return round_doubles(M.coefficient_ranking(M.train_logistic(tr), spark))


def q_importance_ranking(spark, d):
    tr, _ = _sides(spark, d)
    return round_doubles(M.importance_ranking(M.train_forest(tr), spark))


Q["coefficient_ranking"] = q_coefficient_ranking
Q["importance_ranking"] = q_importance_ranking


def _search_query(model: str, resample=None):
    """Trials of a whole search on the train side: as many trials and folds as the operator's defaults."""
    def q(spark, d):
        tr, _ = _sides(spark, d)
        trials, _best = TU.tune_search(tr, model, resample=resample)
        return round_doubles(trials.select("trial", F.to_json("params").alias("params"), "score", "n_folds"))
    return q


q_tune_search = _search_query("lrc")
Q["tune_search"] = q_tune_search
Q["tune_search_smote"] = _search_query("lrc", RS.smote)
Q["tune_search_svc"] = _search_query("svc")


def q_tune_threshold_trained(spark, d):
    """Out-of-fold scores of a trained model, and the threshold of least cost on them."""
    tr, _ = _sides(spark, d)
    _per, best = TU.tune_threshold_cv(TU.oof_predictions(tr, _fit_lr), 100)
    return round_doubles(best)


Q["tune_threshold_trained"] = q_tune_threshold_trained


def q_search_convergence(spark, d):
    """Best-so-far over the weight-grid trials (trial = grid position, score = -cost)."""
    g = EN.weight_grid_search(scored_test(spark, d)).select(F.col("grid_pos").alias("trial"),
                                                           (-F.col("cost")).alias("score"))
    return TU.search_convergence(g)


Q["search_convergence"] = q_search_convergence
S["search_convergence"] = sql(
    GRID_COUNTS + " SELECT grid_pos AS trial, -cost AS score, max(-cost) OVER (ORDER BY grid_pos"
    " ROWS UNBOUNDED PRECEDING) AS best_so_far FROM gr")


def q_tune_threshold_cv(spark, d):
    s = SP.kfold_assign(scored(spark, d), k=5, seed=8).withColumnRenamed("proba_lrc", "proba")
    per, best = TU.tune_threshold_cv(s.select("fold", K.TARGET, "proba"), 100)
    b = best.select(F.col("i").alias("_bi"))
    return round_doubles(per.crossJoin(b).select("i", "threshold", "mean_cost", "n_folds",
                                                  (F.col("i") == F.col("_bi")).alias("is_best")))


KEY8 = duck_md5_bucket("'8_' || CAST(row_id AS VARCHAR)", SP.HASH_KEY_MOD)
Q["tune_threshold_cv"] = q_tune_threshold_cv
S["tune_threshold_cv"] = sql(
    f", f AS (SELECT class, proba_lrc AS p, (row_number() OVER (PARTITION BY class ORDER BY {KEY8}, row_id) - 1) % 5"
    " AS fold FROM scored)"
    ", rg AS (SELECT min(p) AS lo, max(p) AS hi FROM f)"
    ", c AS (SELECT i, CASE WHEN i = 99 THEN hi ELSE lo + i * ((hi - lo) / 99) END AS t FROM range(0, 100) r(i), rg)"
    ", fc AS (SELECT fold, i, t, sum(CASE WHEN class <> 1 AND p >= t THEN 1 ELSE 0 END) * 5"
    " + sum(CASE WHEN class = 1 AND p < t THEN 1 ELSE 0 END) * 1 AS cost FROM f, c GROUP BY fold, i, t)"
    ", per AS (SELECT i, t, avg(CAST(cost AS DOUBLE)) AS mc, count(*) AS nf FROM fc GROUP BY i, t)"
    ", best AS (SELECT i AS bi FROM per ORDER BY mc, i LIMIT 1)"
    " SELECT CAST(i AS INTEGER) AS i, round(t, 6) AS threshold, round(mc, 6) AS mean_cost, nf AS n_folds,"
    " i = bi AS is_best FROM per, best")


_fit_lr = M.LogisticFit()


def q_learning_curve(spark, d):
    tr, _ = _sides(spark, d)
    curve = TU.learning_curve(tr, _fit_lr)
    return round_doubles(curve.withColumn("diagnosis", F.concat_ws("; ", "diagnosis")))


Q["learning_curve"] = q_learning_curve


def q_learning_diagnosis(spark, d):
    """The four rules on each stand-in model's train-side vs held-out AUC."""
    s = SP.hash_split(scored(spark, d))
    long = EV.model_long(s.withColumnRenamed("split", "_split"))
    long = long.join(s.select(K.ROW_ID, "split"), K.ROW_ID)
    auc = EV.roc_auc(long, score="proba", group_cols=["model", "split"])
    w = auc.groupBy("model").pivot("split", ["train", "test"]).agg(F.first("roc_auc"))
    out = TU.learning_diagnosis(w.select("model", F.col("train").alias("train_auc"), F.col("test").alias("val_auc")))
    return round_doubles(out.select("model", "train_auc", "val_auc", "gap",
                                    F.concat_ws("; ", "diagnosis").alias("diagnosis")))


def _diag_sql():
    parts = []
    for m in K.MODEL_ORDER:
        for side, pred in (("train", ">="), ("test", "<")):
            src = (f"(SELECT class, proba_{m} FROM scored WHERE "
                   f"{duck_md5_bucket('CAST(row_id AS VARCHAR)')} {pred} 150)")
            parts.append(f"SELECT '{m}' AS model, '{side}' AS side, (SELECT roc_auc FROM {auc_sql(src, f'proba_{m}')})"
                         " AS auc")
    return sql(
        ", a AS (" + " UNION ALL ".join(parts) + ")"
        ", w AS (SELECT model, max(CASE WHEN side = 'train' THEN auc END) AS tr, max(CASE WHEN side = 'test'"
        " THEN auc END) AS va FROM a GROUP BY model)"
        " SELECT model, tr AS train_auc, va AS val_auc, round(tr - va, 6) AS gap, concat_ws('; ',"
        " CASE WHEN va < 0.70 THEN 'low_score' END, CASE WHEN tr - va > 0.10 THEN 'high_variance' END,"
        " CASE WHEN tr - va < 0.05 AND va < 0.75 THEN 'high_bias' END,"
        " CASE WHEN va > 0.75 AND tr - va < 0.10 THEN 'balanced' END)"
        " AS diagnosis FROM w")


Q["learning_diagnosis"] = q_learning_diagnosis
S["learning_diagnosis"] = _diag_sql()

#: Every feature column of an application.
PERM_COLS = [c for c in APPLICATION_COLUMNS if c not in (K.ROW_ID, K.TARGET)]


def q_permutation_importance(spark, d):
    tr, te = _sides(spark, d)
    m = M.train_logistic(tr)
    return round_doubles(TU.permutation_importance(m, te, PERM_COLS))


Q["permutation_importance"] = q_permutation_importance

#: Raw columns of the given linear score, and its weights on them.
PERM_LIN = {"credit_amount": -0.0002, "duration_months": -0.05, "age_years": 0.02, "existing_credits_count": -0.3}
PERM_LIN_B, PERM_REPEATS, PERM_SEED = 3.0, 10, 42


def q_permutation_importance_linear(spark, d):
    """Importance of every column of a given linear score on the held-out side."""
    te = held_out(apps(spark, d)).select(K.ROW_ID, K.TARGET, *PERM_LIN)
    score = lambda df: M.linear_score(df, PERM_LIN, PERM_LIN_B)
    return round_doubles(TU.permutation_importance(score, te, list(PERM_LIN), PERM_REPEATS, PERM_SEED))


def _perm_sql():
    def once(x, rep):
        left, right = f"({x} // h)", f"({x} % h)"
        cols = []
        for k, (a, b, c) in enumerate(TU.shuffle_constants(PERM_SEED)):
            cols.append((f"l{k}", f"r{k}", a, b, c))
        # nested selects: one for each round
        inner = f"SELECT {left} AS l, {right} AS r"
        for _, _, a, b, c in cols:
            y = f"((r * {a} + {rep} * {c} + {b}) % {TU._PRIME})"
            inner = f"SELECT r AS l, (l + ({y} * {y} + {c}) % {TU._PRIME}) % h AS r FROM ({inner})"
        return f"(SELECT l * h + r FROM ({inner}))"

    z = f"CAST({PERM_LIN_B!r} AS DOUBLE)" + "".join(
        f" + CAST({w!r} AS DOUBLE) * CAST({{{c}}} AS DOUBLE)" for c, w in PERM_LIN.items())
    plain = {c: f"t.{c}" for c in PERM_LIN}
    score = lambda names: f"1.0 / (1.0 + exp(-({z.format(**names)})))"
    copies = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, w.rep, t.class, {score({**plain, c: f'u.{c}'})} AS p"
        " FROM walked w JOIN t ON t.i = w.i JOIN t u ON u.i = w.j" for c in PERM_LIN)
    return sql(
        ", t AS (SELECT *, row_number() OVER (ORDER BY row_id) - 1 AS i FROM app_test)"
        ", k AS (SELECT count(*) AS n, CAST(floor(sqrt(count(*) - 1)) AS BIGINT) + 1 AS h FROM t)"
        f", f0 AS (SELECT t.i, rep, n, h FROM t, k, range(0, {PERM_REPEATS}) g(rep))"
        f", f1 AS (SELECT i, rep, n, h, {once('i', 'rep')} AS j FROM f0)"
        + "".join(f", f{m + 1} AS (SELECT i, rep, n, h, CASE WHEN j < n THEN j ELSE {once('j', 'rep')} END AS j FROM f{m})"
                  for m in range(1, 9)) +
        ", walked AS (SELECT i, rep, j FROM f9)"
        f", s AS ({copies} UNION ALL SELECT NULL, NULL, class, {score(plain)} FROM t)"
        ", v AS (SELECT feature, rep, p, count(*) AS n, sum(class) AS n_pos FROM s GROUP BY feature, rep, p)"
        ", r AS (SELECT *, sum(n) OVER (PARTITION BY feature, rep ORDER BY p) - n + (n + 1) / 2.0 AS rank FROM v)"
        ", a AS (SELECT feature, rep, round((sum(n_pos * rank) - sum(n_pos) * (sum(n_pos) + 1) / 2.0)"
        " / (sum(n_pos) * (sum(n) - sum(n_pos))), 6) AS auc FROM r GROUP BY feature, rep)"
        ", d AS (SELECT a.feature, b.auc - a.auc AS dr FROM a, (SELECT auc FROM a WHERE feature IS NULL) b"
        " WHERE a.feature IS NOT NULL)"
        " SELECT feature, round(avg(dr), 6) AS importance_mean, round(stddev_pop(dr), 6) AS importance_std,"
        " count(*) AS repeats FROM d GROUP BY feature")


Q["permutation_importance_linear"] = q_permutation_importance_linear
S["permutation_importance_linear"] = _perm_sql()


def q_feature_gain(spark, d):
    tr, _ = _sides(spark, d)
    base_cols = [c for c in tr.columns if c != "savings_amount"]
    tr = tr.select(*base_cols)
    return round_doubles(TU.feature_gain(tr, _fit_lr, M.LogisticFit(None)))


Q["feature_gain"] = q_feature_gain


def q_seed_stability(spark, d):
    tr, te = _sides(spark, d)
    _, summary = TU.seed_stability(tr, te, lambda df, s: M.train_forest(df, seed=s))
    return round_doubles(summary)


Q["seed_stability"] = q_seed_stability


def q_train_all(spark, d):
    """End to end: train the three models on the train side, score the held-out
    side, soft-vote with the deployed weights and threshold, evaluate."""
    tr, te = _sides(spark, d)
    models = M.train_all(tr)
    s = M.score_models(models, te)
    return round_doubles(EN.score_ensemble(s))


Q["train_all"] = q_train_all


def q_ensemble_trained(spark, d):
    """The whole way of the deployed ensemble: three models trained on one part of the train side, weights and
    threshold tuned on the rest, configuration written and read back, held-out side scored and the run logged."""
    tr, te = _sides(spark, d)
    parts = written(SP.stratified_split(tr, 0.15), "ensemble")
    part = lambda side: parts.filter(F.col("split") == side).drop("split")
    models, weights, threshold = EN.train_ensemble(part("fit"), part("val"), M.train_all)
    root = scratch(spark, "ensemble-run")
    names = [f"credit-risk-{m}" for m in K.MODEL_ORDER]
    config = RG.load_ensemble_config(spark, RG.write_ensemble_config(spark, f"{root}/config", weights, threshold, names))
    rows = config.orderBy("position").collect()     # a row for each model
    out = materialize(EN.score_ensemble(M.score_models(models, te), [r["weight"] for r in rows], rows[0]["threshold"]))
    params = {f"w_{m}": r["weight"] for m, r in zip(K.MODEL_ORDER, rows)} | {"threshold": rows[0]["threshold"]}
    run = RG.log_run_from_metrics(out, root, "credit-risk", "ensemble", params=params)
    return run.select("run_name", F.to_json(F.map_from_entries(F.array_sort(F.map_entries("params")))).alias("params"),
                      F.explode("metrics").alias("metric", "value")).select("run_name", "params", "metric",
                                                                            F.round("value", 6).alias("value"))


Q["ensemble_trained"] = q_ensemble_trained


def q_train_svc_smote(spark, d):
    """The kernel SVM on rows rebalanced by SVM-SMOTE, calibrated, on the held-out side."""
    tr, te = _sides(spark, d)
    return _preds(M.train_kernel_svm(tr, resample=RS.svm_smote), te)


Q["train_svc_smote"] = q_train_svc_smote


def _encoded_train(spark, d):
    tr, _ = _sides(spark, d)
    return build_pipeline("lrc").fit(tr).transform(tr)


def _resampled_summary(df):
    return round_doubles(df.select(K.ROW_ID, K.TARGET, "synthetic",
                                   F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, b: a + b)
                                   .alias("feature_sum")))


def q_smote(spark, d):
    return _resampled_summary(RS.smote(_encoded_train(spark, d), k=5, ratio=1.0, seed=8))


def q_svm_smote(spark, d):
    return _resampled_summary(RS.svm_smote(_encoded_train(spark, d), k=5, m=10, ratio=1.0, seed=8))


Q["smote"] = q_smote
Q["svm_smote"] = q_svm_smote


def q_class_weights_forest(spark, d):
    """Forest trained with the cost-matching weights {0: 5, 1: 1}."""
    tr, te = _sides(spark, d)
    return _preds(M.train_forest(tr, class_weight={0: 5.0, 1: 1.0}), te)


Q["train_forest_cost_weights"] = q_class_weights_forest


def q_smote_neighbours(spark, d):
    """SMOTE's neighbour stage on the embeddings table: the 5 nearest vectors
    of the same label for every vector (exact; ties by the smaller id)."""
    e = spark.read.parquet(f"{d}/embeddings.parquet").select(
        F.col("vec_id").alias(K.ROW_ID), F.col("label").alias(K.TARGET), "label",
        F.transform("embedding", lambda v: v.cast("double")).alias("x"))
    nb = RS.knn(e, e, 5, group_col="label")
    return nb.select(F.col(K.ROW_ID).alias("vec_id"), F.posexplode("nbr_ids").alias("pos", "nbr_id")) \
        .select("vec_id", (F.col("pos") + 1).cast("int").alias("rank"), "nbr_id")


Q["smote_neighbours"] = q_smote_neighbours
S["smote_neighbours"] = (
    "WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),"
    " d AS (SELECT a.vec_id, b.vec_id AS nbr_id, list_sum(list_transform(range(1, len(a.v) + 1),"
    " lambda i: (a.v[i] - b.v[i]) * (a.v[i] - b.v[i]))) AS d2 FROM e a JOIN e b ON a.label = b.label"
    " AND a.vec_id <> b.vec_id),"
    " r AS (SELECT vec_id, nbr_id, row_number() OVER (PARTITION BY vec_id ORDER BY d2, nbr_id) AS rk FROM d)"
    " SELECT vec_id, CAST(rk AS INTEGER) AS rank, nbr_id FROM r WHERE rk <= 5")
