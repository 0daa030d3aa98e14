"""Catalog: splits (2.8), ranks (2.6), evaluation and ensemble (2.10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from credspark import constants as K
from credspark.functions.hashing import duck_md5_bucket
from credspark.operators import ensemble as EN
from credspark.operators import evaluate as EV
from credspark.operators import splits as SP
from credspark.operators.ranks import avg_rank
from credspark.plans.common import apps, dbl, r, round_doubles, scored_test, sql, train_side
from credspark.sources.fixtures import scored

Q: dict = {}
S: dict = {}

W = K.ENSEMBLE_WEIGHTS
ENS_SQL = (f"({dbl(W[0])} * proba_lrc + {dbl(W[1])} * proba_rfc + {dbl(W[2])} * proba_svc)"
           f" / {dbl(float(sum(W)))}")
THR = dbl(K.ENSEMBLE_THRESHOLD)
LONG_SQL = " UNION ALL ".join(
    f"SELECT row_id, class, '{m}' AS model, proba_{m} AS proba, CAST(proba_{m} >= {dbl(0.5)} AS INTEGER) AS pred"
    " FROM scored_test" for m in K.MODEL_ORDER)
ENS_TEST = (f", ens AS (SELECT *, {ENS_SQL} AS ensemble_proba FROM scored_test)"
            f", ensp AS (SELECT *, CAST(ensemble_proba >= {THR} AS INTEGER) AS ensemble_pred FROM ens)")


ENS_ALL = ENS_TEST.replace("FROM scored_test", "FROM scored")   # every row, for the row-wise operators


def ens_test(spark, d):
    return EN.predict_threshold(EN.soft_vote(scored_test(spark, d)))


def counts_sql(label="class", pred="ensemble_pred", pos=1):
    return (f"CAST(sum(CASE WHEN {label} <> {pos} AND {pred} <> {pos} THEN 1 ELSE 0 END) AS BIGINT) AS tn,"
            f" CAST(sum(CASE WHEN {label} <> {pos} AND {pred} = {pos} THEN 1 ELSE 0 END) AS BIGINT) AS fp,"
            f" CAST(sum(CASE WHEN {label} = {pos} AND {pred} <> {pos} THEN 1 ELSE 0 END) AS BIGINT) AS fn,"
            f" CAST(sum(CASE WHEN {label} = {pos} AND {pred} = {pos} THEN 1 ELSE 0 END) AS BIGINT) AS tp,"
            " count(*) AS n")


METRICS_SQL = (f"{r('CAST(tp + tn AS DOUBLE) / n')} AS accuracy,"
               f" {r('coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0)')} AS precision,"
               f" {r('coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0)')} AS recall,"
               f" {r('coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0)')} AS f1")
COST_SQL = (f"CAST(fp * {K.COST_FP} + fn * {K.COST_FN} AS DOUBLE) AS total_cost,"
            f" {r(f'CAST(fp * {K.COST_FP} + fn * {K.COST_FN} AS DOUBLE) / n')} AS avg_cost")


def auc_sql(src: str, score: str, group: str = "") -> str:
    """Rank AUC over distinct scores (per group)."""
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group} " if group else ""
    return (f"(SELECT {g}{r('(rs - p * (p + 1) / 2.0) / (p * (nn - p))')} AS roc_auc FROM ("
            f" SELECT {g}sum(n_pos * rk) AS rs, sum(n_pos) AS p, sum(n) AS nn FROM ("
            f"  SELECT {g}n, n_pos, sum(n) OVER ({part}ORDER BY {score} ROWS UNBOUNDED PRECEDING) - n"
            f"   + (n + 1) / 2.0 AS rk FROM ("
            f"   SELECT {g}{score}, count(*) AS n, sum(CASE WHEN class = 1 THEN 1 ELSE 0 END) AS n_pos"
            f"   FROM {src} WHERE {score} IS NOT NULL GROUP BY {g}{score})) {'GROUP BY ' + group if group else ''}))")


def ap_sql(src: str, score: str, group: str = "") -> str:
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group} " if group else ""
    return (f"(SELECT {g}{r('s / p')} AS average_precision FROM ("
            f" SELECT {g}sum(n_pos * tp / (tp + fp)) AS s, sum(n_pos) AS p FROM ("
            f"  SELECT {g}n_pos, sum(n_pos) OVER ({part}ORDER BY {score} DESC ROWS UNBOUNDED PRECEDING) AS tp,"
            f"   sum(n - n_pos) OVER ({part}ORDER BY {score} DESC ROWS UNBOUNDED PRECEDING) AS fp FROM ("
            f"   SELECT {g}{score}, count(*) AS n, sum(CASE WHEN class = 1 THEN 1 ELSE 0 END) AS n_pos"
            f"   FROM {src} GROUP BY {g}{score})) {'GROUP BY ' + group if group else ''}))")


# ------------------------------------------------------------------ splits

def q_hash_split(spark, d):
    return SP.hash_split(apps(spark, d)).select("row_id", "class", "split")


Q["hash_split"] = q_hash_split
S["hash_split"] = sql(
    f"SELECT row_id, class, CASE WHEN {duck_md5_bucket('CAST(row_id AS VARCHAR)')} < 150 THEN 'test' ELSE 'train'"
    " END AS split FROM applications")


def q_hash_split_by_column(spark, d):
    return SP.hash_split(apps(spark, d), 0.2, hash_column="checking_account_status") \
        .groupBy("split", "class").agg(F.count(F.lit(1)).alias("n"))


Q["hash_split_by_column"] = q_hash_split_by_column
S["hash_split_by_column"] = sql(
    "SELECT CASE WHEN "
    + duck_md5_bucket("checking_account_status || '_' || CAST(row_id AS VARCHAR)")
    + " < 200 THEN 'test' ELSE 'train' END AS split, class, count(*) AS n FROM applications GROUP BY ALL")

SPLIT_SQL = (f", s AS (SELECT class, CASE WHEN {duck_md5_bucket('CAST(row_id AS VARCHAR)')} < 150 THEN 'test'"
             " ELSE 'train' END AS split FROM applications)")


def q_split_stats(spark, d):
    return SP.split_stats(SP.hash_split(apps(spark, d)))


Q["split_stats"] = q_split_stats
S["split_stats"] = sql(
    SPLIT_SQL + ", g AS (SELECT split, class, count(*) AS n FROM s GROUP BY ALL)"
    " SELECT split, class, n, CAST(sum(n) OVER (PARTITION BY split) AS BIGINT) AS split_n,"
    " round(sum(n) OVER (PARTITION BY split) / sum(n) OVER (), 6) AS split_share,"
    " round(n / sum(n) OVER (PARTITION BY split), 6) AS class_share FROM g")


def q_class_distribution(spark, d):
    return SP.class_distribution(train_side(apps(spark, d)))


Q["class_distribution"] = q_class_distribution
S["class_distribution"] = sql(
    "SELECT class, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM app_train GROUP BY class")

KEY8 = duck_md5_bucket("'8_' || CAST(row_id AS VARCHAR)", SP.HASH_KEY_MOD)


def q_stratified_split(spark, d):
    s = SP.stratified_split(train_side(apps(spark, d)), size=150, seed=8)
    return s.filter(F.col("split") == "val").select("row_id", "class")


Q["stratified_split"] = q_stratified_split
S["stratified_split"] = sql(
    ", c AS (SELECT class, count(*) AS n FROM app_train GROUP BY class)"
    ", c2 AS (SELECT class, n, CAST(150 AS DOUBLE) * n / sum(n) OVER () AS ex FROM c)"
    ", c3 AS (SELECT class, floor(ex) AS base, ex - floor(ex) AS rem FROM c2)"
    ", c4 AS (SELECT class, base, 150 - sum(base) OVER () AS lft,"
    " row_number() OVER (ORDER BY rem DESC, class) AS pos FROM c3)"
    ", take AS (SELECT class, base + CASE WHEN pos <= lft THEN 1 ELSE 0 END AS n_take FROM c4)"
    f", rn AS (SELECT row_id, class, row_number() OVER (PARTITION BY class ORDER BY {KEY8}, row_id) AS rn"
    " FROM app_train)"
    " SELECT rn.row_id, rn.class FROM rn JOIN take USING (class) WHERE rn.rn <= take.n_take")


def q_kfold_assign(spark, d):
    return SP.kfold_assign(train_side(apps(spark, d)), k=5, seed=8).select("row_id", "class", "fold")


Q["kfold_assign"] = q_kfold_assign
S["kfold_assign"] = sql(
    f"SELECT row_id, class, CAST((row_number() OVER (PARTITION BY class ORDER BY {KEY8}, row_id) - 1) % 5 AS INTEGER)"
    " AS fold FROM app_train")


def q_class_weights(spark, d):
    return round_doubles(SP.class_weights(train_side(apps(spark, d)), "balanced"))


Q["class_weights"] = q_class_weights
S["class_weights"] = sql(
    "SELECT class, count(*) AS n, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight"
    " FROM app_train GROUP BY class")


# ------------------------------------------------------------------- ranks

def q_avg_rank(spark, d):
    a = apps(spark, d).select("row_id", "credit_amount", "duration_months")
    return avg_rank(avg_rank(a, "duration_months", name="rank_duration"), "credit_amount", name="rank_amount") \
        .select("row_id", "rank_duration", "rank_amount")


Q["avg_rank"] = q_avg_rank
S["avg_rank"] = sql(
    "SELECT row_id,"
    " rank() OVER (ORDER BY duration_months) + (count(*) OVER (PARTITION BY duration_months) - 1) / 2.0"
    " AS rank_duration,"
    " rank() OVER (ORDER BY credit_amount) + (count(*) OVER (PARTITION BY credit_amount) - 1) / 2.0"
    " AS rank_amount FROM applications")


def q_avg_rank_grouped(spark, d):
    a = apps(spark, d).select("row_id", "checking_account_status", "credit_amount")
    return avg_rank(a, "credit_amount", ["checking_account_status"], name="rank_in_status") \
        .select("row_id", "rank_in_status")


Q["avg_rank_grouped"] = q_avg_rank_grouped
S["avg_rank_grouped"] = sql(
    "SELECT row_id, rank() OVER (PARTITION BY checking_account_status ORDER BY credit_amount)"
    " + (count(*) OVER (PARTITION BY checking_account_status, credit_amount) - 1) / 2.0 AS rank_in_status"
    " FROM applications")


# -------------------------------------------------------------- evaluation

def q_confusion_counts(spark, d):
    return EV.confusion_counts(ens_test(spark, d))


Q["confusion_counts"] = q_confusion_counts
S["confusion_counts"] = sql(
    ENS_TEST + f", c AS (SELECT {counts_sql()} FROM ensp) SELECT tn, fp, fn, tp, n,"
    + ", ".join(f" {r(f'CAST({x} AS DOUBLE) / n')} AS {x}_share" for x in ("tn", "fp", "fn", "tp")) + " FROM c")


def q_cost_metric(spark, d):
    return EV.cost_metric(ens_test(spark, d))


Q["cost_metric"] = q_cost_metric
S["cost_metric"] = sql(ENS_TEST + f", c AS (SELECT {counts_sql()} FROM ensp) SELECT n, fp, fn, {COST_SQL} FROM c")


def q_class_metrics(spark, d):
    return EV.class_metrics(ens_test(spark, d))


Q["class_metrics"] = q_class_metrics
S["class_metrics"] = sql(ENS_TEST + f", c AS (SELECT {counts_sql()} FROM ensp) SELECT n, {METRICS_SQL} FROM c")


def q_roc_auc(spark, d):
    long = EV.model_long(scored_test(spark, d))
    return EV.roc_auc(long, score="proba", group_cols=["model"])


Q["roc_auc"] = q_roc_auc
S["roc_auc"] = sql(f", long AS ({LONG_SQL}) SELECT * FROM {auc_sql('long', 'proba', 'model')}")


def q_pr_curve(spark, d):
    return EV.pr_curve(ens_test(spark, d))


Q["pr_curve"] = q_pr_curve
S["pr_curve"] = sql(
    ENS_TEST + ", v AS (SELECT ensemble_proba, count(*) AS n, sum(CASE WHEN class = 1 THEN 1 ELSE 0 END) AS n_pos"
    " FROM ensp GROUP BY ensemble_proba)"
    ", c AS (SELECT ensemble_proba, sum(n_pos) OVER (ORDER BY ensemble_proba DESC ROWS UNBOUNDED PRECEDING) AS tp,"
    " sum(n - n_pos) OVER (ORDER BY ensemble_proba DESC ROWS UNBOUNDED PRECEDING) AS fp,"
    " sum(n_pos) OVER () AS P, sum(n) OVER () AS NN FROM v)"
    " SELECT ensemble_proba AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,"
    " round(tp / (tp + fp), 6) AS precision,"
    " round(tp / P, 6) AS recall, round(P / NN, 6) AS baseline FROM c")


def q_average_precision(spark, d):
    long = EV.model_long(scored_test(spark, d))
    return EV.average_precision(long, score="proba", group_cols=["model"])


Q["average_precision"] = q_average_precision
S["average_precision"] = sql(f", long AS ({LONG_SQL}) SELECT * FROM {ap_sql('long', 'proba', 'model')}")


def q_evaluate_model(spark, d):
    long = EV.model_long(scored_test(spark, d))
    return EV.evaluate_model(long, group_cols=["model"])


Q["evaluate_model"] = q_evaluate_model
S["evaluate_model"] = sql(
    f", long AS ({LONG_SQL}), c AS (SELECT model, {counts_sql(pred='pred')} FROM long GROUP BY model)"
    f" SELECT c.model, n, tn, fp, fn, tp, {METRICS_SQL}, {COST_SQL}, a.roc_auc, p.average_precision FROM c"
    f" JOIN {auc_sql('long', 'proba', 'model')} a USING (model) JOIN {ap_sql('long', 'proba', 'model')} p"
    " USING (model)")


def q_trivial_baselines(spark, d):
    return EV.trivial_baselines(scored_test(spark, d))


Q["trivial_baselines"] = q_trivial_baselines
S["trivial_baselines"] = sql(
    ", c AS (SELECT count(*) AS n, CAST(sum(CASE WHEN class = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_pos"
    " FROM scored_test) SELECT n, n_pos, n - n_pos AS n_neg,"
    f" CAST((n - n_pos) * {K.COST_FP} AS DOUBLE) AS accept_all_cost,"
    f" round(CAST((n - n_pos) * {K.COST_FP} AS DOUBLE) / n, 6) AS accept_all_avg_cost,"
    f" CAST(n_pos * {K.COST_FN} AS DOUBLE) AS reject_all_cost,"
    f" round(CAST(n_pos * {K.COST_FN} AS DOUBLE) / n, 6) AS reject_all_avg_cost FROM c")


# ---------------------------------------------------------------- ensemble

def q_soft_vote(spark, d):
    return round_doubles(EN.soft_vote(scored(spark, d)).select("row_id", "ensemble_proba"))


Q["soft_vote"] = q_soft_vote
S["soft_vote"] = sql(f"SELECT row_id, {r(ENS_SQL)} AS ensemble_proba FROM scored")


def q_predict_threshold(spark, d):
    return EN.predict_threshold(EN.soft_vote(scored(spark, d))).select("row_id", "class", "ensemble_pred")


Q["predict_threshold"] = q_predict_threshold
S["predict_threshold"] = sql(ENS_ALL + " SELECT row_id, class, ensemble_pred FROM ensp")


def q_predict_details(spark, d):
    return round_doubles(EN.predict_details(scored(spark, d)))


Q["predict_details"] = q_predict_details
S["predict_details"] = sql(
    "SELECT row_id, "
    + ", ".join(f"CAST(proba_{m} >= {dbl(0.5)} AS INTEGER) AS pred_{m}, {r(f'proba_{m}')} AS proba_{m}"
                for m in K.MODEL_ORDER)
    + f", {r(ENS_SQL)} AS ensemble_proba, CAST({ENS_SQL} >= {THR} AS INTEGER) AS ensemble_pred FROM scored")


def q_risk_labels(spark, d):
    return EN.risk_labels(scored(spark, d))


Q["risk_labels"] = q_risk_labels
S["risk_labels"] = sql(
    "SELECT row_id, "
    + ", ".join(f"round(({dbl(1.0)} - proba_{m}) * {dbl(100.0)}, 1) AS risk_pct_{m},"
                f" CASE WHEN proba_{m} >= {dbl(0.5)} THEN 'Low Risk' ELSE 'High Risk' END AS risk_label_{m}"
                for m in K.MODEL_ORDER)
    + f", round(({dbl(1.0)} - e) * {dbl(100.0)}, 1) AS risk_pct_ensemble,"
    f" CAST(round(({dbl(1.0)} - e) * {dbl(100.0)}, 1) AS VARCHAR) || '%' AS risk_text_ensemble,"
    f" CASE WHEN e >= {THR} THEN 'Low Risk' ELSE 'High Risk' END AS risk_label_ensemble"
    f" FROM (SELECT *, {ENS_SQL} AS e FROM scored)")


def q_score_ensemble(spark, d):
    return EN.score_ensemble(scored_test(spark, d))


Q["score_ensemble"] = q_score_ensemble
S["score_ensemble"] = sql(
    ENS_TEST + f", c AS (SELECT {counts_sql()} FROM ensp)"
    " SELECT n, tn, fp, fn, tp, "
    + METRICS_SQL.replace(" AS accuracy", " AS val_accuracy").replace(" AS precision", " AS val_precision")
    .replace(" AS recall", " AS val_recall").replace(" AS f1", " AS val_f1")
    + f", CAST(fp * {K.COST_FP} + fn * {K.COST_FN} AS DOUBLE) AS val_cost,"
    f" {r(f'CAST(fp * {K.COST_FP} + fn * {K.COST_FN} AS DOUBLE) / n')} AS val_avg_cost,"
    f" (SELECT roc_auc FROM {auc_sql('ensp', 'ensemble_proba')}) AS val_roc_auc FROM c")

GRID = EN.weight_grid()
GRID_SQL = "(VALUES " + ", ".join(f"({i}, {dbl(a)}, {dbl(b)}, {dbl(c)})" for i, a, b, c in GRID) + \
    ") AS g(grid_pos, w_lrc, w_rfc, w_svc)"
GRID_COUNTS = (
    f", gp AS (SELECT g.grid_pos, g.w_lrc, g.w_rfc, g.w_svc, s.class, (g.w_lrc * s.proba_lrc + g.w_rfc * s.proba_rfc"
    " + g.w_svc * s.proba_svc) / (g.w_lrc + g.w_rfc + g.w_svc) AS e FROM scored_test s, " + GRID_SQL + ")"
    f", gc AS (SELECT grid_pos, w_lrc, w_rfc, w_svc, {counts_sql(pred=f'CAST(e >= {dbl(0.5)} AS INTEGER)')}"
    " FROM gp GROUP BY ALL)"
    f", gr AS (SELECT grid_pos, w_lrc, w_rfc, w_svc, tp, fp, fn, tn,"
    f" CAST(fp * {K.COST_FP} + fn * {K.COST_FN} AS DOUBLE) AS cost,"
    f" {r(f'CAST(fp * {K.COST_FP} + fn * {K.COST_FN} AS DOUBLE) / n')} AS avg_cost,"
    f" {r('coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0)')} AS f1 FROM gc)")


def q_weight_grid_search(spark, d):
    return EN.weight_grid_search(scored_test(spark, d))


Q["weight_grid_search"] = q_weight_grid_search
S["weight_grid_search"] = sql(GRID_COUNTS + " SELECT * FROM gr")


def q_topk_by_cost(spark, d):
    top = EN.topk_by_cost(EN.weight_grid_search(scored_test(spark, d)), 10)
    return top.select("grid_pos", "w_lrc", "w_rfc", "w_svc", "cost", "avg_cost", "f1")


Q["topk_by_cost"] = q_topk_by_cost
S["topk_by_cost"] = sql(GRID_COUNTS + " SELECT grid_pos, w_lrc, w_rfc, w_svc, cost, avg_cost, f1 FROM gr"
                        " ORDER BY cost, grid_pos LIMIT 10")


def q_weight_grid_auc(spark, d):
    st = scored_test(spark, d)
    top = EN.topk_by_cost(EN.weight_grid_search(st), 10)
    return EN.grid_auc(st, top)


Q["weight_grid_auc"] = q_weight_grid_auc
S["weight_grid_auc"] = sql(
    GRID_COUNTS + ", top AS (SELECT grid_pos FROM gr ORDER BY cost, grid_pos LIMIT 10)"
    ", gpt AS (SELECT gp.grid_pos, gp.class, gp.e FROM gp JOIN top USING (grid_pos))"
    f" SELECT * FROM {auc_sql('gpt', 'e', 'grid_pos')}")

SWEEP_SQL = (
    ", th AS (SELECT i FROM range(20, 81) t(i))"
    ", sw AS (SELECT i, CAST(sum(CASE WHEN class = 1 AND ensemble_proba >= i / 100 THEN 1 ELSE 0 END) AS BIGINT) AS tp,"
    " CAST(sum(CASE WHEN class <> 1 AND ensemble_proba >= i / 100 THEN 1 ELSE 0 END) AS BIGINT) AS fp,"
    " CAST(sum(CASE WHEN class = 1 AND ensemble_proba < i / 100 THEN 1 ELSE 0 END) AS BIGINT) AS fn,"
    " CAST(sum(CASE WHEN class <> 1 AND ensemble_proba < i / 100 THEN 1 ELSE 0 END) AS BIGINT) AS tn, count(*) AS n"
    " FROM {src}, th GROUP BY i)"
    ", swr AS (SELECT i / 100 AS threshold, tp, fp, fn, tn,"
    f" CAST(fp * {K.COST_FP} + fn * {K.COST_FN} AS DOUBLE) AS cost,"
    f" {r(f'CAST(fp * {K.COST_FP} + fn * {K.COST_FN} AS DOUBLE) / n')} AS avg_cost,"
    f" {r('coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0)')} AS f1,"
    f" {r('coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0)')} AS precision,"
    f" {r('coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0)')} AS recall FROM sw)")


def q_threshold_sweep(spark, d):
    return EN.threshold_sweep(EN.soft_vote(scored_test(spark, d)))


Q["threshold_sweep"] = q_threshold_sweep
S["threshold_sweep"] = sql(ENS_TEST + SWEEP_SQL.replace("{src}", "ens") + " SELECT * FROM swr")


def q_tune_ensemble(spark, d):
    return EN.tune_ensemble(scored_test(spark, d))


Q["tune_ensemble"] = q_tune_ensemble
S["tune_ensemble"] = sql(
    GRID_COUNTS + ", best AS (SELECT w_lrc, w_rfc, w_svc FROM gr ORDER BY cost, grid_pos LIMIT 1)"
    ", ens AS (SELECT s.*, b.w_lrc, b.w_rfc, b.w_svc, (b.w_lrc * s.proba_lrc + b.w_rfc * s.proba_rfc"
    " + b.w_svc * s.proba_svc) / (b.w_lrc + b.w_rfc + b.w_svc) AS ensemble_proba FROM scored_test s, best b)"
    + SWEEP_SQL.replace("{src}", "ens")
    + ", bt AS (SELECT threshold FROM swr ORDER BY cost, threshold LIMIT 1)"
    ", fin AS (SELECT ens.*, bt.threshold, CAST(ensemble_proba >= bt.threshold AS INTEGER) AS ensemble_pred"
    " FROM ens, bt)"
    f", c AS (SELECT w_lrc, w_rfc, w_svc, threshold, {counts_sql()} FROM fin GROUP BY ALL)"
    f" SELECT w_lrc, w_rfc, w_svc, threshold, tp, fp, fn, tn,"
    f" CAST(fp * {K.COST_FP} + fn * {K.COST_FN} AS DOUBLE) AS cost,"
    f" {r(f'CAST(fp * {K.COST_FP} + fn * {K.COST_FN} AS DOUBLE) / n')} AS avg_cost, {METRICS_SQL},"
    f" (SELECT roc_auc FROM {auc_sql('fin', 'ensemble_proba')}) AS roc_auc FROM c")
