"""Catalog: sources, sinks, run log, registry, config, streaming.

Each query writes what it needs (derived from the driver's tables) into a
fresh folder under the session's shared checkpoint folder, then reads it
back through the operator under test.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from credspark import constants as K
from credspark.operators import ensemble as EN
from credspark.operators import evaluate as EV
from credspark.operators import models as M
from credspark.operators import splits as SP
from credspark.session import scratch
from credspark.sources import io as IO
from credspark.sources import registry as RG
from credspark.sources.fixtures import score_columns
from credspark.plans.common import apps, held_out, round_doubles, scored_test, sides, sql, train_side
from credspark.plans.q_eval import COST_SQL, ENS_ALL, LONG_SQL, METRICS_SQL, auc_sql, counts_sql

Q: dict = {}
S: dict = {}

REC_COLS = ["row_id"] + K.COLUMNS


def q_read_coded_text(spark, d):
    a = apps(spark, d)
    path = IO.write_coded_text(a, scratch(spark, "coded"))
    return IO.read_coded_text(spark, path).select(*REC_COLS)


Q["read_coded_text"] = q_read_coded_text
# positional ids equal the order keys, which are 0..n-1 in the derived view
S["read_coded_text"] = sql("SELECT row_number() OVER (ORDER BY row_id) - 1 AS row_id, "
                           + ", ".join(f"CAST({c} AS BIGINT) AS {c}" if c in K.NUMERIC_COLUMNS else c
                                       for c in K.COLUMNS) + " FROM applications")


def q_read_csv_typed(spark, d):
    a = apps(spark, d).select(*REC_COLS)
    path = scratch(spark, "csv")
    a.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return IO.read_csv_typed(spark, path)


Q["read_csv_typed"] = q_read_csv_typed
S["read_csv_typed"] = sql("SELECT " + ", ".join(REC_COLS) + " FROM applications")


def q_write_split(spark, d):
    path = IO.write_split(SP.hash_split(apps(spark, d)), scratch(spark, "split"))
    back = spark.read.parquet(path)
    return back.groupBy("split", "class").agg(F.count(F.lit(1)).alias("n"), F.sum("credit_amount").alias("amount"))


Q["write_split"] = q_write_split
S["write_split"] = sql(
    ", s AS (SELECT *, CASE WHEN row_id IN (SELECT row_id FROM app_test) THEN 'test' ELSE 'train' END AS split"
    " FROM applications) SELECT split, class, count(*) AS n, CAST(sum(credit_amount) AS BIGINT) AS amount FROM s GROUP BY ALL")


def q_class_head_sample(spark, d):
    return IO.class_head_sample(apps(spark, d), 50).select("row_id", "class", "credit_amount")


Q["class_head_sample"] = q_class_head_sample
S["class_head_sample"] = sql(
    "SELECT row_id, class, credit_amount FROM (SELECT *, row_number() OVER (PARTITION BY class ORDER BY row_id)"
    " AS rn FROM applications) WHERE rn <= 50")


def q_union_samples(spark, d):
    a = apps(spark, d)
    good, bad = a.filter(F.col("class") == 1), a.filter(F.col("class") == 0)
    return IO.union_samples(good, bad).select("row_id", "class", "purpose")


Q["union_samples"] = q_union_samples
S["union_samples"] = sql(
    "SELECT row_id, class, purpose FROM applications WHERE class = 1 UNION ALL"
    " SELECT row_id, class, purpose FROM applications WHERE class = 0")

SCORE_METRICS = ["n", "tn", "fp", "fn", "tp", "val_accuracy", "val_precision", "val_recall", "val_f1",
                 "val_cost", "val_avg_cost", "val_roc_auc"]


def q_log_run(spark, d):
    m = EN.score_ensemble(scored_test(spark, d))
    run = RG.log_run_from_metrics(m, scratch(spark, "runs"), "credit-risk-ensemble",
                                  "Ensemble_w2.5-1.5-3.0_t0.63", params={"voting_type": "soft"})
    return round_doubles(run.select("run_name", F.explode("metrics").alias("metric", "value")))


def _score_ensemble_sql_body():
    from credspark.plans.q_eval import S as ES
    return ES["score_ensemble"]


Q["log_run"] = q_log_run
S["log_run"] = (
    "WITH se AS (" + _score_ensemble_sql_body() + ") SELECT 'Ensemble_w2.5-1.5-3.0_t0.63' AS run_name, metric,"
    " round(CAST(value AS DOUBLE), 6) AS value FROM (UNPIVOT (SELECT " + ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}" for c in SCORE_METRICS) + " FROM se) ON " + ", ".join(SCORE_METRICS)
    + " INTO NAME metric VALUE value)")


def q_runs_leaderboard(spark, d):
    root = scratch(spark, "board")
    ev = EV.evaluate_model(EV.model_long(scored_test(spark, d)), group_cols=["model"])
    for m in K.MODEL_ORDER:
        RG.log_run_from_metrics(ev.filter(F.col("model") == m).drop("model"), root, "credit-risk", m)
    board = RG.runs_leaderboard(RG.read_runs(spark, root), ["roc_auc", "avg_cost", "f1"], "avg_cost")
    return round_doubles(board.drop("run_id"))


Q["runs_leaderboard"] = q_runs_leaderboard
S["runs_leaderboard"] = sql(
    f", long AS ({LONG_SQL}), c AS (SELECT model, {counts_sql(pred='pred')} FROM long GROUP BY model)"
    f", ev AS (SELECT c.model, {METRICS_SQL}, {COST_SQL}, a.roc_auc FROM c JOIN {auc_sql('long', 'proba', 'model')} a"
    " USING (model))"
    " SELECT model AS run_name, roc_auc, avg_cost, f1 FROM ev")


def _fit_small(spark, d):
    return M.train_logistic(train_side(apps(spark, d)))


def q_register_model(spark, d):
    root = scratch(spark, "registry")
    m = _fit_small(spark, d)
    RG.register_model(m, spark, root, "credit-risk-lrc", "run-a")
    RG.register_model(m, spark, root, "credit-risk-lrc", "run-b")
    return RG.model_versions(spark, root).select("name", "version", "run_id")


Q["register_model"] = q_register_model
S["register_model"] = ("SELECT 'credit-risk-lrc' AS name, CAST(version AS INTEGER) AS version, run_id"
                       " FROM (VALUES (1, 'run-a'), (2, 'run-b')) v(version, run_id)")


def q_resolve_model_version(spark, d):
    root = scratch(spark, "resolve")
    m = _fit_small(spark, d)
    for name in ("credit-risk-lrc", "credit-risk-rfc"):
        for run in ("r1", "r2", "r3"):
            RG.register_model(m, spark, root, name, f"{name}-{run}")
    v = RG.model_versions(spark, root)
    latest = RG.resolve_model_version(v, "latest").select(F.lit("latest").alias("query"), "name", "version")
    by_num = RG.resolve_model_version(v, 2).select(F.lit("2").alias("query"), "name", "version")
    by_run = RG.resolve_model_version(v, "credit-risk-rfc-r1").select(F.lit("run").alias("query"), "name", "version")
    loaded = RG.load_model(latest.join(v, ["name", "version"]).select("path").first()["path"])
    te = held_out(apps(spark, d))
    n_scored = loaded.transform(te).count()
    return latest.unionByName(by_num).unionByName(by_run).withColumn("n_scored_by_latest", F.lit(n_scored))


Q["resolve_model_version"] = q_resolve_model_version
S["resolve_model_version"] = sql(
    ", reg AS (SELECT name, run, row_number() OVER (PARTITION BY name ORDER BY run) AS version FROM"
    " (VALUES ('credit-risk-lrc'), ('credit-risk-rfc')) n(name), (VALUES ('r1'), ('r2'), ('r3')) r(run))"
    ", hit AS (SELECT 'latest' AS query, name, max(version) AS version FROM reg GROUP BY name"
    " UNION ALL SELECT '2', name, version FROM reg WHERE version = 2"
    " UNION ALL SELECT 'run', name, version FROM reg WHERE name = 'credit-risk-rfc' AND run = 'r1')"
    " SELECT query, name, CAST(version AS INTEGER) AS version,"
    " CAST((SELECT count(*) FROM app_test) AS INTEGER) AS n_scored_by_latest FROM hit")


def q_export_models(spark, d):
    root = scratch(spark, "export")
    tr, te = sides(spark, d)
    models = M.train_all(tr)
    for kind, m in models.items():
        RG.register_model(m, spark, root, f"credit-risk-{kind}")
    out = RG.export_models(spark, root, ["credit-risk-lrc", "credit-risk-rfc", "credit-risk-svc"],
                           os.path.join(root, "exported"))
    paths = {r["name"]: r["path"] for r in out.collect()}       # a row for each model
    counts = [(n, RG.load_model(p).transform(te).filter("proba between 0 and 1").count()) for n, p in paths.items()]
    return out.join(spark.createDataFrame(counts, "name string, n_scored int"), "name").select(
        "name", "version", "n_scored")


Q["export_models"] = q_export_models
S["export_models"] = sql(
    " SELECT 'credit-risk-' || m AS name, CAST(1 AS INTEGER) AS version,"
    " CAST((SELECT count(*) FROM app_test) AS INTEGER) AS n_scored FROM (VALUES ('lrc'), ('rfc'), ('svc')) k(m)")


def q_load_ensemble_config(spark, d):
    """Tune the ensemble on the held-out scores, write its config, read it back."""
    t = EN.tune_ensemble(scored_test(spark, d)).first()
    path = RG.write_ensemble_config(spark, scratch(spark, "config"), [t["w_lrc"], t["w_rfc"], t["w_svc"]],
                                    t["threshold"], ["credit-risk-lrc", "credit-risk-rfc", "credit-risk-svc"])
    return RG.load_ensemble_config(spark, path)


def _config_sql():
    from credspark.plans.q_eval import S as ES
    te = ES["tune_ensemble"]
    return ("WITH t AS (" + te + ") SELECT CAST(0 AS INTEGER) AS position, 'credit-risk-lrc' AS component,"
            " w_lrc AS weight, threshold FROM t UNION ALL SELECT 1, 'credit-risk-rfc', w_rfc, threshold FROM t"
            " UNION ALL SELECT 2, 'credit-risk-svc', w_svc, threshold FROM t")


Q["load_ensemble_config"] = q_load_ensemble_config
S["load_ensemble_config"] = _config_sql()


def q_stream_soft_vote(spark, d):
    """Applications arrive as files; the stand-in scores, soft vote
    and threshold run as a Structured Streaming query into a Parquet sink."""
    from credspark.streaming.score_stream import read_stream, run_to_sink, stream_transform
    src = scratch(spark, "stream-src")
    apps(spark, d).write.parquet(src)        # as many files as the scan has parts
    schema = spark.read.parquet(src).schema
    stream = stream_transform(read_stream(spark, src, schema),
                              lambda df: EN.predict_threshold(EN.soft_vote(score_columns(df))))
    sink = scratch(spark, "stream-sink")
    run_to_sink(stream.select("row_id", "class", "ensemble_proba", "ensemble_pred"), sink,
                scratch(spark, "stream-ckpt"))
    return round_doubles(spark.read.parquet(sink))


Q["stream_soft_vote"] = q_stream_soft_vote
S["stream_soft_vote"] = sql(ENS_ALL + " SELECT row_id, class, round(ensemble_proba, 6) AS ensemble_proba,"
                            " ensemble_pred FROM ensp")
