"""Soft-voting ensemble: scoring, decision, weight and threshold tuning
(SURVEY 2.10).

Tuning sweeps are single passes: each row meets the fixed 216-triple weight
grid in the pipeline and a partial aggregate folds it at once (at most 216
rows per task reach the shuffle), and the 61 thresholds are one histogram
of "highest threshold reached" by label, summed over at most 62 bins.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credspark import constants as K
from credspark.operators.evaluate import R, cost_exprs, evaluate_model, metric_exprs, roc_auc
from credspark.operators.models import score_models
from credspark.session import materialize


def vote_expr(weights=None, models=None) -> Column:
    weights = [float(w) for w in (weights or K.ENSEMBLE_WEIGHTS)]
    models = models or K.MODEL_ORDER
    num = None
    for w, m in zip(weights, models):
        t = F.lit(w) * F.col(f"proba_{m}")
        num = t if num is None else num + t
    return num / F.lit(sum(weights))


def soft_vote(df: DataFrame, weights=None, models=None, name: str = "ensemble_proba") -> DataFrame:
    """Weighted mean of the model probabilities, order lrc, rfc, svc."""
    return df.withColumn(name, vote_expr(weights, models))


def predict_threshold(df: DataFrame, threshold: float = K.ENSEMBLE_THRESHOLD,
                      proba: str = "ensemble_proba", name: str = "ensemble_pred") -> DataFrame:
    """1 when the probability is at least the threshold (inclusive)."""
    return df.withColumn(name, (F.col(proba) >= F.lit(float(threshold))).cast("int"))


def predict_details(df: DataFrame, weights=None, threshold: float = K.ENSEMBLE_THRESHOLD,
                    models=None, id_col: str = K.ROW_ID) -> DataFrame:
    """Each model's class (at 0.5) and probability, and the ensemble's."""
    models = models or K.MODEL_ORDER
    cols = [id_col]
    for m in models:
        cols += [(F.col(f"proba_{m}") >= 0.5).cast("int").alias(f"pred_{m}"), F.col(f"proba_{m}")]
    e = vote_expr(weights, models)
    cols += [e.alias("ensemble_proba"), (e >= F.lit(float(threshold))).cast("int").alias("ensemble_pred")]
    return df.select(*cols)


def risk_labels(df: DataFrame, models=None, id_col: str = K.ROW_ID, weights=None,
                threshold: float = K.ENSEMBLE_THRESHOLD) -> DataFrame:
    """Per model: risk = 1 - P(good); 'High Risk' when P(good) < 0.5; the same for
    the weighted vote of all models, with its own threshold, and its percent text.

    Polarity follows the data (class 1 = good), not the web form's text."""
    models = models or K.MODEL_ORDER
    cols = [id_col]
    for m in models:
        p = F.col(f"proba_{m}")
        pct = F.round((F.lit(1.0) - p) * 100.0, 1)
        label = F.when(p >= 0.5, F.lit("Low Risk")).otherwise(F.lit("High Risk"))
        cols += [pct.alias(f"risk_pct_{m}"), label.alias(f"risk_label_{m}")]
    e = vote_expr(weights, models)
    risk = F.round((F.lit(1.0) - e) * 100.0, 1)
    cols += [risk.alias("risk_pct_ensemble"), F.concat(risk.cast("string"), F.lit("%")).alias("risk_text_ensemble"),
             F.when(e >= F.lit(float(threshold)), F.lit("Low Risk")).otherwise(F.lit("High Risk"))
             .alias("risk_label_ensemble")]
    return df.select(*cols)


def weight_grid(weight_range=None) -> list[tuple[int, float, float, float]]:
    """(grid position, w_lrc, w_rfc, w_svc) in nested-loop order."""
    wr = [float(w) for w in (weight_range or K.WEIGHT_RANGE)]
    return [(i, a, b, c) for i, (a, b, c) in enumerate(product(wr, wr, wr))]


def weight_grid_search(df: DataFrame, threshold: float = 0.5, weight_range=None, label: str = K.TARGET,
                       models=None, cost_fp: float = K.COST_FP, cost_fn: float = K.COST_FN) -> DataFrame:
    """Cost, average cost, F1 (and counts) for every weight triple at a fixed
    threshold, in one scan.

    Each row meets the fixed grid (216 literal triples, generated in the
    pipeline) and is folded at once by the partial aggregate, so every task
    emits at most 216 rows to the shuffle whatever its input size."""
    grid = weight_grid(weight_range)
    models = models or K.MODEL_ORDER
    pos = F.col(label) == K.POSITIVE
    g = F.array(*[F.struct(F.lit(i).alias("grid_pos"), F.lit(a).alias("w_lrc"), F.lit(b).alias("w_rfc"),
                           F.lit(c).alias("w_svc")) for i, a, b, c in grid])
    x = df.select(pos.alias("_pos"), *[F.col(f"proba_{m}") for m in models], F.explode(g).alias("_g"))
    w = [F.col("_g.w_lrc"), F.col("_g.w_rfc"), F.col("_g.w_svc")]
    e = (w[0] * F.col(f"proba_{models[0]}") + w[1] * F.col(f"proba_{models[1]}")
         + w[2] * F.col(f"proba_{models[2]}")) / (w[0] + w[1] + w[2])
    hit = e >= F.lit(float(threshold))
    s = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    long = x.groupBy(F.col("_g.grid_pos").alias("grid_pos"), F.col("_g.w_lrc").alias("w_lrc"),
                     F.col("_g.w_rfc").alias("w_rfc"), F.col("_g.w_svc").alias("w_svc")).agg(
        s(hit & F.col("_pos")).alias("tp"), s(hit & ~F.col("_pos")).alias("fp"),
        s(~hit & F.col("_pos")).alias("fn"), s(~hit & ~F.col("_pos")).alias("tn"),
        F.count(F.lit(1)).alias("n"))
    c, m = cost_exprs(cost_fp, cost_fn), metric_exprs()
    return long.select("grid_pos", "w_lrc", "w_rfc", "w_svc", "tp", "fp", "fn", "tn",
                       c["total_cost"].cast("double").alias("cost"), c["avg_cost"], m["f1"])


def topk_by_cost(results: DataFrame, k: int = 10, order_cols=("grid_pos",)) -> DataFrame:
    """k best rows by cost; ties kept in grid order (a stable sort).  The limit
    is the feature here (a top-k report)."""
    return results.orderBy("cost", *order_cols).limit(k)


def grid_auc(df: DataFrame, grid_rows: DataFrame, label: str = K.TARGET, models=None) -> DataFrame:
    """Exact AUC for a *small* set of weight triples (e.g. the top ten):
    one probability column per triple, stacked, ranked per triple."""
    triples = [(r["grid_pos"], r["w_lrc"], r["w_rfc"], r["w_svc"]) for r in grid_rows.collect()]  # <= k rows
    cols = [F.col(label)] + [vote_expr([a, b, c], models).alias(f"e{i}") for i, a, b, c in triples]
    wide = df.select(*cols)
    stack = ", ".join(f"{i}, e{i}" for i, *_ in triples)
    long = wide.selectExpr(label, f"stack({len(triples)}, {stack}) as (grid_pos, ensemble_proba)")
    return roc_auc(long, label, "ensemble_proba", ["grid_pos"])


def _threshold_index(p: Column, lo: int, hi: int, scale: int) -> Column:
    """Largest i in [lo, hi] with i/scale <= p (lo-1 if none), exactly as the
    comparisons p >= i/scale would decide."""
    c = F.floor(p * scale).cast("int")
    c = F.when((c + 1) / F.lit(scale) <= p, c + 1).when(c / F.lit(scale) > p, c - 1).otherwise(c)
    return F.greatest(F.least(c, F.lit(hi)), F.lit(lo - 1))


def threshold_sweep(df: DataFrame, proba: str = "ensemble_proba", label: str = K.TARGET,
                    lo: int = 20, hi: int = 80, scale: int = 100, cost_fp: float = K.COST_FP,
                    cost_fn: float = K.COST_FN) -> DataFrame:
    """Cost, F1, precision, recall at thresholds i/scale, i = lo..hi, in one pass."""
    idx = _threshold_index(F.col(proba), lo, hi, scale)
    pos = F.col(label) == K.POSITIVE
    h = df.groupBy(idx.alias("k")).agg(F.sum(F.when(pos, 1).otherwise(0)).alias("pos"),
                                       F.sum(F.when(pos, 0).otherwise(1)).alias("neg"))
    thr = F.broadcast(df.sparkSession.range(lo, hi + 1).select(F.col("id").cast("int").alias("i")))
    # bins and thresholds: at most (hi - lo + 2) rows each
    j = thr.join(h, F.col("k") >= F.col("i"), "left")
    g = j.groupBy("i").agg(F.coalesce(F.sum("pos"), F.lit(0)).cast("bigint").alias("tp"),
                           F.coalesce(F.sum("neg"), F.lit(0)).cast("bigint").alias("fp"))
    # totals from the histogram itself (every row is in exactly one bin): no second pass
    tot = h.agg((F.sum("pos") + F.sum("neg")).cast("bigint").alias("n"), F.sum("pos").cast("bigint").alias("P"))
    g = g.crossJoin(tot)  # one row
    g = g.select((F.col("i") / F.lit(scale)).alias("threshold"), "i", "n", "tp", "fp",
                 (F.col("P") - F.col("tp")).alias("fn"), (F.col("n") - F.col("P") - F.col("fp")).alias("tn"))
    c, m = cost_exprs(cost_fp, cost_fn), metric_exprs()
    return g.select("threshold", "tp", "fp", "fn", "tn", c["total_cost"].cast("double").alias("cost"),
                    c["avg_cost"], m["f1"], m["precision"], m["recall"])


def tune_ensemble(df: DataFrame, label: str = K.TARGET, weight_range=None, lo: int = 20, hi: int = 80,
                  fixed_threshold: float = 0.5) -> DataFrame:
    """Weights first (least cost at the fixed threshold, grid order on ties),
    then the threshold (least cost, lowest threshold on ties), then the final
    evaluation with both.  One row."""
    models = K.MODEL_ORDER
    # three passes follow (grid, sweep, final): compute the narrow input once
    df = materialize(df.select(label, *[f"proba_{m}" for m in models]))
    grid = weight_grid_search(df, fixed_threshold, weight_range, label)
    # The winners are single rows: resolve them once (a bounded collect) so
    # later stages do not recompute the grid and can use literals.
    b = grid.orderBy("cost", "grid_pos").select("w_lrc", "w_rfc", "w_svc").first()
    weights = [b["w_lrc"], b["w_rfc"], b["w_svc"]]
    scored = df.select("*", *[F.lit(w).alias(n) for w, n in zip(weights, ("w_lrc", "w_rfc", "w_svc"))],
                       vote_expr(weights).alias("ensemble_proba"))
    sweep = threshold_sweep(scored, "ensemble_proba", label, lo, hi)
    t = sweep.orderBy("cost", "threshold").select("threshold").first()["threshold"]
    final = scored.withColumn("threshold", F.lit(t)) \
        .withColumn("ensemble_pred", (F.col("ensemble_proba") >= F.lit(t)).cast("int"))
    pos = F.col(label) == K.POSITIVE
    pp = F.col("ensemble_pred") == K.POSITIVE
    s = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    g = final.groupBy("w_lrc", "w_rfc", "w_svc", "threshold").agg(
        s(~pos & ~pp).alias("tn"), s(~pos & pp).alias("fp"), s(pos & ~pp).alias("fn"), s(pos & pp).alias("tp"),
        F.count(F.lit(1)).alias("n"))
    c, m = cost_exprs(), metric_exprs()
    auc = roc_auc(final, label, "ensemble_proba")
    return g.select("w_lrc", "w_rfc", "w_svc", "threshold", "tp", "fp", "fn", "tn",
                    c["total_cost"].cast("double").alias("cost"), c["avg_cost"],
                    *[v.alias(k) for k, v in m.items()]).crossJoin(auc)


def train_ensemble(train: DataFrame, valid: DataFrame, fit: Callable[[DataFrame], dict]) -> tuple[dict, list[float], float]:
    """(models, weights, threshold): the models fitted on ``train``; weights and threshold of least cost on
    ``valid``, which no model has seen."""
    models = fit(train)
    best = tune_ensemble(score_models(models, valid)).first()
    return models, [best[f"w_{m}"] for m in K.MODEL_ORDER], best["threshold"]


def score_ensemble(df: DataFrame, weights=None, threshold: float = K.ENSEMBLE_THRESHOLD,
                   label: str = K.TARGET) -> DataFrame:
    """Score with fixed weights and threshold, then evaluate: one row of
    metrics named as the run log names them."""
    s = predict_threshold(soft_vote(df, weights), threshold)
    e = evaluate_model(s, label, "ensemble_proba", "ensemble_pred", with_ap=False)  # one pass over rows
    return e.select("n", "tn", "fp", "fn", "tp", *[F.col(k).alias(f"val_{k}") for k in metric_exprs()],
                    F.col("total_cost").alias("val_cost"), F.col("avg_cost").alias("val_avg_cost"),
                    F.col("roc_auc").alias("val_roc_auc"))
