"""Evaluation: confusion counts, cost, class metrics, exact ROC AUC, PR curve,
average precision (SURVEY 2.10).

All metrics are one grouped aggregate (partial aggregation map-side).  AUC
and the PR curve need order: they work on *distinct scores with label
counts* and the bucketed running totals of ``ranks``, never a window over
raw rows and never a join back to rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credspark import constants as K
from credspark.operators.ranks import running_totals, value_counts
from credspark.session import materialize

R = 6  # rounding of reported doubles


def _counts_aggs(label: Column, pred: Column, positive=K.POSITIVE) -> list[Column]:
    pos, pp = label == positive, pred == positive
    s = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    return [s(~pos & ~pp).alias("tn"), s(~pos & pp).alias("fp"),
            s(pos & ~pp).alias("fn"), s(pos & pp).alias("tp"),
            F.count(F.lit(1)).alias("n")]


def confusion_counts(df: DataFrame, label: str = K.TARGET, pred: str = "ensemble_pred",
                     group_cols: list[str] | None = None) -> DataFrame:
    """tn, fp, fn, tp (always all four) and their shares of n."""
    g = df.groupBy(*(group_cols or [])).agg(*_counts_aggs(F.col(label), F.col(pred)))
    return g.select("*", *[F.round(F.col(c) / F.col("n"), R).alias(f"{c}_share") for c in ("tn", "fp", "fn", "tp")])


def cost_exprs(cost_fp: float = K.COST_FP, cost_fn: float = K.COST_FN) -> dict[str, Column]:
    total = F.col("fp") * cost_fp + F.col("fn") * cost_fn
    return {"total_cost": total.alias("total_cost"),
            "avg_cost": F.round(F.try_divide(total, F.col("n")), R).alias("avg_cost")}


def metric_exprs() -> dict[str, Column]:
    tp, fp, fn, tn, n = (F.col(c) for c in ("tp", "fp", "fn", "tn", "n"))
    z = lambda e: F.coalesce(e, F.lit(0.0))  # noqa: E731  (0 on empty denominators)
    precision = z(F.try_divide(tp, tp + fp))
    recall = z(F.try_divide(tp, tp + fn))
    m = {
        "accuracy": F.round(F.try_divide(tp + tn, n), R),
        "precision": F.round(precision, R),
        "recall": F.round(recall, R),
        "f1": F.round(z(F.try_divide(2 * tp, 2 * tp + fp + fn)), R),
    }
    return {k: v.alias(k) for k, v in m.items()}


def cost_metric(df: DataFrame, label: str = K.TARGET, pred: str = "ensemble_pred",
                group_cols: list[str] | None = None, cost_fp: float = K.COST_FP,
                cost_fn: float = K.COST_FN) -> DataFrame:
    g = df.groupBy(*(group_cols or [])).agg(*_counts_aggs(F.col(label), F.col(pred)))
    c = cost_exprs(cost_fp, cost_fn)
    return g.select(*(group_cols or []), "n", "fp", "fn",
                    c["total_cost"].cast("double").alias("total_cost"), c["avg_cost"])


def row_cost(df: DataFrame, label: str = K.TARGET, pred: str = "ensemble_pred",
             cost_fp: float = K.COST_FP, cost_fn: float = K.COST_FN, name: str = "row_cost") -> DataFrame:
    """Per-row cost: accepting a bad applicant costs ``cost_fp``, rejecting a good one ``cost_fn``."""
    y, p = F.col(label), F.col(pred)
    return df.withColumn(name, F.when((y != K.POSITIVE) & (p == K.POSITIVE), float(cost_fp))
                         .when((y == K.POSITIVE) & (p != K.POSITIVE), float(cost_fn)).otherwise(0.0))


def class_metrics(df: DataFrame, label: str = K.TARGET, pred: str = "ensemble_pred",
                  group_cols: list[str] | None = None) -> DataFrame:
    g = df.groupBy(*(group_cols or [])).agg(*_counts_aggs(F.col(label), F.col(pred)))
    m = metric_exprs()
    return g.select(*(group_cols or []), "n", *[v.alias(k) for k, v in m.items()])


def roc_auc(df: DataFrame, label: str = K.TARGET, score: str = "ensemble_proba",
            group_cols: list[str] | None = None, n_buckets: int | None = None) -> DataFrame:
    """Exact ROC AUC with ties: (sum of positive ranks - P(P+1)/2) / (P N),
    ranks averaged over ties, computed on distinct scores per group."""
    group_cols = list(group_cols or [])
    v = materialize(value_counts(df, score, group_cols, label))  # one scan; cut points and sums read v
    return _auc_from_counts(v, score, group_cols, n_buckets)


def _auc_from_counts(v: DataFrame, score: str, group_cols: list[str], n_buckets: int | None = None) -> DataFrame:
    """AUC from one row per distinct (group, score) with n and n_pos."""
    cum = running_totals(v, score, ["n"], group_cols, n_buckets=n_buckets)
    r = cum.select(*v.columns, (F.col("n_cum") - F.col("n") + (F.col("n") + 1) / 2.0).alias("rank"))
    g = r.groupBy(*group_cols).agg(F.sum(F.col("n_pos") * F.col("rank")).alias("_rs"),
                                   F.sum("n_pos").alias("_p"), F.sum("n").alias("_n"))
    p, q = F.col("_p"), F.col("_n") - F.col("_p")
    auc = F.try_divide(F.col("_rs") - p * (p + 1) / 2.0, p * q)
    return g.select(*group_cols, F.round(auc, R).alias("roc_auc"))


def auc_from_counts(v: DataFrame, score: str) -> DataFrame:
    """AUC from one row per distinct score with n and n_pos, without groups."""
    return _auc_from_counts(v, score, [])


def pr_curve(df: DataFrame, label: str = K.TARGET, score: str = "ensemble_proba",
             group_cols: list[str] | None = None, n_buckets: int | None = None) -> DataFrame:
    """Precision and recall when predicting positive for score >= threshold,
    at every distinct score (descending running sums), plus the baseline
    (share of positives)."""
    group_cols = list(group_cols or [])
    v = materialize(value_counts(df, score, group_cols, label)).withColumn("_neg", -F.col(score).cast("double"))
    v = v.withColumn("n_neg", F.col("n") - F.col("n_pos"))
    cum = running_totals(v, "_neg", ["n_pos", "n_neg"], group_cols, n_buckets=n_buckets)
    tot = v.groupBy(*group_cols).agg(F.sum("n_pos").alias("_P"), F.sum("n").alias("_N"))
    tot = F.broadcast(tot) if not group_cols else tot
    j = cum.join(tot, on=group_cols, how="inner") if group_cols else cum.crossJoin(tot)
    tp, fp = F.col("n_pos_cum"), F.col("n_neg_cum")
    return j.select(*group_cols, F.col(score).alias("threshold"), tp.alias("tp"), fp.alias("fp"),
                    F.round(F.try_divide(tp, tp + fp), R).alias("precision"),
                    F.round(F.try_divide(tp, F.col("_P")), R).alias("recall"),
                    F.round(F.try_divide(F.col("_P"), F.col("_N")), R).alias("baseline"))


def average_precision(df: DataFrame, label: str = K.TARGET, score: str = "ensemble_proba",
                      group_cols: list[str] | None = None, n_buckets: int | None = None) -> DataFrame:
    """Step-form AP = sum over thresholds of (R_n - R_{n-1}) P_n
    = sum over distinct scores of n_pos * precision / P (not trapezoidal)."""
    group_cols = list(group_cols or [])
    v = materialize(value_counts(df, score, group_cols, label))  # one scan; cut points and sums read v
    return _ap_from_counts(v, score, group_cols, n_buckets)


def _ap_from_counts(v: DataFrame, score: str, group_cols: list[str], n_buckets: int | None = None) -> DataFrame:
    v = v.withColumn("_neg", -F.col(score).cast("double")).withColumn("n_neg", F.col("n") - F.col("n_pos"))
    cum = running_totals(v, "_neg", ["n_pos", "n_neg"], group_cols, n_buckets=n_buckets)
    prec = F.col("n_pos_cum") / (F.col("n_pos_cum") + F.col("n_neg_cum"))
    g = cum.groupBy(*group_cols).agg(F.sum(F.col("n_pos") * prec).alias("_s"), F.sum("n_pos").alias("_p"))
    return g.select(*group_cols, F.round(F.try_divide(F.col("_s"), F.col("_p")), R).alias("average_precision"))


def model_long(df: DataFrame, models: list[str] | None = None, label: str = K.TARGET,
               threshold: float = 0.5, id_col: str = K.ROW_ID) -> DataFrame:
    """(row_id, class, model, proba, pred) for each model's probability column."""
    models = models or K.MODEL_ORDER
    long = df.select(id_col, label, *[f"proba_{m}" for m in models]) \
        .unpivot([id_col, label], [f"proba_{m}" for m in models], "model", "proba")
    return long.select(id_col, label, F.regexp_replace("model", "^proba_", "").alias("model"), "proba",
                       (F.col("proba") >= threshold).cast("int").alias("pred"))


def evaluate_model(df: DataFrame, label: str = K.TARGET, score: str = "proba", pred: str = "pred",
                   group_cols: list[str] | None = None, cost_fp: float = K.COST_FP,
                   cost_fn: float = K.COST_FN, with_ap: bool = True) -> DataFrame:
    """All metrics for each group (model): counts, accuracy, precision, recall,
    F1, ROC AUC, average precision, total and average cost."""
    group_cols = list(group_cols or [])
    # ONE pass over the rows: counts per (group, score, prediction), kept in
    # the shared checkpoint folder; every metric below reads that table.
    pos = F.col(label) == K.POSITIVE
    sc = materialize(df.groupBy(*group_cols, score, pred).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(pos, 1).otherwise(0)).alias("n_pos")))
    pp = F.col(pred) == K.POSITIVE
    s = lambda e: F.sum(e).cast("bigint")
    g = sc.groupBy(*group_cols).agg(
        s(F.when(~pp | F.col(pred).isNull(), F.col("n") - F.col("n_pos")).otherwise(0)).alias("tn"),
        s(F.when(pp, F.col("n") - F.col("n_pos")).otherwise(0)).alias("fp"),
        s(F.when(~pp | F.col(pred).isNull(), F.col("n_pos")).otherwise(0)).alias("fn"),
        s(F.when(pp, F.col("n_pos")).otherwise(0)).alias("tp"), s(F.col("n")).alias("n"))
    m, c = metric_exprs(), cost_exprs(cost_fp, cost_fn)
    base = g.select(*group_cols, "n", "tn", "fp", "fn", "tp", *[v.alias(k) for k, v in m.items()],
                    c["total_cost"].cast("double").alias("total_cost"), c["avg_cost"])
    v = sc.filter(F.col(score).isNotNull()).groupBy(*group_cols, score).agg(
        F.sum("n").alias("n"), F.sum("n_pos").alias("n_pos"))
    auc = _auc_from_counts(v, score, group_cols)
    out = base.join(auc, on=group_cols, how="inner") if group_cols else base.crossJoin(auc)
    if with_ap:
        ap = _ap_from_counts(v, score, group_cols)
        out = out.join(ap, on=group_cols, how="inner") if group_cols else out.crossJoin(ap)
    return out


def trivial_baselines(df: DataFrame, label: str = K.TARGET, cost_fp: float = K.COST_FP,
                      cost_fn: float = K.COST_FN) -> DataFrame:
    """Cost of accepting everyone (all bad rows are false positives) and of
    rejecting everyone (all good rows are false negatives)."""
    g = df.agg(F.count(F.lit(1)).alias("n"),
               F.sum(F.when(F.col(label) == K.POSITIVE, 1).otherwise(0)).cast("bigint").alias("n_pos"))
    neg = F.col("n") - F.col("n_pos")
    return g.select("n", "n_pos", neg.alias("n_neg"),
                    (neg * float(cost_fp)).alias("accept_all_cost"),
                    F.round(neg * float(cost_fp) / F.col("n"), R).alias("accept_all_avg_cost"),
                    (F.col("n_pos") * float(cost_fn)).alias("reject_all_cost"),
                    F.round(F.col("n_pos") * float(cost_fn) / F.col("n"), R).alias("reject_all_avg_cost"))
