"""Search, threshold tuning, learning curves, importances, stability.

Fits are Spark jobs; the driver only submits them, a few at once, and keeps
per-trial numbers.  All scoring is DataFrame work: scored rows are written by
each fit and AUCs come from one grouped pass of the distributed ranks of
``evaluate``.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from typing import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from credspark import constants as K
from credspark.functions.hashing import md5_bucket
from credspark.operators.evaluate import auc_from_counts, evaluate_model, roc_auc
from credspark.operators.batch_fits import logistic_many, margins, side_by_side
from credspark.operators import encoded_fits as EF
from credspark.operators.models import (FourierFeatures, LogisticFit, ProbaColumn, at_once, carrying, forest,
                                        given_logistic, linear_svm, train_forest, train_kernel_svm, train_logistic)
from credspark.operators.pipelines import build_pipeline
from credspark.operators.profile import seed_summary
from credspark.operators.ranks import count_below, cut_points, row_numbers, value_counts
from credspark.operators.splits import kfold_assign
from credspark.session import materialize, written

FitFn = Callable[[DataFrame], object]  # train DataFrame -> fitted model with .transform giving ``proba``


# --------------------------------------------------------------- search

def sample_space(space: dict, n_trials: int, seed: int) -> list[dict]:
    """Seeded draws: ("uniform", lo, hi), ("log-uniform", lo, hi), ("int", lo, hi), ("cat", [..])."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n_trials):
        p = {}
        for name, spec in space.items():
            kind = spec[0]
            if kind == "uniform":
                p[name] = float(rng.uniform(spec[1], spec[2]))
            elif kind == "log-uniform":
                p[name] = float(math.exp(rng.uniform(math.log(spec[1]), math.log(spec[2]))))
            elif kind == "int":
                p[name] = int(rng.integers(spec[1], spec[2] + 1))
            elif kind == "cat":
                p[name] = spec[1][int(rng.integers(0, len(spec[1])))]
            else:
                raise ValueError(kind)
        out.append(p)
    return out




SPACES = {"lrc": K.LRC_SPACE, "rfc": K.RFC_SPACE, "svc": K.SVC_SPACE}
#: Settings that successive halving takes to all folds.
FINALISTS = 4


def fold_matrices(df: DataFrame, model: str, folds: int, fold_col: str = "fold", resample=None, parallelism: int = 4
                  ) -> list[DataFrame]:
    """For each fold the encoded rows (class, held, features): encoders fitted on the other folds, applied to all
    rows, written once.  ``held`` marks the fold's own rows; ``resample`` sees the others only."""
    def encode(f: int) -> DataFrame:
        rows = df.withColumn("held", F.col(fold_col) == f)
        prep = build_pipeline(model, keep_cols=[K.ROW_ID, K.TARGET, "held"]).fit(rows.filter(~F.col("held")))
        x = prep.transform(rows)
        out = x.select(K.TARGET, "held", "features")
        if resample:
            more = resample(x.filter(~F.col("held")).select(K.ROW_ID, K.TARGET, "features"))
            out = out.filter("held").unionByName(more.select(K.TARGET, F.lit(False).alias("held"), "features"))
        return written(out, f"fold{f}")

    return side_by_side(df.sparkSession, encode, list(range(folds)), parallelism)


def _class_counts(x: DataFrame) -> dict[int, int]:
    return {r[K.TARGET]: r["count"] for r in x.filter(~F.col("held")).groupBy(K.TARGET).count().collect()}


def _weight(p: dict, counts: dict[int, int], resample) -> dict[int, float] | None:
    """Class weights of a draw: balanced against the training rows, or none."""
    if resample or p.get("class_weight") != "balanced":
        return None
    return {c: sum(counts.values()) / (len(counts) * n) for c, n in counts.items()}


def _fold_aucs(parts: list[DataFrame]) -> dict[tuple[int, int], float]:
    """AUC of every (fold, trial) from one pass over all scored rows."""
    scored = parts[0]
    for p in parts[1:]:
        scored = scored.unionByName(p)
    aucs = roc_auc(scored, score="score", group_cols=["fold", "trial"])
    return {(r["fold"], r["trial"]): r["roc_auc"] for r in aucs.collect()}     # a row for each fold and trial


def _logistic_search(mats: list[DataFrame], draws: list[dict], resample, parallelism: int):
    """All draws on all folds: one batch of Newton passes for each fold."""
    def scored(f: int) -> DataFrame:
        x = mats[f].select(K.TARGET, "held", vector_to_array("features").alias("x"))
        counts = _class_counts(mats[f])
        n = sum(counts.values())
        fits = logistic_many(x.filter(~F.col("held")), [1.0 / (p["C"] * n) for p in draws],
                             [_weight(p, counts, resample) for p in draws], label=K.TARGET)
        out = margins(x.filter("held"), fits, [K.TARGET])
        return written(out.withColumn("fold", F.lit(f)), "scored")

    aucs = _fold_aucs(side_by_side(mats[0].sparkSession, scored, list(range(len(mats))), parallelism))
    return [[aucs[f, k] for f in range(len(mats))] for k in range(len(draws))]


def _shared_search(df: DataFrame, draws: list[dict], folds: int, fold_col: str):
    """All draws of the regression on all folds, in passes that all share: no fold's rows are encoded or written.
    Returns their scores and a function that fits a draw on all rows; None where the rows do not allow that
    (``code_rows``), or a fold lacks a class."""
    x = EF.code_rows(build_pipeline("lrc"), df, folds, fold_col)
    if x is None or folds < 2 or not ((x.good > 0) & (x.good < x.rows)).all():
        return None
    learned = ~np.eye(folds, dtype=bool)

    def setting(p: dict, parts: np.ndarray) -> tuple[float, np.ndarray]:
        n, good = x.rows[parts].sum(), x.good[parts].sum()
        w = _weight(p, {0: n - good, 1: good}, None) or {0: 1.0, 1: 1.0}
        return 1.0 / (p["C"] * n), parts[:, None] * np.array([w[0], w[1]])

    def refit(train: DataFrame, p: dict):
        every = np.ones(folds, bool)
        reg, weights = setting(p, every)
        fitted = EF.solve(x, [EF.encoding(x, every)], [reg], weights[None])[0]
        prep = build_pipeline("lrc", keep_cols=[K.ROW_ID, K.TARGET]).fit(train)
        return PipelineModel(stages=[*prep.stages, given_logistic(fitted), ProbaColumn()])

    maps = [EF.encoding(x, m) for m in learned]
    jobs = [(f, k) for f in range(folds) for k in range(len(draws))]
    regs, weights = zip(*[setting(draws[k], learned[f]) for f, k in jobs])
    fitted = EF.fit(x, [maps[f] for f, _ in jobs], list(regs), np.array(weights))
    aucs = EF.score(x, fitted, np.array([np.where(learned[f], -1, 0) for f, _ in jobs]))[:, 0].round(6)
    return [[float(aucs[f * len(draws) + k]) for f in range(folds)] for k in range(len(draws))], refit


def _estimator(model: str, p: dict, n: int, n_in: int, weighted: bool, seed: int) -> Pipeline:
    """Stages that score a draw: the margin of a kernel SVM (calibration keeps its order), or a forest's votes."""
    weight = "weight" if weighted else None
    if model == "rfc":
        return Pipeline(stages=[forest(int(p["n_estimators"]), int(p["max_depth"]), int(p["min_samples_leaf"]),
                                       float(p["max_samples"]), str(p["max_features"]), seed, weight)])
    rbf = p["kernel"] == "rbf"
    first = [FourierFeatures.make(n_in, gamma=p["gamma"], seed=seed)] if rbf else []
    return Pipeline(stages=[*first, linear_svm("rff" if rbf else "features", p["C"], n, tol=p["tol"],
                                               weight_col=weight)])


def _halving_search(model: str, mats: list[DataFrame], draws: list[dict], resample, seed: int, parallelism: int):
    """Successive halving: every draw on the first fold, the better half on the next, and so on until FINALISTS
    are left, which run on all folds.  Returns each draw's scores, one for each fold it ran on."""
    counts = [_class_counts(x) for x in mats]
    n_in = [x.select("features").first()["features"].size for x in mats]

    def scored(job: tuple[int, int]) -> DataFrame:
        f, k = job
        weight = _weight(draws[k], counts[f], resample)
        x = mats[f]
        if weight:
            x = x.withColumn("weight", F.when(F.col(K.TARGET) == 1, weight[1]).otherwise(weight[0]))
        fitted = _estimator(model, draws[k], sum(counts[f].values()), n_in[f], bool(weight), seed).fit(
            x.filter(~F.col("held")))
        score = vector_to_array("probability" if model == "rfc" else "svm_raw")[1]
        out = fitted.transform(x.filter("held")).select(K.TARGET, F.lit(f).alias("fold"), F.lit(k).alias("trial"),
                                                        score.alias("score"))
        return written(out, "scored")

    alive, scores, f = list(range(len(draws))), [[] for _ in draws], 0
    while f < len(mats):
        last = len(alive) <= FINALISTS or f == len(mats) - 1
        now = list(range(f, len(mats))) if last else [f]
        jobs = [(g, k) for g in now for k in alive]
        aucs = _fold_aucs(side_by_side(mats[0].sparkSession, scored, jobs, parallelism))
        for g, k in jobs:
            scores[k].append(aucs[g, k])
        f = now[-1] + 1
        if not last:
            keep = max(FINALISTS, math.ceil(len(alive) / 2))
            alive = sorted(sorted(alive, key=lambda k: (-float(np.mean(scores[k])), k))[:keep])
    return scores


def _refit(train: DataFrame, model: str, p: dict, resample, seed: int):
    weight = None if resample else p.get("class_weight")
    if model == "svc":
        return train_kernel_svm(train, C=p["C"], gamma=p["gamma"], kernel=p["kernel"], tol=p["tol"],
                                class_weight=weight, resample=resample, seed=seed)
    if model == "rfc":
        return train_forest(train, p.get("class_weight") or {0: 1.0, 1: 1.0}, int(p["n_estimators"]),
                            int(p["max_depth"]), int(p["min_samples_leaf"]), float(p["max_samples"]),
                            str(p["max_features"]), seed)
    return train_logistic(train, C=p["C"], class_weight=weight, max_iter=int(p["max_iter"]), resample=resample)


def tune_search(train: DataFrame, model: str = "lrc", space: dict | None = None, n_trials: int = 25,
                folds: int = 5, seed: int = 8, parallelism: int | None = None, fold_col: str = "fold", resample=None):
    """Random search over ``space`` with k-fold ROC AUC (exact, ties counted), for
    the models lrc, rfc and svc.  The encoders are fitted once for each fold, on the
    other folds, and the encoded rows written; all trials run on those.  ``resample``
    (lrc, svc) rebalances the encoded training rows of each fold.

    lrc: every trial on every fold, as regressions that share their passes: over one table of codes where the rows
    allow it and nothing is resampled, else over the encoded rows of each fold.
    rfc, svc: successive halving over the folds; ``n_folds`` of the trials table says
    on how many folds a trial ran, ``score`` is the mean over those, and the best
    trial is chosen among those that ran on all.
    Returns (trials DataFrame, best PipelineModel refit on all rows)."""
    if model not in SPACES:
        raise ValueError(f"unknown model {model!r}; there are {', '.join(SPACES)}")
    if resample and model == "rfc":
        raise ValueError("the forest balances by class weights, not by a resampler")
    draws = sample_space(space or SPACES[model], n_trials, seed)
    df = written(train if fold_col in train.columns else kfold_assign(train, folds, seed, name=fold_col), "dealt")
    shared = _shared_search(df, draws, folds, fold_col) if model == "lrc" and not resample else None
    if shared:
        scores, refit = shared
    else:
        refit = lambda rows, p: _refit(rows, model, p, resample, seed)
        # folds of few rows are all encoded and fitted side by side: a fold is many small jobs
        folds_at_once = parallelism or max(4, at_once(df.count(), WIDTH, folds))
        mats = fold_matrices(df, model, folds, fold_col, resample, folds_at_once)
        scores = _logistic_search(mats, draws, resample, folds_at_once) if model == "lrc" else \
            _halving_search(model, mats, draws, resample, seed, parallelism or 4)
    full = [k for k, s in enumerate(scores) if len(s) == folds]
    best = max(full, key=lambda k: (float(np.mean(scores[k])), -k))
    trials = _trials(df, model, draws, [float(np.mean(s)) for s in scores], [len(s) for s in scores])
    return trials, refit(df.drop(fold_col), draws[best])


def _trials(df: DataFrame, model: str, draws: list[dict], scores: list[float], folds: list[int]) -> DataFrame:
    sid = f"{model}-{uuid.uuid4().hex[:8]}"
    rows = [(sid, i, {k: str(v) for k, v in p.items()}, s, n)
            for i, (p, s, n) in enumerate(zip(draws, scores, folds))]
    return df.sparkSession.createDataFrame(
        rows, "search_id string, trial int, params map<string,string>, score double, n_folds int")


def search_convergence(trials: DataFrame, trial_col: str = "trial", score_col: str = "score",
                       group_cols: list[str] | None = None) -> DataFrame:
    """Best score so far by trial, per search.  One search is a small table
    (trials are tens to hundreds), so an ordered window per search is fine."""
    group_cols = group_cols or (["search_id"] if "search_id" in trials.columns else [])
    w = (Window.partitionBy(*group_cols) if group_cols else Window.partitionBy()).orderBy(trial_col) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return trials.select(*group_cols, trial_col, score_col, F.max(score_col).over(w).alias("best_so_far"))


# ------------------------------------------------------- out-of-fold work

def oof_predictions(train: DataFrame, fit: FitFn, folds: int = 5, seed: int = 8, fold_col: str = "fold"
                    ) -> DataFrame:
    """(row_id, class, fold, proba) for every training row, each predicted by
    the model fitted on the other folds."""
    df = materialize(train if fold_col in train.columns else kfold_assign(train, folds, seed, name=fold_col))
    parts = None
    for f in range(folds):
        m = fit(df.filter(F.col(fold_col) != f))
        p = m.transform(df.filter(F.col(fold_col) == f)).select(K.ROW_ID, K.TARGET, F.lit(f).alias(fold_col),
                                                                 "proba")
        parts = p if parts is None else parts.unionByName(p)
    return parts


def tune_threshold_cv(oof: DataFrame, n_thresholds: int = 100, proba: str = "proba", fold_col: str = "fold",
                      label: str = K.TARGET, cost_fp: float = K.COST_FP, cost_fn: float = K.COST_FN
                      ) -> tuple[DataFrame, DataFrame]:
    """Threshold of least mean cost over folds among ``n_thresholds`` evenly
    spaced candidates between the lowest and highest out-of-fold score.

    Each fold is one histogram of 'how many candidates a score reaches' by
    label, then reverse running sums over <= n_thresholds + 1 bins: one
    pass over the predictions.  Returns (per-candidate table, best row)."""
    lo, hi = oof.agg(F.min(proba), F.max(proba)).first()
    step = (hi - lo) / (n_thresholds - 1)
    cands = [lo + i * step for i in range(n_thresholds - 1)] + [hi]
    reach = count_below(F.col(proba), cands, inclusive=True)
    pos = F.col(label) == K.POSITIVE
    h = oof.groupBy(fold_col, reach.alias("k")).agg(F.sum(F.when(pos, 1).otherwise(0)).alias("pos"),
                                                   F.sum(F.when(pos, 0).otherwise(1)).alias("neg"))
    tot = h.groupBy(fold_col).agg(F.sum("pos").alias("P"), F.sum("neg").alias("NEG"))
    idx = oof.sparkSession.createDataFrame([(i, float(c)) for i, c in enumerate(cands)], "i int, threshold double")
    # predicted positive at candidate i <=> the score reaches more than i
    # candidates.  Both sides are tiny: candidates x (folds x bins).
    j = F.broadcast(idx).crossJoin(h)
    hit = F.col("k") > F.col("i")
    g = j.groupBy(fold_col, "i", "threshold").agg(F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
                                                  F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"))
    g = g.join(tot, fold_col)
    cost = (F.col("fp") * cost_fp + (F.col("P") - F.col("tp")) * cost_fn).cast("double")
    per = g.groupBy("i", "threshold").agg(F.avg(cost).alias("mean_cost"), F.count(F.lit(1)).alias("n_folds"))
    best = per.orderBy("mean_cost", "i").limit(1)
    return per, best


#: Numbers in an applicant's encoded row, about: how many fits run side by side follows from it.
WIDTH = 100
#: The column that says on which side of a fit a row is, while it is scored.
SIDE = "_credspark_side"


def _fits_at_once(df: DataFrame, parallelism: int | None) -> int:
    """``parallelism``, or as many as there are cores where the rows are few."""
    if parallelism:
        return parallelism
    return max(4, at_once(df.count(), WIDTH, df.sparkSession.sparkContext.defaultParallelism))


def _with_side(model, rows: DataFrame, of: list[str]) -> DataFrame:
    """Columns ``of`` and the column ``side`` (train, val) of scored rows.  A model whose encoding stage can let a
    column through scores both sides in one pass; any other model takes them one after the other."""
    if any(st.hasParam("keepCols") for st in getattr(model, "stages", [])):
        return carrying(model, SIDE).transform(rows).select(F.col(SIDE).alias("side"), *of)
    out = None
    for side in ("train", "val"):
        p = model.transform(rows.filter(F.col(SIDE) == side).drop(SIDE)).select(F.lit(side).alias("side"), *of)
        out = p if out is None else out.unionByName(p)
    return out


def _curves_together(df: DataFrame, fits: dict[str, LogisticFit], sizes: list[float], folds: int) -> DataFrame | None:
    """``_curves`` of regressions: all cells of a curve share the passes over one table of codes.  None where the rows
    do not allow that (``code_rows``), or a cell has rows of one class only."""
    sizes = sorted(set(sizes))
    limits = [int(round(s * 1000)) for s in sizes]
    step = sum((F.col("_b") >= b).cast("int") for b in limits)      # the first sample that holds the row
    steps = len(sizes) + 1
    rows = df.withColumn(SIDE, F.col("fold") * steps + step)
    fold, first = np.divmod(np.arange(folds * steps), steps)
    cells = [(i, f) for i in range(len(sizes)) for f in range(folds)]
    learned = np.array([(fold != f) & (first <= i) for i, f in cells])
    sides = np.array([np.where(fold == f, 1, np.where(m, 0, -1)) for (_, f), m in zip(cells, learned)])
    out = []
    for curve, one in fits.items():
        x = EF.code_rows(one.pipeline(df.drop("fold", "_b")), rows, folds * steps, SIDE)
        if x is None or not all(0 < x.good[m].sum() < x.rows[m].sum() for m in learned):
            return None
        fitted = EF.fit(x, [EF.encoding(x, m) for m in learned], [1.0 / (one.C * x.rows[m].sum()) for m in learned],
                        learned[:, :, None] * np.ones(2))
        order = list(range(len(cells)))[::-1]       # the ranges of scores are cut by the fit on the most rows
        aucs = EF.score(x, fitted[order], sides[order])[order]
        out += [(curve, float(sizes[i]), f, *[None if np.isnan(a) else float(a) for a in pair])
                for (i, f), pair in zip(cells, aucs)]
    schema = "curve string, train_size double, fold int, train_auc double, val_auc double"
    return df.sparkSession.createDataFrame(out, schema).withColumns(
        {c: F.round(c, 6) for c in ("train_auc", "val_auc")})


def _curves(train: DataFrame, fits: dict[str, FitFn], sizes: list[float], folds: int, seed: int,
            parallelism: int | None) -> DataFrame:
    """(curve, train_size, fold, train_auc, val_auc): one fit for each curve, size and fold, all on the same folds and
    samples.  Regressions share their passes where the rows allow it; other fits run side by side, each writes its
    scored rows, and one grouped pass gives all AUCs."""
    keyed = kfold_assign(train, folds, seed).withColumn(
        "_b", md5_bucket(F.concat(F.lit(f"lc{seed}_"), F.col(K.ROW_ID).cast("string")), 1000))
    df = written(keyed, "learning")
    if all(isinstance(fit, LogisticFit) for fit in fits.values()):
        curves = _curves_together(df, fits, sizes, folds)
        if curves is not None:
            return curves

    def scored(cell: tuple[str, float, int]) -> DataFrame:
        curve, size, f = cell
        sample = (F.col("fold") != f) & (F.col("_b") < int(round(size * 1000)))
        m = fits[curve](df.filter(sample).drop("fold", "_b"))
        rows = df.withColumn(SIDE, F.when(F.col("fold") == f, "val").when(sample, "train")).filter(
            F.col(SIDE).isNotNull()).drop("fold", "_b")
        out = _with_side(m, rows, [K.TARGET, "proba"]).select(
            F.lit(curve).alias("curve"), F.lit(float(size)).alias("train_size"), F.lit(f).alias("fold"), "side",
            K.TARGET, "proba")
        return written(out, "learning")

    # the largest samples first, so that none of them is left alone at the end
    cells = [(c, s, f) for s in sorted(sizes, reverse=True) for c in fits for f in range(folds)]
    parts = side_by_side(train.sparkSession, scored, cells, _fits_at_once(df, parallelism))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    aucs = roc_auc(rows, score="proba", group_cols=["curve", "train_size", "fold", "side"])
    return aucs.groupBy("curve", "train_size", "fold").pivot("side", ["train", "val"]).agg(F.first("roc_auc")) \
        .withColumnsRenamed({"train": "train_auc", "val": "val_auc"})


def learning_scores(train: DataFrame, fit: FitFn, sizes: list[float], folds: int = 5, seed: int = 8,
                    parallelism: int | None = None) -> DataFrame:
    """(train_size, fold, train_auc, val_auc): one fit for each size and fold on a nested hash sample of the other
    folds."""
    return _curves(train, {"": fit}, sizes, folds, seed, parallelism).drop("curve")


SIZES = [k / 10 for k in range(1, 11)]


def learning_curve(train: DataFrame, fit: FitFn, sizes: list[float] | None = None, folds: int = 5,
                   seed: int = 8, parallelism: int | None = None) -> DataFrame:
    """Train / validation ROC AUC by training size, mean and population std over folds, per size."""
    r = learning_scores(train, fit, sizes or SIZES, folds, seed, parallelism)
    curve = r.groupBy("train_size").agg(F.avg("train_auc").alias("train_auc_mean"),
                                        F.stddev_pop("train_auc").alias("train_auc_std"),
                                        F.avg("val_auc").alias("val_auc_mean"),
                                        F.stddev_pop("val_auc").alias("val_auc_std"))
    return learning_diagnosis(curve, "val_auc_mean", "train_auc_mean").orderBy("train_size")


def learning_diagnosis(df: DataFrame, val: str = "val_auc", train: str = "train_auc") -> DataFrame:
    """The four bias-variance rules on (train, validation) scores; several may hold."""
    v, gap = F.col(val), F.col(train) - F.col(val)
    rules = [(v < 0.70, "low_score"), (gap > 0.10, "high_variance"),
             ((gap < 0.05) & (v < 0.75), "high_bias"), ((v > 0.75) & (gap < 0.10), "balanced")]
    labels = F.filter(F.array(*[F.when(c, F.lit(t)) for c, t in rules]), lambda x: x.isNotNull())
    return df.select("*", gap.alias("gap"), labels.alias("diagnosis"))


#: Rounds of the position shuffle, and how often a position beyond the table may be sent on.
SHUFFLE_ROUNDS, SHUFFLE_WALK = 4, 32
_PRIME = 2147483647


def shuffle_constants(seed: int) -> list[tuple[int, int, int]]:
    """Multiplier and two offsets of each round."""
    rng = np.random.default_rng(seed)
    return [tuple(int(v) for v in rng.integers(1, _PRIME, 3)) for _ in range(SHUFFLE_ROUNDS)]


def shuffled_position(i, n: int, rep, seed: int):
    """A seeded bijection of 0 .. n - 1 as a column: a Feistel network over pairs of half-positions below
    ceil(sqrt(n)), walked on until the position lies in the table.  ``rep`` picks one of many bijections."""
    half = math.isqrt(max(n - 1, 0)) + 1
    prime, h = F.lit(_PRIME).cast("long"), F.lit(half).cast("long")
    rep = rep.cast("long")

    def once(x):
        left, right = F.floor(x / h).cast("long"), x % h
        for a, b, c in shuffle_constants(seed):
            y = (right * F.lit(a).cast("long") + rep * F.lit(c).cast("long") + F.lit(b)) % prime
            left, right = right, (left + (y * y + F.lit(c)) % prime) % h
        return left * h + right

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(SHUFFLE_WALK)), once(i.cast("long")),
                         lambda x, _: F.when(x < n, x).otherwise(once(x)))
    lost = F.raise_error(F.lit("a position did not come back into the table; use another seed")).cast("long")
    return F.when(walked < n, walked).otherwise(lost)


def _positions(n: int, seed: int):
    """``shuffled_position`` of many rows at once: column steps would be interpreted row by row."""
    half, rounds = math.isqrt(max(n - 1, 0)) + 1, shuffle_constants(seed)

    @F.pandas_udf("long")
    def moved(i: pd.Series, rep: pd.Series) -> pd.Series:
        x, r = i.to_numpy(np.int64, copy=True), rep.to_numpy(np.int64)
        out = np.arange(len(x))     # those that are not in the table yet
        for _ in range(SHUFFLE_WALK + 1):
            left, right = x[out] // half, x[out] % half
            for a, b, c in rounds:
                y = (right * a + r[out] * c + b) % _PRIME
                left, right = right, (left + (y * y + c) % _PRIME) % half
            x[out] = left * half + right
            out = out[x[out] >= n]
            if not len(out):
                return pd.Series(x)
        raise ValueError("a position did not come back into the table; use another seed")

    return moved


#: Rows of one group that a task of ``many_aucs`` sorts, and scored rows that a task counts before it sends them on.
GROUP_ROWS, COUNTED_ROWS = 250_000, 500_000


def many_aucs(scored: DataFrame, group: str, cuts: list[float], label: str = K.TARGET, score: str = "proba"
              ) -> DataFrame:
    """(group, roc_auc): the exact ROC AUC of ``roc_auc`` for many groups of scores that are alike.

    ``cuts`` deal the scores to ranges; any will do, they only balance the work.  Tasks count the labels of
    their own equal scores and send one row of packed counts for each group and range, so the shuffle
    sorts those rows and not the scores."""
    edges = np.array(cuts, np.float64)

    def counted(g: np.ndarray, v: np.ndarray, pos: np.ndarray, n: np.ndarray):
        order = np.lexsort((v, g))
        g, v, pos, n = g[order], v[order], pos[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], (g[1:] != g[:-1]) | ((v[1:] != v[:-1]) & (v[:-1] == v[:-1])))))
        return g[first], v[first], np.add.reduceat(pos, first), np.add.reduceat(n, first)

    def packed(parts: list) -> pa.RecordBatch:
        g, v, pos = (np.concatenate(x) for x in zip(*parts))
        bucket = np.minimum(np.searchsorted(edges, v), len(edges))      # NaN counts as the greatest, as in a sort
        key, v, pos, n = counted(g * (len(edges) + 1) + bucket, v, pos, np.ones(len(v), np.int64))
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        ends = np.append(first[1:], len(key))
        cut = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(first, ends)], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(key[first]), cut(v), cut(pos), cut(n)], ["key", "v", "pos", "n"])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows = [], 0
        for b in batches:
            if b.num_rows:
                parts.append((b.column(0).to_numpy().astype(np.int64), b.column(1).to_numpy() + 0.0,
                              b.column(2).to_numpy().astype(np.int64)))
                rows += b.num_rows
            if rows >= COUNTED_ROWS:
                yield packed(parts)
                parts, rows = [], 0
        if parts:
            yield packed(parts)

    def ranked(t: pa.Table) -> pa.Table:
        v, pos, n = (np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in t.column(c)])
                     for c, kind in (("v", np.float64), ("pos", np.int64), ("n", np.int64)))
        _, _, pos, n = counted(np.zeros(len(v), np.int64), v, pos, n)
        neg = n - pos
        twice = (pos * (2 * (np.cumsum(neg) - neg) + neg)).sum()        # pairs in order count 2, equal ones 1
        return pa.table({"key": t.column("key").slice(0, 1), "twice": [int(twice)], "pos": [int(pos.sum())],
                         "neg": [int(neg.sum())]})

    rows = scored.filter(F.col(score).isNotNull() & F.col(group).isNotNull()).select(
        group, F.col(score).cast("double"), F.when(F.col(label) == 1, 1).otherwise(0))
    sums = rows.mapInArrow(tally, "key long, v binary, pos binary, n binary").groupBy("key").applyInArrow(
        ranked, "key long, twice long, pos long, neg long")
    ranges = len(edges) + 1
    sums = sums.select(F.floor(F.col("key") / ranges).cast("int").alias(group), (F.col("key") % ranges).alias("_at"),
                       F.col("twice").cast("double"), "pos", "neg")     # a row for each group and range
    before = Window.partitionBy(group).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(before), F.lit(0)).cast("double")
    pairs = sums.select(group, "pos", "neg", (F.col("twice") / 2 + F.col("pos") * below).alias("_won"))
    p, q = F.sum("pos").cast("double"), F.sum("neg").cast("double")
    return pairs.groupBy(group).agg(F.round(F.try_divide(F.sum("_won"), p * q), 6).alias("roc_auc"))


def permutation_importance(score: Callable[[DataFrame], DataFrame], df: DataFrame, columns: list[str],
                           repeats: int = 10, seed: int = 42, id_col: str = K.ROW_ID) -> DataFrame:
    """Drop in ROC AUC when one column is shuffled, mean and std over repeats.

    ``score``: a function that adds ``proba`` to rows and keeps their id, or a fitted model.  The rows are
    numbered once; a seeded bijection of the numbers (a column expression) names the row that each repeat's
    value comes from, so no repeat is sorted or numbered.  One join brings row and source row together for all
    repeats; every (repeat, column) copy is scored in one plan, and ``many_aucs`` ranks them in the ranges of the unshuffled scores."""
    apply = score if callable(score) else score.transform
    df = written(df, "rows")
    base = materialize(row_numbers(df, id_col, name="_i").withColumn("_i", F.col("_i") - 1))
    n = base.count()
    reps = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    mine = base.select("*", reps.alias("_rep")).withColumn("_j", _positions(n, seed)("_i", "_rep"))
    src = base.select(F.col("_i").alias("_j"), *[F.col(c).alias(f"_src_{c}") for c in columns])
    # a number of tasks of its own: the joined rows are few bytes for the work on their copies
    spark = df.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    paired = mine.repartition(tasks, "_j").join(src.repartition(tasks, "_j"), "_j")
    copies = paired.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(columns) - 1))).alias("_f"))
    # the model keeps only id and label: carry (repeat, column) inside the id
    gid = (F.col("_rep") * len(columns) + F.col("_f")) * F.lit(n).cast("long") + F.col("_i")
    sel = [gid.alias(c) if c == id_col else
           F.when(F.col("_f") == columns.index(c), F.col(f"_src_{c}")).otherwise(F.col(c)).alias(c) if c in columns
           else F.col(c)
           for c in df.columns]
    g = F.floor(F.col(id_col) / F.lit(max(n, 1)).cast("long"))
    scored = apply(copies.select(*sel)).select(g.cast("int").alias("_g"), K.TARGET, "proba")
    counts = materialize(value_counts(apply(df), "proba", label_col=K.TARGET))
    ref = auc_from_counts(counts, "proba").first()["roc_auc"]
    cuts = cut_points(counts, "proba", None, rows_per_bucket=GROUP_ROWS, minimum=1)
    aucs = many_aucs(scored, "_g", cuts, score="proba").select(
        (F.col("_g") % len(columns)).alias("_f"), F.floor(F.col("_g") / len(columns)).alias("_rep"), "roc_auc")
    names = F.array(*[F.lit(c) for c in columns])
    drop = aucs.select(F.element_at(names, (F.col("_f") + 1).cast("int")).alias("feature"),
                       (F.lit(ref) - F.col("roc_auc")).alias("drop"))
    return drop.groupBy("feature").agg(F.avg("drop").alias("importance_mean"),
                                       F.stddev_pop("drop").alias("importance_std"),
                                       F.count(F.lit(1)).alias("repeats")).orderBy(F.desc("importance_mean"), "feature")


def cv_auc(train: DataFrame, fit: FitFn, folds: int = 5, seed: int = 8) -> float:
    oof = oof_predictions(train, fit, folds, seed)
    aucs = roc_auc(oof, score="proba", group_cols=["fold"])
    return aucs.agg(F.avg("roc_auc")).first()[0]


def feature_gain(train: DataFrame, fit_engineered: FitFn, fit_baseline: FitFn, sizes: list[float] | None = None,
                 folds: int = 5, seed: int = 8, parallelism: int | None = None) -> DataFrame:
    """Validation AUC with the engineered pipeline minus with the baseline one, for every training size: two
    learning curves over the same folds and samples."""
    fits = {"engineered": fit_engineered, "baseline": fit_baseline}
    both = _curves(train, fits, sizes or SIZES, folds, seed, parallelism)
    both = both.groupBy("train_size").pivot("curve", list(fits)).agg(F.avg("val_auc"))
    return both.withColumnsRenamed({c: f"auc_{c}" for c in fits}).withColumn(
        "gain", F.col("auc_engineered") - F.col("auc_baseline")).orderBy("train_size")


def seed_stability(train: DataFrame, test: DataFrame, fit_seeded: Callable[[DataFrame, int], object],
                   seeds=range(5), threshold: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Refit under several seeds, evaluate each on the test side; per-seed
    metrics and their mean / std / range.  The refits run side by side where the
    train side is small."""
    def evaluated(s: int) -> DataFrame:
        m = fit_seeded(train, s)
        p = m.transform(test).select(K.TARGET, "proba", (F.col("proba") >= threshold).cast("int").alias("pred"))
        return evaluate_model(p, with_ap=False).select(F.lit(int(s)).alias("seed"), "*")

    seeds = list(seeds)
    parts = side_by_side(train.sparkSession, evaluated, seeds, at_once(train.count(), WIDTH, len(seeds)))
    per = parts[0]
    for e in parts[1:]:
        per = per.unionByName(e)
    summary = seed_summary(per, ["roc_auc", "accuracy", "f1", "precision", "total_cost", "avg_cost"])
    return per, summary
