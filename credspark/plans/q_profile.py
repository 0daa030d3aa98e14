"""Catalog: profiles and descriptive aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from credspark import constants as K
from credspark.functions.distributions import normal_quantile_sql
from credspark.functions.hashing import duck_md5_bucket
from credspark.operators import ensemble as EN
from credspark.operators import evaluate as EV
from credspark.operators import profile as PR
from credspark.operators import splits as SP
from credspark.plans.common import apps, qs, r, round_doubles, sql
from credspark.plans.q_features import engineered_view
from credspark.sources.fixtures import APPLICATION_COLUMNS, scored

Q: dict = {}
S: dict = {}

NUM = ["duration_months", "age_years", "credit_amount", "savings_amount"]
CAT = list(K.CODEBOOK)


def long_sql(cols, cast="DOUBLE", src="applications"):
    return " UNION ALL ".join(f"SELECT {qs(c)} AS variable, CAST({c} AS {cast}) AS value FROM {src}" for c in cols)


def _round_profile(df):
    df = round_doubles(df)
    return df.withColumn("variance", F.round("variance", 2))


def q_profile_numeric(spark, d):
    return _round_profile(PR.profile_numeric(apps(spark, d), NUM))


Q["profile_numeric"] = q_profile_numeric
S["profile_numeric"] = sql(
    f", long AS ({long_sql(NUM)})"
    ", vc AS (SELECT variable, value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY ALL)"
    ", md AS (SELECT variable, value AS mode FROM (SELECT variable, value, row_number() OVER"
    " (PARTITION BY variable ORDER BY n DESC, value) AS rk FROM vc) WHERE rk = 1)"
    ", st AS (SELECT variable, count(value) AS count, count(*) - count(value) AS missing,"
    " (count(*) - count(value)) * 100.0 / count(*) AS missing_pct, count(DISTINCT value) AS \"unique\","
    " avg(value) AS mean, quantile_cont(value, 0.5) AS median, stddev_samp(value) AS std,"
    " var_samp(value) AS variance, min(value) AS min, max(value) AS max, max(value) - min(value) AS range,"
    " quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr, skewness(value) AS skewness,"
    " kurtosis(value) AS kurtosis, CASE WHEN avg(value) <> 0 THEN stddev_samp(value) / avg(value) * 100 END AS cv"
    " FROM long GROUP BY variable)"
    f" SELECT variable, count, missing, {r('missing_pct')} AS missing_pct, \"unique\", {r('mean')} AS mean,"
    f" {r('median')} AS median, {r('mode')} AS mode, {r('std')} AS std, round(variance, 2) AS variance,"
    f" {r('min')} AS min, {r('max')} AS max, {r('range')} AS range, {r('iqr')} AS iqr,"
    f" {r('skewness')} AS skewness, {r('kurtosis')} AS kurtosis, {r('cv')} AS cv FROM st JOIN md USING (variable)")

PCTS = K.PERCENTILES
PNAMES = [f"p{round(p * 100)}" for p in PCTS]


def q_percentile_table(spark, d):
    return round_doubles(PR.percentile_table(apps(spark, d), NUM))


Q["percentile_table"] = q_percentile_table
S["percentile_table"] = sql(
    f", long AS ({long_sql(NUM)}) SELECT variable, "
    + ", ".join(f"{r(f'quantile_cont(value, {p})')} AS {n}" for p, n in zip(PCTS, PNAMES))
    + " FROM long GROUP BY variable")


def q_outliers_iqr(spark, d):
    return round_doubles(PR.outliers_iqr(apps(spark, d), NUM))


Q["outliers_iqr"] = q_outliers_iqr
S["outliers_iqr"] = sql(
    f", long AS ({long_sql(NUM)})"
    ", q AS (SELECT variable, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM long"
    " GROUP BY variable), b AS (SELECT variable, q1, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)"
    f" SELECT variable, {r('q1')} AS q1, {r('q3')} AS q3, {r('lo')} AS lower_bound, {r('hi')} AS upper_bound,"
    " CAST(sum(CASE WHEN value < lo OR value > hi THEN 1 ELSE 0 END) AS BIGINT) AS outliers_count,"
    f" {r('sum(CASE WHEN value < lo OR value > hi THEN 1 ELSE 0 END) * 100.0 / count(*)')} AS outliers_pct"
    " FROM long JOIN b USING (variable) WHERE value IS NOT NULL GROUP BY variable, q1, q3, lo, hi")


def q_shape_labels(spark, d):
    return round_doubles(PR.shape_labels(PR.profile_numeric(apps(spark, d), NUM)))


Q["shape_labels"] = q_shape_labels
S["shape_labels"] = sql(
    f", long AS ({long_sql(NUM)}), st AS (SELECT variable, skewness(value) AS s, kurtosis(value) AS k FROM long"
    f" GROUP BY variable) SELECT variable, {r('s')} AS skewness, {r('k')} AS kurtosis,"
    " CASE WHEN abs(s) < 0.5 THEN 'approximately symmetric' WHEN s > 0 THEN 'right-skewed' ELSE 'left-skewed' END"
    " AS skew_label, CASE WHEN k > 1 THEN 'heavy tails / peaked' WHEN k < -1 THEN 'light tails / flat'"
    " ELSE 'approximately normal tails' END AS kurtosis_label FROM st")


def q_profile_categorical(spark, d):
    return round_doubles(PR.profile_categorical(apps(spark, d), CAT))


Q["profile_categorical"] = q_profile_categorical
S["profile_categorical"] = sql(
    f", long AS ({long_sql(CAT, 'VARCHAR')})"
    ", vc AS (SELECT variable, value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY ALL)"
    ", tot AS (SELECT variable, count(value) AS cnt, count(*) - count(value) AS missing, count(*) AS rws FROM long"
    " GROUP BY variable)"
    ", md AS (SELECT variable, value AS mode, n AS mode_count FROM (SELECT variable, value, n, row_number() OVER"
    " (PARTITION BY variable ORDER BY n DESC, value) AS rk FROM vc) WHERE rk = 1)"
    ", ent AS (SELECT variable, count(*) AS \"unique\", -sum((n / cnt) * log2(n / cnt + 1e-15)) AS entropy,"
    " 1 - sum((n / cnt) * (n / cnt)) AS gini FROM vc JOIN tot USING (variable) GROUP BY variable)"
    f" SELECT variable, cnt AS count, missing, {r('missing * 100.0 / rws')} AS missing_pct, \"unique\", mode,"
    f" mode_count, {r('mode_count * 100.0 / cnt')} AS mode_pct, {r('entropy')} AS entropy,"
    f" {r('gini')} AS gini_impurity FROM tot JOIN ent USING (variable) JOIN md USING (variable)")


def q_value_counts_topk(spark, d):
    return round_doubles(PR.value_counts_topk(apps(spark, d), "purpose", 5))


Q["value_counts_topk"] = q_value_counts_topk
S["value_counts_topk"] = sql(
    ", vc AS (SELECT purpose AS value, count(*) AS n FROM applications WHERE purpose IS NOT NULL GROUP BY 1)"
    " SELECT 'purpose' AS variable, value, n, round(n * 100.0 / (SELECT sum(n) FROM vc), 6) AS pct,"
    " greatest((SELECT count(*) FROM vc) - 5, 0) AS n_more FROM vc ORDER BY n DESC, value LIMIT 5")

QP_COLS = [c for c in APPLICATION_COLUMNS if c != "row_id"]


def q_quick_profile(spark, d):
    return round_doubles(PR.quick_profile(apps(spark, d).drop("row_id")))


def _quick_sql():
    # kinds: strings categorical; numbers with > 10 distinct values numerical
    num = ["duration_months", "credit_amount", "age_years", "savings_amount"]
    # numeric columns with <= 10 levels are profiled as text, so mode ties order by text
    cat = [c for c in QP_COLS if c not in num]
    return (
        f", ln AS ({long_sql(num)}), lc AS ({long_sql(cat, 'VARCHAR')})"
        ", vn AS (SELECT variable, value, count(*) AS n FROM ln WHERE value IS NOT NULL GROUP BY ALL)"
        ", mn AS (SELECT variable, value AS mode FROM (SELECT variable, value, row_number() OVER"
        " (PARTITION BY variable ORDER BY n DESC, value) AS rk FROM vn) WHERE rk = 1)"
        ", vcc AS (SELECT variable, value, count(*) AS n FROM lc WHERE value IS NOT NULL GROUP BY ALL)"
        ", mc AS (SELECT variable, value AS mode FROM (SELECT variable, value, row_number() OVER"
        " (PARTITION BY variable ORDER BY n DESC, value) AS rk FROM vcc) WHERE rk = 1)"
        ", tc AS (SELECT variable, count(value) AS cnt FROM lc GROUP BY variable)"
        ", ent AS (SELECT variable, -sum((n / cnt) * log2(n / cnt + 1e-15)) AS entropy FROM vcc JOIN tc"
        " USING (variable) GROUP BY variable)"
        " SELECT variable, 'numerical' AS kind, count(value) AS count, count(*) - count(value) AS missing,"
        f" count(DISTINCT value) AS unique, CAST(any_value(mn.mode) AS VARCHAR) AS mode, {r('avg(value)')} AS mean,"
        f" {r('stddev_samp(value)')} AS std, {r('min(value)')} AS min, {r('max(value)')} AS max,"
        " CAST(NULL AS DOUBLE) AS entropy FROM ln JOIN mn USING (variable) GROUP BY variable"
        " UNION ALL SELECT variable, 'categorical', count(value), count(*) - count(value), count(DISTINCT value),"
        f" any_value(mc.mode), NULL, NULL, NULL, NULL, {r('any_value(ent.entropy)')} FROM lc JOIN mc USING (variable)"
        " JOIN ent USING (variable) GROUP BY variable")


Q["quick_profile"] = q_quick_profile
S["quick_profile"] = sql(_quick_sql())


def q_group_stats(spark, d):
    return round_doubles(PR.group_stats(apps(spark, d), "purpose", "credit_amount"))


Q["group_stats"] = q_group_stats
S["group_stats"] = sql(
    "SELECT purpose, count(*) AS count, round(avg(credit_amount), 6) AS mean,"
    " round(quantile_cont(CAST(credit_amount AS DOUBLE), 0.5), 6) AS median,"
    " round(stddev_samp(credit_amount), 6) AS std, CAST(min(credit_amount) AS DOUBLE) AS min,"
    " CAST(max(credit_amount) AS DOUBLE) AS max FROM applications"
    " WHERE purpose IS NOT NULL AND credit_amount IS NOT NULL GROUP BY purpose")


def q_crosstab(spark, d):
    return round_doubles(PR.crosstab(apps(spark, d), "checking_account_status", "class"))


Q["crosstab"] = q_crosstab
S["crosstab"] = sql(
    ", g AS (SELECT checking_account_status, class, count(*) AS n FROM applications GROUP BY ALL)"
    " SELECT checking_account_status, class, n, round(n * 100.0 / sum(n) OVER (), 6) AS pct_all,"
    " round(n * 100.0 / sum(n) OVER (PARTITION BY checking_account_status), 6) AS pct_row,"
    " round(n * 100.0 / sum(n) OVER (PARTITION BY class), 6) AS pct_col FROM g")


def q_histogram(spark, d):
    return round_doubles(PR.histogram(apps(spark, d), "credit_amount", 30))


Q["histogram"] = q_histogram
S["histogram"] = sql(
    ", rg AS (SELECT CAST(min(credit_amount) AS DOUBLE) AS lo, CAST(max(credit_amount) AS DOUBLE) AS hi,"
    " count(credit_amount) AS nn FROM applications)"
    ", b AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((credit_amount - lo) / (hi - lo) * 30), 29) END"
    " AS INTEGER) AS bin, lo, hi, nn FROM applications, rg WHERE credit_amount IS NOT NULL)"
    " SELECT bin, round(lo + bin * ((hi - lo) / 30), 6) AS bin_start, round(lo + (bin + 1) * ((hi - lo) / 30), 6)"
    " AS bin_end, count(*) AS count, round(count(*) / (nn * ((hi - lo) / 30)), 6) AS density FROM b"
    " GROUP BY bin, lo, hi, nn")


def _kde_round(df):
    return df.select(*[F.round(c, 10).alias(c) if c in ("x", "density") else F.col(c) for c in df.columns])


def q_kde_curve(spark, d):
    return _kde_round(PR.kde_curve(apps(spark, d), "age_years", grid=50))


def _kde_sql(group=None):
    g = f"{group}, " if group else ""
    on = f" USING ({group})" if group else " ON TRUE"
    return (
        f", base AS (SELECT {g}CAST(age_years AS DOUBLE) AS x FROM applications WHERE age_years IS NOT NULL)"
        f", vc AS (SELECT {g}x, count(*) AS c FROM base GROUP BY ALL)"
        f", st AS (SELECT {g}count(*) AS nn, min(x) AS lo, max(x) AS hi,"
        f" stddev_samp(x) * pow(count(*), -0.2) AS h FROM base {'GROUP BY ' + group if group else ''})"
        f", grid AS (SELECT i FROM range(0, 50) t(i))"
        f", e AS (SELECT {('vc.' + group + ', ') if group else ''}i, (st.lo - 3.0 * h) + ((st.hi + 3.0 * h)"
        f" - (st.lo - 3.0 * h)) * i / 49 AS gx, vc.x, c, nn, h FROM vc JOIN st{on} CROSS JOIN grid)"
        f" SELECT {g}CAST(i AS INTEGER) AS grid_index, round(gx, 10) AS x,"
        f" round(sum(c * exp(-0.5 * ((gx - x) / h) * ((gx - x) / h)) / (h * sqrt(2 * pi()))) / nn, 10)"
        f" AS density FROM e GROUP BY {g}i, gx, nn")


Q["kde_curve"] = q_kde_curve
S["kde_curve"] = sql(_kde_sql())


def q_kde_by_class(spark, d):
    return _kde_round(PR.kde_curve(apps(spark, d), "age_years", grid=50, group="class"))


Q["kde_curve_by_group"] = q_kde_by_class
S["kde_curve_by_group"] = sql(_kde_sql("class"))


def q_box_stats(spark, d):
    return round_doubles(PR.box_stats(apps(spark, d), "credit_amount", "housing"))


Q["box_stats"] = q_box_stats
S["box_stats"] = sql(
    ", q AS (SELECT housing, quantile_cont(CAST(credit_amount AS DOUBLE), 0.25) AS q1,"
    " quantile_cont(CAST(credit_amount AS DOUBLE), 0.5) AS median,"
    " quantile_cont(CAST(credit_amount AS DOUBLE), 0.75) AS q3 FROM applications GROUP BY housing)"
    ", j AS (SELECT a.housing, CAST(a.credit_amount AS DOUBLE) AS v, q1, median, q3, q3 - q1 AS iqr"
    " FROM applications a JOIN q USING (housing))"
    " SELECT housing, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(iqr, 6) AS iqr,"
    " round(min(CASE WHEN v >= q1 - 1.5 * iqr THEN v END), 6) AS whisker_low,"
    " round(max(CASE WHEN v <= q3 + 1.5 * iqr THEN v END), 6) AS whisker_high,"
    " CAST(sum(CASE WHEN v < q1 - 1.5 * iqr OR v > q3 + 1.5 * iqr THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers,"
    " count(*) AS n FROM j GROUP BY housing, q1, median, q3, iqr")


def q_density_2d(spark, d):
    return PR.density_2d(apps(spark, d), "duration_months", "credit_amount", 20)


Q["density_2d"] = q_density_2d
S["density_2d"] = sql(
    ", rg AS (SELECT CAST(min(duration_months) AS DOUBLE) AS x0, CAST(max(duration_months) AS DOUBLE) AS x1,"
    " CAST(min(credit_amount) AS DOUBLE) AS y0, CAST(max(credit_amount) AS DOUBLE) AS y1 FROM applications)"
    " SELECT CAST(CASE WHEN x1 = x0 THEN 0 ELSE least(floor((duration_months - x0) / (x1 - x0) * 20), 19) END"
    " AS INTEGER) AS x_bin, CAST(CASE WHEN y1 = y0 THEN 0 ELSE least(floor((credit_amount - y0) / (y1 - y0) * 20),"
    " 19) END AS INTEGER) AS y_bin, count(*) AS count FROM applications, rg GROUP BY ALL")


def q_trend_line(spark, d):
    return round_doubles(PR.trend_line(apps(spark, d), "duration_months", "credit_amount"))


Q["trend_line"] = q_trend_line
S["trend_line"] = sql(
    "SELECT count(*) AS n, round(regr_slope(credit_amount, duration_months), 6) AS slope,"
    " round(regr_intercept(credit_amount, duration_months), 6) AS intercept,"
    " round(regr_r2(credit_amount, duration_months), 6) AS r2 FROM applications"
    " WHERE credit_amount IS NOT NULL AND duration_months IS NOT NULL")


def q_seed_summary(spark, d):
    """Stability of the ensemble's metrics across the 5 stratified folds."""
    s = SP.kfold_assign(scored(spark, d), k=5, seed=8).withColumnRenamed("fold", "seed")
    s = EN.predict_threshold(EN.soft_vote(s))
    m = EV.class_metrics(s, group_cols=["seed"]).join(EV.cost_metric(s, group_cols=["seed"]), ["seed", "n"])
    return round_doubles(PR.seed_summary(m, ["accuracy", "f1", "avg_cost"]))


KEY8 = duck_md5_bucket("'8_' || CAST(row_id AS VARCHAR)", SP.HASH_KEY_MOD)
W = K.ENSEMBLE_WEIGHTS
S["seed_summary"] = sql(
    f", f AS (SELECT *, (row_number() OVER (PARTITION BY class ORDER BY {KEY8}, row_id) - 1) % 5 AS seed,"
    f" CAST((CAST({W[0]} AS DOUBLE) * proba_lrc + CAST({W[1]} AS DOUBLE) * proba_rfc + CAST({W[2]} AS DOUBLE)"
    f" * proba_svc) / CAST({sum(W)} AS DOUBLE) >= CAST({K.ENSEMBLE_THRESHOLD} AS DOUBLE) AS INTEGER) AS pred"
    " FROM scored)"
    ", c AS (SELECT seed, sum(CASE WHEN class = 1 AND pred = 1 THEN 1 ELSE 0 END) AS tp,"
    " sum(CASE WHEN class = 0 AND pred = 1 THEN 1 ELSE 0 END) AS fp,"
    " sum(CASE WHEN class = 1 AND pred = 0 THEN 1 ELSE 0 END) AS fn,"
    " sum(CASE WHEN class = 0 AND pred = 0 THEN 1 ELSE 0 END) AS tn, count(*) AS n FROM f GROUP BY seed)"
    ", m AS (SELECT seed, round(CAST(tp + tn AS DOUBLE) / n, 6) AS accuracy,"
    " round(coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,"
    f" round(CAST(fp * {K.COST_FP} + fn * {K.COST_FN} AS DOUBLE) / n, 6) AS avg_cost FROM c)"
    ", l AS (SELECT 'accuracy' AS metric, accuracy AS value FROM m UNION ALL SELECT 'f1', f1 FROM m"
    " UNION ALL SELECT 'avg_cost', avg_cost FROM m)"
    " SELECT metric, count(value) AS n_seeds, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std,"
    " round(min(value), 6) AS min, round(max(value), 6) AS max, round(max(value) - min(value), 6) AS range"
    " FROM l GROUP BY metric")
Q["seed_summary"] = q_seed_summary


def q_qq_points(spark, d):
    """Q-Q points of the engineered credit log with the fitted line attached."""
    from credspark.operators import features as FE
    pts, fit = PR.qq_points(FE.feature_engineer(apps(spark, d)), "credit_log")
    return round_doubles(pts.crossJoin(fit))  # fit: one row


Q["qq_points"] = q_qq_points
S["qq_points"] = sql(
    f", fe AS ({engineered_view()}), v AS (SELECT CAST(credit_log AS DOUBLE) AS value FROM fe WHERE credit_log IS NOT NULL)"
    ", o AS (SELECT row_number() OVER (ORDER BY value) AS i, value, count(*) OVER () AS n FROM v)"
    ", m AS (SELECT *, CASE WHEN i = n THEN pow(0.5, 1.0 / n) WHEN i = 1 THEN 1.0 - pow(0.5, 1.0 / n)"
    " ELSE (i - 0.3175) / (n + 0.365) END AS p FROM o)"
    f", z AS (SELECT *, {normal_quantile_sql('p')} AS q FROM m)"
    ", f AS (SELECT regr_slope(value, q) AS slope, regr_intercept(value, q) AS intercept, corr(value, q) AS r,"
    " count(*) AS n FROM z)"
    " SELECT z.i, round(z.value, 6) AS ordered_value, round(z.q, 6) AS theoretical_quantile, round(slope, 6) AS slope,"
    " round(intercept, 6) AS intercept, round(r, 6) AS r, f.n FROM z, f")
