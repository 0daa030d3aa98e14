"""Catalog: hypothesis tests and association measures.

Statistics are checked against SQL; p-values need tail functions DuckDB
lacks, so they are left out of the SQL-checked results and tested in pytest.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from credspark import constants as K
from credspark.functions.distributions import normal_quantile_sql
from credspark.operators import features as FE
from credspark.operators import stattests as ST
from credspark.plans.common import apps, qs, r, round_doubles, sql
from credspark.plans.q_features import engineered_view
from credspark.plans.q_profile import CAT, NUM, long_sql

Q: dict = {}
S: dict = {}


def _strength_sql(x):
    return (f"CASE WHEN abs({x}) < 0.1 THEN 'negligible' WHEN abs({x}) < 0.3 THEN 'weak' WHEN abs({x}) < 0.5"
            f" THEN 'moderate' WHEN abs({x}) < 0.7 THEN 'strong' ELSE 'very strong' END")


def _corr_sql(x, y, method, src, rx=None, ry=None):
    a, b = rx or x, ry or y
    return (f", c AS (SELECT count(*) AS n_pairs, corr({a}, {b}) AS rr FROM {src})"
            f" SELECT {qs(x)} AS variable1, {qs(y)} AS variable2, {qs(method)} AS method, n_pairs,"
            f" {r('rr')} AS correlation, {r('rr * rr')} AS r_squared, {r('rr * sqrt((n_pairs - 2) / (1 - rr * rr))')}"
            f" AS t_stat, {_strength_sql('rr')} AS strength, CASE WHEN rr > 0 THEN 'positive' ELSE 'negative' END"
            " AS direction FROM c WHERE n_pairs >= 3")


def q_corr_pearson(spark, d):
    return round_doubles(ST.corr_pearson(apps(spark, d), "duration_months", "credit_amount", with_p=False))


Q["corr_pearson"] = q_corr_pearson
S["corr_pearson"] = sql(
    ", p AS (SELECT CAST(duration_months AS DOUBLE) AS x, CAST(credit_amount AS DOUBLE) AS y FROM applications"
    " WHERE duration_months IS NOT NULL AND credit_amount IS NOT NULL)"
    + _corr_sql("duration_months", "credit_amount", "pearson", "p", "x", "y"))


def q_corr_spearman(spark, d):
    return round_doubles(ST.corr_spearman(apps(spark, d), "age_years", "savings_amount", with_p=False))


def _avg_rank_sql(c):
    return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0"


Q["corr_spearman"] = q_corr_spearman
S["corr_spearman"] = sql(
    ", p AS (SELECT CAST(age_years AS DOUBLE) AS x, savings_amount AS y FROM applications"
    " WHERE age_years IS NOT NULL AND savings_amount IS NOT NULL)"
    f", rk AS (SELECT {_avg_rank_sql('x')} AS rx, {_avg_rank_sql('y')} AS ry FROM p)"
    + _corr_sql("age_years", "savings_amount", "spearman", "rk", "rx", "ry"))


def q_point_biserial(spark, d):
    return round_doubles(ST.point_biserial(apps(spark, d), "credit_amount", with_p=False))


Q["point_biserial"] = q_point_biserial
S["point_biserial"] = sql(
    ", p AS (SELECT CAST(class AS DOUBLE) AS x, CAST(credit_amount AS DOUBLE) AS y FROM applications"
    " WHERE class IS NOT NULL AND credit_amount IS NOT NULL)"
    + _corr_sql("credit_amount", "class", "point_biserial", "p", "x", "y"))


def q_normality_dagostino(spark, d):
    out = round_doubles(ST.normality_dagostino(apps(spark, d), NUM))
    return out.select(*[F.round(c, 4).alias(c) if c in ("skew_z", "kurtosis_z", "k2") else F.col(c)
                        for c in out.columns])


def _dagostino_sql():
    n = "CAST(n AS DOUBLE)"
    y = f"(g1 * sqrt(({n} + 1) * ({n} + 3) / (6.0 * ({n} - 2))))"
    beta2 = (f"(3.0 * ({n} * {n} + 27 * {n} - 70) * ({n} + 1) * ({n} + 3) / (({n} - 2) * ({n} + 5) * ({n} + 7)"
             f" * ({n} + 9)))")
    w2 = f"(-1.0 + sqrt(2.0 * ({beta2} - 1)))"
    delta = f"(1.0 / sqrt(0.5 * ln({w2})))"
    alpha = f"sqrt(2.0 / ({w2} - 1))"
    yy = f"(CASE WHEN {y} = 0 THEN 1.0 ELSE {y} END)"
    zs = f"({delta} * ln({yy} / {alpha} + sqrt(({yy} / {alpha}) * ({yy} / {alpha}) + 1)))"
    b2 = "(g2 + 3.0)"
    e = f"(3.0 * ({n} - 1) / ({n} + 1))"
    varb2 = f"(24.0 * {n} * ({n} - 2) * ({n} - 3) / (({n} + 1) * ({n} + 1) * ({n} + 3) * ({n} + 5)))"
    x = f"(({b2} - {e}) / sqrt({varb2}))"
    sb1 = (f"(6.0 * ({n} * {n} - 5 * {n} + 2) / (({n} + 7) * ({n} + 9)) * sqrt(6.0 * ({n} + 3) * ({n} + 5)"
           f" / ({n} * ({n} - 2) * ({n} - 3))))")
    a = f"(6.0 + 8.0 / {sb1} * (2.0 / {sb1} + sqrt(1 + 4.0 / ({sb1} * {sb1}))))"
    term1 = f"(1.0 - 2.0 / (9.0 * {a}))"
    den = f"(1.0 + {x} * sqrt(2.0 / ({a} - 4.0)))"
    term2 = f"(sign({den}) * cbrt((1.0 - 2.0 / {a}) / abs({den})))"
    zk = f"(({term1} - {term2}) / sqrt(2.0 / (9.0 * {a})))"
    return (
        f", long AS ({long_sql(NUM)}), lx AS (SELECT * FROM long WHERE value IS NOT NULL)"
        ", mu AS (SELECT variable, avg(value) AS mean, count(*) AS n FROM lx GROUP BY variable)"
        ", mo AS (SELECT variable, n, avg(power(value - mean, 2)) AS m2, avg(power(value - mean, 3)) AS m3,"
        " avg(power(value - mean, 4)) AS m4 FROM lx JOIN mu USING (variable) GROUP BY variable, n)"
        ", g AS (SELECT variable, n, m3 / power(m2, 1.5) AS g1, m4 / (m2 * m2) - 3 AS g2 FROM mo WHERE n >= 20)"
        f", z AS (SELECT variable, n, {zs} AS zs, {zk} AS zk FROM g)"
        f" SELECT variable, n, {r('zs', 4)} AS skew_z, {r('zk', 4)} AS kurtosis_z, {r('zs * zs + zk * zk', 4)} AS k2,"
        f" {r('exp(-(zs * zs + zk * zk) / 2.0)')} AS p_value, exp(-(zs * zs + zk * zk) / 2.0) > 0.05 AS normal FROM z")


Q["normality_dagostino"] = q_normality_dagostino
S["normality_dagostino"] = sql(_dagostino_sql())


def q_normality_shapiro(spark, d):
    """Shapiro-Wilk of three engineered features, per checking status, over every row."""
    a = FE.feature_engineer(apps(spark, d))
    return round_doubles(ST.normality_shapiro(a, ["credit_log", "age_years", "duration_to_age_ratio_sqrt"],
                                              group="checking_account_status"))


Q["normality_shapiro"] = q_normality_shapiro

SHAPIRO_COLS = ["credit_log", "age_years", "duration_to_age_ratio_sqrt"]


def q_normality_shapiro_w(spark, d):
    """The statistic alone, per checking status: no Python in the plan."""
    a = FE.feature_engineer(apps(spark, d))
    return round_doubles(ST.normality_shapiro(a, SHAPIRO_COLS, group="checking_account_status", with_p=False))


def _shapiro_sql():
    long = " UNION ALL ".join(f"SELECT '{c}' AS variable, checking_account_status AS grp, CAST({c} AS DOUBLE) AS value"
                              f" FROM fe WHERE {c} IS NOT NULL" for c in SHAPIRO_COLS)
    poly = lambda c, x: "".join("(" for _ in c[1:]) + repr(c[-1]) + "".join(
        f" * {x} + {v!r})" for v in reversed(c[:-1]))
    return sql(
        f", fe AS ({engineered_view()}), l AS ({long})"
        ", o AS (SELECT *, row_number() OVER (PARTITION BY variable, grp ORDER BY value) AS i,"
        " count(*) OVER (PARTITION BY variable, grp) AS n, avg(value) OVER (PARTITION BY variable, grp) AS mean FROM l)"
        ", p AS (SELECT *, (i - 0.375) / (n + 0.25) AS p FROM o)"
        f", m AS (SELECT *, {normal_quantile_sql('p')} AS m FROM p)"
        ", g AS (SELECT variable, grp, n, sum(m * m) AS s2, sum(CASE WHEN i > 2 AND i < n - 1 THEN m * value END) AS si,"
        " sum((value - mean) * (value - mean)) AS ssq, max(CASE WHEN i = 1 THEN value END) AS x1,"
        " max(CASE WHEN i = 2 THEN value END) AS x2, max(CASE WHEN i = n - 1 THEN value END) AS xn1,"
        " max(CASE WHEN i = n THEN value END) AS xn, max(CASE WHEN i = n THEN m END) AS mn,"
        " max(CASE WHEN i = n - 1 THEN m END) AS mn1, 1.0 / sqrt(n) AS u FROM m GROUP BY variable, grp, n)"
        f", a AS (SELECT *, {poly(ST._SW_C1, 'u')} + mn / sqrt(s2) AS a1, {poly(ST._SW_C2, 'u')} + mn1 / sqrt(s2) AS a2"
        " FROM g)"
        ", f AS (SELECT *, sqrt((s2 - 2 * mn * mn - 2 * mn1 * mn1) / (1 - 2 * a1 * a1 - 2 * a2 * a2)) AS fac FROM a)"
        " SELECT variable, grp, CAST(n AS BIGINT) AS n, round(least(pow(si / fac + a1 * (xn - x1) + a2 * (xn1 - x2), 2)"
        " / ssq, 1.0), 6) AS w, n > 5000 AS p_extrapolated FROM f WHERE n >= 8")


Q["normality_shapiro_w"] = q_normality_shapiro_w
S["normality_shapiro_w"] = _shapiro_sql()



def _with_p(test):
    """The test with its p-value and flags: rows only, since DuckDB has no such tails."""
    return lambda spark, d: round_doubles(test(apps(spark, d)))


Q["corr_pearson_p"] = _with_p(lambda a: ST.corr_pearson(a, "duration_months", "credit_amount"))
Q["corr_spearman_p"] = _with_p(lambda a: ST.corr_spearman(a, "duration_months", "credit_amount"))
Q["ttest_ind_p"] = _with_p(lambda a: ST.ttest_ind(a, "class", "credit_amount"))
Q["mann_whitney_u_p"] = _with_p(lambda a: ST.mann_whitney_u(a, "class", "credit_amount"))
Q["anova_oneway_p"] = _with_p(lambda a: ST.anova_oneway(a, "purpose", "credit_amount"))
Q["kruskal_wallis_p"] = _with_p(lambda a: ST.kruskal_wallis(a, "purpose", "credit_amount"))
Q["levene_p"] = _with_p(lambda a: ST.levene(a, "purpose", "credit_amount"))
Q["chi2_independence_p"] = _with_p(lambda a: ST.chi2_independence(a, "purpose", "class"))
for _g, _par in (("class", True), ("class", False), ("purpose", True), ("purpose", False)):
    Q[f"compare_groups_{_g}_{'mean' if _par else 'rank'}"] = _with_p(
        lambda a, g=_g, par=_par: ST.compare_groups(a, g, "credit_amount", parametric=par))


def q_chi2_expected(spark, d):
    return round_doubles(ST.chi2_expected(apps(spark, d), "purpose", "class"))


Q["chi2_expected"] = q_chi2_expected
S["chi2_expected"] = sql(
    ", o AS (SELECT purpose, CAST(class AS VARCHAR) AS class, count(*) AS n FROM applications"
    " WHERE purpose IS NOT NULL AND class IS NOT NULL GROUP BY ALL)"
    ", rt AS (SELECT purpose, sum(n) AS r FROM o GROUP BY 1), ct AS (SELECT class, sum(n) AS c FROM o GROUP BY 1)"
    " SELECT rt.purpose, ct.class, CAST(coalesce(o.n, 0) AS BIGINT) AS observed,"
    f" {r('CAST(r AS DOUBLE) * c / (SELECT sum(n) FROM o)')} AS expected"
    " FROM rt CROSS JOIN ct LEFT JOIN o ON o.purpose = rt.purpose AND o.class = ct.class")

GROUP_FIRST = (", sub AS (SELECT class AS g, CAST(credit_amount AS DOUBLE) AS x, row_id FROM applications"
               " WHERE class IS NOT NULL AND credit_amount IS NOT NULL)"
               ", ord AS (SELECT g, row_number() OVER (ORDER BY min(row_id)) - 1 AS gi FROM sub GROUP BY g)")


def q_ttest_ind(spark, d):
    return round_doubles(ST.ttest_ind(apps(spark, d), "class", "credit_amount", with_p=False))


Q["ttest_ind"] = q_ttest_ind
S["ttest_ind"] = sql(
    GROUP_FIRST + ", mo AS (SELECT g, count(*) AS n, avg(x) AS m, var_samp(x) AS v FROM sub GROUP BY g)"
    ", a AS (SELECT mo.g AS group1, n AS n1, m AS m1, v AS v1 FROM mo JOIN ord USING (g) WHERE gi = 0)"
    ", b AS (SELECT mo.g AS group2, n AS n2, m AS m2, v AS v2 FROM mo JOIN ord USING (g) WHERE gi = 1)"
    ", j AS (SELECT *, ((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) AS sp2 FROM a, b)"
    f" SELECT CAST(group1 AS INTEGER) AS group1, CAST(group2 AS INTEGER) AS group2, n1, n2,"
    f" {r('(m1 - m2) / sqrt(sp2 * (1.0 / n1 + 1.0 / n2))')} AS t_stat, CAST(n1 + n2 - 2 AS BIGINT) AS dof,"
    f" {r('CASE WHEN sqrt(sp2) > 0 THEN (m1 - m2) / sqrt(sp2) ELSE 0 END')} AS cohens_d,"
    " CASE WHEN abs((m1 - m2) / sqrt(sp2)) < 0.2 THEN 'small' WHEN abs((m1 - m2) / sqrt(sp2)) < 0.8 THEN 'medium'"
    " ELSE 'large' END AS effect_label FROM j")

RANKSUMS = (
    ", ranks AS (SELECT x, count(*) AS t, sum(count(*)) OVER (ORDER BY x ROWS UNBOUNDED PRECEDING) - count(*)"
    " + (count(*) + 1) / 2.0 AS rk FROM sub GROUP BY x)"
    ", rs AS (SELECT g, count(*) AS n, sum(rk) AS rsum FROM sub JOIN ranks USING (x) GROUP BY g)"
    ", ties AS (SELECT sum(t * t * t - t) AS tie, sum(t) AS nn FROM ranks)")


def q_mann_whitney_u(spark, d):
    return round_doubles(ST.mann_whitney_u(apps(spark, d), "class", "credit_amount", with_p=False))


Q["mann_whitney_u"] = q_mann_whitney_u
S["mann_whitney_u"] = sql(
    GROUP_FIRST + RANKSUMS
    + ", a AS (SELECT rs.g AS group1, n AS n1, rsum AS r1 FROM rs JOIN ord USING (g) WHERE gi = 0)"
    ", b AS (SELECT rs.g AS group2, n AS n2 FROM rs JOIN ord USING (g) WHERE gi = 1)"
    ", j AS (SELECT *, r1 - n1 * (n1 + 1) / 2.0 AS u1 FROM a, b, ties)"
    " SELECT CAST(group1 AS INTEGER) AS group1, CAST(group2 AS INTEGER) AS group2, n1, n2, round(u1, 6) AS u_stat,"
    " round((greatest(u1, n1 * n2 - u1) - n1 * n2 / 2.0 - 0.5) / sqrt(n1 * n2 / 12.0 * ((nn + 1) - tie"
    " / (CAST(nn AS DOUBLE) * (nn - 1)))), 6) AS z FROM j")

PURPOSE_SUB = (", sub AS (SELECT purpose AS g, CAST(credit_amount AS DOUBLE) AS x FROM applications"
               " WHERE purpose IS NOT NULL AND credit_amount IS NOT NULL)")


def _anova_tail(src_mo: str, stat: str = "f_stat", with_effect: bool = True) -> str:
    eff = (", CASE WHEN ssb + ssw > 0 THEN ssb / (ssb + ssw) ELSE 0 END AS eta" if with_effect else "")
    out = (f", tot AS (SELECT sum(n) AS nn, sum(n * m) / sum(n) AS gm, count(*) AS k FROM {src_mo})"
           f", ss AS (SELECT nn, k, sum(n * (m - gm) * (m - gm)) AS ssb, sum(coalesce((n - 1) * v, 0)) AS ssw"
           f" FROM {src_mo}, tot GROUP BY nn, k)"
           f", fin AS (SELECT k, nn, (ssb / (k - 1)) / (ssw / (nn - k)) AS f{eff} FROM ss)")
    return out


def q_anova_oneway(spark, d):
    return round_doubles(ST.anova_oneway(apps(spark, d), "purpose", "credit_amount", with_p=False))


Q["anova_oneway"] = q_anova_oneway
S["anova_oneway"] = sql(
    PURPOSE_SUB + ", mo AS (SELECT g, count(*) AS n, avg(x) AS m, var_samp(x) AS v FROM sub GROUP BY g)"
    + _anova_tail("mo")
    + " SELECT k AS n_groups, CAST(nn AS BIGINT) AS total_n, round(f, 6) AS f_stat, k - 1 AS df_between,"
    " CAST(nn - k AS BIGINT) AS df_within,"
    " round(eta, 6) AS eta_squared, CASE WHEN eta < 0.01 THEN 'small' WHEN eta < 0.06 THEN 'medium' ELSE 'large'"
    " END AS effect_label FROM fin")


def q_kruskal_wallis(spark, d):
    return round_doubles(ST.kruskal_wallis(apps(spark, d), "purpose", "credit_amount", with_p=False))


Q["kruskal_wallis"] = q_kruskal_wallis
S["kruskal_wallis"] = sql(
    PURPOSE_SUB + RANKSUMS
    + ", h AS (SELECT count(*) AS k, sum(rsum * rsum / n) AS s FROM rs)"
    " SELECT k AS n_groups, CAST(nn AS BIGINT) AS total_n, round((12.0 / (CAST(nn AS DOUBLE) * (nn + 1)) * s - 3 * (nn + 1))"
    " / (1 - tie / (CAST(nn AS DOUBLE) * nn * nn - nn)), 6) AS h_stat, k - 1 AS dof FROM h, ties")

LEVENE_SQL = (
    ", med AS (SELECT g, quantile_cont(x, 0.5) AS md FROM sub GROUP BY g)"
    ", z AS (SELECT g, abs(x - md) AS x FROM sub JOIN med USING (g))"
    ", mz AS (SELECT g, count(*) AS n, avg(x) AS m, var_samp(x) AS v FROM z GROUP BY g)")


def q_levene(spark, d):
    return round_doubles(ST.levene(apps(spark, d), "purpose", "credit_amount", with_p=False))


Q["levene"] = q_levene
S["levene"] = sql(
    PURPOSE_SUB + LEVENE_SQL + _anova_tail("mz", with_effect=False)
    + " SELECT k AS n_groups, CAST(nn AS BIGINT) AS total_n, round(f, 6) AS levene_stat, k - 1 AS df_between,"
    " CAST(nn - k AS BIGINT) AS df_within FROM fin WHERE (SELECT min(n) FROM mz) >= 2")


def q_compare_groups(spark, d):
    return round_doubles(ST.compare_groups(apps(spark, d), "housing", "duration_months", parametric=True,
                                           with_p=False))


Q["compare_groups"] = q_compare_groups
S["compare_groups"] = sql(
    ", sub AS (SELECT housing AS g, CAST(duration_months AS DOUBLE) AS x FROM applications"
    " WHERE housing IS NOT NULL AND duration_months IS NOT NULL)"
    ", mo AS (SELECT g, count(*) AS n, avg(x) AS m, var_samp(x) AS v FROM sub GROUP BY g)"
    + _anova_tail("mo").replace("fin AS", "fa AS").replace("tot AS", "tota AS").replace("ss AS", "ssa AS")
    .replace("FROM mo, tot", "FROM mo, tota").replace("FROM ss)", "FROM ssa)")
    + LEVENE_SQL + _anova_tail("mz", with_effect=False)
    + " SELECT fa.k AS n_groups, 'One-way ANOVA' AS test_name, round(fa.f, 6) AS statistic,"
    " round(fa.eta, 6) AS effect_size, 'Eta-squared' AS effect_size_name,"
    " CASE WHEN fa.eta < 0.01 THEN 'small' WHEN fa.eta < 0.06 THEN 'medium' ELSE 'large' END AS effect_label,"
    " round(fin.f, 6) AS levene_stat FROM fa, fin")


def _chi2_sql(a: str, b: str, yates: bool = True, x: str = "") -> str:
    """CTEs obs{x} .. v{x} computing chi-square on ALL cells of the table."""
    return (
        f", obs{x} AS (SELECT CAST({a} AS VARCHAR) AS a, CAST({b} AS VARCHAR) AS b, count(*) AS o FROM applications"
        f" WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL)"
        f", rt{x} AS (SELECT a, sum(o) AS rr FROM obs{x} GROUP BY a), ct{x} AS (SELECT b, sum(o) AS cc FROM obs{x}"
        f" GROUP BY b), nt{x} AS (SELECT sum(o) AS nn FROM obs{x})"
        f", cells{x} AS (SELECT r1.a, c1.b, rr, cc, coalesce(o, 0) AS o, CAST(rr AS DOUBLE) * cc / nn AS e"
        f" FROM rt{x} r1 CROSS JOIN ct{x} c1 CROSS JOIN nt{x} LEFT JOIN obs{x} o1 ON o1.a = r1.a AND o1.b = c1.b)"
        f", dims{x} AS (SELECT (SELECT count(*) FROM rt{x}) AS r, (SELECT count(*) FROM ct{x}) AS c, nn FROM nt{x})"
        f", st{x} AS (SELECT sum((o - e) * (o - e) / e) AS plain,"
        " sum(greatest(abs(o - e) - 0.5, 0) * greatest(abs(o - e) - 0.5, 0) / e) AS yates,"
        f" min(e) AS min_e, sum(CASE WHEN e < 5 THEN 1 ELSE 0 END) * 100.0 / count(*) AS pct_low FROM cells{x})"
        f", fin{x} AS (SELECT r, c, nn, (r - 1) * (c - 1) AS dof, CASE WHEN (r - 1) * (c - 1) = 1 AND "
        + ("TRUE" if yates else "FALSE") + f" THEN yates ELSE plain END AS chi2, min_e, pct_low FROM dims{x}, st{x})"
        f", v{x} AS (SELECT *, CASE WHEN least(r, c) - 1 > 0 AND nn > 0 THEN sqrt(chi2 / (nn * (least(r, c) - 1)))"
        f" ELSE 0 END AS cv FROM fin{x})")


def _chi2_select(a, b):
    return (f" SELECT {qs(a)} AS variable1, {qs(b)} AS variable2, CAST(nn AS BIGINT) AS n_obs, round(chi2, 6) AS chi2_stat, dof,"
            " round(min_e, 6) AS min_expected, round(pct_low, 6) AS pct_cells_low_expected,"
            " min_e >= 5 AS assumption_met, round(cv, 6) AS cramers_v, CASE WHEN cv < 0.1 THEN 'negligible'"
            " WHEN cv < 0.3 THEN 'small' WHEN cv < 0.5 THEN 'medium' ELSE 'large' END AS effect_label FROM v")


def q_chi2_independence(spark, d):
    return round_doubles(ST.chi2_independence(apps(spark, d), "checking_account_status", "class", with_p=False))


Q["chi2_independence"] = q_chi2_independence
S["chi2_independence"] = sql(_chi2_sql("checking_account_status", "class")
                             + _chi2_select("checking_account_status", "class"))


def q_chi2_yates(spark, d):
    return round_doubles(ST.chi2_independence(apps(spark, d), "telephone", "class", with_p=False))


Q["chi2_independence_2x2_yates"] = q_chi2_yates
S["chi2_independence_2x2_yates"] = sql(_chi2_sql("telephone", "class") + _chi2_select("telephone", "class"))


def q_cramers_v(spark, d):
    return round_doubles(ST.cramers_v(apps(spark, d), "purpose", "class"))


Q["cramers_v"] = q_cramers_v
S["cramers_v"] = sql(
    _chi2_sql("purpose", "class") + " SELECT 'purpose' AS variable1, 'class' AS variable2, CAST(nn AS BIGINT) AS n_obs,"
    " round(cv, 6) AS cramers_v, CASE WHEN cv < 0.1 THEN 'negligible' WHEN cv < 0.3 THEN 'small'"
    " WHEN cv < 0.5 THEN 'medium' ELSE 'large' END AS effect_label FROM v")

FTA_NUM = NUM
FTA_CAT = CAT


def q_feature_target_association(spark, d):
    return round_doubles(ST.feature_target_association(apps(spark, d), FTA_NUM, FTA_CAT, with_p=False))


def _fta_sql():
    nums = " UNION ALL ".join(
        f"SELECT {qs(c)} AS feature, corr(CAST(class AS DOUBLE), CAST({c} AS DOUBLE)) AS correlation,"
        f" 'point_biserial' AS method FROM applications WHERE {c} IS NOT NULL AND class IS NOT NULL" for c in FTA_NUM)
    cats = [(c, _chi2_sql(c, "class", True, f"_{c}").lstrip(", ")) for c in FTA_CAT]
    ctes = ", ".join(b for _, b in cats)
    cat_sel = " UNION ALL ".join(f"SELECT {qs(c)} AS feature, cv AS correlation, 'cramers_v' AS method FROM v_{c}"
                                 for c, _ in cats)
    return (f", {ctes}, allf AS ({nums} UNION ALL {cat_sel})"
            " SELECT feature, round(correlation, 6) AS correlation, round(abs(correlation), 6) AS abs_correlation,"
            " method, CASE WHEN abs(correlation) >= 0.3 THEN 'strong' WHEN abs(correlation) >= 0.1 THEN 'moderate'"
            " ELSE 'weak' END AS strength FROM allf")


Q["feature_target_association"] = q_feature_target_association
S["feature_target_association"] = sql(_fta_sql())

PAIR_COLS = ["credit_amount", "credit_amount_squared", "credit_log", "duration_months", "duration_log",
             "monthly_burden", "age_years", "duration_to_age_ratio"]


def q_correlated_pairs(spark, d):
    return round_doubles(ST.correlated_pairs(FE.feature_engineer(apps(spark, d)), PAIR_COLS, 0.7))


def _pairs_sql():
    from credspark.plans.q_features import engineered_view
    pairs = [(a, b) for i, a in enumerate(PAIR_COLS) for b in PAIR_COLS[i + 1:]]
    body = " UNION ALL ".join(f"SELECT {qs(a)} AS feature_1, {qs(b)} AS feature_2,"
                              f" corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS correlation FROM fe"
                              for a, b in pairs)
    return (f", fe AS ({engineered_view()}), pr AS ({body})"
            " SELECT feature_1, feature_2, round(correlation, 6) AS correlation FROM pr WHERE abs(correlation) >= 0.7")


Q["correlated_pairs"] = q_correlated_pairs
S["correlated_pairs"] = sql(_pairs_sql())


def q_vif(spark, d):
    """VIF of two engineered features (closed form in SQL: ab / (ab - c²))."""
    return round_doubles(ST.vif(FE.feature_engineer(apps(spark, d)), ["duration_log", "credit_log"]))


def _vif_sql():
    from credspark.plans.q_features import engineered_view
    return (f", fe AS ({engineered_view()}), g AS (SELECT sum(duration_log * duration_log) AS a,"
            " sum(credit_log * credit_log) AS b, sum(duration_log * credit_log) AS c FROM fe"
            " WHERE duration_log IS NOT NULL AND credit_log IS NOT NULL)"
            ", v AS (SELECT 'duration_log' AS feature, a * b / (a * b - c * c) AS vif FROM g UNION ALL"
            " SELECT 'credit_log', a * b / (a * b - c * c) FROM g)"
            " SELECT feature, round(vif, 6) AS vif, CASE WHEN vif >= 10 THEN 'High' WHEN vif >= 5 THEN 'Moderate'"
            " ELSE 'OK' END AS status FROM v")


Q["vif"] = q_vif
S["vif"] = sql(_vif_sql())

VIF_COLS = ["duration_months", "credit_amount", "age_years", "installment_rate_pct_of_disp_income",
            "present_residence_since", "existing_credits_count", "credit_log", "duration_log", "monthly_burden"]


def q_vif_many(spark, d):
    return round_doubles(ST.vif(FE.feature_engineer(apps(spark, d)), VIF_COLS))


Q["vif_many"] = q_vif_many


def q_suggest_drops(spark, d):
    return ST.suggest_drops(FE.feature_engineer(apps(spark, d)), VIF_COLS)


Q["suggest_drops"] = q_suggest_drops
