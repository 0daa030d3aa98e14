"""Hand-checked values on the tiny inputs of the source's docstrings."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from credspark.functions import distributions as D
from credspark.operators import profile as PR
from credspark.operators import stattests as ST


def approx(x, rel=1e-6, abs_=1e-9):
    return pytest.approx(x, rel=rel, abs=abs_)


def test_profile_numeric_1_to_10(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)], "values double")
    r = PR.profile_numeric(df, ["values"]).first()
    assert r["count"] == 10 and r["missing"] == 0 and r["unique"] == 10
    assert r["mean"] == approx(5.5) and r["median"] == approx(5.5) and r["mode"] == approx(1.0)
    assert r["std"] == approx(3.0276503540974917) and r["variance"] == approx(9.166666666666666)
    assert r["iqr"] == approx(4.5) and r["skewness"] == approx(0.0, abs_=1e-12)
    assert r["kurtosis"] == approx(-1.2)
    assert r["cv"] == approx(3.0276503540974917 / 5.5 * 100)


def test_skew_kurtosis_corrections(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (10.0,)], "x double")
    r = PR.profile_numeric(df, ["x"]).first()
    assert r["skewness"] == approx(1.6971, rel=1e-4)
    assert r["kurtosis"] == approx(3.152, rel=1e-3)


def test_percentiles_linear(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)], "v double")
    r = PR.percentile_table(df, ["v"]).first()
    assert r["p25"] == approx(3.25) and r["p75"] == approx(7.75) and r["p1"] == approx(1.09)
    assert r["p99"] == approx(9.91)


def test_profile_categorical_docstring(spark):
    df = spark.createDataFrame([(c,) for c in "ABACBA"], "category string")
    r = PR.profile_categorical(df, ["category"]).first()
    assert r["count"] == 6 and r["unique"] == 3 and r["mode"] == "A" and r["mode_count"] == 3
    ent = -(0.5 * math.log2(0.5) + (1 / 3) * math.log2(1 / 3) + (1 / 6) * math.log2(1 / 6))
    assert r["entropy"] == approx(ent, rel=1e-9)
    assert r["gini_impurity"] == approx(1 - (0.25 + 1 / 9 + 1 / 36))


def test_mode_ties_smallest(spark):
    df = spark.createDataFrame([(3.0,), (1.0,), (3.0,), (1.0,), (2.0,)], "x double")
    assert PR.profile_numeric(df, ["x"]).first()["mode"] == 1.0


def test_pearson_spearman_docstring(spark):
    df = spark.createDataFrame(list(zip([1, 2, 3, 4, 5], [2, 4, 5, 4, 5], range(5))), "x int, y int, row_id long")
    p = ST.corr_pearson(df, "x", "y").first()
    assert p["correlation"] == approx(0.7745966692414834)
    assert p["p_value"] == approx(0.12402706265755, rel=1e-6)
    assert p["strength"] == "very strong" and p["direction"] == "positive"
    s = ST.corr_spearman(df, "x", "y").first()
    # ranks: x 1..5, y 1, 2.5, 4.5, 2.5, 4.5 -> rho = 7 / sqrt(90)
    rho = 7 / math.sqrt(90)
    assert s["correlation"] == approx(rho)
    assert s["p_value"] == approx(D.two_sided_t(rho * math.sqrt(3 / (1 - rho * rho)), 3), rel=1e-9)


def _groups(spark):
    rows = list(zip("AABBCC", [1.2, 1.5, 2.1, 2.3, 3.0, 3.2], range(6)))
    return spark.createDataFrame(rows, "group string, value double, row_id long")


def test_anova_kruskal_levene_docstring(spark):
    df = _groups(spark)
    a = ST.anova_oneway(df, "group", "value").first()
    ssb = 2 * ((1.35 - 2.2166666666666663) ** 2 + (2.2 - 2.2166666666666663) ** 2 + (3.1 - 2.2166666666666663) ** 2)
    f = (ssb / 2) / (0.085 / 3)
    assert a["f_stat"] == approx(f, rel=1e-9)
    assert a["p_value"] == approx(D.f_sf(f, 2, 3), rel=1e-9)
    assert a["eta_squared"] == approx(ssb / (ssb + 0.085))
    k = ST.kruskal_wallis(df, "group", "value").first()
    h = 12 / 42 * (9 / 2 + 49 / 2 + 121 / 2) - 21
    assert k["h_stat"] == approx(h) and k["p_value"] == approx(math.exp(-h / 2), rel=1e-9)
    rows = list(zip("AAABBBCCC", [1.0, 2.0, 4.0, 2.0, 3.0, 3.0, 5.0, 7.0, 12.0]))
    lv = ST.levene(spark.createDataFrame(rows, "group string, value double"), "group", "value").first()
    # |x - median|: A 1,0,2  B 1,0,0  C 2,0,5 -> SSB = 504/81, SSW = 46/3
    assert lv["levene_stat"] == approx((504 / 81 / 2) / (46 / 3 / 6))
    assert lv["p_value"] == approx(D.f_sf((504 / 81 / 2) / (46 / 3 / 6), 2, 6), rel=1e-9)


def test_ttest_and_u(spark):
    rows = [("a", x, i) for i, x in enumerate([1.0, 2.0, 3.0, 4.0, 5.0])] + \
           [("b", x, 10 + i) for i, x in enumerate([2.0, 4.0, 6.0, 8.0, 10.0])]
    df = spark.createDataFrame(rows, "g string, v double, row_id long")
    t = ST.ttest_ind(df, "g", "v").first()
    # means 3 and 6, variances 2.5 and 10 -> sp2 = 6.25, t = -3 / sqrt(6.25 * 0.4) = -1.897366
    assert t["t_stat"] == approx(-1.8973665961010275) and t["dof"] == 8
    assert t["cohens_d"] == approx(-1.2) and t["effect_label"] == "large"
    assert t["p_value"] == approx(2 * D.t_sf(1.8973665961010275, 8), rel=1e-9)
    u = ST.mann_whitney_u(df, "g", "v").first()
    # pooled ranks: a = 1, 2.5, 4, 5.5, 7 (ties at 2 and 4); R1 = 20 -> U1 = 5
    assert u["u_stat"] == approx(5.0)


def test_chi2_yates_and_cramers(spark):
    rows = list(zip("AABBAB", "XYXYYX"))
    df = spark.createDataFrame(rows, "a string, b string")
    r = ST.chi2_independence(df, "a", "b").first()
    assert r["chi2_stat"] == approx(0.0, abs_=1e-12) and r["dof"] == 1 and r["p_value"] == approx(1.0)
    assert r["cramers_v"] == approx(0.0, abs_=1e-12) and r["min_expected"] == approx(1.5)
    assert r["pct_cells_low_expected"] == approx(100.0) and r["assumption_met"] is False
    r2 = ST.chi2_independence(df, "a", "b", yates=False).first()
    assert r2["chi2_stat"] == approx(0.6666666666666666)


def test_chi2_zero_cells_match_full_table(spark):
    rows = [("a", "x")] * 10 + [("a", "y")] * 3 + [("b", "y")] * 8 + [("c", "x")] * 5 + [("c", "z")] * 2
    df = spark.createDataFrame(rows, "a string, b string")
    r = ST.chi2_independence(df, "a", "b").first()
    obs = {("a", "x"): 10, ("a", "y"): 3, ("b", "y"): 8, ("c", "x"): 5, ("c", "z"): 2}
    R = {"a": 13, "b": 8, "c": 7}
    C = {"x": 15, "y": 11, "z": 2}
    n = 28
    chi = sum((obs.get((i, j), 0) - R[i] * C[j] / n) ** 2 / (R[i] * C[j] / n) for i in R for j in C)
    assert r["chi2_stat"] == approx(chi) and r["dof"] == 4
    low = sum(1 for i in R for j in C if R[i] * C[j] / n < 5)
    assert r["pct_cells_low_expected"] == approx(low * 100 / 9)


def test_dagostino_and_shapiro_behave(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    normal = rng.normal(size=400)
    skewed = rng.exponential(size=400)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(normal, skewed)], "n double, e double")
    d = {r["variable"]: r for r in ST.normality_dagostino(df, ["n", "e"]).collect()}
    assert d["n"]["p_value"] > 0.01 and d["e"]["p_value"] < 1e-6
    s = {r["variable"]: r for r in ST.normality_shapiro(df, ["n", "e"]).collect()}
    assert 0.99 < s["n"]["w"] <= 1.0 and s["n"]["p_value"] > 0.01
    assert s["e"]["w"] < 0.95 and s["e"]["p_value"] < 1e-6


def test_shapiro_matches_direct_numpy(spark):
    """W from distributed order statistics equals the same formula on one machine."""
    import numpy as np
    from credspark.functions.distributions import norm_ppf
    x = np.array([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236], dtype=float)
    n = len(x)
    m = norm_ppf((np.arange(1, n + 1) - 0.375) / (n + 0.25))
    summ2 = (m ** 2).sum()
    u = 1 / math.sqrt(n)
    c1 = [0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056]
    c2 = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
    poly = lambda c, v: sum(ci * v ** i for i, ci in enumerate(c))
    a1 = poly(c1, u) + m[-1] / math.sqrt(summ2)
    a2 = poly(c2, u) + m[-2] / math.sqrt(summ2)
    fac = math.sqrt((summ2 - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * a1 ** 2 - 2 * a2 ** 2))
    a = m / fac
    a[0], a[1], a[-2], a[-1] = -a1, -a2, a2, a1
    w = (a @ np.sort(x)) ** 2 / ((x - x.mean()) ** 2).sum()
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    r = ST.normality_shapiro(df, ["x"]).first()
    assert r["w"] == approx(w, rel=1e-9)
    assert 0.7 < r["w"] < 0.85 and r["p_value"] < 0.01


def test_distributions_known_values():
    assert D.t_sf(2.0, 10) == approx(0.036694017385370, rel=1e-9)
    assert D.chi2_sf(3.841458820694124, 1) == approx(0.05, rel=1e-9)
    assert D.chi2_sf(10.0, 4) == approx(0.040427681994512805, rel=1e-9)
    assert D.f_sf(3.0, 2, 20) == approx(1.3 ** -10, rel=1e-9)
    assert D.norm_sf(1.959963984540054) == approx(0.025, rel=1e-9)
    import numpy as np
    from statistics import NormalDist
    ps = np.array([1e-10, 0.01, 0.3, 0.5, 0.9, 0.999])
    assert np.allclose(D.norm_ppf(ps), [NormalDist().inv_cdf(p) for p in ps], rtol=1e-12, atol=1e-12)


def test_vif_two_features(spark):
    rows = [(1.0, 2.0), (2.0, 3.5), (3.0, 7.0), (4.0, 8.0), (5.0, 9.5)]
    df = spark.createDataFrame(rows, "a double, b double")
    v = {r["feature"]: r["vif"] for r in ST.vif(df, ["a", "b"]).collect()}
    aa = sum(x * x for x, _ in rows)
    bb = sum(y * y for _, y in rows)
    ab = sum(x * y for x, y in rows)
    assert v["a"] == approx(aa * bb / (aa * bb - ab * ab)) and v["b"] == approx(v["a"])


def test_feature_target_association_sorted(spark):
    rows = [(i % 2, float(i % 2) + 0.1 * (i % 7), "p" if i % 3 else "q", i) for i in range(60)]
    df = spark.createDataFrame(rows, "class int, num double, cat string, row_id long")
    out = ST.feature_target_association(df, ["num"], ["cat"]).collect()
    assert [r["abs_correlation"] for r in out] == sorted([r["abs_correlation"] for r in out], reverse=True)
    assert {r["method"] for r in out} == {"point_biserial", "cramers_v"}
    assert F is not None


def test_correlations_of_a_wide_table_with_gaps(spark, monkeypatch):
    """300 columns with missing values: one plan of a fixed size, equal to pairwise numpy."""
    from credspark.operators import stattests as ST
    rng = np.random.default_rng(6)
    d = 300
    x = rng.normal(size=(200, d)) + 1000.0
    x[:, 1] = -x[:, 0] + 0.01 * rng.normal(size=200)
    x[:, 7] = 5.0                                   # constant
    gaps = rng.random((200, d)) < 0.1
    cols = [f"c{i}" for i in range(d)]
    rows = [tuple(None if g else float(v) for v, g in zip(r, q)) for r, q in zip(x, gaps)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(4).cache()
    monkeypatch.setattr(ST, "PRODUCT_ROWS", 128)    # three passes
    got = {(r["feature_1"], r["feature_2"]): r["correlation"] for r in ST.correlated_pairs(df, cols, 0.25).collect()}
    want = {}
    for i in range(d):
        for j in range(i + 1, d):
            both = ~(gaps[:, i] | gaps[:, j])
            if 7 not in (i, j):
                r = np.corrcoef(x[both, i], x[both, j])[0, 1]
                if abs(r) >= 0.25:
                    want[cols[i], cols[j]] = r
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)


@pytest.mark.parametrize("n", [8, 9, 127, 128, 129, 131, 400, 3001])
def test_score_sums_equal_sums_of_scores(spark, n):
    from pyspark.sql import functions as F

    from credspark.functions.distributions import norm_ppf
    from credspark.operators import stattests as ST
    m = norm_ppf((np.arange(1, n + 1) - 0.375) / (n + 0.25))
    ends = ST.end_scores(spark.createDataFrame([("v", n, 0.0)], "variable string, n long, mean double"), ["variable"])
    assert ends.first()["summ2"] == pytest.approx((m * m).sum(), rel=1e-11)
    rng = np.random.default_rng(n)
    spans = [(3, n - 2), (1, 1), (n, n), (5, 4), *map(tuple, np.sort(rng.integers(1, n + 1, (40, 2)), axis=1).tolist())]
    rows = spark.createDataFrame([("v", *s) for s in spans], "variable string, lo long, hi long").join(ends, "variable")
    for r in ST.score_sums(rows).select("lo", "hi", "scores").collect():
        assert r["scores"] == pytest.approx(m[r["lo"] - 1:r["hi"]].sum(), abs=1e-9), (r["lo"], r["hi"])
    assert F is not None
