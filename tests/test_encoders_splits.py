"""Encoders on hand-computed tables; split, fold and resampling invariants."""

import math

import pytest
from pyspark.sql import functions as F

from credspark.operators import encoders as EC
from credspark.operators import splits as SP


def _tiny(spark):
    rows = [(0, "A", 1), (1, "A", 0), (2, "B", 1), (3, "A", 1), (4, "C", 0), (5, "B", 1)]
    return spark.createDataFrame(rows, "row_id long, cat string, class int")


def test_woe_target_count_ordinal(spark):
    tr = _tiny(spark)
    te = spark.createDataFrame([(10, "A"), (11, "C"), (12, "Z"), (13, None)], "row_id long, cat string")
    woe = {r["row_id"]: r["cat"] for r in EC.encode_woe(tr, te, ["cat"]).collect()}
    P, N = 4, 2
    want_a = math.log(((2 + 1) / (P + 2)) / ((1 + 1) / (N + 2)))
    assert woe[10] == pytest.approx(want_a) and woe[11] == 0.0 and woe[12] == 0.0 and woe[13] == 0.0
    tgt = {r["row_id"]: r["cat"] for r in EC.encode_target(tr, te, ["cat"], smoothing=1.0).collect()}
    prior = 4 / 6
    w = 1 / (1 + math.exp(-(3 - 20) / 1.0))
    assert tgt[10] == pytest.approx(prior * (1 - w) + (2 / 3) * w)
    assert tgt[12] == pytest.approx(prior) and tgt[13] == pytest.approx(prior)
    cnt = {r["row_id"]: r["cat"] for r in EC.encode_count(tr, te, ["cat"]).collect()}
    assert cnt[10] == pytest.approx(3 / 6) and cnt[11] == pytest.approx(1 / 6) and cnt[12] == 0.0
    ordn = {r["row_id"]: r["cat"] for r in EC.encode_ordinal(tr, te, ["cat"]).collect()}
    assert ordn[10] == 1.0 and ordn[11] == 3.0 and ordn[12] == -1.0 and ordn[13] == -2.0


def test_onehot_all_levels_unseen_zero(spark):
    tr = _tiny(spark)
    te = spark.createDataFrame([(10, "B"), (11, "Z")], "row_id long, cat string")
    m = EC.OneHotAllEncoder(inputCols=["cat"]).fit(tr)
    assert m.output_columns() == ["cat_A", "cat_B", "cat_C"]  # no level dropped, first-seen order
    rows = {r["row_id"]: r for r in m.transform(te).collect()}
    assert (rows[10]["cat_A"], rows[10]["cat_B"], rows[10]["cat_C"]) == (0, 1, 0)
    assert (rows[11]["cat_A"], rows[11]["cat_B"], rows[11]["cat_C"]) == (0, 0, 0)


def test_population_scaler(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    out = [r["x"] for r in EC.scale_standard(df, df, ["x"]).collect()]
    sd = math.sqrt(1.25)
    assert out == pytest.approx([(v - 2.5) / sd for v in (1, 2, 3, 4)])
    const = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert [r["x"] for r in EC.scale_standard(const, const, ["x"]).collect()] == [0.0, 0.0]


def test_hash_split_known_answer(spark):
    import hashlib
    ids = spark.range(1000).withColumnRenamed("id", "row_id")
    test = {r["row_id"] for r in SP.hash_split(ids, 0.15).filter("split = 'test'").collect()}
    want = {i for i in range(1000) if int(hashlib.md5(str(i).encode()).hexdigest(), 16) % 1000 < 150}
    assert test == want and len(test) == 159
    with pytest.raises(ValueError):
        SP.hash_split(ids, 1.5)


def test_splits_disjoint_complete_and_folds_balanced(spark, sf):
    from credspark.sources.fixtures import applications
    a = applications(spark, sf)
    s = SP.hash_split(a)
    assert s.count() == a.count()
    assert s.groupBy("row_id").count().filter("count > 1").count() == 0
    f = SP.kfold_assign(a, k=5, seed=3).groupBy("class", "fold").count().collect()
    by_class = {}
    for r in f:
        by_class.setdefault(r["class"], []).append(r["count"])
    for sizes in by_class.values():
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    st = SP.stratified_split(a, size=150, seed=8)
    val = st.filter("split = 'val'")
    assert val.count() == 150
    shares = {r["class"]: r["count"] for r in val.groupBy("class").count().collect()}
    tot = {r["class"]: r["count"] for r in a.groupBy("class").count().collect()}
    for c in tot:
        assert abs(shares.get(c, 0) - 150 * tot[c] / sum(tot.values())) < 1


def test_class_weights_balanced(spark):
    w = {r["class"]: r["weight"] for r in SP.class_weights(_tiny(spark)).collect()}
    assert w[1] == pytest.approx(6 / (2 * 4)) and w[0] == pytest.approx(6 / (2 * 2))


def test_smote_counts_and_segments(spark):
    import numpy as np
    from pyspark.ml.functions import array_to_vector
    from credspark.operators import resample as RS
    rng = np.random.default_rng(0)
    rows = [(i, 1, [float(v) for v in rng.normal(0, 1, 3)]) for i in range(60)] + \
           [(100 + i, 0, [float(v) for v in rng.normal(3, 1, 3)]) for i in range(15)]
    df = spark.createDataFrame(rows, "row_id long, class int, x array<double>") \
        .select("row_id", "class", array_to_vector("x").alias("features"))
    out = RS.smote(df, k=3, ratio=1.0, seed=1)
    syn = out.filter("synthetic = 1")
    assert syn.count() == 60 - 15 and syn.filter("class != 0").count() == 0
    # exact neighbours against brute force
    mino = RS._as_array(df.filter("class = 0"))
    nb = {r["row_id"]: list(r["nbr_ids"]) for r in RS.knn(mino, mino, 3).collect()}
    pts = {r["row_id"]: np.array(r["x"]) for r in mino.collect()}
    for rid, got in nb.items():
        d = sorted((np.linalg.norm(pts[rid] - v), o) for o, v in pts.items() if o != rid)
        assert got == [o for _, o in d[:3]]
    assert F is not None


def test_a_million_levels(spark):
    n = 1_000_000
    tr = spark.range(2 * n).selectExpr("id as row_id", f"concat('v', id % {n}) as cat", "cast(id % 2 as int) as class")
    te = spark.range(0, n + 2, 100_003).selectExpr("id as row_id", "concat('v', id) as cat")
    te = te.unionByName(spark.createDataFrame([(-1, None), (-2, "new")], "row_id long, cat string"))
    got = {r["row_id"]: r["cat"] for r in EC.encode_count(tr, te, ["cat"]).collect()}
    assert got[-1] == got[-2] == 0.0 and {v for k, v in got.items() if k >= 0} == {2 / (2 * n)}


def test_state_is_saved_with_the_model(spark, tmp_path):
    m = EC.CategoryEncoder(kind="woe", inputCols=["cat"]).fit(_tiny(spark))
    m.save(str(tmp_path / "m"))
    again = EC.CategoryEncoderModel.load(str(tmp_path / "m"))
    assert again.transform(_tiny(spark)).exceptAll(m.transform(_tiny(spark))).count() == 0


def test_onehot_names_are_injective(spark):
    df = spark.createDataFrame([(0, "a-b"), (1, "a b"), (2, "c")], "row_id long, cat string")
    out = EC.encode_onehot(df, df, ["cat"])
    assert len(set(out.columns)) == 4 and "cat_c" in out.columns
    assert all(sum(r[c] for c in out.columns if c.startswith("cat_")) == 1 for r in out.collect())


def test_ordinal_unseen_and_missing(spark):
    tr = _tiny(spark)
    te = spark.createDataFrame([(10, "A"), (11, "C"), (12, "Z"), (13, None)], "row_id long, cat string")
    ordn = {r["row_id"]: r["cat"] for r in EC.encode_ordinal(tr, te, ["cat"]).collect()}
    assert ordn == {10: 1.0, 11: 3.0, 12: -1.0, 13: -2.0}


def test_box_stats_without_groups(spark):
    from credspark.operators import profile as PR
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)] + [(100.0,)], "x double")
    r = PR.box_stats(df, "x").first()
    assert r["median"] == 6.0 and r["whisker_high"] == 10.0 and r["n_outliers"] == 1


def test_knn_ties_by_smaller_id_and_groups(spark):
    from credspark.operators import resample as RS
    pts = [(1, 0, "a", [0.0, 0.0]), (2, 0, "a", [1.0, 0.0]), (3, 0, "a", [0.0, 1.0]), (4, 0, "a", [-1.0, 0.0]),
           (5, 0, "b", [0.1, 0.0]), (6, 0, "a", [0.0, -1.0])]
    df = spark.createDataFrame(pts, "row_id long, class int, g string, x array<double>")
    nb = {r["row_id"]: list(r["nbr_ids"]) for r in RS.knn(df, df, 2, group_col="g").collect()}
    # row 1 has four neighbours at distance 1 in its group: the two smallest ids win; row 5 is alone
    assert nb[1] == [2, 3] and nb[5] == []


def test_tables_of_levels_equal_maps(spark, monkeypatch, tmp_path):
    """Columns too wide for a map take one join whatever their number, with the same values; saved and loaded too."""
    import json

    from credspark.operators.pipelines import EncodingPlan, EncodingPlanModel
    rows = [(i, f"a{i % 23}" if i % 11 else None, f"b{i % 5}", f"c{i % 7}", f"d{i % 3}", i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "row_id long, a string, b string, c string, d string, class int")
    new = spark.createDataFrame([(900, None, "b1", "zz", "d0", 0), (901, "a1", None, "c2", "d2", 1),
                                 (901, "a1", None, "c2", "d2", 1)], df.schema)
    spec = {"woe": ["a"], "target": ["b"], "count": ["c"], "ordinal": ["d"]}
    plan = EncodingPlan(spec=json.dumps(spec), keepCols=["row_id"], assemble=False)
    both = df.unionByName(new)
    want = sorted(map(tuple, plan.fit(df).transform(both).collect()))
    for most, tables in ((3, 3), (20, 1), (1, 4)):
        monkeypatch.setattr(EC, "MAP_LEVELS", most)
        m = plan.fit(df)
        assert m.state.select("column_name").distinct().count() == tables
        m.save(str(tmp_path / f"m{most}"))
        for model in (m, EncodingPlanModel.load(str(tmp_path / f"m{most}"))):
            assert sorted(map(tuple, model.transform(both).collect())) == want
    plan = m.transform(both)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2      # levels to values, values to rows: the same for any number of columns


def test_one_hot_refuses_a_column_of_too_many_levels(spark, monkeypatch):
    monkeypatch.setattr(EC, "ONEHOT_LEVELS", 10)
    df = spark.createDataFrame([(i, f"v{i}", i % 2) for i in range(11)], "row_id long, cat string, class int")
    with pytest.raises(ValueError, match="cat"):
        EC.OneHotAllEncoder(inputCols=["cat"]).fit(df)


def test_encoding_plan_one_pass_states(spark):
    import json
    from credspark.operators.pipelines import EncodingPlan
    rows = [(0, "A", 1, 1.0), (1, "A", 0, 2.0), (2, "B", 1, 3.0), (3, None, 1, 4.0)]
    df = spark.createDataFrame(rows, "row_id long, cat string, class int, x double")
    spec = {"woe": ["cat"], "count": [], "scale": ["x"], "onehot": ["cat"]}
    m = EncodingPlan(spec=json.dumps(spec), keepCols=["row_id"], assemble=False).fit(df)
    fitted = json.loads(m.getOrDefault("fitted"))
    P, NN = 3, 4  # totals come from all rows, the NULL level included
    want_a = math.log(((1 + 1) / (P + 2)) / ((1 + 1) / (NN - P + 2)))
    assert m.state.count() == 0     # a column of few levels is a map, not a table
    woe = fitted["maps"]["woe"]["cat"]
    assert woe == {"A": pytest.approx(want_a), "B": 0.0}
    assert fitted["onehot"]["cat"] == ["A", "B"]
    mean, sd = fitted["scale"]["x"]
    assert mean == pytest.approx(2.5) and sd == pytest.approx(math.sqrt(1.25))
