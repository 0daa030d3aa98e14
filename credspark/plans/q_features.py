"""Catalog: sources, projections and feature expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from credspark import constants as K
from credspark.operators import features as FE
from credspark.plans.common import apps, qs, r, round_doubles, sql
from credspark.sources.fixtures import APPLICATION_COLUMNS

Q: dict = {}
S: dict = {}


def _merge_sql(col: str) -> str:
    out = col
    for c, olds, new in K.CATEGORY_MERGES:
        if c == col:
            out = f"CASE WHEN {out} IN ({', '.join(qs(o) for o in olds)}) THEN {qs(new)} ELSE {out} END"
    return out


def _bin_sql(col: str, edges, labels) -> str:
    parts = [f"WHEN {col} > {lo} AND {col} <= {hi} THEN {qs(lab)}"
             for lo, hi, lab in zip(edges[:-1], edges[1:], labels)]
    return "CASE " + " ".join(parts) + " END"


def engineered_sql(duplicate_checking: bool = False) -> list[tuple[str, str, bool]]:
    """(name, SQL expression, is_double) in the Spark operator's column order."""
    a, d, g = "CAST(credit_amount AS DOUBLE)", "CAST(duration_months AS DOUBLE)", "CAST(age_years AS DOUBLE)"
    merged = {m[0] for m in K.CATEGORY_MERGES}
    cols = [(c, _merge_sql(c) if c in merged else c, c == "savings_amount")
            for c in APPLICATION_COLUMNS if c not in K.DROP_COLUMNS]
    if duplicate_checking:
        cols += [("checking_2", "checking_account_status", False),
                 ("personal_status_2", "personal_status_sex", False)]
    cols += [
        ("no_checking", "CAST(checking_account_status = 'no checking account' AS INTEGER)", False),
        ("credit_amount_squared", f"{a} * {a}", True),
        ("duration_squared", f"{d} * {d}", True),
        ("monthly_burden", f"{a} / {d}", True),
        ("duration_to_age_ratio", f"{d} / {g}", True),
        ("duration_to_age_ratio_sqrt", f"sqrt({d} / {g})", True),
        ("credit_log", f"ln(1 + {a})", True),
        ("duration_log", f"ln(1 + {d})", True),
        ("monthly_burden_log", f"ln({a} / {d})", True),
        ("credit_amount_bins", _bin_sql("credit_amount", K.AMOUNT_EDGES, K.AMOUNT_LABELS), False),
        ("age_group", _bin_sql("age_years", K.AGE_EDGES, K.AGE_LABELS), False),
    ]
    return cols


def engineered_select(duplicate_checking: bool = False, src: str = "applications") -> str:
    cols = engineered_sql(duplicate_checking)
    return "SELECT " + ", ".join(f"{r(e) if isd else e} AS {n}" for n, e, isd in cols) + f" FROM {src}"


def engineered_view(duplicate_checking: bool = False, src: str = "applications") -> str:
    """Unrounded engineered rows (for further SQL)."""
    cols = engineered_sql(duplicate_checking)
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e, _ in cols) + f" FROM {src}"


# ----------------------------------------------------------------- queries

def _coded(spark, d):
    """Encode the decoded view back to raw codes (label -> code), as text."""
    df = apps(spark, d)
    sel = []
    for c in K.COLUMNS:
        if c in K.CODEBOOK:
            inv = F.create_map(*[x for code, lab in K.CODEBOOK[c].items() for x in (F.lit(lab), F.lit(code))])
            sel.append(inv[F.col(c)].alias(c))
        elif c == K.TARGET:
            sel.append(F.when(F.col(c) == 1, "1").otherwise("2").alias(c))
        else:
            sel.append(F.col(c).cast("string").alias(c))
    return df.select("row_id", *sel)


def _coded_sql() -> str:
    parts = []
    for c in K.COLUMNS:
        if c in K.CODEBOOK:
            parts.append("CASE " + " ".join(f"WHEN {c} = {qs(lab)} THEN {qs(code)}"
                                            for code, lab in K.CODEBOOK[c].items()) + f" END AS {c}")
        elif c == K.TARGET:
            parts.append("CASE WHEN class = 1 THEN '1' ELSE '2' END AS class")
        else:
            parts.append(f"CAST({c} AS VARCHAR) AS {c}")
    return "SELECT row_id, " + ", ".join(parts) + " FROM applications"


def q_decode_codes(spark, d):
    return FE.target_recode(FE.decode_codes(_coded(spark, d)))


Q["decode_codes"] = q_decode_codes
S["decode_codes"] = sql(
    f", coded AS ({_coded_sql()}) SELECT row_id, "
    + ", ".join(
        ("CASE " + " ".join(f"WHEN {c} = {qs(code)} THEN {qs(lab)}" for code, lab in K.CODEBOOK[c].items())
         + f" ELSE {c} END AS {c}") if c in K.CODEBOOK
        else ("CAST(CASE WHEN class = '1' THEN 1 WHEN class = '2' THEN 0 END AS INTEGER) AS class" if c == K.TARGET
              else c)
        for c in K.COLUMNS) + " FROM coded")


def q_cast_numeric_strict(spark, d):
    return FE.cast_numeric_strict(_coded(spark, d)).select("row_id", *K.NUMERIC_COLUMNS)


Q["cast_numeric_strict"] = q_cast_numeric_strict
S["cast_numeric_strict"] = sql(
    "SELECT row_id, " + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in K.NUMERIC_COLUMNS) + " FROM applications")


def q_target_recode(spark, d):
    return FE.target_recode(_coded(spark, d).select("row_id", "class"))


Q["target_recode"] = q_target_recode
S["target_recode"] = sql("SELECT row_id, class FROM applications")


def q_drop_if_exists(spark, d):
    return FE.drop_if_exists(apps(spark, d), K.DROP_COLUMNS + ["not_a_column"])


Q["drop_if_exists"] = q_drop_if_exists
S["drop_if_exists"] = sql("SELECT " + ", ".join(c for c in APPLICATION_COLUMNS if c not in K.DROP_COLUMNS)
                          + " FROM applications")


def q_duplicate_columns(spark, d):
    return FE.duplicate_columns(apps(spark, d)).select("row_id", "checking_2", "personal_status_2")


Q["duplicate_columns"] = q_duplicate_columns
S["duplicate_columns"] = sql(
    "SELECT row_id, checking_account_status AS checking_2, personal_status_sex AS personal_status_2 FROM applications")


def q_equality_flag(spark, d):
    return FE.equality_flag(apps(spark, d)).groupBy("checking_account_status", "no_checking") \
        .agg(F.count(F.lit(1)).alias("n"))


Q["equality_flag"] = q_equality_flag
S["equality_flag"] = sql(
    "SELECT checking_account_status, CAST(checking_account_status = 'no checking account' AS INTEGER) AS no_checking,"
    " count(*) AS n FROM applications GROUP BY ALL")


def q_square_features(spark, d):
    return round_doubles(FE.square_features(apps(spark, d)).select("row_id", "credit_amount_squared",
                                                                    "duration_squared"))


Q["square_features"] = q_square_features
S["square_features"] = sql(
    f"SELECT row_id, {r('CAST(credit_amount AS DOUBLE) * CAST(credit_amount AS DOUBLE)')} AS credit_amount_squared,"
    f" {r('CAST(duration_months AS DOUBLE) * CAST(duration_months AS DOUBLE)')} AS duration_squared FROM applications")


def q_ratio_features(spark, d):
    return round_doubles(FE.ratio_features(apps(spark, d)).select("row_id", "monthly_burden",
                                                                   "duration_to_age_ratio"))


Q["ratio_features"] = q_ratio_features
S["ratio_features"] = sql(
    f"SELECT row_id, {r('CAST(credit_amount AS DOUBLE) / duration_months')} AS monthly_burden,"
    f" {r('CAST(duration_months AS DOUBLE) / age_years')} AS duration_to_age_ratio FROM applications")


def q_log_sqrt_features(spark, d):
    return round_doubles(FE.log_sqrt_features(apps(spark, d)).select(
        "row_id", "credit_log", "duration_log", "monthly_burden_log", "duration_to_age_ratio_sqrt"))


Q["log_sqrt_features"] = q_log_sqrt_features
S["log_sqrt_features"] = sql(
    f"SELECT row_id, {r('ln(1 + CAST(credit_amount AS DOUBLE))')} AS credit_log,"
    f" {r('ln(1 + CAST(duration_months AS DOUBLE))')} AS duration_log,"
    f" {r('ln(CAST(credit_amount AS DOUBLE) / duration_months)')} AS monthly_burden_log,"
    f" {r('sqrt(CAST(duration_months AS DOUBLE) / age_years)')} AS duration_to_age_ratio_sqrt FROM applications")


def q_merge_categories(spark, d):
    m = FE.merge_categories(apps(spark, d))
    return m.groupBy("purpose", "savings_account_bonds", "housing", "credit_history") \
        .agg(F.count(F.lit(1)).alias("n"))


Q["merge_categories"] = q_merge_categories
S["merge_categories"] = sql(
    ", m AS (SELECT " + ", ".join(f"{_merge_sql(c)} AS {c}" for c in
                                  ["purpose", "savings_account_bonds", "housing", "credit_history"])
    + " FROM applications) SELECT purpose, savings_account_bonds, housing, credit_history, count(*) AS n"
      " FROM m GROUP BY ALL")


def q_bin_right_closed(spark, d):
    b = FE.bin_right_closed(apps(spark, d))
    return b.groupBy("credit_amount_bins", "age_group").agg(
        F.count(F.lit(1)).alias("n"), F.min("credit_amount").alias("min_amount"),
        F.max("credit_amount").alias("max_amount"), F.min("age_years").alias("min_age"),
        F.max("age_years").alias("max_age"))


Q["bin_right_closed"] = q_bin_right_closed
S["bin_right_closed"] = sql(
    f", b AS (SELECT *, {_bin_sql('credit_amount', K.AMOUNT_EDGES, K.AMOUNT_LABELS)} AS credit_amount_bins,"
    f" {_bin_sql('age_years', K.AGE_EDGES, K.AGE_LABELS)} AS age_group FROM applications)"
    " SELECT credit_amount_bins, age_group, count(*) AS n, min(credit_amount) AS min_amount,"
    " max(credit_amount) AS max_amount, min(age_years) AS min_age, max(age_years) AS max_age FROM b GROUP BY ALL")


def q_quantile_bins(spark, d):
    b = FE.quantile_bins(apps(spark, d), "duration_months", 5, "duration_q5")
    return b.groupBy("duration_q5").agg(F.count(F.lit(1)).alias("n"), F.min("duration_months").alias("lo"),
                                        F.max("duration_months").alias("hi"))


Q["quantile_bins"] = q_quantile_bins
S["quantile_bins"] = sql(
    ", e AS (SELECT quantile_cont(CAST(duration_months AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS q FROM applications)"
    ", b AS (SELECT duration_months, CASE WHEN duration_months <= q[1] THEN 'Q1' WHEN duration_months <= q[2]"
    " THEN 'Q2' WHEN duration_months <= q[3] THEN 'Q3' WHEN duration_months <= q[4] THEN 'Q4'"
    " WHEN duration_months IS NOT NULL THEN 'Q5' END AS duration_q5 FROM applications, e)"
    " SELECT duration_q5, count(*) AS n, min(duration_months) AS lo, max(duration_months) AS hi"
    " FROM b GROUP BY ALL")


def q_feature_engineer(spark, d):
    return round_doubles(FE.feature_engineer(apps(spark, d)))


Q["feature_engineer"] = q_feature_engineer
S["feature_engineer"] = sql(engineered_select(False))


def q_feature_engineer_dup(spark, d):
    return round_doubles(FE.feature_engineer(apps(spark, d), duplicate_checking=True))


Q["feature_engineer_duplicate_checking"] = q_feature_engineer_dup
S["feature_engineer_duplicate_checking"] = sql(engineered_select(True))


def q_detect_column_kinds(spark, d):
    return FE.detect_column_kinds(apps(spark, d).drop("row_id")).drop("dtype")


def _kinds_sql() -> str:
    parts = []
    for c in APPLICATION_COLUMNS:
        if c == "row_id":
            continue
        numeric = c not in K.CODEBOOK
        kind = (f"CASE WHEN count(DISTINCT {c}) > 10 THEN 'numerical' ELSE 'categorical' END" if numeric
                else "'categorical'")
        parts.append(f"SELECT {qs(c)} AS column_name, CAST(count(DISTINCT {c}) AS BIGINT) AS n_unique, {kind} AS kind"
                     " FROM applications")
    return " UNION ALL ".join(parts)


Q["detect_column_kinds"] = q_detect_column_kinds
S["detect_column_kinds"] = sql(_kinds_sql())


def q_pairwise_complete(spark, d):
    return FE.pairwise_complete(apps(spark, d), "savings_amount", "credit_amount") \
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("savings_amount"), 2).alias("sum_savings"))


Q["pairwise_complete"] = q_pairwise_complete
S["pairwise_complete"] = sql(
    "SELECT count(*) AS n, round(sum(savings_amount), 2) AS sum_savings FROM applications"
    " WHERE savings_amount IS NOT NULL AND credit_amount IS NOT NULL")


# form domains (the web form omits two coded levels, see constants)
FORM_CATEGORIES = {c: [v for v in K.CODEBOOK[c].values() if v not in ("vacation", "female: single")]
                   for c in K.CODEBOOK}


def q_validate_domain(spark, d):
    return FE.validate_domain(apps(spark, d), FORM_CATEGORIES, K.NUMERIC_DOMAIN)


def _validate_sql() -> str:
    parts = []
    for c, allowed in FORM_CATEGORIES.items():
        parts.append(f"SELECT {qs(c)} AS column_name, count(*) AS n_checked, CAST(sum(CASE WHEN {c} IS NOT NULL AND {c}"
                     f" NOT IN ({', '.join(qs(a) for a in allowed)}) THEN 1 ELSE 0 END) AS BIGINT) AS n_invalid"
                     " FROM applications")
    for c, (lo, hi) in K.NUMERIC_DOMAIN.items():
        parts.append(f"SELECT {qs(c)} AS column_name, count(*) AS n_checked, CAST(sum(CASE WHEN {c} < {lo} OR {c} > {hi}"
                     " THEN 1 ELSE 0 END) AS BIGINT) AS n_invalid FROM applications")
    return (", v AS (" + " UNION ALL ".join(parts) + ") SELECT column_name, n_checked, n_invalid,"
            " round(n_invalid * 100.0 / n_checked, 6) AS invalid_pct FROM v")


Q["validate_domain"] = q_validate_domain
S["validate_domain"] = sql(_validate_sql())


def q_random_sample(spark, d):
    a = apps(spark, d)
    good = FE.random_sample(a, n=5, seed=42, label=1)
    bad = FE.random_sample(a, n=5, seed=42, label=0)
    anyone = FE.random_sample(a, n=5, seed=7)
    cols = ["row_id", "class", "credit_amount"]
    return good.select(F.lit("good").alias("draw"), *cols).unionByName(
        bad.select(F.lit("bad").alias("draw"), *cols)).unionByName(anyone.select(F.lit("any").alias("draw"), *cols))


def _sample_sql(draw, seed, where):
    from credspark.functions.hashing import duck_md5_bucket
    key = duck_md5_bucket(f"'{seed}_' || CAST(row_id AS VARCHAR)", 1_000_000)
    return (f"(SELECT {qs(draw)} AS draw, row_id, class, credit_amount FROM applications {where}"
            f" ORDER BY {key}, row_id LIMIT 5)")


Q["random_sample"] = q_random_sample
S["random_sample"] = sql(" UNION ALL ".join([_sample_sql("good", 42, "WHERE class = 1"),
                                             _sample_sql("bad", 42, "WHERE class = 0"),
                                             _sample_sql("any", 7, "")]))


def q_unpivot_record(spark, d):
    return FE.unpivot_record(apps(spark, d))


def _unpivot_sql():
    feats = [c for c in K.COLUMNS if c != K.TARGET]
    parts = [f"SELECT row_id, {qs(K.FEATURE_LABELS[c])} AS feature, CAST({c} AS VARCHAR) AS value FROM applications"
             for c in feats]
    return " UNION ALL ".join(parts)


Q["unpivot_record"] = q_unpivot_record
S["unpivot_record"] = sql(_unpivot_sql())


def q_align_series(spark, d):
    """Two series from two tables aligned on the row id (inner equi-join)."""
    a = apps(spark, d)
    left = a.select("row_id", "credit_amount")
    right = a.filter(F.col("savings_amount").isNotNull()).select("row_id", "savings_amount")
    j = left.join(right, "row_id", "inner")
    return j.agg(F.count(F.lit(1)).alias("n"), F.round(F.corr("credit_amount", "savings_amount"), 6).alias("r"))


Q["align_series"] = q_align_series
S["align_series"] = sql(
    "SELECT count(*) AS n, round(corr(credit_amount, savings_amount), 6) AS r FROM applications"
    " WHERE savings_amount IS NOT NULL")

