"""Risk-style views derived from the driver's tables.

``applications``: one loan application per order (orders joined to
customer), with the 21 fields of the application record, a nullable
``savings_amount`` and a learnable class label.  ``scored`` adds three
deterministic model probabilities so that evaluation operators have exact
SQL oracles.  Each view is defined once for Spark (DataFrame API) and once
as SQL text for the DuckDB oracle; the two must agree row for row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credspark.constants import CODEBOOK
from credspark.functions.hashing import duck_md5_bucket, md5_bucket
from credspark.session import spread

# (column, a, b): label index = (o_orderkey * a + o_custkey * b) % len(labels)
CATEGORY_PICKS = [
    ("credit_history", 7, 3),
    ("purpose", 11, 5),
    ("savings_account_bonds", 13, 7),
    ("present_employment_since", 17, 11),
    ("personal_status_sex", 19, 13),
    ("other_debtors_guarantors", 23, 17),
    ("property", 29, 19),
    ("other_installment_plans", 31, 23),
    ("housing", 37, 29),
    ("job", 41, 31),
    ("telephone", 43, 37),
    ("foreign_worker", 47, 41),
]

# (column, a, b, levels): value = 1 + (o_orderkey * a + o_custkey * b) % levels
SMALL_INTS = [
    ("installment_rate_pct_of_disp_income", 3, 1, 4),
    ("present_residence_since", 5, 2, 4),
    ("existing_credits_count", 1, 3, 4),
    ("people_liable_for_maintenance", 7, 1, 2),
]

STATUS_BY_PRIORITY = {
    "1": "< 0 DM",
    "2": "0 <= ... < 200 DM",
    "3": ">= 200 DM / salary assign.",
}
STATUS_OTHER = "no checking account"

APPLICATION_COLUMNS = [
    "row_id", "checking_account_status", "duration_months", "credit_history", "purpose",
    "credit_amount", "savings_account_bonds", "present_employment_since",
    "installment_rate_pct_of_disp_income", "personal_status_sex",
    "other_debtors_guarantors", "present_residence_since", "property", "age_years",
    "other_installment_plans", "housing", "existing_credits_count", "job",
    "people_liable_for_maintenance", "telephone", "foreign_worker", "savings_amount",
    "class",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _labels(column: str) -> list[str]:
    return list(CODEBOOK[column].values())


def applications(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """``dealt``: the orders are spread over all cores first, for work that costs much for each row."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    o = spread(o) if dealt else o
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")

    prio = F.substring("o_orderpriority", 1, 1)
    status = F.when(prio == "1", STATUS_BY_PRIORITY["1"]) \
        .when(prio == "2", STATUS_BY_PRIORITY["2"]) \
        .when(prio == "3", STATUS_BY_PRIORITY["3"]) \
        .otherwise(STATUS_OTHER)
    duration = (F.lit(4) + ok % 69).cast("int")
    cols = {
        "row_id": ok,
        "checking_account_status": status,
        "duration_months": duration,
        "credit_amount": F.floor(F.col("o_totalprice") / 25).cast("int"),
        "age_years": (F.lit(19) + ck % 57).cast("int"),
        "savings_amount": F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")),
    }
    for name, a, b in CATEGORY_PICKS:
        labels = _labels(name)
        idx = (ok * a + ck * b) % len(labels)
        cols[name] = F.element_at(F.array(*[F.lit(x) for x in labels]), (idx + 1).cast("int"))
    for name, a, b, levels in SMALL_INTS:
        cols[name] = (F.lit(1) + (ok * a + ck * b) % levels).cast("int")
    bucket = md5_bucket(F.concat(F.lit("y"), ok.cast("string")))
    limit = (F.lit(150) + F.when(status == "< 0 DM", 250).otherwise(0)
             + F.when(duration > 48, 150).otherwise(0))
    cols["class"] = F.when(bucket < limit, 0).otherwise(1).cast("int")
    return j.select(*[cols[n].alias(n) for n in APPLICATION_COLUMNS])


def score_columns(df: DataFrame) -> DataFrame:
    """Three fixed model probabilities (stand-ins for trained models)."""
    status = F.col("checking_account_status")
    z = (F.lit(1.6)
         - F.lit(1.2) * (status == "< 0 DM").cast("int")
         + F.lit(0.6) * (status == "no checking account").cast("int")
         - F.lit(0.04) * (F.col("duration_months") - 24)
         - F.lit(0.00005) * (F.col("credit_amount") - 4000)
         + F.lit(0.01) * (F.col("age_years") - 35))
    rfc = (F.lit(30)
           + F.lit(25) * (F.col("duration_months") <= 24).cast("int")
           + F.lit(20) * (status != "< 0 DM").cast("int")
           + F.lit(10) * (F.col("age_years") > 30).cast("int")
           + F.lit(10) * (F.col("credit_amount") <= 7000).cast("int")) / 100
    svc = md5_bucket(F.concat(F.lit("s"), F.col("row_id").cast("string"))) / 1000
    return df.select(
        "*",
        (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias("proba_lrc"),
        rfc.alias("proba_rfc"),
        svc.alias("proba_svc"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_columns(applications(spark, sf_dir))


# --------------------------------------------------------------------------
# DuckDB twins (oracle side)
# --------------------------------------------------------------------------

def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def applications_sql() -> str:
    """SELECT producing ``applications`` in DuckDB."""
    parts = [
        "o_orderkey AS row_id",
        "CASE substr(o_orderpriority, 1, 1) "
        + " ".join(f"WHEN {_sql_str(k)} THEN {_sql_str(v)}" for k, v in STATUS_BY_PRIORITY.items())
        + f" ELSE {_sql_str(STATUS_OTHER)} END AS checking_account_status",
        "CAST(4 + o_orderkey % 69 AS INTEGER) AS duration_months",
        "CAST(floor(o_totalprice / 25) AS INTEGER) AS credit_amount",
        "CAST(19 + o_custkey % 57 AS INTEGER) AS age_years",
        "CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS savings_amount",
    ]
    for name, a, b in CATEGORY_PICKS:
        labels = _labels(name)
        arr = "[" + ", ".join(_sql_str(x) for x in labels) + "]"
        parts.append(f"{arr}[CAST((o_orderkey * {a} + o_custkey * {b}) % {len(labels)} + 1 AS INTEGER)] AS {name}")
    for name, a, b, levels in SMALL_INTS:
        parts.append(f"CAST(1 + (o_orderkey * {a} + o_custkey * {b}) % {levels} AS INTEGER) AS {name}")
    bucket = duck_md5_bucket("'y' || CAST(o_orderkey AS VARCHAR)")
    parts.append(
        f"CAST(CASE WHEN {bucket} < 150 + CASE WHEN substr(o_orderpriority, 1, 1) = '1' THEN 250 ELSE 0 END"
        " + CASE WHEN 4 + o_orderkey % 69 > 48 THEN 150 ELSE 0 END THEN 0 ELSE 1 END AS INTEGER) AS class")
    inner = "SELECT " + ",\n       ".join(parts) + "\nFROM orders JOIN customer ON o_custkey = c_custkey"
    return "SELECT " + ", ".join(APPLICATION_COLUMNS) + f" FROM ({inner})"


def scored_sql(src: str = "applications") -> str:
    d = lambda x: f"CAST({x!r} AS DOUBLE)"  # noqa: E731  (DuckDB reads 1.5 as DECIMAL)
    z = (f"({d(1.6)} - {d(1.2)} * CAST(checking_account_status = '< 0 DM' AS INTEGER)"
         f" + {d(0.6)} * CAST(checking_account_status = 'no checking account' AS INTEGER)"
         f" - {d(0.04)} * (duration_months - 24)"
         f" - {d(0.00005)} * (credit_amount - 4000)"
         f" + {d(0.01)} * (age_years - 35))")
    rfc = ("(30 + 25 * CAST(duration_months <= 24 AS INTEGER)"
           " + 20 * CAST(checking_account_status <> '< 0 DM' AS INTEGER)"
           " + 10 * CAST(age_years > 30 AS INTEGER)"
           " + 10 * CAST(credit_amount <= 7000 AS INTEGER)) / 100")
    svc = duck_md5_bucket("'s' || CAST(row_id AS VARCHAR)") + " / 1000"
    return (f"SELECT *, {d(1.0)} / ({d(1.0)} + exp(-{z})) AS proba_lrc, {rfc} AS proba_rfc,"
            f" {svc} AS proba_svc FROM {src}")


def with_views(select_sql: str) -> str:
    """Prefix a query with the ``applications`` and ``scored`` CTEs."""
    return (f"WITH applications AS ({applications_sql()}),\n"
            f"scored AS ({scored_sql()})\n{select_sql}")
