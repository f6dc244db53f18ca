"""A questionnaire derived from the driver's star schema (orders x customer x nation).

One questionnaire per order. Each answer is a plain SQL expression over the joined row,
written so the same text runs on Spark and on DuckDB; the oracle queries reuse it. The raw
JSON line of a row is Spark's ``to_json`` of the three nested groups, with dirt added by
rule (cut-free: malformed lines keep the whole text plus junk).

Join plan: orders is the big side, customer the second big side (sort-merge join on
custkey; AQE splits a hot custkey), nation has 25 rows and is broadcast only by Spark's
size check (autoBroadcastJoinThreshold), never forced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import PARSE_ERROR, RAW_GROUPS, SCHEMA_ERROR, SURVEY_COLUMNS, VALID

_Q = "chr(39)"  # a single quote, written so both SQL dialects read it the same

# --- fixed values: the answer expressions (column, SQL over orders/customer/nation) -----
ANSWER_EXPRS: list[tuple[str, str]] = [
    ("Gender", "case when o_orderkey % 3 = 0 then 'female' else 'male' end"),
    ("Country", "lower(n_name)"),
    ("Occupation",
     "case when o_orderkey % 17 = 0 then null"
     " when o_orderkey % 67 = 0 then 'self-employed'"
     f" when o_orderkey % 71 = 0 then concat('don', {_Q}, 't know')"
     " when o_orderkey % 73 = 0 then 'éCOLE ünï'"
     " when o_orderkey % 79 = 0 then 'sales, \"retail\"'"
     " when o_orderkey % 83 = 0 then concat('line one', chr(10), 'line two')"
     " else lower(c_mktsegment) end"),
    ("SelfEmployed", "case when c_acctbal < 2000 then 'yes' else 'no' end"),
    ("FamilyHistory", "case when o_orderpriority < '3' then 'yes' else 'no' end"),
    ("Treatment", "case when o_orderstatus = 'F' then 'Yes' else 'No' end"),
    ("MentalHealthHistory",
     "case o_orderkey % 5 when 0 then 'yes' when 1 then 'maybe' else 'no' end"),
    ("IncreasingStress",
     "case when o_totalprice < 150000 then 'no' when o_totalprice < 300000 then 'MAYBE'"
     " else 'yes' end"),
    ("MoodSwings", "case o_orderstatus when 'P' then 'low' when 'F' then 'medium' else 'high' end"),
    ("SocialWeaknessPrimary",
     "case o_custkey % 3 when 0 then 'yes' when 1 then 'no' else 'maybe' end"),
    ("SocialWeaknessSecondary",
     "case when o_orderkey % 11 = 0 then 'other'"
     " when o_custkey % 3 = 0 then 'yes' when o_custkey % 3 = 1 then 'no' else 'maybe' end"),
    ("CopingStruggles", "case when o_custkey % 2 = 0 then 'yes' else 'no' end"),
    ("MentalHealthInterview", "case when o_custkey % 7 = 0 then 'maybe' else 'no' end"),
    ("CareOptions",
     "case when o_orderkey % 19 = 0 then '' when o_orderkey % 23 = 0 then 'NULL'"
     " when o_custkey % 4 = 0 then 'not sure' else 'yes' end"),
    ("DaysIndoors",
     "case o_orderkey % 4 when 0 then '1-14 days' when 1 then 'go out every day'"
     " when 2 then 'more than 2 months' else '15-30 days' end"),
    ("HabitsChange",
     "case when o_orderkey % 53 = 0 then 'NA' when o_orderkey % 59 = 0 then 'n/a'"
     " when o_orderkey % 61 = 0 then 'null ' when o_custkey % 5 < 2 then 'yes' else 'no' end"),
    ("WorkInterest",
     "case when o_orderkey % 89 = 0 then 'None' when o_custkey % 5 < 3 then 'yes' else 'no' end"),
]

# --- fixed values: which raw line a row becomes, by rule on its id -----------------------
LINE_KIND_EXPR = (
    "case when rid % 41 = 0 then 'blank'"
    " when rid % 29 = 0 then 'trailing_brace'"
    " when rid % 31 = 0 then 'single_quotes'"
    " when rid % 37 = 0 then 'array'"
    " when rid % 43 = 0 then 'group_not_object'"
    " when rid % 7 = 3 then 'padded'"
    " when rid % 47 = 0 then 'cr_inside'"
    " else 'plain' end"
)
STATUS_EXPR = (
    "case when line_kind = 'blank' then null"
    f" when line_kind in ('trailing_brace', 'single_quotes') then '{PARSE_ERROR}'"
    f" when line_kind in ('array', 'group_not_object') then '{SCHEMA_ERROR}'"
    f" else '{VALID}' end"
)

FROM_JOIN = (
    "orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey"
)

assert [c for c, _ in ANSWER_EXPRS] == SURVEY_COLUMNS


def questionnaire_sql() -> str:
    """SQL (Spark and DuckDB) for the questionnaire: rid, line kind, the expected Bronze
    status and the 17 answers, over tables named orders, customer, nation."""
    answers = ",\n  ".join(f"{expr} AS {name}" for name, expr in ANSWER_EXPRS)
    return (
        "SELECT rid, line_kind, " + STATUS_EXPR + " AS expected_status, "
        + ", ".join(SURVEY_COLUMNS)
        + " FROM (SELECT *, " + LINE_KIND_EXPR + " AS line_kind FROM ("
        + "SELECT o_orderkey AS rid,\n  " + answers + f"\n FROM {FROM_JOIN}) a) b"
    )


def load_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three star-schema tables, only the columns the questionnaire reads."""
    base = sf_dir.rstrip("/")
    return {
        "orders": spark.read.parquet(f"{base}/orders.parquet").select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
        ),
        "customer": spark.read.parquet(f"{base}/customer.parquet").select(
            "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"
        ),
        "nation": spark.read.parquet(f"{base}/nation.parquet").select("n_nationkey", "n_name"),
    }


def questionnaire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The questionnaire as a DataFrame (clean answers + rid, line kind, expected status)."""
    t = load_tables(spark, sf_dir)
    o, c, n = (t[k] for k in ("orders", "customer", "nation"))
    joined = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"])
    a = joined.select(
        F.col("o_orderkey").alias("rid"), *[F.expr(expr).alias(name) for name, expr in ANSWER_EXPRS]
    )
    b = a.withColumn("line_kind", F.expr(LINE_KIND_EXPR))
    return b.select("rid", "line_kind", F.expr(STATUS_EXPR).alias("expected_status"), *SURVEY_COLUMNS)


def _record_json() -> F.Column:
    """The three nested groups of a row as JSON text (Spark leaves null fields out)."""
    names = iter(SURVEY_COLUMNS)
    groups = [
        F.struct(*[F.col(next(names)).alias(f) for f in fields]).alias(g)
        for g, fields in RAW_GROUPS.items()
    ]
    return F.to_json(F.struct(*groups))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``DataFrame[value: string]``: one raw JSON line per questionnaire row, with dirt."""
    q = questionnaire(spark, sf_dir)
    j = _record_json()
    kind = F.col("line_kind")
    line = (
        F.when(kind == "blank", F.concat(F.lit(" "), F.lit("\t"), F.lit(" ")))
        .when(kind == "trailing_brace", F.concat(j, F.lit("}")))
        .when(kind == "single_quotes", F.regexp_replace(j, '"', "'"))
        .when(kind == "array", F.concat(F.lit("["), j, F.lit("]")))
        .when(kind == "group_not_object",
              F.concat(F.lit('{"person":'), F.to_json(F.array(F.col("Country"))), F.lit("}")))
        .when(kind == "padded", F.concat(F.lit("　 "), j, F.lit("\t")))
        .when(kind == "cr_inside", F.regexp_replace(j, '^\\{"person":\\{', '{"person":\r{'))
        .otherwise(j)
    )
    return q.select(line.alias("value"))


# Raw lines and Silver are scratch here, and the widest things a query writes: both are
# compressed. Gzip files don't split, so raw files are bounded, to about 4 MB of text: the least
# that Spark would split off an uncompressed file, so later layers keep their number of files.
RAW_LINES_PER_FILE = 10_000

_MATERIALIZED: dict[tuple[str, str], tuple[str, object]] = {}


def materialize(spark: SparkSession, sf_dir: str):
    """Write the fixture's raw JSONL and run the medallion pipeline over it once per
    session and scale, under the shared scratch folder. Returns (raw_path, Layers)."""
    from strata.plans.pipeline import medallion
    from strata.session import scratch_path

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _MATERIALIZED:
        root = scratch_path(spark, "fixture")
        raw = f"{root}/raw"
        w = raw_lines(spark, sf_dir).write.mode("overwrite").option("maxRecordsPerFile", str(RAW_LINES_PER_FILE))
        w.option("lineSep", "\n").option("compression", "gzip").text(raw)
        _MATERIALIZED[key] = (raw, medallion(spark, raw, root, silver_compression="gzip"))
    return _MATERIALIZED[key]
