from pyspark.sql import functions as F

from conftest import rows
from strata.operators import serve as S

COLS = "Country string, Occupation string, SelfEmployed string, MentalHealthHistory string, IncreasingStress string"


def _df(spark, data):
    return spark.createDataFrame(data, COLS)


DATA = [
    ("no", "a", "yes", "yes", "yes"),
    ("no", "a", "no", "no", "no"),
    ("no", "b", None, None, "yes"),
    ("se", "b", "Yes", "yes", "no"),
    ("se", None, "yes", "no", None),
    (None, "a", "no", "yes", "yes"),
]


def test_rate_by_factor_and_top_category_ties(spark):
    df = _df(spark, DATA)
    rates = {(r["factor"], r["category"]): (r["n"], r["yes_count"], r["prop"])
             for r in S.rate_by_factor(df, ["Country", "Occupation"]).collect()}
    assert rates[("Country", "no")] == (3, 2, 2 / 3)
    assert rates[("Country", "se")] == (2, 0, 0.0)  # null target counts as 0
    assert ("Country", None) not in rates  # null categories left out
    top = {r["factor"]: (r["category"], r["prop"]) for r in S.top_category(df, ["Country", "Occupation"]).collect()}
    assert top["Country"] == ("no", 2 / 3)
    # Occupation: a -> 2/3, b -> 1/2
    assert top["Occupation"] == ("a", 2 / 3)
    tie = _df(spark, [("x", "p", "", "", "yes"), ("y", "q", "", "", "yes")])
    assert S.top_category(tie, ["Country"]).first()["category"] == "x"
    assert S.top_category_one_factor(tie, "Country").first()["category"] == "x"


def test_share_within_sums_to_one(spark):
    df = _df(spark, DATA)
    out = S.share_within(df, "Country", "IncreasingStress")
    sums = {r[0]: r[1] for r in out.groupBy("Country").agg(F.sum("prop")).collect()}
    assert all(abs(v - 1.0) < 1e-12 for v in sums.values())
    assert None in sums  # null key kept
    assert None not in {r[0] for r in S.share_within(df, "Country", "IncreasingStress", drop_null_key=True).collect()}


def test_share_map(spark):
    df = _df(spark, DATA)
    m = {r["Country"]: (dict(r["shares"]), r["total"]) for r in S.share_map(df, "Country", "IncreasingStress").collect()}
    assert m["no"] == ({"yes": 2 / 3, "no": 1 / 3}, 3)
    assert m["se"] == ({"no": 0.5}, 2)  # null value left out of the map, counted in the total


def test_share_global(spark):
    df = _df(spark, DATA)
    got = {r[0]: (r[1], r[2]) for r in S.share_global(df, "IncreasingStress").collect()}
    assert got == {"yes": (3, 0.5), "no": (2, 2 / 6), None: (1, 1 / 6)}
    dropped = {r[0]: r[2] for r in S.share_global(df, "IncreasingStress", drop_null=True).collect()}
    assert dropped == {"yes": 0.6, "no": 0.4}


def test_rate_by_group_rules(spark):
    df = _df(spark, DATA)
    d = {r[0]: tuple(r[1:]) for r in S.rate_by_group(df, "Country", "MentalHealthHistory").collect()}
    assert d == {"no": (1, 2, 0.5), "se": (1, 2, 0.5), None: (1, 1, 1.0)}
    as_no = {r[0]: tuple(r[1:]) for r in S.rate_by_group(
        df, "Country", "MentalHealthHistory", missing_flag="as_no", drop_null_key=True).collect()}
    assert as_no == {"no": (1, 3, 1 / 3), "se": (1, 2, 0.5)}
    e = {r[0]: tuple(r[1:]) for r in S.rate_by_group(df, "Occupation", "SelfEmployed", drop_null_key=True).collect()}
    assert e == {"a": (1, 3, 1 / 3), "b": (1, 1, 1.0)}  # lower() makes 'Yes' count


def test_percent_text_distinct_sample(spark):
    df = _df(spark, DATA)
    pct = rows(S.with_percent_text(S.share_global(df, "IncreasingStress")).select("IncreasingStress", "pct"))
    assert ("yes", "50.00%") in pct
    assert sorted(r[0] for r in S.distinct_values(df, "Occupation").collect() if r[0]) == ["a", "b"]
    big = spark.range(10000)
    n = S.sample_rows(big, 0.1, seed=42).count()
    assert 800 < n < 1200


def test_answer_all_equals_separate_answers(spark):
    df = _df(spark, DATA + [("no", "b", "no", "maybe", "MAYBE"), ("se", "a", None, "yes", "yes")])
    factors = ["Country", "Occupation", "SelfEmployed"]
    got = S.answer_all(df, factors=factors)
    want = {
        "A": S.top_category(df, factors),
        "A_rates": S.rate_by_factor(df, factors),
        "B": S.share_within(df, "Country", "IncreasingStress", sort=False),
        "C": S.share_global(df, "IncreasingStress"),
        "D": S.rate_by_group(df, "Country", "MentalHealthHistory"),
        "E": S.rate_by_group(df, "Occupation", "SelfEmployed", drop_null_key=True),
    }
    for k, w in want.items():
        assert rows(got[k].select(*w.columns)) == rows(w), k


def test_hot_key_third_of_rows(spark):
    """One country holds over a third of the rows: answers stay exact and the plan
    aggregates map-side before the exchange."""
    hot = spark.range(30000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('c', CAST(id % 500 AS STRING)) END AS Country",
        "CASE WHEN id % 4 = 0 THEN 'yes' ELSE 'no' END AS MentalHealthHistory",
        "CASE WHEN id % 7 = 0 THEN 'yes' ELSE 'no' END AS IncreasingStress",
        "'x' AS Occupation", "'no' AS SelfEmployed",
    )
    d = S.rate_by_group(hot, "Country", "MentalHealthHistory")
    r = d.filter(F.col("Country") == "hot").first()
    assert (r["yes_count"], r["total_count"]) == (2500, 10000)
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        d.explain()
    plan = buf.getvalue()
    assert plan.index("partial_sum") > plan.index("Exchange")  # partial aggregate sits below the exchange
    b = S.answer_all(hot, factors=["Country"])["B"].filter(F.col("Country") == "hot")
    assert {x["IncreasingStress"]: x["count"] for x in b.collect()} == {"yes": 1429, "no": 8571}


def test_text_reports(spark):
    df = _df(spark, DATA)
    top = rows(S.report_top(S.top_category(df, ["Country"])))
    assert top == [("Country: 'no' → 0.67",)]
    c = rows(S.report_counts(S.share_global(df, "IncreasingStress", drop_null=True), "IncreasingStress"))
    assert c == [("no: 2 (40.00%)",), ("yes: 3 (60.00%)",)]
    d = rows(S.report_rates(S.rate_by_group(df, "Country", "MentalHealthHistory", drop_null_key=True), "Country"))
    assert d == [("no: 1/2 (50.00%)",), ("se: 1/2 (50.00%)",)]


def test_missing_factor_columns_raise(spark):
    import pytest

    df = _df(spark, DATA)
    with pytest.raises(ValueError):
        S.rate_by_factor(df, ["NoSuchColumn"])
    with pytest.raises(ValueError):
        S.answer_all(df, factors=["NoSuchColumn"])
