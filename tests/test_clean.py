import pytest

from conftest import rows
from strata.operators import clean as C
from strata.schemas import GOLD_COLUMNS, MERGED, PAIR, SURVEY_COLUMNS


def _silver(spark, records):
    """records: list of dicts with some survey columns; the rest filled with 'yes'."""
    cols = SURVEY_COLUMNS + ["_ingestion_timestamp", "_source", "_status"]
    data = []
    for r in records:
        base = {c: "yes" for c in SURVEY_COLUMNS}
        base.update({"_ingestion_timestamp": 1.0, "_source": "jsonl", "_status": "valid"})
        base.update(r)
        data.append(tuple(base[c] for c in cols))
    schema = ", ".join(f"{c} string" for c in SURVEY_COLUMNS) + \
        ", _ingestion_timestamp double, _source string, _status string"
    return spark.createDataFrame(data, schema)


def test_drop_missing_reference_rule(spark):
    df = _silver(spark, [{}, {"Gender": None}, {"Gender": ""}, {"Gender": "NULL"},
                         {"Gender": "null "}, {"Gender": "NA"}, {"Gender": "null"}])
    kept = C.drop_missing(C.drop_metadata(df)).select("Gender").collect()
    assert sorted(r[0] for r in kept) == ["NA", "null", "null ", "yes"]


def test_drop_missing_pandas_rule(spark):
    df = _silver(spark, [{}, {"Country": "NA"}, {"Country": "n/a"}, {"Country": "None"},
                         {"Country": "nan"}, {"Country": "#N/A"}, {"Country": "Na"}, {"Country": "null "}])
    kept = C.drop_missing(C.drop_metadata(df), nulls="pandas").select("Country").collect()
    assert sorted(r[0] for r in kept) == ["Na", "null ", "yes"]


def test_drop_missing_ignores_metadata(spark):
    df = _silver(spark, [{"_status": None}])
    assert C.drop_missing(df).count() == 1


def test_normalize_missing(spark):
    df = _silver(spark, [{"Gender": ""}, {"Gender": "NULL"}, {"Gender": "x"}])
    got = [r[0] for r in C.normalize_missing(C.drop_metadata(df)).select("Gender").collect()]
    assert sorted(got, key=str) == [None, None, "x"] or sorted(map(str, got)) == ["None", "None", "x"]


def test_case_rules(spark):
    df = _silver(spark, [{"Occupation": "self-employed", "Gender": "mALE"}])
    t = C.apply_case(C.drop_metadata(df), "title").first()
    f = C.apply_case(C.drop_metadata(df), "first").first()
    n = C.apply_case(C.drop_metadata(df), "none").first()
    assert (t["Occupation"], t["Gender"]) == ("Self-Employed", "Male")
    assert (f["Occupation"], f["Gender"]) == ("Self-employed", "MALE")
    assert (n["Occupation"], n["Gender"]) == ("self-employed", "mALE")
    with pytest.raises(ValueError):
        C.apply_case(df, "upper")


def test_string_columns_by_type(spark):
    df = _silver(spark, [{}])
    assert "_ingestion_timestamp" not in C.string_columns(df, df.columns)
    assert set(C.string_columns(df)) == set(SURVEY_COLUMNS)


def test_merge_null_on_mismatch(spark):
    df = C.drop_metadata(_silver(spark, [{PAIR[0]: "a", PAIR[1]: "a"}, {PAIR[0]: "a", PAIR[1]: "b"}]))
    out = C.merge_pair(df, policy="null_on_mismatch")
    assert out.columns == GOLD_COLUMNS
    assert sorted(r[MERGED] or "-" for r in out.collect()) == ["-", "a"]


def test_merge_keep_pair(spark):
    df = C.drop_metadata(_silver(spark, [{PAIR[0]: "a", PAIR[1]: "a"}, {PAIR[0]: "a", PAIR[1]: "b"}]))
    out = C.merge_pair(df, policy="keep_pair")
    assert out.columns == SURVEY_COLUMNS + [MERGED]
    got = rows(out.select(*PAIR, MERGED))
    assert got == [("a", "b", None), (None, None, "a")]


def test_merge_whole_table(spark):
    agree = C.drop_metadata(_silver(spark, [{PAIR[0]: "a", PAIR[1]: "a"}, {PAIR[0]: None, PAIR[1]: None}]))
    out = C.merge_pair(agree, policy="whole_table")
    assert PAIR[1] not in out.columns and MERGED in out.columns
    assert out.columns.index(MERGED) == SURVEY_COLUMNS.index(PAIR[0])  # renamed in place
    differ = C.drop_metadata(_silver(spark, [{PAIR[0]: "a", PAIR[1]: "b"}]))
    assert C.merge_pair(differ, policy="whole_table").columns == SURVEY_COLUMNS
    empty = C.drop_metadata(_silver(spark, [{}])).limit(0)
    assert MERGED in C.merge_pair(empty, policy="whole_table").columns


def test_dedup_ignores_metadata(spark):
    df = _silver(spark, [{"_ingestion_timestamp": 1.0}, {"_ingestion_timestamp": 2.0}, {"Gender": "x"}])
    assert C.dedup(df).count() == 2


def test_clean_end_to_end_and_counts(spark):
    df = _silver(spark, [
        {"Gender": "male", PAIR[0]: "yes", PAIR[1]: "YES"},
        {"Gender": "male", PAIR[0]: "yes", PAIR[1]: "no"},
        {"Gender": "", PAIR[0]: "yes"},
        {"Gender": "male", PAIR[0]: "yes", PAIR[1]: "YES"},
    ])
    gold = C.clean(df)
    assert gold.columns == GOLD_COLUMNS
    got = rows(gold.select("Gender", MERGED))
    assert got == [("Male", "Yes"), ("Male", "Yes"), ("Male", None)]
    assert C.clean(df, dedup_rows=True).count() == 2
    c = C.clean_counts(df).first()
    assert (c["rows_in"], c["rows_dropped"], c["rows_kept"]) == (4, 1, 3)
    # Gold has no missing word left (except the merged column on mismatch)
    for col in GOLD_COLUMNS[:-1]:
        assert gold.filter(gold[col].isNull() | gold[col].isin("", "NULL")).count() == 0
