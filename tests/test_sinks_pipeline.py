import os
import sys

from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL, rows
from strata import fixtures
from strata.operators import clean as C
from strata.plans import compare, pipeline
from strata.schemas import GOLD_COLUMNS
from strata.session import scratch_path
from strata.sinks.writers import output_sizes, write_gold
from strata.sources.files import read_gold
from strata.streaming import start_bronze_stream

HOSTILE = [
    ("a, b", 'say "hi"', "line one\nline two", "back\\slash", "null ", " lead"),
    ("plain", "", None, "é ü", "NULL", "x"),
]
SCHEMA = "c1 string, c2 string, c3 string, c4 string, c5 string, c6 string"


def test_round_trips_keep_values(spark):
    df = spark.createDataFrame(HOSTILE, SCHEMA)
    root = scratch_path(spark, "rt")
    paths = write_gold(spark, df, root, partitions=2)
    want = rows(df)
    assert rows(read_gold(spark, paths["parquet"], "parquet", df.schema)) == want
    assert rows(read_gold(spark, paths["json"], "json", df.schema)) == want
    # CSV: the empty string comes back as null (treated alike by the missing-value rule)
    csv_want = [tuple(None if v == "" else v for v in r) for r in want]
    assert rows(read_gold(spark, paths["csv"], "csv", df.schema)) == sorted(
        csv_want, key=lambda t: tuple((x is None, str(x)) for x in t))
    sizes = {r["format"]: (r["bytes"], r["files"]) for r in output_sizes(spark, paths).collect()}
    assert set(sizes) == {"parquet", "csv", "json"}
    for fmt, (size, files) in sizes.items():
        on_disk = sum(os.path.getsize(os.path.join(paths[fmt].replace("file:", ""), f))
                      for f in os.listdir(paths[fmt].replace("file:", "")) if f.startswith("part-"))
        assert size == on_disk and files >= 1


def test_medallion_and_faces(spark):
    raw, layers = fixtures.materialize(spark, SF_SMALL)
    gold = pipeline.gold_frame(spark, layers)
    assert gold.columns == GOLD_COLUMNS
    assert gold.count() == C.clean(spark.read.schema(gold.schema).parquet(layers.gold["parquet"])).count()
    agree = {(r["question"], r["face"]): r["mismatches"] for r in compare.faces_agree(spark, gold).collect()}
    assert len(agree) == 10 and set(agree.values()) == {0}
    timings = compare.time_faces(spark, gold)
    assert len(timings) == 15 and all(t["seconds"] >= 0 for t in timings)


def test_bronze_stream_equals_batch(spark):
    raw, layers = fixtures.materialize(spark, SF_SMALL)
    out = scratch_path(spark, "stream-test")
    q = start_bronze_stream(spark, raw, out, max_files_per_trigger=1)
    q.awaitTermination()
    streamed = spark.read.parquet(out).drop("_ingestion_timestamp")
    batch = spark.read.parquet(layers.bronze).drop("_ingestion_timestamp")
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0


def test_short_csv_row_pads_with_null(spark, tmp_path):
    from strata.schemas import SILVER_SCHEMA
    from strata.sources.files import read_silver_csv

    header = ",".join(SILVER_SCHEMA.names)
    (tmp_path / "s.csv").write_text(header + "\nmale,norway\n")
    df = read_silver_csv(spark, str(tmp_path / "s.csv"))
    r = df.first()
    assert (r["Gender"], r["Country"], r["Occupation"]) == ("male", "norway", None)
    assert C.drop_missing(C.drop_metadata(df)).count() == 0


def test_silver_files_are_bounded(spark, tmp_path):
    from strata.sinks.writers import write_table

    out = write_table(spark.range(100).selectExpr("cast(id as string) as a"), str(tmp_path / "o"), "csv",
                      partitions=1, max_records_per_file=30)
    assert len([f for f in os.listdir(out) if f.startswith("part-")]) == 4


def test_sql_face_decimal_option(spark):
    from strata.plans import sql_face

    df = spark.createDataFrame([("a", "yes"), ("a", "no"), ("b", "yes")], "Country string, IncreasingStress string")
    df.createOrReplaceTempView("t_dec")
    dec = spark.sql(sql_face.share_within_sql("t_dec", "Country", "IncreasingStress", decimal=True))
    dbl = spark.sql(sql_face.share_within_sql("t_dec", "Country", "IncreasingStress"))
    assert dict(dec.dtypes)["prop"].startswith("decimal") and dict(dbl.dtypes)["prop"] == "double"
    assert [float(r["prop"]) for r in dec.collect()] == [r["prop"] for r in dbl.collect()]


def test_command_line_jobs(spark, capsys):
    from strata.__main__ import main

    raw, _ = fixtures.materialize(spark, SF_SMALL)
    root = scratch_path(spark, "cli")
    assert main(["ingest", raw, root]) == 0
    assert main(["clean", f"{root}/silver", f"{root}/gold", "--merge", "keep_pair"]) == 0
    assert main(["serve", f"{root}/gold/parquet", "--faces", "dataframe,sql"]) == 0
    assert main(["serve", f"{root}/gold/parquet", "--one-scan"]) == 0
    out = capsys.readouterr().out
    assert "cleaned rows:" in out and "=== question E" in out


def test_gold_folder_per_face(spark):
    _, layers = fixtures.materialize(spark, SF_SMALL)
    root = scratch_path(spark, "faces")
    out = pipeline.run_gold_faces(spark, layers.silver, root, formats=("parquet",))
    assert set(out) == {"rdd", "spark_df", "pandas"}
    cols = {face: spark.read.parquet(p["parquet"]).columns for face, p in out.items()}
    assert len(cols["rdd"]) == 18 and cols["spark_df"] == GOLD_COLUMNS and len(cols["pandas"]) == 17


def test_silver_as_parquet_gives_same_gold(spark):
    raw, layers = fixtures.materialize(spark, SF_SMALL)
    root = scratch_path(spark, "silver-parquet")
    alt = pipeline.medallion(spark, raw, root, formats=("parquet",), silver_format="parquet")
    a = spark.read.parquet(alt.gold["parquet"])
    b = spark.read.parquet(layers.gold["parquet"])
    # CSV turns "" into null; both are dropped by the missing-value rule, so Gold agrees.
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_bronze_stream_is_incremental_across_restarts(spark, tmp_path):
    raw_dir = tmp_path / "raw"
    raw_dir.mkdir()
    (raw_dir / "a.jsonl").write_text('{"person":{"gender":"m"}}\n{"a":\n')
    out, ckpt = str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    start_bronze_stream(spark, str(raw_dir), out, checkpoint=ckpt).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    (raw_dir / "b.jsonl").write_text('{"person":{"gender":"f"}}\n5\n\n')
    start_bronze_stream(spark, str(raw_dir), out, checkpoint=ckpt).awaitTermination()  # restart
    got = sorted(r["_status"] for r in spark.read.parquet(out).collect())
    assert got == ["parse_error", "schema_error", "valid", "valid"]  # first file not read twice


def test_rdd_face_runs_from_another_directory(tmp_path):
    """Python workers import the package shipped with addPyFile, not the caller's cwd."""
    import subprocess
    import textwrap

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "run.py"
    script.write_text(textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {repo!r})
        from strata.session import build_session
        from strata.plans.rdd_face import rate_by_group_rdd
        spark = build_session(master="local[2]", shuffle_partitions=2)
        df = spark.createDataFrame([("a", "yes"), ("a", "no")], "k string, f string")
        print(sorted(tuple(r) for r in rate_by_group_rdd(spark, df, "k", "f").collect()))
    """))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(script)], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=300)
    assert "[('a', 1, 2, 0.5)]" in out.stdout, out.stderr[-2000:]


_CELL = ["a", " ", ",", '"', "'", "\n", "\r", "\\", "\t", "é", "NULL", '""', "\r\n", "{", "}"]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(*[st.lists(st.sampled_from(_CELL), max_size=6).map("".join)] * 2),
                min_size=1, max_size=40))
def test_csv_and_json_round_trips_are_exact(spark, data):
    from strata.sinks.writers import write_table

    df = spark.createDataFrame(data, "a string, b string")
    root = scratch_path(spark, "rt-prop")
    csv_back = read_gold(spark, write_table(df, f"{root}/csv", "csv"), "csv", df.schema)
    json_back = read_gold(spark, write_table(df, f"{root}/json", "json"), "json", df.schema)
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert sorted(map(tuple, csv_back.collect()), key=key) == sorted(
        [tuple(None if v == "" else v for v in r) for r in data], key=key)
    assert sorted(map(tuple, json_back.collect()), key=key) == sorted(data, key=key)


def test_scratch_uses_the_clusters_checkpoint_dir():
    from strata.session import scratch_path, scratch_root

    class _Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value if key == "spark.checkpoint.dir" else default

    class _Session:
        def __init__(self, value):
            self.conf = _Conf(value)

    shared = _Session("hdfs://cluster/shared/ckpt/")
    assert scratch_root(shared) == "hdfs://cluster/shared/ckpt"
    p = scratch_path(shared, "x")
    assert p.startswith("hdfs://cluster/shared/ckpt/strata-x-") and p != scratch_path(shared, "x")
