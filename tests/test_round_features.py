"""Signed face comparison, decisions inside a plan, deep JSON, the cache, text sinks, Gold by
approach, hash samples, two-level shares and exact fixed-point text."""

import contextlib
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from strata import fixtures
from strata.functions.text import fixed_text, percent_text
from strata.operators import clean as C
from strata.operators import serve as S
from strata.plans import compare, pipeline, rdd_face, sql_face
from strata.schemas import MERGED, PAIR, SURVEY_COLUMNS
from strata.session import scratch_path
from strata.sinks import writers as W
from strata.sources.files import read_gold, read_silver_csv
from strata.sources.jsonl import bronze, is_single_json, read_lines


def plan(df, final=False):
    if final:
        df.collect()
    with contextlib.redirect_stdout(buf := io.StringIO()):
        df.explain()
    return buf.getvalue()


@contextlib.contextmanager
def no_jobs(spark):
    """Fails if a job starts inside the block."""
    sc, group = spark.sparkContext, f"no-jobs-{random.random()}"
    sc.setJobGroup(group, "")
    try:
        yield
    finally:
        ids = sc.statusTracker().getJobIdsForGroup(group)
        sc._jsc.clearJobGroup()
    assert list(ids) == []


@pytest.fixture(scope="module")
def layers(spark):
    return fixtures.materialize(spark, SF_SMALL)[1]


@pytest.fixture(scope="module")
def gold(spark, layers):
    return spark.read.parquet(layers.gold["parquet"])


# ------------------------------------------------------------------ faces
def test_signed_union_counts_copies_both_ways(spark):
    a = spark.createDataFrame([(1, "x", 0.5), (1, "x", 0.5), (2, None, None), (3, "z", -0.0)], "a int, b string, c double")
    b = spark.createDataFrame([(1, "x", 0.5), (2, None, None), (4, "q", 1.0), (4, "q", 1.0), (3, "z", 0.0)], "a int, b string, c double")
    assert rows(compare.differing_rows(a, b)) == [(1, "x", 0.5, 1), (4, "q", 1.0, -2)]
    assert compare.mismatches(a, b).first()[0] == 3
    assert compare.mismatches(a, a).first()[0] == 0 and compare.mismatches(a.limit(0), a.limit(0)).first()[0] == 0


def test_a_planted_wrong_face_is_reported(spark, gold):
    built = {f: build() for f, build in compare.faces(spark, gold)["D"].items()}
    built["wrong"] = built["sql"].withColumn("yes_count", F.when(F.col("Country") == built["sql"].first()["Country"], -1).otherwise(F.col("yes_count")))
    got = {r.face: r.mismatches for r in compare.compare_faces("D", built).collect()}
    assert got == {"sql": 0, "rdd": 0, "wrong": 2}


def test_each_answer_is_planned_once(spark, gold):
    built = {f: build() for f, build in compare.faces(spark, gold)["D"].items()}
    text = plan(compare.compare_faces("D", built))
    assert text.count("FileScan parquet") == 2 and text.count("Scan ExistingRDD") == 1
    assert text.count("Union") == 1 and "Except" not in text and "Join" not in text


def test_rdd_face_plans_without_a_job(spark, gold):
    gold.count()
    with no_jobs(spark):
        rdd_face.share_global_rdd(spark, gold, "IncreasingStress")


# ------------------------------------------------------------------ whole-table merge
def survey(spark, pairs):
    return spark.createDataFrame([(*["v"] * len(SURVEY_COLUMNS), *p) for p in pairs], ", ".join(f"{c} string" for c in [*(f"x{i}" for i in range(len(SURVEY_COLUMNS))), *PAIR]))


@pytest.mark.parametrize("pairs,agree", [([("a", "a"), (None, None)], True), ([("a", "a"), ("a", None)], False), ([], True)])
def test_whole_table_decision_in_the_plan(spark, pairs, agree):
    df = survey(spark, pairs)
    with no_jobs(spark):
        out = C.merge_pair(df, policy="whole_table_in_plan")
    got = [(r[PAIR[0]], r[PAIR[1]], r[MERGED]) for r in out.collect()]
    assert sorted(got, key=str) == sorted([(None, None, a) if agree else (a, b, None) for a, b in pairs], key=str)


def test_whole_table_computes_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = survey(spark, [("a", "a")] * 50)
    out = C.merge_pair(df.mapInArrow(count, df.schema), policy="whole_table")
    assert out.count() == 50 and MERGED in out.columns and seen.value == 50


# ------------------------------------------------------------------ deep JSON
DEEP = "[" * 1500 + "]" * 1500


def status(spark, lines):
    return [r._status for r in bronze(spark.createDataFrame([(x,) for x in lines], "value string")).select("_status").collect()]


def test_nesting_beyond_the_parser_is_not_a_parse_error(spark):
    lines = [DEEP, '{"x":' + DEEP + "}", '{"person":{"gender":' + DEEP + "}}", '{"person":' + DEEP + "}", "[" * 1500, DEEP + "]", '{"x":' + DEEP + "},1"]
    assert status(spark, lines) == ["schema_error", "valid", "too_deep", "schema_error", "parse_error", "parse_error", "parse_error"]


def test_deep_text_is_kept(spark):
    line = '{"person":{"gender":' + DEEP + "}}"
    assert bronze(spark.createDataFrame([(line,)], "value string")).first()._raw_data == line


def test_token_soup_agrees_with_json_loads(spark):
    rng = random.Random(11)
    tokens = ["{", "}", "[", "]", ",", ":", '"a"', '"r"', "1", "null", "true", " ", "]}", '"r":', "{}", "[]", "'", "-1.5e3", "x", "[" * 40, "]" * 40, '{"a":', '"\\""', '{"_corrupt":1}']
    soup = ["".join(rng.choice(tokens) for _ in range(rng.randint(1, 9))) for _ in range(6000)]
    soup += ["[" * k + "]" * (k + d) for k in (900, 990, 1010) for d in (-1, 0, 1)]

    def good(t):
        try:
            json.loads(t)
        except ValueError:
            return False
        except RecursionError:
            return None
        return True

    df = spark.createDataFrame(list(enumerate(soup)), "i int, t string")
    for r in df.select("t", is_single_json("t").alias("ok")).collect():
        assert good(r.t) in (None, r.ok), r.t


# ------------------------------------------------------------------ cache
def test_served_copy_is_read_and_released(spark, gold):
    with S.served(gold, partitions=3) as g:
        text = plan(S.share_global(g, "IncreasingStress"))
        assert "InMemoryTableScan" in text and g.rdd.getNumPartitions() == 3
        with pytest.raises(ZeroDivisionError), S.served(gold.limit(5)) as few:
            assert few.is_cached
            1 / 0  # noqa: B018
        assert not few.is_cached
    assert not g.is_cached and not spark.sparkContext._jsc.getPersistentRDDs()


def test_cached_answers_scan_once_and_leave_nothing(spark, gold, tmp_path):
    got = S.cached_answers(gold, str(tmp_path / "a"))
    assert not spark.sparkContext._jsc.getPersistentRDDs()
    one = S.answer_all(gold)
    want = S.answer_rows({q: one[q] for q in "ABCDE"})
    assert compare.mismatches(got, want).first()[0] == 0


# ------------------------------------------------------------------ text sinks
def test_text_plan_follows_the_expanded_bytes(spark):
    df = spark.range(20_000).select(*[F.lit("same text again and again").alias(c) for c in "abcdefgh"])
    plans = W.plan_text(df, ("csv", "json"), 1 << 20)
    assert plans["csv"].bytes == 20_000 * 8 * 26 and plans["csv"].tasks == 4 and plans["csv"].rows_per_file == 5000
    assert plans["json"].tasks > plans["csv"].tasks
    empty = W.plan_text(df.limit(0), ("csv",))["csv"]
    assert (empty.rows, empty.tasks, empty.rows_per_file) == (0, 1, 1)


def test_no_text_file_is_larger_than_planned(spark, tmp_path):
    df = spark.range(20_000).select(*[F.lit("same text again and again").alias(c) for c in "abcdefgh"]).coalesce(1)
    paths = W.write_gold(spark, df, str(tmp_path), task_bytes=1 << 20)
    for fmt in ("csv", "json"):
        sizes = [p.stat().st_size for p in (tmp_path / fmt).glob("part-*")]
        assert max(sizes) < 1.1 * (1 << 20) and len(sizes) >= 4
        assert spark.read.options(header="true").format(fmt).load(paths[fmt]).count() == 20_000
    assert len(list((tmp_path / "parquet").glob("part-*"))) == 1


def test_text_rows_are_dealt_without_a_sort(spark, tmp_path):
    df = spark.range(1000).select(F.when(F.col("id") % 9 > 0, F.lit("x")).alias("a"), F.col("id").cast("string").alias("_part"))
    df.repartition(3).write.parquet(str(tmp_path / "p"))
    written = spark.read.parquet(str(tmp_path / "p"))
    out = W.dealt(written, 7)
    plan = out._jdf.queryExecution().toString()
    assert "RoundRobin" not in plan and "Sort" not in plan and "_extract_file_name" not in plan
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert out.columns == df.columns and len(sizes) == 7 and max(sizes) - min(sizes) <= 3
    assert rows(out) == rows(df)
    again = spark.read.parquet(str(tmp_path / "p"))
    assert rows(out.withColumn("at", F.spark_partition_id())) == rows(W.dealt(again, 7).withColumn("at", F.spark_partition_id()))


def test_text_sinks_sort_no_rows(spark, tmp_path, monkeypatch):
    seen = []
    keep = W.write_table
    monkeypatch.setattr(W, "write_table", lambda df, path, fmt="parquet", partitions=None, *a, **k: (
        seen.append((fmt, partitions, df._jdf.queryExecution().toString())), keep(df, path, fmt, partitions, *a, **k))[1])
    df = spark.range(20_000).select(*[F.lit("same text again and again").alias(c) for c in "abcdefgh"]).coalesce(1)
    W.write_gold(spark, df, str(tmp_path), task_bytes=1 << 20)
    text = [(p, plan) for fmt, p, plan in seen if fmt != "parquet"]
    assert len(text) == 2 and all(p is None and "RoundRobin" not in plan for p, plan in text)


def _names(spark, path):
    return [f.rsplit("/", 1)[1] for f in spark.read.text(path).inputFiles()]


def test_scratch_silver_is_compressed_and_whole(spark):
    _, layers = fixtures.materialize(spark, SF_SMALL)
    plain = pipeline.run_silver(spark, layers.bronze, scratch_path(spark, "silver-plain"))
    assert all(n.endswith(".csv.gz") for n in _names(spark, layers.silver)) and all(n.endswith(".csv") for n in _names(spark, plain))
    got, want = read_silver_csv(spark, layers.silver), read_silver_csv(spark, plain)
    assert want.count() > 0 and rows(got) == rows(want)


def test_scratch_raw_is_compressed_and_whole(spark):
    raw, _ = fixtures.materialize(spark, SF_SMALL)
    assert all(n.endswith(".txt.gz") for n in _names(spark, raw))
    assert rows(read_lines(spark, raw)) == rows(fixtures.raw_lines(spark, SF_SMALL))


def test_raw_files_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "RAW_LINES_PER_FILE", 400)
    monkeypatch.setattr(fixtures, "_MATERIALIZED", {})
    raw, layers = fixtures.materialize(spark, SF_SMALL)
    per_file = read_lines(spark, raw).groupBy(F.input_file_name()).count().collect()
    assert len(per_file) >= 4 and max(r["count"] for r in per_file) <= 400
    assert read_gold(spark, layers.gold["parquet"], "parquet").exceptAll(read_gold(spark, layers.gold["json"], "json")).isEmpty()


def test_row_bytes_do_not_depend_on_files(spark, gold, tmp_path):
    few, many = (W.write_gold(spark, gold, str(tmp_path / str(n)), ("csv", "json"), partitions=n) for n in (1, 7))
    assert rows(W.row_bytes(spark, few)) == rows(W.row_bytes(spark, many))


def test_gold_csv_is_bound_by_header(spark, gold, tmp_path):
    write = W.CSV_WRITE_OPTIONS
    gold.select(gold.columns[::-1]).write.options(**write).csv(str(tmp_path / "r"))
    assert compare.mismatches(gold, read_gold(spark, str(tmp_path / "r"), "csv")).first()[0] == 0
    gold.drop("Gender").write.options(**write).csv(str(tmp_path / "short"))
    with pytest.raises(ValueError, match="header"):
        read_gold(spark, str(tmp_path / "short"), "csv")


# ------------------------------------------------------------------ Gold by approach
def test_gold_by_approach_is_pruned(spark, layers, tmp_path):
    root = str(tmp_path / "g")
    paths = pipeline.run_gold_by_approach(spark, layers.silver, root, formats=("parquet", "json"))
    assert set(paths) == {"rdd", "spark_df", "pandas"}
    for fmt in ("parquet", "json"):
        every = pipeline.read_gold_by_approach(spark, root, fmt)
        assert every.columns == [*SURVEY_COLUMNS, MERGED, "approach"]
        one = every.filter("approach = 'spark_df'")
        text = plan(one)
        assert "PartitionFilters: [isnotnull(approach" in text and "= spark_df" in text
        assert len(one.inputFiles()) >= 1 and all("approach=" in f for f in one.inputFiles())
        assert one.count() == spark.read.parquet(paths["spark_df"]["parquet"]).count()
        assert one.filter(F.col(PAIR[0]).isNotNull()).count() == 0
    with pytest.raises(ValueError):
        pipeline.read_gold_by_approach(spark, root, "csv")


# ------------------------------------------------------------------ sample
def test_hash_sample_ignores_the_layout(spark, gold):
    a, b = S.hash_sample(gold, 0.3), S.hash_sample(gold.repartition(7).sortWithinPartitions("Country"), 0.3)
    assert rows(a) == rows(b) and 0.2 < a.count() / gold.count() < 0.4
    assert rows(S.hash_sample(gold, 0.3, seed=1)) != rows(a)
    assert S.hash_sample(gold, 0.0).count() == 0 and S.hash_sample(gold, 1.0).count() == gold.count()
    odd = spark.createDataFrame([(None, ""), ("", None), ("a|=b", None), ("a", "b")], "x string, y string")
    assert S.hash_sample(odd, 1.0).count() == 4
    with pytest.raises(ValueError):
        S.hash_sample(odd, 1.5)


# ------------------------------------------------------------------ shares
def test_share_global_sql_scans_once(spark, gold):
    gold.createOrReplaceTempView("once")
    assert plan(spark.sql(sql_face.share_global_sql("once", "IncreasingStress"))).count("FileScan parquet") == 1


def test_share_within_has_no_window_task_per_group(spark):
    many = spark.range(1_000_000).select(F.lit("one").alias("g"), F.col("id").cast("string").alias("v"))
    df = many.unionAll(spark.createDataFrame([(None, "a"), (None, None), ("two", None)], "g string, v string"))
    out = S.share_within(df, "g", "v", sort=False)
    assert "Window" not in plan(out)
    r = out.agg(F.count("*").alias("n"), F.sum("prop").alias("p"), F.sum(F.when(F.col("g") == "one", F.col("prop"))).alias("one")).first()
    assert r.n == 1_000_003 and abs(r.p - 3) < 1e-6 and abs(r.one - 1) < 1e-6
    assert rows(out.filter("g is null")) == [(None, "a", 1, 0.5), (None, None, 1, 0.5)]


# ------------------------------------------------------------------ fixed-point text
def test_fixed_text_rounds_the_exact_binary_value(spark):
    rng = random.Random(2)
    some = [0.125, 0.285, 2.675, 0.00125, 0.375, 0.5, 1.5, 2.5, 0.005, 1.005, -0.125, -2.675, -0.001, 0.0, -0.0, 1e-300, 999999999.995, 1e15, 1e17, 123456.785]
    some += [rng.random() * 10 ** rng.randint(-3, 9) for _ in range(3000)] + [k / 2**j for j in range(1, 12) for k in range(1, 200, 7)] + [k / 200 for k in range(400)]
    df = spark.createDataFrame([(x,) for x in some], "x double")
    got = df.select("x", fixed_text("x").alias("two"), fixed_text("x", 0).alias("none"), fixed_text("x", 5).alias("five"), percent_text("x").alias("pct")).collect()
    for r in got:
        if r.x < 1e13:
            assert (r.two, r.five, r.pct) == (f"{r.x:.2f}", f"{r.x:.5f}" if r.x < 1e10 else r.five, f"{r.x * 100:.2f}%"), r.x
            assert r.none == f"{r.x:.0f}", r.x
    assert spark.createDataFrame([(None,)], "x double").select(fixed_text("x")).first()[0] is None
