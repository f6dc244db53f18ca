"""Command line for the three medallion jobs.

    python -m strata ingest RAW_PATH ROOT            # raw JSONL -> ROOT/bronze (Parquet), ROOT/silver (CSV)
    python -m strata clean SILVER_PATH GOLD_ROOT     # Silver CSV -> Gold in Parquet, CSV, JSON + sizes
    python -m strata serve GOLD_PARQUET [--faces dataframe,sql,rdd]   # questions A-E, timed per face
    python -m strata serve GOLD_PARQUET --one-scan                    # A-E from one scan of Gold

On a cluster, submit with ``spark-submit -m strata ...`` or call the same functions from a
job; the session comes from the environment (``SparkSession.builder.getOrCreate()``).
Only the small answer tables are shown on the console.
"""

from __future__ import annotations

import argparse
import json
import sys
import time

from pyspark.sql import SparkSession

from strata.operators import ingest as I
from strata.operators import serve as S
from strata.plans import compare, pipeline
from strata.sinks.writers import output_sizes


def _session() -> SparkSession:
    return SparkSession.builder.appName("strata").getOrCreate()


def cmd_ingest(args) -> None:
    spark = _session()
    root = args.root.rstrip("/")
    t0 = time.perf_counter()
    b = pipeline.run_bronze(spark, args.raw, f"{root}/bronze")
    s = pipeline.run_silver(spark, b, f"{root}/silver", fmt=args.silver_format)
    bronze_df = spark.read.parquet(b)
    I.status_counts(bronze_df).show(truncate=False)
    I.shape(I.flatten(bronze_df)).show()
    print(json.dumps({"bronze": b, "silver": s, "seconds": round(time.perf_counter() - t0, 3)}))


def cmd_clean(args) -> None:
    spark = _session()
    t0 = time.perf_counter()
    paths = pipeline.run_gold(
        spark, args.silver, args.gold_root, partitions=args.partitions,
        silver_format=args.silver_format, nulls=args.nulls, case=args.case, merge=args.merge, dedup_rows=args.dedup,
    )
    seconds = round(time.perf_counter() - t0, 3)
    gold = spark.read.parquet(paths["parquet"])
    print(f"cleaned rows: {gold.count()}")
    output_sizes(spark, paths).show(truncate=False)
    print(json.dumps({"gold": paths, "seconds": seconds}))


def _show_all(answer) -> None:
    """Every row of a printed answer (a row for each category, country or occupation)."""
    answer.show(max(1, answer.count()), truncate=False)


def cmd_serve(args) -> None:
    spark = _session()
    gold = spark.read.parquet(args.gold)
    if args.one_scan:
        t0 = time.perf_counter()
        for name, answer in S.answer_all(gold).items():
            print(f"=== {name}")
            _show_all(answer)
        print(f"one scan: {time.perf_counter() - t0:.2f}s")
        return
    wanted = args.faces.split(",")
    built = compare.faces(spark, gold)
    for question, by_face in built.items():
        print(f"=== question {question}")
        for face in wanted:
            t0 = time.perf_counter()
            answer = by_face[face]()
            if face == wanted[0]:
                _show_all(answer)
            else:
                answer.write.format("noop").mode("overwrite").save()
            print(f"{face}: {time.perf_counter() - t0:.2f}s")


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="strata")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest")
    a.add_argument("raw")
    a.add_argument("root")
    a.add_argument("--silver-format", default="csv", choices=["csv", "parquet"])
    a.set_defaults(fn=cmd_ingest)
    c = sub.add_parser("clean")
    c.add_argument("silver")
    c.add_argument("gold_root")
    c.add_argument("--silver-format", default="csv", choices=["csv", "parquet"])
    c.add_argument("--nulls", default="reference", choices=["reference", "pandas", "none"])
    c.add_argument("--case", default="title", choices=["title", "first", "none"])
    c.add_argument("--merge", default="null_on_mismatch",
                   choices=["null_on_mismatch", "keep_pair", "whole_table", "whole_table_in_plan", "none"])
    c.add_argument("--dedup", action="store_true")
    c.add_argument("--partitions", type=int, default=None)
    c.set_defaults(fn=cmd_clean)
    s = sub.add_parser("serve")
    s.add_argument("gold")
    s.add_argument("--faces", default="dataframe,sql")
    s.add_argument("--one-scan", action="store_true", help="answer A-E from one scan of Gold")
    s.set_defaults(fn=cmd_serve)
    args = p.parse_args(argv)
    args.fn(args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
