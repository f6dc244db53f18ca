"""Parquet, CSV and JSON writers, and output sizes.

``write_gold`` writes Parquet first and derives CSV and JSON from the written Parquet:
the cleaning plan runs once, the later writes read a compact columnar copy, and a lost
executor re-reads files instead of recomputing the whole lineage.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Quotes doubled, and no whitespace trimming: Spark's CSV writer trims leading and trailing
# spaces by default, which would change values such as "null " on the way to Silver.
CSV_WRITE_OPTIONS = {
    "header": "true", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
FORMATS = ("parquet", "csv", "json")


#: Text a task writes at most, about: a text file is one task's, and multi-line CSV is read
#: back by one task a file.
TEXT_TASK_BYTES = 256 * 1024 * 1024


def text_bytes(df: DataFrame, fmt: str) -> Column:
    """Bytes of a row as a line of CSV or JSON, but for quoting and escapes."""
    if fmt == "csv":
        each = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 1 for c in df.columns]
    else:
        each = [F.coalesce(F.octet_length(F.col(c).cast("string")) + 2, F.lit(4)) + len(c.encode()) + 4 for c in df.columns]
    return reduce(lambda a, b: a + b, each).cast("bigint")


@dataclass(frozen=True)
class TextPlan:
    """How a table goes to text files: tasks, and rows a file at most."""

    rows: int
    bytes: int
    tasks: int
    rows_per_file: int


def plan_text(df: DataFrame, formats: Sequence[str], task_bytes: int = TEXT_TASK_BYTES) -> dict[str, TextPlan]:
    """Tasks and files of text sinks by the bytes that the rows expand to, from one aggregate
    over ``df`` (Parquet splits say little: text is many times larger)."""
    widths = [F.coalesce(F.sum(text_bytes(df, f)), F.lit(0)).alias(f) for f in formats]
    r = df.agg(F.count(F.lit(1)).alias("rows"), *widths).first()
    tasks = {f: max(1, -(-r[f] // task_bytes)) for f in formats}
    return {f: TextPlan(r["rows"], r[f], tasks[f], max(1, -(-r["rows"] // tasks[f]))) for f in formats}


def dealt(written: DataFrame, partitions: int) -> DataFrame:
    """Rows of a Parquet table, as read, dealt evenly over ``partitions``: each file's rows in
    turn by their place in it. The place is the same when a task runs again, so unlike a
    round-robin ``repartition`` it needs no sort of the rows first, which spills once a
    task's rows outgrow its memory."""
    if partitions == 1:
        return written.repartition(1)
    read = written.metadataColumn("_metadata")
    place = read["row_index"] + F.crc32(read["file_name"].cast("binary"))
    # a column of its own: given as an expression, file name and place would be shuffled too
    part = "_part"
    while part in {c.lower() for c in written.columns}:
        part += "_"
    to = F.pmod(place, F.lit(partitions)).cast("int")
    return written.withColumn(part, to).repartitionById(partitions, part).drop(part)


def write_text(written: DataFrame, path: str, fmt: str, plan: TextPlan, mode: str = "overwrite") -> str:
    """Write a Parquet table, as read, as CSV or JSON by a plan: the rows are dealt evenly over
    its tasks (AQE would join partitions by their compressed bytes), and no file has more than
    its rows."""
    return write_table(dealt(written, plan.tasks), path, fmt, mode=mode, max_records_per_file=plan.rows_per_file)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partitions: int | None = None,
                mode: str = "overwrite", max_records_per_file: int | None = None,
                compression: str | None = None) -> str:
    """Write one table. ``partitions`` fixes the number of output files (a round-robin
    repartition); by default the upstream partitioning is kept. ``max_records_per_file``
    bounds file size, which keeps later non-splittable reads (multi-line CSV) parallel.
    ``compression`` is the codec of the files; by default the format's own."""
    if partitions:
        df = df.repartition(partitions)
    w = df.write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    if compression:
        w = w.option("compression", compression)
    if fmt == "parquet":
        w.parquet(path)
    elif fmt == "csv":
        w.options(**CSV_WRITE_OPTIONS).csv(path)
    elif fmt == "json":
        w.option("ignoreNullFields", "false").json(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return path


def write_gold(spark: SparkSession, df: DataFrame, root: str, formats: Sequence[str] = FORMATS,
               partitions: int | None = None, task_bytes: int = TEXT_TASK_BYTES) -> dict[str, str]:
    """Write Gold in each format under ``root/<format>``; returns format -> path. Text formats
    are dealt to tasks of about ``task_bytes`` unless ``partitions`` fixes their number."""
    root = root.rstrip("/")
    paths: dict[str, str] = {}
    pq = write_table(df, f"{root}/parquet", "parquet", partitions)
    if "parquet" in formats:
        paths["parquet"] = pq
    written = spark.read.parquet(pq)
    others = [fmt for fmt in formats if fmt != "parquet"]
    plans = {} if partitions or not others else plan_text(written, others, task_bytes)

    def text(fmt):
        if partitions:
            return write_table(dealt(written, partitions), f"{root}/{fmt}", fmt)
        return write_text(written, f"{root}/{fmt}", fmt, plans[fmt])

    # The other formats only read the written Parquet and are independent: submit them as
    # concurrent jobs so one job's last tasks do not leave the cluster idle.
    with ThreadPoolExecutor(max_workers=max(1, len(others))) as pool:
        done = {fmt: pool.submit(text, fmt) for fmt in others}
        for fmt in others:
            paths[fmt] = done[fmt].result()
    return paths


def output_sizes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Bytes, MB and data files per output folder. The folders are listed by Spark's
    binaryFile source with only ``length`` selected, so file contents are never read."""
    parts = [
        spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(p)
        .select(F.lit(fmt).alias("format"), F.col("length"))
        for fmt, p in paths.items()
    ]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionAll(p)
    return union.groupBy("format").agg(
        F.sum("length").alias("bytes"),
        (F.sum("length") / F.lit(1048576.0)).alias("mb"),
        F.count(F.lit(1)).alias("files"),
    )


def row_bytes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Bytes of the rows in each folder of text files, without the header that each CSV file
    repeats: it depends on the rows only, not on how many files hold them."""
    parts = []
    for fmt, p in paths.items():
        files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(p).filter("length > 0")
        head = 0
        if fmt == "csv":
            head = len((",".join(spark.read.options(header="true").csv(p).columns) + "\n").encode())
        parts.append(files.agg(F.lit(fmt).alias("format"), F.coalesce(F.sum(F.col("length") - head), F.lit(0)).alias("row_bytes")))
    return reduce(DataFrame.unionAll, parts)
