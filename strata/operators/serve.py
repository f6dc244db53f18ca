"""Gold -> answers: generic categorical questions over any table (DataFrame face).

All answers are DataFrames; nothing is collected. Every question is a grouped aggregate
with map-side partial aggregation, so a hot key (even a third of all rows) is combined
inside each task before the exchange and the shuffle carries one row per key per task.
Windows and totals only ever run over already-aggregated rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.text import fixed_text, flag, percent_text
from strata.schemas import FACTORS, TARGET


def _ratio(num: str, den: str) -> F.Column:
    return F.col(num).cast("double") / F.col(den).cast("double")


def _present(df: DataFrame, factors: Sequence[str]) -> list[str]:
    present = [f for f in factors if f in df.columns]
    if not present:
        raise ValueError(f"none of the factor columns {list(factors)} is in the table")
    return present


def rate_by_factor(
    df: DataFrame,
    factors: Sequence[str] = FACTORS,
    target: str = TARGET,
    positive: str = "yes",
    trim: bool = False,
) -> DataFrame:
    """Every (factor, category) with its row count, positive count and rate of
    ``target == positive``; null categories are left out, a null target counts as 0.
    One scan for all factors: unpivot -> partial aggregate -> one exchange."""
    present = _present(df, factors)
    long = (
        df.select(flag(target, positive, trim).alias("_hi"), *[F.col(f).cast("string") for f in present])
        .unpivot(["_hi"], present, "factor", "category")
        .filter(F.col("category").isNotNull())
    )
    return (
        long.groupBy("factor", "category")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("_hi").cast("bigint").alias("yes_count"))
        .withColumn("prop", _ratio("yes_count", "n"))
    )


def top_category(
    df: DataFrame,
    factors: Sequence[str] = FACTORS,
    target: str = TARGET,
    positive: str = "yes",
    trim: bool = False,
) -> DataFrame:
    """For each factor, the category with the highest rate (ties: category ascending)."""
    rates = rate_by_factor(df, factors, target, positive, trim)
    w = Window.partitionBy("factor").orderBy(F.desc("prop"), F.asc("category"))
    return (
        rates.withColumn("_rk", F.row_number().over(w))
        .filter(F.col("_rk") == 1)
        .select("factor", "category", "prop")
    )


def top_category_one_factor(
    df: DataFrame, factor: str, target: str = TARGET, positive: str = "yes", trim: bool = False
) -> DataFrame:
    """The single-factor form: filter -> flag -> group -> rate -> top 1 (TakeOrderedAndProject)."""
    return (
        df.filter(F.col(factor).isNotNull())
        .withColumn("_hi", flag(target, positive, trim))
        .groupBy(factor)
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("_hi").alias("_yes"))
        .select(
            F.lit(factor).alias("factor"),
            F.col(factor).cast("string").alias("category"),
            _ratio("_yes", "_n").alias("prop"),
        )
        .orderBy(F.desc("prop"), F.asc("category"))
        .limit(1)
    )


def share_within(
    df: DataFrame, group: str, value: str, drop_null_key: bool = False, sort: bool = True
) -> DataFrame:
    """Count of each ``value`` inside each ``group`` and its share of the group.

    Two levels: counts of (group, value), then totals of the groups from the counts, joined
    back. No task needs all values of a group, as a window per group would, so a group with
    millions of values stays spread; both levels read one shuffle of the counts."""
    d = df.filter(F.col(group).isNotNull()) if drop_null_key else df
    counts = d.groupBy(group, value).agg(F.count(F.lit(1)).alias("count"))
    out = _with_share(counts, group).select(group, value, "count", "prop")
    return out.orderBy(group, value) if sort else out


def _with_share(counts: DataFrame, group: str) -> DataFrame:
    """``counts`` with ``prop``, the share of a row's count in its group (null is a group)."""
    totals = counts.groupBy(F.col(group).alias("_g")).agg(F.sum("count").alias("_total"))
    joined = counts.join(totals, F.col(group).eqNullSafe(F.col("_g")))
    return joined.withColumn("prop", _ratio("count", "_total")).drop("_g", "_total")


def share_map(df: DataFrame, group: str, value: str, drop_null_key: bool = False) -> DataFrame:
    """One row per group with a ``value -> share`` map. Built from the aggregated counts,
    so each map holds one entry per distinct value, never one per row. Null values cannot
    be map keys and are left out of the map (their rows still count in the total)."""
    shares = share_within(df, group, value, drop_null_key, sort=False)
    return shares.groupBy(group).agg(
        F.map_from_entries(
            F.collect_list(F.when(F.col(value).isNotNull(), F.struct(F.col(value), F.col("prop"))))
        ).alias("shares"),
        F.sum("count").alias("total"),
    )


def share_global(df: DataFrame, value: str, drop_null: bool = False) -> DataFrame:
    """Count and overall share of each ``value``. The total is a scalar subquery over the
    grouped counts (Spark reuses the grouped exchange), not a single-partition window."""
    d = df.filter(F.col(value).isNotNull()) if drop_null else df
    counts = d.groupBy(value).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("prop", F.col("count").cast("double") / total.cast("double"))


def rate_by_group(
    df: DataFrame,
    key: str,
    flag_col: str,
    positive: str = "yes",
    trim: bool = False,
    missing_flag: str = "drop",
    drop_null_key: bool = False,
) -> DataFrame:
    """Per ``key``: rows whose ``flag_col`` is ``positive``, all rows, and the rate.

    ``missing_flag='drop'`` leaves rows with a null flag out (DataFrame/SQL rule);
    ``'as_no'`` counts them as not positive and keeps them in the total (RDD rule).
    ``drop_null_key`` leaves out rows with a null key."""
    if missing_flag not in ("drop", "as_no"):
        raise ValueError("missing_flag must be 'drop' or 'as_no'")
    d = df
    if missing_flag == "drop":
        d = d.filter(F.col(flag_col).isNotNull())
    if drop_null_key:
        d = d.filter(F.col(key).isNotNull())
    return (
        d.groupBy(key)
        .agg(
            F.sum(flag(flag_col, positive, trim)).cast("bigint").alias("yes_count"),
            F.count(F.lit(1)).alias("total_count"),
        )
        .withColumn("prop", _ratio("yes_count", "total_count"))
    )


def with_percent_text(df: DataFrame, prop_col: str = "prop", name: str = "pct") -> DataFrame:
    """Add the share as percent text (``25.00%``)."""
    return df.withColumn(name, percent_text(prop_col))


def report_top(top: DataFrame) -> DataFrame:
    """Question A as text lines: ``factor: 'category' → 0.43``."""
    return top.select(F.concat(F.col("factor"), F.lit(": '"), F.col("category"), F.lit("' → "),
                               fixed_text("prop")).alias("line"))


def report_counts(shares: DataFrame, value: str) -> DataFrame:
    """Question C as text lines: ``value: count (share%)``."""
    return shares.select(F.concat(F.col(value), F.lit(": "), F.col("count").cast("string"), F.lit(" ("),
                                  percent_text("prop"), F.lit(")")).alias("line"))


def report_rates(rates: DataFrame, key: str) -> DataFrame:
    """Questions D and E as text lines: ``key: yes/total (rate%)``."""
    return rates.select(F.concat(F.col(key), F.lit(": "), F.col("yes_count").cast("string"), F.lit("/"),
                                 F.col("total_count").cast("string"), F.lit(" ("), percent_text("prop"),
                                 F.lit(")")).alias("line"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of one column (partial distinct per task, then one exchange)."""
    return df.select(column).distinct()


def sample_rows(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """A Bernoulli sample without replacement (per task, no shuffle)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, fraction: float, seed: int = 42, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows whose hash is below ``fraction``: a sample without replacement that depends on
    the values and the seed only, not on files, partitions or tasks, so any engine draws the
    same rows again. Hashed are ``columns`` (by default all, in their order) as text, a null as
    a mark of its own; equal rows are drawn together. A filter: no shuffle."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be between 0 and 1")
    text = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns or df.columns]
    digits = F.substring(F.sha2(F.concat_ws("|", F.lit(str(seed)), *text), 256), 1, 8)
    return df.filter(F.conv(digits, 16, 10).cast("bigint") < F.lit(int(fraction * (1 << 32))))


# --------------------------------------------------------------------------- cache
@contextmanager
def served(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK, partitions: int | None = None) -> Iterator[DataFrame]:
    """``df`` persisted while several questions are asked of it, and released after them, also
    on an error. ``partitions`` deals the rows out anew before they are kept. Partitions that
    don't fit in memory go to the executors' disks; a lost one is computed again.

        with served(gold) as g:
            answers = {q: stored(a) for q, a in answer_all(g).items()}

    What is built inside and run after the block reads the files again, not the copy."""
    kept = (df.repartition(partitions) if partitions else df).persist(level)
    try:
        yield kept
    finally:
        kept.unpersist(blocking=True)


def answer_rows(answers: dict[str, DataFrame]) -> DataFrame:
    """Answers of questions A-E in one table: question, key, value, n, prop."""
    text = lambda c: F.col(c).cast("string") if c else F.lit(None).cast("string")
    parts = []
    for q, df in sorted(answers.items()):
        names = [c for c in df.columns if c not in ("count", "total_count", "yes_count", "n", "prop")]
        n = next((c for c in ("count", "total_count", "n") if c in df.columns), None)
        parts.append(df.select(
            F.lit(q).alias("question"), text(names[0]).alias("key"), text(names[1] if len(names) > 1 else None).alias("value"),
            (F.col(n) if n else F.lit(None)).cast("bigint").alias("n"), "prop"))
    return reduce(DataFrame.unionAll, parts)


def cached_answers(df: DataFrame, path: str) -> DataFrame:
    """Questions A-E, each by its own operator over one persisted copy of ``df``: ``df`` is
    scanned once, the answers are written to ``path`` and the copy is released."""
    with served(df) as g:
        answers = {
            "A": top_category(g), "B": share_within(g, "Country", TARGET, sort=False), "C": share_global(g, TARGET),
            "D": rate_by_group(g, "Country", "MentalHealthHistory"),
            "E": rate_by_group(g, "Occupation", "SelfEmployed", drop_null_key=True),
        }
        answer_rows(answers).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


# --------------------------------------------------------------------------- one scan
def answer_all(
    df: DataFrame,
    factors: Sequence[str] = FACTORS,
    target: str = TARGET,
    share_group: str = "Country",
    rates: Sequence[tuple[str, str, bool]] = (("Country", "MentalHealthHistory", False),
                                             ("Occupation", "SelfEmployed", True)),
    positive: str = "yes",
    materialize: bool = True,
) -> dict[str, DataFrame]:
    """Questions A-E from ONE scan of ``df``.

    Each row is exploded into one entry per grouping - one per factor ``(factor, value)``,
    ``(share_group, target)`` and ``(target)`` - and a single aggregate on the three-part
    key ``(set, k1, k2)`` counts rows and positive answers of every flag column, with a
    map-side partial aggregate before the only exchange. The aggregate holds one row per
    category per set; when ``materialize`` it is written as a small Parquet table in the
    shared scratch folder and every answer is then derived from it.

    Returns ``{"A", "A_rates", "B", "C", "D", "E"}`` with the same columns and values as
    ``top_category``, ``rate_by_factor``, ``share_within``, ``share_global`` and
    ``rate_by_group`` (D and E by ``rates``)."""
    present = _present(df, factors)
    sets: list[tuple[str, str, str | None]] = [(f, f, None) for f in present]
    sets += [("__within", share_group, target), ("__global", target, None)]
    for key, _, _ in rates:
        if key not in present:
            sets.append((key, key, None))
    flags: list[str] = []
    for fl in [target, *[r[1] for r in rates]]:
        if fl not in flags:
            flags.append(fl)

    def entry(name, k1, k2):
        return F.struct(
            F.lit(name).alias("_set"),
            F.col(k1).cast("string").alias("_k1"),
            (F.col(k2).cast("string") if k2 else F.lit(None).cast("string")).alias("_k2"),
        )

    flag_cols = []
    for i, fl in enumerate(flags):
        flag_cols += [flag(fl, positive).alias(f"_f{i}"), F.col(fl).isNotNull().cast("int").alias(f"_p{i}")]
    long = df.select(*flag_cols, F.explode(F.array(*[entry(*s) for s in sets])).alias("_e")).select(
        "_e._set", "_e._k1", "_e._k2", *[c for i in range(len(flags)) for c in (f"_f{i}", f"_p{i}")]
    )
    aggs = [F.count(F.lit(1)).alias("n")]
    for i in range(len(flags)):
        aggs += [F.sum(f"_f{i}").cast("bigint").alias(f"_yes{i}"), F.sum(f"_p{i}").cast("bigint").alias(f"_n{i}")]
    g = long.groupBy("_set", "_k1", "_k2").agg(*aggs)
    if materialize:
        # A written table in the shared scratch folder: one job, columnar, and it cuts the
        # lineage so the answers below never rescan the input.
        from strata.session import scratch_path

        spark = df.sparkSession
        path = scratch_path(spark, "answers")
        g.write.parquet(path)
        g = spark.read.parquet(path)
    t = flags.index(target)

    def rows_of(name):
        return g.filter(F.col("_set") == F.lit(name))

    a_rates = g.filter(F.col("_set").isin(present) & F.col("_k1").isNotNull()).select(
        F.col("_set").alias("factor"), F.col("_k1").alias("category"), F.col("n"),
        F.col(f"_yes{t}").alias("yes_count"),
    ).withColumn("prop", _ratio("yes_count", "n"))
    w = Window.partitionBy("factor").orderBy(F.desc("prop"), F.asc("category"))
    a_top = a_rates.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") == 1).select(
        "factor", "category", "prop")

    b = rows_of("__within").select(F.col("_k1").alias(share_group), F.col("_k2").alias(target),
                                   F.col("n").alias("count"))
    b = _with_share(b, share_group)
    c = rows_of("__global").select(F.col("_k1").alias(target), F.col("n").alias("count"))
    c = c.withColumn("prop", F.col("count").cast("double") / c.agg(F.sum("count")).scalar().cast("double"))

    out = {"A": a_top, "A_rates": a_rates, "B": b, "C": c}
    for name, (key, fl, drop_null_key) in zip(("D", "E"), rates):
        i = flags.index(fl)
        r = rows_of(key)
        if drop_null_key:
            r = r.filter(F.col("_k1").isNotNull())
        out[name] = r.filter(F.col(f"_n{i}") > 0).select(
            F.col("_k1").alias(key), F.col(f"_yes{i}").alias("yes_count"), F.col(f"_n{i}").alias("total_count")
        ).withColumn("prop", _ratio("yes_count", "total_count"))
    return out
