"""The RDD face of the serving questions, kept only so the three faces can be compared
(as the reference compares them). Python functions run per row in Python workers and no
optimizer sees them: this is the slow face by construction, never a library path.

Each answer still aggregates with map-side combining (``reduceByKey`` / ``aggregateByKey``),
and each result becomes a DataFrame with the DataFrame face's schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.schemas import FACTORS, TARGET
from strata.session import ship_package


def _is(v, positive: str = "yes") -> int:
    return 1 if v is not None and v.lower() == positive else 0


def _add2(a, b):
    return (a[0] + b[0], a[1] + b[1])


def top_category_rdd(spark: SparkSession, df: DataFrame, factors=FACTORS, target=TARGET) -> DataFrame:
    ship_package(spark)
    present = [f for f in factors if f in df.columns]
    rows = df.select(target, *present).rdd

    def pairs(r):
        hi = _is(r[target])
        for f in present:
            if r[f] is not None:
                yield ((f, r[f]), (hi, 1))

    rates = rows.flatMap(pairs).reduceByKey(_add2).map(
        lambda kv: (kv[0][0], (kv[0][1], kv[1][0] / kv[1][1]))
    )

    def better(a, b):  # highest rate, ties to the smaller category
        if a[1] != b[1]:
            return a if a[1] > b[1] else b
        return a if a[0] <= b[0] else b

    best = rates.reduceByKey(better).map(lambda kv: (kv[0], kv[1][0], kv[1][1]))
    schema = T.StructType([T.StructField("factor", T.StringType()), T.StructField("category", T.StringType()),
                           T.StructField("prop", T.DoubleType())])
    return spark.createDataFrame(best, schema)


def share_within_rdd(spark: SparkSession, df: DataFrame, group: str, value: str) -> DataFrame:
    ship_package(spark)
    counts = df.select(group, value).rdd.map(lambda r: ((r[0], r[1]), 1)).reduceByKey(lambda x, y: x + y)
    totals = counts.map(lambda kv: (kv[0][0], kv[1])).reduceByKey(lambda x, y: x + y)
    paired = counts.map(lambda kv: (kv[0][0], (kv[0][1], kv[1]))).join(totals)
    shares = paired.map(lambda kv: (kv[0], kv[1][0][0], kv[1][0][1], kv[1][0][1] / kv[1][1]))

    schema = T.StructType([T.StructField(group, T.StringType()), T.StructField(value, T.StringType()),
                           T.StructField("count", T.LongType(), False), T.StructField("prop", T.DoubleType())])
    return spark.createDataFrame(shares, schema)


def share_global_rdd(spark: SparkSession, df: DataFrame, value: str) -> DataFrame:
    ship_package(spark)
    counts = df.select(value).rdd.map(lambda r: (r[0], 1)).reduceByKey(lambda a, b: a + b)
    schema = T.StructType([T.StructField(value, T.StringType()), T.StructField("count", T.LongType(), False)])
    rows = spark.createDataFrame(counts, schema)  # the total is a subquery: no job while planning
    total = rows.agg(F.sum("count")).scalar()
    return rows.withColumn("prop", F.col("count").cast("double") / total.cast("double"))


def rate_by_group_rdd(spark: SparkSession, df: DataFrame, key: str, flag_col: str,
                      drop_null_key: bool = False) -> DataFrame:
    ship_package(spark)
    rows = df.select(key, flag_col).rdd.filter(lambda r: r[1] is not None)
    if drop_null_key:
        rows = rows.filter(lambda r: r[0] is not None)
    stats = rows.map(lambda r: (r[0], (_is(r[1]), 1))).reduceByKey(_add2)
    schema = T.StructType([T.StructField(key, T.StringType()), T.StructField("yes_count", T.LongType()),
                           T.StructField("total_count", T.LongType(), False), T.StructField("prop", T.DoubleType())])
    return spark.createDataFrame(stats.map(lambda kv: (kv[0], kv[1][0], kv[1][1], kv[1][0] / kv[1][1])), schema)
