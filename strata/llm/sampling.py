"""A bounded, repeatable sample of labelled texts for fitting a classifier."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sample(df: DataFrame, class_col: str, per_class: int, key: str) -> pd.DataFrame:
    """At most ``per_class`` rows of each class of ``df``: those with the smallest hash of
    ``key``. Classes are counted first, so that only about as many rows as are wanted leave
    the scan; the exact cut is made among these."""
    h = F.xxhash64(F.lit(29), F.col(key))
    counts = df.groupBy(class_col).count().collect()  # a row for each class
    if not counts:
        return df.limit(0).toPandas()
    part = lambda n: min(1.0, 1.3 * per_class / n + 64 / n)
    share = F.coalesce(*[F.when(F.col(class_col).eqNullSafe(F.lit(r[class_col])), F.lit(part(r["count"]))) for r in counts])
    few = df.withColumn("__h", h).filter(F.shiftrightunsigned("__h", 11) < share * F.lit(float(1 << 53)))
    rank = F.row_number().over(Window.partitionBy(class_col).orderBy("__h", key))
    return few.withColumn("__r", rank).filter(F.col("__r") <= per_class).drop("__r", "__h").orderBy(key).toPandas()
