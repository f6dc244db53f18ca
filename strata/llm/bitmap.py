"""A bitmap of bounded size that tells which rows of a large table may be in a set of keys, so
that only those need be shuffled to meet it."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Bitmap:
    """Of the hashes of the rows of ``keys`` (distinct, stored), 16 bits a row and at most
    2**30: every key is found; of the other rows, few are as long as the bound isn't reached."""

    def __init__(self, keys: DataFrame):
        self.cols = keys.columns
        self.bits = 1 << int(np.clip(math.ceil(math.log2(max(1, keys.count()) * 16)), 16, 30))
        lit = keys.select(self._bit([F.col(c) for c in self.cols]).alias("bit")).distinct()
        lit = lit.groupBy(F.expr("bit div 8").alias("byte")).agg(F.sum(F.expr("shiftleft(1, cast(bit % 8 as int))")).alias("v"))
        table = np.zeros(self.bits // 8, np.uint8)
        for r in lit.toLocalIterator():
            table[r["byte"]] = r["v"]
        self.held = keys.sparkSession.sparkContext.broadcast(table)

    def _bit(self, cols: list[Column]) -> Column:
        return F.pmod(F.xxhash64(*cols), F.lit(self.bits))

    def split(self, df: DataFrame, may: bool) -> DataFrame:
        """The rows of ``df`` that may be among the keys, or those that surely are not."""
        held, names = self.held, df.columns

        def run(batches):
            for b in batches:
                at = b.column(len(names)).to_numpy(zero_copy_only=False).astype(np.int64)
                hit = ((held.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)
                yield b.select(names).filter(pa.array(hit if may else ~hit))

        bit = self._bit([F.col(c) for c in self.cols]).alias("__bit")
        return df.select(*names, bit).mapInArrow(run, df.schema)
