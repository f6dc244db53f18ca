"""Near duplicates among embeddings by inverted lists with product quantisation.

Equal vectors are one point. Points are normalised and dealt to the list of their nearest
coarse centroid, with a residual coded in sub-spaces. A point probes every other list that can
hold a neighbour: one whose bisector with its own list is within the search radius, which loses
none. In a list, table look-up distances to the codes select candidates, with each code's own
error as slack, so that again none is lost; cosines in double precision decide. The
points of a list and those that probe it are both split into blocks; a pair of blocks returns
counts and a spanning forest, not pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import on_workers, stored
from strata.llm.components import Forest, components

PARTS, CODES, BLOCK = 8, 64, 2000


@dataclass
class Index:
    """Coarse centroids (k, d) and per sub-space codebooks (PARTS, CODES, d / PARTS)."""

    coarse: np.ndarray
    books: np.ndarray

    @property
    def dim(self) -> int:
        return self.coarse.shape[1]

    def lists(self, x: np.ndarray) -> np.ndarray:
        """Squared distances to all centroids."""
        return (x * x).sum(1)[:, None] - 2 * x @ self.coarse.T + (self.coarse**2).sum(1)[None]

    def encode(self, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of residuals, and the distance from each to what its code stands for."""
        codes, left = np.zeros((len(r), PARTS), np.uint8), np.zeros(len(r))
        for p, part in enumerate(np.split(r, PARTS, 1)):
            d = (part * part).sum(1)[:, None] - 2 * part @ self.books[p].T + (self.books[p] ** 2).sum(1)[None]
            codes[:, p] = d.argmin(1)
            left += np.maximum(d.min(1), 0)
        return codes, np.sqrt(left) + 1e-6


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, also of components whose squares a double can't hold."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _kmeans(x: np.ndarray, k: int, rounds: int, rng) -> np.ndarray:
    c = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        at = np.concatenate([((c**2).sum(1)[None] - 2 * part @ c.T).argmin(1) for part in np.array_split(x, -(-len(x) // 4096))])
        n = np.bincount(at, minlength=k)
        s = np.zeros_like(c)
        np.add.at(s, at, x)
        c[n > 0] = s[n > 0] / n[n > 0, None]
    return c


def fit(points: DataFrame, n: int, sample: int = 20_000, most: int = 200_000, seed: int = 3) -> Index | None:
    """Centroids, as many as the square root of the number of points, and codebooks; None if
    there is no dimension that is a multiple of ``PARTS``. They are trained on a sample of the
    most frequent dimension: ``sample`` points, or 8 a centroid, but ``most`` in all, which
    bounds the lists at 25,000 (over 600 million points they get longer)."""
    dims = points.groupBy("dim").count().filter(F.col("dim") % PARTS == 0).orderBy(F.desc("count"), "dim").first()
    if dims is None:
        return None
    k = max(1, int(np.sqrt(n)))
    some = points.filter(F.col("dim") == dims["dim"]).orderBy(F.xxhash64(F.lit(seed), "point")).limit(min(most, max(sample, 8 * k)))
    x = unit(np.array([r[0] for r in some.select("vector").collect()], np.float64))
    rng = np.random.default_rng(seed)
    coarse = _kmeans(x, min(k, max(1, len(x) // 8)), 12, rng)
    i = Index(coarse, np.zeros((PARTS, CODES, x.shape[1] // PARTS)))
    r = x - coarse[i.lists(x).argmin(1)]
    i.books = np.stack([_kmeans(part, CODES, 12, rng) for part in np.split(r, PARTS, 1)])
    return i


def dealt(points: DataFrame, index: Index | None, radius: float) -> DataFrame:
    """Points (point, label, dim, vector, n) dealt to the groups (label, dim, list, block, part)
    that find all pairs within ``radius``: an index block of a list and one block of queries.

    Part s < block asks with the points of block s of the list, part s = block has no queries and
    is searched in itself, and parts from the number of blocks on ask with the points of other
    lists that probe this one. So a group holds about ``BLOCK`` index rows and ``BLOCK`` queries.
    """
    spark = points.sparkSession
    held = spark.sparkContext.broadcast(index)
    shape = "point long, label string, dim int, n long, vector array<double>"

    def assign(batches):
        ix = held.value
        for b in batches:
            vectors = b.column(4).to_pylist()
            own, probes = np.zeros(len(vectors), np.int64), [[] for _ in vectors]
            ours = [i for i, v in enumerate(vectors) if ix is not None and len(v) == ix.dim]
            if ours:
                x = unit(np.array([vectors[i] for i in ours], np.float64))
                d = ix.lists(x)
                near = d.argmin(1)
                apart = np.sqrt(np.maximum(ix.lists(ix.coarse), 0))
                reach = d - d[np.arange(len(x)), near][:, None] <= 2 * radius * apart[near] + 1e-9
                reach &= np.arange(len(ix.coarse))[None] > near[:, None]  # each pair from one side
                for i, a, row in zip(ours, near.tolist(), reach, strict=True):
                    own[i], probes[i] = a, np.flatnonzero(row).tolist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own), pa.array(probes, pa.list_(pa.int64()))], [*b.schema.names, "list", "probes"])

    rows = points.select("point", F.col("label").cast("string").alias("label"), "dim", "n", F.col("vector").cast("array<double>").alias("vector"))
    rows = stored(rows.mapInArrow(assign, f"{shape}, list long, probes array<long>"), "pq-points")
    key = ["label", "dim", "list"]
    other = rows.withColumn("list", F.explode("probes"))
    asks = other.groupBy(key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("asks"))
    sizes = rows.groupBy(key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    sizes = sizes.join(asks, key, "left").withColumn("asks", F.coalesce("asks", F.lit(0)))
    sizes = stored(sizes, "pq-lists")
    own = rows.join(sizes, key).withColumn("block", F.pmod(F.xxhash64("point"), F.col("blocks")).cast("int"))
    keep = [*key, "block", "part", "query", "point", "n", "vector"]
    before = F.sequence(F.lit(0), F.col("block"))
    probing = F.when(F.col("asks") > 0, F.sequence(F.col("blocks"), F.col("blocks") + F.col("asks") - 1)).otherwise(F.array().cast("array<int>"))
    index_rows = own.withColumn("part", F.explode(F.concat(before, probing))).withColumn("query", F.lit(False)).select(keep)
    same = own.filter("block + 1 < blocks").withColumn("part", F.col("block"))
    same = same.withColumn("block", F.explode(F.sequence(F.col("block") + 1, F.col("blocks") - 1)))
    other = other.join(sizes, key).withColumn("part", (F.col("blocks") + F.pmod(F.xxhash64("point"), F.col("asks"))).cast("int"))
    other = other.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    ask = [*key, "block", "part", F.lit(True).alias("query"), "point", "n", "vector"]
    return index_rows.unionAll(same.select(ask)).unionAll(other.select(ask))


def links(points: DataFrame, index: Index | None, least: float) -> DataFrame:
    """(kind, a, b) over points (point, label, dim, vector, n): kind 0: point a links with b
    rows of other points; kind 1: an edge of a spanning forest of the links."""
    radius = float(np.sqrt(max(0.0, 2 - 2 * least))) + 1e-7
    held = points.sparkSession.sparkContext.broadcast(index)

    def search(table):
        ix = held.value
        ask = np.array(table.column("query").to_pylist(), bool)
        point, n = table.column("point").to_numpy(), table.column("n").to_numpy()
        x = unit(np.array(table.column("vector").to_pylist(), np.float64))
        at = np.flatnonzero(~ask)
        count, forest = np.zeros(len(point), np.int64), Forest(len(point))
        coded = ix is not None and x.shape[1] == ix.dim
        if coded:
            c = ix.coarse[table.column("list")[0].as_py()]
            codes, err = ix.encode(x[at] - c)
        alone = table.column("part")[0].as_py() == table.column("block")[0].as_py()
        asking = at if alone else np.flatnonzero(ask)
        for lo in range(0, len(asking), 256):
            q = asking[lo : lo + 256]
            if coded:  # distance to a code, from tables per sub-space
                far = np.zeros((len(q), len(at)))
                for p, part in enumerate(np.split(x[q] - c, PARTS, 1)):
                    tab = (part * part).sum(1)[:, None] - 2 * part @ ix.books[p].T + (ix.books[p] ** 2).sum(1)[None]
                    far += tab[:, codes[:, p]]
                may = np.sqrt(np.maximum(far, 0)) <= radius + err[None]
            else:
                may = np.ones((len(q), len(at)), bool)
            may &= ask[q][:, None] | (q[:, None] < at[None])  # in a block, each pair once
            i, j = np.nonzero(may)
            for k in range(0, len(i), 200_000):
                a, b = q[i[k : k + 200_000]], at[j[k : k + 200_000]]
                ok = np.einsum("ij,ij->i", x[a], x[b]) >= least
                a, b = a[ok], b[ok]
                np.add.at(count, a, n[b])
                np.add.at(count, b, n[a])
                forest.link(a, b)
        child, root = forest.edges()
        some = np.flatnonzero(count)
        kind = np.concatenate([np.zeros(len(some), np.int32), np.ones(len(child), np.int32)])
        return pa.table([pa.array(kind), pa.array(np.concatenate([point[some], point[child]])), pa.array(np.concatenate([count[some], point[root]]))], ["kind", "a", "b"])

    return dealt(points, index, radius).groupBy("label", "dim", "list", "block", "part").applyInArrow(search, "kind int, a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = 0.98) -> DataFrame:
    """A row for each row of ``df``: the number of rows it links with, its component (the
    smallest id reachable by links) and whether it is kept.

    Rows link when their labels are equal and not null, their vectors have one length, and
    their cosine is at least ``least``. Vectors that are null, empty, zero, or hold a null or
    non-finite component link with nothing, nor does a row with a null id; such a row is its
    own component (null for a null id, not kept). Rows with equal vectors and labels link with
    each other, also when they share an id. Other columns are ignored; an empty table gives no rows.
    """
    on_workers(df.sparkSession)
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = df.select(df[id_col].cast("long").alias("vec_id"), df[vector_col].cast("array<double>").alias("vector"), df[label_col].alias("label"))
    fit_in = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite & F.exists("vector", lambda v: v != 0), F.lit(False))
    good = rows.filter(fit_in)
    points = good.groupBy("label", "vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
    # Points of several labels or vectors may share an id: number them by content.
    points = points.select(F.xxhash64("label", "vector", "first").alias("point"), "label", F.size("vector").alias("dim"), "vector", "n", "first")
    points = stored(points, "pq-distinct")
    total = points.count()
    found = stored(links(points, fit(points, total) if total else None, least), "pq-links")
    count = found.filter("kind = 0").groupBy(F.col("a").alias("point")).agg(F.sum("b").alias("others"))
    comp = components(found.filter("kind = 1").select("a", "b")).select(F.col("node").alias("point"), "component")
    known = points.join(count, "point", "left").join(comp, "point", "left").withColumn("component", F.coalesce("component", "point"))
    least_id = known.groupBy("component").agg(F.min("first").alias("component_id"))
    known = known.join(least_id, "component")
    known = known.select("label", "vector", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    linked = good.join(known, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~fit_in).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.unionAll(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
