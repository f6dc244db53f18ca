"""Jaccard join on word shingles by a size-aware split into light and heavy sets.

Light sets are joined by enumerating their subsets of the sizes that a partner must share;
heavy sets by scanning inverted lists of their rarest shingles: a partner shares one of the
first n - ceil(t n) + 1 in any common order. The boundary between the two is the size up to
which enumeration costs less than scanning. The order is by frequency in a count sketch of all
shingles, so that widely shared passages come last and make no long lists.

Equal sets are one node, named by its content; an id only says which texts are compared, so
one id may stand on several. Neighbours in a list are verified exactly first; then only pairs of
nodes that the links found so far leave apart, so that groups of near copies are never
expanded into all pairs, and no link between components is lost. Of those, a pair goes on only
if its parity signatures allow a link: they differ in at most as many bits as the sets do in
shingles, so no link is lost there either.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.bitmap import Bitmap
from strata.llm.common import on_workers, stored
from strata.llm.components import components
from strata.llm.words import U, mix, pieces_of, run_hash, run_starts, span_hash, split_words

_CHUNKS = 64
#: Longs of 64 bits in a parity signature.
SIGNATURE = 8
_SIGNED = [f"s{i}" for i in range(SIGNATURE)]


def shingles(col: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every shingle of a text column: ``width`` words, or all of fewer."""
    w = split_words(col, lower=True)
    h = span_hash(w.data, w.starts, w.ends)
    at = run_starts(w.counts, width)
    rows, hashes = [w.row[at]], [run_hash(h, width)[at]]
    for k in range(1, width):
        some = np.flatnonzero(w.counts == k)
        if len(some):
            out = np.full(len(some), k, U)
            for i in range(k):
                out = mix(out * U(0x9E3779B97F4A7C15) + h[w.first[some] + i])
            rows.append(some)
            hashes.append(out)
    return np.concatenate(rows), np.concatenate(hashes)


def _needed(n: int, percent: int) -> int:
    """The least overlap of a set of n with any partner."""
    return -(-percent * n // 100)


def subset_sizes(n: int, boundary: int, percent: int) -> list[int]:
    """Sizes of subsets by which a light set of n meets its light partners: the least overlap
    with each larger size there is."""
    return sorted({_needed(m, percent) for m in range(n, min(boundary, n * 100 // percent) + 1)})


def cost_boundary(mean_list: float, percent: int) -> int:
    """The largest size up to which enumerating subsets costs no more keys than scanning the
    lists of the prefix costs entries, at this mean length of a list."""
    n = 0
    while True:
        m = n + 1
        keys = sum(math.comb(m, c) for c in subset_sizes(m, m * 2, percent))
        if keys > (m - _needed(m, percent) + 1) * (1 + mean_list):
            return n
        n = m


def count_sketch(docs: DataFrame, width: int, slots: int) -> np.ndarray:
    """Counts of shingles by slot of their hash, over all texts; its size is fixed."""
    part = slots // _CHUNKS

    def count(batches):
        total = np.zeros(slots, np.uint32)
        for whole in batches:
            for b in pieces_of(whole, "text"):
                _, h = shingles(b.column(0), width)
                np.add.at(total, (mix(h) % U(slots)).astype(np.int64), np.uint32(1))
        packed = [pa.compress(total[i * part : (i + 1) * part].tobytes(), "zstd", asbytes=True) for i in range(_CHUNKS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(_CHUNKS), pa.int32()), pa.array(packed, pa.binary())], ["chunk", "counts"])

    def add(table):
        total = np.zeros(part, np.uint64)
        for x in table.column("counts"):
            total += np.frombuffer(pa.decompress(x.as_py(), 4 * part, "zstd", asbytes=True), np.uint32)
        total = np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes()
        return pa.table([pa.array([table.column("chunk")[0].as_py()], pa.int32()), pa.array([total], pa.binary())], ["chunk", "counts"])

    rows = docs.select("text").mapInArrow(count, "chunk int, counts binary").groupBy("chunk").applyInArrow(add, "chunk int, counts binary").collect()
    out = np.zeros(slots, np.uint32)
    for r in rows:
        out[r["chunk"] * part : (r["chunk"] + 1) * part] = np.frombuffer(r["counts"], np.uint32)
    return out


def _sets(col: pa.Array, width: int, sketch: np.ndarray | None):
    """Distinct shingles by row, rarest first: (row, hash), sorted."""
    row, h = shingles(col, width)
    rare = sketch[(mix(h) % U(len(sketch))).astype(np.int64)] if sketch is not None else np.zeros(len(h), np.uint32)
    order = np.lexsort((h, rare, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[new], h[new]


def signatures(row: np.ndarray, h: np.ndarray, rows: int) -> list[np.ndarray]:
    """Parity signature of each row's set: a bit tells whether an odd number of its shingles
    hash to it. Returned as ``SIGNATURE`` columns of longs."""
    bits = 64 * SIGNATURE
    odd = np.bincount(row * bits + (mix(h ^ U(0x51)) % U(bits)).astype(np.int64), minlength=rows * bits) & 1
    packed = np.packbits(odd.astype(np.uint8).reshape(rows, bits), axis=1, bitorder="little")
    return list(np.ascontiguousarray(packed).view("<i8").T)


def fingerprints(h: np.ndarray, first: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Two sums of mixed hashes for each set: 128 bits that tell sets apart."""
    f = []
    for seed in (11, 23):
        s = np.concatenate([np.zeros(1, U), np.cumsum(mix(h + U(seed)), dtype=U)])
        f.append((s[first + n] - s[first]).view(np.int64))
    return f


def _may_link(n: Column, m: Column, differing: Column, percent: int) -> Column:
    """Sets of n and m that differ in at least ``differing`` shingles can still be similar."""
    return differing * (100 + percent) <= (n + m) * (100 - percent)


def _nodes(docs: DataFrame, width: int, percent: int, sketch: np.ndarray, boundary: int) -> DataFrame:
    """(doc, t, n, f1, f2, keys, s0...): id, hash of the text, set size, 128-bit fingerprint of the set, the keys under
    which it meets its partners, and its parity signature."""
    held = docs.sparkSession.sparkContext.broadcast(sketch)

    def run(batches):
        for whole in batches:
            for b in pieces_of(whole, "text"):
                rows = b.num_rows
                row, h = _sets(b.column(2), width, held.value)
                n = np.bincount(row, minlength=rows)
                first = np.cumsum(n) - n
                f = fingerprints(h, first, n)
                scan_from = boundary * percent // 100  # light sets with a heavy partner scan too
                prefix = np.where((n > boundary) | (n * 100 // percent > boundary), n - -(-percent * n // 100) + 1, 0)
                prefix = np.where(n > scan_from, prefix, 0) * (n > 0)
                rank = np.arange(len(h)) - first[row]
                heavy = rank < prefix[row]
                keys = np.split(mix(h[heavy] ^ U(0xA1)).view(np.int64), np.cumsum(np.bincount(row[heavy], minlength=rows))[:-1])
                for r in np.flatnonzero((n > 0) & (n <= boundary)).tolist():
                    own = np.sort(h[first[r] : first[r] + n[r]])
                    more = []
                    for c in subset_sizes(int(n[r]), boundary, percent):
                        for pick in combinations(range(int(n[r])), c):
                            more.append(int(np.bitwise_xor.reduce(mix(own[list(pick)] + U(c)))))
                    keys[r] = np.concatenate([keys[r], mix(np.array(more, U) ^ U(0xB2)).view(np.int64)])
                cols = [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(f[0]), pa.array(f[1]), pa.array(keys, pa.list_(pa.int64()))]
                cols += [pa.array(x) for x in signatures(row, h, rows)]
                yield pa.RecordBatch.from_arrays(cols, ["doc", "t", "n", "f1", "f2", "keys", *_SIGNED])

    signed = ", ".join(f"{c} long" for c in _SIGNED)
    return docs.select("doc", "t", "text").mapInArrow(run, f"doc long, t long, n long, f1 long, f2 long, keys array<long>, {signed}")


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets, made again from the texts, are similar enough. Only
    documents that stand for a node in question are shuffled: the others fail a bitmap of
    bounded size."""
    pairs = stored(pairs, "join-pairs")
    nodes = pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")).distinct()
    nodes = stored(nodes.join(classes.select("node", "doc", "t"), "node"), "join-ids")
    ids = stored(nodes.select("doc", "t").distinct(), "join-docs")

    def sets(batches):
        for whole in batches:
            for b in pieces_of(whole, "text"):
                row, h = _sets(b.column(1), width, None)
                parts = np.split(h, np.cumsum(np.bincount(row, minlength=b.num_rows))[:-1])
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([p.tobytes() for p in parts], pa.binary())], ["node", "hashes"])

    may = Bitmap(ids).split(docs.select("doc", "t", "text"), True).join(nodes, ["doc", "t"]).dropDuplicates(["doc", "t"])
    made = stored(may.select("node", "text").mapInArrow(sets, "node long, hashes binary"), "join-sets")
    both = pairs.join(made.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a")
    both = both.join(made.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b").select("a", "b", "x", "y")

    def check(batches):
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                both = len(x) + len(y) - len(np.union1d(x, y))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return both.mapInArrow(check, "a long, b long")


def _found(docs: DataFrame, width: int, percent: int, sketch_slots: int | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For documents (doc, t, text), t a hash of the text: rows (doc, t, n, node), where node is
    null for an empty set or a null id; classes (node, doc, t), the smallest document of each
    node; and links (a, b) that connect whatever hangs together."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slots = sketch_slots or 1 << int(np.clip(math.ceil(math.log2(total / 256 + 1)), 16, 26))
    sketch = count_sketch(docs, width, slots)
    boundary = cost_boundary(float(sketch.sum()) / max(1, np.count_nonzero(sketch)), percent)
    rows = stored(_nodes(docs, width, percent, np.minimum(sketch, 0xFFFF).astype(np.uint16), boundary), "join-nodes")
    some = rows.filter("n > 0 and doc is not null")
    same = some.groupBy("f1", "f2", "n").agg(F.min(F.struct("doc", "t")).alias("least"), F.first("keys").alias("keys"), *[F.first(c).alias(c) for c in _SIGNED])
    classes = stored(same.select("f1", "f2", "n", "least.doc", "least.t", "keys", *_SIGNED, F.monotonically_increasing_id().alias("node")), "join-classes")
    fits = lambda n, m: F.least(n, m) * 100 >= F.greatest(n, m) * percent
    order = Window.partitionBy("key").orderBy("n", "node")
    lists = classes.select("node", "n", F.explode("keys").alias("key")).distinct()
    mixed_up = Window.partitionBy("key").orderBy(F.xxhash64("key", "node"), "node")
    lists = lists.withColumn("next", F.lead(F.struct("node", "n")).over(order)).withColumn("prev", F.lag("node").over(order))
    lists = lists.filter("next is not null or prev is not null")
    lists = stored(lists.withColumn("other", F.lead(F.struct("node", "n")).over(mixed_up)), "join-lists")
    pair = lambda a, b: [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]
    # neighbours by size, and in an order of each list's own: in a group of near copies that
    # is a random graph, which links nearly all that can be linked
    near = lists.select("node", "n", F.explode(F.array("next", "other")).alias("to"))
    near = near.filter(F.col("to").isNotNull() & fits(F.col("n"), F.col("to.n")))
    near = near.select(*pair(F.col("node"), F.col("to.node"))).filter("a <> b").distinct()
    links = stored(_verified(docs, classes, near, width, percent), "join-links")
    # what is still apart after the first links
    comp = components(links)
    at = lists.join(comp, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("c"))
    mixed = at.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("key")
    at = at.join(mixed, "key").join(classes.select("node", *_SIGNED), "node")
    at = stored(at, "join-apart")
    x, y = at.select("key", F.col("node").alias("p"), F.col("n").alias("pn"), F.col("c").alias("pc"), *[F.col(c).alias(f"p{c}") for c in _SIGNED]), at
    differing = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"p{c}"))) for c in _SIGNED), F.lit(0))
    can = (F.col("pc") < F.col("c")) & fits(F.col("pn"), F.col("n")) & _may_link(F.col("pn"), F.col("n"), differing, percent)
    more = x.join(y, "key").filter(can)
    more = more.select(*pair(F.col("p"), F.col("node"))).distinct().join(near, ["a", "b"], "left_anti")
    more = stored(_verified(docs, classes, more, width, percent), "join-more")
    known = classes.select("f1", "f2", "n", "node")
    rows = rows.select("doc", "t", "n", "f1", "f2")
    rows = rows.filter("n > 0 and doc is not null").join(known, ["f1", "f2", "n"]).select("doc", "t", "n", "node").unionAll(
        rows.filter("n = 0 or doc is null").select("doc", "t", "n", F.lit(None).cast("long")))
    return stored(rows, "join-rows"), classes.select("node", "doc", "t"), links.unionAll(more)


def _documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(df[id_col].cast("long").alias("doc"), F.xxhash64(df[text_col]).alias("t"), df[text_col].alias("text"))


def join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85, sketch_slots: int | None = None) -> DataFrame:
    """A row for each row of ``df``: the size of its shingle set and its component (the
    smallest id reachable by links of at least ``percent`` hundredths of Jaccard similarity).

    Null texts and texts without words have an empty set and link with nothing. A row with a
    null id gets its size and a null component, and links nothing. Rows that share an id are
    one document for links if their sets are equal; else each links by its own set and all get the
    component of the id's rows together. Other columns are ignored; an empty table gives no rows.
    """
    on_workers(df.sparkSession)
    rows, classes, links = _found(_documents(df, id_col, text_col), width, percent, sketch_slots)
    # the sets of one id hang together too
    own = rows.filter("node is not null").select("doc", "node").distinct()
    several = own.groupBy("doc").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a < z").select("doc", "a")
    edges = links.unionAll(own.join(several, "doc").select("a", F.col("node").alias("b")).filter("a <> b"))
    least = classes.join(components(edges), "node", "left").withColumn("c", F.coalesce("component", "node"))
    least = least.join(least.groupBy("c").agg(F.min("doc").alias("component_id")), "c").select("node", "component_id")
    out = rows.join(least, "node", "left")
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc").alias("component_id"))


def superseded(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """(doc, t, copies): the texts, by id and xxhash64 of the text, of whose group another one
    stays, and those that stay but stand on several rows (``copies`` of them, else 0). Of each
    group of linked texts the one with the smallest id stays (of several, the one with the
    least t). An id on unlike texts is as many documents; empty sets and null ids stay."""
    on_workers(df.sparkSession)
    rows, classes, links = _found(_documents(df, id_col, text_col), width, percent, None)
    comp = components(links).withColumnRenamed("component", "c")
    some = rows.filter("node is not null").groupBy("doc", "t", "node").agg(F.count("*").alias("copies"))
    some = some.join(comp, "node", "left").withColumn("c", F.coalesce("c", "node"))
    first = some.groupBy("c").agg(F.min(F.struct("doc", "t")).alias("first"))
    some = some.join(first, "c").withColumn("stays", F.struct("doc", "t") == F.col("first"))
    return some.filter("not stays or copies > 1").select("doc", "t", F.when(F.col("stays"), F.col("copies")).otherwise(0).alias("copies"))


#: The same rows in DuckDB, each pair of documents with a common shingle counted.
ORACLE = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[ 	-
]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS s FROM w),
e AS MATERIALIZED (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS k FROM g),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS shared
          FROM e a JOIN e b ON a.k = b.k AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM pairs WHERE 100 * shared >= 85 * (n + m - shared)),
reach(x, y) AS (SELECT a, b FROM links UNION SELECT b, a FROM links UNION SELECT r.x, l.y FROM reach r JOIN
                (SELECT a AS x, b AS y FROM links UNION ALL SELECT b, a FROM links) l ON r.y = l.x)
SELECT g.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(g.doc_id, coalesce(min(y), g.doc_id)) AS component_id
FROM g LEFT JOIN reach ON x = g.doc_id GROUP BY g.doc_id, s
"""
