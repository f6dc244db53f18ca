"""Merkle manifest of a table of documents, by slot pivots.

Every row is a leaf; the leaves of a group (a language) form a tree of ``fanout`` children a
node, and the roots of the groups form a tree of the same kind over them. A level is a pivot:
conditional aggregates spread the children of a parent into ``fanout`` columns. All columns
together hash to the parent, all but a row's own slot are its siblings.

A shuffle serves ``span`` levels: rows are dealt by blocks of fanout ** span leaves, a parent
never leaves its block, and only the top of each block goes on to the next round. So no task
holds more of one group than a block at a time, whatever the group's share of the rows.

Rows: a null in any column is hashed as ``-``; a null language is a group of its own, first in
order; a null doc_id comes first in its group and is never tampered with; rows with the same
doc_id are ordered by their leaf, so equal rows get neighbouring places; empty and very long
texts are hashed whole; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import shuffle_partitions, stored

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("", *parts), 256)


def field(c: Column) -> Column:
    """A value as it enters a leaf: its length in bytes, a colon, the value; ``-`` for null."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(**other: Column) -> Column:
    """Digest of a row of documents; ``other`` replaces columns by name."""
    return digest(*[field(other.get(c, F.col(c))) for c in FIELDS])


def ranked(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``df`` with ``__pos``, the place of a row in its group from 0, ``__n``, the rows of the
    group, and ``__start``, how many rows stand in the groups before it.

    The rows are sorted by ranges over all partitions and numbered there; the counts of each
    group in each partition, a few rows a partition, are added up to the offsets."""
    spark = df.sparkSession
    keys = [*group, *order]
    run = df.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys)
    run = stored(run.withColumn("__row", F.monotonically_increasing_id()), "ranked")
    run = run.withColumn("__part", F.shiftrightunsigned("__row", 33))
    runs = run.groupBy("__part", *group).agg(F.min("__row").alias("__first"), F.count("*").alias("__rows"))
    every = Window.partitionBy(*group)
    add = lambda w: F.coalesce(F.sum("__rows").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(
        "__part", "__first", *[F.col(c).alias(f"__g_{c}") for c in group],
        add(every.orderBy("__part")).alias("__before"), F.sum("__rows").over(every).alias("__n"),
        add(Window.orderBy("__first")).alias("__global"),
    ).withColumn("__start", F.col("__global") - F.col("__before"))
    same = run["__part"] == runs["__part"]
    for c in group:
        same &= run[c].eqNullSafe(runs[f"__g_{c}"])
    pos = F.col("__row") - F.col("__first") + F.col("__before")
    return run.join(runs, same).select(*df.columns, pos.alias("__pos"), "__n", "__start")


def climb(nodes: DataFrame, fanout: int = 2, span: int = 8) -> DataFrame:
    """``nodes`` (``__start``, ``__pos``, ``__n``, ``__digest``, others) with ``__root``, the
    root of their group, and ``__path``: for each level up to it what stands left and right of
    the node's own ancestor among its siblings."""
    block = fanout**span
    pos, start = F.col("__pos"), F.col("__start")
    x = nodes.withColumn("__block", start + pos - pos % block).withColumn("__root", F.col("__digest"))
    x = x.withColumn("__path", F.array().cast("array<struct<l:string,r:string>>")).repartition("__block")
    for level in range(span):
        width = fanout**level
        slot = F.floor(pos / width) % fanout
        parent = start + pos - pos % (width * fanout)
        among = Window.partitionBy("__block", "__parent")
        x = x.withColumn("__parent", parent).withColumn("__slot", slot)
        x = x.withColumns({f"__c{j}": F.max(F.when(F.col("__slot") == j, F.col("__root"))).over(among) for j in range(fanout)})
        row = [F.col(f"__c{j}") for j in range(fanout)]
        left = F.concat_ws("", *[F.when(F.col("__slot") > j, c) for j, c in enumerate(row)])
        right = F.concat_ws("", *[F.when(F.col("__slot") < j, c) for j, c in enumerate(row)])
        more = F.col("__n") > width  # several nodes remain on this level
        step = F.array(F.struct(left.alias("l"), right.alias("r")))
        x = x.withColumn("__path", F.when(more, F.concat("__path", step)).otherwise(F.col("__path")))
        x = x.withColumn("__root", F.when(more, digest(*row)).otherwise(F.col("__root")))
        x = x.drop("__parent", "__slot", *[f"__c{j}" for j in range(fanout)])
    most = nodes.agg(F.max("__n")).first()[0] or 0
    if most <= block:
        return x.drop("__block")
    x = stored(x, "blocks")
    tops = x.filter(pos % block == 0).select(
        "__start", F.floor(pos / block).alias("__pos"), F.ceil(F.col("__n") / block).alias("__n"), F.col("__root").alias("__digest"))
    up = climb(stored(tops, "tops"), fanout, span)
    up = up.select((start + pos * block).alias("__block"), F.col("__root").alias("__up"), F.col("__path").alias("__more"))
    x = x.join(up, "__block").withColumn("__path", F.concat("__path", "__more")).withColumn("__root", F.col("__up"))
    return x.drop("__block", "__up", "__more")


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, leaf, lambda d, e: digest(e["l"], d, e["r"]))


def manifest(docs: DataFrame, fanout: int = 2) -> DataFrame:
    """One row a document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``folded_root`` starts from the leaf as tampered with: where 7 divides the crc32 of the
    doc_id, n_chars is one more (a null stays)."""
    bent = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    nodes = docs.select("doc_id", "lang", leaf().alias("leaf"), F.when(bent, leaf(n_chars=F.col("n_chars") + 1)).alias("__seen"))
    nodes = stored(nodes, "digests")  # the texts are read once; all that follows moves digests
    nodes = ranked(nodes, ["lang"], ["doc_id", "leaf"]).withColumn("__digest", F.col("leaf"))
    x = stored(climb(nodes, fanout).withColumnRenamed("__root", "subroot"), "leaves")
    groups = x.filter("__pos = 0").select("lang", F.col("__start").alias("__group"), F.col("subroot").alias("__digest"))
    top = climb(ranked(groups, [], ["lang"]), fanout)
    top = top.select(F.col("__group").alias("__start"), F.col("__root").alias("root"), F.col("__path").alias("__more"))
    x = x.join(top, "__start").withColumn("__path", F.concat("__path", "__more"))
    proof = digest(F.transform("__path", lambda e: F.concat(e["l"], e["r"])))
    x = x.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), fold(F.coalesce("__seen", "leaf"), F.col("__path")).alias("folded_root"))
    return x.withColumn("verified", F.col("folded_root") == F.col("root"))


#: crc32 of an ASCII text in DuckDB, which has no function for it.
CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda x: ord(x)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)))"""

_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || {0}, '-')"
_LEAF = "sha256(concat({}))".format(", ".join(_FIELD.format(c) for c in FIELDS))

#: The same rows: each level is a list of digests, halved until one is left.
ORACLE = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
    SELECT doc_id, lang, leaf, seen, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
    FROM (SELECT *, {_LEAF} AS leaf, CASE WHEN n_chars IS NOT NULL AND {CRC32.format("doc_id::VARCHAR")} % 7 = 0
                THEN {_LEAF.replace("n_chars", "(n_chars + 1)")} ELSE {_LEAF} END AS seen FROM documents)),
levels(lang, lvl, l) AS (
    SELECT lang, 0, list(leaf ORDER BY pos) FROM leaves GROUP BY lang
    UNION ALL
    SELECT lang, lvl + 1, list_transform(range((len(l) + 1) // 2), lambda i: sha256(concat(l[2 * i + 1], l[2 * i + 2])))
    FROM levels WHERE len(l) > 1),
subroots AS (SELECT lang, l[1] AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos FROM levels WHERE len(l) = 1),
tops(lvl, l) AS (
    SELECT 0, list(subroot ORDER BY pos) FROM subroots
    UNION ALL
    SELECT lvl + 1, list_transform(range((len(l) + 1) // 2), lambda i: sha256(concat(l[2 * i + 1], l[2 * i + 2]))) FROM tops WHERE len(l) > 1),
steps AS (
    SELECT d.doc_id, d.leaf, d.seen, s.subroot, v.lvl AS k, (d.pos >> v.lvl) & 1 AS side, v.l[xor(d.pos >> v.lvl, 1) + 1] AS sib
    FROM leaves d JOIN subroots s ON d.lang IS NOT DISTINCT FROM s.lang
    JOIN levels v ON d.lang IS NOT DISTINCT FROM v.lang AND len(v.l) > 1
    UNION ALL
    SELECT d.doc_id, d.leaf, d.seen, s.subroot, 1000 + t.lvl, (s.pos >> t.lvl) & 1, t.l[xor(s.pos >> t.lvl, 1) + 1]
    FROM leaves d JOIN subroots s ON d.lang IS NOT DISTINCT FROM s.lang JOIN tops t ON len(t.l) > 1),
paths AS MATERIALIZED (
    SELECT d.doc_id, d.leaf, d.seen, s.subroot, coalesce(list(struct_pack(side := p.side, sib := coalesce(p.sib, '')) ORDER BY p.k) FILTER (p.k IS NOT NULL), []) AS path
    FROM leaves d JOIN subroots s ON d.lang IS NOT DISTINCT FROM s.lang
    LEFT JOIN steps p ON p.doc_id IS NOT DISTINCT FROM d.doc_id AND p.leaf = d.leaf GROUP BY ALL),
folds(doc_id, leaf, k, x, path) AS (
    SELECT doc_id, leaf, 0, seen, path FROM paths
    UNION ALL
    SELECT doc_id, leaf, k + 1, sha256(CASE WHEN path[k + 1].side = 1 THEN concat(path[k + 1].sib, x) ELSE concat(x, path[k + 1].sib) END), path
    FROM folds WHERE k < len(path))
SELECT p.doc_id, p.leaf, p.subroot, t.l[1] AS root,
       sha256(array_to_string(list_transform(p.path, lambda e: e.sib), '')) AS proof_sha256,
       f.x AS folded_root, f.x = t.l[1] AS verified
FROM paths p JOIN folds f ON f.doc_id IS NOT DISTINCT FROM p.doc_id AND f.leaf = p.leaf AND f.k = len(p.path)
JOIN tops t ON len(t.l) = 1
"""
