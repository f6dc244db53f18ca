"""Prefix trie of conversations, by union-find over the sorted neighbours' common prefixes.

A conversation is one key: a block of fixed width a turn (a digest of role and text, and the
text's code points), so the order of keys puts common prefixes side by side. The keys are
sorted by ranges over all partitions; equal keys are ordered by conversation, so a group of
copies spreads over as many partitions as it fills.

Inside a task the edges between sorted neighbours, each as deep as their common prefix, are
taken in descending depth: a union of two components is a branching node at that depth. Nodes
that a key of another task could share are prefixes of the task's first or last key; all others
are whole and leave as rows. What hangs below the open ones is contracted to counts at the
node it hangs from, and these few items of 64 neighbouring tasks at a time are merged by the
same step until one forest is left. The conversations that end at an open node are never
gathered: their numbers leave as packed runs, which are hashed in order as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import on_workers, shuffle_partitions, stored
from strata.llm.merkle import CRC32

DIGEST, CHARS = 16, 8
WIDTH = DIGEST + CHARS
FAN = 64
RUN = 8192
EMPTY = hashlib.sha256(b"").hexdigest()
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
#: node: a row of the result, but for ``parent`` (the open node whose conv_id is its parent's)
#: and ``ends`` (the key whose runs give its hash); ``ref`` names a node that was open.
#: item: an open node of a task, with what is contracted into it. run: conversations that end
#: at an open node. first, last: the task's first and last key.
PARTS = (
    "kind string, pid int, key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, parent string, ends string, ref string, n_ends long, run string"
)
_NAMES = [c.split()[0] for c in PARTS.split(", ")]
_TYPES = {"string": pa.string(), "int": pa.int32(), "binary": pa.binary(), "long": pa.int64()}
_SCHEMA = pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in PARTS.split(", ")])


# ------------------------------------------------------------------ one forest
@dataclass(slots=True)
class Node:
    """A node of a forest with what hangs below it, all but the nodes of the same forest."""

    key: bytes
    n_ends: int = 0
    n_convs: int = 0  # n_ends and those of contracted subtrees
    conv_id: int | None = None  # the smallest of them
    n_children: int = 0
    n_leaves: int = 0
    saved: int = 0
    ends: str | None = None  # hash of the ends where it is known
    open_ends: bool = False  # the runs of the key give it
    was_open: bool = False
    kids: list[Node] = field(default_factory=list)

    @property
    def depth(self) -> int:
        return len(self.key) // WIDTH

    def add(self, item: dict) -> None:
        """Another forest's part of this node."""
        self.n_ends += item["n_ends"]
        self.n_convs += item["n_convs"]
        self.n_children += item["n_children"]
        self.n_leaves += item["n_leaves"]
        self.saved += item["saved_tokens"]
        self.conv_id = least(self.conv_id, item["conv_id"])
        self.open_ends = self.n_ends > 0


def least(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def name(key: bytes) -> str:
    return hashlib.sha256(key).hexdigest()


def common(a: bytes, b: bytes) -> int:
    """Turns that two keys share at their beginning."""
    n = min(len(a), len(b)) // WIDTH * WIDTH
    if a[:n] == b[:n]:
        return n // WIDTH
    x = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(x.argmax()) // WIDTH


def forest(nodes: list[Node]) -> Node:
    """The root of the trie over ``nodes`` (distinct keys in ascending order)."""
    n = len(nodes)
    lcp = np.array([common(a.key, b.key) for a, b in zip(nodes, nodes[1:], strict=False)], np.int64)
    up, top = list(range(n)), list(nodes)

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for e in np.argsort(-lcp, kind="stable").tolist():
        d, a, b = int(lcp[e]), find(e), find(e + 1)
        if top[a].depth > d:  # else the left one is the branching node itself
            top[a] = Node(top[a].key[: d * WIDTH], kids=[top[a]])
        top[a].kids.append(top[b])  # deeper than d: a prefix sorts first, and edges of a depth go from left to right
        up[b] = a
    root = top[find(0)]
    return root if root.depth == 0 else Node(b"", kids=[root])


class Rows:
    """Columns of the parts that a task makes, handed out in batches."""

    def __init__(self, most: int = 10_000):
        self.rows, self.most = [], most

    def put(self, **row) -> None:
        self.rows.append(row)

    def batches(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        if self.rows and (last or len(self.rows) >= self.most):
            rows, self.rows = self.rows, []
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


def close(rows: Rows, node: Node, above: int) -> tuple[int, dict]:
    """Puts the rows of ``node`` and of the single-child nodes between it and depth ``above``,
    but for the topmost: the tokens saved from it down, and that row, without a parent yet."""
    saved, row = node.saved, {}
    for d in range(node.depth, above, -1):
        saved += (node.n_convs - 1) * int.from_bytes(node.key[d * WIDTH - CHARS : d * WIDTH], "big")
        row = {
            "kind": "node", "conv_id": node.conv_id, "depth": d, "n_convs": node.n_convs, "saved_tokens": saved,
            "n_leaves": node.n_leaves, "n_children": 1, "ends_sha256": EMPTY,
        } | (_low(node) if d == node.depth else {})
        if d > above + 1:
            rows.put(**row, parent_conv_id=node.conv_id)
    return saved, row


def _low(v: Node) -> dict:
    """What holds for a node itself, not for the single-child nodes above it."""
    return {
        "n_children": v.n_children, "ends_sha256": v.ends if v.n_ends else EMPTY,
        "ends": name(v.key) if v.open_ends else None, "ref": name(v.key) if v.was_open else None,
    }


def solve(nodes: list[Node], first: bytes, last: bytes, whole: bool, pid: int) -> Iterator[pa.RecordBatch]:
    """The rows of all nodes that no other forest shares, and the items of the others: the
    prefixes of the first and the last key, unless this forest is the ``whole`` one."""
    rows = Rows()
    root = forest(nodes)
    open_ = lambda k: not whole and (first.startswith(k) or last.startswith(k))
    order, stack = [], [root]
    while stack:
        v = stack.pop()
        order.append(v)
        stack += v.kids
    for v in reversed(order):  # children before their parent
        held, tops = open_(v.key), []
        for kid in v.kids:
            if not open_(kid.key):
                saved, row = close(rows, kid, v.depth)
                tops.append(row)
                v.n_convs += kid.n_convs
                v.conv_id = least(v.conv_id, kid.conv_id)
                v.n_leaves += kid.n_leaves
                v.saved += saved
                v.n_children += 1
        v.kids = []
        if not held and v.n_children == 0:
            v.n_leaves = 1
        for row in tops:  # an open parent's conv_id isn't known yet
            rows.put(**row, **({"parent": name(v.key)} if held else {"parent_conv_id": v.conv_id}))
        if held and (v.n_convs or v.n_children):
            rows.put(
                kind="item", pid=pid, key=v.key, conv_id=v.conv_id, n_convs=v.n_convs, n_children=v.n_children,
                n_leaves=v.n_leaves, saved_tokens=v.saved, n_ends=v.n_ends,
            )
        yield from rows.batches()
    if whole:
        rows.put(kind="node", conv_id=root.conv_id, depth=0, n_convs=root.n_convs, n_leaves=root.n_leaves, saved_tokens=root.saved, **_low(root))
    else:
        rows.put(kind="first", pid=pid, key=first)
        rows.put(kind="last", pid=pid, key=last)
    yield from rows.batches(last=True)


# ------------------------------------------------------------------ tasks
def _leaves(batches):
    """A partition of (pid, key, conv_id), sorted by key and conv_id."""
    keys, starts, ids, pid, at = [], [], [], 0, 0
    for batch in batches:
        for i, k in enumerate(batch.column(1).to_pylist()):
            if not keys or keys[-1] != k:
                keys.append(k)
                starts.append(at + i)
        if batch.num_rows:
            pid, at = batch.column(0)[0].as_py(), at + batch.num_rows
            ids.append(batch.column(2).to_numpy())
    if not keys:
        return
    convs, nodes, rows = np.concatenate(ids), [], Rows()
    for k, lo, hi in zip(keys, starts, [*starts[1:], len(convs)], strict=True):
        v = Node(k, n_ends=hi - lo, n_convs=hi - lo, conv_id=int(convs[lo]))
        h, shared = hashlib.sha256(), keys[0].startswith(k) or keys[-1].startswith(k)
        for j in range(lo, hi, RUN):
            run = ",".join(map(str, convs[j : min(hi, j + RUN)].tolist()))
            if shared:
                rows.put(kind="run", pid=pid, ref=name(k), n_ends=j, run=run)
                yield from rows.batches()
            else:
                h.update((("," if j > lo else "") + run).encode())
        v.ends = h.hexdigest()
        nodes.append(v)
    yield from rows.batches(last=True)
    yield from solve(nodes, keys[0], keys[-1], False, pid)


def _merge(whole: bool):
    """The items of neighbouring forests."""

    def run(key, data):
        x = data.to_pylist()
        first = min((r for r in x if r["kind"] == "first"), key=lambda r: r["pid"])["key"]
        last = max((r for r in x if r["kind"] == "last"), key=lambda r: r["pid"])["key"]
        nodes: dict[bytes, Node] = {}
        for r in x:
            if r["kind"] == "item":
                v = nodes.setdefault(r["key"], Node(r["key"], was_open=True))
                v.add(r)
        return pa.Table.from_batches(solve([nodes[k] for k in sorted(nodes)], first, last, whole, key[0].as_py()), _SCHEMA)

    return run


def _hash_runs(batches):
    """Hash of the conversations of each key, from its runs in order."""
    at, h = None, None
    for batch in batches:
        for ref, run in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if ref != at:
                if h:
                    yield pa.RecordBatch.from_pylist([{"ref": at, "sha": h.hexdigest()}])
                at, h = ref, hashlib.sha256(run.encode())
            else:
                h.update(b"," + run.encode())
    if h:
        yield pa.RecordBatch.from_pylist([{"ref": at, "sha": h.hexdigest()}])


# ------------------------------------------------------------------ the operator
def take(c: Column, most: int = 6) -> Column:
    return F.crc32(c.cast("string").cast("binary")) % most


def rebuilt(turns: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """(conv_id, key) of every conversation: the first h turns of the first conversation of
    its ``group``, then its own turns after its first h; h = crc32 of the conv_id modulo
    ``most``. Turns are ordered by turn (null first), then by role and text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    sha = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    block = F.concat(F.unhex(F.substring(sha, 1, 2 * DIGEST)), F.unhex(F.lpad(F.hex(F.length(text).cast("long")), 2 * CHARS, "0")))
    t = turns.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"), block.alias("block"))
    at = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    t = stored(t.withColumn("at", at).select("conv_id", "at", "block"), "turns")
    convs = t.groupBy("conv_id").agg(F.lit(None).alias("none")).select("conv_id", take(F.col("conv_id"), most).alias("h"))
    base = F.col("conv_id") - F.col("conv_id") % group
    heads = convs.filter("h > 0").select(base.alias("base"), F.col("conv_id").alias("of"), "h")
    lead = t.filter(F.col("at") < most).select(F.col("conv_id").alias("base"), "at", "block")
    heads = heads.join(lead, "base").filter("at <= h").select(F.col("of").alias("conv_id"), F.lit(0).alias("part"), "at", "block")
    tails = t.filter(F.col("at") > take(F.col("conv_id"), most)).select("conv_id", F.lit(1).alias("part"), "at", "block")
    none = convs.select("conv_id", F.lit(0).alias("part"), F.lit(0).alias("at"), F.expr("X''").alias("block"))
    x = none.unionAll(heads).unionAll(tails).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "at", "block"))).alias("turns"))
    return x.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda r: F.hex(r["block"])), "")).alias("key"))


def nodes(turns: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row for each distinct prefix of the rebuilt conversations; see the module.

    Null role or text counts as empty, a null turn comes first, rows without conv_id belong to
    no conversation, turns of the same number are ordered by role and text, a repeated row is
    a turn of its own, other columns are ignored; an empty table gives no rows. A task holds
    its share of the keys, ``WIDTH`` bytes a turn, never the texts."""
    spark = turns.sparkSession
    on_workers(spark)
    keys = stored(rebuilt(turns), "keys")
    dealt = keys.repartitionByRange(partitions or shuffle_partitions(spark), "key", "conv_id").sortWithinPartitions("key", "conv_id")
    parts = stored(dealt.select(F.spark_partition_id().alias("pid"), "key", "conv_id").mapInArrow(_leaves, PARTS), "trie")
    levels, n = [parts], 1 + (parts.agg(F.max("pid")).first()[0] or 0)
    while len(levels) == 1 or n > 1:
        n = -(-n // FAN)
        open_ = levels[-1].filter("kind in ('item', 'first', 'last')").withColumn("group", F.floor(F.col("pid") / FAN).cast("int"))
        levels.append(stored(open_.groupBy("group").applyInArrow(_merge(n == 1), PARTS), "trie"))
    found = reduce(DataFrame.unionAll, levels).filter("kind = 'node'")
    # open nodes are few; what waits for one gets its conv_id, and its hash from the runs
    runs = parts.filter("kind = 'run'").select("ref", "run", "pid", "n_ends").repartition("ref").sortWithinPartitions("ref", "pid", "n_ends")
    hashed = runs.select("ref", "run").mapInArrow(_hash_runs, "ref string, sha string").withColumnRenamed("ref", "ends")
    refs = stored(found.filter("ref is not null").select(F.col("ref").alias("parent"), F.col("conv_id").alias("above")), "open")
    done = found.filter("parent is null").withColumn("above", F.col("parent_conv_id"))
    wait = found.filter("parent is not null").join(refs, "parent")
    found = done.unionByName(wait).withColumn("parent_conv_id", F.col("above"))
    known = found.filter("ends is null")
    late = found.filter("ends is not null").join(stored(hashed, "ends"), "ends").withColumn("ends_sha256", F.col("sha"))
    return known.select(RESULT).unionAll(late.select(RESULT))


#: The same rows in DuckDB: prefixes as lists of turns.
ORACLE = f"""
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS txt,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id, {CRC32.format("conv_id::VARCHAR")} % 6 AS h FROM t),
r AS (
    SELECT c.conv_id, 0 AS part, t.pos, t.role, t.txt FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.pos <= c.h
    UNION ALL SELECT c.conv_id, 1, t.pos, t.role, t.txt FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
s AS (SELECT c.conv_id, coalesce(list(strlen(role) || ':' || role || sha256(txt) ORDER BY part, pos) FILTER (role IS NOT NULL), []) AS turns,
             coalesce(list(length(txt) ORDER BY part, pos) FILTER (role IS NOT NULL), []) AS chars
      FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
p AS (SELECT conv_id, d, sha256(array_to_string(turns[:d], ',')) AS node, CASE WHEN d > 0 THEN sha256(array_to_string(turns[:d - 1], ',')) END AS up,
             coalesce(chars[d], 0) AS n, d = len(turns) AS ends FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM s) u),
v AS (SELECT node, d AS depth, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n) AS n,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM p GROUP BY node, d),
k AS (SELECT up AS node, d, count(*) AS n_children FROM (SELECT up, depth - 1 AS d FROM v WHERE up IS NOT NULL) u GROUP BY up, d),
below AS (SELECT DISTINCT a.node, a.d, b.node AS low, b.d AS low_d FROM p a JOIN p b ON a.conv_id = b.conv_id AND a.d <= b.d),
sums AS (SELECT b.node, b.d, sum((v.n_convs - 1) * v.n) AS saved_tokens, count(*) FILTER (k.node IS NULL) AS n_leaves
         FROM below b JOIN v ON v.node = b.low AND v.depth = b.low_d LEFT JOIN k ON k.node = v.node AND k.d = v.depth GROUP BY b.node, b.d)
SELECT v.conv_id, v.depth, a.conv_id AS parent_conv_id, v.n_convs, coalesce(k.n_children, 0) AS n_children, sums.n_leaves,
       CAST(sums.saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM v LEFT JOIN v a ON a.node = v.up AND a.depth = v.depth - 1 LEFT JOIN k ON k.node = v.node AND k.d = v.depth
JOIN sums ON sums.node = v.node AND sums.d = v.depth
"""
