"""Language-model scores from a hierarchical Pitman-Yor model.

Every token is a customer of the restaurant of the word before it, known by its 64-bit hash; all
context restaurants share the root as their parent, whose base is uniform over the known words
and one unknown. In a sweep all customers of each dish, in the contexts and at the root, stand up
and are seated anew: the number of a dish's tables is drawn exactly, given what restaurants
share, so no seat is left over from the start. Predictive probabilities are averaged over samples.

Spark deals tokens by word, packed in arrays: a bucket holds all that is said about its words in
every context, so a dish's tables and the root's are local. What a context's dishes share (its
customers and tables) lies in shards of contexts: after a sweep each bucket sends a shard the
tables of the contexts that it has there, in an order fixed once, the shard adds them up, and the
sums go back the same way. Only a few sums over everything come to the driver. Each sweep's seats
are written to the shared folder, and sweeps are seeded, so a lost task makes the same seating
again.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fold, on_workers, shuffle_partitions, stored
from strata.llm.words import U, mix, pieces_of, span_hash, split_words

BUCKET_BYTES, HELD_TOKENS, HELD_DOCS = 10 << 20, 1_500_000, 30_000
EXACT, DRAWN = 512, 500_000  # customers of a dish by table, customers drawn for at a time
_END, _START, _HELD_OUT = U(0x0E0D), U(0x57A7), 0x8000
_FIELDS = ("words", "pairs", "ctx", "count", "posts", "part", "doc")
_TYPES = ("<u8", "<u4", "<u4", "<u4", "<u4", "<u4", "<u2")  # ctx: place among the bucket's contexts
_DEALT = ("<u8", "<u4", "<u8", "<u4", "<u2")  # words, pairs a word, contexts, tokens a pair, documents
_NOTE = "bucket long, kind int, shard int, body binary, stats array<double>"
_TOTAL, _CUSTOMERS, _SENT, _TABLES, _ROOT, _STATS = range(6)  # kinds of notes
_PERSON = np.dtype([("doc_id", "<i8"), ("no_id", "u1"), ("n", "<i8"), ("held_out", "u1")])


def _pack(a: np.ndarray) -> bytes:
    return len(a.tobytes()).to_bytes(8, "little") + pa.compress(a.tobytes(), "zstd", asbytes=True)


def _unpack(b: bytes, kind: str) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    return np.frombuffer(pa.decompress(b[8:], n, "zstd", asbytes=True) if n else b"", kind)


# ------------------------------------------------------------------ dealing tokens out
def _tokens(col: pa.Array):
    """(row, token, context) of the words of each text and its end."""
    w = split_words(col, lower=True)
    n, rows = int(w.counts.sum()), len(w.counts)
    ends = np.cumsum(w.counts + 1) - 1
    tok = np.empty(n + rows, U)
    is_end = np.zeros(n + rows, bool)
    is_end[ends] = True
    tok[is_end] = _END
    tok[~is_end] = span_hash(w.data, w.starts, w.ends)
    prev = np.empty_like(tok)
    prev[1:] = tok[:-1]
    prev[ends - w.counts] = _START
    return np.repeat(np.arange(rows), w.counts + 1), tok, mix(prev), w.counts


def _deal(docs: DataFrame, buckets: int) -> DataFrame:
    """Packed tokens by bucket of the word; the documents of part p are in bucket -1 - p."""

    def run(batches):
        pid, turn = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        people: list[tuple] = []
        n_tok = 0

        def flush():
            tok, ctx, doc = (np.concatenate([h[i] for h in held]) for i in range(3))
            order = np.lexsort((doc, ctx, tok, tok % U(buckets)))
            tok, ctx, doc = tok[order], ctx[order], doc[order]
            b = (tok % U(buckets)).astype(np.int64)
            cuts = np.flatnonzero(np.append(True, b[1:] != b[:-1]))
            part = (pid << 24) + turn
            ids, blobs = [-1 - part], [np.array(people, _PERSON).tobytes()]
            for lo, hi in zip(cuts, np.append(cuts[1:], len(b)), strict=True):
                t, c = tok[lo:hi], ctx[lo:hi]
                word = np.append(True, t[1:] != t[:-1])
                first = np.flatnonzero(word | np.append(True, c[1:] != c[:-1]))
                pairs = np.diff(np.append(np.flatnonzero(word[first]), len(first)))
                made = (t[word], pairs, c[first], np.diff(np.append(first, hi - lo)), doc[lo:hi])
                parts = [_pack(x.astype(k)) for x, k in zip(made, _DEALT, strict=True)]
                blobs.append(b"".join(len(p).to_bytes(8, "little") + p for p in parts))
                ids.append(int(b[lo]))
            held.clear()
            people.clear()
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([part] * len(ids), pa.int64()), pa.array(blobs, pa.binary())], ["bucket", "part", "tokens"])

        for whole in batches:
            for b in pieces_of(whole, "text", 2 << 20):
                for k in range(0, b.num_rows, 8192):
                    s = b.slice(k, 8192)
                    row, tok, ctx, counts = _tokens(s.column(2))
                    out = s.column(1).to_pylist()
                    mark = np.array(out, bool) * _HELD_OUT
                    held.append((tok, ctx, (len(people) + row + mark[row]).astype("<u2")))
                    people.extend((i or 0, i is None, k, o) for i, k, o in zip(s.column(0).to_pylist(), (counts + 1).tolist(), out, strict=True))
                    n_tok += len(tok)
                    if n_tok > HELD_TOKENS or len(people) > HELD_DOCS - 8192:
                        yield flush()
                        n_tok, turn = 0, turn + 1
        if people:
            yield flush()

    return docs.mapInArrow(run, "bucket long, part long, tokens binary")


def _gather(table: pa.Table, shards: int) -> pa.Table:
    """All parts of a bucket as one row of arrays: words, pairs a word, and for each pair of
    word and context its training count and its postings (part, document). ``keys`` are the
    bucket's contexts in order of shard, ``cuts`` how many are in each shard."""
    names = ["bucket", "parts", *_FIELDS, "keys", "cuts", "people"]
    if table.column("bucket")[0].as_py() < 0:
        none = [pa.nulls(1, pa.binary()) for _ in (*_FIELDS, "keys", "cuts")]
        ids = pa.array([table.column("part").to_pylist()], pa.list_(pa.int64()))
        return pa.table([table.column("bucket"), ids, *none, table.column("tokens")], names)
    w, c, d, p = [], [], [], []
    parts = sorted(zip(table.column("part").to_pylist(), table.column("tokens").to_pylist(), strict=True))
    for k, (_, blob) in enumerate(parts):
        got, at = [], 0
        for kind in _DEALT:
            n = int.from_bytes(blob[at : at + 8], "little")
            got.append(_unpack(blob[at + 8 : at + 8 + n], kind))
            at += 8 + n
        w.append(np.repeat(np.repeat(got[0], got[1]), got[3]))
        c.append(np.repeat(got[2], got[3]))
        d.append(got[4])
        p.append(np.full(len(got[4]), k, "<u4"))
    w = np.concatenate(w)
    c = np.concatenate(c)
    p = np.concatenate(p)
    order = np.lexsort((p, c, w))
    w = w[order]
    c = c[order]
    p = p[order]
    d = np.concatenate(d)[order]
    del order, got
    new_word = np.append(True, w[1:] != w[:-1])
    new_pair = new_word | np.append(True, c[1:] != c[:-1])
    first = np.flatnonzero(new_pair)
    train = np.add.reduceat((d & _HELD_OUT) == 0, first)
    pairs = np.add.reduceat(new_pair.astype(np.int64), np.flatnonzero(new_word))
    keys, ctx = np.unique(c[first], return_inverse=True)
    shard = (keys % U(shards)).astype(np.int64)
    by_shard = np.argsort(shard, kind="stable")
    place = np.empty(len(keys), np.int64)
    place[by_shard] = np.arange(len(keys))
    made = (w[new_word], pairs, place[ctx], train, np.diff(np.append(first, len(w))), p, d, keys[by_shard], np.bincount(shard, minlength=shards))
    row = [pa.array([_pack(x.astype(t))], pa.binary()) for x, t in zip(made, (*_TYPES, "<u8", "<u4"), strict=True)]
    ids = pa.array([[k for k, _ in parts]], pa.list_(pa.int64()))
    return pa.table([pa.array([table.column("bucket")[0].as_py()], pa.int64()), ids, *row, pa.nulls(1, pa.binary())], names)


# ------------------------------------------------------------------ seating
@dataclass
class Shared:
    """What all buckets share before a sweep; of contexts, what concerns one bucket."""

    customers: np.ndarray  # of each context restaurant
    tables: np.ndarray
    known: int  # distinct training words
    tokens: int  # training tokens
    root_customers: float
    root_tables: float
    discount: float
    root_discount: float
    strength: float = 1.0


def _first_tables(c: np.ndarray, discount: float) -> np.ndarray:
    """About as many tables as a dish of c customers has."""
    return np.clip(np.rint(np.power(np.maximum(c, 1), discount)), np.minimum(c, 1), c).astype(np.int64)


@lru_cache(4)
def _log_stirling(discount: float) -> np.ndarray:
    """Logs of the generalised Stirling numbers of up to ``EXACT`` customers at t tables."""
    out = np.full((EXACT + 1, EXACT + 1), -np.inf)
    out[1, 1] = 0.0
    for c in range(1, EXACT):
        t = np.arange(1, c + 1)
        stay = np.log(c - discount * t) + out[c, 1 : c + 1]
        out[c + 1, 1 : c + 1] = np.logaddexp(out[c, :c], stay)
        out[c + 1, c + 1] = 0.0
    return out


def _root_of(f, low: np.ndarray, steps: int = 60) -> np.ndarray:
    """Where the falling ``f`` of log u passes 0 between ``low`` and 0 (an end if it doesn't)."""
    high = np.zeros_like(low)
    for _ in range(steps):
        mid = (low + high) / 2
        up = f(mid) > 0
        low, high = np.where(up, mid, low), np.where(up, high, mid)
    return (low + high) / 2


def _log_tables(c: int, t: np.ndarray, discount: float) -> np.ndarray:
    """Log of the generalised Stirling number of c customers at t tables, times t! discount**t / c!:
    the coefficient of z**c in (1 - (1 - z)**discount)**t, by Cauchy's integral over a parabola
    u = 1 - z through the saddle point (or 1 / c if that lies closer to the branch at 0)."""
    d, t = discount, t.astype(float)

    def slope(x):
        return np.log(t * d / (c + 1)) + (d - 1) * x - np.log(-np.expm1(d * x)) + np.log(-np.expm1(x))

    with np.errstate(divide="ignore", invalid="ignore"):
        m = np.exp(_root_of(slope, np.full(len(t), -math.log(c + 1.0)), 30))  # any path near the saddle will do
    m = np.minimum(m, 1 - 1e-9)
    pole = 1 - m**d
    first = (c + 1) / (1 - m) - t * d * m ** (d - 1) / pole
    second = (c + 1) / (1 - m) ** 2 + t * (d * (1 - d) * m ** (d - 2) / pole - (d * m ** (d - 1) / pole) ** 2)
    wide = 1 / np.sqrt(2 * np.maximum(first * m + 2 * second * m * m, 1e-300))
    top = t * np.log(pole) - (c + 1) * np.log1p(-m)
    h, total = 0.2 if c < 20_000 else 0.1, np.zeros(len(t))  # the branch comes nearer as c grows
    for k in range(int(12 / h) + 1):
        a = 1 + 1j * wide * (k * h)
        u = m * a * a
        f = a * np.exp(t * np.log(1 - np.exp(d * np.log(u))) - (c + 1) * np.log(1 - u) - top)
        total += (0.5 if k == 0 else 1.0) * f.real
        if np.abs(f).max() < 1e-18:  # it only falls along the path
            break
    out = top + np.log(np.maximum(total * 2 * h * wide * m / np.pi, 1e-300))
    return np.where(t == c, c * math.log(d), out)


def _mean_tables(c: np.ndarray, w: np.ndarray, d: float) -> np.ndarray:
    """About the mean number of tables of large dishes."""
    x = _root_of(lambda x: np.log(w / c) + np.log(-np.expm1(x)) + (d - 1) * x, np.full(len(c), -700.0))
    return -w * np.expm1(d * x) / d


def _draw_many(c: int, w: float, mean: float, discount: float, u: float) -> int:
    """Tables of a dish of more than ``EXACT`` customers; the numbers that are left out lie
    twelve deviations off."""
    d = discount
    far = 12 * math.sqrt(mean) + 40
    t = np.arange(max(1, int(mean - far)), min(c, int(mean + far)) + 1)
    p = t * math.log(w / d) - np.cumsum(np.log(t)) + _log_tables(c, t, d)
    upto = np.cumsum(np.exp(p - p.max()))
    return int(t[min(np.searchsorted(upto, u * upto[-1], "right"), len(t) - 1)])


def table_counts(c: np.ndarray, new_weight: np.ndarray, discount: float, rng) -> np.ndarray:
    """Numbers of tables of dishes of c customers (one at least) who are all seated anew, where
    a new table has the weight ``new_weight`` and a table of n the weight n - discount: t has the
    odds ``new_weight``**t times the generalised Stirling number of (c, t)."""
    out, u, logs = np.ones(len(c), np.int64), rng.random(len(c)), _log_stirling(discount)
    large = np.flatnonzero(c > EXACT)
    for i, mean in zip(large.tolist(), _mean_tables(c[large], new_weight[large], discount).tolist(), strict=True):
        out[i] = _draw_many(int(c[i]), float(new_weight[i]), mean, discount, float(u[i]))
    few = np.flatnonzero((c > 1) & (c <= EXACT))
    upto = np.cumsum(c[few])
    for part in np.split(few, np.unique(np.searchsorted(upto, np.arange(DRAWN, upto[-1], DRAWN)))) if len(few) else []:
        if not len(part):
            continue
        n = c[part]
        first = np.cumsum(n) - n
        dish = np.repeat(np.arange(len(n)), n)
        t = np.arange(len(dish)) - first[dish] + 1
        p = logs[n[dish], t] + t * np.log(new_weight[part])[dish]
        p = np.cumsum(np.exp(p - np.maximum.reduceat(p, first)[dish]))
        below = np.concatenate([[0.0], p])[first]
        at = np.searchsorted(p, below + u[part] * (p[first + n - 1] - below), "right")
        out[part] = np.clip(at - first, 0, n - 1) + 1
    return out


class Seating:
    """A bucket's dishes: pairs of word and context, and the words at the root. ``alone`` counts, for
    each word, pairs with one customer that the row leaves out: their tables never change."""

    def __init__(self, row: dict):
        self.words, pairs, self.ctx, count, self.posts, self.part, self.doc = (_unpack(row[f], t) for f, t in zip(_FIELDS, _TYPES, strict=True))
        self.ctx, self.count, self.bucket = self.ctx.astype(np.int64), count.astype(np.int64), row["bucket"]
        self.word = np.repeat(np.arange(len(self.words)), pairs)
        self.train = np.bincount(self.word, self.count, len(self.words))
        self.tables = np.minimum(self.count, 1)
        self.many = np.flatnonzero(self.count > 1)
        self.root_tables = None
        self.alone = _unpack(row["alone"], "<u4") if row.get("alone") else 0

    def root(self) -> np.ndarray:
        """Customers of each word at the root: the tables of its pairs."""
        return np.bincount(self.word, self.tables, len(self.words)).astype(np.int64) + self.alone

    def root_prob(self, s: Shared, tables: np.ndarray) -> np.ndarray:
        held = np.maximum(self.root() - s.root_discount * tables, 0)
        new = (s.strength + s.root_discount * s.root_tables) / (s.known + 1)
        return (held + new) / (s.strength + s.root_customers)

    def sweep(self, s: Shared, turn: int) -> None:
        """All customers of the pairs are seated anew, then all of the root's words."""
        rng = np.random.default_rng([turn, self.bucket])
        c = self.count[self.many]
        if self.root_tables is None:
            self.tables[self.many] = _first_tables(c, s.discount)
            self.root_tables = _first_tables(self.root(), s.root_discount)
        p = self.root_prob(s, self.root_tables)
        new = (s.strength + s.discount * s.tables[self.ctx[self.many]]) * p[self.word[self.many]]
        self.tables[self.many] = table_counts(c, new, s.discount, rng)
        r = self.root()
        some = np.flatnonzero(r > 0)
        weight = np.full(len(some), (s.strength + s.root_discount * s.root_tables) / (s.known + 1))
        self.root_tables = np.zeros(len(r), np.int64)
        self.root_tables[some] = table_counts(r[some], weight, s.root_discount, rng)

    def predict(self, s: Shared) -> np.ndarray:
        """Probability of each pair's word in its context."""
        p = self.root_prob(s, self.root_tables)[self.word]
        own = np.maximum(self.count - s.discount * self.tables, 0)
        return (own + (s.strength + s.discount * s.tables[self.ctx]) * p) / (s.strength + s.customers[self.ctx])


# ------------------------------------------------------------------ what contexts share
def _notes(rows: list[tuple]) -> pa.Table:
    """Rows of (bucket, kind, shard, body, stats)."""
    types = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.float64()))
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
    return pa.table([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], ["bucket", "kind", "shard", "body", "stats"])


def _segments(cuts: bytes):
    """(shard, from, to) of a bucket's contexts, by shard that has some."""
    ends = np.cumsum(_unpack(cuts, "<u4").astype(np.int64))
    return [(k, lo, hi) for k, (lo, hi) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)) if hi > lo]


def _begin(rows: DataFrame) -> DataFrame:
    """What each bucket tells the shards of its contexts (keys, customers, pairs), and its sums."""

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                seat, keys = Seating(row), _unpack(row["keys"], "<u8")
                cust, tabs = (np.bincount(seat.ctx, x, len(keys)).astype("<u8") for x in (seat.count, seat.tables))
                r = seat.root()
                stats = [(seat.train > 0).sum(), seat.train.sum(), r.sum(), np.minimum(r, 1).sum(), (seat.count == 1).sum(), (seat.count == 2).sum(), (r == 1).sum(), (r == 2).sum()]
                made = [(row["bucket"], k, _pack(keys[lo:hi]), _pack(cust[lo:hi]), _pack(tabs[lo:hi]), None) for k, lo, hi in _segments(row["cuts"])]
                made.append((row["bucket"], -1, None, None, None, [float(x) for x in stats]))
                types = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.float64()))
                cols = [pa.array(list(c), t) for c, t in zip(zip(*made, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(cols, ["bucket", "shard", "keys", "customers", "tables", "stats"])

    none = F.lit(_pack(np.zeros(0)))
    needed = rows.select("bucket", *_FIELDS[:4], *[none.alias(f) for f in _FIELDS[4:]], "keys", "cuts")
    return needed.mapInArrow(run, "bucket long, shard int, keys binary, customers binary, tables binary, stats array<double>")


def _meet(table: pa.Table) -> pa.Table:
    """A shard: who sends what, as places among its contexts, and the sums of a context."""
    told = sorted(table.to_pylist(), key=lambda r: r["bucket"])
    keys = [_unpack(r["keys"], "<u8") for r in told]
    known, at = np.unique(np.concatenate(keys), return_inverse=True)
    sums = [_pack(np.bincount(at, np.concatenate([_unpack(r[c], "<u8") for r in told]), len(known)).astype("<u8")) for c in ("customers", "tables")]
    row = ([told[0]["shard"]], [[r["bucket"] for r in told]], [[len(k) for k in keys]], [_pack(at.astype("<u4"))], [sums[0]], [sums[1]])
    types = (pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary())
    return pa.table([pa.array(x, t) for x, t in zip(row, types, strict=True)], ["shard", "buckets", "sizes", "at", "customers", "tables"])


def _give(row: dict, kind: int, sums: np.ndarray) -> list[tuple]:
    """A shard's sums for each of its buckets, in the order in which that bucket has its contexts."""
    at, out, lo = _unpack(row["at"], "<u4"), [], 0
    for bucket, n in zip(row["buckets"], row["sizes"], strict=True):
        out.append((bucket, kind, row["shard"], _pack(sums[at[lo : lo + n]].astype("<u8")), None))
        lo += n
    return out


def _first_notes(shards: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                made = [n for kind, c in ((_TOTAL, "tables"), (_CUSTOMERS, "customers")) for n in _give(row, kind, _unpack(row[c], "<u8"))]
                yield from _notes(made).to_batches()

    return shards.mapInArrow(run, _NOTE)


def _totals(sent: DataFrame, shards: DataFrame) -> DataFrame:
    """Tables of each context after a sweep, for all buckets that have it: a pair has one table,
    and the more that its bucket has sent."""

    def add(key, told, own):
        row = own.to_pylist()[0]
        more = {r["bucket"]: _unpack(r["body"], "<u4") for r in told.to_pylist()}
        at, tables = _unpack(row["at"], "<u4"), _unpack(row["tables"], "<u8").astype(np.int64)
        sent = np.concatenate([more[b] if b in more else np.zeros(n, "<u4") for b, n in zip(row["buckets"], row["sizes"], strict=True)])
        return _notes(_give(row, _TOTAL, tables + np.bincount(at, sent, len(tables)).astype(np.int64)))

    return sent.filter(F.col("kind") == _SENT).groupBy("shard").cogroup(shards.groupBy("shard")).applyInArrow(add, _NOTE)


def _by_kind(notes: pa.Table) -> dict[int, list[bytes]]:
    """Bodies by kind, in order of shard."""
    out: dict[int, list[bytes]] = {}
    for r in sorted(notes.to_pylist(), key=lambda r: (r["kind"], r["shard"])):
        out.setdefault(r["kind"], []).append(r["body"])
    return out


def _joined(bodies: list[bytes]) -> np.ndarray:
    return np.concatenate([_unpack(x, "<u8") for x in bodies]).astype(np.float64)


def _moving(rows: DataFrame) -> DataFrame:
    """Rows of the pairs that a sweep can change, those of several customers."""

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                seat = Seating(row)
                many, n = seat.many, len(seat.words)
                alone = np.bincount(seat.word[seat.count == 1], minlength=n)
                made = (np.zeros(n), np.bincount(seat.word[many], minlength=n), seat.ctx[many], seat.count[many], [], [], [])
                body = [_pack(np.asarray(x).astype(t)) for x, t in zip(made, _TYPES, strict=True)]
                cols = [pa.array([row["bucket"]], pa.int64()), *(pa.array([x], pa.binary()) for x in (*body, _pack(alone.astype("<u4")), row["cuts"]))]
                yield pa.RecordBatch.from_arrays(cols, ["bucket", *_FIELDS, "alone", "cuts"])

    none = F.lit(_pack(np.zeros(0)))
    needed = rows.select("bucket", *_FIELDS[:4], *[none.alias(f) for f in _FIELDS[4:]], "cuts")
    return needed.mapInArrow(run, "bucket long, " + ", ".join(f"{f} binary" for f in (*_FIELDS, "alone", "cuts")))


def _sweep(rows: DataFrame, notes: DataFrame, before: Shared, turn: int) -> DataFrame:
    """Notes of a sweep over every bucket: tables for the shards, the bucket's seats, its sums."""

    def run(key, own, told):
        row, got = own.to_pylist()[0], _by_kind(told)
        seat, bucket = Seating(row), row["bucket"]
        s = replace(before, tables=_joined(got[_TOTAL]))
        if turn:
            seat.tables, seat.root_tables = (_unpack(got[k][0], "<u4").astype(np.int64) for k in (_TABLES, _ROOT))
        seat.sweep(s, turn)
        more = np.bincount(seat.ctx, seat.tables - 1, len(s.tables)).astype("<u4")
        out = [(bucket, _SENT, k, _pack(more[lo:hi]), None) for k, lo, hi in _segments(row["cuts"]) if more[lo:hi].any()]
        out += [(bucket, k, -1, _pack(x.astype("<u4")), None) for k, x in ((_TABLES, seat.tables), (_ROOT, seat.root_tables))]
        return _notes([*out, (bucket, _STATS, -1, None, [float(seat.root().sum()), float(seat.root_tables.sum())])])

    return _moving(rows).groupBy("bucket").cogroup(notes.groupBy("bucket")).applyInArrow(run, _NOTE)


def _sums(notes: DataFrame, n: int) -> list[float]:
    got = notes.filter("stats is not null").agg(*[F.sum(F.col("stats")[i]) for i in range(n)]).first()
    return [x or 0.0 for x in got]


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", out_fold: int = 1, sweeps: int = 3, burn_in: int = 1) -> DataFrame:
    """A row for each row of ``df``: fold, tokens, known tokens, training tokens, the score
    of the smoothed unigram base and of the model, both log10 of the text's probability, and
    the model's perplexity per token.

    Learns from rows whose fold of five is not ``out_fold``. Null and empty texts have one token,
    their end. A null id is returned as null; repeated rows are each learned from and scored; other
    columns are ignored; an empty table gives no rows.
    """
    spark = df.sparkSession
    on_workers(spark)
    docs = df.select(df[id_col].cast("long").alias("doc_id"), (fold(df[id_col]) == out_fold).alias("held_out"), df[text_col].alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(shuffle_partitions(spark), math.ceil(total / BUCKET_BYTES))
    shape = "bucket long, parts array<long>, " + ", ".join(f"{f} binary" for f in (*_FIELDS, "keys", "cuts"))
    gathered = _deal(docs, buckets).groupBy("bucket").applyInArrow(lambda t: _gather(t, buckets), f"{shape}, people binary")
    gathered = stored(gathered, "lm-buckets")
    rows = gathered.filter("people is null").drop("people")
    told = stored(_begin(rows), "lm-contexts-told")
    known, tokens, rc, rt, n1, n2, r1, r2 = _sums(told, 8)
    # discounts from the numbers of dishes seen once and twice
    d, rd = (min(0.95, max(0.05, a / (a + 2 * b))) if a else 0.5 for a, b in ((n1, n2), (r1, r2)))
    none = np.zeros(0)
    states = [Shared(none, none, int(known), int(tokens), rc, rt, d, rd)]  # before a sweep, and after the last
    shards = stored(told.filter("shard >= 0").groupBy("shard").applyInArrow(_meet, "shard int, buckets array<long>, sizes array<long>, at binary, customers binary, tables binary"), "lm-contexts")
    first = stored(_first_notes(shards), "lm-notes")
    notes, samples = first.filter(F.col("kind") == _TOTAL), first.filter(F.col("kind") == _CUSTOMERS)
    for turn in range(sweeps):
        seats = stored(_sweep(rows, notes, states[-1], turn), "lm-seats")
        rc, rt = _sums(seats, 2)
        states.append(replace(states[0], root_customers=rc, root_tables=rt))
        notes = stored(_totals(seats, shards), "lm-notes").unionAll(seats.filter(F.col("kind").isin(_TABLES, _ROOT)))
        if turn >= burn_in:
            samples = samples.unionAll(notes.withColumn("kind", F.col("kind") + 10 * (turn + 1)))
    shared = states

    def predict(key, own, told):
        row, got = own.to_pylist()[0], _by_kind(told)
        seat, p, out = Seating(row), 0.0, []
        cust = _joined(got[_CUSTOMERS])
        for turn in range(burn_in, sweeps):  # seats and sums of one sweep: probabilities add up to 1
            kind = 10 * (turn + 1)
            seat.tables[seat.many], seat.root_tables = (_unpack(got[kind + k][0], "<u4").astype(np.int64) for k in (_TABLES, _ROOT))
            p = p + seat.predict(replace(shared[turn + 1], customers=cust, tables=_joined(got[kind + _TOTAL])))
        p = np.log10(p / (sweeps - burn_in))
        base, known = np.log10(seat.train + 0.5), (seat.train > 0).astype(float)  # of words
        pair = np.repeat(np.arange(len(p), dtype="<u4"), seat.posts)
        parts = len(row["parts"])
        by_part = np.argsort(seat.part.astype("<u2") if parts <= 1 << 16 else seat.part, kind="stable")
        ends = np.cumsum(np.bincount(seat.part, minlength=parts)).tolist()
        for part, lo, hi in zip(row["parts"], [0, *ends], ends, strict=False):
            doc, of = seat.doc[by_part[lo:hi]] & (_HELD_OUT - 1), pair[by_part[lo:hi]]
            word = seat.word[of]
            who = np.flatnonzero(np.bincount(doc))
            sums = [np.bincount(doc, x)[who] for x in (p[of], base[word], known[word])]
            out.append([part, *map(_pack, (who.astype("<u2"), *sums[:2], sums[2].astype("<u4")))])
        types = (pa.int64(), *[pa.binary()] * 4)
        return pa.table([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["part", "at", "score", "base", "known"])

    needed = rows.drop("keys", "cuts")
    partial = needed.groupBy("bucket").cogroup(samples.groupBy("bucket")).applyInArrow(predict, "part long, at binary, score binary, base binary, known binary")
    people = gathered.filter("people is not null").select(F.col("parts")[0].alias("part"), "people")
    s = states[0]
    base_norm = math.log10(s.tokens + 0.5 * (s.known + 1))
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"

    def add(who, table):
        ids, no_id, n, outs = (np.frombuffer(who.column("people")[0].as_py(), _PERSON)[c] for c in _PERSON.names)
        score_, base, known = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids), np.int64)
        for a, x, y, z in zip(*(table.column(c).to_pylist() for c in ("at", "score", "base", "known")), strict=True):
            a = _unpack(a, "<u2")
            score_[a] += _unpack(x, "<f8")
            base[a] += _unpack(y, "<f8")
            known[a] += _unpack(z, "<u4")
        cols = [pa.array(ids, mask=no_id.astype(bool)), pa.array(outs.astype(bool)), pa.array(n), pa.array(known), pa.array(np.full(len(n), s.tokens)), pa.array(base - n * base_norm), pa.array(score_), pa.array(10 ** (-score_ / n))]
        return pa.table(cols, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    return people.groupBy("part").cogroup(partial.groupBy("part")).applyInArrow(add, out)
