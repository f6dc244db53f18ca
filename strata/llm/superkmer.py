"""Removal of repeated passages by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words. Its minimiser is the least hash among its runs of
``GRAM`` words. Consecutive windows of a document that share a minimiser travel together as
one string, a super-k-mer, to the bucket of that minimiser; equal windows have equal minimisers,
so they meet there. In a bucket the windows are sorted by hash and document, and equal ones are
confirmed word by word. Strings that are equal within a task travel once, from the smallest
document; the others are known to be repeats at once.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.bitmap import Bitmap
from strata.llm.common import on_workers, shuffle_partitions, stored
from strata.llm.words import pieces_of, run_hash, run_starts, sliding_min, span_hash, split_bytes, split_words

WINDOW, GRAM = 13, 3
#: Bytes of strings that a bucket holds on average, that a task gathers (with their items)
#: before it sends, and that it puts into one message.
BUCKET_BYTES, HELD_BYTES, SENT_BYTES = 2 << 20, 48 << 20, 4 << 20
_ITEM = np.dtype([("doc", "<i8"), ("key", "<i8"), ("start", "<i4"), ("stop", "<i4"), ("size", "<i4")])
_HELD = np.dtype([*_ITEM.descr, ("bucket", "<i8"), ("at", "<i8"), ("d1", "<i8"), ("d2", "<i8")])
_RANGES = "doc long, key long, start int, stop int"


def super_kmers(w, window: int = WINDOW):
    """(row, first word, last word + 1, minimiser) of each super-k-mer; word numbers count
    over all rows of ``w``."""
    gram = min(GRAM, window)
    at = run_starts(w.counts, window)
    if len(at) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.uint64)
    least = sliding_min(run_hash(span_hash(w.data, w.starts, w.ends), gram), window - gram + 1)[at]
    row = w.row[at]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (least[1:] != least[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return row[first], at[first], at[last] + window, least[first]


def _words_of(data: bytes) -> bytes:
    return b" ".join(data.split())


def repeated(items: np.ndarray, strings: bytes, window: int = WINDOW):
    """Which words of a bucket's strings are covered by a window that a smaller document has
    too: (index of the item, first word, last word + 1), numbered within each string."""
    data = np.frombuffer(strings, np.uint8)
    w = split_bytes(data, np.concatenate([[0], np.cumsum(items["size"], dtype=np.int64)]))
    at = run_starts(w.counts, window)
    if len(at) == 0:
        return np.zeros((0, 3), np.int64)
    h = run_hash(span_hash(w.data, w.starts, w.ends), window)[at]
    item = w.row[at]
    doc = items["doc"][item]
    order = np.lexsort((doc, h))
    hs = h[order]
    new = np.ones(len(hs), bool)
    new[1:] = hs[1:] != hs[:-1]
    group = np.cumsum(new) - 1
    head = order[np.flatnonzero(new)][group]  # the smallest document's window
    later = doc[order] > doc[head]
    text = lambda i: _words_of(strings[w.starts[at[i]] : w.ends[at[i] + window - 1]])
    hit = np.zeros(len(at), bool)
    seen, told, clash = -1, b"", set()
    for i, g, k in zip(order[later].tolist(), group[later].tolist(), head[later].tolist(), strict=True):
        if g != seen:
            seen, told = g, text(k)
        if text(i) == told:
            hit[i] = True
        else:
            clash.add(g)
    for g in clash:  # two passages with one hash: told apart by their words
        least: dict[bytes, int] = {}
        members = order[group == g].tolist()
        for i in members:
            least[text(i)] = min(least.get(text(i), doc[i]), doc[i])
        for i in members:
            hit[i] = doc[i] > least[text(i)]
    found = np.flatnonzero(hit)
    if len(found) == 0:
        return np.zeros((0, 3), np.int64)
    new = np.ones(len(found), bool)
    new[1:] = (at[found[1:]] != at[found[:-1]] + 1) | (item[found[1:]] != item[found[:-1]])
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(found)) - 1
    base = w.first[item[found[a]]]
    return np.stack([item[found[a]], at[found[a]] - base, at[found[b]] - base + window], 1)


def ranges(df: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, key, start, stop): words of the texts of ``df`` (doc, key, text) that are
    covered by a window which a smaller document has too; ranges may overlap."""
    spark = df.sparkSession
    total = df.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(shuffle_partitions(spark), math.ceil(3 * total / BUCKET_BYTES))

    def send(batches):
        parts, held, n_held = [], bytearray(), 0  # items and their strings, one after another

        def flush():
            """Buckets in order, a few at a time, so that no second copy of the whole is made."""
            x = np.concatenate(parts)
            parts.clear()
            x = x[np.lexsort((x["at"], x["doc"], x["d2"], x["d1"]))]
            new = np.ones(len(x), bool)
            new[1:] = (x["d1"][1:] != x["d1"][:-1]) | (x["d2"][1:] != x["d2"][:-1])
            least = x["doc"][np.flatnonzero(new)][np.cumsum(new) - 1]
            x["size"][x["doc"] > least] = -1  # equal strings of later documents are repeats: told without the string
            x = x[np.argsort(x["bucket"], kind="stable")]
            lo = 0
            while lo < len(x):
                hi = int(np.searchsorted(np.cumsum(np.maximum(x["size"][lo:], 0) + _ITEM.itemsize), SENT_BYTES, "right")) + lo
                hi = max(hi, lo + 1)
                hi = int(np.searchsorted(x["bucket"], x["bucket"][hi - 1], "right"))
                ids, metas, sizes, packed = [], [], [], []
                for y in np.split(x[lo:hi], np.flatnonzero(np.diff(x["bucket"][lo:hi])) + 1):
                    text = b"".join([held[i : i + n] for i, n in zip(y["at"].tolist(), y["size"].tolist(), strict=True) if n > 0])
                    ids.append(int(y["bucket"][0]))
                    metas.append(y[list(_ITEM.names)].astype(_ITEM).tobytes())
                    sizes.append(len(text))
                    packed.append(pa.compress(text, "zstd", asbytes=True))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(metas, pa.binary()), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())], ["bucket", "items", "size", "strings"])
                lo = hi

        for whole in batches:
            for b in pieces_of(whole, "text"):
                w = split_words(b.column(2))
                row, lo, hi, least = super_kmers(w, window)
                base, raw, s, e = w.first[row], w.data.data, w.starts[lo], w.ends[hi - 1]
                x = np.zeros(len(row), _HELD)
                x["doc"], x["key"] = b.column(0).to_numpy()[row], b.column(1).to_numpy()[row]
                x["start"], x["stop"], x["size"], x["bucket"] = lo - base, hi - base, e - s, least % np.uint64(buckets)
                x["at"] = len(held) + np.cumsum(e - s) - (e - s)
                sha = b"".join([hashlib.blake2b(raw[i:j], digest_size=16).digest() for i, j in zip(s.tolist(), e.tolist(), strict=True)])
                x["d1"], x["d2"] = np.frombuffer(sha, "<i8").reshape(-1, 2).T
                held += b"".join([raw[i:j] for i, j in zip(s.tolist(), e.tolist(), strict=True)])
                parts.append(x)
                n_held += x.nbytes
                if len(held) + n_held > HELD_BYTES:
                    yield from flush()
                    held, n_held = bytearray(), 0
        if parts:
            yield from flush()

    def judge(table):
        items = np.concatenate([np.frombuffer(x, _ITEM) for x in table.column("items").to_pylist()])
        packed = zip(table.column("strings").to_pylist(), table.column("size").to_pylist(), strict=True)
        strings = b"".join(pa.decompress(s, n, "zstd", asbytes=True) for s, n in packed if n)
        done, items = items[items["size"] < 0], items[items["size"] >= 0]
        got = repeated(items, strings, window)
        of = items[got[:, 0]]
        cols = [np.concatenate(x) for x in ((done["doc"], of["doc"]), (done["key"], of["key"]), (done["start"], of["start"] + got[:, 1]), (done["stop"], of["start"] + got[:, 2]))]
        return pa.table([pa.array(c.astype(t)) for c, t in zip(cols, (np.int64, np.int64, np.int32, np.int32), strict=True)], ["doc", "key", "start", "stop"])

    sent = df.filter("doc is not null and text is not null").mapInArrow(send, "bucket int, items binary, size long, strings binary")
    return sent.groupBy("bucket").applyInArrow(judge, _RANGES)


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """A row for each row of ``df``: its number of words, how many were removed, and the
    SHA-256 of the words that are left, joined by single spaces (with ``with_text`` also
    that text as ``kept``).

    A word goes if a window that covers it also starts in a document with a smaller id;
    windows are judged on the input. Null text: no words. A row with a null id is kept whole
    and takes nothing from others. Rows with one id never judge each other. Texts of fewer
    than ``window`` words have no window. Other columns are ignored; an empty table gives no
    rows.
    """
    on_workers(df.sparkSession)
    docs = df.select(df[id_col].cast("long").alias("doc"), F.xxhash64(df[text_col]).alias("key"), df[text_col].alias("text"))
    of = ranges(docs, window).groupBy("doc", "key").agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))
    of = stored(of, "repeats")  # a row for each text that has some
    some = Bitmap(of.select("doc", "key"))  # only texts with repeats are shuffled
    none = F.lit(None).cast("array<int>")
    joined = some.split(docs, True).join(of, ["doc", "key"], "left").select("doc", "text", "starts", "stops")
    joined = joined.unionAll(some.split(docs, False).select("doc", "text", none.alias("starts"), none.alias("stops")))
    out = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text

    def cut(batches):
        for whole in batches:
            for b in pieces_of(whole, "text"):
                n, gone, sha, kept = [], [], [], []
                for t, starts, stops in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                    ws = (t or "").encode().split()
                    n.append(len(ws))
                    if starts:
                        depth = np.zeros(len(ws) + 1, np.int32)
                        np.add.at(depth, starts, 1)
                        np.add.at(depth, stops, -1)
                        left = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
                        ws = [ws[i] for i in left.tolist()]
                    gone.append(n[-1] - len(ws))
                    text = b" ".join(ws)
                    sha.append(hashlib.sha256(text).hexdigest())
                    kept.append(text.decode())
                cols = [b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    cols, names = [*cols, pa.array(kept, pa.string())], [*names, "kept"]
                yield pa.RecordBatch.from_arrays(cols, names)

    return joined.mapInArrow(cut, out)


ORACLE = """
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w) t),
least AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos FROM win JOIN least USING (k) WHERE m < doc_id),
word AS (SELECT doc_id, pos, ws[pos] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS pos FROM w) t),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
