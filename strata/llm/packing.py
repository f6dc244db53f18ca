"""Best-fit packing of token sequences: bin completion with branch and bound.

Texts are tokenised in Arrow batches (each distinct word once per worker), cut into pieces
of at most ``capacity`` tokens, and dealt round robin into shards of a bounded number of
documents. A task packs one shard: around the largest piece left it enumerates the
undominated fillings of the free space, follows them in order of waste, and leaves a branch
as soon as its waste shows that it cannot beat the incumbent, which starts as best-fit
decreasing. Time bounds the search, see ``bin_completion``. A shard wastes at most the fraction of a sequence, so sharding costs less than
one sequence a shard.
"""

from __future__ import annotations

import math
import os
import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from strata.llm.common import on_workers

_PIECE = np.dtype([("doc_id", "<i8"), ("no_id", "u1"), ("piece", "<i4"), ("start", "<i8"), ("length", "<i4"), ("crc", "<u4")])
OUT = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


# ------------------------------------------------------------------ packing one shard
def best_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of sizes."""
    bins, free = [], []  # free: sorted (room, bin)
    for s in sorted(sizes, reverse=True):
        i = bisect_left(free, (s, -1))
        if i == len(free):
            bins.append([s])
            insort(free, (capacity - s, len(bins) - 1))
        else:
            room, b = free.pop(i)
            bins[b].append(s)
            insort(free, (room - s, b))
    return bins


class _Left:
    """The multiset of sizes still to be packed, with a bit for each size present."""

    def __init__(self, sizes, capacity):
        self.count = [0] * (capacity + 1)
        self.mask = 0
        for s in sizes:
            self.add(s)

    def add(self, s):
        self.count[s] += 1
        self.mask |= 1 << s

    def take(self, s):
        self.count[s] -= 1
        if not self.count[s]:
            self.mask ^= 1 << s

    def at_most(self, s):
        """The largest size present that is <= s, or 0."""
        return (self.mask & ((2 << s) - 1)).bit_length() - 1 if s > 0 and self.mask & ((2 << s) - 1) else 0


def fillings(left: _Left, room: int, allowed: int, steps: int) -> tuple[list[tuple[int, tuple[int, ...]]], int]:
    """(waste, sizes) of the undominated fillings of ``room`` that waste no more than
    ``allowed``, least waste first, and the steps that finding them took, ``steps`` at most.

    Fillings of any number of pieces are enumerated depth-first, larger pieces first. One is
    dominated if another piece fits in as well, or if a larger piece that is left can stand in
    for one of its pieces, or one piece for two neighbours."""
    found, chosen, rest, used = [], [], room, 0
    while True:
        x = left.at_most(min(chosen[-1], rest) if chosen else rest)
        while x:  # fill up
            left.take(x)
            chosen.append(x)
            rest -= x
            used += 1
            x = left.at_most(min(x, rest))
        if rest <= allowed and not left.at_most(rest):
            over = any(left.at_most(c + rest) > c for c in set(chosen))
            if not over and not any(left.at_most(c + d + rest) >= c + d for c, d in zip(chosen, chosen[1:], strict=False)):
                found.append((rest, tuple(chosen)))
                if rest == 0 and len(chosen) <= 1:
                    break  # one piece that fills the room dominates all others
        x = 0
        while chosen and not x and used < steps:  # the next smaller piece in the last place that has one
            last = chosen.pop()
            left.add(last)
            rest += last
            x = left.at_most(last - 1)
        if not x:
            break
        left.take(x)
        chosen.append(x)
        rest -= x
        used += 1
    for c in chosen:
        left.add(c)
    return sorted(found, key=lambda f: f[0]), used + 1


def bin_completion(sizes: list[int], capacity: int, steps: int | None = None, each: int = 256) -> list[list[int]]:
    """Bins (lists of sizes) that hold all sizes. ``steps`` of the search in all and ``each`` in
    one enumeration bound the time, not the result: when they run out the incumbent stands, at
    first best-fit decreasing. A search that ends before is complete: the result is optimal as
    far as no enumeration was cut."""
    best = best_fit_decreasing(sizes, capacity)
    total = sum(sizes)
    least = math.ceil(total / capacity)
    left, path, waste = _Left(sizes, capacity), [], 0
    steps = 100_000 + 64 * len(best) if steps is None else steps
    while len(best) > least and steps > 0:
        allowed = (len(best) - 1) * capacity - total - waste  # what a solution with a bin less may still waste
        if left.mask and allowed >= 0:
            big = left.mask.bit_length() - 1
            left.take(big)
            options, used = fillings(left, capacity - big, allowed, min(each, steps))
            steps -= used
            path.append([big, options, 0, None])
        elif not left.mask and len(path) < len(best):
            best = [[big, *chosen] for big, _, _, chosen in path]
            continue
        # move on: the next filling of the deepest bin that has one
        while path:
            big, options, k, chosen = path[-1]
            if chosen is not None:
                for s in chosen:
                    left.add(s)
                waste -= options[k - 1][0]
            if k < len(options) and waste + options[k][0] <= (len(best) - 1) * capacity - total:
                path[-1][2:] = [k + 1, options[k][1]]
                for s in options[k][1]:
                    left.take(s)
                waste += options[k][0]
                break
            path.pop()
            left.add(big)
        else:
            break
    return best


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of each piece, and the number of sequences."""
    seq, off = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    full = np.flatnonzero(lengths >= capacity)
    seq[full] = np.arange(len(full))
    n = len(full)
    where: dict[int, list[int]] = {}
    for i in np.flatnonzero(lengths < capacity).tolist():
        where.setdefault(int(lengths[i]), []).append(i)
    for b in bin_completion([s for s, at in where.items() for _ in at], capacity):
        pos = 0
        for s in b:
            i = where[s].pop()
            seq[i], off[i] = n, pos
            pos += s
        n += 1
    return seq, off, n


# ------------------------------------------------------------------ tokens
_CACHE: dict = {}
#: ASCII punctuation without the apostrophe, which can begin a token of its own.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _byte_letters() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow
    from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class _Ids:
    """Token ids of words as little-endian bytes. The tokenizer treats white space as a
    boundary and drops it, so a text's ids are its words' ids in order. Most words are
    letters with some punctuation behind; both parts go straight to the BPE model and are
    kept, every other word takes the tokenizer's whole way. What was used of late is kept
    (two generations of at most ``most`` words each)."""

    def __init__(self, spec: str, most: int = 500_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_str(spec)
        self.model, self.letters = self.whole.model, _byte_letters()
        self.known, self.before, self.parts, self.most = {}, {}, {}, most

    def _part(self, s: str) -> bytes:
        got = self.parts.get(s)
        if got is None:
            shown = "".join([self.letters[b] for b in s.encode()])
            got = self.parts[s] = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        return got

    def _word(self, w: bytes) -> bytes:
        text = w.decode()
        stem = text.rstrip(_MARKS)
        low = stem.lower()  # of U+0130 two characters, which the tokenizer splits
        if low.isalpha() and max(stem) < "\u0250" > max(low):
            tail = text[len(stem) :]
            return self._part(low) + (self._part(tail) if tail else b"")
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def of(self, ws: list[bytes]) -> bytes:
        known = self.known
        try:
            return b"".join([known[w] for w in ws])
        except KeyError:
            pass
        for w in ws:
            if w not in known:
                known[w] = self.before.get(w) or self._word(w)
        out = b"".join([known[w] for w in ws])
        if len(known) > self.most:
            self.before, self.known, self.parts = known, {}, {}
        return out


def _ids(spec: str) -> _Ids:
    key = zlib.crc32(spec.encode())
    if key not in _CACHE:
        _CACHE.clear()
        _CACHE[key] = _Ids(spec)
    return _CACHE[key]


def tokenizer_json(path: str | None = None) -> str:
    """The tokenizer file's content; by default the installed public word-level BPE."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def pack(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    capacity: int = 2048,
    end_id: int = 0,
    shard_docs: int = 8192,
) -> DataFrame:
    """Pieces of all documents placed in sequences of at most ``capacity`` tokens.

    A document is its token ids, then ``end_id``. Only longer ones are cut. Null or empty
    text: just the end id. A null id is returned as null; repeated rows are packed each.
    Other columns of ``df`` are ignored. An empty table gives no rows.
    """
    spark = df.sparkSession
    on_workers(spark)
    spec = spark.sparkContext.broadcast(tokenizer_json(tokenizer))
    docs = df.select(df[id_col].cast("long").alias("doc_id"), df[text_col].alias("text"))
    shards = max(1, math.ceil(docs.count() / shard_docs))
    end = int(end_id).to_bytes(4, "little")

    def cut(batches):
        ids, pid, turn = _ids(spec.value), TaskContext.get().partitionId(), 0
        held = [[] for _ in range(shards)]
        n_held = 0

        def flush():
            full = [s for s in range(shards) if held[s]]
            blobs = [np.array(held[s], _PIECE).tobytes() for s in full]
            for s in full:
                held[s].clear()
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(blobs, pa.binary())], ["shard", "blob"])

        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1)
            for lo in range(0, len(names), 256):
                lists = [(t or "").encode().split() for t in texts.slice(lo, 256).to_pylist()]
                for name, ws in zip(names[lo : lo + 256], lists, strict=True):
                    got = ids.of(ws) + end
                    for k, at in enumerate(range(0, len(got), 4 * capacity)):
                        part = got[at : at + 4 * capacity]
                        held[(pid * 7919 + turn) % shards].append((name or 0, name is None, k, at // 4, len(part) // 4, zlib.crc32(part)))
                        turn += 1
                        n_held += 1
            if n_held > 200_000:
                yield flush()
                n_held = 0
        yield flush()

    def fill(keys, data):
        shard = keys[0].as_py()
        x = np.concatenate([np.frombuffer(b, _PIECE) for b in data.column("blob").to_pylist()])
        x = x[np.lexsort((x["crc"], x["piece"], x["doc_id"], x["no_id"]))]  # any arrival order gives one packing
        seq, off, _ = place(x["length"].astype(np.int64), capacity)
        return pa.table(
            [
                pa.array(x["doc_id"], mask=x["no_id"].astype(bool)), pa.array(x["piece"]), pa.array(x["start"]),
                pa.array(x["length"].astype(np.int64)), pa.array(x["crc"].astype(np.int64)),
                pa.array(seq + (shard << 32)), pa.array(off),
            ],
            ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        )

    return docs.mapInArrow(cut, "shard int, blob binary").groupBy("shard").applyInArrow(fill, OUT)
