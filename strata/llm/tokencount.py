"""Token counts by a map-side two-tier lookup.

A byte-level BPE never merges across pre-tokens, so a text has as many tokens as its
pre-tokens together. Their lengths come from two tiers, and nothing but the result leaves a
task: a broadcast hash table of the frequent pre-tokens, then a cache of each worker, filled by
encoding what both miss. Frequencies are taken from a bounded sample of documents; the table
only saves work, so they change the speed, never a count.

Pre-tokens are cut by the tokenizer's published pattern where all characters are of blocks on
whose classes the pattern and the library agree, and by the library itself elsewhere.
"""

from __future__ import annotations

import json
import os
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import on_workers

OUT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
#: The pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Latin, Greek, Cyrillic, general punctuation, kana, unified ideographs, Hangul: every code
#: point of these blocks has the same class for the pattern and for the library (tested).
BLOCKS = [(0x0000, 0x0557), (0x2000, 0x2064), (0x3041, 0x3096), (0x3099, 0x30FF), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3)]
PLAIN = "[{}]*".format("".join(rf"\u{a:04x}-\u{b:04x}" for a, b in BLOCKS))
CHUNK = 4096


class Lengths:
    """A compact open-addressing hash table of pre-tokens to token counts: a slot holds 64 bits
    of hash and a row; a hit is confirmed by the pre-token's bytes."""

    def __init__(self, counts: dict[str, int]):
        words = [w.encode() for w in counts]
        bits = max(1, (2 * len(words)).bit_length())
        self.mask = (1 << bits) - 1
        self.hashes, self.rows = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
        self.lengths = np.array(list(counts.values()), np.int32)
        self.ends, self.blob = np.cumsum([0, *map(len, words)]), b"".join(words)
        for row, w in enumerate(words):
            h = xxhash.xxh64_intdigest(w)
            at = h & self.mask
            while self.rows[at] >= 0:
                at = (at + 1) & self.mask
            self.hashes[at], self.rows[at] = h, row

    def get(self, word: str) -> int | None:
        w = word.encode()
        h = xxhash.xxh64_intdigest(w)
        at = h & self.mask
        while (row := self.rows[at]) >= 0:
            if self.hashes[at] == h and self.blob[self.ends[row] : self.ends[row + 1]] == w:
                return int(self.lengths[row])
            at = (at + 1) & self.mask
        return None


class Counts:
    """Token counts of texts as the library gives them, by pre-tokens."""

    def __init__(self, spec: str, table: Lengths | None = None, most: int = 400_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        plan = json.loads(spec)
        pre, added = plan["pre_tokenizer"], plan["added_tokens"]
        odd = [t["content"] for t in added if t["lstrip"] or t["rstrip"] or t["single_word"]]
        if plan["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or odd:
            raise ValueError("only byte-level tokenizers without normaliser, prefix space or stripping added tokens")
        self.tok = Tokenizer.from_str(spec)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.table, self.most = table, most
        self.known: dict[str, int] = {}
        self.misses = 0
        self.find, self.plain = regex.compile(PATTERN).findall, regex.compile(PLAIN).fullmatch
        special = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def pieces(self, text: str) -> Iterator[list[str]]:
        """Pre-tokens of a text without special strings, part by part. A part ends before a
        lone space between two other characters, where a pre-token always ends."""
        at = 0
        while at < len(text):
            end = at + CHUNK
            while end < len(text):
                end = text.find(" ", end)
                if end < 0:
                    end = len(text)
                elif text[end - 1].isspace() or end + 1 == len(text) or text[end + 1].isspace():
                    end += 1
                else:
                    break
            part = text[at:end]
            at = end
            if self.plain(part):
                yield self.find(part)
            else:
                yield [part[a:b] for _, (a, b) in self._spans(part)]

    def _spans(self, part: str) -> list:
        """The library's pre-tokens; two of them may share a character, never a byte, so the
        pieces of such a character are put together again."""
        out = []
        for name, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(part):
            if out and a < out[-1][1][1]:
                out[-1] = (out[-1][0] + name, (out[-1][1][0], b))
            else:
                out.append((name, (a, b)))
        return out

    def split(self, text: str) -> tuple[list[str], int]:
        """Parts of a text between special strings, and how many of these there are."""
        if self.special is None:
            return [text], 0
        parts = self.special.split(text)
        return parts, len(parts) - 1

    def of(self, text: str) -> int:
        parts, total = self.split(text)
        known = self.known
        for part in parts:
            for words in self.pieces(part):
                try:
                    total += sum([known[w] for w in words])
                except KeyError:
                    self._learn({w for w in words if w not in known})
                    total += sum([known[w] for w in words])
                    if len(known) > self.most:
                        known.clear()
        return total

    def _learn(self, words: set[str]) -> None:
        """Lengths from the broadcast table, else by encoding."""
        new = []
        for w in words:
            n = self.table.get(w) if self.table else None
            if n is None:
                new.append(w)
            else:
                self.known[w] = n
        self.misses += len(new)
        for w, e in zip(new, self.tok.encode_batch(new, add_special_tokens=False), strict=True):
            self.known[w] = len(e.ids)


_CACHE: dict[str, Counts] = {}


def tokenizer_json(path: str | None = None) -> str:
    """The tokenizer file's content; by default the installed public byte-level BPE."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def frequent(docs: DataFrame, spec, sample_docs: int, table_size: int, longest: int) -> Lengths:
    """The ``table_size`` most frequent pre-tokens, of ``longest`` bytes at most, in a sample of
    about ``sample_docs`` documents (those with the smallest hashes), with their lengths."""
    share = min(1.0, sample_docs / max(1, docs.count()))
    few = docs.filter(F.shiftrightunsigned(F.xxhash64(F.lit(12), "doc_id", F.length("text")), 11) < int(share * (1 << 53)))

    def count(batches):
        counts, seen = Counts(spec.value), Counter()
        for batch in batches:
            for text in batch.column(1):
                for part in counts.split(text.as_py() or "")[0]:
                    for words in counts.pieces(part):
                        seen.update(words)
        seen = {w: n for w, n in seen.items() if len(w.encode()) <= longest}
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["w", "n"])

    top = few.mapInArrow(count, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "w").limit(table_size)
    words = [r.w for r in top.collect()]
    lengths = Counts(spec.value)
    lengths._learn(set(words))
    return Lengths({w: lengths.known[w] for w in words})


def count_tokens(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    limit: int = 512,
    sample_docs: int = 2048,
    table_size: int = 65536,
    longest: int = 64,
) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens) of every row.

    No token is added at either end; special strings inside texts are the tokens the library
    makes of them. Null or empty text: no bytes, no tokens. A null id is returned as null, each
    of several equal rows is returned, an empty table gives no rows, other columns are ignored.
    Texts are cut part by part, so a very long one needs no more memory than its longest
    pre-token. The broadcast table has at most ``table_size`` pre-tokens of ``longest`` bytes."""
    spark = df.sparkSession
    on_workers(spark)
    spec = spark.sparkContext.broadcast(tokenizer_json(tokenizer))
    docs = df.select(df[id_col].cast("long").alias("doc_id"), F.coalesce(df[text_col], F.lit("")).alias("text"))
    table = spark.sparkContext.broadcast(frequent(docs, spec, sample_docs, table_size, longest))

    job = uuid.uuid4().hex  # a worker keeps its cache from task to task of this query

    def run(batches):
        if job not in _CACHE:
            _CACHE.clear()
            _CACHE[job] = Counts(spec.value, table.value)
        counts = _CACHE[job]
        for batch in batches:
            n = np.array([counts.of(t.as_py()) for t in batch.column(1)], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.withColumn("n_bytes", F.octet_length("text").cast("long")).mapInArrow(run, OUT)
