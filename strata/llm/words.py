"""Words, hashes and sliding windows of whole Arrow text columns, in numpy (no Python loop
over words or bytes)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

_BASE = 0x9E3779B97F4A7C15


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, eight bytes a step; spans over 64 bytes one by one."""
    size = ends - starts
    h = size.astype(U) * U(_BASE)
    if len(h) == 0:
        return h
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    at = np.flatnonzero(size <= 64)
    k = 0
    while len(at):
        left = np.minimum(size[at] - k, 8)
        part = eight[starts[at] + k] & (U(0xFFFFFFFFFFFFFFFF) >> ((8 - left) * 8).astype(U))
        h[at] = mix(h[at] ^ (part + U(k + 1)) * U(0xD6E8FEB86659FD93))
        k += 8
        at = at[size[at] > k]
    for i in np.flatnonzero(size > 64).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return h


@dataclass
class Words:
    """The words of a run of documents: byte spans into ``data`` and each word's row."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray  # words of each row
    offsets: np.ndarray  # where each row's text begins in ``data``

    @property
    def first(self) -> np.ndarray:
        """Index of each row's first word."""
        return np.cumsum(self.counts) - self.counts

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the rows' offsets into them (null: empty)."""
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offs[0] : offs[-1]], offs - offs[0]


def split_words(col: pa.Array, lower: bool = False, alnum: bool = False) -> Words:
    """Words of a string column: runs without ASCII white space; with ``alnum`` runs of
    ASCII letters, digits and non-ASCII bytes. ``lower`` maps A-Z to a-z."""
    data, offs = text_bytes(col)
    return split_bytes(_LOWER[data] if lower else data, offs, alnum)


def split_bytes(data: np.ndarray, offs: np.ndarray, alnum: bool = False) -> Words:
    """The same for bytes that ``offs`` cuts into rows."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(data, z, z, np.zeros(len(offs) - 1, np.int64), offs[:-1])
    inside = _ALNUM[data] if alnum else ~_SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[offs] = True
    before = np.zeros(n + 1, bool)
    before[1:] = inside
    here = np.zeros(n + 1, bool)
    here[:n] = inside
    starts = np.flatnonzero(here & (cut | ~before))
    ends = np.flatnonzero(before & (cut | ~here))
    at = np.searchsorted(starts, offs)
    return Words(data, starts, ends, np.diff(at), offs[:-1])


def run_hash(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` neighbouring hashes, n - width + 1 of them."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, U)
    out = np.zeros(n, U)
    for i in range(width):
        out = out * U(_BASE) + h[i : i + n]
    return mix(out)


def run_starts(counts: np.ndarray, width: int) -> np.ndarray:
    """Indexes at which a run of ``width`` items fits into its row, for rows of ``counts``
    items that follow each other."""
    n = int(counts.sum())
    ok = np.ones(n, bool)
    last = np.cumsum(counts)
    for k in range(1, width):
        at = last - k
        ok[at[counts >= k]] = False
    return np.flatnonzero(ok)


def pieces_of(batch: pa.RecordBatch, col: str, most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``most_bytes`` of text each (one row at least), so that
    working memory follows the slice and not the batch."""
    if batch.num_rows == 0:
        return
    c = batch.column(batch.schema.get_field_index(col))
    _, offs = text_bytes(c)
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offs, offs[at] + most_bytes, "right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` neighbours, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out
