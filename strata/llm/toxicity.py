"""Toxic spans by a linear-chain conditional random field, and document scores.

Documents carry the labels, tokens do not: in a sample of toxic documents a token counts as
toxic if documents that hold it are toxic at far better odds than others. The field has two
states and features of the token and its neighbours; it is trained in numpy by gradients from
forward-backward. Scoring runs forward-backward over whole texts: the chain of a batch is cut
into blocks whose 2 x 2 transfer matrices are multiplied side by side, which is exact. The
marginals give offending spans; their largest and their sum give the document's score, by a
logistic fit to the labels.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fold, on_workers
from strata.llm.sampling import sample
from strata.llm.words import U, Words, mix, pieces_of, span_hash, split_words

OUT = "doc_id long, held_out boolean, score double, predicted int, spans array<struct<start:int,end:int>>"
_BLOCK = 128


# ------------------------------------------------------------------ the chain
def _steps(e, reset, start, trans):
    """Step weights K[a][b] of moving from state a into state b at each token."""
    x = np.exp(np.clip(e, -30, 30))
    return [[np.where(reset, np.exp(start[b]), np.exp(trans[a][b])) * (x if b else 1.0) for b in (0, 1)] for a in (0, 1)]


def forward_backward(e: np.ndarray, reset: np.ndarray, start, trans):
    """Normalised forward and backward messages of each token, (n, 2) each. ``e``: score of
    state 1 over state 0; ``reset``: the token begins a document, whatever came before."""
    n = len(e)
    blocks = max(1, -(-n // _BLOCK))
    pad = blocks * _BLOCK - n
    e = np.concatenate([e, np.zeros(pad)]).reshape(blocks, _BLOCK).T
    reset = np.concatenate([reset, np.ones(pad, bool)]).reshape(blocks, _BLOCK).T
    k = np.array(_steps(e, reset, start, trans))  # 2, 2, block, blocks
    # transfer matrix of each block
    m = np.zeros((2, 2, blocks))
    m[0, 0] = m[1, 1] = 1
    for t in range(_BLOCK):
        m = m[:, :1] * k[:1, :, t] + m[:, 1:] * k[1:, :, t]
        m /= m.sum((0, 1))
    into, back = np.ones((blocks, 2)), np.ones((blocks, 2))
    mm = m.transpose(2, 0, 1)
    v = np.array([0.5, 0.5])
    for i in range(blocks):
        into[i] = v
        v = v @ mm[i]
        v /= v.sum()
    v = np.array([0.5, 0.5])
    for i in range(blocks - 1, -1, -1):
        back[i] = v
        v = mm[i] @ v
        v /= v.sum()
    alpha, beta = np.empty((2, _BLOCK, blocks)), np.empty((2, _BLOCK, blocks))
    a0, a1 = into.T
    for t in range(_BLOCK):
        a0, a1 = a0 * k[0, 0, t] + a1 * k[1, 0, t], a0 * k[0, 1, t] + a1 * k[1, 1, t]
        s = a0 + a1
        a0, a1 = a0 / s, a1 / s
        alpha[0, t], alpha[1, t] = a0, a1
    b0, b1 = back.T
    for t in range(_BLOCK - 1, -1, -1):
        beta[0, t], beta[1, t] = b0, b1
        b0, b1 = k[0, 0, t] * b0 + k[0, 1, t] * b1, k[1, 0, t] * b0 + k[1, 1, t] * b1
        s = b0 + b1
        b0, b1 = b0 / s, b1 / s
    flat = lambda x: x.transpose(2, 1, 0).reshape(-1, 2)[:n]
    return flat(alpha), flat(beta)


def marginals(e, reset, start, trans) -> np.ndarray:
    """Probability of state 1 at each token."""
    if len(e) == 0:
        return np.zeros(0)
    a, b = forward_backward(e, reset, start, trans)
    p = a * b
    return p[:, 1] / p.sum(1)


# ------------------------------------------------------------------ features
def _features(w: Words) -> np.ndarray:
    """(3, n) hashes: the token, the one before and the one after (0 at a document's ends)."""
    h = span_hash(w.data, w.starts, w.ends)
    h[h == 0] = U(1)  # 0 stands for no token
    prev, nxt = np.zeros_like(h), np.zeros_like(h)
    prev[1:], nxt[:-1] = h[:-1], h[1:]
    some = w.counts > 0
    prev[w.first[some]] = 0
    nxt[(w.first + w.counts - 1)[some]] = 0
    return np.stack([h, _before(prev), _after(nxt)])


def _before(token: np.ndarray) -> np.ndarray:
    return mix(token ^ U(0xA5A5A5A5))


def _after(token: np.ndarray) -> np.ndarray:
    return mix(token ^ U(0x5A5A5A5A))


def _feature_keys(tokens: np.ndarray) -> np.ndarray:
    """Hashes of the features that tokens make: as the token, the one before, the one after."""
    return np.concatenate([tokens, _before(tokens), _after(tokens)])


def _resets(w: Words) -> np.ndarray:
    r = np.zeros(int(w.counts.sum()), bool)
    r[w.first[w.counts > 0]] = True
    return r


class _Weights:
    """Weights by 64-bit feature hash; a table of slots finds the few keys there are."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(8, int(np.ceil(np.log2(max(2, 8 * len(keys))))))
        self.shift, self.keys, self.values = U(64 - bits), keys, values
        order = np.argsort(mix(keys) >> self.shift, kind="stable")
        self.keys, self.values = keys[order], values[order]
        slot = (mix(self.keys) >> self.shift).astype(np.int64)
        self.first = np.searchsorted(slot, np.arange((1 << bits) + 1)).astype(np.int32)
        self.deep = int(np.bincount(slot, minlength=1).max()) if len(keys) else 0

    def of(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(h.shape)
        if not len(self.keys):
            return out
        slot = (mix(h) >> self.shift).astype(np.int64)
        lo, hi = self.first[slot], self.first[slot + 1]
        for d in range(self.deep):
            at = np.flatnonzero(lo + d < hi)
            k = lo[at] + d
            same = self.keys[k] == h[at]
            out[at[same]] = self.values[k[same]]
        return out


@dataclass
class Model:
    weights: _Weights
    bias: float
    start: np.ndarray
    trans: np.ndarray
    logistic: np.ndarray  # of (1, largest marginal's log odds, log of 1 + sum of marginals)

    def emissions(self, w: Words) -> np.ndarray:
        f = _features(w)
        return self.weights.of(f[0]) + self.weights.of(f[1]) + self.weights.of(f[2]) + self.bias

    def score(self, col: pa.Array):
        """Scores of a column's rows, and its words with their marginals."""
        w = split_words(col, lower=True, alnum=True)
        p = marginals(self.emissions(w), _resets(w), self.start, self.trans)
        x = _pooled(p, w)
        return 1 / (1 + np.exp(-x @ self.logistic)), w, p


def _pooled(p: np.ndarray, w: Words) -> np.ndarray:
    n = len(w.counts)
    x = np.zeros((n, 3))
    x[:, 0] = 1
    top = np.full(n, 1e-6)
    if len(p):
        np.maximum.at(top, w.row, np.clip(p, 1e-6, 1 - 1e-6))
        x[:, 2] = np.log1p(np.bincount(w.row, p, n))
    x[:, 1] = np.log(top / (1 - top)) / 4
    return x


# ------------------------------------------------------------------ training
def _copies(f: np.ndarray, w: Words) -> np.ndarray:
    """Rows that are probably near copies of an earlier row: one of three least hashes over
    their runs of three tokens is the same."""
    copy = np.zeros(len(w.counts), bool)
    if f.shape[1] == 0:
        return copy
    run = mix(f[0] ^ mix(f[1]) ^ (mix(f[2]) << U(1)))
    some = np.flatnonzero(w.counts >= 3)
    for seed in (1, 2, 3):
        least = np.minimum.reduceat(mix(run ^ U(seed)), w.first[w.counts > 0])
        least = least[np.isin(np.flatnonzero(w.counts > 0), some)]
        _, first = np.unique(least, return_index=True)
        copy[np.delete(some, first)] = True
    return copy


def _token_labels(f: np.ndarray, w: Words, toxic: np.ndarray) -> np.ndarray:
    """1 for tokens of toxic documents whose documents are toxic at odds at least e**3 times
    those of others, by a log-likelihood ratio that chance would not reach among that many
    different tokens (the best token if none does). Near copies count once."""
    alone = ~_copies(f, w)
    some = np.flatnonzero(alone[w.row])
    token, row = f[0][some], w.row[some]
    order = np.lexsort((row, token))
    token, row = token[order], row[order]
    once = np.ones(len(token), bool)  # a token counts once a document
    once[1:] = (token[1:] != token[:-1]) | (row[1:] != row[:-1])
    keys, at = np.unique(token[once], return_inverse=True)
    hot = toxic[row[once]] == 1
    a, b = np.bincount(at, hot, len(keys)), np.bincount(at, ~hot, len(keys))
    P, N = (alone & (toxic == 1)).sum(), (alone & (toxic == 0)).sum()
    odds = np.log((a + 0.5) / (P - a + 0.5)) - np.log((b + 0.5) / (N - b + 0.5))
    expected = (a + b) * P / max(1, P + N)
    ratio = 2 * (a * np.log(np.maximum(a, 1) / np.maximum(expected, 1e-9)) + b * np.log(np.maximum(b, 1) / np.maximum(a + b - expected, 1e-9)))
    likely = odds >= 3
    far = likely & (ratio >= min(2 * np.log(max(2, len(keys))), ratio[likely].max(initial=0)))
    marked = keys[far]
    return (np.isin(f[0], marked) & (toxic[w.row] == 1)).astype(float)


def _steps_of(reset: np.ndarray, step_tokens: int) -> np.ndarray:
    """Bounds of about equal parts of ``step_tokens`` tokens that begin where documents do."""
    n, first = len(reset), np.flatnonzero(reset)
    parts = max(1, round(n / step_tokens))
    at = np.searchsorted(first, np.arange(1, parts) * n // parts)
    return np.unique(np.concatenate([[0], first[at[at < len(first)]], [n]]))


def fit(texts: list[str], toxic: np.ndarray, weights: np.ndarray, passes: int = 120, l2: float = 0.5, step_tokens: int = 150_000) -> Model:
    """The field and the logistic fit. ``weights``: of each document in the logistic fit. A
    round follows the gradient of one part of the documents, which are shuffled, in turn;
    every document is in ``passes`` rounds, however many parts there are."""
    mixed = np.random.default_rng(7).permutation(len(texts))
    texts, toxic, weights = [texts[i] for i in mixed], toxic[mixed], weights[mixed]
    w = split_words(pa.array(texts, pa.large_string()), lower=True, alnum=True)
    f, every_reset = _features(w), _resets(w)
    y = _token_labels(f, w, toxic)
    # documents that hold marked tokens, and as many others; toxic ones without are left out
    marked = np.bincount(w.row, y, len(texts)) > 0
    use = (marked | (toxic == 0))[w.row]
    words, own = np.unique(f[0][use], return_inverse=True)
    del f
    nothing, reset = len(words), every_reset[use]  # before the first and after the last word
    every = np.empty((3, len(own)), np.int32)
    every[0] = own
    every[1] = np.where(reset, nothing, np.roll(own, 1)) + nothing + 1
    every[2] = np.where(np.roll(reset, -1), nothing, np.roll(own, -1)) + 2 * (nothing + 1)
    keys = _feature_keys(np.append(words, U(0)))
    every_y, every_reset = y[use], reset
    n = max(1, len(every_y))
    theta = np.zeros(len(keys) + 7)  # features, bias, start 2, trans 4
    theta[len(keys)] = -2.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    bounds = _steps_of(every_reset, step_tokens)
    rounds = passes * (len(bounds) - 1)
    for i in range(rounds if len(every_y) else 0):
        part = slice(*bounds[i % (len(bounds) - 1) :][:2])
        at, y, reset = every[:, part], every_y[part], every_reset[part]
        wt, bias, start, trans = theta[: len(keys)], theta[len(keys)], theta[-6:-4], theta[-4:].reshape(2, 2)
        e = wt[at].sum(0) + bias
        a, b = forward_backward(e, reset, start, trans)
        p = a * b
        p = p[:, 1] / p.sum(1)
        d = p - y
        g = np.zeros_like(theta)
        for k in range(3):
            g[: len(keys)] += np.bincount(at[k], d, len(keys))
        g[len(keys)] = d.sum()
        g[-6:-4] = [-(d[reset].sum()), d[reset].sum()]
        inner = np.flatnonzero(~reset)
        k = np.array(_steps(e[inner], np.zeros(len(inner), bool), start, trans))
        joint = np.array([[a[inner - 1, s] * k[s, t] * b[inner, t] for t in (0, 1)] for s in (0, 1)])
        joint /= joint.sum((0, 1))
        seen = [[((y[inner - 1] == s) & (y[inner] == t)).sum() for t in (0, 1)] for s in (0, 1)]
        g[-4:] = (joint.sum(2) - np.array(seen)).ravel()
        g = g / len(y) + l2 * theta / n
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        rate = 0.15 * min(1.0, 2 * (1 - i / rounds))
        theta -= rate * (m / (1 - 0.9 ** (i + 1))) / (np.sqrt(v / (1 - 0.99 ** (i + 1))) + 1e-9)
    del every
    keep = np.abs(theta[: len(keys)]) > 0.3
    model = Model(_Weights(keys[keep], theta[: len(keys)][keep]), float(theta[len(keys)]), theta[-6:-4].copy(), theta[-4:].reshape(2, 2).copy(), np.zeros(3))
    del w, every_y, every_reset, use, marked
    x, t = [np.zeros((0, 3))], (toxic == 1).astype(float)
    for k in range(0, len(texts), 256):
        w = split_words(pa.array(texts[k : k + 256], pa.large_string()), lower=True, alnum=True)
        x.append(_pooled(marginals(model.emissions(w), _resets(w), model.start, model.trans), w))
    x = np.concatenate(x)
    c = np.zeros(3)
    for _ in range(40):  # Newton steps with a small ridge
        q = 1 / (1 + np.exp(-x @ c))
        h = (x * (weights * q * (1 - q))[:, None]).T @ x + 1e-2 * np.eye(3)
        c += np.linalg.solve(h, x.T @ (weights * (t - q)) - 1e-2 * c)
    model.logistic = c
    return model


def train(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = 3000, most_chars: int = 20_000
) -> Model | None:
    """A model from at most ``per_class`` documents of each label, outside the held-out fold,
    of at most ``most_chars`` characters each (longer texts are scored, not learned from).
    A document with both labels counts as toxic. None if either label is missing. The sample is
    learned from in one task, of these bounds; only the model comes to the driver."""
    known = labels.select(labels[id_col].alias("doc_id"), labels[label_col].alias("y")).filter("y is not null and doc_id is not null")
    known = known.filter(fold("doc_id") != 0).groupBy("doc_id").agg(F.max("y").cast("int").alias("y"))
    n = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if not n.get(0) or not n.get(1):
        return None
    ids = sample(known, "y", per_class, "doc_id")
    picked = df.sparkSession.createDataFrame([(int(i), int(y)) for i, y in zip(ids.doc_id, ids.y, strict=True)], "doc_id long, y int")
    texts = df.select(df[id_col].alias("doc_id"), df[text_col].alias("text")).filter(F.length("text") <= most_chars)
    got = texts.join(F.broadcast(picked), "doc_id").select("doc_id", "text", "y").distinct()  # 2 * per_class documents at most

    def learn(batches):
        batches = list(batches)
        if not batches:
            return
        rows = pa.Table.from_batches(batches).sort_by([("doc_id", "ascending"), ("text", "ascending")])
        y = rows.column("y").to_numpy()
        if (y == 0).any() and (y == 1).any():
            share = {c: n[c] / (y == c).sum() for c in (0, 1)}
            scale = len(y) / sum(n[c] for c in (0, 1))
            model = fit(rows.column("text").to_pylist(), y, np.where(y == 1, share[1], share[0]) * scale)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    on_workers(df.sparkSession)
    made = got.withColumn("doc_id", F.col("doc_id").cast("long")).repartition(1).mapInArrow(learn, "model binary").first()
    return pickle.loads(made["model"]) if made else None


# ------------------------------------------------------------------ scoring
def _spans(w: Words, p: np.ndarray, rows: int) -> list[list[dict]]:
    """Runs of tokens with a marginal of at least a half, as offsets in code points."""
    out = [[] for _ in range(rows)]
    hot = p >= 0.5
    if not hot.any():
        return out
    chars = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
    row = w.row
    for i in np.flatnonzero(hot).tolist():
        r = row[i]
        head = chars[w.offsets[r]]
        s, e = int(chars[w.starts[i]] - head), int(chars[w.ends[i]] - head)
        if out[r] and i and hot[i - 1] and row[i - 1] == r:
            out[r][-1]["end"] = e
        else:
            out[r].append({"start": s, "end": e})
    return out


def score(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of ``df``: fold, score, prediction and offending spans.

    Null and empty texts have no token and get the score of a text without any toxic token.
    Without a model every score is 0. Repeated rows are scored each; other columns are
    ignored; an empty table gives no rows.
    """
    spark = df.sparkSession
    on_workers(spark)
    docs = df.select(df[id_col].alias("doc_id"), (fold(df[id_col]) == 0).alias("held_out"), df[text_col].alias("text"))
    held = spark.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for whole in batches:
            for b in pieces_of(whole, "text"):
                n = b.num_rows
                s, spans = np.zeros(n), [[] for _ in range(n)]
                if m is not None:
                    s, w, p = m.score(b.column(2))
                    spans = _spans(w, p, n)
                cols = [b.column(0), b.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32)), pa.array(spans, _SPANS)]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "held_out", "score", "predicted", "spans"])

    return docs.mapInArrow(run, OUT.replace("doc_id long", f"doc_id {docs.schema['doc_id'].dataType.simpleString()}"))


def keep_clean(df: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that are not predicted toxic, with all their columns; the batches
    that are scored are filtered in place, so nothing is shuffled. Null and empty texts stay."""
    on_workers(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for whole in batches:
            for b in pieces_of(whole, text_col):
                if m is not None:
                    s, _, _ = m.score(b.column(b.schema.get_field_index(text_col)))
                    b = b.filter(pa.array(s < 0.5))
                yield b

    return df.mapInArrow(run, df.schema)


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
