"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are cut into segments of ``SEGMENT`` bytes. In each, a gated recurrent unit runs over
the bytes' embeddings from either end; both states label every byte with a language. The
document's probabilities are the mean over all its bytes. The network is trained in numpy by
backpropagation through time on a bounded sample, and runs in Arrow batches over whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fold, on_workers
from strata.llm.sampling import sample
from strata.llm.words import pieces_of, text_bytes

SEGMENT = 128
OUT = "held_out boolean, lang_pred string, score double, n_positions long"
UNKNOWN = "und"


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Weights: byte embeddings (256, D); per direction the gates (2H, D+H+1) and the candidate
    (H, D+H+1), the last column being the bias; the output layer (L, 2H+1)."""

    langs: list[str]
    emb: np.ndarray
    gates: list[np.ndarray]
    cand: list[np.ndarray]
    out: np.ndarray

    @property
    def hidden(self) -> int:
        return self.cand[0].shape[0]

    def _run(self, x: np.ndarray, way: int, keep: bool):
        """States (T, H, B) of one direction over embedded bytes x (T, D, B); with ``keep``
        also what backpropagation needs."""
        t_n, d, n = x.shape
        h_n = self.hidden
        w, u = self.gates[way], self.cand[way]
        states, kept = np.empty((t_n, h_n, n), np.float32), []
        v = np.ones((d + h_n + 1, n), np.float32)
        v[d:-1] = 0
        h = np.zeros((h_n, n), np.float32)
        for t in range(t_n) if way == 0 else range(t_n - 1, -1, -1):
            v[:d] = x[t]
            v[d:-1] = h
            rz = _sigmoid(w @ v)
            r, z = rz[:h_n], rz[h_n:]
            if keep:
                before, v1 = h, v.copy()
            v[d:-1] = r * h
            c = np.tanh(u @ v)
            h = c + z * (h - c)
            states[t] = h
            if keep:
                kept.append((t, before, r, z, c, v1, v.copy()))
        return states, kept

    def label(self, seg: np.ndarray) -> np.ndarray:
        """Language probabilities (T, L, B) of every byte of segments (B, T)."""
        x = np.ascontiguousarray(self.emb[seg.T].transpose(0, 2, 1))
        s = np.concatenate([self._run(x, 0, False)[0], self._run(x, 1, False)[0]], 1)
        return _softmax(self.out[:, :-1] @ s + self.out[:, -1:])


def _softmax(a: np.ndarray) -> np.ndarray:
    a = np.exp(a - a.max(1, keepdims=True))
    return a / a.sum(1, keepdims=True)


def _gradients(net: Network, seg: np.ndarray, y: np.ndarray):
    """Loss and gradients of mean cross entropy over the bytes of segments (B, T)."""
    b, t_n = seg.shape
    d, h_n = net.emb.shape[1], net.hidden
    x = np.ascontiguousarray(net.emb[seg.T].transpose(0, 2, 1))
    runs = [net._run(x, way, True) for way in (0, 1)]
    s = np.concatenate([runs[0][0], runs[1][0]], 1)
    p = _softmax(net.out[:, :-1] @ s + net.out[:, -1:])
    real = (seg.T != 0).astype(np.float32)[:, None, :]
    n = max(1.0, float(real.sum()))
    target = np.zeros_like(p)
    target[:, y, np.arange(b)] = 1
    loss = -float((np.log(np.maximum(p, 1e-9)) * target * real).sum()) / n
    da = (p - target) * real / n
    g_out = np.concatenate([np.einsum("tlb,thb->lh", da, s), da.sum((0, 2))[:, None]], 1)
    ds = net.out[:, :-1].T @ da
    dx = np.zeros_like(x)
    g_gates, g_cand = [np.zeros_like(w) for w in net.gates], [np.zeros_like(w) for w in net.cand]
    for way in (0, 1):
        w, u = net.gates[way], net.cand[way]
        dh = np.zeros((h_n, b), np.float32)
        for t, before, r, z, c, v1, v2 in reversed(runs[way][1]):
            dh = dh + ds[t, way * h_n : (way + 1) * h_n]
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (before - c) * z * (1 - z)
            g_cand[way] += dc @ v2.T
            back = u.T @ dc
            dr = back[d:-1] * before * r * (1 - r)
            drz = np.concatenate([dr, dz])
            g_gates[way] += drz @ v1.T
            back1 = w.T @ drz
            dx[t] += back[:d] + back1[:d]
            dh = dh * z + back[d:-1] * r + back1[d:-1]
    g_emb = np.zeros_like(net.emb)
    np.add.at(g_emb, seg.T.ravel(), dx.transpose(0, 2, 1).reshape(-1, d))
    return loss, [g_emb, *g_gates, *g_cand, g_out]


def segments(data: np.ndarray, offs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Segments (B, length) of all rows' bytes, the last of a row filled up with zeros, and
    the row of each."""
    sizes = np.diff(offs)
    per = -(-sizes // length)
    row = np.repeat(np.arange(len(sizes)), per)
    k = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    start = offs[:-1][row] + k * length
    at = start[:, None] + np.arange(length)
    ok = at < offs[1:][row][:, None]
    return np.where(ok, data[np.minimum(at, max(0, len(data) - 1))], 0).astype(np.uint8) if len(data) else np.zeros((0, length), np.uint8), row


def fit(texts: list[str], langs: list[str], hidden: int = 12, dim: int = 8, steps: int = 220, batch: int = 128, length: int = 64, seed: int = 5) -> Network:
    """A network trained with Adam on segments drawn evenly from the languages."""
    rng = np.random.default_rng(seed)
    names = sorted(set(langs))
    y = np.array([names.index(x) for x in langs])
    data, offs = text_bytes(pa.array(texts, pa.large_string()))
    seg, row = segments(data, offs, length)
    by = [np.flatnonzero(y[row] == k) for k in range(len(names))]
    draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[-1])).astype(np.float32)
    w = dim + hidden + 1
    net = Network(names, draw(256, dim) * 2, [draw(2 * hidden, w) for _ in "12"], [draw(hidden, w) for _ in "12"], draw(len(names), 2 * hidden + 1))
    theta = [net.emb, *net.gates, *net.cand, net.out]
    m, v = [np.zeros_like(x) for x in theta], [np.zeros_like(x) for x in theta]
    if len(names) < 2:
        return net
    for i in range(1, steps + 1):
        pick = np.concatenate([rng.choice(b, max(2, batch // len(names))) for b in by if len(b)])
        _, g = _gradients(net, seg[pick], y[row[pick]])
        norm = np.sqrt(sum(float((x * x).sum()) for x in g))
        rate = 0.02 * min(1.0, 2.0 * (1 - i / (steps + 1)))
        for x, gx, mx, vx in zip(theta, g, m, v, strict=True):
            gx = gx * min(1.0, 1.0 / (norm + 1e-9))
            mx += 0.1 * (gx - mx)
            vx += 0.01 * (gx * gx - vx)
            x -= (rate * (mx / (1 - 0.9**i)) / (np.sqrt(vx / (1 - 0.99**i)) + 1e-8)).astype(np.float32)
    return net


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_class: int = 300, most_chars: int = 4000) -> Network | None:
    """A network from at most ``per_class`` texts of each language outside the held-out fold,
    each of which gives at most ``most_chars`` characters from its middle. None if there is
    no labelled text."""
    d = df.select(df[id_col].alias("doc_id"), df[text_col].alias("text"), df[lang_col].alias("lang"))
    d = d.filter((fold("doc_id") != 0) & F.col("lang").isNotNull() & F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    n = F.length("text")
    at = F.greatest(F.floor((n - most_chars) / 2), F.lit(0)).cast("int") + 1
    got = sample(d.withColumn("text", F.substr("text", at, F.lit(most_chars))), "lang", per_class, "doc_id")
    return fit(list(got["text"]), list(got["lang"])) if len(got) else None


def predict(df: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text", at_once: int = 2048) -> DataFrame:
    """A row for each row of ``df``: fold, predicted language, its pooled probability, and the
    number of labelled positions (bytes).

    Null texts and texts without a letter are ``und`` with score 0, as is every text when
    there is no network. Repeated rows are labelled each; other columns are ignored; an empty
    table gives no rows.
    """
    spark = df.sparkSession
    on_workers(spark)
    docs = df.select(
        df[id_col].alias("doc_id"), (fold(df[id_col]) == 0).alias("held_out"),
        F.coalesce(df[text_col].rlike(r"\p{L}"), F.lit(False)).alias("letters"), df[text_col].alias("text"),
    )
    held = spark.sparkContext.broadcast(net)

    def run(batches):
        model = held.value
        for whole in batches:
            for b in pieces_of(whole, "text"):
                data, offs = text_bytes(b.column(3))
                n = b.num_rows
                ok = np.asarray(b.column(2).to_pylist(), bool)
                best, top = np.zeros(n, np.int64), np.zeros(n)
                if model is not None:
                    seg, row = segments(data, offs, SEGMENT)
                    total = np.zeros((n, len(model.langs)))
                    for i in range(0, len(seg), at_once):
                        s = seg[i : i + at_once]
                        p = (model.label(s) * (s.T != 0)[:, None, :]).sum(0)  # L, B
                        for k in range(len(model.langs)):
                            total[:, k] += np.bincount(row[i : i + at_once], p[k], n)
                    total /= np.maximum(total.sum(1, keepdims=True), 1e-9)
                    best, top = total.argmax(1), np.clip(total.max(1), 0, 1)
                ok &= model is not None
                names = [model.langs[k] if o else UNKNOWN for k, o in zip(best, ok, strict=True)]
                cols = [b.column(0), b.column(1), pa.array(names), pa.array(np.where(ok, top, 0.0)), pa.array(np.diff(offs))]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "held_out", "lang_pred", "score", "n_positions"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {OUT}")
