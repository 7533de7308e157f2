"""Quality: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into chunks that overlap by the filter width and cover all of it. In a
chunk, learned filters slide over byte embeddings and keep their maximum; a dense layer reads the
chunk's maxima (and so sees how varied a chunk is); its units are max-pooled over all chunks of the
document and combined into one probability. Memory is bounded by ``batch_chunks`` chunks, whatever the
text's length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .sampling import labelled_sample


@dataclass(frozen=True)
class Params:
    """sample_rows bounds the labelled rows learnt from; their texts take part whole."""

    sample_rows: int = 2_400
    chunk: int = 384
    width: int = 8
    stride: int = 2
    embed: int = 6
    filters: int = 32
    hidden: int = 24
    epochs: int = 8
    batch: int = 24
    rate: float = 0.004
    batch_chunks: int = 64
    seed: int = 7


def chunks(text: str | None, p: Params) -> np.ndarray:
    """(n, chunk + width) bytes of the whole text; the last chunk is padded with 0, an empty text is one chunk of 0."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    n = max(1, -(-len(data) // p.chunk))
    padded = np.zeros(n * p.chunk + p.width, np.uint8)
    padded[: len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(padded, p.chunk + p.width)[:: p.chunk]


def _windows(x: np.ndarray, w: dict, p: Params) -> np.ndarray:
    """(n, positions, width * embed) embedded windows of chunks ``x``."""
    e = w["embed"][x]  # n, bytes, embed
    n, size, d = e.shape
    view = np.lib.stride_tricks.as_strided(e, (n, (size - p.width) // p.stride + 1, p.width * d), (e.strides[0], p.stride * d * e.itemsize, e.itemsize))
    return view


def _maxima(x: np.ndarray, w: dict, p: Params):
    win = _windows(x, w, p)
    n, k, d = win.shape
    conv = np.ascontiguousarray(win).reshape(n * k, d) @ w["conv"]
    return conv.reshape(n, k, -1), win


def _units(x: np.ndarray, w: dict, p: Params) -> np.ndarray:
    """Hidden units of each chunk."""
    conv, _ = _maxima(x, w, p)
    return np.maximum(np.maximum(conv.max(1) + w["conv_b"], 0) @ w["dense"] + w["dense_b"], 0)


def _start(p: Params) -> dict:
    r = np.random.default_rng(p.seed)
    f = np.float32
    return {
        "embed": r.normal(0, 0.5, (256, p.embed)).astype(f),
        "conv": r.normal(0, (2 / (p.width * p.embed)) ** 0.5, (p.width * p.embed, p.filters)).astype(f),
        "conv_b": np.zeros(p.filters, f),
        "dense": r.normal(0, (2 / p.filters) ** 0.5, (p.filters, p.hidden)).astype(f),
        "dense_b": np.zeros(p.hidden, f),
        "out": r.normal(0, 0.3, p.hidden).astype(f),
        "out_b": np.zeros(1, f),
    }


def _winners(docs: list[np.ndarray], w: dict, p: Params) -> list[np.ndarray]:
    """The chunks of each document that have the greatest value of a unit, in order; only these pass gradients on."""
    out = []
    for d in docs:
        if len(d) > p.hidden:
            h = np.concatenate([_units(d[a : a + p.batch_chunks], w, p) for a in range(0, len(d), p.batch_chunks)])
            d = d[np.unique(h.argmax(0))]
        out.append(d)
    return out


def _gradients(docs: list[np.ndarray], y: np.ndarray, weight: np.ndarray, w: dict, p: Params) -> dict:
    """Of the weighted mean log loss over ``docs``, by hand; only the maxima pass gradients on."""
    x = np.concatenate(docs)
    sizes = np.array([len(d) for d in docs])
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    conv, win = _maxima(x, w, p)
    at = conv.argmax(1)  # n, filters
    top = np.take_along_axis(conv, at[:, None, :], 1)[:, 0] + w["conv_b"]
    m = np.maximum(top, 0)
    pre = m @ w["dense"] + w["dense_b"]
    h = np.maximum(pre, 0)
    pooled = np.maximum.reduceat(h, first, 0)
    prob = 1 / (1 + np.exp(-np.clip(pooled @ w["out"] + w["out_b"], -30, 30)))
    d_out = ((prob - y) * weight / len(docs)).astype(np.float32)
    g = {"out": pooled.T @ d_out, "out_b": d_out.sum(keepdims=True)}
    d_pool = np.outer(d_out, w["out"])
    d_h = np.zeros_like(h)
    for i, (a, n) in enumerate(zip(first, sizes, strict=True)):
        d_h[a + h[a : a + n].argmax(0), np.arange(h.shape[1])] += d_pool[i]
    d_h *= pre > 0
    g["dense"], g["dense_b"] = m.T @ d_h, d_h.sum(0)
    d_m = (d_h @ w["dense"].T) * (top > 0)
    g["conv_b"] = d_m.sum(0)
    c, f = np.nonzero(d_m)
    picked = win[c, at[c, f]]  # the windows that won
    g["conv"] = np.zeros_like(w["conv"])
    np.add.at(g["conv"].T, f, picked * d_m[c, f][:, None])
    d_win = (w["conv"].T[f] * d_m[c, f][:, None]).reshape(len(c), p.width, p.embed)
    spots = x[c[:, None], (at[c, f] * p.stride)[:, None] + np.arange(p.width)]
    g["embed"] = np.zeros_like(w["embed"])
    np.add.at(g["embed"], spots.ravel(), d_win.reshape(-1, p.embed))
    return g


def learn(texts: list[str | None], labels: np.ndarray, p: Params, weight: np.ndarray | None = None) -> dict:
    """Weights of the network after ``epochs`` passes of Adam over the given rows, in a fixed order."""
    r, w = np.random.default_rng(p.seed), _start(p)
    docs, weight = [chunks(t, p) for t in texts], np.ones(len(texts)) if weight is None else weight
    m, v, t = {k: np.zeros_like(x) for k, x in w.items()}, {k: np.zeros_like(x) for k, x in w.items()}, 0
    steps = p.epochs * max(1, -(-len(docs) // p.batch))
    for _ in range(p.epochs):
        order = r.permutation(len(docs))
        for a in range(0, len(order), p.batch):
            i = order[a : a + p.batch]
            t += 1
            rate = p.rate * min(1.0, 2.5 * (1 - t / (steps + 1)))
            for k, g in _gradients(_winners([docs[j] for j in i], w, p), labels[i], weight[i], w, p).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                w[k] -= (rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-7)).astype(np.float32)
    return w


def probability(texts, w: dict, p: Params) -> np.ndarray:
    """Of label 1, for each text. Chunks of neighbouring texts are worked on together."""
    out = np.zeros(len(texts))
    held, owner = [], []

    def flush():
        if held:
            h = _units(np.concatenate(held), w, p)
            np.maximum.at(pooled, np.concatenate(owner), h)
            held.clear()
            owner.clear()

    pooled = np.zeros((len(texts), p.hidden), np.float32)  # units are 0 or more
    n = 0
    for i, t in enumerate(texts):
        c = chunks(t, p)
        for a in range(0, len(c), p.batch_chunks):
            held.append(c[a : a + p.batch_chunks])
            owner.append(np.full(len(held[-1]), i))
            n += len(held[-1])
            if n >= p.batch_chunks:
                flush()
                n = 0
    flush()
    out[:] = 1 / (1 + np.exp(-np.clip(pooled.astype(float) @ w["out"].astype(float) + float(w["out_b"][0]), -30, 30)))
    return out


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", params: Params | None = None) -> dict | None:
    """The network, learnt in one task from a sample of at most ``sample_rows`` labelled rows of ``docs``.

    See labelled_sample() for the rows that may be learnt from. Half of the sample has label 0 as far as
    there are such rows; losses are weighted so that the odds of all labelled rows hold. None without rows.
    """
    p = params or Params()

    def shares(n: dict[bool, int]) -> dict[bool, int]:
        bad = min(n.get(False, 0), p.sample_rows // 2)
        return {False: bad, True: p.sample_rows - bad}

    sample, n, taken = labelled_sample(docs, labels, label_col, shares, "quality")
    if not n:
        return None
    share = {y: n.get(y, 0) / sum(n.values()) / max(taken[y] / sum(taken.values()), 1e-9) for y in taken}

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        common.kept("fit of quality")
        part = part.sort_values("order")
        y = part["y"].to_numpy(bool)
        w = learn(part["text"].tolist(), y.astype(np.float32), p, np.where(y, share[True], share[False]))
        return pd.DataFrame({"name": list(w), "values": [x.ravel().astype("<f4").tobytes() for x in w.values()]})

    learnt = sample.groupBy(F.lit(0).alias("all")).applyInPandas(run, "name string, values binary").collect()  # some 15 KB
    shape = _start(p)
    return {r["name"]: np.frombuffer(r["values"], "<f4").reshape(shape[r["name"]].shape) for r in learnt}


def score(docs: DataFrame, model: dict | None, params: Params | None = None, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``: the probability of label 1, from every byte of the text and nothing else.

    Null counts as empty; an empty text has one chunk of zeros and so one fixed score. Without a model
    (no labelled rows) every score is 0.5. Rows are neither dropped nor merged; an existing column
    named ``out`` is replaced.
    """
    p = params or Params()

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        common.kept("scores of quality")
        for texts in batches:
            yield pd.Series(probability(texts.tolist(), model, p) if model else np.full(len(texts), 0.5))

    return docs.withColumn(out, F.pandas_udf(run, "double")(F.col(text_col)))


def judge(docs: DataFrame, labels: DataFrame, params: Params | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``; a null id counts as not held out."""
    model = fit(docs, labels, "quality", params)
    scored = score(docs.select("doc_id", "text"), model, params)
    return scored.select("doc_id", F.coalesce(common.held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, params: Params | None = None, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``threshold``, with their own columns only."""
    model = fit(docs, labels, "quality", params)
    name = common.spare(docs, "score")
    return score(docs, model, params, out=name).where(F.col(name) >= threshold).drop(name)
