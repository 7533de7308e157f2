"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Learning rates are per coordinate and L1 keeps most weights at zero, so the model is a short list of
(feature hash, weight) that every task can hold. Shards of a bounded, documented sample of labelled
rows are learnt in parallel, and their weights averaged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .sampling import labelled_sample

WORD = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Params:
    """sample_rows bounds the labelled rows learnt from, whole texts of any length (at most half of them label 1, and
    ``negatives`` of label 0 for each of these, or 1,000). Shards have some shard_rows of them, or shard_bytes.

    A feature takes part where ``min_rows`` texts of its shard hold it (in a shard of under 200 rows fewer, down to
    one), as one seen in a single text could only memorise that text. ``l1_share`` times the rows of the shard is the
    L1 term. At the default L1 some hundreds of weights are left; more than ``max_weights`` are an error that asks for
    a larger one, as they could not be broadcast.
    """

    sample_rows: int = 16_384
    shard_rows: int = 4_096
    shard_bytes: int = 32 << 20
    negatives: int = 2
    min_rows: int = 3
    epochs: int = 10
    alpha: float = 2.0
    beta: float = 1.0
    l1_share: float = 0.002
    l2: float = 0.0
    max_weights: int = 200_000


def parts(text: str | None, most: int = 1 << 16) -> Iterator[np.ndarray]:
    """64-bit hashes of the words, word pairs and pairs over one word of the whole text, some words at a time."""
    found = WORD.finditer((text or "").lower())
    before = np.zeros(0, np.uint64)
    while len(new := np.fromiter((xxhash.xxh64_intdigest(m.group()) for m in islice(found, most)), np.uint64)):
        h, k = np.concatenate([before, new]), len(before)
        pairs = (h[:-1] * _MIX) ^ (h[1:] + np.uint64(1))
        skips = (h[:-2] * _MIX) ^ (h[2:] + np.uint64(2))
        yield np.concatenate([new, pairs[max(0, k - 1) :], skips[max(0, k - 2) :]])
        before = h[-2:]


def features(text: str | None) -> np.ndarray:
    """All hashes of a text, those of a place that is looked at first included."""
    return np.concatenate([np.zeros(0, np.uint64), *parts(text)])


def _frequent(texts: list[str | None], least: int, buckets: int = 1 << 23) -> list[np.ndarray]:
    """Distinct features of each text, without most of those that fewer than ``least`` texts hold.

    The first reading counts texts by bucket, never too few for any feature in it; only the second keeps hashes, so
    the memory needed is that of features which may be learnt.
    """
    mask, most = np.uint64(buckets - 1), np.iinfo(np.uint16).max
    counts = np.zeros(buckets, np.uint16)
    for t in texts:
        at = np.unique(np.concatenate([np.zeros(0, np.int64), *[np.unique((f & mask).astype(np.int64)) for f in parts(t)]]))
        counts[at] = np.minimum(counts[at], most - 1) + 1  # once a text, however often it holds the bucket
    out = []
    for t in texts:
        out.append(np.unique(np.concatenate([np.zeros(0, np.uint64), *[np.unique(f[counts[(f & mask).astype(np.int64)] >= min(least, most)]) for f in parts(t)]])))
    return out


def _learn_shard(p: Params):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        common.kept("fit of toxicity")
        rows = rows.sort_values("order")  # the same at every run
        least = min(p.min_rows, 1 + len(rows) // 100)
        docs = _frequent(rows["text"].tolist(), least)
        labels = rows["y"].to_numpy(float)
        space, held = np.unique(np.concatenate([np.zeros(0, np.uint64), *docs]), return_counts=True)
        space = space[held >= least]
        spot = [np.minimum(np.searchsorted(space, d), max(len(space) - 1, 0)) for d in docs]
        at = [np.concatenate([i[space[i] == d] if len(space) else i[:0], [len(space)]]) for i, d in zip(spot, docs, strict=True)]  # last: intercept
        z, n = np.zeros(len(space) + 1), np.zeros(len(space) + 1)
        l1 = np.full(len(space) + 1, p.l1_share * len(docs))
        l1[-1] = 0.0

        def weights(i):
            zi = z[i]
            return np.where(np.abs(zi) <= l1[i], 0.0, -(zi - np.sign(zi) * l1[i]) / ((p.beta + np.sqrt(n[i])) / p.alpha + p.l2))

        for _ in range(p.epochs):
            for i, y in zip(at, labels, strict=True):
                w = weights(i)
                g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y
                step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / p.alpha
                z[i] += g - step * w
                n[i] += g * g
        w = weights(np.arange(len(space) + 1))
        kept = np.flatnonzero(w[:-1])
        return pd.DataFrame({"feature": np.concatenate([space[kept].view(np.int64), [0]]), "intercept": np.arange(len(kept) + 1) == len(kept), "weight": np.concatenate([w[kept], w[-1:]])})

    return run


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", params: Params | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """(feature hashes, weights, intercept) learnt from a bounded sample of the labelled rows of ``docs``.

    See labelled_sample() for the rows that may be learnt from. No such rows: an empty model.
    """
    p = params or Params()

    def shares(n: dict[bool, int]) -> dict[bool, int]:
        toxic = min(n.get(True, 0), p.sample_rows // 2)
        return {True: toxic, False: min(p.sample_rows - toxic, max(p.negatives * toxic, 1_000))}

    usable, n, taken = labelled_sample(docs, labels, label_col, shares, "toxicity")
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0), -3.0
    usable = common.written(usable)
    size = usable.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-sum(taken.values()) // p.shard_rows), -(-size // p.shard_bytes))
    learnt = usable.withColumn("shard", F.pmod(F.xxhash64("order"), F.lit(shards))).groupBy("shard").applyInPandas(_learn_shard(p), "feature long, intercept boolean, weight double")
    mean = learnt.groupBy("feature", "intercept").agg((F.sum("weight") / shards).alias("weight"))
    rows = mean.limit(p.max_weights + 2).toPandas()
    if len(rows) > p.max_weights + 1:
        raise ValueError(f"more than {p.max_weights} weights: raise l1_share")
    intercept = float(rows.loc[rows["intercept"], "weight"].sum())
    if all(taken.values()):  # back from the sample's odds to those of all labelled rows
        intercept += float(np.log(n[True] / n[False]) - np.log(taken[True] / taken[False]))
    rows = rows[~rows["intercept"]]
    keys = rows["feature"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], rows["weight"].to_numpy(float)[order], intercept


def _score(model):
    keys, weights, intercept = model
    mask = np.uint64((1 << 20) - 1)
    likely = np.zeros(1 << 20, bool)
    likely[(keys & mask).astype(np.int64)] = True

    def one(text):
        f = np.unique(np.concatenate([keys[:0], *[p[likely[(p & mask).astype(np.int64)]] for p in parts(text)]]))
        if not len(f) or not len(keys):
            return intercept
        at = np.minimum(np.searchsorted(keys, f), len(keys) - 1)
        return intercept + float(weights[at][keys[at] == f].sum())

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        common.kept("scores of toxicity")
        for texts in batches:
            logit = np.array([one(t) for t in texts], float)
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(logit, -35, 35))))

    return F.pandas_udf(run, "double")


def score(docs: DataFrame, model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``: the probability of label 1, from the whole text and nothing else.

    Null and empty texts, and texts without known features, get the intercept's probability. Rows are
    neither dropped nor merged. An existing column named ``out`` is replaced.
    """
    return docs.withColumn(out, _score(model)(F.col(text_col)))


def judge(docs: DataFrame, labels: DataFrame, params: Params | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``; a null id counts as not held out."""
    model = fit(docs, labels, "toxic", params)
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(common.held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, params: Params | None = None, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, with their own columns only."""
    model = fit(docs, labels, "toxic", params)
    name = common.spare(docs, "score")
    return score(docs, model, out=name).where(F.col(name) < threshold).drop(name)
