"""A bounded, repeatable sample of labelled texts, for the classifiers to learn from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, shares: Callable[[dict[bool, int]], dict[bool, int]], seed: str) -> tuple[DataFrame, dict[bool, int], dict[bool, int]]:
    """(sample, n, taken): rows (order, text, y); labelled documents of each label; how many the sample aims at.

    Held-out rows, null ids and null labels are left out, and labels of documents that are not in ``docs``; a
    document labelled twice has its largest label; of several texts with one id the one with the smallest hash
    is learnt from. Texts of any length take part, whole. ``shares`` turns the counts of each label into the bounded numbers to take. Ids are taken by a
    hash threshold, so the sample is the same at every run and needs no sort. Only the chosen ids (bounded by
    ``shares``) are broadcast; the texts are scanned once and only those chosen leave their task.
    """
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed))
    known = labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull() & ~common.held_out())
    known = known.groupBy("doc_id").agg((F.max(label_col) > 0.5).alias("y"))
    known = common.cut(known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").withColumn("order", order))
    n = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    taken = {y: min(n.get(y, 0), k) for y, k in shares(n).items()}
    cut = {y: min(int(-(2**63) + (taken[y] / n[y] if n.get(y) else 0.0) * 2**64), 2**63 - 1) for y in (True, False)}
    chosen = known.where(F.col("order") <= F.when(F.col("y"), F.lit(cut[True])).otherwise(F.lit(cut[False])))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    one = texts.groupBy("doc_id", "order", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
    return one.select("order", F.col("t.text").alias("text"), "y"), n, taken
