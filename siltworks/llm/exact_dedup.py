"""Exact dedup by an exchange of Golomb-coded fingerprints.

1. Each partition of the input fingerprints its texts, and sends every *owner* (a range of the
   64-bit fingerprint space) one sorted, Golomb-Rice-coded list of its distinct fingerprints, with a
   bit for those that it holds more than once.
2. An owner merges the lists it got and answers each with a bitmap: 1 = held elsewhere, or twice.
3. The bitmaps go back to the partitions, which turn them into *suspect* rows.
4. Only the suspects' texts are shuffled and compared byte for byte. Everything else is single.

A fingerprint travels once per partition, however many copies the partition holds, and the byte
comparison is a hash aggregate over the text itself, combined before its shuffle: a group with a
third of all rows costs each task one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Fingerprints that one owner merges, about (there are more owners where rows are many).
OWNER_ROWS = 1_000_000
#: Suspect ids are broadcast up to this many bytes (8 each), and joined by a shuffle beyond.
BROADCAST_BYTES = 16 << 20


def rice_encode(values: np.ndarray) -> bytes:
    """Sorted distinct uint64 -> gaps in Golomb-Rice code: parameter byte, low bits of all gaps, unary quotients of all."""
    if not len(values):
        return b""
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    gaps[1:] -= np.uint64(1)
    # the first value counts from the start of the owner's range, so one parameter suits all
    k = max(int(np.log2(max(float(gaps.mean()), 1.0))), 0)
    quotient = (gaps >> np.uint64(k)).astype(np.int64)
    low = np.zeros((len(gaps), k), np.uint8)
    for j in range(k):
        low[:, j] = (gaps >> np.uint64(k - 1 - j)) & np.uint64(1)
    ends = np.cumsum(quotient + 1)
    unary = np.ones(ends[-1], np.uint8)
    unary[ends - 1] = 0  # so many ones, ended by a 0
    return bytes([k]) + np.packbits(low).tobytes() + np.packbits(unary).tobytes()


def rice_decode(data: bytes, n: int) -> np.ndarray:
    """The ``n`` values that rice_encode() coded."""
    if not n:
        return np.zeros(0, np.uint64)
    k = data[0]
    low = np.unpackbits(np.frombuffer(data, np.uint8, offset=1), count=n * k).reshape(n, k)
    unary = np.unpackbits(np.frombuffer(data, np.uint8, offset=1 - (-n * k // 8)))
    ends = np.flatnonzero(unary == 0)[:n]
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(k)
    for j in range(k):
        gaps |= low[:, j].astype(np.uint64) << np.uint64(k - 1 - j)
    gaps[1:] += np.uint64(1)
    return np.cumsum(gaps, dtype=np.uint64)


def _send(owners: int):
    width = (1 << 64) // owners + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        src = int(parts[0]["src"].iloc[0])
        fps = np.concatenate([b["fp"].to_numpy(np.int64) for b in parts]).view(np.uint64)
        distinct, counts = np.unique(fps, return_counts=True)
        cuts = np.searchsorted(distinct, np.array([min(i * width, (1 << 64) - 1) for i in range(1, owners)], np.uint64))
        rows = []
        for owner, (own, many) in enumerate(zip(np.split(distinct, cuts), np.split(counts > 1, cuts), strict=True)):
            if len(own):
                rows.append((src, owner, len(own), rice_encode(own - np.uint64(owner * width)), np.packbits(many).tobytes()))
        yield pd.DataFrame(rows, columns=["src", "owner", "n", "codes", "many"])

    return run


def _own(key: tuple, lists: pd.DataFrame) -> pd.DataFrame:
    values = [rice_decode(c, n) for c, n in zip(lists["codes"], lists["n"], strict=True)]
    merged = np.sort(np.concatenate(values))
    twice = np.unique(merged[1:][merged[1:] == merged[:-1]])
    maps = []
    for v, many, n in zip(values, lists["many"], lists["n"], strict=True):
        held = np.unpackbits(np.frombuffer(many, np.uint8), count=n).astype(bool)
        maps.append(np.packbits(held | np.isin(v, twice, assume_unique=True)).tobytes())
    return pd.DataFrame({"src": lists["src"], "owner": lists["owner"], "n": lists["n"], "bitmap": maps})


def _mark(rows: pd.DataFrame, maps: pd.DataFrame) -> pd.DataFrame:
    """Suspect fingerprints of one partition, and its rows with each: the bitmaps, by owner, follow its sorted fingerprints."""
    if not len(rows) or not len(maps):
        return pd.DataFrame({"fp": pd.Series([], dtype="int64"), "size": pd.Series([], dtype="int64")})
    maps = maps.sort_values("owner")
    bits = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(maps["bitmap"], maps["n"], strict=True)])
    fps, sizes = np.unique(rows["fp"].to_numpy(np.int64).view(np.uint64), return_counts=True)
    return pd.DataFrame({"fp": fps[bits == 1].view(np.int64), "size": sizes[bits == 1]})


def suspects(keyed: DataFrame) -> DataFrame:
    """(fp, size) of every fingerprint that occurs again, and how many rows have it. ``keyed``: checkpointed (fp, src).

    ``src`` is the row's partition; the checkpoint keeps it so when tasks are repeated.
    """
    owners = max(1, int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-keyed.count() // OWNER_ROWS))
    lists = keyed.select("src", "fp").mapInPandas(_send(owners), "src int, owner int, n int, codes binary, many binary")
    maps = lists.groupBy("owner").applyInPandas(_own, "src int, owner int, n int, bitmap binary")
    found = keyed.select("src", "fp").groupBy("src").cogroup(maps.groupBy("src")).applyInPandas(_mark, "fp long, size long")
    return found.groupBy("fp").agg(F.sum("size").alias("size"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, keep_id, group_size, kept, text_sha256), one row for each row of ``docs``.

    Texts are equal when their UTF-8 bytes are; a null text counts as empty. In a group the row with
    the largest id stays; a null id sorts below every other. Rows that repeat both id and text count
    in group_size, and all of them say kept (drop_copies() leaves one). An empty table gives an empty
    result. Other columns of ``docs``, whatever their names, play no part.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("id"), text.alias("t"), F.xxhash64(text).alias("fp"))
    # one scan fingerprints the texts; the exchange then reads some 60 bytes a row
    keyed = common.cut(base.select("id", "fp", F.sha2("t", 256).alias("sha"), F.spark_partition_id().alias("src")))
    found = common.cut(suspects(keyed))
    if found.count() * 8 <= BROADCAST_BYTES:
        again = base.join(F.broadcast(found.select("fp")), "fp", "left_semi")
    else:
        again = common.spread_join(base, found, ["fp"])
    # byte verification: only rows under suspect fingerprints move, grouped by the text itself
    groups = again.groupBy("t").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = common.cut(groups.where("group_size > 1").select(F.sha2("t", 256).alias("sha"), "keep_id", "group_size", F.col("group_size").alias("size")))
    keep = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return common.spread_join(keyed, groups, ["sha"], how="left").select(
        F.col("id").alias(id_col), keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), F.col("id").eqNullSafe(keep).alias("kept"), F.col("sha").alias("text_sha256")
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one with the largest id.

    Ids name documents here: a row goes if its id and text are those of a dropped row. Null ids stay
    where no other row has their text; of rows that repeat both id and text one stays.
    """
    groups = common.cut(exact_groups(docs, id_col, text_col).where("group_size > 1"))
    sha, gone = common.spare(docs, "sha"), groups.where("not kept").select(F.col(id_col).alias("id"), F.col("text_sha256").alias("sha"))
    rows = docs.withColumn(sha, F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    if gone.count() * 80 <= BROADCAST_BYTES:
        gone = F.broadcast(gone)
    left = rows.join(gone, rows[id_col].eqNullSafe(gone["id"]) & (rows[sha] == gone["sha"]), "left_anti")
    repeats = groups.where("kept").groupBy(id_col, "text_sha256").count().where("count > 1").limit(1)
    if repeats.count():
        left = left.dropDuplicates([id_col, sha])
    return left.drop(sha)
