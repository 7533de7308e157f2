"""Best-fit packing of tokenised documents, improved by swap-based local search.

Documents are cut into pieces of at most ``capacity`` tokens; full pieces are sequences by themselves.
The others are dealt to shards of bounded size (some ``shard_pieces`` each, by a hash, so no shard grows
with the input), and each shard is packed best fit decreasing and then searched: moves, one-for-one and
two-for-one exchanges between underfull bins that raise the sum of squared fills, until bins run empty.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, vocab

SHARD_PIECES = 16_384


def encode(text: str | None, path: str, end_id: int = 0) -> np.ndarray:
    """The ids of the whole text, then ``end_id``.

    No token of this vocabulary spans white space, so a text's ids are those of the pieces between
    spaces and line feeds, one after another; each distinct piece is encoded once.
    """
    return encode_many([text], path, end_id)[0]


def encode_many(texts: list[str | None], path: str, end_id: int = 0) -> list[np.ndarray]:
    pieces = [(t or "").replace("\n", " ").split(" ") for t in texts]
    last = np.array([end_id], "<u4").tobytes()
    return [np.frombuffer(b"".join([*v, last]), "<u4") for v in vocab.memory(path, "ids").each(pieces)]


def _cut(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for a in range(0, len(rows), 256):
                part = rows.iloc[a : a + 256]
                out = []
                for row, text in zip(part["row"], encode_many(part["text"].tolist(), path, end_id), strict=True):
                    for k, s in enumerate(range(0, len(text), capacity)):
                        ids = text[s : s + capacity]
                        out.append((row, k, s, len(ids), zlib.crc32(ids)))
                yield pd.DataFrame(out, columns=["row", "piece", "start", "length", "ids_crc32"])

    return run


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of indices, best fit decreasing. Open bins are kept by free space."""
    free_sorted: list[int] = []  # distinct free spaces that some bin has
    by_free: dict[int, list[int]] = {}
    bins: list[list[int]] = []

    def put(b: int, free: int):
        if free:
            if not by_free.get(free):
                by_free[free] = []
                insort(free_sorted, free)
            by_free[free].append(b)

    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        k = bisect_left(free_sorted, n)
        if k == len(free_sorted):
            bins.append([i])
            put(len(bins) - 1, capacity - n)
            continue
        free = free_sorted[k]
        b = by_free[free].pop()
        if not by_free[free]:
            free_sorted.pop(k)
        bins[b].append(i)
        put(b, free - n)
    return bins


def _exchange(mine: list[int], theirs: list[int], free: int, size: list[int]) -> tuple[list[int], list[int], int]:
    """(given, taken, gain): what fills the other bin's gap best, by a move, one for one or two for one. Items in order of size."""
    sizes = [size[i] for i in mine]
    k = bisect_right(sizes, free) - 1
    give, take, gain = ([mine[k]], [], sizes[k]) if k >= 0 else ([], [], 0)
    for j in theirs:
        room = free + size[j]
        k = bisect_right(sizes, room) - 1
        if k >= 0 and sizes[k] - size[j] > gain:
            give, take, gain = [mine[k]], [j], sizes[k] - size[j]
        lo, hi = 0, len(mine) - 1  # the largest pair that fits
        while lo < hi:
            both = sizes[lo] + sizes[hi]
            if both > room:
                hi -= 1
            else:
                if both - size[j] > gain:
                    give, take, gain = [mine[lo], mine[hi]], [j], both - size[j]
                lo += 1
        if gain == free:
            break
    return give, take, gain


def _improve(block: list[int], bins: list[list[int]], fill: list[int], size: list[int], capacity: int) -> None:
    """Exchanges among some bins until none raises the sum of squared fills."""
    changed = dict.fromkeys(block, 0)  # when a bin last changed
    seen: dict[tuple[int, int], int] = {}
    clock, again = 1, True
    while again:
        again = False
        order = sorted((b for b in block if 0 < fill[b] < capacity), key=lambda b: fill[b])
        for at, poor in enumerate(order):
            for rich in reversed(order[at + 1 :]):
                if not bins[poor]:
                    break
                if fill[rich] == capacity or fill[rich] < fill[poor] or seen.get((poor, rich), 0) > max(changed[poor], changed[rich]):
                    continue
                clock += 1
                seen[poor, rich] = clock
                give, take, gain = _exchange(bins[poor], bins[rich], capacity - fill[rich], size)
                if gain > 0:  # filling the fuller bin raises the sum of squares
                    bins[poor] = sorted([i for i in bins[poor] if i not in give] + take, key=lambda i: size[i])
                    bins[rich] = sorted([i for i in bins[rich] if i not in take] + give, key=lambda i: size[i])
                    fill[poor] -= gain
                    fill[rich] += gain
                    clock += 1
                    changed[poor] = changed[rich] = clock
                    again = True


def search(bins: list[list[int]], lengths: np.ndarray, capacity: int, block: int = 128) -> list[list[int]]:
    """Moves, one-for-one and two-for-one exchanges between underfull bins, each raising the squared fill.

    A bin gives to fuller ones: a move fills a gap, an exchange replaces one item of the other bin by one, or
    two, that fill it better. Bins that run empty go. A pass deals all underfull bins to blocks (by another shuffle
    each time) and searches each of them to its fixed point. It ends when no packing could do with fewer bins, or
    when two passes in a row have emptied no bin.
    """
    size = lengths.tolist()
    bins = [sorted(b, key=lambda i: size[i]) for b in bins]
    fill = [sum(size[i] for i in b) for b in bins]
    least, r, idle = -(-sum(size) // capacity), np.random.default_rng(7), 0
    while idle < 2 and (count := sum(1 for b in bins if b)) > least:
        order = np.array([b for b in range(len(bins)) if 0 < fill[b] < capacity])
        r.shuffle(order)
        for part in np.array_split(order, max(1, -(-len(order) // block))):
            _improve(part.tolist(), bins, fill, size, capacity)
        idle = 0 if sum(1 for b in bins if b) < count else idle + 1
    return [b for b in bins if b]


def _pack(capacity: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["row", "piece"], ignore_index=True)
        lengths = rows["length"].to_numpy(np.int64)
        bins = search(best_fit(lengths, capacity), lengths, capacity)
        seq, off = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for n, b in enumerate(bins):
            at = 0
            for i in b:
                seq[i], off[i] = n, at
                at += lengths[i]
        return rows.assign(sequence_id=(int(key[0]) << 32) + seq, offset=off)[["row", "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    return run


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row per piece: row, id_col, piece, start, length, ids_crc32, sequence_id, offset.

    ``row`` numbers the rows of ``docs``, so that rows that repeat an id are packed apart. Null and
    empty texts have the one token ``end_id``. Ids may be null. Only documents of more than
    ``capacity`` tokens are cut; a piece of exactly ``capacity`` fills a sequence. An empty table gives
    an empty result; columns of ``docs`` other than id and text play no part.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = _cut(path, capacity, end_id)
        for b in batches:
            ids = dict(zip(b["row"], b["doc_id"], strict=True))
            for out in step(iter([b])):
                yield out.assign(doc_id=pd.array([None if pd.isna(ids[r]) else int(ids[r]) for r in out["row"]], dtype="Int64"))

    pieces = common.cut(rows.mapInPandas(cut, "row long, piece int, start long, length long, ids_crc32 long, doc_id long"))
    full, rest = pieces.where(F.col("length") == capacity), pieces.where(F.col("length") < capacity)
    n = rest.count()
    shards = max(1, -(-n // shard_pieces))
    packed = rest.withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards))).groupBy("shard").applyInPandas(_pack(capacity), "row long, doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    alone = full.select("row", "doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone).withColumnRenamed("doc_id", id_col) if id_col != "doc_id" else packed.unionByName(alone)
