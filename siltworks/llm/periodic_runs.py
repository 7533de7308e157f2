"""Runs of repeated words in whole documents: overlapping tiles for every octave of periods, stitched by period.

A run of period q, with 2^k <= q < 2^(k+1), and at least four periods long holds, after its first word, a multiple b of 2^k
such that the 2^k words from b on come again q words later within the run. So each octave k has a tile for each multiple
of 2^k, from 2^k words before it to 4 * 2^k behind it. A tile whose boundary does not come again in that distance (by hashes of
2^k words, compared for all tiles at once) has no run. In the others Z-functions from the boundary, onwards and backwards,
give the stretch around it that repeats with each such period, as far as the tile reaches. These fragments are
shuffled by document and period and stitched where they share at least one period.

Tiles are solved where the document is read, but those of long documents are dealt to other tasks first.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: A run has at least so many words, and so many periods.
LEAST, TIMES = 6, 4
#: Documents of more words have their tiles dealt to other tasks.
LONG = 4_096
_ODD = np.uint64(0x9E3779B97F4A7C15)


def numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers, equal ones as equal numbers."""
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int32)


def z_function(s: list[int]) -> list[int]:
    """How many items from each place on equal those from the start on."""
    n = len(s)
    z, left, right = [0] * n, 0, 0
    if n:
        z[0] = n
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _primes(q: int) -> list[int]:
    out, p = [], 2
    while p * p <= q:
        if q % p == 0:
            out.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return out + [q] if q > 1 else out


def solve(tile: list[int], before: int, octave: int) -> list[tuple[int, int, int]]:
    """(period, start, stop) around the boundary of a tile, ``before`` words from its start.

    Periods that are multiples of a shorter one are left out: the same run is found with the shorter one.
    """
    step, out = 1 << octave, []
    onwards = z_function(tile[before:])
    found = [q for q in range(step, min(2 * step, len(onwards))) if onwards[q] >= step]
    if not found:
        return out
    back, width = tile[:before][::-1], len(tile)
    other = z_function([*back, -1, *tile[: before + 2 * step][::-1]])
    top = min(width, before + 2 * step)
    for q in found:
        if any(onwards[q // p] >= q - q // p for p in _primes(q)):
            continue
        behind = other[before + 1 + top - before - q] if before else 0  # words before the boundary that come again q later
        out.append((q, before - behind, before + q + onwards[q]))
    return out


def suspects(ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(octave, boundaries whose words come again within the octave's periods), for all octaves that may have a run."""
    n, octave, h = len(ids), 0, ids.astype(np.uint64) * _ODD + np.uint64(1)
    while TIMES << octave <= n and n >= LEAST:
        step = 1 << octave
        at = h[: max(0, len(h) - step) : step]
        if len(at):
            later = h[step:]
            full = np.concatenate([later, np.zeros(-len(later) % step + step, np.uint64)])[: len(at) * step].reshape(len(at), step)
            hit = np.flatnonzero((full == at[:, None]).any(axis=1))
            if len(hit):
                yield octave, hit * step
        h = (h[:-step] ^ (h[:-step] >> np.uint64(29))) * _ODD + h[step:] if len(h) > step else h[:0]
        h ^= h >> np.uint64(32)
        octave += 1


def span(boundary: int, octave: int, n: int) -> tuple[int, int]:
    """First word and end of the tile of a boundary."""
    step = 1 << octave
    return max(0, boundary - step), min(n, boundary + 4 * step)


def stitched(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Fragments of one period that share at least one period, as one."""
    by: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for q, start, stop in found:
        by[q].append((start, stop))
    out = []
    for q, parts in by.items():
        parts.sort()
        a, b = parts[0]
        for start, stop in parts[1:]:
            if start + q <= b:
                b = max(b, stop)
            else:
                out.append((q, a, b))
                a, b = start, stop
        out.append((q, a, b))
    return out


def _fragments(ids: np.ndarray) -> list[tuple[int, int, int]]:
    out = []
    for octave, boundaries in suspects(ids):
        for _, start, stop in stitched(out):  # a tile inside a run of a shorter period has multiples of it only
            if stop - start >= 5 << octave:
                boundaries = boundaries[(boundaries - (1 << octave) < start) | (boundaries + (4 << octave) > stop)]
        for b in boundaries.tolist():
            a, z = span(b, octave, len(ids))
            out += [(q, a + s, a + e) for q, s, e in solve(ids[a:z].tolist(), b - a, octave)]
    return [f for f in stitched(out) if f[2] - f[1] >= max(LEAST, TIMES * f[0])]


def planted(words: list[bytes], doc_id: str | None) -> list[bytes]:
    """The words, of some documents with a periodic end: by crc32 of the id."""
    n = len(words)
    if doc_id is None or not n or (h := zlib.crc32(doc_id.encode())) % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [*words[:a], *(words[a : a + p] * (-(-(n - a) // p)))[: n - a]]


def _read(plant: bool, long: int):
    """Each document: finished where nothing repeats; else its words with fragments, or with tiles to be solved elsewhere."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for row, doc_id, text in zip(b["row"], b["id"], b["text"], strict=True):
                words = (text or "").encode().split()
                if plant:
                    words = planted(words, doc_id)
                ids, fragments, tiles = numbered(words), [], []
                if len(ids) > long:
                    for octave, boundaries in suspects(ids):
                        for group in _strips(boundaries, octave):
                            a, z = span(group[0], octave, len(ids))[0], span(group[-1], octave, len(ids))[1]
                            tiles.append((octave, a, [x - a for x in group], ids[a:z].tobytes()))
                else:
                    fragments = _fragments(ids)
                whole = b" ".join(words)
                open_ = bool(fragments or tiles)
                out.append((row, doc_id, len(words), whole.decode() if open_ else None, None if open_ else hashlib.sha256(whole).hexdigest(), fragments, tiles))
            yield pd.DataFrame(out, columns=["row", "id", "n", "text", "sha256", "fragments", "tiles"])

    return run


def _strips(boundaries: np.ndarray, octave: int, most: int = 16_384) -> Iterator[list[int]]:
    """Boundaries whose tiles overlap, as strips of some ``most`` words, or of a few tiles where one is longer."""
    step = 1 << octave
    cut = np.flatnonzero((np.diff(boundaries) > 5 * step) | (np.diff(boundaries // max(most, 8 * step)) > 0)) + 1
    for part in np.split(boundaries, cut):
        yield part.tolist()


def _solve_strips(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for row, octave, at, boundaries, packed in zip(b["row"], b["octave"], b["at"], b["boundaries"], b["ids"], strict=True):
            ids, found = np.frombuffer(packed, np.int32), []
            for x in map(int, boundaries):
                a, z = span(x, octave, len(ids))
                found += [(q, at + a + s, at + a + e) for q, s, e in solve(ids[a:z].tolist(), x - a, octave)]
            out += [(row, *f) for f in stitched(found)]
        yield pd.DataFrame(out, columns=["row", "period", "start", "stop"])


def runs(fragments: DataFrame) -> DataFrame:
    """(row, start, period, length) of the runs of which (row, period, start, stop) are fragments.

    Stitched by document and period: a stretch goes on where the next fragment shares one period with what came before.
    Of several periods of one stretch the smallest counts.
    """
    each = Window.partitionBy("row", "period").orderBy("start", "stop")
    so_far = F.max("stop").over(each.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(F.col("start") + F.col("period") > so_far, F.lit(True)).cast("int")
    parts = fragments.withColumn("fresh", fresh).withColumn("part", F.sum("fresh").over(each.rowsBetween(Window.unboundedPreceding, 0)))
    whole = parts.groupBy("row", "period", "part").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    whole = whole.where(F.col("stop") - F.col("start") >= F.greatest(F.lit(LEAST), TIMES * F.col("period")))
    return whole.groupBy("row", "start", "stop").agg(F.min("period").alias("period")).select("row", "start", "period", (F.col("stop") - F.col("start")).alias("length"))


def _collapsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for row, doc_id, text, found in zip(b["row"], b["id"], b["text"], b["runs"], strict=True):
            words = text.encode().split()
            keep = np.ones(len(words), bool)
            for r in found if found is not None else ():
                keep[r["start"] + r["period"] : r["start"] + r["length"]] = False
            left = b" ".join(w for w, k in zip(words, keep.tolist(), strict=True) if k)
            out.append((row, doc_id, left.decode(), hashlib.sha256(left).hexdigest(), found))
        yield pd.DataFrame(out, columns=["row", "id", "collapsed", "sha256", "runs"])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False, long: int = LONG) -> tuple[DataFrame, DataFrame]:
    """(documents, runs): (row, id, n, text, sha256) and (row, start, period, length), by words numbered from 0.

    A run is a stretch with smallest period q, at least max(6, 4 q) words long, that cannot be extended. ``text`` has
    the words joined by spaces where something may repeat; elsewhere it is null and ``sha256`` has the hash of them.
    ``row`` numbers the rows, so ids may repeat or be null. Null texts have no words. An empty table gives empty results;
    other columns play no part. ``plant`` repeats the end of some documents (the contract of the query).
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    read = rows.mapInPandas(_read(plant, long), "row long, id string, n long, text string, sha256 string, fragments array<struct<period:long,start:long,stop:long>>, tiles array<struct<octave:int,at:long,boundaries:array<int>,ids:binary>>")
    read = common.written(read)
    near = read.select("row", F.explode("fragments").alias("f")).select("row", "f.*")
    strips = read.select("row", F.explode("tiles").alias("t")).select("row", "t.*")
    n = max(docs.sparkSession.sparkContext.defaultParallelism, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    far = strips.repartition(n, "row", "octave", "at").mapInPandas(_solve_strips, "row long, period long, start long, stop long")
    found = common.written(runs(near.unionByName(far)))
    return read.select("row", "id", "n", "text", "sha256"), found


def collapse(read: DataFrame, found: DataFrame) -> DataFrame:
    """(row, id, collapsed, sha256, runs): of every run only the first period stays.

    ``collapsed`` and ``runs`` are null where nothing repeats. Only the texts where something may are shuffled.
    """
    each = found.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    open_ = read.where("text is not null").join(each, "row", "left").select("row", "id", "text", "runs")
    done = open_.mapInPandas(_collapsed, "row long, id string, collapsed string, sha256 string, runs array<struct<start:long,period:long,length:long>>")
    return done.unionByName(read.where("text is null").select("row", "id", "sha256"), allowMissingColumns=True)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False, long: int = LONG) -> DataFrame:
    """One row for each document: how many runs, the longest, and hashes of all runs and of the collapsed text."""
    found = collapse(*find(docs, id_col, text_col, plant, long))
    runs_ = F.coalesce("runs", F.array().cast("array<struct<start:bigint,period:bigint,length:bigint>>"))
    best = F.array_min(F.transform(runs_, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform(runs_, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    out = found.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), F.size(runs_).cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.col("sha256").alias("collapsed_sha256"))
    length, period = -F.col("best.l"), F.col("best.period")
    return out.select(id_col, "n_runs", F.col("best.start").alias("start"), length.alias("length"), period.alias("period"), F.floor(1000 * length / period).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
