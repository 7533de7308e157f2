"""Embedding near-dedup: PCA-ordered tiled comparison.

Unit vectors are rotated so that the directions with most energy come first. Two vectors with cosine t
or more differ by at most sqrt(2 - 2t), so only neighbouring cells of that width along the two leading
directions can hold links. Vectors are put in order of their cells along the leading directions and cut into
tiles of bounded size, so that a full cell is split along further directions. Tiles whose boxes are further
apart than links reach are never compared. In a pair of tiles the product over the leading dimensions is
accumulated first, the rest is bounded by the product of the suffix norms (Cauchy-Schwarz), and pairs that
cannot reach the threshold stop there. Survivors are decided by the cosine of the original vectors in double
precision.

Equal vectors are one *class* with a weight. A tile pair returns, for each of its classes, the weight of
what it links to and one link towards each linked group: as many rows as it was given, never all pairs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

TILE = 1024
STEPS = (8, 16, 32)
#: Leading directions of the boxes of tiles, and those along which vectors are put in order.
LEAD, CELLS = 12, 6
_SLACK = 1e-7  # of the pruning bounds; the decision itself has none


def _moments(orders: dict[int, np.ndarray], most: int):
    """Sum of outer products of unit vectors' first coordinates (in their order), one row per task and dimension."""

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for rows in batches:
            for d, part in rows.groupby("dim"):
                x = np.stack(part["v"].to_numpy()).astype(float)
                x = (x / np.linalg.norm(x, axis=1, keepdims=True))[:, orders[d][:most]]
                sums[d] = sums.get(d, 0) + x.T @ x
        for d, s in sums.items():
            yield pd.DataFrame({"dim": [d], "sums": [s.ravel().tolist()]})

    return run


@dataclass(frozen=True)
class _Basis:
    """An orthogonal map, most energy first: the coordinates in ``order``, of which the first are rotated."""

    order: np.ndarray
    turn: np.ndarray

    def __call__(self, v: np.ndarray, leading: int | None = None) -> np.ndarray:
        unit = (v / np.linalg.norm(v, axis=1, keepdims=True))[:, self.order]
        m = len(self.turn)
        if leading is not None:
            return (unit[:, :m] @ self.turn[:, :leading]) if leading <= m else np.hstack([unit[:, :m] @ self.turn, unit[:, m:leading]])
        return np.hstack([unit[:, :m] @ self.turn, unit[:, m:]])


#: Vector lengths whose directions are rotated, those of most vectors; others keep their coordinates as they are.
ROTATED = 8


class _Bases(dict):
    """The basis of each length; one that has none keeps its coordinates."""

    def __missing__(self, dim: int) -> _Basis:
        return _Basis(np.arange(dim), np.eye(1))


def _bases(valid: DataFrame, most_dims: int) -> _Bases:
    """The bases of the ROTATED lengths that most vectors have. At most ``most_dims`` coordinates, those with most energy, are rotated.

    So no more than ROTATED * most_dims ** 2 numbers reach the driver and the tasks, however many lengths there are.
    """
    usual = valid.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").limit(ROTATED).collect()
    orders = {r["dim"]: np.arange(r["dim"]) for r in usual}
    valid = valid.where(F.col("dim").isin(list(orders)))
    if any(d > most_dims for d in orders):
        norm = F.aggregate("v", F.lit(0.0), lambda a, e: a + e * e)
        long = valid.where(F.col("dim") > most_dims).select("dim", "v", norm.alias("norm"))
        energy = long.select("dim", "norm", F.posexplode("v").alias("i", "x")).groupBy("dim", "i").agg(F.sum(F.col("x") * F.col("x") / F.col("norm")).alias("x"))
        for r in energy.groupBy("dim").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("m")).collect():
            orders[r["dim"]] = np.argsort([-e["x"] for e in r["m"]], kind="stable")
    rows = valid.select("dim", "v").mapInPandas(_moments(orders, most_dims), "dim int, sums array<double>")
    added = rows.select("dim", F.posexplode("sums").alias("i", "x")).groupBy("dim", "i").agg(F.sum("x").alias("x"))
    out = _Bases()
    for r in added.groupBy("dim").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("m")).collect():
        m = min(r["dim"], most_dims)
        _, vecs = np.linalg.eigh(np.array([e["x"] for e in r["m"]]).reshape(m, m))
        out[r["dim"]] = _Basis(orders[r["dim"]], vecs[:, ::-1].copy())
    return out


def _links(a: np.ndarray, b: np.ndarray, ra: np.ndarray, rb: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with cosine >= t. a, b: original vectors (double); ra, rb: rotated unit vectors."""
    d = a.shape[1]
    steps = [s for s in STEPS if s < d]
    part, at = np.zeros((len(ra), len(rb))), 0
    for s in steps[:1]:
        part += ra[:, :s] @ rb[:, :s].T
        at = s
    tail = lambda r: np.sqrt(np.maximum((r[:, at:] ** 2).sum(1), 0))
    i, j = np.nonzero(part + np.outer(tail(ra), tail(rb)) >= t - _SLACK) if steps else np.nonzero(np.ones_like(part))
    sums = part[i, j]
    for s in [*steps[1:], d]:
        if not len(i):
            break
        sums = sums + np.einsum("ij,ij->i", ra[i, at:s], rb[j, at:s])
        at = s
        keep = sums + tail(ra)[i] * tail(rb)[j] >= t - _SLACK
        i, j, sums = i[keep], j[keep], sums[keep]
    if not len(i):
        return i, j
    norm = lambda x: np.sqrt(np.einsum("ij,ij->i", x, x))
    keep = np.einsum("ij,ij->i", a[i], b[j]) / (norm(a)[i] * norm(b)[j]) >= t
    return i[keep], j[keep]


def _compare(t: float, bases: dict[int, _Basis]):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node", ignore_index=True)
        x = np.stack(rows["v"].to_numpy()).astype(float)
        r = bases[x.shape[1]](x)
        left = np.flatnonzero(rows["left"].to_numpy(bool))
        right = np.flatnonzero(rows["right"].to_numpy(bool))
        weight, node = rows["weight"].to_numpy(np.int64), rows["node"].to_numpy(np.int64)
        linked, root = np.zeros(len(rows), np.int64), np.arange(len(rows))

        def top(k):
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        for s in range(0, len(left), 256):
            own = left[s : s + 256]
            i, j = _links(x[own], x[right], r[own], r[right], t)
            i, j = own[i], right[j]
            if key[0] == key[1]:  # a tile with itself: each pair once
                i, j = i[i < j], j[i < j]
            np.add.at(linked, i, weight[j])
            np.add.at(linked, j, weight[i])
            for p, q in zip(i.tolist(), j.tolist(), strict=True):
                p, q = top(p), top(q)
                if p != q:
                    root[max(p, q)] = min(p, q)
        tops = np.array([top(k) for k in range(len(rows))], dtype=np.int64)
        hit = linked > 0
        return pd.DataFrame({"node": node[hit], "linked": linked[hit], "to": node[tops[hit]]})

    return run


def _lead(bases: dict[int, _Basis], width: float):
    """Coordinates along the leading directions, and the cells along each (0 where there are fewer)."""

    def run(batches):
        for rows in batches:
            lead = np.zeros((len(rows), LEAD))
            for d, part in rows.groupby("dim"):
                x = bases[d](np.stack(part["v"].to_numpy()).astype(float), min(d, LEAD))
                lead[rows.index.get_indexer(part.index), : x.shape[1]] = x
            cells = np.floor(lead / width).astype(np.int64)
            yield rows.assign(lead=list(lead), **{f"c{k}": cells[:, k] for k in range(CELLS)})

    return run


def _tiles(size: int):
    """Rows that come in order of group and cells, cut into tiles of ``size`` within one cell of the two first directions."""

    def run(batches):
        before, tile, held = None, 0, 0
        for rows in batches:
            numbers = []
            for cell in zip(rows["part"].tolist(), rows["g_key"].tolist(), rows["dim"].tolist(), rows["c0"].tolist(), rows["c1"].tolist(), strict=True):
                if cell != before or held >= size:
                    before, tile, held = cell, tile + 1, 0
                held += 1
                numbers.append((cell[0] << 32) + tile)
            yield rows.assign(tile=numbers).drop(columns=["part"])

    return run


def near_copies(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding", group_col: str = "label", tile: int = TILE, most_dims: int = 1024) -> DataFrame:
    """(id_col, n_links, component_id, kept) of every row of ``vectors``.

    Rows link when their ``group_col`` values are equal and not null, their vectors have the same
    length, and their cosine in double precision is at least ``threshold`` (which must be above 0).
    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing, nor
    do rows with a null id (their component_id is null, kept is true). n_links counts other rows linked
    directly; component_id is the smallest id reachable; kept marks rows with that id. Rows that repeat an id are
    rows of their own: they link by their own vectors and groups, and only so share a component. Other columns play
    no part; an empty table gives an empty result. Vectors may be of any length; of more than ``most_dims``
    coordinates those with most energy are rotated, which says how fast pairs are ruled out, not which link.
    """
    v = F.transform(F.col(vec_col), lambda e: e.cast("double") + 0.0)  # no negative zeros
    base = vectors.select(F.col(id_col).alias("id"), F.col(group_col).alias("g"), v.alias("v"))
    sound = (F.size("v") > 0) & F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists("v", lambda e: e != 0)
    usable = F.col("id").isNotNull() & F.col("g").isNotNull() & F.coalesce(sound, F.lit(False))
    # equal vectors of a group have equal keys: doubles are written in full
    key = F.sha2(F.array_join(F.col("v").cast("array<string>"), ","), 256)
    base = common.written(base.select("id", "g", "v", F.when(usable, key).alias("key")))
    rows, usable = base.select("id", "g", "key"), base.where("key is not null")
    # one class per distinct vector and group, combined before the shuffle
    classes = usable.groupBy("g", "key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("size"), F.first("v").alias("v"))
    classes = common.written(classes.withColumns({"dim": F.size("v"), "node": F.monotonically_increasing_id()}))  # a number for each class, whatever ids repeat
    bases = _bases(classes, most_dims)
    width = float(np.sqrt(max(2 - 2 * threshold, 1e-12))) + 1e-6
    cells = [f"c{k}" for k in range(CELLS)]
    # tiles follow the leading directions, so a full cell is split along further ones
    schema = "g_key string, dim int, node long, size long, v array<double>"
    placed = classes.select(F.col("g").cast("string").alias("g_key"), "dim", "node", "size", "v").mapInPandas(_lead(bases, width), schema + ", lead array<double>, " + ", ".join(f"{c} long" for c in cells))
    n = classes.count()
    by = ["g_key", "dim", *cells, F.xxhash64("node")]
    ordered = common.cut(placed).repartitionByRange(max(1, -(-n // (16 * tile))), *by).sortWithinPartitions(*by).withColumn("part", F.spark_partition_id())
    held = ordered.select("part", "g_key", "dim", "c0", "c1", "node", "size", "v", "lead")
    held = common.written(held.mapInPandas(_tiles(tile), "g_key string, dim int, c0 long, c1 long, node long, size long, v array<double>, lead array<double>, tile long"))
    at = lambda k: F.get("lead", F.lit(k))
    box = [f(at(k)).alias(f"{name}{k}") for k in range(LEAD) for name, f in (("lo", F.min), ("hi", F.max))]
    boxes = held.groupBy("tile").agg(F.first("g_key").alias("g_key"), F.first("dim").alias("dim"), F.first("c0").alias("c0"), F.first("c1").alias("c1"), *box)
    boxes = common.cut(boxes.select("tile", "g_key", "dim", "c0", "c1", F.array(*[f"lo{k}" for k in range(LEAD)]).alias("lo"), F.array(*[f"hi{k}" for k in range(LEAD)]).alias("hi")))
    # pairs of tiles in the same or neighbouring cells whose boxes are near enough, each once; a few numbers a tile
    step = F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))]))
    a = boxes.withColumn("s", step).select("g_key", "dim", (F.col("c0") + F.col("s.x")).alias("c0"), (F.col("c1") + F.col("s.y")).alias("c1"), ((F.col("s.x") == 0) & (F.col("s.y") == 0)).alias("same"), F.col("tile").alias("a"), F.col("lo").alias("alo"), F.col("hi").alias("ahi"))
    near = a.join(boxes.withColumnRenamed("tile", "b"), ["g_key", "dim", "c0", "c1"]).where("not same or a <= b")
    gap = reduce(lambda x, y: x + y, [F.pow(F.greatest(F.lit(0.0), F.get("lo", F.lit(k)) - F.get("ahi", F.lit(k)), F.get("alo", F.lit(k)) - F.get("hi", F.lit(k))), 2) for k in range(LEAD)])
    near = common.cut(near.where(gap <= width * width).select("a", "b"))
    left = near.select("a", "b", F.col("a").alias("tile"), F.lit(True).alias("left"), (F.col("a") == F.col("b")).alias("right"))
    right = near.where("a <> b").select("a", "b", F.col("b").alias("tile"), F.lit(False).alias("left"), F.lit(True).alias("right"))
    dealt = left.unionByName(right).join(held.select("tile", "node", F.col("size").alias("weight"), "v"), "tile").drop("tile")
    found = common.cut(dealt.groupBy("a", "b").applyInPandas(_compare(threshold, bases), "node long, linked long, to long"))
    comps = common.components(found.where("node != to"), "node", "to")
    linked = found.groupBy("node").agg(F.sum("linked").alias("linked")).join(comps, "node", "left")
    own = F.coalesce("component", "node").alias("component")
    info = common.cut(classes.select("g", "key", "size", "node", "id").join(linked, "node", "left").select("g", "key", "size", "id", (F.col("size") - 1 + F.coalesce("linked", F.lit(0))).alias("n"), own))
    least = info.groupBy("component").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("c"))
    info = common.cut(common.spread_join(info, least, ["component"]).select("g", "key", "size", "n", "c"))
    known = common.spread_join(rows.where("key is not null"), info, ["g", "key"]).select("id", "n", "c")
    alone = rows.where("key is null").select("id", F.lit(0).cast("long").alias("n"), F.col("id").alias("c"))
    return known.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_links"), F.col("c").alias("component_id"), F.col("id").eqNullSafe(F.col("c")).alias("kept"))
