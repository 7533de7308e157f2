"""Mixing sources to target weights: a min-cost flow over membership patterns, then seeded documents.

A document may belong to several sources. Documents are aggregated by their set of sources (the pattern); from
each pattern words flow to the quotas of its sources, the k-th copy of a document costing more than the one before.
The flow is solved on the driver: it has a node for each pattern and source, never one for a document. Which documents
make up a pattern's flow is decided on Spark, in the order of a seeded hash, by prefix sums over blocks.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

SPACE = " \t\n\x0b\x0c\r"
#: Patterns times their sources that the driver takes; more is an error, nothing is left out.
MAX_ARCS = 200_000
BLOCK_BITS = 12


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text, in linear time and without an array of them; null: 0."""
    marks = F.regexp_replace(text, r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", "x")
    return F.coalesce(F.length(F.ltrim(marks, F.lit(SPACE))), F.lit(0)).cast("long")


def fill(sizes: Sequence[int], weights: Sequence[int], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size; what is above is shared again by weight.

    The sources that reach their limit first are those with the least size for their weight, so one pass in that order
    settles all of them. If all reach it, less than ``total`` is shared.
    """
    order = sorted(range(len(sizes)), key=lambda i: sizes[i] / weights[i])
    out, full, rest = [0.0] * len(sizes), 0, sum(weights)
    for at, i in enumerate(order):
        if most * sizes[i] * rest >= (total - most * full) * weights[i]:
            for j in order[at:]:
                out[j] = (total - most * full) * weights[j] / rest
            break
        out[i] = most * float(sizes[i])
        full += sizes[i]
        rest -= weights[i]
    return out


class Network:
    """Arcs with capacities and costs of at least 0; ``solve`` finds a cheapest one of the largest flows."""

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def arc(self, a: int, b: int, room: int, cost: int = 0) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def _prices(self, s: int, price: list[int]) -> list[float]:
        """Distances from ``s`` by reduced costs (Dijkstra)."""
        far = [float("inf")] * len(self.out)
        far[s], heap = 0, [(0, s)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for e in self.out[a]:
                b = self.to[e]
                if self.room[e] and (x := d + self.cost[e] + price[a] - price[b]) < far[b]:
                    far[b] = x
                    heapq.heappush(heap, (x, b))
        return far

    def _augment(self, s: int, t: int, price: list[int]) -> bool:
        """A blocking flow on arcs of reduced cost 0, level by level."""
        level, queue = {s: 0}, [s]
        for a in queue:
            for e in self.out[a]:
                b = self.to[e]
                if self.room[e] and b not in level and self.cost[e] + price[a] == price[b]:
                    level[b] = level[a] + 1
                    queue.append(b)
        if t not in level:
            return False
        at, path, a = [0] * len(self.out), [], s
        while True:
            if a == t:
                least = min(self.room[e] for e in path)
                for e in path:
                    self.room[e] -= least
                    self.room[e ^ 1] += least
                path, a = [], s
                continue
            while at[a] < len(self.out[a]):
                e = self.out[a][at[a]]
                b = self.to[e]
                if self.room[e] and level.get(b) == level[a] + 1 and self.cost[e] + price[a] == price[b]:
                    break
                at[a] += 1
            if at[a] < len(self.out[a]):
                path.append(e)
                a = b
            elif path:
                e = path.pop()
                a = self.to[e ^ 1]
                at[a] += 1
            else:
                return True

    def solve(self, s: int, t: int) -> None:
        """Primal-dual: prices by shortest paths, then all flow that costs no more, until ``t`` is out of reach."""
        price = [0] * len(self.out)
        while (far := self._prices(s, price))[t] < float("inf"):
            price = [p + int(min(d, far[t])) for p, d in zip(price, far, strict=True)]
            while self._augment(s, t, price):
                pass


def route(patterns: Sequence[tuple[Sequence[int], int]], quotas: Sequence[int], most: int) -> list[dict[int, int]]:
    """Words that each pattern (its sources, its size) gives to each of its sources.

    The k-th copy of a word costs k - 1, so no words repeat a second time while a source could be served by words
    that were not used yet.
    """
    n, m = len(patterns), len(quotas)
    net, s, t = Network(n + m + 2), n + m, n + m + 1
    arcs = []
    for p, (members, size) in enumerate(patterns):
        for k in range(most):
            net.arc(s, p, size, k)
        arcs.append([(x, net.arc(p, n + x, most * size)) for x in members])
    for x, q in enumerate(quotas):
        net.arc(n + x, t, q)
    net.solve(s, t)
    return [{x: net.room[e ^ 1] for x, e in own} for own in arcs]


@dataclass(frozen=True)
class Mix:
    """``rows``: one for each document; ``shares``: (sources, source, words), what each pattern gives to each source."""

    rows: DataFrame
    shares: list[tuple[tuple, str | None, int]]


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", sources: Column | None = None) -> Mix:
    """Documents with how often each is taken, so that the sources' words come near their targets.

    ``sources`` is an array column (default: the one in ``source``). Sources in code point order, null last, have the
    ``weights`` in turn and share ``share`` times the words of all documents, none more than ``most`` times its own.
    Rows: id, sources, size, source_size and target (of the first source), copies, taken. A pattern's documents are
    taken whole, each as often as all of them fit, then once more in the order of md5(seed:id) while they fit, and then
    the one whose size comes nearest to what is left: of equal ones the first in that order.

    Null and empty texts have size 0 and are taken 0 times as the others are; ids may be null or repeat; an empty array of
    sources is never taken. An empty table gives an empty result. The patterns go to the driver: an error if there are
    more than MAX_ARCS of (pattern, source).
    """
    spark = docs.sparkSession
    own = F.array("source") if sources is None else sources
    sized = common.written(docs.select(F.col(id_col).alias("id"), F.array_distinct(F.transform(own, lambda x: x.cast("string"))).alias("sources"), n_words(F.col(text_col)).alias("size")))
    order = lambda a, b: F.when(a.isNull(), F.when(b.isNull(), 0).otherwise(1)).when(b.isNull(), -1).when(a < b, -1).when(a > b, 1).otherwise(0)
    sized = sized.withColumn("sources", F.array_sort("sources", order))
    found = sized.groupBy("sources").agg(F.sum("size").alias("size")).limit(MAX_ARCS + 1).collect()
    if sum(max(1, len(r["sources"] or [])) for r in found) > MAX_ARCS:
        raise ValueError(f"more than {MAX_ARCS} pairs of a set of sources and a source in it")
    last = lambda x: (x is None, x or "")
    found = sorted(((tuple(r["sources"] or ()), r["size"]) for r in found), key=lambda r: [last(x) for x in r[0]])
    names = sorted({x for p, _ in found for x in p}, key=last)
    index = {x: i for i, x in enumerate(names)}
    sizes = [0] * len(names)
    for p, size in found:
        for x in p:
            sizes[index[x]] += size
    total = share * sum(size for p, size in found if p)
    targets = fill(sizes, [weights[i % len(weights)] for i in range(len(names))], total, most)
    flows = route([([index[x] for x in p], size) for p, size in found], [min(most * n, int(x + 0.5)) for n, x in zip(sizes, targets, strict=True)], most)
    plan = []
    for (p, size), flow in zip(found, flows, strict=True):
        words = sum(flow.values())
        copies = words // size if size else 0
        first = index[p[0]] if p else None
        plan.append((list(p), sizes[first] if p else 0, targets[first] if p else 0.0, copies, words - copies * size))
    plan = spark.createDataFrame(plan, "sources array<string>, source_size long, target double, copies long, rest long")
    rows = sized.withColumn("sources", F.coalesce("sources", F.array().cast("array<string>"))).join(F.broadcast(plan), "sources")  # at most MAX_ARCS rows
    picked = _pick(rows, seed)
    shares = [(p, names[x], words) for (p, _), flow in zip(found, flows, strict=True) for x, words in flow.items()]
    taken = picked.withColumn("taken", F.col("size") * F.col("copies"))
    return Mix(taken.select(F.col("id").alias(id_col), "sources", "size", "source_size", "target", "copies", "taken"), shares)


def _pick(rows: DataFrame, seed: int) -> DataFrame:
    """``copies`` one higher for documents whose sizes come near ``rest`` in each pattern.

    Prefix sums over a range-partitioned table: of blocks of 4,096 rows, then inside them. A pattern with most of the
    documents is spread like any other.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null"))))
    keys = ("sources", "key", "size", "tie")
    spread = rows.withColumns({"key": key, "tie": F.monotonically_increasing_id()})  # rows that are equal but for the tie may change places
    n = max(1, spread.sparkSession.sparkContext.defaultParallelism)
    ordered = spread.repartitionByRange(max(n, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys).sortWithinPartitions(*keys)
    ordered = common.written(ordered.withColumn("at", F.monotonically_increasing_id())).withColumn("block", F.shiftright("at", BLOCK_BITS))
    sums = ordered.groupBy("sources", "block").agg(F.sum("size").alias("words"))
    before = F.coalesce(F.sum("words").over(Window.partitionBy("sources").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("sources", "block", before.alias("before"))
    up_to = F.col("before") + F.sum("size").over(Window.partitionBy("sources", "block").orderBy("at"))
    fits = common.written(ordered.join(sums, ["sources", "block"]).withColumn("fits", up_to <= F.col("rest")).drop("before"))
    gaps = fits.groupBy("sources").agg((F.max("rest") - F.coalesce(F.sum(F.when(F.col("fits"), F.col("size"))), F.lit(0))).alias("gap"))
    left = fits.where(~F.col("fits")).join(F.broadcast(gaps), "sources")  # one row for each pattern
    off = F.abs(F.col("gap") - F.col("size"))
    nearest = left.where(off < F.col("gap")).groupBy("sources").agg(F.min(F.struct(off.alias("off"), "at")).alias("best")).select(F.col("best.at").alias("at"), F.lit(1).alias("more"))
    out = fits.join(F.broadcast(nearest), "at", "left")
    return out.withColumn("copies", F.col("copies") + F.col("fits").cast("long") + F.coalesce("more", F.lit(0)))


#: The same rows by DuckDB, for documents of one source each.
SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n, [5, 2, 1][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS w FROM d GROUP BY source),
r AS (SELECT *, coalesce(sum(n) OVER before, 0) AS held, sum(w) OVER all_ - coalesce(sum(w) OVER before, 0) AS weights, 1.5 * sum(n) OVER all_ AS total, row_number() OVER (ORDER BY n / w, source) AS k FROM s
      WINDOW before AS (ORDER BY n / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), all_ AS (ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
stop AS (SELECT held, weights, k FROM r WHERE 2 * n * weights >= (total - 2 * held) * w ORDER BY k LIMIT 1),
t AS (SELECT r.source, r.n AS source_size, CASE WHEN r.k < stop.k THEN 2.0 * r.n ELSE (r.total - 2 * stop.held) * r.w / stop.weights END::DOUBLE AS target FROM r, stop),
p AS (SELECT *, least(2 * source_size, floor(target + 0.5))::BIGINT AS quota FROM t),
q AS (SELECT *, CASE WHEN source_size > 0 THEN quota // source_size ELSE 0 END AS copies, CASE WHEN source_size > 0 THEN quota % source_size ELSE 0 END AS rest FROM p),
o AS (SELECT d.doc_id, d.size, q.*, row_number() OVER i AS nth, sum(d.size) OVER i AS up_to FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
      WINDOW i AS (PARTITION BY d.source ORDER BY md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
g AS (SELECT *, rest - coalesce(sum(size) FILTER (up_to <= rest) OVER (PARTITION BY source), 0) AS gap FROM o),
b AS (SELECT *, up_to > rest AND abs(gap - size) < gap AND row_number() OVER (PARTITION BY source ORDER BY up_to <= rest, abs(gap - size), nth) = 1 AS more FROM g)
SELECT doc_id, size, source_size, target, (size * (copies + (up_to <= rest)::INT + more::INT))::BIGINT AS taken FROM b
"""
