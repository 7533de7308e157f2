"""Near-dedup by Order MinHash.

A text is its sequence of lower-case words. The similarity of two texts is the share of the longer one's
words that a banded alignment keeps: at most ``threshold`` off by edits of words, wherever they are. It is
at least the edit similarity (1 - edit distance / longer length), so no pair at the threshold is refused.

Candidates: for each of some hash orders the ``kept`` smallest k-mers (runs of words,
labelled with their occurrence number so that repeats count) are taken and put back into the order they
have in the text. Two texts share such a sketch with a chance that grows with their edit similarity, not
only with the k-mers they share. K-mers have five words in ``sketches`` orders, and three in ``fine_sketches`` more:
where every fifth word is another one, no run of five is left, but two in five runs of three are. K-mers say little of a text with few words, so texts of up to ``short``
words (and those that may be similar to them) also have prefix buckets: of its labelled words, the rarest
first, a text of n is found under the first n - ceil(threshold * n) + 1. Two similar texts always share
one of those, so no pair with a text of up to ``short`` words is missed.

No bucket is expanded into all pairs. Texts meet the *leader* of each of their buckets (the smallest node
of a random numbering, so buckets of one family mostly have one leader): once for each leader, however
many buckets they share with it. Groups of one leader are worked on in tasks of bounded size: first
everybody against the leader, then, among those that are not joined yet, an exact prefix join on their
rarest words. The blocks of a group too large for one task are then compared across: texts outside of the
group's largest component against all. What comes out are links that join components, less than there are
texts. No pair that shares a bucket is left undecided unless other links have joined it already.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: First code point of the scripts whose words are not parted by spaces, and a word of theirs: one character.
UNSPACED = 0x0E00
WORD = re.compile(r"\w+")
WORD_OR_SIGN = re.compile(r"[฀-໿က-႟ក-៿぀-ヿ㐀-鿿豈-﫿\U00020000-\U0003ffff]|[^\W฀-໿က-႟ក-៿぀-ヿ㐀-鿿豈-﫿\U00020000-\U0003ffff]+")
#: Classes that go are broadcast up to this many bytes (80 each), and joined by a shuffle beyond.
BROADCAST_BYTES = 16 << 20
_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


@dataclass(frozen=True)
class Params:
    """Chance of a shared sketch: some J ** kept, where J is the Jaccard index of the labelled k-mers.

    At the threshold J of runs of three words is 1/4 where changed words are spread evenly, and more elsewhere, so
    1 - (15/16) ** 44 = 94 % of such pairs meet, the worst case; the others nearly all do.

    ``block_words`` and ``block_rows`` bound what a task compares (more only where one text has more words).
    """

    words: int = 5
    threshold: float = 0.8
    sketches: int = 8
    fine_words: int = 3
    fine_sketches: int = 44
    kept: int = 2
    short: int = 40
    block_words: int = 1 << 19
    block_rows: int = 4096


class _Hashes(dict):
    """64-bit hashes of words, a bounded number of them remembered."""

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < 1 << 18:
            self[word] = h
        return h


def word_ids(text: str | None) -> np.ndarray:
    """64-bit hashes of the lower-case words of the whole text."""
    text = (text or "").lower()
    plain = text.isascii() or np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").max() < UNSPACED
    words = (WORD if plain else WORD_OR_SIGN).findall(text)
    hashes = common.kept("words of near_dedup").setdefault("hashes", _Hashes())
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def kmers(ids: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words; a shorter text is one run."""
    if not len(ids):
        return ids
    n = max(1, len(ids) - k + 1)
    h = np.zeros(n, np.uint64)
    for j in range(min(k, len(ids))):
        h = h * _MUL + ids[j : j + n] + np.uint64(j + 1)
    return _mix(h)


def labelled(h: np.ndarray) -> np.ndarray:
    """Each hash mixed with its occurrence number in the text."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    number = np.arange(len(s)) - np.repeat(first, np.diff(np.concatenate([first, [len(s)]])))
    out = np.empty_like(h)
    out[order] = s + number.astype(np.uint64) * _MUL
    return out


def sketches(ids: np.ndarray, p: Params) -> np.ndarray:
    """The buckets of a text's words: of runs of ``words`` and of ``fine_words`` words."""
    if not len(ids):
        return ids
    return np.concatenate([sketch(kmers(ids, p.words), p.sketches, p.kept), sketch(kmers(ids, p.fine_words), p.fine_sketches, p.kept)])


def sketch(h: np.ndarray, orders: int, kept: int) -> np.ndarray:
    """One 64-bit bucket for each of some hash orders of the k-mers ``h``; none for a text without words."""
    if not len(h):
        return h
    lab, few = _mix(labelled(h)).astype(np.uint32), min(kept, len(h))
    seeds = _mix(np.arange(1, orders + 1, dtype=np.uint64) * _MUL)
    xor, times = seeds.astype(np.uint32), (seeds >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    at = np.tile(np.arange(few), (orders, 1))
    step = max(1, (1 << 18) // len(lab))  # orders worked on at once
    for i in range(0, orders if few < len(lab) else 0, step):
        v = (lab[None, :] ^ xor[i : i + step, None]) * times[i : i + step, None]
        rows = np.arange(len(v))
        for j in range(few):
            at[i : i + step, j] = v.argmin(1)
            v[rows, at[i : i + step, j]] = np.uint32(0xFFFFFFFF)
    at.sort(axis=1)  # back to the order of the text
    code = np.arange(orders, dtype=np.uint64)
    for j in range(few):
        code = code * _MUL + h[at[:, j]] + np.uint64(1)
    return _mix(code)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """How many of the sorted, distinct ``a`` are in the sorted ``b``: no alignment can keep more."""
    at = np.searchsorted(b, a)
    return int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))


def aligned(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Words kept by a banded alignment (longest common subsequence with \\|i - j\\| <= band).

    A common prefix is always part of a best alignment, and so is a common suffix. What lies between is
    aligned by bit-parallel rows: bit j of the row is 0 where word j of ``b`` raises the count. Rows are
    taken in blocks whose columns are those that the band lets them reach.
    """
    n = min(len(a), len(b))
    same = a[:n] == b[:n]
    head = int(n if same.all() else same.argmin())
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    same = a[::-1][:n] == b[::-1][:n]
    tail = int(n if same.all() else same.argmin()) if n else 0
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    kept = head + tail
    if not len(a) or not len(b):
        return kept
    row, lo, wide = 0, 0, 0  # bits of the columns lo .. lo + wide
    step = min(512, max(64, band))
    for i in range(0, len(a), step):
        part = a[i : i + step]
        new_lo, new_hi = min(len(b), max(0, i - band)), min(len(b), i + len(part) + band)
        gone = new_lo - lo
        if gone > 0:  # columns out of reach: their count stands
            left = row & ((1 << min(gone, wide)) - 1)
            kept += min(gone, wide) - left.bit_count()
            row, wide, lo = row >> gone, max(wide - gone, 0), new_lo
        more = new_hi - lo - wide
        if more > 0:
            row, wide = row | ((1 << more) - 1) << wide, wide + more
        if not wide:
            break
        words, which = np.unique(part, return_inverse=True)
        bits = np.packbits(b[lo : lo + wide][None, :] == words[:, None], axis=1, bitorder="little")
        masks = [int.from_bytes(m.tobytes(), "little") for m in bits]
        full = (1 << wide) - 1
        for w in which.tolist():
            u = row & masks[w]
            if u:
                row = ((row + u) | (row - u)) & full
    return kept + wide - row.bit_count()


def allowed(na, nb, p: Params):
    """Whether lengths allow the similarity (also of arrays)."""
    return np.minimum(na, nb) >= p.threshold * np.maximum(na, nb) - 1e-9


def similar(a: np.ndarray, b: np.ndarray, p: Params, held_a: np.ndarray | None = None, held_b: np.ndarray | None = None) -> bool:
    """Whether the similarity of two texts, given as words in order, is at least the threshold.

    ``held_a`` and ``held_b``: their labelled words, sorted.
    """
    if not len(a) or not len(b) or not allowed(len(a), len(b), p):
        return False
    need = p.threshold * max(len(a), len(b)) - 1e-9
    held_a = np.sort(labelled(a.astype(np.uint64))) if held_a is None else held_a
    held_b = np.sort(labelled(b.astype(np.uint64))) if held_b is None else held_b
    if overlap(held_a, held_b) < need:
        return False
    # an alignment that keeps enough leaves at most this many words of either text out
    return aligned(a, b, int(max(len(a), len(b)) - need) + 1) >= need


def _sketches(p: Params):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[bytes] = set()  # of copies in one task one is sketched
        for rows in batches:
            out = []
            for sha, text in zip(rows["sha"], rows["text"], strict=True):
                if sha in seen:
                    out.append((0, None, None, None))
                    continue
                if len(seen) < 1 << 17:
                    seen.add(sha)
                ids = word_ids(text)
                few = labelled(ids).view(np.int64) if len(ids) * p.threshold <= p.short + 1e-9 else ids[:0].view(np.int64)
                out.append((len(ids), sketches(ids, p).view(np.int64), few, ids.astype("<u4").tobytes()))
            yield pd.DataFrame({"id": rows["id"], "sha": rows["sha"], **{k: [x[i] for x in out] for i, k in enumerate(("n", "buckets", "few", "word_ids"))}})

    return run


def _prefixes(heads: DataFrame, p: Params) -> DataFrame:
    """(node, n, bucket) of the prefix buckets. A word of one text only takes its place in the prefix but makes no bucket."""
    each = common.cut(heads.where(F.size("few") > 0).select("node", "n", F.explode("few").alias("bucket")))
    sizes = common.cut(each.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    shared = common.spread_join(each, sizes, ["bucket"], keep_size=True).groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("size", "bucket"))).alias("all"))
    most = F.size("all") - F.ceil(F.col("n") * p.threshold - 1e-9).cast("int") + 1
    first = shared.where(most > 0).select("node", "n", F.explode(F.slice("all", 1, most)).alias("x"))
    return first.select("node", "n", F.xxhash64("x.bucket", F.lit("prefix")).alias("bucket"))


class _Met:
    """The texts that a task holds, and which of them are joined."""

    def __init__(self, rows: pd.DataFrame, p: Params, start: np.ndarray | None = None):
        node = rows["node"].to_numpy(np.int64)
        self.node, first, self.at = np.unique(node, return_index=True, return_inverse=True)
        self.text = [np.frombuffer(w, "<u4") for w in rows["word_ids"].iloc[first]]
        self.held = [np.sort(labelled(t.astype(np.uint64))) for t in self.text]
        self.n = np.array([len(t) for t in self.text])
        self.p, self.links = p, []
        self.root = list(range(len(first)))
        if start is not None:  # components that are known already
            _, same = np.unique(start[first], return_inverse=True)
            least = np.full(same.max() + 1 if len(same) else 0, len(first))
            np.minimum.at(least, same, np.arange(len(first)))
            self.root = least[same].tolist()

    def top(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def tops(self) -> np.ndarray:
        return np.array([self.top(x) for x in range(len(self.root))], np.int64)

    def decide(self, x: int, y: int) -> None:
        a, b = self.top(x), self.top(y)
        if a != b and similar(self.text[x], self.text[y], self.p, self.held[x], self.held[y]):
            self.root[max(a, b)] = min(a, b)
            self.links.append((self.node[min(x, y)], self.node[max(x, y)]))

    def prefix_join(self, group: np.ndarray, text: np.ndarray, left: np.ndarray | None = None, right: np.ndarray | None = None) -> None:
        """All pairs of one group that share a word of their prefixes: exact, as words are ranked alike for all.

        With ``left`` and ``right`` only pairs of a left and a right row are decided.
        """
        used = np.unique(text)
        if not len(used):
            return
        words, counts = np.unique(np.concatenate([self.held[x] for x in used]), return_counts=True)
        prefix = {}
        for x in used.tolist():
            at = np.searchsorted(words, self.held[x])
            most = len(at) - int(np.ceil(self.p.threshold * len(at) - 1e-9)) + 1
            rare = at[counts[at] > 1]
            # words of one text only come first and meet nobody
            most -= len(at) - len(rare)
            prefix[x] = rare[np.argsort(counts[rare], kind="stable")[:most]] if most > 0 else rare[:0]
        sizes = np.array([len(prefix[x]) for x in text.tolist()])
        if not sizes.sum():
            return
        row = np.repeat(np.arange(len(text)), sizes)
        word = np.concatenate([prefix[x] for x in text.tolist()])
        order = np.lexsort((row, word, group[row]))
        row, word = row[order], word[order]
        run = np.cumsum(np.concatenate([[True], (word[1:] != word[:-1]) | (group[row[1:]] != group[row[:-1]])]))
        at, seen, away = np.arange(len(run)), set(), 0
        while True:
            away += 1
            at = at[at + away < len(run)]
            at = at[run[at] == run[at + away]]  # runs that are longer
            if not len(at):
                return
            i, j = row[at], row[at + away]
            x, y = text[i], text[j]
            tops = self.tops()
            fit = (tops[x] != tops[y]) & allowed(self.n[x], self.n[y], self.p)
            if left is not None:
                fit &= (left[i] & right[j]) | (left[j] & right[i])
            for code in np.unique(np.minimum(x, y)[fit] * len(self.n) + np.maximum(x, y)[fit]).tolist():
                if code not in seen:
                    seen.add(code)
                    self.decide(*divmod(code, len(self.n)))


def _meet(p: Params):
    """Links within the groups (or blocks of groups) of one hall."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        common.kept("links of near_dedup")
        rows = rows.sort_values(["leader", "block", "node"], ignore_index=True)
        met = _Met(rows, p)
        leads = (rows["leader"] == rows["node"]).to_numpy()
        group = rows.groupby(["leader", "block"], sort=False).ngroup().to_numpy()
        lead = np.zeros(group.max() + 1, np.int64)
        lead[group[leads]] = met.at[leads]
        for x, y in zip(met.at[~leads].tolist(), lead[group[~leads]].tolist(), strict=True):
            met.decide(x, y)
        # what the leader has not joined, in groups of two others or more
        tops, others = met.tops(), pd.Series(group[~leads])
        c = pd.Series(tops[met.at[~leads]])
        open_ = (c.groupby(others).transform("nunique") > 1).to_numpy()
        met.prefix_join(group[~leads][open_], met.at[~leads][open_])
        return pd.DataFrame(met.links, columns=["a", "b"], dtype="int64")

    return run


def _across(p: Params):
    """Links between the texts outside of a group's largest component (one block of them) and a block of all."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        common.kept("links of near_dedup")
        rows = rows.sort_values(["node", "left"], ignore_index=True)
        met = _Met(rows, p, rows["c"].to_numpy(np.int64))
        left = rows["left"].to_numpy(bool)
        met.prefix_join(np.zeros(len(rows), np.int64), met.at, left, ~left)
        return pd.DataFrame(met.links, columns=["a", "b"], dtype="int64")

    return run


def _similar_components(heads: DataFrame, texts: DataFrame, p: Params) -> DataFrame:
    """(node, component) of every text that links with another. ``heads``: node, n, buckets, few; ``texts``: node, word_ids."""
    each = common.written(heads.select("node", "n", F.explode("buckets").alias("bucket")).unionByName(_prefixes(heads, p)))
    # nearly all buckets hold one text; five bytes of a bucket are enough to leave them out, the rest is counted in full
    each = each.withColumn("code", F.shiftrightunsigned("bucket", 24))
    often = common.cut(each.groupBy("code").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("code"))
    each = common.written(common.marked(each, often, "code", "often").where("often").select("node", "n", "bucket"))
    sizes = common.cut(each.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("leader")).where("size > 1"))
    meets = common.spread_join(each, sizes, ["bucket"]).where("node != leader").groupBy("leader", "node").agg(F.min("n").alias("n"))
    meets = common.cut(meets)
    groups = meets.groupBy("leader").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("total"))
    groups = common.cut(groups.withColumn("blocks", F.greatest(F.ceil(F.col("total") / p.block_words), F.ceil(F.col("size") / p.block_rows)).cast("long")))
    sums = groups.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).first()
    halls = max(1, -(-sums[0] // p.block_words), -(-sums[1] // p.block_rows))
    dealt = common.spread_join(meets, groups.drop("total"), ["leader"]).select("leader", "node", F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).alias("block"), "blocks")
    every_block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    dealt = dealt.unionByName(groups.select("leader", F.col("leader").alias("node"), every_block, "blocks"))
    # a block of a large group fills a hall by itself; small groups share halls
    hall = F.xxhash64("leader", "block")
    dealt = dealt.select("leader", "node", "block", F.when(F.col("blocks") > 1, hall).otherwise(F.pmod(hall, F.lit(halls))).alias("hall"))
    some = common.marked(texts, meets.select("node").unionByName(groups.select(F.col("leader").alias("node"))), "node", "met").where("met").drop("met")
    found = common.cut(dealt.join(some, "node").groupBy("hall").applyInPandas(_meet(p), "a long, b long").distinct())
    comps = common.components(found, "a", "b")
    large = groups.where("blocks > 1").select("leader", "size")
    if not large.limit(1).count():
        return comps
    comps = common.cut(comps)
    # groups of several blocks: texts outside of the largest component, against all
    mine = common.spread_join(meets, large, ["leader"]).join(comps, "node", "left").select("leader", "node", "n", F.coalesce("component", "node").alias("c"))
    mine = common.cut(mine)
    parts = mine.groupBy("leader", "c").agg(F.sum("n").alias("words"), F.count(F.lit(1)).alias("size"))
    top = parts.groupBy("leader").agg(F.max(F.struct("words", "c")).alias("m"), F.sum("words").alias("all"), F.sum("size").alias("size")).select("leader", "size", F.col("m.c").alias("main"), "all", (F.col("all") - F.col("m.words")).alias("minor"))
    count = lambda x: F.ceil(F.col(x) / p.block_words).cast("long")
    top = common.cut(top.where("minor > 0").select("leader", "size", "main", count("minor").alias("lefts"), count("all").alias("rights")))
    if not top.limit(1).count():
        return comps
    number = lambda n, to: F.pmod(F.xxhash64("node", F.lit(to)), F.col(n)).alias(to)
    spread = lambda n, to: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1)).alias(to)
    mine = common.spread_join(mine, top, ["leader"])
    some = common.marked(texts, mine.select("node"), "node", "met").where("met").drop("met")
    left = mine.where("c != main").select("leader", "node", "c", F.lit(True).alias("left"), number("lefts", "i"), spread("rights", "j"))
    right = mine.select("leader", "node", "c", F.lit(False).alias("left"), spread("lefts", "i"), number("rights", "j"))
    rest = left.unionByName(right).join(some, "node").groupBy("leader", "i", "j").applyInPandas(_across(p), "a long, b long")
    rest = common.cut(rest.distinct())
    return common.components(rest.unionByName(comps.select(F.col("node").alias("a"), F.col("component").alias("b"))), "a", "b")


def _classes(docs: DataFrame, p: Params, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows: id, sha) with an id, and one row per distinct text: sha, size, class_id, component_id, keeps.

    ``keeps``: the class whose row with the component's id stays.
    """
    known = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where(F.col("id").isNotNull())
    # one scan of the texts; what is kept of each is its hash, its buckets and its words, 4 bytes each: two words that
    # are compared are taken for equal with a chance of 2 ** -32 if they are not
    marks = known.withColumn("sha", F.unhex(F.sha2("text", 256))).mapInPandas(_sketches(p), "id long, sha binary, n long, buckets array<long>, few array<long>, word_ids binary")
    marks = common.written(marks.withColumn("node", F.xxhash64(F.monotonically_increasing_id())))
    rows = marks.select("id", "sha")
    classes = common.cut(marks.groupBy("sha").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("size"), F.min(F.when(F.col("word_ids").isNotNull(), F.col("node"))).alias("node"), F.count("word_ids").alias("sketched")))
    # only texts that more than one task has sketched are looked up by a shuffle
    heads = marks.where(F.col("word_ids").isNotNull() & (F.col("n") > 0)).select("sha", "node", "n", "buckets", "few")
    heads = common.marked(heads, classes.where("sketched > 1").select("sha"), "sha", "again").drop("sha")
    chosen = heads.where("again").join(classes.select("node"), "node", "left_semi")
    heads = heads.where("not again").unionByName(chosen).drop("again")
    comps = common.cut(_similar_components(heads, marks.where("word_ids is not null").select("node", "word_ids"), p))
    linked = classes.join(comps, "node")
    least = linked.groupBy("component").agg(F.min(F.struct("class_id", "sha")).alias("least"))
    linked = common.cut(linked.join(least, "component").select("node", F.col("least.class_id").alias("component_id"), F.col("least.sha").alias("keeper")))
    info = classes.join(linked, "node", "left").select("sha", "size", "class_id", F.coalesce("component_id", "class_id").alias("component_id"), F.coalesce(F.col("keeper") == F.col("sha"), F.lit(True)).alias("keeps"))
    return rows, common.cut(info)


def groups(docs: DataFrame, params: Params | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, class_id, component_id, kept), one row for each row of ``docs``.

    class_id is the smallest id among rows with the same text (null counts as empty), component_id the
    smallest id that links between texts reach from there, kept marks the row that stays: the one with
    that id. Texts without any word (so also empty ones) link with equal texts only; a text of fewer words
    than a k-mer is one k-mer. Rows with a null id are their own group (class_id and component_id null,
    kept true). Ids may repeat: rows are known by id and text, so rows with one id and unrelated texts are in
    different groups, and each group keeps one; rows equal in both say the same. Empty tables give an empty
    result.
    """
    rows, info = _classes(docs, params or Params(), id_col, text_col)
    out = common.spread_join(rows, info, ["sha"]).select(F.col("id").alias(id_col), "class_id", "component_id", (F.col("keeps") & (F.col("id") == F.col("component_id"))).alias("kept"))
    null = F.lit(None).cast("long")
    alone = docs.where(F.col(id_col).isNull()).select(F.col(id_col), null.alias("class_id"), null.alias("component_id"), F.lit(True).alias("kept"))
    return out.unionByName(alone)


def keep_one(docs: DataFrame, params: Params | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that groups() keeps: one of each group, and all rows with a null id.

    Of rows that repeat both id and text one stays; a text without near copies is never lost, whatever its id.
    """
    rows, info = _classes(docs, params or Params(), id_col, text_col)
    sha, stay, hit = (common.spare(docs, x) for x in ("sha", "stay", "hit"))
    left = docs.withColumn(sha, F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)))
    # classes that lose all rows, and those that lose all but one
    gone = info.where("not keeps or size > 1").select(F.col("sha").alias(sha), "size", F.when(F.col("keeps"), F.col("component_id")).alias(stay), F.lit(True).alias(hit))
    gone = common.cut(gone)
    if gone.count() * 80 <= BROADCAST_BYTES:
        left = left.join(F.broadcast(gone.drop("size")), sha, "left")
    else:
        left = common.spread_join(left, gone, [sha], how="left")
    loses = F.col(hit).isNotNull() & F.col(id_col).isNotNull() & ~F.col(id_col).eqNullSafe(F.col(stay))
    left = left.where(~loses).drop(hit, stay)
    if rows.groupBy("id", "sha").count().where("count > 1").limit(1).count():
        left = left.where(F.col(id_col).isNull()).unionByName(left.where(F.col(id_col).isNotNull()).dropDuplicates([id_col, sha]))
    return left.select(*docs.columns)
