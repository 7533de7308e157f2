"""Near-dedup against brute force over the edit similarity of words, and the edge cases of its docstrings."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from siltworks.llm import common, near_dedup  # noqa: E402

from .test_operators import frame, prose  # noqa: E402


def banded(a, b, band):
    m = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + 1 if a[i] == b[j] and abs(i - j) <= band else 0)
    return m[-1][-1]


def edit_similarity(a, b):
    d = np.arange(len(b) + 1)
    for i, w in enumerate(a):
        new = np.concatenate([[i + 1], np.minimum(d[:-1] + (b != w), d[1:] + 1)])
        k = np.arange(len(new))
        d = np.minimum.accumulate(new - k) + k
    return 1 - d[-1] / max(len(a), len(b))


def kept_share(a, b):
    return banded(a.tolist(), b.tolist(), len(a) + len(b)) / max(len(a), len(b))


def brute_groups(rows, p):
    rows = [(i, t or "") for i, t in rows]
    ids = [near_dedup.word_ids(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for x in range(len(rows)):
        for y in range(x):
            if rows[x][1] == rows[y][1] or (len(ids[x]) and len(ids[y]) and kept_share(ids[x], ids[y]) >= p.threshold - 1e-9):
                root[top(x)] = top(y)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[top(k)] = min(i, least.get(top(k), i))
    return {i: least[top(k)] for k, (i, _) in enumerate(rows)}


def edited(r, words, share):
    """``words`` with so many substitutions, insertions and deletions, all apart."""
    out = list(words)
    for k in sorted(r.sample(range(len(words)), int(share * len(words))), reverse=True):
        kind = r.randrange(3)
        out[k : k + 1] = [[f"new{r.randrange(10**6)}"], [out[k], f"new{r.randrange(10**6)}"], []][kind]
    return out


def test_alignment_is_the_longest_within_its_band():
    r = random.Random(3)
    for k in range(300):
        a, b = (np.array([r.randrange(2 + k % 30) for _ in range(r.randrange(1, 40))], np.uint32) for _ in range(2))
        assert near_dedup.aligned(a, b, 80) == banded(a, b, 80)
        assert banded(a, b, 5) <= near_dedup.aligned(a, b, 5) <= banded(a, b, 80)
    base = [r.randrange(10**6) for _ in range(1500)]  # several blocks of rows
    a, b = np.array(base, np.uint32), np.array(edited(r, base, 0.0) + [1, 2, 3], np.uint32)
    for _ in range(150):
        k = r.randrange(len(b))
        b = np.concatenate([b[:k], b[k + 1 :]]) if r.random() < 0.5 else np.insert(b, k, r.randrange(10**6))
    assert near_dedup.aligned(a, b, 300) == banded(a.tolist(), b.tolist(), 3000)


@pytest.mark.parametrize("block_words", [1 << 20, 400])
def test_groups_equal_brute_force(spark, block_words):
    r, p = random.Random(5), near_dedup.Params(block_words=block_words)
    base = [prose(r, 60).split() for _ in range(4)]
    rows = []
    for i in range(70):
        words = list(base[i % 4])
        for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
            words[r.randrange(len(words))] = f"w{r.randrange(50)}"
        rows.append((i + 10, " ".join(words)))
    rows += [(1, None), (2, ""), (3, "one two"), (4, "one  two!"), (5, "?!"), (6, "..."), (7, "one two three four five six")]
    got = {x["doc_id"]: x for x in near_dedup.groups(frame(spark, rows), p).collect()}
    assert {i: x["component_id"] for i, x in got.items()} == brute_groups(rows, p)
    assert all(x["kept"] == (i == x["component_id"]) for i, x in got.items())


@pytest.mark.parametrize("block_words", [1 << 20, 2000])
def test_a_passage_in_many_texts_links_none_but_copies(spark, block_words):
    """One passage makes one large group of otherwise unrelated texts; the near copies among them are found."""
    r = random.Random(6)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join([*(f"w{r.randrange(10**6)}" for _ in range(30)), *passage, *(f"w{r.randrange(10**6)}" for _ in range(30))])) for i in range(150)]
    rows += [(1000 + k, " ".join(edited(r, rows[k][1].split(), 0.1))) for k in range(0, 150, 10)]
    got = {x["doc_id"]: x["component_id"] for x in near_dedup.groups(frame(spark, rows), near_dedup.Params(block_words=block_words)).collect()}
    assert got == {i: i - 1000 if i >= 1000 else i for i, _ in rows}


def test_all_short_pairs_are_found(spark):
    """Words changed in the middle of texts of 5 to 40 words, where no run of five words may be left."""
    r, p, rows = random.Random(8), near_dedup.Params(), []
    for k in range(60):
        words = [f"w{r.randrange(10**6)}" for _ in range(r.choice([5, 6, 8, 9, 10, 14, 25, 40]))]
        family = [words] + [edited(r, words, 0.2) for _ in range(r.choice([1, 1, 2, 3]))]
        rows += [(10 * k + j, " ".join(t)) for j, t in enumerate(family)]
    r.shuffle(rows)
    got = {x["doc_id"]: x["component_id"] for x in near_dedup.groups(frame(spark, rows), p).collect()}
    assert got == brute_groups(rows, p)
    assert all(got[10 * k + 1] == 10 * k for k in range(60))


@pytest.mark.parametrize(("share", "least"), [(0.05, 0.99), (0.1, 0.99), (0.15, 0.95), (0.19, 0.8)])
def test_recall_of_sketches_by_edit_similarity(share, least):
    r, p, hit = random.Random(int(share * 100)), near_dedup.Params(), 0
    for _ in range(150):
        a = [f"w{r.randrange(10**6)}" for _ in range(300)]
        one, two = (set(near_dedup.sketches(near_dedup.word_ids(" ".join(t)), p).tolist()) for t in (a, edited(r, a, share)))
        hit += bool(one & two)
    print(f"edits in {share:.0%} of the words: {hit / 150:.1%} of pairs share a sketch")
    assert hit >= least * 150


def spread(r, words, similarity, how):
    """So many words replaced: as far apart as can be, at random places, or in runs of some ten."""
    n = len(words)
    k = int(n * (1 - similarity) + 1e-9)
    if how == "even":
        at = [int((i + 0.5) * n / k) for i in range(k)]
    elif how == "random":
        at = r.sample(range(n), k)
    else:
        at = sorted(range(n), key=lambda i: (hash((i // 10, r.random() if i % 10 == 0 else 0)), i))[:k]
    out = list(words)
    for i in at:
        out[i] = f"x{r.randrange(10**9)}"
    return out


@pytest.mark.parametrize("how", ["even", "random", "runs"])
@pytest.mark.parametrize("n", [50, 100, 300, 1000])
@pytest.mark.parametrize("similarity", [0.8, 0.833, 0.857, 0.875, 0.9])
def test_recall_of_sketches_wherever_edits_are(similarity, n, how):
    r, p, hit, trials = random.Random(f"{similarity}{n}{how}"), near_dedup.Params(), 0, 150
    for _ in range(trials):
        a = [f"w{r.randrange(10**6)}" for _ in range(n)]
        one, two = (set(near_dedup.sketches(near_dedup.word_ids(" ".join(t)), p).tolist()) for t in (a, spread(r, a, similarity, how)))
        hit += bool(one & two)
    print(f"{how} {n} words, similarity {similarity}: {hit / trials:.1%} of pairs share a sketch")
    assert hit >= 0.9 * trials


def test_pairs_at_the_threshold_are_joined(spark):
    """Texts of 300 words with every sixth word changed (0.833), through the whole operator."""
    r = random.Random(11)
    rows = []
    for i in range(40):
        a = [f"w{r.randrange(10**6)}" for _ in range(300)]
        rows += [(2 * i, " ".join(a)), (2 * i + 1, " ".join(spread(r, a, 0.8334, "even")))]
    got = {x["doc_id"]: x["component_id"] for x in near_dedup.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[2 * i] == got[2 * i + 1] for i in range(40)) >= 38 and all(got[2 * i] == 2 * i for i in range(40))


def test_recall_on_documents(spark):
    """Every pair of different texts of sf0.01 at an edit similarity of 0.8 is in one group; no group without a link."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    group = {r["doc_id"]: r["component_id"] for r in near_dedup.groups(docs).collect()}
    one = {t: i for i, t in texts.items()}
    ids = {i: near_dedup.word_ids(t).astype("<u4") for t, i in one.items()}
    held = {i: np.sort(near_dedup.labelled(x.astype(np.uint64))) for i, x in ids.items()}
    order, pairs, found = sorted(i for i in ids if len(ids[i])), 0, 0
    linked = set()
    for k, x in enumerate(order):
        for y in order[:k]:
            a, b = ids[x], ids[y]
            most = max(len(a), len(b))
            if min(len(a), len(b)) >= 0.8 * most and near_dedup.overlap(held[x], held[y]) >= 0.8 * most:
                if edit_similarity(a, b) >= 0.8:
                    pairs += 1
                    found += group[x] == group[y]
                if near_dedup.aligned(a, b, most) >= 0.8 * most:
                    linked |= {texts[x], texts[y]}
    print(f"{found} of {pairs} pairs found")
    assert pairs > 50 and found >= 0.9 * pairs
    members = pd.Series(group).groupby(pd.Series(group)).transform("size")
    copies = pd.Series(texts).groupby(pd.Series(texts)).transform("size")
    assert all(texts[i] in linked for i in texts if members[i] > copies[i])


def test_giant_texts(spark):
    r = random.Random(9)
    words = [f"w{r.randrange(10**5)}" for _ in range(60_000)]
    docs = frame(spark, [(1, " ".join(words)), (2, " ".join(edited(r, words, 0.05))), (3, " ".join(reversed(words)))])
    assert {x["doc_id"]: x["component_id"] for x in near_dedup.groups(docs).collect()} == {1: 1, 2: 1, 3: 3}


def test_scripts_without_spaces():
    assert len(near_dedup.word_ids("日本語の文 and two")) == 7
    assert len(near_dedup.word_ids("été Straße ΣΑΣ")) == 3


def test_keep_one_and_edges(spark):
    text = prose(random.Random(1), 80)
    docs = frame(spark, [(1, text), (2, text + " end"), (3, text), (None, text), (4, "other words entirely"), (5, "x " * 30_000)])
    left = near_dedup.keep_one(docs)
    assert left.columns == docs.columns
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in left.collect()) == [-1, 1, 4, 5]
    assert near_dedup.groups(frame(spark, [])).count() == 0 and near_dedup.keep_one(frame(spark, [])).count() == 0


@pytest.mark.parametrize("bound", [16 << 20, 0])
def test_repeated_ids_lose_no_text(spark, monkeypatch, bound):
    monkeypatch.setattr(near_dedup, "BROADCAST_BYTES", bound)
    a, b, c = (prose(random.Random(k), 50) for k in (2, 3, 4))
    docs = frame(spark, [(1, a), (5, a), (5, b), (5, b), (5, c), (7, c + " end"), *[(100 + k, a) for k in range(300)]])
    assert sorted((r["doc_id"], r["text"]) for r in near_dedup.keep_one(docs).collect()) == sorted([(1, a), (5, b), (5, c)])
    assert {(r["doc_id"], r["class_id"], r["component_id"], r["kept"]) for r in near_dedup.groups(docs).where("doc_id < 100").collect()} == {(1, 1, 1, True), (5, 1, 1, False), (5, 5, 5, True), (7, 7, 5, False)}


def test_hot_keys_are_joined_apart(spark):
    rows = spark.createDataFrame([(1 if k < 600 else k,) for k in range(1000)], "k long")
    groups = rows.groupBy("k").count().withColumnRenamed("count", "size").withColumn("name", F.col("k"))
    joined = common.spread_join(rows, groups, ["k"])
    assert joined.count() == 1000 and joined.where("name = k").count() == 1000
    assert common.spread_join(rows, groups.where("k <> 1"), ["k"], how="left").where("name is null").count() == 600

def test_marks_lose_no_key(spark):
    rows = spark.range(50_000).withColumnRenamed("id", "k").withColumn("block", F.lit("x"))
    for n in (0, 1, 20_000):
        held = common.marked(rows, spark.range(n).select((2 * F.col("id")).alias("k")), "k", "in")
        assert held.columns == ["k", "block", "in"] and held.count() == 50_000
        mine = (F.col("k") % 2 == 0) & (F.col("k") < 2 * n)
        assert held.where(mine & F.col("in")).count() == n and held.where(~mine & F.col("in")).count() <= 0.1 * 50_000


def shuffled(spark) -> int:
    """Bytes that all stages of the session have written for shuffles."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_texts_that_meet_nothing_are_not_shuffled(spark):
    """Beside a group of several blocks, nothing but codes of buckets goes through a shuffle for texts without any candidate."""
    r, n, words = random.Random(12), 3000, 200
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(f"w{r.randrange(10**9)}" for _ in range(words))) for i in range(n)]
    rows += [(n + i, " ".join([*(f"w{r.randrange(10**6)}" for _ in range(30)), *passage])) for i in range(50)]
    docs, before = frame(spark, rows), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with larger tables
    try:
        at = shuffled(spark)
        assert near_dedup.groups(docs, near_dedup.Params(block_words=2000)).where("kept").count() == n + 50
        sent = shuffled(spark) - at
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    print(f"{sent / n:.0f} bytes a text")
    assert sent < n * 4 * words * 1.5


def test_a_worker_remembers_one_kind_of_work_at_a_time(monkeypatch):
    monkeypatch.setattr(common, "_kept", {})  # whatever earlier tests have left in this process
    first = near_dedup.word_ids("one two one")
    held = common.kept("words of near_dedup")["hashes"]
    assert set(held) == {"one", "two"} and common.kept("words of near_dedup")["hashes"] is held
    assert common.kept("other work") == {} and common.kept("words of near_dedup") == {}
    assert (near_dedup.word_ids("one two one") == first).all()
