"""The operators against brute force, round trips and the edge cases that their docstrings state."""

import random
import re
import time
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

public_tokenizers = pytest.importorskip("public_tokenizers")

from siltworks.llm import embedding_dedup, exact_dedup, html_text, packing, quality, queries, sampling, sentence_pieces, token_counts, toxicity, url_filter, vocab  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BYTE, WORD, PIECE = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
ODD = ["", " ", "a  b", "x <|endoftext|> y<|endoftext|>z", "\n\n a\tb  c  d\x1c e\x85f", "it's 's 'S don't", "İstanbul ΣΑΣ ΟΔΟΣ. straße ﬁ é e\u0301", "a" * 500 + " " + "b" * 300, "日本語 123 4567", "..,, ,. ! ?!", "<|startoftext|> hi", "🙂 🙂🙂 a🙂", "▁▁ a"]


def prose(r, n):
    words = "the of and tion ing over under water stone light paper green house river table north seven".split()
    return " ".join(r.choice(words) + r.choice(["", "s", "er", ",", "."]) for _ in range(n))


def frame(spark, rows):
    """documents with columns whose names clash with those that the operators use themselves."""
    rows = [(i, t, None, "s", None, 1.0, "x", 5) for i, t in rows]
    return spark.createDataFrame(rows, DOCS + ", score double, row string, fp int").withColumnRenamed("row", "__row")


# --- exact dedup


def test_rice_codes_round_trip():
    for n in (0, 1, 2, 5, 1000):
        for top in (1 << 11, 1 << 40, 1 << 64):
            v = np.unique(np.random.default_rng(n).integers(0, top - 1, n, dtype=np.uint64, endpoint=True))
            v = v if n != 5 else np.append(v[:-1], np.uint64(top - 1))
            assert (exact_dedup.rice_decode(exact_dedup.rice_encode(v), len(v)) == v).all()
    v = np.arange(70, dtype=np.uint64)
    assert (exact_dedup.rice_decode(exact_dedup.rice_encode(v), 70) == v).all()


@pytest.mark.parametrize("bound", [0, 16 << 20])
def test_exact_groups(spark, monkeypatch, bound):
    monkeypatch.setattr(exact_dedup, "BROADCAST_BYTES", bound)
    rows = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "b"), (None, "b"), (6, "c" * 200_000), (7, "c" * 200_000), (8, "d"), (9, "a ")] + [(100 + i, "hot") for i in range(300)]
    docs = frame(spark, rows).repartition(5)
    got = {r["doc_id"]: r for r in exact_dedup.exact_groups(docs).collect() if r["doc_id"] is not None}
    assert (got[1]["keep_id"], got[1]["group_size"], got[1]["kept"]) == (2, 2, False)
    assert got[3]["keep_id"] == 4 and got[4]["kept"] and got[5]["group_size"] == 2 and got[5]["kept"]
    assert got[6]["keep_id"] == 7 and got[9]["group_size"] == 1
    assert got[100]["keep_id"] == 399 and got[100]["group_size"] == 300
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 4, 5, 7, 8, 9, 399]


def test_exact_repeated_rows_and_empty_table(spark):
    docs = frame(spark, [(1, "a"), (1, "a"), (2, "b")])
    assert [r["group_size"] for r in exact_dedup.exact_groups(docs).orderBy("doc_id").collect()] == [2, 2, 1]
    assert sorted(r["doc_id"] for r in exact_dedup.drop_copies(docs).collect()) == [1, 2]
    assert exact_dedup.exact_groups(frame(spark, [])).count() == 0


# --- tokens


def test_counts_equal_the_library():
    t, r = vocab.tokenizer(BYTE), random.Random(2)
    texts = [*ODD, None, prose(r, 900), "".join(r.choice("ab \n,é日") for _ in range(3000))]
    want = [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]
    assert token_counts.count_texts(texts, BYTE) == want
    for chunk, overlap in ((200, 16), (64, 2), (1000, 50)):
        assert [token_counts.count_huge(x, BYTE, chunk, overlap) if x else 0 for x in texts] == want


@pytest.mark.parametrize("kind", ["tabs", "lines", "double", "signs", "one letter", "spaces", "apostrophes", "special", "random", "digits"])
def test_huge_counts_encode_the_text_about_once(kind, monkeypatch):
    r, n = random.Random(1), 150_000
    text = {
        "tabs": lambda: "\t".join(r.choice(["ab", "c", "the"]) for _ in range(n // 2)),
        "lines": lambda: "\r\n".join(prose(r, 3) for _ in range(n // 20)),
        "double": lambda: "  ".join(prose(r, 1) for _ in range(n // 7)),
        "signs": lambda: "".join(chr(r.randrange(0x4E00, 0x9F00)) for _ in range(n)),
        "one letter": lambda: "a" * n,
        "spaces": lambda: " " * n + "a",
        "apostrophes": lambda: "'re'll's" * (n // 8),
        "special": lambda: "a  <|endoftext|>" * (n // 16),
        "random": lambda: "".join(r.choice("ab \n,é日'1.") for _ in range(n)),
        "digits": lambda: "".join(r.choice("0123456789") for _ in range(n)),
    }[kind]()
    real, seen = vocab.tokenizer(BYTE), []

    class Counting:
        def encode(self, x, **kw):
            seen.append(len(x))
            return real.encode(x, **kw)

    want = len(real.encode(text, add_special_tokens=False).ids)
    monkeypatch.setattr(vocab, "tokenizer", lambda path: Counting())
    assert token_counts.count_huge(text, BYTE) == want
    assert sum(seen) <= 1.3 * len(text) and max(seen) <= 2 * token_counts.HUGE


def test_counts_of_random_texts_equal_the_library():
    t, r = vocab.tokenizer(BYTE), random.Random(5)
    for k in range(400):
        parts = [" ", "  ", "\n", "\t", "'s", "'re", "'", "a", "Word", "été", "日本", "12", "!?", "<|endoftext|>", "\x1c", "\x85", "\u3000", "🙂", "e\u0301"]
        text = "".join(r.choice(parts) for _ in range(r.randrange(1, 300)))
        want = len(t.encode(text, add_special_tokens=False).ids)
        assert token_counts.count_texts([text], BYTE) == [want]
        assert token_counts.count_huge(text, BYTE, r.choice([64, 100, 200]), r.choice([8, 50])) == want


def test_counts_query(spark):
    docs = frame(spark, [(1, "a b"), (2, None), (1, "a b"), (None, "é")])
    out = token_counts.token_counts(docs, BYTE, 1)
    assert [(r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in out.orderBy("n_bytes", "doc_id").collect()] == [(0, 0, False), (2, 1, False), (3, 2, True), (3, 2, True)]
    assert token_counts.token_counts(frame(spark, []), BYTE, 1).count() == 0


def test_packing_is_whole_and_gapless(spark):
    t, r = vocab.tokenizer(WORD), random.Random(4)
    rows = [(i, prose(r, r.choice([3, 40, 300, 900]))) for i in range(60)] + [(100 + i, x) for i, x in enumerate(ODD)] + [(200, None), (200, None), (None, "a b"), (300, "word " * 3000)]
    out = packing.pack(frame(spark, rows), WORD, 512, shard_pieces=64).toPandas()
    want = sorted(zlib.crc32(np.array(ids[s : s + 512], "<u4").tobytes()) for _, x in rows for ids in [[*t.encode(x or "", add_special_tokens=False).ids, 0]] for s in range(0, len(ids), 512))
    assert sorted(out["ids_crc32"]) == want
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert g["length"].sum() <= 512 and (g["offset"] == g["length"].cumsum() - g["length"]).all()
    assert out["sequence_id"].nunique() <= 1.1 * out["length"].sum() / 512 + 2
    assert packing.pack(frame(spark, []), WORD).count() == 0


def test_search_empties_bins():
    lengths = np.array([50, 50, 60, 40, 55, 45])
    bad = [[0, 3], [1, 5], [2], [4]]
    assert len(packing.search([list(b) for b in bad], lengths, 100)) == 3


def test_search_ends_at_fewer_bins_than_best_fit(spark):
    r = random.Random(3)
    sizes = [r.randrange(649, 720) for _ in range(900)]
    fit = packing.best_fit(np.array(sizes) + 1, 2048)
    docs = spark.createDataFrame([(i, "word " * n) for i, n in enumerate(sizes)], "doc_id long, text string")
    out = packing.pack(docs, WORD, 2048).toPandas()
    assert sorted(out["length"]) == sorted(n + 1 for n in sizes)
    assert out.groupby("sequence_id")["length"].sum().max() <= 2048
    print(f"best fit: {len(fit)} sequences, after the search: {out['sequence_id'].nunique()}")
    assert out["sequence_id"].nunique() <= 0.97 * len(fit)


def test_search_keeps_every_item():
    r = random.Random(4)
    for _ in range(60):
        lengths = np.array([r.randrange(1, 100) for _ in range(r.randrange(1, 120))])
        start = packing.best_fit(lengths, 100)
        bins = packing.search([list(b) for b in start], lengths, 100, block=r.choice([4, 128]))
        assert sorted(i for b in bins for i in b) == list(range(len(lengths))) and len(bins) <= len(start)
        assert all(lengths[b].sum() <= 100 for b in bins)


def test_sentence_pieces_equal_the_library(spark):
    m, r = sentence_pieces.model(PIECE), random.Random(6)
    texts = [*ODD, prose(r, 120), "".join(r.choice("ab c\n é日") for _ in range(800)), " " * 45 + "a", "x" * 200]
    rows = spark.createDataFrame(list(enumerate(texts)) + [(99, None)], "doc_id long, text string").withColumnRenamed("doc_id", "ids_of")
    for giant, chunk, fan in ((1 << 16, 1 << 13, 64), (10, 7, 3), (10, 100, 64)):
        got = {x["ids_of"]: x["ids"] for x in sentence_pieces.encode(rows, PIECE, giant=giant, chunk=chunk, fan=fan).collect()}
        assert got == {i: m.library.encode(x or "") for i, x in [*enumerate(texts), (99, None)]}
    for x in texts:
        ids = m.library.encode(x)
        assert sentence_pieces.decode_ids(ids, PIECE, 5) == m.library.decode(ids)


def test_sentence_digest_round_trip(spark):
    rows = spark.createDataFrame([(1, "Hello, wörld  \n x"), (2, None), (1, "Hello, wörld  \n x"), (None, "a" * 70_000)], "doc_id long, text string")
    out = sentence_pieces.digest(sentence_pieces.encode(rows, PIECE), PIECE).orderBy("doc_id").collect()
    assert [r["round_trip"] for r in out] == [True] * 4 and out[3]["n_tokens"] == 0
    assert out[1] == out[2] and out[1]["decoded"] == "Hello, wörld  \n x" and zlib.crc32(np.array(out[1]["ids"], "<u4")) == out[1]["ids_crc32"]
    assert sentence_pieces.digest(sentence_pieces.encode(rows.limit(0), PIECE), PIECE).count() == 0


def test_matrices_of_monotonous_texts_are_quick():
    m, began = sentence_pieces.model(PIECE), time.perf_counter()
    for text in (" " * 70_000, "a" * 70_000, "=-" * 35_000):
        text = m.library.normalize(text)
        sentence_pieces.transfer(m, text, 0, len(text))
    assert time.perf_counter() - began < 12


# --- classifiers


def labelled(r, n=240):
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = prose(r, 40).split()
        if toxic:
            words[r.randrange(40)] = r.choice(["zorgel", "blatfink"])
            words[r.randrange(40)] = r.choice(["zorgel", "blatfink"])
        good = i % 3 != 0
        rows.append((i, " ".join(words) if good else " ".join(w + "###" for w in words)))
        labels.append((i, int(good), int(toxic)))
    return rows, labels


def test_classifiers_learn_and_hold_out(spark):
    rows, labels = labelled(random.Random(8))
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for judge, k in ((toxicity.judge, 2), (quality.judge, 1)):
        got = judge(docs, marks).toPandas()
        assert len(got) == len(rows) and got["score"].between(0, 1).all()
        assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(got["doc_id"], got["held_out"], strict=True))
        held = got[got["held_out"]]
        right = np.mean([p == labels[i][k] for i, p in zip(held["doc_id"], held["predicted"], strict=True)])
        assert right >= 0.9
    assert toxicity.drop_toxic(docs, marks).columns == docs.columns
    assert quality.keep_good(docs, marks).columns == docs.columns


def test_classifiers_without_labels_nulls_and_empty(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = frame(spark, [(1, None), (None, ""), (2, "x " * 50_000)])
    assert toxicity.judge(docs, none).where("predicted = 0").count() == 3
    assert quality.judge(docs, none).where("score = 0.5").count() == 3
    assert toxicity.judge(frame(spark, []), none).count() == 0 and quality.judge(frame(spark, []), none).count() == 0


def test_ftrl_equals_a_plain_version():
    r = random.Random(2)
    rows, labels = labelled(r, 60)
    p = toxicity.Params(epochs=3, min_rows=1, l1_share=0.001)
    made = toxicity._learn_shard(p)((0,), pd.DataFrame({"order": range(60), "text": [t for _, t in rows], "y": [bool(x[2]) for x in labels]}))
    docs = [sorted(set(toxicity.features(t).tolist())) + ["intercept"] for _, t in rows]
    z, n, w = {}, {}, {}

    def weight(f):
        zf, l1 = z.get(f, 0.0), 0.0 if f == "intercept" else 0.001 * 60
        return 0.0 if abs(zf) <= l1 else -(zf - (l1 if zf > 0 else -l1)) / ((p.beta + n.get(f, 0.0) ** 0.5) / p.alpha)

    for _ in range(3):
        for d, (_, _, y) in zip(docs, labels, strict=True):
            w = {f: weight(f) for f in d}
            g = 1 / (1 + np.exp(-sum(w.values()))) - y
            for f in d:
                old = n.get(f, 0.0)
                z[f] = z.get(f, 0.0) + g - ((old + g * g) ** 0.5 - old**0.5) / p.alpha * w[f]
                n[f] = old + g * g
    want = {f: weight(f) for f in z if weight(f) and f != "intercept"}
    got = dict(zip(made["feature"][~made["intercept"]].to_numpy(np.int64).view(np.uint64).tolist(), made["weight"][~made["intercept"]], strict=True))
    assert got.keys() == want.keys() and all(abs(got[f] - want[f]) < 1e-9 for f in want)
    assert abs(made["weight"][made["intercept"]].iloc[0] - weight("intercept")) < 1e-9


def test_long_texts_repeated_ids_and_rows_are_learnt_from(spark):
    """Toxic texts are long and learnt from whole; some ids have two texts; labels of absent documents do not count."""
    r = random.Random(5)
    rows, labels = labelled(r, 400)
    rows = [(i, (t + " ") * 150 if labels[i][2] else t) for i, t in rows]
    rows += [(1, "another text"), (1, rows[1][1]), (2, rows[2][1])]
    labels += [(10_000 + k, 1, 1) for k in range(500)]
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    sample, n, taken = sampling.labelled_sample(docs, marks, "toxic", lambda n: dict(n), "x")
    got = sample.toPandas()
    learnable = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    assert len(got) == len(learnable) == sum(n.values()) and got["y"].sum() == n[True] == sum(labels[i][2] for i in learnable)
    assert set(got.loc[got["y"], "text"]) <= {t for _, t in rows} and (got["text"].str.len() > 3_900).sum() == n[True]
    judged = toxicity.judge(docs, marks, toxicity.Params()).toPandas()
    assert len(judged) == len(rows)
    held = judged[judged["held_out"]]
    assert np.mean([p == labels[i][2] for i, p in zip(held["doc_id"], held["predicted"], strict=True)]) >= 0.9


def test_features_do_not_depend_on_the_parts_they_are_read_in():
    text = prose(random.Random(3), 500) + " Σας ΟΔΟΣ"
    whole = np.sort(toxicity.features(text))
    for most in (1, 2, 3, 7, 100):
        assert (np.sort(np.concatenate(list(toxicity.parts(text, most)))) == whole).all()
    words = toxicity.WORD.findall(text.lower())
    assert len(whole) == 3 * len(words) - 3 and len(toxicity.features("one")) == 1 and len(toxicity.features(None)) == 0


def test_gradients_of_whole_texts_come_from_their_best_chunks():
    p = quality.Params(chunk=16, width=4, embed=3, filters=5, hidden=4, stride=2, batch_chunks=3)
    w, r = quality._start(p), random.Random(4)
    docs = [quality.chunks(prose(r, n), p) for n in (1, 40, 300)]
    y, weight = np.array([1, 0, 1], np.float32), np.ones(3)
    few = quality._winners(docs, w, p)
    assert len(few[2]) <= 4 < len(docs[2])
    whole = quality._gradients(docs, y, weight, w, p)
    for k, g in quality._gradients(few, y, weight, w, p).items():
        assert np.allclose(g, whole[k], atol=1e-6)


def test_network_equals_a_plain_version():
    p = quality.Params(chunk=16, width=4, embed=3, filters=5, hidden=4, stride=2, batch_chunks=2)
    w = {k: v.astype(np.float64) for k, v in quality._start(p).items()}
    for text in ("hello world, this is a text of some chunks", "", "é"):
        data = text.encode()
        data += bytes(max(1, -(-len(data) // 16)) * 16 + 4 - len(data))
        pooled = np.zeros(4)
        for a in range(0, len(data) - 4, 16):
            part = data[a : a + 20]
            best = np.max([np.concatenate([w["embed"][b] for b in part[s : s + 4]]) @ w["conv"] for s in range(0, 17, 2)], axis=0)
            pooled = np.maximum(pooled, np.maximum(np.maximum(best + w["conv_b"], 0) @ w["dense"] + w["dense_b"], 0))
        want = 1 / (1 + np.exp(-(pooled @ w["out"] + w["out_b"][0])))
        assert abs(quality.probability([text], w, p)[0] - want) < 1e-6


def test_network_gradients():
    p = quality.Params(chunk=16, width=4, embed=3, filters=5, hidden=4, stride=1)
    r = np.random.default_rng(0)
    w = {k: (v + r.normal(0, 0.1, v.shape)).astype(np.float64) for k, v in quality._start(p).items()}
    docs, y, s = [quality.chunks(t, p) for t in ("hello world, this is it", "zz", "")], np.array([1.0, 0.0, 1.0]), np.ones(3)
    g = quality._gradients(docs, y, s, w, p)

    def loss():
        q = np.array([np.maximum.reduce(quality._units(d, w, p)) @ w["out"] + w["out_b"][0] for d in docs])
        return np.mean(np.log1p(np.exp(q)) - y * q)

    for k in w:
        for at in list(np.ndindex(w[k].shape))[:: max(1, w[k].size // 7)]:
            old = w[k][at]
            w[k][at] = old + 1e-6
            up = loss()
            w[k][at] = old - 1e-6
            down = loss()
            w[k][at] = old
            assert abs((up - down) / 2e-6 - g[k][at]) < 1e-4


def test_network_reads_the_whole_text():
    p = quality.Params()
    w = quality._start(p)
    long = "ab " * 20_000
    assert quality.probability([long], w, p)[0] != quality.probability([long + "#$%&" * 200], w, p)[0]
    assert quality.chunks(long, p).shape[0] == -(-len(long) // p.chunk)


# --- URLs, pages, vectors

RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]


def test_url_rules(spark):
    urls = ["HTTP://WWW.Example.COM/en/7x?q#f", None, "foo", "http://a.net?x=/de/", "https://example.net/de/85", "http://x.example.net/de/9#/x", "http://notexample.com/en/7", "com://com/en/", "http://b.org#/es/", "x://y://z/p?"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = [(r["host"], r["path"], r["rule"]) for r in url_filter.apply_rules(df, RULES).orderBy("page_id").collect()]
    assert got == [
        ("www.example.com", "/en/7x", "example.com/en/7"), ("", "", None), ("", "", None), ("a.net", "", None), ("example.net", "/de/85", "example.net/de/8"),
        ("x.example.net", "/de/9", "net/de/"), ("notexample.com", "/en/7", "com/en/"), ("com", "/en/", "com/en/"), ("b.org", "", None), ("y:", "//z/p", None),
    ]


def test_url_trees_judge_what_rules_leave(spark):
    rows = [(i, f"http://h{i % 9}.example.{'com' if i % 2 else 'net'}/{'en' if i % 2 else 'de'}/{i}{'?a=1&b=2&c=3' * (i % 2)}") for i in range(120)]
    rows += [(500 + i, f"http://k{i}.test/x/{i}?a=1&b=2&c=3") for i in range(5)] + [(600, None), (601, "")]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), RULES)
    assert got.count() == len(rows) and got.where("verdict is null").count() == 0
    assert all(r["verdict"] == ("block" if r["score"] >= 0.5 else "allow") for r in got.where("rule is null").collect())
    assert url_filter.judge(spark.createDataFrame([(1, "x")], "page_id long, url string"), RULES).first()["verdict"] == "allow"
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string"), RULES).count() == 0


def test_url_trees_on_urls_kept_out(spark):
    """Learnt from four fifths of what rules decide, the trees judge the last fifth, under hosts of the same kinds."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    base = url_filter.apply_rules(pages, RULES).withColumn("suffix", url_filter.suffix(F.col("host")))
    decided = base.where("rule is not null").withColumn("y", (F.col("rule_verdict") == "block").cast("double"))
    last = F.pmod(F.xxhash64("url", F.lit("test")), F.lit(5)) == 0
    judged = url_filter.scores(decided.where(last), url_filter.learn(decided.where(~last)), ["y"]).toPandas()
    right = ((judged["score"] >= 0.5) == (judged["y"] == 1)).mean()
    print(f"{right:.1%} of {len(judged)} right; {max(judged['y'].mean(), 1 - judged['y'].mean()):.1%} by the more frequent verdict")
    assert len(judged) > 20 and right >= max(judged["y"].mean(), 1 - judged["y"].mean())


def test_url_odd_tables(spark):
    long = "http://a.example.net/de/" + "x" * 300_000 + "?q=" + "1" * 300_000
    rows = [(1, long, "h", 1.0), (1, long, "h", 1.0), (2, "http://com/en/", None, None), (None, None, None, None)]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, host string, score double"), RULES).orderBy("page_id").collect()
    assert [(r["page_id"], r["rule"], r["verdict"]) for r in got] == [(None, None, got[0]["verdict"]), (1, "net/de/", "allow"), (1, "net/de/", "allow"), (2, "com/en/", "block")]
    assert got[1]["path"] == "/de/" + "x" * 300_000 and got[2]["host"] == "a.example.net"


@pytest.mark.parametrize("bound", [None, 0])
def test_url_suffixes_all_have_statistics(spark, monkeypatch, bound):
    if bound is not None:
        monkeypatch.setattr(url_filter, "BROADCAST_BYTES", bound)
    r, rows, want = random.Random(4), [], {}
    for k in range(400):
        name = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8))
        top = "com" if k % 2 else "org"
        for _ in range(6):
            rows.append((len(rows), f"https://{name}.{top}/x/{r.randrange(10**6)}"))
        want[len(rows)] = "block" if k % 2 else "allow"
        rows.append((len(rows), f"https://{name}.{top}/y/{r.randrange(10**6)}"))
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), [("block", "com/x"), ("allow", "org/x")])
    verdicts = {x["page_id"]: x["verdict"] for x in got.collect()}
    assert len(verdicts) == len(rows) and {i: verdicts[i] for i in want} == want


def test_main_text():
    page = """<html><body class="has-sidebar"><header><h1>Site</h1><p>welcome, to, the, site, a, b, c</p></header><div id="cookie-notice"><p>We use cookies, and more, text text</p></div>
    <div id=main><div class="post-content"><h2>Title &amp; more</h2><p>First paragraph, with <a href=x>link</a> text&nbsp;here, long enough to count, yes.</p><div><p>Second, para one.<p>Third</div>
    <form><p>name, form, x</p><input></form><ul><li>item one<li>item two</ul><script>var t="</p>";</script></div>
    <aside><p>Side, bar, text, that is, rather long</p></aside><section id="comments"><p>A reader, says, things, that are, long long long</p></section></div><div class=footer><p>foo, bar</p></div></body>"""
    assert html_text.main_text(page) == "Title & more First paragraph, with link text here, long enough to count, yes. Second, para one. Third item one item two"
    for x, want in (("", ""), (None, ""), ("plain, text", "plain, text"), ("<div>" * 5000 + "x", "x"), ("<nav>a</nav>", ""), ("<p>a &am b &amp c", "a &am b & c")):
        assert html_text.main_text(x) == want


def test_main_text_around_drawings():
    a, b = "One, two, three and some words of the first paragraph.", "Second paragraph, with more words to read."
    for x in ("<svg viewBox='0 0 1 1'/>", "<svg/>", "<svg><svg><text>no</text></svg><text>no</text></svg>", "<svg><style/><path d='a'/></svg>", "<svg><path>", "<svg><foreignObject><div>no</svg>", "<math><mi>no</mi></math>", "<svg a=b/>no</svg>"):
        assert html_text.main_text(f"<body><article><p>{a}</p>{x}<p>{b}</p></article></body>") == f"{a} {b}", x


def test_main_text_inside_wrappers():
    a = "<h1>Head</h1><p>One, two, three and some words of the first paragraph.</p><p>Second paragraph, with more words to read.</p>"
    want = "Head One, two, three and some words of the first paragraph. Second paragraph, with more words to read."
    side, note = "<div class=sidebar><p>Read this too, please.</p></div>", "<div class=comments><div class=comment><p>I, for one, like it, so well, and more, and more.</p></div></div>"
    for page in (
        f"<div class='content-sidebar-wrap'><main><article>{a}</article></main>{side}</div>{note}",
        f"<div class='content-sidebar-wrap'><article>{a}</article>{side}</div>",
        f"<div id=page class='has-sidebar'><div class=content>{a}</div>{side}</div>",
        f"<form action=x><div class=content>{a}</div>{side}<select><option>no</select></form>",
        f"<div role=dialog><article>{a}</article></div>",
        f"<div class=content>{a}</div><div class=related><article><p>Another story, in short.</p></article></div>{side}{note}",
    ):
        assert html_text.main_text(f"<body>{page}</body>") == want, page


def test_broken_pages_are_read_in_linear_time():
    n = 1 << 18
    for x in ("<a", "<b>", "<div>", "<p>", "<li>", "<a ", "<", "<!", "</", "<a '", '<a "> ', '<a " > " ', "<b><div></div>", "<li><table>", "<svg>", "<svg/><g>", "<script ", "</b>", "<!--", "&", "&#", "<p><b>", "<td><li>", "<b></li><li></li>"):
        began = time.perf_counter()
        html_text.main_text(x * (n // len(x)))
        html_text.main_text(x * (n // len(x)) + "'><script>" + "</script " * 9_000)
        assert time.perf_counter() - began < 8, x


def test_tags_with_and_without_closed_quotes_end_where_a_plain_reading_says():
    rest, r, ends = re.compile(r"""(?:"[^"]*"|'[^']*'|[^>"'])*+>"""), random.Random(8), 0
    for _ in range(3_000):
        page = "".join(r.choice("\"'>ab" if r.random() < 0.5 else "b") for _ in range(r.randrange(120))) + ">"
        tree = html_text.Tree("")
        for at in range(0, len(page), 3):  # what was learnt from one tag holds for the next ones
            m = rest.match(page, at)
            ends += m is None
            assert tree._tag_end(page, at) == (m.end() - 1 if m else page.find(">", at)), (page, at)
    assert ends > 1_000


def test_the_fortieth_loose_quote_is_read_like_the_first():
    loose = '<b ">"some words, and ' * 40  # none of these tags ends outside of quotes
    got = html_text.main_text(f"<body><article><p>{loose}\"<i title='a > b'>the end of it.")
    assert got.count("some words, and") == 40 and got.endswith("the end of it.") and "b'" not in got


def test_headings_and_notes_inside_articles_stay():
    body = "<p>One, two, three and some words of the first paragraph.</p><p>Second paragraph, with more words to read.</p>"
    page = f"<body><div class=header><p>Site, name, and, so, on</p></div><article><div class='entry-header'><h1>Title</h1></div>{body}<div class='legal-notice'><p>What the law says, in short.</p></div><div class='toc'><a href=x>One</a> <a href=y>Two</a></div><div class=comments><p>I, for one, like it, so well.</p></div></article></body>"
    assert html_text.main_text(page) == "Title One, two, three and some words of the first paragraph. Second paragraph, with more words to read. What the law says, in short."


def test_extraction_of_odd_tables(spark):
    pages = spark.createDataFrame([(1, "<p>a</p>", "x", 5), (1, "<p>a</p>", "x", 5), (None, None, None, None)], "page_id long, html string, text string, n_chars int")
    got = html_text.extract(pages)
    assert got.columns == pages.columns and [tuple(r) for r in got.orderBy("page_id").collect()] == [(None, None, "", 0), (1, "<p>a</p>", "a", 1), (1, "<p>a</p>", "a", 1)]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_pages_equal_their_articles(spark):
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in html_text.extract(pages).collect():
        body = r["html"].split("<article>")[1].split("</article>")[0]
        assert r["text"] == " ".join(html.unescape(re.sub(r"</?(p|h1|br)>", " ", body.replace("<b>", ""))).split())
        assert r["n_chars"] == len(r["text"])


def test_vectors_equal_brute_force(spark):
    r = np.random.default_rng(9)
    base = r.normal(size=(6, 8))
    rows = [(i, [float(np.float32(x)) for x in base[i % 6] + r.normal(size=8) * r.choice([0, 0.05, 0.1, 0.2])], int(i % 2)) for i in range(160)]
    rows += [(900, None, 0), (901, [0.0] * 8, 0), (902, [float("nan")] * 8, 0), (903, [1.0, None], 0), (904, [1.0] * 8, None), (905, [], 1), (906, [1.0, 2.0], 1), (907, [2.0, 4.0], 1)]
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])
    df = spark.createDataFrame(rows, schema)
    x = {i: np.array(v, float) for i, v, g in rows if v and g is not None and all(e is not None and np.isfinite(e) for e in v) and any(v)}
    group = {i: g for i, _, g in rows}
    links = {i: {j for j in x if j != i and i in x and group[i] == group[j] and len(x[i]) == len(x[j]) and x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= 0.98} for i, _, _ in rows}
    want = {}
    for i, _, _ in sorted(rows, key=lambda t: t[0]):
        if i in want:
            continue
        todo = [i]
        while todo:
            k = todo.pop()
            if k not in want:
                want[k] = i
                todo += links[k]
    for tile, most in ((1024, 1024), (8, 1024), (8, 3)):
        got = embedding_dedup.near_copies(df, tile=tile, most_dims=most).toPandas().set_index("vec_id")
        assert {i: int(n) for i, n in got["n_links"].items()} == {i: len(v) for i, v in links.items()}
        assert {i: int(c) for i, c in got["component_id"].items()} == want
    assert embedding_dedup.near_copies(df.limit(0)).count() == 0


def test_embedding_repeated_ids_with_other_vectors_and_labels(spark):
    """Rows of one id are rows of their own: links follow vectors and labels only."""
    rows = [(5, [1.0, 0.0], 0), (5, [0.0, 1.0], 0), (5, [1.0, 0.0], 1), (7, [1.0, 0.01], 0), (9, [1.0, 0.02], 1), (3, [0.0, 1.0], 0), (8, [1.0] * 3, 1)] + [(20 + d, [1.0] * d, 2) for d in range(1, 13)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((x["vec_id"], x["n_links"], x["component_id"], x["kept"]) for x in embedding_dedup.near_copies(df).where("vec_id < 20").collect())
    assert got == [(3, 1, 3, True), (5, 1, 3, False), (5, 1, 5, True), (5, 1, 5, True), (7, 1, 5, False), (8, 0, 8, True), (9, 1, 5, False)]
    assert embedding_dedup.near_copies(df).where("vec_id >= 20").select("vec_id").where("vec_id = 32").count() == 1


def test_repeated_vector_ids(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, [1.0, 0.0], 0)], "vec_id long, embedding array<float>, label int")
    got = embedding_dedup.near_copies(df).toPandas()
    assert sorted(got["n_links"]) == [0, 1, 1]
    assert pd.isna(got[got["vec_id"].isna()]["component_id"]).all()


def test_vectors_of_any_length_and_clashing_columns(spark):
    r = np.random.default_rng(4)
    a = r.normal(size=1500)
    rows = [(1, a.tolist(), 0), (2, (a + 0.01 * r.normal(size=1500)).tolist(), 0), (3, r.normal(size=1500).tolist(), 0)]
    df = spark.createDataFrame([(*x, 7, "x", 1.0, 2) for x in rows], "vec_id long, embedding array<double>, label int, node int, key string, v double, tile int")
    got = {x["vec_id"]: (x["n_links"], x["component_id"], x["kept"]) for x in embedding_dedup.near_copies(df).collect()}
    assert got == {1: (1, 1, True), 2: (1, 1, False), 3: (0, 3, True)}


def test_vectors_at_exactly_the_threshold(spark):
    """cos((3, 4), (1, 0)) is 0.6 in double precision: a link at 0.6, none just above."""
    df = spark.createDataFrame([(1, [3.0, 4.0], 0), (2, [1.0, 0.0], 0), (3, [-0.0, 1.0], 1), (4, [0.0, 1.0], 1)], "vec_id long, embedding array<double>, label int")
    for t, n in ((0.6, 1), (0.6 + 1e-12, 0)):
        assert {x["vec_id"]: x["n_links"] for x in embedding_dedup.near_copies(df, t).collect()} == {1: n, 2: n, 3: 1, 4: 1}


def test_vector_query_equals_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.01/embeddings.parquet'")
    got = queries.QUERIES["op10_embedding_dedup"](spark, "/root/testdata/sf0.01")
    result = con.execute(queries.ORACLES["op10_embedding_dedup"])
    names = [d[0] for d in result.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(result.fetchall())


COUNTABLE = {
    "op4_token_counts": "SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n_bytes FROM documents",
    "op5_url_filter": """
        WITH a AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        b AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
        r(h, p, rule) AS (VALUES ('com', '/en/', 'com/en/'), ('example.com', '/en/7', 'example.com/en/7'), ('net', '/de/', 'net/de/'), ('example.net', '/de/8', 'example.net/de/8'), ('org', '/es/', 'org/es/'))
        SELECT page_id, host, path, (SELECT arg_max(rule, length(rule)) FROM r WHERE (host = h OR host LIKE '%.' || h) AND starts_with(path, p)) AS rule FROM b""",
}


@pytest.mark.parametrize("name", COUNTABLE)
def test_countable_columns_equal_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for x in ("documents", "pages"):
        con.execute(f"CREATE VIEW {x} AS SELECT * FROM '/root/testdata/sf0.001/{x}.parquet'")
    result = con.execute(COUNTABLE[name])
    names = [d[0] for d in result.description]
    got = queries.QUERIES[name](spark, "/root/testdata/sf0.001").select(*names).collect()
    assert sorted(map(tuple, got), key=str) == sorted(result.fetchall(), key=str)
