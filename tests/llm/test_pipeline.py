"""The pipeline's stages in order, against plain versions of their decisions."""

import random

import pytest

pytest.importorskip("public_tokenizers")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from siltworks.llm import queries  # noqa: E402

from .test_operators import DOCS, labelled, prose  # noqa: E402


def test_stages(spark, tmp_path):
    r = random.Random(11)
    rows, labels = labelled(r)
    text = prose(r, 40)
    rows += [(1000, text), (1001, text), (1002, text + " more"), (1003, prose(r, 40)), (1004, prose(r, 40))]
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, seen = docs.columns, {}
    assert [k for k, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "exact_dedup", "near_dedup", "packing"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/out{k}")
        docs = spark.read.parquet(f"{tmp_path}/out{k}")
        seen[name] = {x["doc_id"] for x in docs.select("doc_id").collect()}
        if name != "packing":
            assert docs.columns == columns
    clean = {i for i, q, t in labels if q and not t}
    assert len(clean & seen["quality"]) >= 0.97 * len(clean)
    assert sum(t for i, _, t in labels if i in seen["toxicity"]) <= 0.1 * sum(t for _, _, t in labels)
    assert 1000 not in seen["exact_dedup"] and {1001, 1002} <= seen["exact_dedup"]
    assert 1001 in seen["near_dedup"] and 1002 not in seen["near_dedup"]
    assert seen["packing"] == seen["near_dedup"]


ODD = DOCS + ", score double, sha string, fp int, node long, size int"


def odd_documents(r):
    """(id, text): null and repeated ids, null, empty, blank and very long texts, exact and near copies, repeated rows."""
    long = prose(r, 20_000)
    near = prose(r, 60).split()
    rows = [(None, "a lone text"), (None, "a lone text"), (1, None), (2, ""), (3, " \n"), (4, long), (5, long), (6, long + " more"), (7, " ".join(near)), (8, " ".join([*near[:50], "x", *near[51:]])), (9, prose(r, 30)), (9, prose(r, 30)), (10, "twice"), (10, "twice"), (11, "twice")]
    return rows + [(20 + i, prose(r, 15 + i % 7)) for i in range(30)]


def test_stages_on_odd_rows_equal_plain_versions(spark, tmp_path):
    from collections import Counter

    import numpy as np
    from tokenizers import Tokenizer

    from siltworks.llm import common, near_dedup, quality, toxicity
    from siltworks.llm.queries import tokenizer_path

    r = random.Random(12)
    known, labels = labelled(r, 150)
    spark.createDataFrame([(i + 1000, q, t) for i, q, t in labels] + [(None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = odd_documents(r) + [(i + 1000, t) for i, t in known]
    docs = spark.createDataFrame([(i, t, "en", None, 0, 1.0, "x", 1, 2, 3) for i, t in rows], ODD).repartition(3)
    marks = common.table(spark, str(tmp_path), "labels")
    ids = lambda df: Counter((x["doc_id"], x["text"]) for x in df.select("doc_id", "text").collect())
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        kept[name] = ids(out)
    stages = dict(corpus_pipeline.STAGES)
    keys, weights, intercept = toxicity.fit(docs, marks)
    weight = dict(zip(keys.tolist(), weights.tolist(), strict=True))
    odds = lambda t: intercept + sum(weight.get(f, 0.0) for f in set(toxicity.features(t).tolist()))
    assert kept["toxicity"] == Counter(x for x in rows if odds(x[1]) < 0)
    network, p = quality.fit(docs, marks), quality.Params()
    good = quality.probability([t for _, t in rows], network, p) >= 0.3
    assert kept["quality"] == Counter(x for x, ok in zip(rows, good.tolist(), strict=True) if ok)
    best = {}
    for i, t in rows:
        best[t or ""] = max(best.get(t or "", (False, 0)), (i is not None, i or 0))
    assert {(i, t or "") for i, t in kept["exact_dedup"]} == {(v[1] if v[0] else None, t) for t, v in best.items()} and max(kept["exact_dedup"].values()) == 1
    # near copies: links between distinct texts with words, by comparing all of them
    texts = sorted({t or "" for i, t in rows if i is not None})
    words = [near_dedup.word_ids(t).astype("<u4") for t in texts]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if near_dedup.similar(words[a], words[b], near_dedup.Params()):
                root = [min(root[a], root[b]) if x in (root[a], root[b]) else x for x in root]
    least = {}
    for i, t in rows:
        if i is not None:
            k = root[texts.index(t or "")]
            least[k] = min(least.get(k, (i, t or "")), (i, t or ""))
    got = kept["near_dedup"]
    assert {x[0] for x in got if x[0] is not None} == {v[0] for v in least.values()} and sum(n for x, n in got.items() if x[0] is None) == 2
    # packing: every piece has the ids of its place, sequences have no gaps and no more than 2048 tokens
    import zlib

    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    tokens = {(i, t): [*tok.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows}
    spots, pieces = {}, Counter()
    for x in stages["packing"](spark, docs, str(tmp_path)).collect():
        spots.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
        pieces[x["doc_id"], x["start"], x["length"], x["ids_crc32"]] += 1
    assert pieces == Counter((i, s, len(v[s : s + 2048]), zlib.crc32(np.array(v[s : s + 2048], "<u4").tobytes())) for i, t in rows for v in [tokens[i, t]] for s in range(0, len(v), 2048))
    for at in spots.values():
        at.sort()
        assert [o for o, _ in at] == [sum(n for _, n in at[:k]) for k in range(len(at))] and sum(n for _, n in at) <= 2048


def test_stages_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([], ODD)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)


def test_run_hands_over_parquet(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, "a", "en", "s", 1), (2, "b", "en", "s", 1)], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    read = []

    def stage(spark, docs, sf_dir):
        read.append(docs.inputFiles())
        return docs.where("doc_id > 0")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", stage), ("two", stage), ("three", stage)])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 2
    assert "/one/" in read[1][0] and "/two/" in read[2][0]


def test_each_operator_has_one_query():
    names = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert names == list(range(1, 14)) and set(queries.ORACLES) <= set(queries.QUERIES)


def test_exact_query_equals_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    got = queries.QUERIES["op6_exact_dedup"](spark, "/root/testdata/sf0.001")
    result = con.execute(queries.ORACLES["op6_exact_dedup"])
    names = [d[0] for d in result.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(result.fetchall())
