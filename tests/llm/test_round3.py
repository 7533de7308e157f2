"""Repair of conversations, source mixing and periodic runs against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

pytest.importorskip("public_tokenizers")

from siltworks.llm import common, conversation_repair, mixing, periodic_runs, queries  # noqa: E402

DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
CONV = "conv_id long, turn long, role string, text string, code string, block int, at int"


# --- conversations


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def repaired(rows):
    """(faults, cost, audit, text) by dynamic programming over (cost, letters) of all edits."""
    faults, seen = [], set()
    for role, text in rows:
        solid = text.strip(" \t\n\x0b\x0c\r")
        faults.append(2 if not solid else 3 if (role, text) in seen else 0 if solid[-1] in ".!?" else 1)
        seen.add((role, text))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {("", 0): (0, "", [])}
    heap = [(0, "", "", 0, [])]
    done = {}
    while heap:
        heap.sort(key=lambda x: x[:2])
        cost, audit, state, k, out = heap.pop(0)
        if (state, k) in done:
            continue
        done[state, k] = cost, audit, out
        if k == len(rows) and state in ("", "a"):
            break
        for name in ("user", "assistant"):
            if (state, name[0]) in step:
                heap.append((cost + 2, audit + "I", name[0], k, [*out, (name, "")]))
        if k < len(rows):
            role, text = rows[k]
            heap.append((cost + 3, audit + "D", state, k + 1, out))
            if faults[k] < 2:
                for letter, name, c in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                    if (state, name[:1]) in step:
                        heap.append((cost + c + faults[k], audit + letter, name[:1], k + 1, [*out, (name, text)]))
    del best
    return faults, cost, audit, out


def expected(rows):
    out = {}
    bad = damage(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted([r for r in bad if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        faults, cost, audit, left = repaired([r[2:] for r in mine])
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:], strict=False))
        text = "\n".join(f"{r}:{t}" for r, t in left)
        out[conv] = (gaps, faults.count(2), faults.count(3), faults.count(1), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def conversations(seed, n, longest=9):
    r = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(r.randint(1, longest)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = r.choice(["a.", "b!", "c", " \n", None, "", "d.\n ", "e?x", " ", "f." * 50])
            rows.append((conv if conv else None, turn if r.random() > 0.1 else r.choice([None, turn + 2]), role, text))
    return rows


def found(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def with_others(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], CONV)


def test_repair_equals_brute_force(spark):
    rows = conversations(1, 120)
    assert found(conversation_repair.report(with_others(spark, rows).repartition(3))) == expected(rows)


def test_long_conversations_are_cut_into_blocks(spark, monkeypatch):
    rows = conversations(2, 12, 40)
    whole = expected(rows)
    monkeypatch.setattr(conversation_repair.repair, "__defaults__", (2,))
    assert found(conversation_repair.report(with_others(spark, rows))) == whole


def test_repaired_rows_and_empty_table(spark):
    rows = conversations(3, 20)
    done = conversation_repair.repair(conversation_repair.damaged(with_others(spark, rows)), 3)
    text = {}
    for r in conversation_repair.rows(done).orderBy("conv", "at", "sub").collect():
        text.setdefault(r["conv"] and int(r["conv"]), []).append(f"{r['role']}:{r['text']}")
    for conv, e in expected(rows).items():
        assert hashlib.sha256("\n".join(text.get(conv, [])).encode()).hexdigest() == e[-1]
    assert conversation_repair.report(with_others(spark, [])).count() == 0


def test_prices_are_what_is_left_to_pay():
    r = random.Random(4)
    for _ in range(200):
        rows = "".join(r.choice("ABCDEFGHIJKLMNOP") for _ in range(r.randint(0, 7)))
        price = conversation_repair.prices(rows, conversation_repair.END)
        for k, here in enumerate(price[:-1]):
            for s in range(4):
                ways = [c + (price[k + 1][to] if read else here[to]) for _, c, read, to in conversation_repair._arcs(rows[k], s)]
                assert here[s] == min(ways)
        m = conversation_repair.matrix(rows)
        assert [min(m[4 * a + b] + conversation_repair.END[b] for b in range(4)) for a in range(4)] == list(price[0])


def test_a_whole_long_conversation_in_linear_time():
    rows = "".join(random.Random(5).choice("ABCDEFGHIJKLMNOP") for _ in range(20_000))
    letters, cost = conversation_repair.solve(rows)
    assert len(re.sub("I", "", letters)) == len(rows) and cost > 0


# --- mixing


def plain_fill(sizes, weights, total, most):
    out, left = [0.0] * len(sizes), set(range(len(sizes)))
    while left:
        rest = total - sum(out)
        share = {i: rest * weights[i] / sum(weights[j] for j in left) for i in left}
        full = [i for i in left if share[i] > most * sizes[i]]
        if not full:
            for i in left:
                out[i] = share[i]
            break
        for i in full:
            out[i] = float(most * sizes[i])
            left.remove(i)
    return out


def test_shares_are_those_of_sharing_again():
    r = random.Random(1)
    for _ in range(200):
        sizes = [r.choice([0, r.randint(1, 50), r.randint(1, 10_000)]) for _ in range(r.randint(1, 9))]
        weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
        assert mixing.fill(sizes, weights, 1.5 * sum(sizes), 2) == pytest.approx(plain_fill(sizes, weights, 1.5 * sum(sizes), 2))


def test_flow_is_the_cheapest_of_the_largest():
    """All integer flows of small networks, by hand."""
    r = random.Random(2)
    for _ in range(60):
        m = r.randint(1, 3)
        patterns = [(sorted(r.sample(range(m), r.randint(1, m))), r.randint(0, 3)) for _ in range(r.randint(1, 2))]
        quotas = [r.randint(0, 4) for _ in range(m)]
        best = None
        arcs = [(p, x) for p, (members, _) in enumerate(patterns) for x in members]
        for flow in itertools.product(range(5), repeat=len(arcs)):
            used = [sum(f for f, (a, _) in zip(flow, arcs, strict=True) if a == p) for p in range(len(patterns))]
            given = [sum(f for f, (_, b) in zip(flow, arcs, strict=True) if b == x) for x in range(m)]
            if all(u <= 2 * s for u, (_, s) in zip(used, patterns, strict=True)) and all(g <= q for g, q in zip(given, quotas, strict=True)):
                cost = sum(max(0, u - s) for u, (_, s) in zip(used, patterns, strict=True))
                best = max(best, (sum(given), -cost)) if best else (sum(given), -cost)
        got = mixing.route(patterns, quotas, 2)
        used = [sum(g.values()) for g in got]
        assert (sum(used), -sum(max(0, u - s) for u, (_, s) in zip(used, patterns, strict=True))) == best
        for x in range(m):
            assert sum(g.get(x, 0) for g in got) <= quotas[x]


def test_mix_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DIR}/documents.parquet'")
    want = sorted(con.execute("SELECT doc_id, size, source_size, target, taken FROM (" + mixing.SQL + ")").fetchall())
    got = sorted(tuple(r) for r in queries.QUERIES["op12_source_mix"](spark, DIR).collect())
    assert got == want
    assert got == sorted(tuple(r) for r in queries.QUERIES["op12_source_mix"](spark, DIR).collect())


def test_mix_of_odd_rows(spark):
    rows = [(1, "a b c"), (1, "a b c"), (None, "x " * 500), (3, None), (4, ""), (5, " \x0b\n"), (6, "  \x1c")] + [(10 + i, "w " * (i % 7)) for i in range(300)]
    docs = spark.createDataFrame([(i, t, "s" if k % 3 else None, 1, 2, 3) for k, (i, t) in enumerate(rows)], "doc_id long, text string, source string, size int, at int, block int").repartition(3)
    got = mixing.mix(docs).rows.collect()
    assert sorted(r["size"] for r in got) == sorted(len(WORD.findall(t or "")) for _, t in rows)
    assert all(r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2 for r in got)
    for s in {tuple(r["sources"]) for r in got}:
        mine = [r for r in got if tuple(r["sources"]) == s]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 6
    assert mixing.mix(docs.where("false")).rows.count() == 0


def test_mix_of_sources_that_share_documents(spark):
    from pyspark.sql import functions as F

    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', 1 + cast(id % 5 as int))").alias("text"), F.expr("case when id % 9 < 4 then array('a') when id % 9 < 8 then array('b', 'a', 'b') else array('c') end").alias("of"))
    done = mixing.mix(docs, (1, 1, 1), 1.2, 2, sources=F.col("of"))
    words = {(p, x): w for p, x, w in done.shares}
    size = {tuple(r["sources"]): r["n"] for r in done.rows.groupBy("sources").agg(F.sum("size").alias("n")).collect()}
    taken = {tuple(r["sources"]): r["n"] for r in done.rows.groupBy("sources").agg(F.sum("taken").alias("n")).collect()}
    assert set(size) == {("a",), ("a", "b"), ("c",)}
    for p, n in taken.items():
        assert abs(n - sum(w for (q, _), w in words.items() if q == p)) <= 5
    assert words[("c",), "c"] == 2 * size[("c",)]  # less than its share even twice


# --- runs


def plain_runs(words):
    out = {}
    n = len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            k = i
            while k + q < n and words[k] == words[k + q]:
                k += 1
            if k > i and k - i + q >= max(6, 4 * q) and (i, k + q) not in out:
                out[i, k + q] = q
            i = k + 1
    return sorted((s, q, e - s) for (s, e), q in out.items())


def plain_report(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found_ = plain_runs(words)
    keep = [True] * n
    for s, q, m in found_:
        keep[s + q : s + m] = [False] * (m - q)
    best = min(found_, key=lambda r: (-r[2], r[0], r[1]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    head = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    return (doc_id, len(found_), *head, sha("".join(f"{s},{m},{q}\n" for s, q, m in found_)), sha(" ".join(w for w, k in zip(words, keep, strict=True) if k)))


def odd_texts():
    r = random.Random(6)
    out = [None, "", " \n", "a", "a " * 5, "a " * 6, "a " * 300, "a b " * 3 + "a b", "x\x1cy x y " * 9, "a a a a a a b b b b b b a a a a a a"]
    for n in (10, 30, 100, 400):
        for letters in ("ab", "abc", "abcdefgh"):
            out += [" ".join(r.choice(letters) for _ in range(n)) for _ in range(8)]
    for _ in range(60):  # runs in runs
        words = [r.choice("abcd") for _ in range(r.randint(1, 20))]
        for _ in range(r.randint(1, 4)):
            words = words[: r.randint(1, len(words))] * r.randint(1, 6) + [r.choice("abcd") for _ in range(r.randint(0, 3))]
        out.append(" ".join(words[:1500]))
    return out


@pytest.mark.parametrize("long", [4096, 40])
def test_runs_equal_brute_force(spark, long):
    rows = [(i if i != 7 else None, t) for i, t in enumerate(odd_texts())]
    docs = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], "doc_id long, text string, row int, n string, start int").repartition(3)
    got = sorted((tuple(r) for r in periodic_runs.report(docs, plant=True, long=long).collect()), key=str)
    assert got == sorted((plain_report(i, t) for i, t in rows), key=str)


def test_runs_of_the_documents_equal_brute_force(spark):
    got = {r["doc_id"]: tuple(r) for r in queries.QUERIES["op13_periodic_runs"](spark, DIR).collect()}
    docs = common.table(spark, DIR, "documents").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for r in docs:
        assert got[r["doc_id"]] == plain_report(r["doc_id"], r["text"])


def test_runs_of_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a " * 9), (1, "a " * 9), (1, "b c")], "doc_id long, text string")
    assert sorted(r["n_runs"] for r in periodic_runs.report(docs).collect()) == [0, 1, 1]
    assert periodic_runs.report(docs.where("false")).count() == 0


def test_repair_of_the_conversations_equals_brute_force(spark):
    rows = [tuple(r) for r in common.table(spark, DIR, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.QUERIES["op11_conversation_repair"](spark, DIR)) == expected(rows)


# --- main text: class words lower an element's chances, the text decides

LONG_TEXT = "The first paragraph of a long article, which goes on and on, with many words, so that it has points. " * 3
PLAIN_TEXT = "This is a plain paragraph of the article, long enough to be one, with commas, and no links at all."


@pytest.mark.parametrize("name", "section-share social-studies tags-explained form-factor menu-items widget-design trending-topic signup-story related-work comment-on-law ads-history nav-chapter popular-science alert-level".split())
def test_class_words_alone_remove_no_prose(name):
    from siltworks.llm import html_text

    for outer in ("article", "div"):
        page = f"<body><{outer}><p>{LONG_TEXT}</p><div class='{name}'><p>{PLAIN_TEXT}</p></div><p>{LONG_TEXT}</p></{outer}></body>"
        assert PLAIN_TEXT in html_text.main_text(page)


@pytest.mark.parametrize("name", "cookie-notice comments comment-list newsletter ad share-buttons related-posts site-footer sidebar nav-menu".split())
def test_furniture_still_goes(name):
    from siltworks.llm import html_text

    page = f"<body><div class='post'><p>{LONG_TEXT}</p><p>{LONG_TEXT}</p><div class='{name}'><a href=x>One</a> <a href=y>Two</a></div></div><div class='{name}'><p>{PLAIN_TEXT}</p></div></body>"
    assert html_text.main_text(page) == " ".join((LONG_TEXT * 2).split())


def test_an_article_in_several_parts_and_references_in_one_text():
    from siltworks.llm import html_text

    long = " ".join((LONG_TEXT * 3).split())
    for body, end in (("<section><p>SHORT end</p></section><section><ul><li>one</li><li>two</li></ul></section>", "SHORT end one two"), ("<section><h2>Head</h2><p>Short text</p></section>", "Head Short text")):
        assert html_text.main_text(f"<body><section><p>{long}</p></section>{body}</body>") == f"{long} {end}"
        divs = body.replace("section", "div")
        assert html_text.main_text(f"<body><div><p>{long}</p></div>{divs}</body>") == f"{long} {end}"
    for x, y in (("AT&<b>lt</b> x", "AT&lt x"), ("a &am<!-- -->p; b", "a &amp; b"), ("one <label>two</label> three.", "one two three."), ("&lt;b&gt; &amp;amp;", "<b> &amp;")):
        assert html_text.main_text(f"<body><article><p>{long}</p><p>{x}</p></article></body>") == f"{long} {y}"


# --- URLs


def test_entropy_counts_every_character(spark):
    import math

    from siltworks.llm import url_filter
    from pyspark.sql import functions as F

    texts = ["", "a", "aaaa", "http://x.org/0123?a=b&c=é🙂🙂", "1234567890", "\\d.*+[x]$"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", url_filter._entropy(F.col("t")).alias("e"))
    for r in df.collect():
        n = len(r["t"])
        assert r["e"] == pytest.approx(sum(-r["t"].count(c) / n * math.log2(r["t"].count(c) / n) for c in set(r["t"])))


def test_one_url_many_times_takes_one_place(spark, monkeypatch):
    """A hot URL counts with all its rows and leaves the others in the sample; large statistics are joined by size."""
    from siltworks.llm import url_filter

    monkeypatch.setattr(url_filter, "BROADCAST_BYTES", 0)
    rows = [(i, f"https://a{i % 40}.com/p{i}") for i in range(400)] + [(400 + i, f"https://b{i % 40}.org/long/path/{i}?q={i}") for i in range(400)] + [(1000 + i, "https://hot.com/x") for i in range(5000)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = url_filter.judge(df, [("block", "com/"), ("allow", "org/long/path/1"), ("allow", "org/long/path/2")]).toPandas()
    assert len(got) == len(rows) and (got[got["host"] == "hot.com"]["verdict"] == "block").all()
    left = got[got["rule"].isna()]
    assert len(left) > 100 and (left["verdict"] == "allow").mean() > 0.9
