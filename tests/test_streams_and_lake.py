"""Sharded source, bounded requests, lookups, layout, file lists and watching, piece by piece."""

import json
import random
import re
from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions.atomic import good, parse_lines
from siltworks.operators import entities, lake, layout, metrics, shred
from siltworks.plans import lake_queries
from siltworks.sources import feed, requests, shards
from siltworks.streaming import loader

DIR = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1, tzinfo=UTC)


# --- the sharded source


def log(spark, at, n=500, number=0, hours=0):
    rows = spark.range(n).select((F.col("id") + number * n).alias("id"), (F.lit(START) + F.make_dt_interval(hours=F.lit(hours), secs=F.floor(F.col("id") / 3))).alias("t"))
    shards.append(rows, at, F.col("id"), F.col("t"), F.col("id").cast("string"), 3, number)
    return {r["id"]: r["t"] for r in rows.collect()}


def test_a_time_is_found_in_every_shard(spark, tmp_path):
    at = str(tmp_path / "log")
    log(spark, at)
    log(spark, at, number=1, hours=1)
    index = shards.Index(at)
    index.refresh()
    rows = spark.read.parquet(at)
    by = {}
    for r in rows.orderBy("arrived").collect():
        by.setdefault(f"{int(r['shard']):05d}", []).append(START + timedelta(microseconds=r["arrived"] - 1_704_067_200_000_000))
    assert {s: g[-1].first + g[-1].n for s, g in index.groups.items()} == {s: len(t) for s, t in by.items()}
    for seconds in (-1, 0, 1, 50, 120, 166, 167, 1000, 3600, 3650, 3766, 9999):
        when = START + timedelta(seconds=seconds)
        got = index.at_time(when)
        for s, times in by.items():
            assert got[s] == sum(t < when for t in times)


def test_spans_cover_offsets_once(spark, tmp_path):
    at = str(tmp_path / "log")
    log(spark, at)
    log(spark, at, number=1, hours=1)
    reader = shards.ShardReader({"path": at, "max_records": "137"})
    start, values = reader.initialOffset(), []
    head = reader.index.head()
    while start != head:
        end = reader.latestOffset()
        spans = reader.partitions(start, end)
        assert 0 < sum(s.take for s in spans) <= 137 + len(head)
        for s in spans:
            for b in reader.read(s):
                values += [(v.decode(), p) for v, p in zip(b["value"].to_pylist(), b["position"].to_pylist(), strict=True)]
        start = end
    assert sorted(int(v) for v, _ in values) == list(range(1000)) and reader.partitions(head, head) == []


def test_the_limit_holds_after_a_restart(spark, tmp_path):
    at, checkpoint, out = (str(tmp_path / x) for x in ("log", "checkpoint", "out"))
    log(spark, at)
    counts = []
    for k in range(4):
        stream = shards.stream(spark, at, "earliest", 200 if k < 3 else None, checkpoint)
        stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
        counts.append(spark.read.parquet(out).count())
    assert counts[-1] == 500 and all(b - a <= 203 for a, b in zip([0, *counts], counts[:3], strict=False))
    assert spark.read.parquet(out).select("shard", "position").distinct().count() == 500


def test_an_unfinished_append_is_not_read(spark, tmp_path):
    at = str(tmp_path / "log")
    log(spark, at)
    log(spark, at, number=1, hours=1)
    (tmp_path / "log/append=00000001/_SUCCESS").unlink()
    index = shards.Index(at)
    index.refresh()
    assert sum(index.head().values()) == 500


# --- requests


def test_requests_are_bounded_and_lose_nothing():
    r = random.Random(1)
    records = ["é" * r.choice([0, 1, 5, 40]) for _ in range(500)]
    got = list(requests.requests(iter(records), 7, 100))
    assert [x for q in got for x in q] == records
    assert all(len(q) <= 7 and sum(len(x.encode()) for x in q) <= 100 for q in got)
    for a, b in zip(got, got[1:], strict=False):  # none could have taken the next record
        assert len(a) == 7 or sum(len(x.encode()) for x in [*a, b[0]]) > 100
    with pytest.raises(ValueError):
        list(requests.requests(iter(["x" * 101]), 7, 100))


def test_a_batch_is_sent_once(spark, tmp_path):
    at = str(tmp_path / "sent")
    rows = spark.range(1000).select(F.col("id").cast("string").alias("record"))
    requests.send(rows.repartition(3), at, 5, max_records=50)
    requests.send(rows.repartition(2), at, 5, max_records=50)
    requests.send(rows.limit(1), at, 6, max_records=50)
    assert requests.sent(spark, at).where("batch_id = 5").agg(F.sum("records"), F.max("records")).first()[:] == (1000, 50)
    assert requests.sent_records(spark, at).where("batch_id = 5").select("record").distinct().count() == 1000
    assert len(list((tmp_path / "sent/requests").glob("*.json"))) == requests.sent(spark, at).count()


# --- schemas


def test_criteria_equal_patterns(spark):
    r = random.Random(2)
    part = lambda some: r.choice(["*", *some])
    criteria = [f"iglu:{part(['com.a', 'com.b'])}/{part(['x', 'y-z'])}/{part(['jsonschema'])}/{part('12')}-{part('01')}-{part('01')}" for _ in range(25)]
    schemas = [f"iglu:{v}/{n}/jsonschema/{m}-{a}-{b}" for v in ("com.a", "com.b", "comXa") for n in ("x", "y-z", "w") for m in (1, 2, 3) for a in (0, 1) for b in (0, 1, 11)] + ["nonsense", None]
    for some in ([criteria[0]], criteria[1:4], criteria[4:9], criteria):
        patterns = [re.compile("iglu:" + "/".join("[^/]+" if x == "*" else re.escape(x) for x in c[5:].rsplit("/", 1)[0].split("/")) + "/" + "-".join("[0-9]+" if x == "*" else x for x in c.rsplit("/", 1)[1].split("-"))) for c in some]
        df = spark.createDataFrame([(s, i) for i, s in enumerate(schemas)], "schema string, i int")
        got = sorted(x["i"] for x in entities.without_skipped(df, some).collect())
        assert got == [i for i, s in enumerate(schemas) if s is None or not any(p.fullmatch(s) for p in patterns)]


def lines(spark, n=300):
    unstruct = lambda i: json.dumps({"schema": f"iglu:com.acme/{'action' if i % 3 else f'odd-{i}'}/jsonschema/1-0-0", "data": {"k": i}})
    return spark.createDataFrame([("\t".join([str(i), "2024-01-02 03:04:05", "e", "1", "", unstruct(i), ""]),) for i in range(n)], "line string")


@pytest.mark.parametrize("few", [10_000, 5])
def test_missing_schemas_however_many(spark, monkeypatch, few):
    monkeypatch.setattr(entities, "FEW", few)
    rows = good(parse_lines(lines(spark)))
    columns, lookup = entities.column_plan(entities.signatures(rows), feed.registry(spark))
    got = shred.judged(rows, columns, lookup).where("kind = 'schema_missing'").select("event_id").collect()
    assert sorted(r[0] for r in got) == list(range(0, 300, 3)) and len(columns) == 2


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_the_plan_does_not_grow_with_criteria_and_registry(spark):
    used = spark.createDataFrame([("iglu:a/b/jsonschema/1-0-0",)], "schema string")
    made = lambda n: len(plan_of(entities.without_skipped(used, [f"iglu:a/n{i}/jsonschema/1-0-*" for i in range(n)])))
    assert made(10_000) < 1.2 * made(10)
    rows = good(parse_lines(lines(spark)))
    columns, lookup = entities.column_plan(entities.signatures(rows), feed.registry(spark))
    assert "odd-3" not in plan_of(shred.judged(rows, columns, lookup))


def test_json_is_parsed_once(spark):
    rows = good(parse_lines(feed.feed(spark, DIR)))
    columns, lookup = entities.column_plan(entities.signatures(rows), feed.registry(spark))
    plan = plan_of(shred.shredded(shred.judged(rows, columns, lookup), columns))
    # one parse of unstruct data and one of each context; the envelopes of both are the only texts read with from_json
    assert plan.count("parseJson") == 2 and plan.count("from_json") == 2


# --- layout


def test_parts_are_balanced_without_a_sample(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 25 != 0, "click").otherwise(F.concat(F.lit("n"), (F.col("id") % 500).cast("string"))).alias("event_name"), F.col("id").alias("event_id"))
    counts = rows.groupBy("event_name").agg(F.count(F.lit(1)).alias("n"))
    for parts in (2, 7, 20):
        out = layout.laid_out(rows, parts, counts)
        assert "rangepartitioning" not in out._jdf.queryExecution().toString().lower()
        sizes = [r["n_rows"] for r in layout.part_sizes(out).collect()]
        assert len(sizes) == parts and sum(sizes) == 20_000 and max(sizes) <= 1.2 * 20_000 / parts
        assert out.columns == rows.columns


def test_layout_of_nulls_and_of_names_that_were_not_counted(spark):
    rows = spark.createDataFrame([(None, 1), ("a", 2), ("b", None), ("c", 4)], "event_name string, event_id long")
    for counts in (None, rows.where("event_name = 'a'").groupBy("event_name").agg(F.count(F.lit(1)).alias("n")), rows.where("false").select("event_name", F.lit(1).alias("n"))):
        assert sorted(layout.laid_out(rows, 3, counts).collect(), key=str) == sorted(rows.collect(), key=str)


# --- lists of files


@pytest.fixture
def table(spark, tmp_path):
    schema = T._parse_datatype_string("event_id long, collector_tstamp timestamp, event_name string, load_tstamp timestamp, load_tstamp_date date")
    t = lake.LakeTable(str(tmp_path / "lake"), schema=schema)
    lake.create(spark, t)
    return t


def put(spark, t, batch, day, n=20, hours=0):
    rows = spark.range(n).select(F.col("id").alias("event_id"), (F.lit(START) + F.make_dt_interval(days=F.lit(day), hours=F.lit(hours))).alias("collector_tstamp"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("event_name"))
    lake.append(layout.stamped(rows.coalesce(1), START + timedelta(days=day, hours=hours)), t, batch)


def test_dates_and_times_leave_files_out(spark, table):
    for day in range(5):
        put(spark, table, day, day)
    assert len(lake.files(spark, table)) == 10
    assert lake.read(spark, table, date(2024, 1, 2), date(2024, 1, 3)).count() == 40
    times = {"collector_tstamp": (START + timedelta(days=3), START + timedelta(days=9))}
    assert len(lake.files(spark, table, times=times)) == 4 and lake.read(spark, table, times=times).count() == 40
    assert lake.read(spark, table, times={"true_tstamp": times["collector_tstamp"]}).count() == 0  # no file has such times


def test_a_batch_that_is_loaded_on_another_day_moves(spark, table):
    put(spark, table, 3, 0)
    put(spark, table, 3, 1)
    assert {str(r["load_tstamp_date"]) for r in lake.read(spark, table).collect()} == {"2024-01-02"}


def test_two_writers_of_a_date_lose_nothing(spark, table, monkeypatch):
    put(spark, table, 0, 0)
    real, done = lake._files, []

    def slow(s, t, day):
        found = real(s, t, day)
        if not done:  # another writer commits between reading and writing
            done.append(1)
            put(spark, table, 1, 0)
        return found

    monkeypatch.setattr(lake, "_files", slow)
    put(spark, table, 2, 0)
    assert {f.batches for f in lake.files(spark, table)} == {(0,), (1,), (2,)} and lake.read(spark, table).count() == 60


def test_a_list_that_was_not_finished_does_not_count(spark, table, tmp_path):
    put(spark, table, 0, 0)
    (tmp_path / "lake/files/load_tstamp_date=2024-01-01/00000001.json").write_text('{"path": "x"')
    assert lake.read(spark, table).count() == 20
    put(spark, table, 1, 0)
    assert lake.read(spark, table).count() == 40


def test_merging_over_batches(spark, table):
    for k in range(12):
        put(spark, table, k, 0, hours=k)
    put(spark, table, 12, 1)
    size = sum(f.bytes for f in lake.files(spark, table) if f.partition.endswith("=a")) - lake.files(spark, table, date(2024, 1, 2))[0].bytes
    assert lake.compact(spark, table, date(2024, 1, 1), small=1 << 20, target=size // 3, below_batch=12) == 12
    files = lake.files(spark, table, until=date(2024, 1, 1))
    assert all(sum(f.partition == f"event_name={n}" for f in files) <= 4 for n in "ab") and sum(f.rows for f in files) == 240
    assert lake.read(spark, table).count() == 260 and len(lake.files(spark, table, date(2024, 1, 2))) == 2
    assert lake.compact(spark, table, date(2024, 1, 1), small=10, target=size) == 0


# --- metrics


def test_metrics_come_with_the_write(spark, tmp_path):
    load = loader.Load(lake_queries.table(spark, str(tmp_path / "lake")), feed.registry(spark), str(tmp_path / "bad"), str(tmp_path / "metrics"), value_col="line", write_partitions=2)
    lake.create(spark, load.table)
    raw = feed.feed(spark, DIR).withColumn("line", F.concat(F.col("line").cast("binary"), F.when(F.rand(1) < 0.1, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit(""))))).persist()
    loader.load_batch(raw, 1, load)
    spark.sparkContext.setJobGroup("one batch", "")
    loader.load_batch(raw, 0, load)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("one batch"))
    spark.sparkContext.setJobGroup("others", "")
    m = loader.read_metrics(spark, load).where("batch_id = 0").first()
    n = lake.read(spark, load.table).count() // 2
    assert m["bytes"] == raw.agg(F.sum(F.octet_length("line"))).first()[0]
    assert (m["received"], m["committed"], m["bad"]) == (raw.count(), n, loader.read_bad(spark, load).where("batch_id = 0").count()) and m["bad"] > raw.count() // 20
    assert jobs <= 26, jobs  # 27 when counts had jobs of their own, without the sizes and bounds of files


def test_watching_a_load(spark, tmp_path):
    watch = metrics.Watch()
    spark.streams.addListener(watch)
    try:
        spark.range(50).select(F.col("id").cast("string")).write.text(str(tmp_path / "in"))
        load = loader.Load(lake_queries.table(spark, str(tmp_path / "lake")), feed.registry(spark), str(tmp_path / "bad"), str(tmp_path / "metrics"), write_partitions=2)
        loader.start(spark.readStream.text(str(tmp_path / "in")), load, str(tmp_path / "checkpoint"), None, name="watched").awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(watch)
    assert [b[:3] for b in watch.batches["watched"]] == [(0, 50, 90)] and watch.stalled(0) == []


def test_a_period_is_reported_once(spark, tmp_path):
    at, total = str(tmp_path / "metrics"), 0
    for k, minutes in enumerate((0, 10, 59, 70, 65, 130, 200)):
        row = (k, START, START + timedelta(minutes=minutes), 10, 1, 9, 100, START, k, k, k)
        spark.createDataFrame([row, (k, START, None, 5, 5, 0, 1, None, None, None, None)], metrics.SCHEMA).write.parquet(f"{at}/batch_id={k}")
        metrics.running_report(spark, at, str(tmp_path / "report"), str(tmp_path / "checkpoint"), 3600, "10 minutes").awaitTermination()
        total = spark.read.parquet(str(tmp_path / "report")).count() if k else 0
    got = [(r["period_start"].hour, r["received"], r["e2e_latency_ms"]) for r in spark.read.parquet(str(tmp_path / "report")).orderBy("period_start").collect()]
    assert total == 3 and got == [(0, 30, 2), (1, 20, 4), (2, 10, 5)]


def test_event_names_of_any_kind(spark, table):
    names = ["a b", "x/y", "50%", "é#?", "k=v", "", None, "part=1", "*", "{a,b}", "[x]"]
    for k in range(2):
        rows = spark.createDataFrame([(i, START, n) for i, n in enumerate(names)], "event_id long, collector_tstamp timestamp, event_name string")
        lake.append(layout.stamped(rows.coalesce(1), START), table, k)
    for _ in range(2):
        back = lake.read(spark, table).groupBy("event_name").agg(F.count(F.lit(1)).alias("n")).collect()
        assert {r["event_name"]: r["n"] for r in back} == {n or None: 4 if not n else 2 for n in names}
        lake.compact(spark, table, date(2024, 1, 1))
    assert len(lake.files(spark, table)) == len({n or None for n in names})
