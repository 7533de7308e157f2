"""The loader over the Parquet lake: end to end, pipeline order, schemas, failures."""

import json
from datetime import UTC, datetime
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from siltworks.functions import json_schema as js
from siltworks.functions import schema_keys as keys
from siltworks.functions.atomic import ATOMIC, bad, good, parse_lines
from siltworks.operators import bad_rows, entities, lake, layout, shred
from siltworks.sources import streams
from siltworks.streaming import loader

TIME = "2024-01-02 03:04:05.678901"


def schema(properties=None, required=(), additional=None):
    out = {"type": "object", "properties": properties or {}, "required": list(required)}
    return json.dumps(out if additional is None else out | {"additionalProperties": additional})


REGISTRY = [
    ("org.buoy", "reading", "jsonschema", "3-1-0", schema({"depth": {"type": "string"}}, ["depth"])),
    ("org.buoy", "reading", "jsonschema", "3-1-1", schema({"depth": {"type": "string"}, "note": {"type": "string"}}, ["depth", "note"])),
    ("org.buoy", "gauge", "jsonschema", "1-0-0", schema({"depth": {"type": "string"}}, ["depth"])),
    ("org.buoy", "gauge", "jsonschema", "1-0-1", schema({"depth": {"type": "integer"}}, ["depth"])),
    ("org.buoy", "remarks", "jsonschema", "1-0-0", schema(additional=True)),
    ("org.buoy", "nothing", "jsonschema", "1-0-0", schema(additional=False)),
]


def sdj(name, version, data):
    return json.dumps({"schema": f"iglu:org.buoy/{name}/jsonschema/{version}", "data": data}, separators=(",", ":"))


def line(i, unstruct="", contexts="", total=""):
    return "\t".join([str(i), TIME, "sample", "1", total, unstruct, contexts])


def batch(first, unstruct="", contexts=""):
    """A good batch: one event with entities and a total, one bare."""
    return [line(first, unstruct, contexts, "1.23"), line(first + 1)]


@pytest.fixture
def setup(spark, tmp_path):
    fields = [f for f in ATOMIC if f.name not in ("unstruct_event", "contexts")] + [T.StructField("load_tstamp", T.TimestampType()), T.StructField("load_tstamp_date", T.DateType())]
    table = lake.LakeTable(f"{tmp_path}/lake", schema=T.StructType(fields))
    registry = spark.createDataFrame(REGISTRY, "vendor string, name string, format string, version string, schema_json string")
    load = loader.Load(table, registry, f"{tmp_path}/bad", f"{tmp_path}/metrics", write_partitions=2)
    lake.create(spark, table)

    def run(*windows):
        for i, lines in enumerate(windows):
            loader.load_batch(spark.createDataFrame([(x,) for x in lines], "value string"), i, load)
        return lake.read(spark, table)

    return load, run


def column(df, start):
    return next(c for c in df.columns if c.startswith(start))


def test_one_window_two_batches(spark, setup):
    load, run = setup
    back = run(batch(1) + batch(3)).orderBy("event_id").collect()
    assert [r["event_id"] for r in back] == [1, 2, 3, 4]
    assert len({r["load_tstamp"] for r in back}) == 1
    assert back[0]["tr_total"] == Decimal("1.23") and back[1]["tr_total"] is None


def test_versions_share_a_column(spark, setup):
    _, run = setup
    back = run(batch(1, sdj("reading", "3-1-0", {"depth": "low"})) + batch(3), batch(5, sdj("reading", "3-1-1", {"depth": "low", "note": "tide"})) + batch(7))
    rows = {r["event_id"]: r["unstruct_event_org_buoy_reading_3"] for r in back.collect()}
    assert len(rows) == 8
    assert (rows[1]["depth"], rows[1]["note"]) == ("low", None)
    assert (rows[5]["depth"], rows[5]["note"]) == ("low", "tide")


def test_breaking_version_is_recovered(spark, setup):
    _, run = setup
    back = run(batch(1, sdj("gauge", "1-0-0", {"depth": "low"})) + batch(3), batch(5, sdj("gauge", "1-0-1", {"depth": 123})) + batch(7))
    name = column(back, "unstruct_event_org_buoy_gauge_1_recovered_1_0_1_")
    assert len(name.rsplit("_", 1)[1]) == 8
    rows = {r["event_id"]: r for r in back.collect()}
    assert len(rows) == 8
    assert rows[1]["unstruct_event_org_buoy_gauge_1"]["depth"] == "low" and rows[1][name] is None
    assert rows[5]["unstruct_event_org_buoy_gauge_1"] is None and rows[5][name]["depth"] == 123


@pytest.mark.parametrize("where", ["unstruct", "contexts"])
def test_empty_schema_has_no_column(spark, setup, where):
    _, run = setup
    entity = sdj("nothing", "1-0-0", {})
    back = run(batch(1, entity) + batch(3) if where == "unstruct" else batch(1, "", f"[{entity}]") + batch(3))
    assert back.count() == 4 and not any("nothing" in c for c in back.columns)


def test_free_form_unstruct_and_context(spark, setup):
    _, run = setup
    entity = sdj("remarks", "1-0-0", {"a": "low", "b": "tide"})
    row = run(batch(1, entity, f"[{entity}]") + batch(3)).where("event_id = 1").first()
    assert row["unstruct_event_org_buoy_remarks_1"] == '{"a":"low","b":"tide"}'
    assert row["contexts_org_buoy_remarks_1"] == ['{"a":"low","b":"tide","_schema_version":"1-0-0"}']


def test_only_bad_lines_commit_nothing(spark, setup):
    load, run = setup
    back = run(["gibberish1", "gibberish2"] * 3)
    assert back.count() == 0
    assert loader.read_bad(spark, load).count() == 6
    m = loader.read_metrics(spark, load).first()
    assert (m["received"], m["bad"], m["committed"]) == (6, 6, 0)


def test_bad_and_good_mixed(spark, setup):
    load, run = setup
    back = run(batch(1) + ["gibberish1"], batch(3) + ["gibberish2", ""])
    assert back.count() == 4
    assert loader.read_bad(spark, load).where("kind = 'parsing'").count() == 3


def test_unknown_schema_tolerant_and_strict(spark, setup):
    load, run = setup
    lines = [line(1, sdj("nowhere", "3-1-0", {})), line(2)]
    assert run(lines).count() == 1
    assert loader.read_bad(spark, load).select("kind").collect() == [("schema_missing",)]
    load.exit_on_missing = True
    with pytest.raises(entities.MissingSchema):
        loader.load_batch(spark.createDataFrame([(x,) for x in lines], "value string"), 9, load)
    assert lake.read(spark, load.table).count() == 1


def test_wrong_type_fails_the_event(spark, setup):
    load, run = setup
    assert run([line(1, sdj("reading", "3-1-0", {"depth": 5})), line(2, sdj("reading", "3-1-0", {})), line(3)]).count() == 1
    assert loader.read_bad(spark, load).where("kind = 'transform'").count() == 2


def test_skipped_schema_is_left_out_and_events_load(spark, setup):
    load, run = setup
    load.skip = ["iglu:org.buoy/reading/jsonschema/3-*-*", "iglu:*/nowhere/jsonschema/*-*-*"]
    back = run([line(1, sdj("reading", "3-1-0", {"depth": 5})), line(2, sdj("nowhere", "3-1-0", {}))])
    assert back.count() == 2 and not any("reading" in c for c in back.columns)


def test_nullability_switch(spark, setup):
    load, run = setup
    load.respect_nullability = False
    assert run([line(1, sdj("reading", "3-1-0", {}))]).count() == 1


def test_replay_after_a_failure_repeats_nothing(spark, setup, monkeypatch):
    load, _ = setup
    frame = spark.createDataFrame([(x,) for x in batch(1) + ["gibberish"]], "value string")

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(lake, "append", fail)
        with pytest.raises(RuntimeError):
            loader.load_batch(frame, 0, load)
    loader.load_batch(frame, 0, load)
    loader.load_batch(frame, 0, load)
    assert lake.read(spark, load.table).count() == 2
    assert loader.read_bad(spark, load).count() == 1


def test_stream_windows_and_resume(spark, setup, tmp_path):
    load, _ = setup
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"{i}.txt").write_text("\n".join(batch(1 + 2 * i)) + "\n")
    for _ in range(2):
        loader.start(streams.files(spark, f"{tmp_path}/in", max_files=1), load, f"{tmp_path}/ck", None).awaitTermination()
    assert lake.read(spark, load.table).count() == 6
    assert loader.read_metrics(spark, load).count() == 3
    (tmp_path / "in" / "9.txt").write_text(line(99) + "\n")
    loader.start(streams.files(spark, f"{tmp_path}/in"), load, f"{tmp_path}/ck", None).awaitTermination()
    assert lake.read(spark, load.table).count() == 7


def test_missing_columns_in_an_existing_table(spark, tmp_path):
    small, large = T.StructType([T.StructField("event_id", T.LongType())]), ATOMIC
    lake.create(spark, lake.LakeTable(f"{tmp_path}/t", schema=small))
    with pytest.raises(ValueError):
        lake.create(spark, lake.LakeTable(f"{tmp_path}/t", schema=large))


def test_parse_bytes_nulls_and_types(spark):
    rows = [(bytearray(line(1, total="2.345").encode()),), (bytearray(b"\xff\xfe"),), (None,), (bytearray(line("x").encode()),), (bytearray(line(2).replace(TIME, "yesterday").encode()),)]
    p = parse_lines(spark.createDataFrame(rows, "value binary"), value_col="value")
    assert [r["tr_total"] for r in good(p).collect()] == [Decimal("2.35")]
    assert bad(p).count() == 4


def test_extra_columns_and_empty_table(spark):
    p = parse_lines(spark.createDataFrame([], "line string, payload string, errors string"))
    assert p.count() == 0 and "errors" in p.columns


def test_large_records_are_capped(spark):
    failed = parse_lines(spark.createDataFrame([("x" * 5000,), ("y",)], "line string"))
    rows = {r["kind"]: r["record"] for r in bad_rows.records(bad(failed), 1000).collect()}
    assert set(rows) == {"size", "parsing"} and len(rows["size"]) < 1000


def test_json_schema_types():
    t = js.read(json.loads(schema({"d": {"type": "string", "format": "date"}, "n": {"type": ["number", "null"]}, "xs": {"type": "array", "items": {"type": "integer"}}, "o": {"type": "object"}, "fooBar": {"type": "boolean"}, "m": {"type": "number", "multipleOf": 0.01, "maximum": 999}}, ["d", "n"])))
    by = {f.name: f for f in t.fields}
    assert (by["d"].type.kind, by["d"].nullable) == ("date", False)
    assert by["n"].nullable and by["o"].type.kind == "json"
    assert js.ddl(by["xs"].type) == "ARRAY<BIGINT>" and js.ddl(by["m"].type) == "DECIMAL(5,2)"
    assert "`foo_bar`" in js.ddl(t, True)
    assert js.merge(t, js.Type("string")) is None


def test_strict_types(spark):
    t = js.Type("struct", (js.Field("a", js.Type("integer"), False), js.Field("b", js.Type("array", element=js.Type("number"), element_nullable=False))))
    data = ['{"a":1}', '{"a":1.5}', '{"a":"1"}', "{}", '{"a":1,"b":[1,2.5]}', '{"a":1,"b":[1,null]}', '{"a":1,"b":["x"]}', '{"a":null}', "[]", "gibberish"]
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(x,) for x in data], "d string").select(F.coalesce(js.fits(F.try_parse_json("d"), t), F.lit(False)).alias("ok"))
    assert [r["ok"] for r in df.collect()] == [True, False, False, False, True, False, False, False, False, False]


def test_criteria():
    assert keys.form(keys.criterion("iglu:com.acme/a-b/jsonschema/1-*-02")) == "com.acme/a-b/jsonschema/1/*/2"
    for wrong in ("com.acme/x", "iglu:com.acme/x/jsonschema/1-0", "iglu:com.acme/x/jsonschema/1-0-x"):
        with pytest.raises(ValueError):
            keys.criterion(wrong)


def test_union_of_nested_structs(spark):
    a = spark.createDataFrame([(1, (1,))], "id long, e struct<k:long>")
    b = spark.createDataFrame([(2, (2, "w"))], "id long, e struct<k:long,src:string>")
    assert layout.union_evolving([a, b]).orderBy("id").collect()[0]["e"]["src"] is None


def test_misfit_message(spark):
    rows = good(parse_lines(spark.createDataFrame([(line(1, sdj("reading", "3-1-0", {"depth": 1})),)], "line string")))
    columns = js.plan("unstruct_event", "org.buoy", "reading", 3, [("3-1-0", REGISTRY[0][4])])
    row = shred.judged(rows, columns).first()
    assert row["kind"] == "transform" and "reading_3" in row["failure"]


def test_stamp_is_one_literal(spark):
    at = datetime(2024, 1, 1, tzinfo=UTC)
    assert layout.stamped(spark.range(3), at).select("load_tstamp").distinct().count() == 1


def test_bounded_integers():
    read = lambda **x: js.read({"type": "integer", **x}).kind
    assert [read(minimum=0, maximum=9), read(minimum=0), read(), read(minimum=0, maximum=2**31), read(minimum=-(2**31), maximum=2**31 - 1)] == ["int", "integer", "integer", "integer", "int"]
    assert js.merge(js.Type("int"), js.Type("integer")).kind == "integer" and js.ddl(js.Type("int")) == "INT"


def test_int_values(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("5",), (str(2**31),), ("1.5",), ('"5"',)], "d string")
    assert [r[0] for r in df.select(F.coalesce(js.fits(F.try_parse_json("d"), js.Type("int")), F.lit(False))).collect()] == [True, False, False, False]


def test_faulty_schema_keys_are_not_collected(spark, setup):
    load, run = setup
    lines = [line(i, sdj(f"id-{i}", "1-0-0", {})) for i in range(200)] + [line(999)]
    columns, lookup = entities.column_plan(entities.signatures(good(parse_lines(spark.createDataFrame([(x,) for x in lines], "line string")))), load.registry)
    assert (columns, lookup.lacking.count(), len(lookup.absent)) == ([], 200, 20)
    assert run(lines).count() == 1 and loader.read_bad(spark, load).where("kind = 'schema_missing'").count() == 200


def test_latencies_are_the_greatest(spark, setup):
    load, _ = setup
    load.source_ts_col, load.clock = "at", lambda: datetime(2024, 1, 3, tzinfo=UTC)
    rows = [(line(1), datetime(2024, 1, 2, 23, 0, 0, tzinfo=UTC)), (line(2), datetime(2024, 1, 2, 22, 0, 0, tzinfo=UTC))]
    loader.load_batch(spark.createDataFrame(rows, "value string, at timestamp"), 0, load)
    m = loader.read_metrics(spark, load).first()
    assert (m["stream_latency_ms"], m["processing_latency_ms"]) == (2 * 3_600_000, 0)


def test_compaction_merges_batches_in_one_step(spark, setup, tmp_path):
    load, run = setup
    load.compact_every = 2
    back = run(*[batch(1 + 2 * k) for k in range(3)])
    loader.finished(load)
    assert lake.read(spark, load.table).count() == 6
    # the loader has merged the first two batches after the second
    assert sorted(f.batches for f in lake.files(spark, load.table)) == [(0, 1), (2,)]
    rows = layout.stamped(lake.read(spark, load.table).drop("load_tstamp", "load_tstamp_date").repartition(3), datetime(2024, 1, 1, tzinfo=UTC))
    lake.append(rows, load.table, 7)
    assert lake.compact(spark, load.table, datetime(2023, 1, 1, tzinfo=UTC).date()) == 4
    assert sorted(f.batches for f in lake.files(spark, load.table)) == [(0, 1, 2), (7,)]
    assert len(lake.parts(spark, load.table)) == 7 and lake.read(spark, load.table).count() == 12
    with pytest.raises(ValueError):
        lake.append(back, load.table, 1)  # merged with others
    lake.maintain(spark, load.table, 0)
    assert len(lake.parts(spark, load.table)) == 2 and lake.read(spark, load.table).count() == 12


def test_columns_widen_and_clash(spark):
    a, b = (T._parse_datatype_string(x) for x in ("a int, s struct<x:int>, l array<struct<p:string>>", "a long, s struct<x:int,y:string>, l array<struct<q:int>>, d decimal(5,2)"))
    assert lake.wider(a, b).simpleString() == "struct<a:bigint,s:struct<x:int,y:string>,l:array<struct<p:string,q:int>>,d:decimal(5,2)>"
    with pytest.raises(ValueError):
        lake.wider(T.StringType(), T.LongType())


class Recorder:
    """Stands in for a session whose jars are absent: keeps statements and writes."""

    def __init__(self):
        self.said, self.conf, self.sparkSession = [], self, self

    def set(self, *_):
        pass

    def sql(self, text):
        self.said.append(text)
        return self

    def count(self):
        return 0

    def createDataFrame(self, *_):
        return self

    def __getattr__(self, name):
        def call(*a, **k):
            self.said.append((name, a, k))
            return self

        return self if name == "write" else call


COLUMNS = T.StructType([T.StructField("event_id", T.LongType(), False), T.StructField("load_tstamp", T.TimestampType()), T.StructField("load_tstamp_date", T.DateType())])


def test_iceberg_statements():
    s = Recorder()
    t = lake.LakeTable("cat.db.events", "iceberg", COLUMNS, properties={"format-version": "2"})
    lake.create(s, t)
    assert s.said[0].startswith("CREATE TABLE IF NOT EXISTS cat.db.events (`event_id` bigint NOT NULL, ") and "PARTITIONED BY (days(load_tstamp), event_name)" in s.said[0] and "'format-version'='2'" in s.said[0]
    assert s.said[1:] == [("writeTo", ("cat.db.events",), {}), ("append", (), {})]
    s.said.clear()
    lake.append(s, t, 5)
    assert "cat.db.events.snapshots" in s.said[0] and s.said[-1][0] == "append"
    assert ("options", (), {"merge-schema": "true", "check-ordering": "false", "distribution-mode": "none", "snapshot-property.siltworks-batch": "5"}) in s.said


def test_hudi_statements():
    s = Recorder()
    lake.create(s, lake.LakeTable("/x", "hudi", COLUMNS, {"database": "d", "name": "e"}))
    assert s.said[0] == "CREATE DATABASE IF NOT EXISTS d" and s.said[1].startswith("CREATE TABLE IF NOT EXISTS d.e (") and s.said[2] == "CALL run_clean(table => 'd.e')"
    lake.append(s, lake.LakeTable("/x", "hudi", COLUMNS), 1)
    assert [x[0] for x in s.said[-4:]] == ["format", "mode", "options", "save"]


def test_delta_statements(monkeypatch):
    import sys
    import types

    s = Recorder()
    monkeypatch.setitem(sys.modules, "delta", types.ModuleType("delta"))
    monkeypatch.setitem(sys.modules, "delta.tables", types.SimpleNamespace(DeltaTable=s))
    lake.create(s, lake.LakeTable("/x", "delta", COLUMNS))
    calls = {x[0]: x for x in s.said}
    assert calls["addColumns"][1][0].fieldNames() == ["event_id", "load_tstamp"] and calls["addColumn"][1][0] == "load_tstamp_date"
    lake.append(s, lake.LakeTable("/x", "delta", COLUMNS), 3)
    assert ("options", (), {"txnAppId": "siltworks", "txnVersion": "3", "mergeSchema": "true"}) in s.said


def test_conflicts_are_tried_again(spark, tmp_path):
    class Clash(Recorder):
        tries = 0

        def save(self, *_):
            Clash.tries += 1
            if Clash.tries < 3:
                raise RuntimeError("ConcurrentAppendException: files were added")

    lake.append(Clash(), lake.LakeTable("/x", "delta", COLUMNS), 3)
    assert Clash.tries == 3
