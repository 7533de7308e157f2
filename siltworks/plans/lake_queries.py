"""Queries of the event-lake operators, each with the SQL it is compared with.

All read ``events`` through the derived raw feed; the SQL computes the expected result from ``events``
itself. Each query's work grows with the table.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from datetime import UTC, date, datetime, timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.atomic import ATOMIC, bad, good, parse_lines
from ..operators import bad_rows, entities, lake, layout, metrics, shred
from ..sources import feed as raw
from ..sources import requests, shards, streams
from ..streaming import loader

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: The feed in SQL: every field and rule that FIXTURES.md states, on the base table.
FEED = """
WITH e AS (
  SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_id % 97 = 13 AS short, event_id % 89 = 7 AS badnum,
         CASE WHEN event_type = 'signup' THEN NULL WHEN event_id % 101 = 5 THEN 'unknown' WHEN event_id % 61 = 9 THEN 'oops'
              WHEN event_id % 3 = 0 THEN 'v0' WHEN event_id % 3 = 1 THEN 'v1' ELSE 'v2' END AS u, event_id % 11 <> 0 AS ctx
  FROM events),
feed AS (
  SELECT *, NOT short AND NOT badnum AS good,
         CASE u WHEN 'unknown' THEN 'com.unknown/thing 1-0-0' WHEN 'oops' THEN 'com.acme/action 1-0-0' WHEN 'v0' THEN 'com.acme/action 1-0-0'
                WHEN 'v1' THEN 'com.acme/action 1-0-1' WHEN 'v2' THEN 'com.acme/action 1-0-2' END AS ukey,
         NOT short AND NOT badnum AND coalesce(u NOT IN ('unknown', 'oops'), true) AS loaded,
         concat_ws(chr(9), CAST(event_id AS VARCHAR), strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), event_type) ||
         CASE WHEN short THEN '' ELSE chr(9) || coalesce(CAST(user_id AS VARCHAR), '') || chr(9) ||
           CASE WHEN badnum THEN 'abc' ELSE coalesce(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), '') END || chr(9) ||
           coalesce(CASE u WHEN 'unknown' THEN '{"schema":"iglu:com.unknown/thing/jsonschema/1-0-0","data":{"z":' || k || '}}'
             WHEN 'oops' THEN '{"schema":"iglu:com.acme/action/jsonschema/1-0-0","data":{"k":"oops"}}'
             WHEN 'v0' THEN '{"schema":"iglu:com.acme/action/jsonschema/1-0-0","data":{"k":' || k || '}}'
             WHEN 'v1' THEN '{"schema":"iglu:com.acme/action/jsonschema/1-0-1","data":{"k":' || k || ',"src":"web"}}'
             WHEN 'v2' THEN '{"schema":"iglu:com.acme/action/jsonschema/1-0-2","data":{"k":"' || k || '"}}' END, '') || chr(9) ||
           CASE WHEN NOT ctx THEN '' ELSE '[{"schema":"iglu:com.acme/user/jsonschema/2-0-0","data":{"user_id":' || user_id || '}}' ||
             CASE WHEN event_id % 2 = 0 THEN ',{"schema":"iglu:com.acme/free-form/jsonschema/1-0-0","data":{"b":"' || event_type || '","a":"xyz"}}' ELSE '' END ||
             CASE WHEN event_id % 5 = 0 THEN ',{"schema":"iglu:com.acme/empty/jsonschema/1-0-0","data":{}}' ELSE '' END || ']' END END AS line
  FROM e),
entity AS (
  SELECT event_id, 'unstruct_event' AS kind, ukey AS key FROM feed WHERE good AND u IS NOT NULL
  UNION ALL SELECT event_id, 'contexts', 'com.acme/user 2-0-0' FROM feed WHERE good AND ctx
  UNION ALL SELECT event_id, 'contexts', 'com.acme/free-form 1-0-0' FROM feed WHERE good AND ctx AND event_id % 2 = 0
  UNION ALL SELECT event_id, 'contexts', 'com.acme/empty 1-0-0' FROM feed WHERE good AND ctx AND event_id % 5 = 0),
parts AS (
  SELECT event_id, kind, split_part(key, '/', 1) AS vendor, split_part(split_part(key, '/', 2), ' ', 1) AS name, split_part(key, ' ', 2) AS version FROM entity)
"""


def query(name: str, sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = FEED + sql
        return f

    return register


def scratch(spark: SparkSession) -> str:
    """A new folder that the whole cluster sees; a local one only on one machine where none is named."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    base = base or tempfile.mkdtemp(prefix="siltworks-")
    return f"{base.rstrip('/')}/siltworks-{uuid.uuid4().hex}"


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed's lines, parsed."""
    return parse_lines(raw.feed(spark, sf_dir))


def ntz(c: str):
    return F.col(c).cast("timestamp_ntz")


_held: list[DataFrame] = []


def hold(*rows: DataFrame) -> DataFrame:
    """The last of ``rows``, kept until the next query that holds some; those before are what it is made of."""
    while _held and not any(_held[-1] is r for r in rows):
        _held.pop().unpersist()
    _held.append(rows[-1].persist(StorageLevel.MEMORY_AND_DISK))
    return rows[-1]


def good_rows(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """The good rows of the feed, held: lines are parsed once. ``keep``: of ``payload`` and its size, what is needed."""
    rows = good(parsed(spark, sf_dir))
    return hold(rows.drop(*{"payload", "payload_bytes"} - set(keep)))


def judged(spark: SparkSession, sf_dir: str, skip: tuple[str, ...] = (), registry: DataFrame | None = None, nullable: bool = False, rows: DataFrame | None = None):
    """(judged rows, columns, lookup) of the whole feed, or of ``rows`` of it."""
    rows = good_rows(spark, sf_dir) if rows is None else rows
    columns, lookup = entities.column_plan(entities.signatures(rows), registry if registry is not None else raw.registry(spark), skip, nullable)
    return shred.judged(rows, columns, lookup), columns, lookup


def loadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, columns, _ = judged(spark, sf_dir)
    return shred.shredded(rows, columns)


ACTION = "unstruct_event_com_acme_action_1"


def recovery(df: DataFrame) -> str:
    return next(c for c in df.columns if c.startswith(f"{ACTION}_recovered_1_0_2_"))


# --- parsing, keys, registry


@query("parse_tsv", "SELECT event_id, ts AS collector_tstamp, event_type AS event_name, user_id, CAST(value AS DECIMAL(18,2)) AS tr_total FROM feed WHERE good")
def parse_tsv(spark, sf_dir):
    return good(parsed(spark, sf_dir)).select("event_id", ntz("collector_tstamp").alias("collector_tstamp"), "event_name", "user_id", "tr_total")


@query("good_bad_split", "SELECT count(*) FILTER (good) AS n_good, count(*) FILTER (NOT good) AS n_bad, count(*) FILTER (short) AS n_short FROM feed")
def good_bad_split(spark, sf_dir):
    wrong = F.size("errors") > 0
    return parsed(spark, sf_dir).agg(F.count_if(~wrong).alias("n_good"), F.count_if(wrong).alias("n_bad"), F.count_if(F.array_contains("errors", "expected 7 fields")).alias("n_short"))


@query("entity_keys", "SELECT kind, vendor, name, version, count(*) AS n FROM parts GROUP BY ALL")
def entity_keys(spark, sf_dir):
    return counted(schema_counts(spark, sf_dir))


@query("entity_inventory", "SELECT kind, vendor, name, CAST(split_part(version, '-', 1) AS INT) AS model, array_to_string(list_sort(list(DISTINCT version)), ',') AS versions FROM parts GROUP BY 1, 2, 3, 4")
def entity_inventory(spark, sf_dir):
    return entities.inventory(good(parsed(spark, sf_dir)))


SKIP = ("iglu:com.acme/action/jsonschema/1-0-*", "iglu:*/free-form/*/*-*-*")


@query("skip_schemas", "SELECT kind, vendor, name, version, count(*) AS n FROM parts WHERE NOT (name = 'action' AND version LIKE '1-0-%') AND name <> 'free-form' GROUP BY ALL")
def skip_schemas(spark, sf_dir):
    return counted(entities.without_skipped(schema_counts(spark, sf_dir), SKIP))


def schema_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(kind, schema, n, parts): entities of the feed by schema; held, as some use them twice."""
    return hold(entities.counts(good(parsed(spark, sf_dir))))


def counted(found: DataFrame) -> DataFrame:
    return found.groupBy("kind", "vendor", "name", F.concat_ws("-", "model", "revision", "addition").alias("version")).agg(F.sum("n").alias("n"))


#: 10,000 criteria: all but a few meet nothing; they have all eight forms of a version, and whole parts.
MANY = (*SKIP, *(f"iglu:com.v{i % 500}/n{i}/jsonschema/{'*' if i & 1 else i}-{'*' if i & 2 else 0}-{'*' if i & 4 else 0}" for i in range(10_000)), "iglu:com.acme/user/jsonschema/2-*-1")


@query("skip_schemas_many", "SELECT kind, vendor, name, version, count(*)::BIGINT AS n FROM parts WHERE NOT (name = 'action' AND version LIKE '1-0-%') AND name <> 'free-form' GROUP BY ALL")
def skip_schemas_many(spark, sf_dir):
    """The same schemas skipped by a list of 10,000 criteria."""
    return counted(entities.without_skipped(schema_counts(spark, sf_dir), MANY))


@query("registry_large", "SELECT event_id, CASE WHEN u = 'unknown' THEN 'schema_missing' END AS kind FROM feed WHERE good AND coalesce(u <> 'oops', true)")
def registry_large(spark, sf_dir):
    """Missing schemas against a registry of 50,000: rows look up what they use, the plan names no schema."""
    i = F.col("id").cast("string")
    more = spark.range(50_000).select(F.concat(F.lit("com.v"), i).alias("vendor"), F.lit("thing").alias("name"), F.lit("jsonschema").alias("format"), F.lit("1-0-0").alias("version"), F.lit('{"type":"object"}').alias("schema_json"))
    rows, _, _ = judged(spark, sf_dir, (), raw.registry(spark).unionByName(more))
    return rows.where("kind is null or kind = 'schema_missing'").select("event_id", "kind")


@query("resolve_schemas", "SELECT DISTINCT kind, vendor, name, version, vendor = 'com.acme' AS known FROM parts")
def resolve_schemas(spark, sf_dir):
    used = entities.distinct_keys(good(parsed(spark, sf_dir)))
    return entities.resolve(used, raw.registry(spark)).select("kind", "vendor", "name", "version", F.col("schema_json").isNotNull().alias("known"))


@query("missing_schema_rows", "SELECT event_id, 'schema_missing' AS kind FROM feed WHERE good AND u = 'unknown'")
def missing_schema_rows(spark, sf_dir):
    return judged(spark, sf_dir)[0].where("kind = 'schema_missing'").select("event_id", "kind")


@query("missing_schema_report", "SELECT kind, 'iglu:' || vendor || '/' || name || '/jsonschema/' || version AS schema, count(*) AS n_entities FROM parts WHERE vendor = 'com.unknown' GROUP BY ALL")
def missing_schema_report(spark, sf_dir):
    return entities.missing(schema_counts(spark, sf_dir), raw.registry(spark)).select("kind", "schema", F.col("n").alias("n_entities"))


# --- shredding


@query("shred_unstruct", "SELECT event_id, CASE WHEN u IN ('v0', 'v1') THEN k END AS k, CASE WHEN u = 'v1' THEN 'web' END AS src FROM feed WHERE loaded")
def shred_unstruct(spark, sf_dir):
    return loadable(spark, sf_dir).select("event_id", f"{ACTION}.k", f"{ACTION}.src")


@query("shred_recovery", "SELECT event_id, coalesce(u NOT IN ('v0', 'v1'), true) AS base_is_null, CASE WHEN u = 'v2' THEN CAST(k AS VARCHAR) END AS recovered_k FROM feed WHERE loaded")
def shred_recovery(spark, sf_dir):
    rows = loadable(spark, sf_dir)
    return rows.select("event_id", F.col(ACTION).isNull().alias("base_is_null"), F.col(f"{recovery(rows)}.k").alias("recovered_k"))


@query("transform_failures", "SELECT event_id, CASE u WHEN 'unknown' THEN 'schema_missing' ELSE 'transform' END AS kind FROM feed WHERE good AND u IN ('oops', 'unknown')")
def transform_failures(spark, sf_dir):
    return judged(spark, sf_dir)[0].where("kind is not null").select("event_id", "kind")


@query("shred_contexts", "SELECT event_id, CASE WHEN ctx THEN 1 END AS n, CASE WHEN ctx THEN '2-0-0' END AS schema_version, CASE WHEN ctx THEN user_id END AS context_user_id FROM feed WHERE loaded")
def shred_contexts(spark, sf_dir):
    c = F.col("contexts_com_acme_user_2")
    first = F.get(c, F.lit(0))
    return loadable(spark, sf_dir).select("event_id", F.when(c.isNotNull(), F.size(c)).alias("n"), first["_schema_version"].alias("schema_version"), first["user_id"].alias("context_user_id"))


@query("shred_freeform", """SELECT event_id, CASE WHEN ctx AND event_id % 2 = 0 THEN '{"b":"' || event_type || '","a":"xyz","_schema_version":"1-0-0"}' END AS item FROM feed WHERE loaded""")
def shred_freeform(spark, sf_dir):
    return loadable(spark, sf_dir).select("event_id", F.get("contexts_com_acme_free_form_1", F.lit(0)).alias("item"))


@query("shred_empty_schema", "SELECT count(*) AS n_rows, count(*) FILTER (ctx AND event_id % 5 = 0) AS n_with_empty, 0 AS n_columns FROM feed WHERE loaded")
def shred_empty_schema(spark, sf_dir):
    rows, columns, _ = judged(spark, sf_dir)
    has = F.exists("contexts", lambda x: x["schema"].contains("/empty/"))
    return rows.where("kind is null").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(has).alias("n_with_empty"), F.lit(sum(c.name == "empty" for c in columns)).alias("n_columns"))


@query("required_fields", """SELECT 'respected' AS mode, count(*) AS n_failed FROM feed WHERE good AND (ctx OR u = 'oops') AND coalesce(u <> 'unknown', true)
    UNION ALL SELECT 'ignored', count(*) FROM feed WHERE good AND u = 'oops'""")
def required_fields(spark, sf_dir):
    stricter = [(v, n, f, ver, raw._schema({"user_id": "integer", "email": "string"}, ["user_id", "email"], False) if n == "user" else s) for v, n, f, ver, s in raw.REGISTRY]
    registry = spark.createDataFrame(stricter, raw.registry(spark).schema)
    rows = good_rows(spark, sf_dir)
    parts = [judged(spark, sf_dir, (), registry, nullable, rows)[0].where("kind = 'transform'").agg(F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("n_failed")) for mode, nullable in (("respected", False), ("ignored", True))]
    return parts[0].unionAll(parts[1])


@query("union_evolving", "SELECT event_id, k, CASE WHEN u = 'v1' THEN 'web' END AS src FROM feed WHERE loaded AND u IN ('v0', 'v1')")
def union_evolving(spark, sf_dir):
    rows = loadable(spark, sf_dir).select("event_id", ACTION)
    a, b = F.col(f"{ACTION}.k"), F.col(f"{ACTION}.src")
    old = rows.where(a.isNotNull() & b.isNull()).select("event_id", F.struct(a.alias("k")).alias("e"))
    new = rows.where(b.isNotNull()).select("event_id", F.struct(a.alias("k"), b.alias("src")).alias("e"))
    return layout.union_evolving([old, new]).select("event_id", "e.k", "e.src")


# --- failed events


@query("bad_rows_sink", "SELECT CASE WHEN NOT good THEN 'parsing' WHEN u = 'unknown' THEN 'schema_missing' ELSE 'transform' END AS kind, count(*) AS n, sum(strlen(line)) AS payload_bytes FROM feed WHERE NOT loaded GROUP BY 1")
def bad_rows_sink(spark, sf_dir):
    rows, _, _ = judged(spark, sf_dir, rows=good_rows(spark, sf_dir, "payload"))
    failed = bad(parsed(spark, sf_dir)).unionByName(rows.where("kind is not null").select("kind", "failure", "payload"))
    at = scratch(spark)
    bad_rows.records(failed).select("record").write.text(at)
    back = spark.read.text(at).select(F.from_json("value", "failure STRUCT<kind STRING>, payload STRING").alias("r"))
    return back.groupBy(F.col("r.failure.kind").alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("r.payload")).alias("payload_bytes"))


@query("bad_rows_capped", "SELECT 'large' AS cap, 'parsing' AS kind, count(*) AS n FROM feed WHERE NOT good UNION ALL SELECT 'small', 'size', count(*) FROM feed WHERE NOT good")
def bad_rows_capped(spark, sf_dir):
    failed = bad(parsed(spark, sf_dir))
    parts = [bad_rows.records(failed, most).groupBy(F.lit(cap).alias("cap"), "kind").agg(F.count(F.lit(1)).alias("n")) for cap, most in (("large", 100_000), ("small", 60))]
    return parts[0].unionAll(parts[1])


@query("bad_rows_undecodable", "SELECT count(*) AS n, sum(strlen(line) + 1)::BIGINT AS bytes, sum(length(line) + 1)::BIGINT AS chars, true AS replaced FROM feed WHERE event_id % 53 = 3")
def bad_rows_undecodable(spark, sf_dir):
    """Lines that are not UTF-8 keep their payload, with U+FFFD for the bytes that cannot be read, and count with all bytes."""
    line = F.col("line").cast("binary")
    lines = raw.feed(spark, sf_dir, "event_id").select(F.when(F.pmod("event_id", F.lit(53)) == 3, F.concat(line, F.unhex(F.lit("FF")))).otherwise(line).alias("value"))
    failed = parse_lines(lines, value_col="value").where(F.array_contains("errors", "not valid UTF-8"))
    return failed.agg(F.count(F.lit(1)).alias("n"), F.sum("payload_bytes").cast("long").alias("bytes"), F.sum(F.length("payload")).alias("chars"), F.every(F.endswith("payload", F.lit("\ufffd"))).alias("replaced"))


@query("bad_rows_requests", "SELECT CASE WHEN NOT good THEN 'parsing' WHEN u = 'unknown' THEN 'schema_missing' ELSE 'transform' END AS kind, count(*) AS n, true AS in_bounds, true AS many FROM feed WHERE NOT loaded GROUP BY 1")
def bad_rows_requests(spark, sf_dir):
    """Failed events of a load in requests of bounded records and bytes; a batch that is loaded twice is sent once."""
    at = scratch(spark)
    load = loader.Load(table(spark, f"{at}/lake"), raw.registry(spark), f"{at}/bad", f"{at}/metrics", value_col="line", bad_requests=True, write_partitions=PARTS)
    lake.create(spark, load.table)
    lines = raw.feed(spark, sf_dir, "event_id")
    for k in (0, 1, 1):
        loader.load_batch(lines.where(F.pmod("event_id", F.lit(2)) == k).drop("event_id").repartition(3), k, load)
    return in_requests(spark, load.bad_location)


def in_requests(spark: SparkSession, at: str, **bounds: int) -> DataFrame:
    records, most_bytes = bounds.get("max_records", requests.MAX_RECORDS), bounds.get("max_bytes", requests.MAX_BYTES)
    sizes = requests.sent(spark, at).agg(F.max("records").alias("records"), F.max("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"), F.sum("records").alias("all"))
    ok = sizes.select(((F.col("records") <= records) & (F.col("bytes") <= most_bytes)).alias("in_bounds"), (F.col("n") * records >= F.col("all")).alias("many"))
    kind = F.get_json_object("record", "$.failure.kind")
    held = requests.sent_records(spark, at).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return held.crossJoin(F.broadcast(ok))  # one row


# --- lake tables


def table(spark: SparkSession, at: str | None = None) -> lake.LakeTable:
    schema = T.StructType([f for f in ATOMIC if f.name not in ("unstruct_event", "contexts")] + [T.StructField("load_tstamp", T.TimestampType()), T.StructField("load_tstamp_date", T.DateType())])
    return lake.LakeTable(at or f"{scratch(spark)}/lake", schema=schema)


STAMP = datetime(2024, 5, 6, 7, 8, 9, 123456, tzinfo=UTC)
PARTS = 4


def written(spark: SparkSession, sf_dir: str, parts: int = PARTS) -> lake.LakeTable:
    t = table(spark)
    lake.create(spark, t)
    parsed_rows = good_rows(spark, sf_dir)
    rows, columns, _ = judged(spark, sf_dir, rows=parsed_rows)
    lake.append(layout.stamped(layout.laid_out(shred.shredded(rows, columns), parts, by_name(parsed_rows)), STAMP), t, 0)
    return t


def by_name(rows: DataFrame) -> DataFrame:
    """(event_name, n) of rows that are held, to lay out those of them that can be loaded."""
    return rows.groupBy("event_name").agg(F.count(F.lit(1)).alias("n"))


@query("lake_append", "SELECT event_type AS event_name, count(*) AS n_rows, sum(CAST(value AS DECIMAL(18,2))) AS total, sum(CASE WHEN u IN ('v0', 'v1') THEN k END)::BIGINT AS sum_k FROM feed WHERE loaded GROUP BY 1")
def lake_append(spark, sf_dir):
    back = lake.read(spark, written(spark, sf_dir))
    return back.groupBy("event_name").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("tr_total").alias("total"), F.sum(f"{ACTION}.k").alias("sum_k"))


@query("lake_readback", "SELECT event_type AS event_name, 2 * count(*) AS n_rows, count(*) FILTER (u IN ('v0', 'v1')) AS n_k, count(*) FILTER (u = 'v2') AS n_recovered FROM feed WHERE loaded GROUP BY 1")
def lake_readback(spark, sf_dir):
    """An older batch without entity columns and a newer one with them, in one table."""
    t, parsed_rows = table(spark), good_rows(spark, sf_dir)
    judged_rows, columns, _ = judged(spark, sf_dir, rows=parsed_rows)
    rows = hold(parsed_rows, layout.laid_out(shred.shredded(judged_rows, columns), PARTS, by_name(parsed_rows)))  # both batches are written from it
    lake.create(spark, t)
    lake.append(layout.stamped(rows.select("event_id", "collector_tstamp", "event_name", "user_id", "tr_total"), STAMP), t, 0)
    lake.append(layout.stamped(rows, STAMP), t, 1)
    back = lake.read(spark, t)
    return back.groupBy("event_name").agg(F.count(F.lit(1)).alias("n_rows"), F.count(f"{ACTION}.k").alias("n_k"), F.count(recovery(back)).alias("n_recovered"))


@query("lake_create_idempotent", "SELECT count(*) AS n_rows, 2 AS n_new_columns FROM feed WHERE loaded")
def lake_create_idempotent(spark, sf_dir):
    """Creating a table again leaves it, and columns it has got since, alone."""
    t = written(spark, sf_dir)
    lake.create(spark, t)
    back = lake.read(spark, t)
    return back.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(sum(c.startswith("contexts_") for c in back.columns)).alias("n_new_columns"))


@query("lake_compact", "SELECT event_type AS event_name, count(*) AS n_rows, sum(event_id)::BIGINT AS ids, 1 AS n_changed FROM feed WHERE loaded GROUP BY 1")
def lake_compact(spark, sf_dir):
    t = written(spark, sf_dir, 24)
    changed = lake.compact(spark, t, date(2024, 1, 1))
    return lake.read(spark, t).groupBy("event_name").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("ids"), F.lit(changed).alias("n_changed"))


RANGE = ("2024-01-05 00:00:00", "2024-01-20 00:00:00")


@query("lake_time_range_scan", f"SELECT event_type AS event_name, count(*) AS n_rows FROM feed WHERE loaded AND ts >= TIMESTAMP '{RANGE[0]}' AND ts < TIMESTAMP '{RANGE[1]}' AND event_type <> 'signup' GROUP BY 1")
def lake_time_range_scan(spark, sf_dir):
    """A range of collector times: pruned by partition (event name) and by file statistics (time)."""
    back = lake.read(spark, written(spark, sf_dir))
    held = back.where((F.col("collector_tstamp") >= F.lit(RANGE[0]).cast("timestamp")) & (F.col("collector_tstamp") < F.lit(RANGE[1]).cast("timestamp")) & (F.col("event_name") != "signup"))
    return held.groupBy("event_name").agg(F.count(F.lit(1)).alias("n_rows"))


FIRST, SPLITS = datetime(2024, 1, 1, tzinfo=UTC), 10
#: Two days of the thirty or so that the events lie on.
TWO_DAYS = (datetime(2024, 1, 8, tzinfo=UTC), datetime(2024, 1, 9, 23, 59, 59, 999999, tzinfo=UTC))


def by_arrival(spark: SparkSession, sf_dir: str, stamp: Callable[[int], datetime]) -> lake.LakeTable:
    """The feed in ten batches, each of three days of events, loaded at ``stamp(k)``."""
    t = table(spark)
    lake.create(spark, t)
    parsed_rows = good_rows(spark, sf_dir)
    rows, columns, _ = judged(spark, sf_dir, rows=parsed_rows)
    loaded = shred.shredded(rows, columns)
    for k in range(SPLITS):
        begin = F.lit(FIRST + timedelta(days=3 * k))
        own = lambda df, k=k, begin=begin: df.where((F.col("collector_tstamp") >= begin) if k else F.lit(True)).where((F.col("collector_tstamp") < F.lit(FIRST + timedelta(days=3 * k + 3))) if k < SPLITS - 1 else F.lit(True))
        lake.append(layout.stamped(layout.laid_out(own(loaded), 2, by_name(own(parsed_rows))), stamp(k)), t, k)
    return t


@query("lake_file_skipping", "SELECT true AS few_files, count(*) AS n_rows FROM feed WHERE loaded AND ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts <= TIMESTAMP '2024-01-09 23:59:59.999999'")
def lake_file_skipping(spark, sf_dir):
    """A range of two days of collector times: files whose bounds exclude it are left out before the scan."""
    t = by_arrival(spark, sf_dir, lambda k: STAMP + timedelta(days=k))
    held = lake.read(spark, t, times={"collector_tstamp": TWO_DAYS})
    few = 3 * len(lake.files(spark, t, times={"collector_tstamp": TWO_DAYS})) < len(lake.files(spark, t))
    return held.where(F.col("collector_tstamp").between(*map(F.lit, TWO_DAYS))).agg(F.lit(few).alias("few_files"), F.count(F.lit(1)).alias("n_rows"))


@query("lake_load_dates", "SELECT 3 AS n_dates, count(*) AS n_rows FROM feed WHERE loaded AND ts >= TIMESTAMP '2024-01-07' AND ts < TIMESTAMP '2024-01-16'")
def lake_load_dates(spark, sf_dir):
    """Three of ten load dates; the lists of the others are not read."""
    t = by_arrival(spark, sf_dir, lambda k: STAMP + timedelta(days=k))
    held = lake.read(spark, t, (STAMP + timedelta(days=2)).date(), (STAMP + timedelta(days=4)).date())
    return held.agg(F.countDistinct("load_tstamp_date").cast("int").alias("n_dates"), F.count(F.lit(1)).alias("n_rows"))


@query("lake_compact_batches", "SELECT event_type AS event_name, count(*) AS n_rows, sum(event_id)::BIGINT AS ids, 10 AS n_changed, true AS packed FROM feed WHERE loaded GROUP BY 1")
def lake_compact_batches(spark, sf_dir):
    """Ten batches of one load date, five minutes apart: no more files than their bytes need, and one, for each name.

    Files of a larger table are larger, and so are those that they are merged to: at least four go into each.
    """
    t = by_arrival(spark, sf_dir, lambda k: STAMP + timedelta(minutes=5 * k))
    before = lake.files(spark, t)
    target = max(16 << 10, 4 * max((f.bytes for f in before), default=0))
    changed = lake.compact(spark, t, STAMP.date(), small=target, target=target)
    after = lake.files(spark, t)
    packed = all(sum(f.partition == p for f in after) <= sum(f.bytes for f in before if f.partition == p) / target + 1 for p in {f.partition for f in before})
    return lake.read(spark, t).groupBy("event_name").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("ids"), F.lit(changed).alias("n_changed"), F.lit(packed).alias("packed"))


@query("lake_maintain", "SELECT count(*) AS n_rows, 1 AS n_parts FROM feed WHERE loaded")
def lake_maintain(spark, sf_dir):
    """After compaction, maintenance leaves the merged part only, and every row in it."""
    t = written(spark, sf_dir, 12)
    lake.compact(spark, t, date(2024, 1, 1))
    lake.maintain(spark, t, 0)
    back = lake.read(spark, t).select(F.regexp_extract("_metadata.file_path", "part=([^/]*)", 1).alias("part"))
    parts = len(lake.parts(spark, t))
    return back.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(parts).alias("n_parts"))


@query("load_stamp", "SELECT count(*) AS n_rows, 1 AS n_stamps, 1 AS n_dates, TIMESTAMP '2024-05-06 07:08:09.123456' AS stamp FROM feed WHERE loaded")
def load_stamp(spark, sf_dir):
    back = lake.read(spark, written(spark, sf_dir))
    return back.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("load_tstamp").alias("n_stamps"), F.countDistinct("load_tstamp_date").alias("n_dates"), F.max(ntz("load_tstamp")).alias("stamp"))


@query("layout_balance", "SELECT 6 AS n_parts, count(*)::BIGINT AS n_rows, true AS balanced FROM feed WHERE loaded")
def layout_balance(spark, sf_dir):
    """Parts of the layout, and whether each is within 1.2 times their mean."""
    parsed_rows = good_rows(spark, sf_dir)
    rows = judged(spark, sf_dir, rows=parsed_rows)[0].where("kind is null").select("event_name", "event_id")
    return balance(hold(parsed_rows, rows))


def balance(rows: DataFrame) -> DataFrame:
    sizes = layout.part_sizes(layout.laid_out(rows, 6))
    return sizes.agg(F.count(F.lit(1)).alias("n_parts"), F.sum("n_rows").alias("n_rows"), (F.max("n_rows") <= 1.2 * F.avg("n_rows")).alias("balanced"))


@query("layout_skewed", "SELECT 6 AS n_parts, count(*)::BIGINT AS n_rows, true AS balanced FROM feed WHERE good")
def layout_skewed(spark, sf_dir):
    """The same with 96 in 100 events of one name and the rest of names of their own."""
    rows = good(parsed(spark, sf_dir)).select(F.when(F.pmod("event_id", F.lit(25)) != 0, "click").otherwise(F.concat(F.lit("n"), F.col("event_id").cast("string"))).alias("event_name"), "event_id")
    return balance(hold(rows))


@query("layout_one_part", "SELECT 1 AS n_parts, count(*)::BIGINT AS n_rows FROM feed WHERE loaded")
def layout_one_part(spark, sf_dir):
    """A batch that is small for its target size is laid out as one part."""
    rows = judged(spark, sf_dir)[0].where("kind is null").select("event_name", "event_id")
    return layout.part_sizes(layout.laid_out(rows, layout.write_partitions(1))).agg(F.count(F.lit(1)).alias("n_parts"), F.sum("n_rows").alias("n_rows"))


@query("layout_write_partitions", "SELECT greatest(1, ceil(sum(strlen(line)) / 65536.0))::BIGINT AS aimed_at, least(count(*) FILTER (good), greatest(1, ceil(sum(strlen(line)) / 65536.0)))::BIGINT AS n_parts, count(*) FILTER (good) AS n_rows FROM feed")
def layout_write_partitions(spark, sf_dir):
    """The number of parts that the loader takes for so many bytes, for files of 64 KB, and those that rows are in."""
    rows = parsed(spark, sf_dir)
    n = layout.write_partitions(rows.agg(F.sum("payload_bytes")).first()[0], 65_536)
    sizes = layout.part_sizes(layout.laid_out(good(rows).select("event_name", "event_id"), n))
    return sizes.agg(F.lit(n).cast("long").alias("aimed_at"), F.count(F.lit(1)).alias("n_parts"), F.sum("n_rows").alias("n_rows"))


@query("strict_schemas", "SELECT count(*) > 0 AS stopped, CASE WHEN count(*) > 0 THEN 0 ELSE (SELECT count(*) FROM feed WHERE loaded) END::BIGINT AS n_rows FROM feed WHERE good AND u = 'unknown'")
def strict_schemas(spark, sf_dir):
    """Where schemas must be known, a batch with an unknown one stops before anything is written."""
    at = scratch(spark)
    load = loader.Load(table(spark, f"{at}/lake"), raw.registry(spark), f"{at}/bad", f"{at}/metrics", value_col="line", exit_on_missing=True, write_partitions=PARTS)
    lake.create(spark, load.table)
    try:
        loader.load_batch(raw.feed(spark, sf_dir), 0, load)
        stopped = False
    except entities.MissingSchema:
        stopped = True
    return lake.read(spark, load.table).agg(F.lit(stopped).alias("stopped"), F.count(F.lit(1)).alias("n_rows"))


# --- windows and metrics

DAY = "CASE WHEN NOT short THEN date_trunc('day', ts) END"


@query("window_counts", f"SELECT {DAY} AS window_start, count(*) AS received, count(*) FILTER (NOT good) AS bad, sum(strlen(line))::BIGINT AS bytes, min(ts) FILTER (good) AS earliest_collector_tstamp FROM feed GROUP BY 1")
def window_counts(spark, sf_dir):
    found = metrics.window_counts(parsed(spark, sf_dir), 86_400)
    return found.select(ntz("window_start").alias("window_start"), "received", "bad", "bytes", ntz("earliest_collector_tstamp").alias("earliest_collector_tstamp"))


@query("window_columns", "SELECT DISTINCT kind || '_' || replace(vendor, '.', '_') || '_' || replace(name, '-', '_') || '_' || split_part(version, '-', 1) AS column_name FROM parts")
def window_columns(spark, sf_dir):
    return entities.column_names(good(parsed(spark, sf_dir)))


#: The clock of a load: batch k starts k hours after STAMP, less 1.5 seconds, and is committed k hours after it.
TAKES = timedelta(milliseconds=1500)


def timed_load(spark: SparkSession, sf_dir: str, at: str) -> tuple[loader.Load, DataFrame]:
    """A load into ``at`` and the lines; ts is when the source got a line."""
    load = loader.Load(table(spark, f"{at}/lake"), raw.registry(spark), f"{at}/bad", f"{at}/metrics", value_col="line", source_ts_col="ts", write_partitions=PARTS, compact_every=None)
    lake.create(spark, load.table)
    return load, raw.feed(spark, sf_dir, "event_id", "ts").withColumn("ts", F.col("ts").cast("timestamp"))


def load_quarter(lines: DataFrame, k: int, load: loader.Load) -> None:
    """Batch k of four, by event_id, with a clock that moves from its start to its commit."""
    done = STAMP + timedelta(hours=k)
    times = iter((done - TAKES, done))
    load.clock = lambda: next(times)
    loader.load_batch(lines.where(F.pmod("event_id", F.lit(4)) == k).drop("event_id"), k, load)


def loaded_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loader's own metrics of four batches."""
    load, lines = timed_load(spark, sf_dir, scratch(spark))
    for k in range(4):
        load_quarter(lines, k, load)
    return loader.read_metrics(spark, load)


BATCHES = """, stamp AS (SELECT TIMESTAMP '2024-05-06 07:08:09.123456' AS done),
batches AS (SELECT event_id % 4 AS batch_id, count(*) AS received, count(*) FILTER (NOT loaded) AS bad, count(*) FILTER (loaded) AS committed,
    (epoch_us(any_value(done)) - epoch_us(min(ts))) // 1000 AS stream, (epoch_us(any_value(done)) - epoch_us(min(ts) FILTER (good))) // 1000 AS e2e FROM feed, stamp GROUP BY 1)
"""


@query("batch_latencies", BATCHES + "SELECT batch_id, received, bad, committed, stream + batch_id * 3600000 AS stream_latency_ms, 1500::BIGINT AS processing_latency_ms, e2e + batch_id * 3600000 AS e2e_latency_ms FROM batches")
def batch_latencies(spark, sf_dir):
    """What the loader reports of each batch: counts, and the greatest latencies; each takes 1.5 seconds of its clock."""
    return loaded_metrics(spark, sf_dir).select("batch_id", "received", "bad", "committed", "stream_latency_ms", "processing_latency_ms", "e2e_latency_ms")


@query("latency_report", BATCHES + "SELECT TIMESTAMP '2024-05-06' AS period_start, sum(received)::BIGINT AS received, sum(bad)::BIGINT AS bad, sum(committed)::BIGINT AS committed, max(stream + batch_id * 3600000) AS stream_latency_ms, 1500::BIGINT AS processing_latency_ms, max(e2e + batch_id * 3600000) AS e2e_latency_ms FROM batches")
def latency_report(spark, sf_dir):
    return metrics.report(loaded_metrics(spark, sf_dir), 86_400).withColumn("period_start", ntz("period_start"))


#: From 1 January 2024 to STAMP: batches whose earliest event is older are unhealthy.
LIMIT_MS = 126 * 86_400_000


@query("freshness_check", BATCHES + f"SELECT batch_id, e2e + batch_id * 3600000 AS e2e_latency_ms FROM batches WHERE e2e + batch_id * 3600000 > {LIMIT_MS}")
def freshness_check(spark, sf_dir):
    return metrics.unhealthy(loaded_metrics(spark, sf_dir), LIMIT_MS).select("batch_id", "e2e_latency_ms")


# --- streaming


def streamed(spark: SparkSession, lines: DataFrame, runs: int = 1, **limits) -> tuple[loader.Load, str]:
    """The lines as files of a folder, loaded by the streaming loader until none is left."""
    at = scratch(spark)
    lines.write.text(f"{at}/in")
    load = loader.Load(table(spark, f"{at}/lake"), raw.registry(spark), f"{at}/bad", f"{at}/metrics", write_partitions=PARTS)
    for _ in range(runs):
        loader.start(streams.files(spark, f"{at}/in", **limits), load, f"{at}/checkpoint", None).awaitTermination()
    return load, at


def by_event(spark: SparkSession, load: loader.Load) -> DataFrame:
    return lake.read(spark, load.table).groupBy("event_name").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("ids"))


BY_EVENT = "SELECT event_type AS event_name, count(*) AS n_rows, sum(event_id)::BIGINT AS ids FROM feed WHERE loaded GROUP BY 1"


@query("stream_load", BY_EVENT)
def stream_load(spark, sf_dir):
    load, _ = streamed(spark, raw.feed(spark, sf_dir))
    return by_event(spark, load)


@query("stream_load_limited", BY_EVENT)
def stream_load_limited(spark, sf_dir):
    """The same feed in several windows of at most two files."""
    load, _ = streamed(spark, raw.feed(spark, sf_dir).repartition(6), max_files=2)
    return by_event(spark, load)


@query("stream_metrics", "SELECT count(*) AS received, count(*) FILTER (NOT loaded) AS bad, count(*) FILTER (loaded) AS committed, sum(strlen(line))::BIGINT AS bytes, min(ts) FILTER (good) AS earliest FROM feed")
def stream_metrics(spark, sf_dir):
    """Sums over the metrics of all windows of a stream."""
    load, _ = streamed(spark, raw.feed(spark, sf_dir).repartition(4), max_files=2)
    return loader.read_metrics(spark, load).agg(*[F.sum(c).alias(c) for c in ("received", "bad", "committed", "bytes")], F.min(ntz("earliest_collector_tstamp")).alias("earliest"))


@query("stream_resume", BY_EVENT)
def stream_resume(spark, sf_dir):
    """Started twice from one checkpoint: the second run finds nothing new."""
    load, _ = streamed(spark, raw.feed(spark, sf_dir), runs=2)
    return by_event(spark, load)


@query("stream_all_bad", "SELECT count(*) AS n_bad, 0::BIGINT AS n_rows FROM feed WHERE short")
def stream_all_bad(spark, sf_dir):
    """Windows without a good line commit nothing, and are done all the same."""
    load, _ = streamed(spark, raw.feed(spark, sf_dir).where(F.size(F.split("line", "\t")) == 3))
    rows = lake.read(spark, load.table).select(F.lit(0).alias("bad"))
    both = loader.read_bad(spark, load).select(F.lit(1).alias("bad")).unionByName(rows)
    return both.agg(F.count_if(F.col("bad") == 1).alias("n_bad"), F.count_if(F.col("bad") == 0).alias("n_rows"))


@query("stream_replay_idempotent", BY_EVENT)
def stream_replay_idempotent(spark, sf_dir):
    """A batch that failed after its rows were written is loaded again: it replaces itself."""
    at = scratch(spark)
    load = loader.Load(table(spark, f"{at}/lake"), raw.registry(spark), f"{at}/bad", f"{at}/metrics", value_col="line", write_partitions=PARTS)
    lake.create(spark, load.table)
    for _ in range(2):
        loader.load_batch(raw.feed(spark, sf_dir), 7, load)
    return by_event(spark, load)


@query("stream_bad_rows", "SELECT CASE WHEN NOT good THEN 'parsing' WHEN u = 'unknown' THEN 'schema_missing' ELSE 'transform' END AS kind, count(*) AS n FROM feed WHERE NOT loaded GROUP BY 1")
def stream_bad_rows(spark, sf_dir):
    """Failed events of a stream, by kind."""
    load, _ = streamed(spark, raw.feed(spark, sf_dir))
    return loader.read_bad(spark, load).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("stream_bad_requests", "SELECT 'parsing' AS kind, count(*) AS n, true AS in_bounds, true AS many FROM feed WHERE NOT good")
def stream_bad_requests(spark, sf_dir):
    """A stream of failed lines to requests of at most 20 records and 4,096 bytes, in several batches, with a restart."""
    at, bounds = scratch(spark), {"max_records": 20, "max_bytes": 4096}
    raw.feed(spark, sf_dir).repartition(6).write.text(f"{at}/in")
    for _ in range(2):
        failed = bad(parse_lines(streams.files(spark, f"{at}/in", max_files=2), value_col="value"))
        requests.start(bad_rows.records(failed, 2000), f"{at}/requests", f"{at}/checkpoint", None, **bounds).awaitTermination()
    return in_requests(spark, f"{at}/requests", **bounds)


FROM = datetime(2024, 1, 6, 12, tzinfo=UTC)


@query("stream_source", "SELECT event_type AS event_name, count(*) AS n_rows, sum(event_id)::BIGINT AS ids FROM feed WHERE loaded AND ts >= TIMESTAMP '2024-01-06 12:00:00' GROUP BY 1")
def stream_source(spark, sf_dir):
    """A sharded log, loaded from a time on: the query is stopped after each batch and goes on, while the log grows."""
    at = scratch(spark)
    lines = raw.feed(spark, sf_dir, "event_id", "ts").withColumn("ts", F.col("ts").cast("timestamp"))
    later = F.col("ts") >= F.lit(FROM + timedelta(days=10))
    put = lambda rows, n: shards.append(rows, f"{at}/log", F.col("event_id"), F.col("ts"), F.col("line"), 4, n)
    put(lines.where(~later), 0)
    load = loader.Load(table(spark, f"{at}/lake"), raw.registry(spark), f"{at}/bad", f"{at}/metrics", source_ts_col="arrived", write_partitions=PARTS)
    most = spark.read.parquet(f"{at}/log").count() // 3
    for k in range(3):
        limit = most if k < 2 else None
        stream = shards.stream(spark, f"{at}/log", FROM.isoformat(), limit, f"{at}/checkpoint")
        loader.start(stream, load, f"{at}/checkpoint", None).awaitTermination()
        if k == 0:
            put(lines.where(later), 1)
    return by_event(spark, load)


@query("stream_report", BATCHES + "SELECT TIMESTAMP '2024-05-06 07:00:00' + to_hours(CAST(batch_id AS INT)) AS period_start, received, bad, committed, stream + batch_id * 3600000 AS stream_latency_ms, 1500::BIGINT AS processing_latency_ms, e2e + batch_id * 3600000 AS e2e_latency_ms FROM batches WHERE batch_id < 3")
def stream_report(spark, sf_dir):
    """Hourly reports of a load, each written once when its hour is closed, by a streaming query that is restarted."""
    at = scratch(spark)
    load, lines = timed_load(spark, sf_dir, at)
    for k in range(4):
        load_quarter(lines, k, load)
        metrics.running_report(spark, load.metrics_location, f"{at}/report", f"{at}/checkpoint", 3600).awaitTermination()
    return spark.read.parquet(f"{at}/report").withColumn("period_start", ntz("period_start"))
