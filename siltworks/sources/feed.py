"""The raw feed derived from the ``events`` table (FIXTURES.md, part B), and its schema registry."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.local import local

ACTION, USER, FREE, EMPTY, UNKNOWN = "com.acme/action", "com.acme/user", "com.acme/free-form", "com.acme/empty", "com.unknown/thing"


def _schema(properties: dict[str, str], required: list[str], additional: bool) -> str:
    return json.dumps({"type": "object", "properties": {k: {"type": v} for k, v in properties.items()}, "required": required, "additionalProperties": additional})


REGISTRY = [
    ("com.acme", "action", "jsonschema", "1-0-0", _schema({"k": "integer"}, ["k"], False)),
    ("com.acme", "action", "jsonschema", "1-0-1", _schema({"k": "integer", "src": "string"}, ["k"], False)),
    ("com.acme", "action", "jsonschema", "1-0-2", _schema({"k": "string"}, ["k"], False)),
    ("com.acme", "user", "jsonschema", "2-0-0", _schema({"user_id": "integer"}, ["user_id"], False)),
    ("com.acme", "free-form", "jsonschema", "1-0-0", _schema({}, [], True)),
    ("com.acme", "empty", "jsonschema", "1-0-0", _schema({}, [], False)),
]


def registry(spark: SparkSession) -> DataFrame:
    """The schema registry as a table (vendor, name, format, version, schema_json)."""
    return local(spark, REGISTRY, "vendor string, name string, format string, version string, schema_json string")


def _entity(schema: str, version: str, data: Column) -> Column:
    return F.concat(F.lit(f'{{"schema":"iglu:{schema}/jsonschema/{version}","data":'), data, F.lit("}"))


def raw_lines(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(event_id, line, keep...): each event as one tab-separated line, some of them corrupt on purpose."""
    i, k = F.col("event_id"), F.get_json_object("props", "$.k")
    num = F.concat(F.lit('{"k":'), k, F.lit("}"))
    unstruct = (
        F.when(F.col("event_type") == "signup", "")
        .when(i % 101 == 5, _entity(UNKNOWN, "1-0-0", F.concat(F.lit('{"z":'), k, F.lit("}"))))
        .when(i % 61 == 9, _entity(ACTION, "1-0-0", F.lit('{"k":"oops"}')))
        .when(i % 3 == 0, _entity(ACTION, "1-0-0", num))
        .when(i % 3 == 1, _entity(ACTION, "1-0-1", F.concat(F.lit('{"k":'), k, F.lit(',"src":"web"}'))))
        .otherwise(_entity(ACTION, "1-0-2", F.concat(F.lit('{"k":"'), k, F.lit('"}'))))
    )
    user = _entity(USER, "2-0-0", F.concat(F.lit('{"user_id":'), F.col("user_id").cast("string"), F.lit("}")))
    free = F.when(i % 2 == 0, _entity(FREE, "1-0-0", F.concat(F.lit('{"b":"'), F.col("event_type"), F.lit('","a":"xyz"}'))))
    empty = F.when(i % 5 == 0, _entity(EMPTY, "1-0-0", F.lit("{}")))
    contexts = F.when(i % 11 == 0, "").otherwise(F.concat(F.lit("["), F.concat_ws(",", user, free, empty), F.lit("]")))
    total = F.when(i % 89 == 7, "abc").otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
    head = F.concat_ws("\t", i.cast("string"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "event_type")
    rest = [F.coalesce(c, F.lit("")) for c in (F.col("user_id").cast("string"), total, unstruct, contexts)]
    return events.select("event_id", F.when(i % 97 == 13, head).otherwise(F.concat_ws("\t", head, *rest)).alias("line"), *[c for c in keep if c != "event_id"])


#: Bytes of ``events.parquet`` that one task turns into lines, some 170,000 events.
TASK_BYTES = 2 << 20


def spread(df: DataFrame, size: int) -> DataFrame:
    """``df``, read from files of ``size`` bytes, in partitions of TASK_BYTES, and as many as there are cores at least.

    Always by a shuffle, of the narrow rows before they grow to lines: the number of a file's splits says nothing of where its
    rows are, as a row group, which may be the whole file, is read by one task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-size // TASK_BYTES)), *df.columns)


def _size(spark: SparkSession, location: str) -> int:
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def feed(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """The lines of ``events.parquet``."""
    at = f"{sf_dir}/events.parquet"
    events = spread(spark.read.parquet(at), _size(spark, at))
    return raw_lines(events).select("line") if not keep else raw_lines(events, keep).select("line", *keep)
