"""Parsing tab-separated event lines into typed rows, with column expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Default fields of a line; any ordered StructType may stand in for it.
ATOMIC = T.StructType(
    [
        T.StructField("event_id", T.LongType(), False),
        T.StructField("collector_tstamp", T.TimestampType(), False),
        T.StructField("event_name", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("tr_total", T.DecimalType(18, 2)),
        T.StructField("unstruct_event", T.StringType()),
        T.StructField("contexts", T.StringType()),
    ]
)
ENTITY_JSON = "schema STRING, data STRING"


def decode_utf8(value: Column) -> tuple[Column, Column]:
    """(text, whether the bytes are valid UTF-8); what is not valid becomes U+FFFD, so that no payload is lost."""
    raw = value.cast("string")
    return F.make_valid_utf8(raw), F.is_valid_utf8(raw)


def once(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with ``columns`` evaluated once per row.

    Without it the optimizer pushes later filters below, and repeats the parsing in every condition that
    uses its result. A generator of one element keeps them above.
    """
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, F.explode(F.array(F.struct(*columns))).alias("_once")).select(*[F.col(f"_once.{c}").alias(c) if c in columns else F.col(c) for c in df.columns])


def _typed(raw: Column, field: T.StructField) -> Column:
    if isinstance(field.dataType, T.StringType):
        return raw
    return raw.try_cast(field.dataType)


def parse_lines(lines: DataFrame, fields: T.StructType = ATOMIC, value_col: str = "line", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per line: ``payload``, its size as it came in ``payload_bytes``, the typed ``fields``, entities and ``errors``.

    No errors: a good row. ``value_col`` may hold text or bytes; null and undecodable values are errors, and the payload
    of the latter has U+FFFD for what cannot be decoded. Empty fields are null.
    A wrong number of fields, a value that its type cannot hold, a null in a field that must have a value
    and text that is no self-describing JSON are errors, all of a line reported together. The JSON columns
    ``unstruct_event`` and ``contexts``, if among the fields, become struct<schema, data> and an array of it.
    """
    text, valid = decode_utf8(F.col(value_col))
    size = F.coalesce(F.octet_length(F.col(value_col)), F.lit(0))
    split = lines.select(*keep, text.alias("payload"), size.alias("payload_bytes"), F.coalesce(valid, F.lit(False)).alias("_valid")).withColumn("_f", F.when(F.col("_valid"), F.split("payload", "\t", -1)))
    n = len(fields)
    complete = F.coalesce(F.size("_f") == n, F.lit(False))
    raw = {f.name: F.nullif(F.get("_f", F.lit(i)), F.lit("")) for i, f in enumerate(fields)}
    named = [complete.alias("_complete"), *[F.when(complete, raw[f.name]).alias(f"_raw_{f.name}") for f in fields], *[F.when(complete, _typed(raw[f.name], f)).alias(f.name) for f in fields]]
    own = ("payload", "payload_bytes")
    typed = split.select(*keep, *own, "_valid", *named)
    names = set(fields.fieldNames())
    entities = {}
    if "unstruct_event" in names:
        entities["unstruct_event"] = F.from_json("unstruct_event", ENTITY_JSON)
    if "contexts" in names:
        entities["contexts"] = F.from_json("contexts", f"ARRAY<STRUCT<{ENTITY_JSON}>>")
    typed = once(typed.withColumns(entities) if entities else typed, ["_complete", *[f"_raw_{f.name}" for f in fields], *fields.fieldNames()])
    found = [F.when(~F.col("_valid"), "not valid UTF-8"), F.when(F.col("_valid") & ~F.col("_complete"), F.concat(F.lit(f"expected {n} fields")))]
    for f in fields:
        bad = F.col(f"_raw_{f.name}").isNotNull() & F.col(f.name).isNull()
        if f.name == "unstruct_event":
            bad = F.col(f"_raw_{f.name}").isNotNull() & (F.col("unstruct_event.schema").isNull() | F.col("unstruct_event.data").isNull())
        if f.name == "contexts":
            bad = bad | F.coalesce(F.exists("contexts", lambda c: c["schema"].isNull() | c["data"].isNull()), F.lit(False))
        found.append(F.when(bad, f"{f.name}: cannot be read as {f.dataType.simpleString() if f.name not in entities else 'self-describing JSON'}"))
        if not f.nullable:
            found.append(F.when(F.col("_complete") & F.col(f"_raw_{f.name}").isNull(), f"{f.name}: missing"))
    out = typed.withColumn("errors", F.array_compact(F.array(*found)))
    return once(out.select(*keep, *own, *fields.fieldNames(), "errors"), ["errors"])


def good(parsed: DataFrame) -> DataFrame:
    """Rows without errors."""
    return parsed.where(F.size("errors") == 0).drop("errors")


def bad(parsed: DataFrame) -> DataFrame:
    """Rows with errors, as failures of kind ``parsing``."""
    return parsed.where(F.size("errors") > 0).select(F.lit("parsing").alias("kind"), F.array_join("errors", "; ").alias("failure"), "payload")
