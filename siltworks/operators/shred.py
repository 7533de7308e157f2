"""Shredding self-describing JSON into typed columns, with strict type checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import json_schema as js
from ..functions import schema_keys as keys
from ..functions.atomic import once
from .entities import Lookup


def _is(schema: Column, c: js.EntityColumn) -> Column:
    """Whether a schema key is one of the column's versions: plain equality with a short list."""
    return schema.isin([f"iglu:{c.vendor}/{c.name}/jsonschema/{v}" for v in c.versions])


def _versioned(item: Column, c: js.EntityColumn) -> Column:
    """A context item with its version: first in a struct, last in JSON text."""
    version = keys.version(keys.parts(item["schema"]))
    if c.type.kind != "struct":
        body = F.regexp_replace(item["data"], r"\s*\}\s*$", "")
        comma = F.when(body.rlike(r"^\s*\{\s*$"), "").otherwise(",")
        return F.when(item["data"].rlike(r"\}\s*$"), F.concat(body, comma, F.lit('"_schema_version":"'), version, F.lit('"}'))).otherwise(item["data"])
    data = js.taken(item["v"], item["data"], c.type)
    return F.struct(version.alias("_schema_version"), *[data[js.normal(f.name)].alias(js.normal(f.name)) for f in c.type.fields])


def value(c: js.EntityColumn) -> Column:
    """The column's value of a judged row: null unless the row has the entity in one of its versions."""
    if c.kind == "unstruct_event":
        return F.when(_is(F.col("unstruct_event.schema"), c), js.taken(F.col("unstruct_event.v"), F.col("unstruct_event.data"), c.type))
    items = F.filter("contexts", lambda x: _is(x["schema"], c))
    return F.when(F.size(items) > 0, F.transform(items, lambda x: _versioned(x, c)))


def _read(rows: DataFrame, columns: Sequence[js.EntityColumn]) -> DataFrame:
    """``rows`` with the JSON of each typed entity parsed, once, beside its text: the variant ``v``."""
    schemas = {kind: [f"iglu:{c.vendor}/{c.name}/jsonschema/{x}" for c in columns if c.kind == kind and c.type.kind != "json" for x in c.versions] for kind in ("unstruct_event", "contexts")}

    def entity(e: Column, kind: str) -> Column:
        v = F.try_parse_json(F.when(e["schema"].isin(schemas[kind]), e["data"])) if schemas[kind] else F.lit(None).cast("variant")
        return F.struct(e["schema"].alias("schema"), e["data"].alias("data"), v.alias("v"))

    unstruct = F.col("unstruct_event")
    parsed = {"unstruct_event": F.when(unstruct["schema"].isNotNull(), entity(unstruct, "unstruct_event")), "contexts": F.transform("contexts", lambda x: entity(x, "contexts"))}
    return once(rows.withColumns(parsed), list(parsed))


def _misfit(c: js.EntityColumn) -> Column:
    """Message where the row's data does not fit the column's type, else null."""
    if c.type.kind == "json":
        return F.lit(None).cast("string")
    ok = lambda v: js.bound(v, lambda x: js.fits(x, c.type))
    if c.kind == "unstruct_event":
        wrong = _is(F.col("unstruct_event.schema"), c) & ~ok(F.col("unstruct_event.v"))
    else:
        wrong = F.exists("contexts", lambda x: _is(x["schema"], c) & ~ok(x["v"]))
    return F.when(wrong, f"{c.column}: data does not fit its schema")


def failures(columns: Sequence[js.EntityColumn]) -> Column:
    """Array of messages of a row whose JSON was read; empty if all of its entities fit."""
    if not columns:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[_misfit(c) for c in columns]))


def judged(rows: DataFrame, columns: Sequence[js.EntityColumn], lookup: Lookup | None = None) -> DataFrame:
    """Parsed rows with ``kind`` and ``failure``, both null where the row can be loaded.

    Rows may have parse ``errors`` still; they fail with kind ``parsing``. JSON data is parsed once here, and the typed
    columns are taken from it later.
    """
    out = [c for c in rows.columns if c != "errors"]
    unread = F.size("errors") > 0 if "errors" in rows.columns else F.lit(False)
    message = F.array_join("errors", "; ") if "errors" in rows.columns else F.lit(None).cast("string")
    marked = (lookup or Lookup(None)).marked(rows, "_missing")
    checked = once(_read(marked, columns).select("*", failures(columns).alias("_found")), ["_found"])
    absent_, wrong = F.col("_missing"), F.size("_found") > 0
    kind = F.when(unread, "parsing").when(absent_, "schema_missing").when(wrong, "transform").alias("kind")
    failure = F.when(unread, message).when(absent_, "schema not in the registry").when(wrong, F.array_join("_found", "; ")).alias("failure")
    return checked.select(*out, kind, failure)


def shredded(judged_rows: DataFrame, columns: Sequence[js.EntityColumn], keep: Sequence[str] = ()) -> DataFrame:
    """The loadable rows: atomic fields, then one typed column for each of ``columns``. One select."""
    atomic = [c for c in judged_rows.columns if c not in {"payload", "payload_bytes", "unstruct_event", "contexts", "kind", "failure", "errors", *keep}]
    return judged_rows.where("kind is null").select(*keep, *atomic, *[value(c).alias(c.column) for c in columns])
