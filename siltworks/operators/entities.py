"""Entities of parsed events: inventory, skipping, resolving against the registry."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import schema_keys as keys
from ..functions.atomic import once
from ..functions.json_schema import EntityColumn, normal, plan
from ..functions.local import local

#: A registry beyond this many bytes is joined by a shuffle.
BROADCAST_BYTES = 16 << 20


def entities(parsed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., kind, schema, vendor, name, format, model, revision, addition), one row per entity.

    Keys that are no schema keys have null parts. No shuffle.
    """
    unstruct = F.when(F.col("unstruct_event.schema").isNotNull(), F.array(F.struct(F.lit("unstruct_event").alias("kind"), F.col("unstruct_event.schema").alias("schema"))))
    contexts = F.transform("contexts", lambda c: F.struct(F.lit("contexts").alias("kind"), c["schema"].alias("schema")))
    none = F.array().cast("array<struct<kind:string,schema:string>>")
    return with_parts(parsed.select(*keep, F.explode(F.concat(F.coalesce(unstruct, none), F.coalesce(contexts, none))).alias("e")).select(*keep, "e.kind", "e.schema"))


def with_parts(used: DataFrame) -> DataFrame:
    """Rows with a ``schema``, and the parts of it."""
    return used.select("*", keys.parts(F.col("schema")).alias("_k")).select(*used.columns, "_k.*")


def counts(parsed: DataFrame) -> DataFrame:
    """(kind, schema, n, vendor, name, format, model, revision, addition): entities by schema.

    They are counted by their texts, and combined before the shuffle; only schemas, not entities, are taken apart.
    """
    found = entities(parsed).select("kind", "schema")  # nobody asks for the parts: they are not made
    each = found.groupBy("kind", "schema").agg(F.count(F.lit(1)).alias("n"))
    return with_parts(once(each, ["schema"]))  # filters by parts stay above


def distinct_keys(parsed: DataFrame) -> DataFrame:
    """Distinct (kind, schema) with parts; as many rows as there are schemas in use."""
    return counts(parsed).drop("n")


def inventory(parsed: DataFrame) -> DataFrame:
    """(kind, vendor, name, model, versions): which sub-versions of each entity a batch holds."""
    version = F.concat_ws("-", "model", "revision", "addition")
    found = counts(parsed).select("kind", "vendor", "name", "model", version.alias("v"))
    return found.groupBy("kind", "vendor", "name", "model").agg(F.array_join(F.sort_array(F.collect_set("v")), ",").alias("versions"))


def without_skipped(used: DataFrame, criteria: Sequence[str]) -> DataFrame:
    """Rows with a ``schema`` that meets none of the criteria.

    Each distinct schema looks its masked forms up in the table of criteria, which is broadcast if its bytes are few: the
    plan is the same for one criterion and for very many.
    """
    if not criteria:
        return used
    stated = sorted({keys.criterion(c) for c in criteria})
    table = local(used.sparkSession, [(keys.form(c),) for c in stated], "form string")
    table = F.broadcast(table) if sum(len(keys.form(c)) + 40 for c in stated) <= BROADCAST_BYTES else table
    looked = used.select("schema").distinct().select("schema", F.explode(keys.forms(F.col("schema"), sorted({keys.mask(c) for c in stated}))).alias("form"))
    return used.join(looked.join(table, "form", "left_semi").select("schema").distinct(), "schema", "left_anti").select(used.columns)


def is_small(registry: DataFrame) -> bool:
    """Whether the registry's bytes are few enough for a broadcast. Asked once of each registry."""
    if not hasattr(registry, "_siltworks_small"):
        registry._siltworks_small = (registry.agg(F.sum(F.octet_length("schema_json") + 200)).first()[0] or 0) <= BROADCAST_BYTES
    return registry._siltworks_small


def resolve(used: DataFrame, registry: DataFrame) -> DataFrame:
    """``used`` with schema_json, null where the registry lacks the schema.

    The registry is broadcast if its bytes are few, and shuffled otherwise.
    """
    known = registry.select("vendor", "name", "format", "version", "schema_json")
    small = is_small(registry)
    version = F.concat_ws("-", "model", "revision", "addition")
    left = used.withColumn("version", version)
    return left.join(F.broadcast(known) if small else known, ["vendor", "name", "format", "version"], "left")


def missing(used: DataFrame, registry: DataFrame, criteria: Sequence[str] = ()) -> DataFrame:
    """Schemas in use that are neither skipped nor in the registry."""
    return resolve(without_skipped(used, criteria), registry).where("schema_json is null")


class MissingSchema(Exception):
    """The strict mode found schemas that the registry lacks."""


def signature() -> Column:
    """All schemas that a parsed row uses, with the kind of entity before each: rows that use the same share one."""
    unstruct = F.array(F.concat(F.lit("unstruct_event "), F.col("unstruct_event.schema")))
    contexts = F.coalesce(F.transform("contexts", lambda c: F.concat(F.lit("contexts "), c["schema"])), F.array().cast("array<string>"))
    return F.array_sort(F.array_distinct(F.array_compact(F.concat(unstruct, contexts))))


def signatures(parsed: DataFrame, *by: str) -> DataFrame:
    """(signature, by..., n): how many rows use the same schemas. Combined before the only shuffle."""
    return parsed.groupBy(signature().alias("signature"), *by).agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class Lookup:
    """What the registry lacks of a batch's schemas: the signatures that have one (None: there are none), and some of them.

    Rows look their signature up in ``lacking`` by a join, a broadcast one up to FEW signatures: no list of schemas
    becomes part of a plan.
    """

    lacking: DataFrame | None
    absent: tuple[str, ...] = ()

    def marked(self, rows: DataFrame, column: str) -> DataFrame:
        """``rows`` with whether they use a schema that is neither known nor skipped."""
        if self.lacking is None:
            return rows.withColumn(column, F.lit(False))
        theirs = self.lacking.select(F.col("signature").alias("_signature"), F.lit(True).alias("_lacks"))
        return rows.join(theirs, signature() == F.col("_signature"), "left").withColumn(column, F.coalesce("_lacks", F.lit(False))).drop("_signature", "_lacks")


#: Lacking signatures up to which they are broadcast.
FEW = 10_000


def column_plan(used: DataFrame, registry: DataFrame, criteria: Sequence[str] = (), nullable_everywhere: bool = False) -> tuple[list[EntityColumn], Lookup]:
    """(columns, lookup) for a batch with these signatures (as signatures() gives them).

    Collects the registry's versions of the models in use, and no more than FEW signatures with a schema that is
    missing, whatever strings events carry as schemas. Columns come from all versions of a model, so that they do not
    depend on what a batch happens to hold.
    """
    spark = used.sparkSession
    own = None if used.is_cached else used.persist()  # few rows, of a pass over all
    each = used.select("signature", F.explode("signature").alias("e")).select("signature", F.split("e", " ", 2)[0].alias("kind"), F.split("e", " ", 2)[1].alias("schema"))
    mine = each.groupBy("kind", "schema").agg(F.lit(1)).select("kind", "schema", keys.parts(F.col("schema")).alias("k")).select("kind", "schema", "k.*")
    mine = resolve(without_skipped(mine, criteria), registry).persist()  # one row for each schema in use
    try:
        missing = mine.where("schema_json is null").select("schema")
        lacking = each.join(missing, "schema", "left_semi").groupBy("signature").agg(F.min("schema").alias("schema"))
        lacking_few = lacking.limit(FEW + 1)
        models = mine.where("model is not null").select("kind", "vendor", "name", "model")
        versions = registry.where("format = 'jsonschema'").select("vendor", "name", F.split("version", "-")[0].cast("int").alias("model"), "version", "schema_json")
        versions = versions.withColumn("schema", F.concat(F.lit("iglu:"), "vendor", F.lit("/"), "name", F.lit("/jsonschema/"), "version"))
        held = without_skipped(models.join(F.broadcast(versions) if is_small(registry) else versions, ["vendor", "name", "model"]), criteria).distinct()
        both = lacking_few.select("signature", "schema").unionByName(held.select("kind", "vendor", "name", "model", "version", "schema_json"), allowMissingColumns=True).collect()
    finally:
        mine.unpersist()
        if own is not None:
            own.unpersist()
    groups: dict[tuple, list[tuple[str, str]]] = {}
    few = [r for r in both if r["signature"] is not None]
    for r in both:
        if r["signature"] is not None:
            continue
        groups.setdefault((r["kind"], r["vendor"], r["name"], r["model"]), []).append((r["version"], r["schema_json"]))
    columns = [c for k in sorted(groups) for c in plan(*k, groups[k], nullable_everywhere)]
    if not few:
        return columns, Lookup(None)
    known = F.broadcast(local(spark, [(r["signature"],) for r in few], "signature array<string>")) if len(few) <= FEW else lacking.select("signature")
    return columns, Lookup(known, tuple(sorted({r["schema"] for r in few})[:20]))


def column_names(parsed: DataFrame) -> DataFrame:
    """Distinct names of the entity columns that a batch's entities belong to."""
    found = counts(parsed).where("model is not null").select("kind", "vendor", "name", "model").distinct()
    snake = lambda c: F.regexp_replace(F.lower(F.regexp_replace(c, "([a-z0-9])([A-Z])", "$1_$2")), "[^a-z0-9_]", "_")
    return found.select(F.concat_ws("_", "kind", snake("vendor"), snake("name"), "model").alias("column_name")).distinct()


__all__ = ["BROADCAST_BYTES", "Lookup", "MissingSchema", "column_names", "column_plan", "counts", "distinct_keys", "entities", "inventory", "missing", "normal", "resolve", "signature", "signatures", "with_parts", "without_skipped"]
