"""From JSON Schemas to column types: reading, merging versions, and recovery columns.

Works on the driver, on one schema document per version in the registry, never on events.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALARS = {"string": "STRING", "boolean": "BOOLEAN", "int": "INT", "integer": "BIGINT", "number": "DOUBLE", "date": "DATE", "timestamp": "TIMESTAMP", "json": "STRING"}


@dataclass(frozen=True)
class Type:
    """kind: a key of SCALARS, ``decimal``, ``struct`` (with fields) or ``array`` (with element)."""

    kind: str
    fields: tuple[Field, ...] = ()
    element: Type | None = None
    element_nullable: bool = True
    precision: int = 0
    scale: int = 0


@dataclass(frozen=True)
class Field:
    """A property: its name in the JSON, its type, and whether it may be absent or null."""

    name: str
    type: Type
    nullable: bool = True


def normal(name: str) -> str:
    """Column name of a property, vendor or schema name: snake case, anything unusual an underscore."""
    snake = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    return re.sub(r"[^a-z0-9_]", "_", snake.lower())


def read(schema: dict, nullable_everywhere: bool = False) -> Type | None:
    """The type of a JSON Schema; None for an object that can hold nothing (no column at all)."""
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else list(kinds or [])
    kinds = [k for k in kinds if k != "null"]
    if not kinds and "properties" in schema:
        kinds = ["object"]
    if len(kinds) != 1:
        return Type("number") if sorted(kinds) == ["integer", "number"] else Type("json")
    kind = kinds[0]
    if kind == "string":
        return Type({"date": "date", "date-time": "timestamp"}.get(schema.get("format", ""), "string"))
    if kind == "number":
        step, top = schema.get("multipleOf"), schema.get("maximum")
        if step and top is not None and re.fullmatch(r"0\.0*1|1", str(step)):
            scale = len(str(step).partition(".")[2])
            digits = len(str(int(max(abs(top), abs(schema.get("minimum", 0))))))
            if digits + scale <= 38:
                return Type("decimal", precision=digits + scale, scale=scale)
        return Type("number")
    if kind == "integer":
        low, high = schema.get("minimum"), schema.get("maximum")
        return Type("int" if low is not None and high is not None and -(2**31) <= low and high < 2**31 else "integer")
    if kind == "boolean":
        return Type(kind)
    if kind == "array":
        items = schema.get("items")
        element = read(items, nullable_everywhere) if isinstance(items, dict) else Type("json")
        may_be_null = nullable_everywhere or not isinstance(items, dict) or _may_be_null(items)
        return Type("array", element=element or Type("json"), element_nullable=may_be_null)
    if kind == "object":
        properties = schema.get("properties") or {}
        if not properties:
            return None if schema.get("additionalProperties") is False else Type("json")
        required = set(schema.get("required") or [])
        fields = [Field(k, t, nullable_everywhere or k not in required or _may_be_null(v)) for k, v in properties.items() if (t := read(v, nullable_everywhere))]
        return Type("struct", tuple(sorted(fields, key=lambda f: (f.nullable, f.name)))) if fields else Type("json")
    return Type("json")


def _may_be_null(schema: dict) -> bool:
    kinds = schema.get("type")
    return "null" in ([kinds] if isinstance(kinds, str) else kinds or ["null"]) or None in schema.get("enum", [])


def merge(old: Type, new: Type) -> Type | None:
    """One type for both, or None where a value of one cannot be a value of the other.

    Fields may be added (after the known ones, and nullable); a field is required only if it is in both.
    """
    if {old.kind, new.kind} == {"int", "integer"}:
        return Type("integer")
    if old.kind != new.kind:
        return None
    if old.kind == "struct":
        out, theirs = [], {f.name: f for f in new.fields}
        for f in old.fields:
            other = theirs.pop(f.name, None)
            t = merge(f.type, other.type) if other else f.type
            if t is None:
                return None
            out.append(Field(f.name, t, f.nullable or other is None or other.nullable))
        return replace(old, fields=(*out, *(replace(f, nullable=True) for f in new.fields if f.name in theirs)))
    if old.kind == "array":
        t = merge(old.element, new.element)
        return t and replace(old, element=t, element_nullable=old.element_nullable or new.element_nullable)
    if old.kind == "decimal":
        scale = max(old.scale, new.scale)
        precision = max(old.precision - old.scale, new.precision - new.scale) + scale
        return replace(old, precision=precision, scale=scale) if precision <= 38 else None
    return old


def ddl(t: Type, normalised: bool = False) -> str:
    """The Spark type; with property names as in the JSON, or normalised as in the table."""
    if t.kind == "struct":
        inner = ", ".join(f"`{(normal(f.name) if normalised else f.name).replace('`', '``')}`: {ddl(f.type, normalised)}" for f in t.fields)
        return f"STRUCT<{inner}>"
    if t.kind == "array":
        return f"ARRAY<{ddl(t.element, normalised)}>"
    if t.kind == "decimal":
        return f"DECIMAL({t.precision},{t.scale})"
    return SCALARS[t.kind]


def typed(data: Column, t: Type) -> Column:
    """JSON text as a value of ``t``, with normalised names."""
    if t.kind == "json":
        return data
    wide = F.from_json(data, ddl(t)) if t.kind in ("struct", "array") else F.from_json(F.concat(F.lit('{"v":'), data, F.lit("}")), f"v {ddl(t)}")["v"]
    return wide.cast(ddl(t, True))


def has_text(t: Type) -> bool:
    """Whether a type holds free JSON somewhere inside, whose text must stay as it is."""
    return t.kind == "json" or any(has_text(f.type) for f in t.fields) or (t.element is not None and has_text(t.element))


def taken(v: Column, data: Column, t: Type) -> Column:
    """The value of ``t`` from the variant that was checked, with normalised names.

    A variant keeps no order of keys, so types with free JSON inside are read from the text.
    """
    if has_text(t):
        return typed(data, t)
    return F.try_variant_get(v, "$", ddl(t)).cast(ddl(t, True))


def bound(value: Column, test: Callable[[Column], Column]) -> Column:
    """``test`` of a value that is evaluated once, however often the test uses it."""
    return F.forall(F.array(value), lambda v: F.coalesce(test(v), F.lit(False)))


def fits(v: Column, t: Type) -> Column:
    """Whether a variant is a value of ``t`` without any conversion; false for null."""
    found = F.schema_of_variant(v)
    if t.kind == "json":
        return F.lit(True)
    if t.kind == "string":
        return found == "STRING"
    if t.kind == "boolean":
        return found == "BOOLEAN"
    if t.kind == "integer":
        return found == "BIGINT"
    if t.kind == "int":
        return (found == "BIGINT") & F.try_variant_get(v, "$", "int").isNotNull()
    if t.kind in ("number", "decimal"):
        is_number = found.rlike(r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$")
        return is_number if t.kind == "number" else is_number & F.try_variant_get(v, "$", ddl(t)).isNotNull()
    if t.kind in ("date", "timestamp"):
        return (found == "STRING") & F.try_variant_get(v, "$", "string").try_cast(SCALARS[t.kind]).isNotNull()
    if t.kind == "array":
        each = F.try_variant_get(v, "$", "array<variant>")
        null = lambda e: e.isNull() | (F.schema_of_variant(e) == "VOID")
        return found.startswith("ARRAY") & F.forall(each, lambda e: F.coalesce(F.when(null(e), F.lit(t.element_nullable)).otherwise(fits(e, t.element)), F.lit(False)))
    checks = found.startswith("OBJECT")
    for f in t.fields:
        quoted = f.name.replace("\\", "\\\\").replace("'", "\\'")
        inner = F.try_variant_get(v, f"$['{quoted}']", "variant")
        checks = checks & bound(inner, lambda x, f=f: F.when(x.isNull() | (F.schema_of_variant(x) == "VOID"), F.lit(f.nullable)).otherwise(fits(x, f.type)))
    return F.coalesce(checks, F.lit(False))


@dataclass
class EntityColumn:
    """A column of the table: one model of one entity, or the recovery of one version."""

    kind: str
    vendor: str
    name: str
    model: int
    column: str
    type: Type
    versions: list[str] = field(default_factory=list)


def plan(kind: str, vendor: str, name: str, model: int, versions: Iterable[tuple[str, str]], nullable_everywhere: bool = False) -> list[EntityColumn]:
    """Columns of one model from all its versions in the registry (version, schema_json), in order.

    The first version shapes the column. A later one is merged into it, or, where a type breaks, gets a
    recovery column of its own: the plan depends on the registry only, never on what a batch happens to
    hold, so a column has one type for ever. Versions that can hold nothing have no column.
    """
    base = f"{kind}_{normal(vendor)}_{normal(name)}_{model}"
    main: EntityColumn | None = None
    out: list[EntityColumn] = []
    for version, text in sorted(versions, key=lambda v: tuple(map(int, v[0].split("-")))):
        t = read(json.loads(text), nullable_everywhere)
        if t is None:
            continue
        if main is None:
            main = EntityColumn(kind, vendor, name, model, base, t, [version])
            out.append(main)
        elif (both := merge(main.type, t)) is not None:
            main.type = both
            main.versions.append(version)
        else:
            mark = hashlib.sha256(ddl(t).encode()).hexdigest()[:8]
            out.append(EntityColumn(kind, vendor, name, model, f"{base}_recovered_{version.replace('-', '_')}_{mark}", t, [version]))
    return out
