"""Schema keys (iglu:vendor/name/format/model-revision-addition) as column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY = r"^iglu:([A-Za-z0-9_.-]+)/([A-Za-z0-9_-]+)/([A-Za-z0-9_-]+)/([0-9]+)-([0-9]+)-([0-9]+)$"
PARTS = ("vendor", "name", "format", "model", "revision", "addition")


def parts(schema: Column) -> Column:
    """struct<vendor, name, format, model, revision, addition>; null where the text is no schema key."""
    taken = [F.regexp_extract(schema, KEY, i + 1) for i in range(6)]
    made = F.struct(*[(c.cast("int") if p in PARTS[3:] else c).alias(p) for p, c in zip(PARTS, [F.nullif(c, F.lit("")) for c in taken], strict=True)])
    return F.when(schema.rlike(KEY), made)


def version(key: Column) -> Column:
    """``model-revision-addition`` of a struct that parts() made."""
    return F.concat_ws("-", key["model"], key["revision"], key["addition"])


def criterion(text: str) -> tuple[str, ...]:
    """The six parts of a criterion like ``iglu:com.acme/name/jsonschema/1-*-*``; ``*`` stands for any value of a part."""
    found = re.fullmatch(r"iglu:([^/]+)/([^/]+)/([^/]+)/(\*|[0-9]+)-(\*|[0-9]+)-(\*|[0-9]+)", text)
    if not found:
        raise ValueError(f"not a schema criterion: {text}")
    return tuple(x if x == "*" or i < 3 else str(int(x)) for i, x in enumerate(found.groups()))


def mask(criterion: tuple[str, ...]) -> tuple[bool, ...]:
    """Which parts of a criterion are ``*``."""
    return tuple(x == "*" for x in criterion)


def form(parts: Sequence[str]) -> str:
    """A criterion, or a key some parts of which are masked, as one text."""
    return "/".join(parts)


def forms(schema: Column, masks: Sequence[tuple[bool, ...]]) -> Column:
    """Array of the forms that a schema key takes under each of the masks; null where the text is no schema key.

    A key meets a criterion if its form under the criterion's mask is the criterion: one lookup for each mask that
    occurs (8 with the version alone, 64 at most), however many criteria there are.
    """
    key = parts(schema)
    each = [F.concat_ws("/", *[F.lit("*") if hidden else key[p].cast("string") for p, hidden in zip(PARTS, m, strict=True)]) for m in masks]
    return F.when(key.isNotNull(), F.array(*each))
