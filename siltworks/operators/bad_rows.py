"""Failed events: one JSON record each, of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROCESSOR = ("siltworks", "0.1.0")


def records(bad: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """(kind, record): a JSON record for each failure (kind, failure, payload).

    A record of more than ``max_bytes`` bytes becomes one of kind ``size`` with the first tenth of that
    many characters of its payload.
    """
    processor = F.struct(F.lit(PROCESSOR[0]).alias("artifact"), F.lit(PROCESSOR[1]).alias("version")).alias("processor")
    record = lambda kind, failure, payload: F.to_json(F.struct(processor, F.struct(kind.alias("kind"), failure.alias("message")).alias("failure"), payload.alias("payload")))
    made = bad.select("kind", "payload", record(F.col("kind"), F.col("failure"), F.col("payload")).alias("record"))
    if max_bytes is None:
        return made.select("kind", "record")
    large = F.octet_length("record") > max_bytes
    short = record(F.lit("size"), F.concat(F.lit("record of "), F.octet_length("record").cast("string"), F.lit(" bytes")), F.left("payload", F.lit(max_bytes // 10)))
    return made.select(F.when(large, "size").otherwise(F.col("kind")).alias("kind"), F.when(large, short).otherwise(F.col("record")).alias("record"))
