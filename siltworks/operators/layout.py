"""Union of evolving batches, and the layout of files before a write."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.local import local

#: Target size of a file, for the default number of write partitions.
TARGET_BYTES = 256 << 20


def union_evolving(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns and nested fields that a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stamped(df: DataFrame, at: datetime) -> DataFrame:
    """With ``load_tstamp``, one literal for the whole batch, and its date.

    A literal, since current_timestamp() would differ between two writes of one batch.
    """
    stamp = F.lit(at).cast("timestamp")
    return df.withColumns({"load_tstamp": stamp, "load_tstamp_date": stamp.cast("date")})


def write_partitions(total_bytes: int, target: int = TARGET_BYTES) -> int:
    """How many files to aim at for so many bytes."""
    return max(1, -(-total_bytes // target))


def cut_points(counts: DataFrame, parts: int, name: str = "event_name", n: str = "n", total: int | None = None) -> list[tuple]:
    """(name, bucket, n, before, total): where each name's rows lie when all rows are put in a line, by name.

    ``counts`` has rows (name, n), several of a name if need be. A name of more than half a part has a row of its own; the
    others share 64 buckets a part, by their hash (name is None there). So there are 66 rows a part at most.
    ``total``, where it is known, saves a job. ``counts`` are computed once.
    """
    sums = counts.groupBy(F.col(name).alias("name")).agg(F.sum(n).alias("n"))
    held = None if total else sums.persist()  # one row for each name
    try:
        total = total or sums.agg(F.sum("n")).first()[0] or 0
        own = F.when(F.col("n") * 2 * parts > total, F.col("name"))
        bucket = F.when(own.isNull(), F.pmod(F.xxhash64("name"), F.lit(64 * parts)))
        rows = sums.groupBy(own.alias("name"), bucket.alias("bucket")).agg(F.sum("n").alias("n")).collect()
    finally:
        if held is not None:
            held.unpersist()
    out, before, total = [], 0, sum(r["n"] for r in rows)
    for r in sorted(rows, key=lambda r: (r["name"] is None, r["name"] or "", r["bucket"] or 0)):
        out.append((r["name"], r["bucket"], r["n"], before, total))
        before += r["n"]
    return out


def laid_out(df: DataFrame, parts: int, counts: DataFrame | None = None, sort: bool = True, name: str = "event_name", spread: str = "event_id", total: int | None = None) -> DataFrame:
    """In ``parts`` balanced parts, sorted by ``name`` in each: similar names share parts, one with most rows has several.

    ``counts`` (name, n) come from an earlier pass over the same rows, so rows are sent straight to their part: no job
    samples or sorts them first. Within its name a row lies by the hash of ``spread``. Counts that are not exact
    move the cuts a little and lose nothing. Without counts they are taken from ``df``. ``total`` is about how many rows there
    are, if that is known. One part: what comes before is still worked on by all tasks, and only ``df``'s columns are sent.
    """
    if parts == 1:
        out = df.repartition(1)
    else:
        if counts is None:
            counts = df.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
        spark = df.sparkSession
        line = local(spark, cut_points(counts, parts, name, total=total), "name string, bucket long, n long, before long, total long")  # 66 rows a part at most
        heavy = F.broadcast(line.where("name is not null").select(F.col("name").alias("_name"), F.struct("before", "n", "total").alias("_own")))
        light = F.broadcast(line.where("name is null").select(F.col("bucket").alias("_bucket"), F.struct("before", "n", "total").alias("_shared")))
        placed = df.join(heavy, F.col(name) == F.col("_name"), "left").join(light, F.pmod(F.xxhash64(name), F.lit(64 * parts)) == F.col("_bucket"), "left")
        at, u = F.coalesce("_own", "_shared"), F.pmod(F.xxhash64(spread), F.lit(1 << 20)) / F.lit(1 << 20)
        part = F.least(F.floor((at["before"] + u * at["n"]) * parts / at["total"]), F.lit(parts - 1)).cast("int")
        out = placed.withColumn("_part", F.coalesce(part, F.lit(0))).repartitionById(parts, "_part").select(*df.columns)
    return out.sortWithinPartitions(name) if sort else out


def part_sizes(df: DataFrame) -> DataFrame:
    """(part, n_rows) of a laid-out frame."""
    return df.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n_rows"))
