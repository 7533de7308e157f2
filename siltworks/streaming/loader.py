"""The loader: each micro-batch is one window, parsed, shredded and committed as one append.

Windows follow arrival: an event belongs to the batch in which it arrives, whatever its timestamps. The
checkpoint moves on only after a batch's failed events, its rows and its metrics are written; each of the
three replaces what an earlier try of the same batch has left, so a replay repeats nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.atomic import ATOMIC, good, parse_lines
from ..functions.local import local
from ..operators import bad_rows, entities, lake, layout, metrics, shred
from ..sources import requests


@dataclass
class Load:
    """What is loaded, and where to. ``skip``: schema criteria that get no column and are not looked up.

    ``exit_on_missing``: a schema that the registry lacks stops the load before anything is written;
    otherwise its events fail and all others load. ``bad_requests``: failed events go out in bounded requests (see
    sources.requests) instead of a table. After every ``compact_every`` commits the small files of the last day are
    compacted, beside the loading. ``clock`` says when a batch starts and is committed.
    """

    table: lake.LakeTable
    registry: DataFrame
    bad_location: str
    metrics_location: str
    fields: T.StructType = field(default_factory=lambda: ATOMIC)
    value_col: str = "value"
    source_ts_col: str | None = None
    skip: Sequence[str] = ()
    exit_on_missing: bool = False
    respect_nullability: bool = True
    max_bad_bytes: int = 1_000_000
    bad_requests: bool = False
    write_partitions: int | None = None
    compact_every: int | None = 4
    clock: Callable[[], datetime] = lambda: datetime.now(UTC)
    compaction: Future | None = None
    pool: ThreadPoolExecutor = field(default_factory=lambda: ThreadPoolExecutor(1))


def load_batch(batch: DataFrame, batch_id: int, load: Load) -> None:
    """Load one batch: failed events, then rows (if any), then a row of metrics.

    Three passes: one over the lines counts which schemas and event names are used together; one writes the
    failed events, and its counts come with the write; one writes the rows, which are sent to their files by the counts of
    the first. Latencies are the greatest of the batch, so they count from its earliest times.
    """
    spark, started = batch.sparkSession, load.clock()
    keep = (load.source_ts_col,) if load.source_ts_col else ()
    parsed = parse_lines(batch, load.fields, load.value_col, keep).persist(StorageLevel.MEMORY_AND_DISK)
    used = entities.signatures(good(parsed), "event_name").persist()
    judged = None
    try:
        columns, lookup = entities.column_plan(used, load.registry, load.skip, not load.respect_nullability)
        if lookup.absent and load.exit_on_missing:
            raise entities.MissingSchema(", ".join(lookup.absent))
        judged = shred.judged(parsed, columns, lookup).persist(StorageLevel.MEMORY_AND_DISK)
        seen = Observation()
        failed = judged.observe(seen, *metrics.batch_counts(load.source_ts_col)).where("kind is not null")
        records = bad_rows.records(failed, load.max_bad_bytes)
        if load.bad_requests:
            requests.send(records, load.bad_location, batch_id)
        else:
            records.select("kind", "record").write.mode("overwrite").json(f"{load.bad_location}/batch_id={batch_id}")
        m = seen.get
        parsed.unpersist()
        committed = m["received"] - m["bad"]
        if committed:
            parts = load.write_partitions or layout.write_partitions(m["bytes"])
            rows = shred.shredded(judged.drop(*keep), columns)  # by all tasks, before rows are sent to the few that write
            lake.append(layout.stamped(layout.laid_out(rows, parts, used, total=committed), started), load.table, batch_id)
        done = load.clock()
        ms = lambda a: None if a is None else int((done - a.astimezone(UTC)).total_seconds() * 1000)
        row = (batch_id, started, done if committed else None, m["received"], m["bad"], committed, m["bytes"], m["earliest"], ms(m["source"]), ms(started), ms(m["earliest"]) if committed else None)
        local(spark, [row], metrics.SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{load.metrics_location}/batch_id={batch_id}")
    finally:
        for held in (parsed, used, judged):
            if held is not None:
                held.unpersist()
    if load.compact_every and load.table.format != "hudi" and (batch_id + 1) % load.compact_every == 0:
        compact(load, spark, started, batch_id)


def compact(load: Load, spark: SparkSession, started: datetime, batch_id: int) -> None:
    """Compact the last day's committed batches while the next batch loads; an earlier compaction is waited for."""
    finished(load)
    load.compaction = load.pool.submit(lake.compact, spark, load.table, started.date() - timedelta(days=1), below_batch=batch_id + 1)


def finished(load: Load) -> None:
    """Wait for a compaction that is under way; its error is raised here."""
    if load.compaction is not None:
        load.compaction.result()
        load.compaction = None


def start(source: DataFrame, load: Load, checkpoint: str, interval: str | None = "5 minutes", name: str | None = None) -> StreamingQuery:
    """Create the table, then load ``source`` window by window; ``interval`` None: what is there, then stop.

    What arrives is observed as ``intake`` (see metrics.Watch), under the query's ``name``.
    """
    spark = source.sparkSession
    lake.create(spark, load.table)
    source = source.observe("intake", *metrics.intake(load.value_col))
    writer = source.writeStream if name is None else source.writeStream.queryName(name)
    writer = writer.option("checkpointLocation", checkpoint).foreachBatch(lambda df, i: load_batch(df, i, load))
    writer = writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)
    return writer.start()


def read_bad(spark: SparkSession, load: Load) -> DataFrame:
    """All failed events written so far: batch_id, kind, record."""
    return spark.read.schema("batch_id long, kind string, record string").option("basePath", load.bad_location).json(load.bad_location)


def read_metrics(spark: SparkSession, load: Load) -> DataFrame:
    """The metrics of all batches so far."""
    return spark.read.schema(metrics.SCHEMA).option("recursiveFileLookup", True).parquet(load.metrics_location)
