"""Counts and latencies of each window, reports over them, and freshness."""

from __future__ import annotations

import time
from collections import defaultdict, deque

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SCHEMA = "batch_id long, window_start timestamp, committed_at timestamp, received long, bad long, committed long, bytes long, earliest_collector_tstamp timestamp, stream_latency_ms long, processing_latency_ms long, e2e_latency_ms long"


def window_start(ts, seconds: int):
    """Start of the tumbling window of ``seconds`` that holds a time; null stays null."""
    return F.timestamp_seconds(F.floor(F.unix_micros(ts) / F.lit(seconds * 1_000_000)) * seconds)


def window_counts(parsed: DataFrame, seconds: int, ts_col: str = "collector_tstamp") -> DataFrame:
    """Per tumbling window of ``ts_col``: received, bad, payload bytes and earliest collector time.

    One aggregate, combined before its shuffle. Rows without a time (unparsable lines) fall in the null window.
    """
    bad = F.size("errors") > 0
    return parsed.groupBy(window_start(F.col(ts_col), seconds).alias("window_start")).agg(
        F.count(F.lit(1)).alias("received"), F.count_if(bad).alias("bad"), F.coalesce(F.sum("payload_bytes"), F.lit(0)).alias("bytes"), F.min(F.when(~bad, F.col(ts_col))).alias("earliest_collector_tstamp")
    )


def batch_counts(source_ts_col: str | None = None) -> list[Column]:
    """Aggregates over judged rows, to be observed while they are written: received, bad, bytes, earliest, source."""
    parsed = F.coalesce(F.col("kind") != "parsing", F.lit(True))
    source = F.min(source_ts_col) if source_ts_col else F.min(F.lit(None).cast("timestamp"))
    return [
        F.count(F.lit(1)).alias("received"),
        F.count_if(F.col("kind").isNotNull()).alias("bad"),
        F.coalesce(F.sum("payload_bytes"), F.lit(0)).cast("long").alias("bytes"),
        F.min(F.when(parsed, F.col("collector_tstamp"))).alias("earliest"),
        source.alias("source"),
    ]


def intake(value_col: str) -> list[Column]:
    """Aggregates over a source's rows as they arrive."""
    return [F.count(F.lit(1)).alias("received"), F.coalesce(F.sum(F.octet_length(value_col)), F.lit(0)).cast("long").alias("bytes")]


class Watch(StreamingQueryListener):
    """Progress of loading queries, as Spark reports it: (batch_id, received, bytes, seconds) of the last batches of each.

    ``stalled`` tells which of them have not finished a batch for so long, or have ended with an error.
    """

    def __init__(self, keep: int = 1000):
        self.batches: dict[str, deque] = defaultdict(lambda: deque(maxlen=keep))
        self.last: dict[str, float] = {}
        self.failed: dict[str, str] = {}
        self.names: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        self.names[str(event.id)] = event.name or str(event.id)
        self.last[self.names[str(event.id)]] = time.time()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        name = p.name or str(p.id)
        self.last[name] = time.time()
        if (seen := p.observedMetrics.get("intake")) is not None:
            self.batches[name].append((p.batchId, seen["received"], seen["bytes"], p.durationMs.get("triggerExecution", 0) / 1000))

    def onQueryIdle(self, event) -> None:
        self.last[self.names.get(str(event.id), str(event.id))] = time.time()

    def onQueryTerminated(self, event) -> None:
        name = self.names.get(str(event.id), str(event.id))
        self.last.pop(name, None)
        if event.exception:
            self.failed[name] = event.exception

    def stalled(self, seconds: float) -> list[str]:
        now = time.time()
        return sorted({n for n, t in self.last.items() if now - t > seconds} | set(self.failed))


def milliseconds(later, earlier):
    """Between two timestamps, in whole milliseconds."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1000)


def report(metrics: DataFrame, seconds: int) -> DataFrame:
    """Counts summed and latencies at their highest, for each period of the commit time."""
    return metrics.groupBy(window_start(F.col("committed_at"), seconds).alias("period_start")).agg(
        F.sum("received").alias("received"), F.sum("bad").alias("bad"), F.sum("committed").alias("committed"), F.max("stream_latency_ms").alias("stream_latency_ms"), F.max("processing_latency_ms").alias("processing_latency_ms"), F.max("e2e_latency_ms").alias("e2e_latency_ms")
    )


def unhealthy(metrics: DataFrame, limit_ms: int) -> DataFrame:
    """Windows in which an event waited longer than ``limit_ms`` for its commit."""
    return metrics.where(F.col("e2e_latency_ms") > limit_ms)


def running_report(spark: SparkSession, metrics_location: str, to: str, checkpoint: str, seconds: int, late: str = "0 seconds", interval: str | None = None) -> StreamingQuery:
    """Append each period's report to ``to`` once, when it is closed: a batch committed ``late`` after its end is there.

    A streaming aggregation over the loader's metrics as they appear; its state goes on after a restart. Batches that
    committed nothing have no commit time and count in no period.
    """
    # the folders of batches appear one after another; committed_at is the event time
    rows = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).parquet(metrics_location)
    closed = rows.where("committed_at is not null").withWatermark("committed_at", late).groupBy(F.window("committed_at", f"{seconds} seconds").alias("w"))
    out = closed.agg(F.sum("received").alias("received"), F.sum("bad").alias("bad"), F.sum("committed").alias("committed"), F.max("stream_latency_ms").alias("stream_latency_ms"), F.max("processing_latency_ms").alias("processing_latency_ms"), F.max("e2e_latency_ms").alias("e2e_latency_ms"))
    writer = out.select(F.col("w.start").alias("period_start"), *[c for c in out.columns if c != "w"]).writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)).start(to)
