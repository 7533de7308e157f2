"""Stream sources. Every one gives a streaming DataFrame; ``value`` is text or bytes.

Kinesis and Pub/Sub style services come in through any Spark source of that name that is installed, or a
Python DataSource registered on the session: only name and options are needed here.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def stream(spark: SparkSession, kind: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """A source by format name and options."""
    return spark.readStream.format(kind).options(**dict(options or {})).load()


def kafka(spark: SparkSession, topic: str, servers: str, start: str = "latest", max_records: int | None = None, group: str = "siltworks", **consumer: str) -> DataFrame:
    """A Kafka topic. ``start``: ``earliest``, ``latest`` or a time in ms since 1970, on the first run only:
    later ones resume from the checkpoint. ``consumer`` options are passed on with the prefix ``kafka.``.
    """
    own = {"subscribe": topic, "kafka.bootstrap.servers": servers, "kafka.group.id": group, **{f"kafka.{k}": v for k, v in consumer.items()}}
    own |= {"startingOffsets": start} if start in ("earliest", "latest") else {"startingTimestamp": start, "startingOffsetsByTimestampStrategy": "latest"}
    if max_records is not None:
        own["maxOffsetsPerTrigger"] = str(max_records)
    return stream(spark, "kafka", own)


def files(spark: SparkSession, folder: str, max_files: int | None = None, max_bytes: str | None = None, modified_after: str | None = None) -> DataFrame:
    """Lines of the text files that appear in ``folder``, at most so many files or bytes a batch."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.text(folder)
