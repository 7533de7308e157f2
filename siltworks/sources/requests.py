"""Failed events to a stream service: records in requests of bounded number and bytes, each batch sent once.

A Python data source for streams and batches. Tasks form requests and put them down as files; a batch counts by one
list of its requests, which the driver writes in one step. A batch that is tried again keeps the list it has: what the
second try has put down is taken away, so nothing is sent twice and nothing is lost.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

from . import stores

#: Bounds of one request.
MAX_RECORDS, MAX_BYTES = 500, 5_242_880


def requests(records: Iterator[str], most: int = MAX_RECORDS, most_bytes: int = MAX_BYTES) -> Iterator[list[str]]:
    """Records in order, in lists of at most so many of them and bytes. One record that is larger is an error."""
    out, size = [], 0
    for r in records:
        n = len(r.encode())
        if n > most_bytes:
            raise ValueError(f"a record of {n} bytes is larger than a request")
        if out and (len(out) == most or size + n > most_bytes):
            yield out
            out, size = [], 0
        out.append(r)
        size += n
    if out:
        yield out


@dataclass
class Put(WriterCommitMessage):
    """What a task has put down: (file, records, bytes) of each request."""

    files: list[tuple[str, int, int]]


class Requests:
    """What the writers of a stream and of a batch share."""

    def __init__(self, options: dict[str, str]):
        self.folder = options["path"]
        self.most = int(options.get("max_records", MAX_RECORDS))
        self.most_bytes = int(options.get("max_bytes", MAX_BYTES))
        self.batch = int(options.get("batch_id", 0))

    def put(self, rows: Iterator) -> Put:
        files = []
        for request in requests((r[0] for r in rows if r[0] is not None), self.most, self.most_bytes):
            name = f"{uuid.uuid4().hex}.json"
            stores.write_text(f"{self.folder}/requests/{name}", "\n".join(json.dumps({"record": r}, ensure_ascii=False) for r in request))
            files.append((name, len(request), sum(len(r.encode()) for r in request)))
        return Put(files)

    def send(self, messages: list[Put | None], batch: int) -> None:
        listed = f"{self.folder}/batches/{batch:012d}.json"
        files = [f for m in messages if m for f in m.files]
        if stores.exists(listed):
            self.drop(messages)
        else:
            stores.write_text(listed, "\n".join(json.dumps({"batch_id": batch, "file": f, "records": n, "bytes": b}) for f, n, b in files))

    def drop(self, messages: list[Put | None]) -> None:
        for m in messages:
            for f, _, _ in m.files if m else ():
                stores.remove(f"{self.folder}/requests/{f}")


class StreamRequests(DataSourceStreamWriter):
    def __init__(self, options: dict[str, str]):
        self.of = Requests(options)

    def write(self, iterator: Iterator) -> Put:
        return self.of.put(iterator)

    def commit(self, messages: list, batchId: int) -> None:
        self.of.send(messages, batchId)

    def abort(self, messages: list, batchId: int) -> None:
        self.of.drop(messages)


class BatchRequests(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.of = Requests(options)

    def write(self, iterator: Iterator) -> Put:
        return self.of.put(iterator)

    def commit(self, messages: list) -> None:
        self.of.send(messages, self.of.batch)

    def abort(self, messages: list) -> None:
        self.of.drop(messages)


class RequestSink(DataSource):
    """Takes one text column. Options: ``path``, ``max_records``, ``max_bytes``; for a batch its ``batch_id``."""

    @classmethod
    def name(cls) -> str:
        return "siltworks_requests"

    def schema(self) -> str:
        return "record string"

    def writer(self, schema, overwrite: bool) -> BatchRequests:
        return BatchRequests(dict(self.options))

    def streamWriter(self, schema, overwrite: bool) -> StreamRequests:
        return StreamRequests(dict(self.options))


def send(records: DataFrame, folder: str, batch_id: int, **bounds: int) -> None:
    """The column ``record`` as requests of one batch; again: nothing."""
    records.sparkSession.dataSource.register(RequestSink)
    options = {"path": folder, "batch_id": str(batch_id)} | {k: str(v) for k, v in bounds.items()}
    records.select("record").write.format(RequestSink.name()).mode("append").options(**options).save()


def start(records: DataFrame, folder: str, checkpoint: str, interval: str | None = "1 minute", **bounds: int):
    """A streaming query that sends ``record`` of a stream; ``interval`` None: what is there, then stop."""
    records.sparkSession.dataSource.register(RequestSink)
    options = {"path": folder} | {k: str(v) for k, v in bounds.items()}
    writer = records.select("record").writeStream.format(RequestSink.name()).options(**options).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)).start()


def sent(spark: SparkSession, folder: str) -> DataFrame:
    """(batch_id, file, records, bytes) of all requests that count."""
    return spark.read.schema("batch_id long, file string, records long, bytes long").json(f"{folder}/batches")


def sent_records(spark: SparkSession, folder: str) -> DataFrame:
    """(batch_id, record) of all requests that count."""
    from pyspark.sql import functions as F

    held = spark.read.schema("record string").json(f"{folder}/requests").withColumn("file", F.element_at(F.split("_metadata.file_path", "/"), -1))
    return held.join(sent(spark, folder).select("batch_id", "file"), "file").select("batch_id", "record")
