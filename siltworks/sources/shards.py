"""A sharded log as a stream source: records in order within each shard, read from a position or from a time on.

A log is a folder of appends; an append holds, for each shard, segments (Parquet files) in order of arrival, and counts
once it is finished. The position of a record is its number within its shard, over all segments. Footers of segments
tell how many records and which times each row group holds: they are the index by which a time is found.

The source is a Python data source: Spark keeps the offsets ({shard: position}) in its checkpoint, plans one partition for
each row group, and tasks read Arrow batches.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from . import stores

SCHEMA = "shard string, position long, arrived timestamp, value binary"
SEGMENT_BYTES = 4 << 20


def append(rows: DataFrame, folder: str, key: Column, arrived: Column, value: Column, shards: int, number: int) -> None:
    """Append records to a log as its append ``number``: by hash of ``key`` to a shard, in it by time of arrival.

    Times within a shard should not go back from one append to the next (a start by time then finds no record earlier than
    the first that is late enough). No time counts as 1970. An append that is written again replaces itself.
    """
    shard = F.lpad(F.pmod(F.xxhash64(key), F.lit(shards)).cast("string"), 5, "0")
    own = rows.select(shard.alias("shard"), F.coalesce(F.unix_micros(arrived.cast("timestamp")), F.lit(0)).alias("arrived"), value.cast("binary").alias("value"))
    n = max(shards, rows.sparkSession.sparkContext.defaultParallelism)
    ranged = own.repartitionByRange(n, "shard", "arrived").sortWithinPartitions("shard", "arrived")
    # part files of one shard are named in the order of the ranges
    ranged.write.mode("overwrite").option("parquet.block.size", SEGMENT_BYTES).partitionBy("shard").parquet(f"{folder}/append={number:08d}")


@dataclass(frozen=True)
class Group:
    """A row group of a segment: where it is, its first position, how many records; its least time and the greatest so far (µs)."""

    path: str
    group: int
    first: int
    n: int
    earliest: int
    latest: int


@dataclass
class Span(InputPartition):
    """Records of one row group: ``skip`` are left out, ``take`` are read."""

    shard: str
    path: str
    group: int
    first: int
    skip: int
    take: int


def _micros(t: datetime) -> int:
    t = t if t.tzinfo else t.replace(tzinfo=UTC)
    return (t - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1)


class Index:
    """Row groups of each shard, in order. Footers are read once; finished appends never change."""

    def __init__(self, folder: str):
        self.folder = folder
        self.known: set[str] = set()
        self.groups: dict[str, list[Group]] = {}

    def refresh(self) -> None:
        for name in stores.names(self.folder):
            if not name.startswith("append=") or name in self.known or not stores.exists(f"{self.folder}/{name}/_SUCCESS"):
                continue
            self.known.add(name)
            for shard in stores.names(f"{self.folder}/{name}"):
                if shard.startswith("shard="):
                    own = self.groups.setdefault(shard.removeprefix("shard="), [])
                    for part in stores.names(f"{self.folder}/{name}/{shard}"):
                        if part.endswith(".parquet"):
                            self._add(own, f"{self.folder}/{name}/{shard}/{part}")

    @staticmethod
    def _add(own: list[Group], location: str) -> None:
        fs, path = stores.opened(location)
        with fs.open_input_file(path) as f:
            footer = pq.ParquetFile(f).metadata
            at = footer.schema.to_arrow_schema().get_field_index("arrived")
            for g in range(footer.num_row_groups):
                part = footer.row_group(g)
                times = part.column(at).statistics
                if part.num_rows:
                    first, latest = (own[-1].first + own[-1].n, own[-1].latest) if own else (0, times.max)
                    own.append(Group(location, g, first, part.num_rows, times.min, max(times.max, latest)))

    def head(self) -> dict[str, int]:
        return {s: g[-1].first + g[-1].n for s, g in self.groups.items() if g}

    def at_time(self, time: datetime) -> dict[str, int]:
        """Position of the first record of each shard that arrived at ``time`` or later.

        The row group is found by bisection over the index; only that one is read.
        """
        out, when = {}, _micros(time)
        for shard, groups in self.groups.items():
            k = bisect_left([g.latest for g in groups], when)
            if k == len(groups):
                out[shard] = groups[-1].first + groups[-1].n
            elif groups[k].earliest >= when:
                out[shard] = groups[k].first
            else:
                fs, path = stores.opened(groups[k].path)
                with fs.open_input_file(path) as f:
                    times = pq.ParquetFile(f).read_row_group(groups[k].group, columns=["arrived"])["arrived"].to_pylist()
                out[shard] = groups[k].first + bisect_left(times, when)
        return out


class ShardReader(DataSourceStreamReader):
    """Offsets are {shard: next position}. A shard that appears later is read from its start."""

    def __init__(self, options: dict[str, str]):
        self.index = Index(options["path"])
        self.start = options.get("start", "earliest")
        self.most = int(options["max_records"]) if "max_records" in options else None
        self.checkpoint = options.get("checkpoint")
        self.issued: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        self.index.refresh()
        if self.start == "earliest":
            out = dict.fromkeys(self.index.groups, 0)
        elif self.start == "latest":
            out = self.index.head()
        else:
            out = self.index.at_time(datetime.fromisoformat(self.start))
        if self.issued is None:
            self.issued = dict(out)
        return out

    def _resumed(self) -> dict[str, int] | None:
        """The last offsets that Spark has written down, from which a restarted query goes on."""
        logged = [n for n in stores.names(f"{self.checkpoint}/offsets") if n.isdigit()] if self.checkpoint else []
        if not logged:
            return None
        return json.loads(stores.read_text(f"{self.checkpoint}/offsets/{max(logged, key=int)}").splitlines()[-1])

    def latestOffset(self) -> dict:
        """The head of each shard, or, with ``max_records``, so many records further than the offsets issued before.

        Each shard gets its even part of the limit, and what others leave of theirs.
        """
        self.index.refresh()
        head = self.index.head()
        if self.issued is None and self.checkpoint:  # Spark may ask for the latest offset before the first
            self.issued = self._resumed() or self.initialOffset()
        if self.most is None or self.issued is None:
            self.issued = head
            return head
        waiting = {s: n - self.issued.get(s, 0) for s, n in head.items()}
        left, out = self.most, {}
        for k, s in enumerate(sorted(waiting, key=lambda s: (waiting[s], s))):
            take = min(waiting[s], -(-left // (len(waiting) - k)))
            out[s] = self.issued.get(s, 0) + take
            left -= take
        self.issued = out
        return dict(out)

    def partitions(self, start: dict, end: dict) -> list[Span]:
        self.index.refresh()
        out = []
        for shard, groups in self.index.groups.items():
            a, z = start.get(shard, 0), end.get(shard, 0)
            for g in groups:
                lo, hi = max(a, g.first), min(z, g.first + g.n)
                if lo < hi:
                    out.append(Span(shard, g.path, g.group, lo, lo - g.first, hi - lo))
        return out

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        fs, path = stores.opened(partition.path)
        with fs.open_input_file(path) as f:
            at, skip, left = partition.first, partition.skip, partition.take
            for batch in pq.ParquetFile(f).iter_batches(1024, row_groups=[partition.group], columns=["arrived", "value"]):
                if skip >= len(batch):
                    skip -= len(batch)
                    continue
                part = batch.slice(skip, left)
                skip = 0
                n, left = len(part), left - len(part)
                stamp = part["arrived"].cast(pa.timestamp("us", "UTC"))
                yield pa.RecordBatch.from_arrays([pa.array([partition.shard] * n), pa.array(range(at, at + n), pa.int64()), stamp, part["value"].cast(pa.binary())], ["shard", "position", "arrived", "value"])
                at += n
                if not left:
                    return


class ShardSource(DataSource):
    """Options: ``path``; ``start`` (earliest, latest, or an ISO time: where a query begins that has no checkpoint yet);
    ``max_records`` of a batch, and with it ``checkpoint``, so that the limit holds for the first batch after a restart too.
    """

    @classmethod
    def name(cls) -> str:
        return "siltworks_shards"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> ShardReader:
        return ShardReader(dict(self.options))


def stream(spark: SparkSession, folder: str, start: str = "earliest", max_records: int | None = None, checkpoint: str | None = None) -> DataFrame:
    """(shard, position, arrived, value) of a log as a stream."""
    spark.dataSource.register(ShardSource)
    options = {"path": folder, "start": start} | ({"max_records": str(max_records)} if max_records else {}) | ({"checkpoint": checkpoint} if checkpoint else {})
    return spark.readStream.format(ShardSource.name()).options(**options).load()
