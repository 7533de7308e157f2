"""Lake tables: create, append, read back, compact.

``parquet`` is complete. Each load date has one small list of its files, with their batches, sizes and bounds of times; a
batch that is written again, and files that are merged, are replaced by the next list, in one step. Readers and
compaction look at the lists of the dates they need, whatever the table's history. The columns of all batches are kept
beside them, so that a reader opens no footers to learn them. Delta, Iceberg and Hudi go through
their own Spark writers, whose jars must be on the session's class path; those paths are thin and have not been run
where the jars are absent.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import UTC, date, datetime, timedelta
from functools import partial
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.local import local

STATS_COLUMNS = ("load_tstamp", "collector_tstamp", "derived_tstamp", "dvce_created_tstamp", "true_tstamp")
PARTITIONS = ("load_tstamp_date", "event_name")


@dataclass(frozen=True)
class LakeTable:
    """Where a table is and how it is written. ``location``: a path, or a table name for catalogs."""

    location: str
    format: str = "parquet"
    schema: T.StructType | None = None
    options: dict[str, str] = field(default_factory=dict)
    properties: dict[str, str] = field(default_factory=dict)
    attempts: int = 5


def _path(spark: SparkSession, location: str):
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds the values of both: fields of either, the wider integer or decimal; ValueError where there is none."""
    if a == b:
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        theirs = {f.name: f.dataType for f in b}
        fields = [T.StructField(f.name, wider(f.dataType, theirs[f.name]) if f.name in theirs else f.dataType) for f in a]
        return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in b if f.name not in a.fieldNames()])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType))
    if {type(a), type(b)} == {T.IntegerType, T.LongType}:
        return T.LongType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        return T.DecimalType(min(38, max(a.precision - a.scale, b.precision - b.scale) + scale), scale)
    raise ValueError(f"{a.simpleString()} and {b.simpleString()} in one column")


def _listed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that exist, by a pattern; the driver lists folders, never rows."""
    fs, path = _path(spark, pattern)
    return sorted(x.getPath().toString() for x in fs.globStatus(path) or [])


def _number(path: str, name: str) -> int:
    return int(path.split(f"/{name}=")[-1].split("/")[0])


def _text(spark: SparkSession, location: str) -> str:
    fs, path = _path(spark, location)
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _put(spark: SparkSession, location: str, text: str) -> bool:
    """A small new file, ended by a line that says so; False if there is one of that name."""
    fs, path = _path(spark, location)
    try:
        stream = fs.create(path, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception):
            return False
        raise
    stream.write(f"{text}\nend\n".encode())
    stream.close()
    return True


def _newest(spark: SparkSession, folder: str) -> tuple[int, list[str] | None]:
    """(greatest number, lines of the newest file that was written to its end) of a folder of numbered small files."""
    numbers = sorted(int(x.rsplit("/", 1)[-1].removesuffix(".json")) for x in _listed(spark, f"{folder}/*.json"))
    for n in reversed(numbers):
        lines = _text(spark, f"{folder}/{n:08d}.json").splitlines()
        if lines and lines[-1] == "end":
            return numbers[-1], lines[:-1]
    return (numbers[-1] if numbers else -1), None


def stored_schema(spark: SparkSession, table: LakeTable) -> T.StructType | None:
    """The columns that creation and all batches have brought; None before creation."""
    _, lines = _newest(spark, f"{table.location}/schema")
    return T.StructType.fromJson(json.loads(lines[0])) if lines else None


def _remember(spark: SparkSession, table: LakeTable, schema: T.StructType) -> None:
    """Columns are known before the rows that have them are."""
    while True:
        n, lines = _newest(spark, f"{table.location}/schema")
        before = T.StructType.fromJson(json.loads(lines[0])) if lines else None
        merged = wider(before, schema) if before else schema
        if merged == before or _put(spark, f"{table.location}/schema/{n + 1:08d}.json", merged.json()):
            return


@dataclass(frozen=True)
class File:
    """A file of a Parquet table: its batches, size, and the least and greatest value (µs) of each column of times.

    ``uri`` is its path as Spark reports it for rows, with characters of names encoded once more.
    """

    path: str
    uri: str
    batches: tuple[int, ...]
    bytes: int
    rows: int
    times: dict[str, tuple[int, int]]

    @property
    def partition(self) -> str:
        """Folder of its event name."""
        return self.path.split("/")[-2]

    def may_hold(self, times: Mapping[str, tuple[datetime, datetime]]) -> bool:
        """Whether a row with all of these times (from, to, both included) may be in it."""
        return all(c in self.times and self.times[c][0] <= _micros(hi) and self.times[c][1] >= _micros(lo) for c, (lo, hi) in times.items())


def _micros(t: datetime) -> int:
    t = t if t.tzinfo else t.replace(tzinfo=UTC)
    return (t - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1)


def _list_folder(table: LakeTable, day: str) -> str:
    return f"{table.location}/files/load_tstamp_date={day}"


def _files(spark: SparkSession, table: LakeTable, day: str) -> tuple[int, list[File]]:
    """(number of its newest list, files) of a load date."""
    n, lines = _newest(spark, _list_folder(table, day))
    found = [json.loads(x) for x in lines or [] if x]
    return n, [File(x["path"], x["uri"], tuple(x["batches"]), x["bytes"], x["rows"], {c: tuple(v) for c, v in x["times"].items()}) for x in found]


def days(spark: SparkSession, table: LakeTable, since: date | None = None, until: date | None = None) -> list[str]:
    """Load dates that the table has files of, within both bounds."""
    found = [x.rsplit("=", 1)[-1] for x in _listed(spark, f"{table.location}/files/load_tstamp_date=*")]
    return [d for d in found if (since is None or d >= str(since)) and (until is None or d <= str(until))]


def files(spark: SparkSession, table: LakeTable, since: date | None = None, until: date | None = None, times: Mapping[str, tuple[datetime, datetime]] | None = None) -> list[File]:
    """Files of load dates from ``since`` to ``until`` that may hold rows with such ``times``: one small list a date is read."""
    return [f for d in days(spark, table, since, until) for f in _files(spark, table, d)[1] if f.may_hold(times or {})]


def parts(spark: SparkSession, table: LakeTable) -> list[str]:
    """Folders of a Parquet table's data, those that no list has included."""
    return [x.rsplit("/", 1)[-1] for x in _listed(spark, f"{table.location}/data/part=*")]


def _commit(spark: SparkSession, table: LakeTable, day: str, change: Callable[[list[File]], list[File]]) -> None:
    """Replace the list of a date in one step. If another writer was first, ``change`` is made to what that one wrote."""
    for _ in range(100):
        n, before = _files(spark, table, day)
        text = "\n".join(json.dumps({"path": f.path, "uri": f.uri, "batches": f.batches, "bytes": f.bytes, "rows": f.rows, "times": f.times}) for f in change(before))
        if _put(spark, f"{_list_folder(table, day)}/{n + 1:08d}.json", text):
            return
    raise RuntimeError(f"{table.location}: other writers were always first")


def _written(df: DataFrame, table: LakeTable, part: str, batches: dict[str, tuple[int, ...]] | tuple[int, ...]) -> dict[str, list[File]]:
    """Write ``df`` as a part of the table that no list has yet; load date -> its files.

    Sizes and bounds are read back from the files' columns of times, one row for each file.
    """
    spark, data = df.sparkSession, f"{table.location}/data"
    df.write.mode("overwrite").partitionBy(*PARTITIONS).options(**table.options).parquet(f"{data}/part={part}")
    stats = [c for c in STATS_COLUMNS if c in df.columns]
    back = spark.read.schema(T.StructType([f for f in df.schema if f.name in stats or f.name in PARTITIONS])).parquet(f"{data}/part={part}")
    bounds = [F.unix_micros(f(F.col(c).cast("timestamp"))).alias(f"{n}_{c}") for c in stats for n, f in (("min", F.min), ("max", F.max))]
    seen = back.groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).agg(F.count(F.lit(1)).alias("rows"), *bounds)
    out: dict[str, list[File]] = {}
    for r in sorted(seen.collect(), key=lambda r: r["path"]):
        uri = r["path"][r["path"].rindex(f"/part={part}/") + 1 :]
        path = unquote(uri)
        times = {c: (r[f"min_{c}"], r[f"max_{c}"]) for c in stats if r[f"min_{c}"] is not None}
        of = batches if isinstance(batches, tuple) else batches[path.split("/")[-2]]
        out.setdefault(path.split("/")[1].split("=", 1)[1], []).append(File(path, uri, of, r["bytes"], r["rows"], times))
    return out


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL") for f in schema)


def create(spark: SparkSession, table: LakeTable) -> None:
    """Create the table if it is absent, and probe that it can be written with an empty commit.

    A table that exists with more columns is no error; one that lacks columns or has other types for
    them raises ValueError (Parquet; the other formats check on their own).
    """
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    if table.format == "parquet":
        nullable = T.StructType([T.StructField(f.name, f.dataType) for f in table.schema])
        if (stored := stored_schema(spark, table)) is not None:
            have = {f.name: f.dataType for f in stored}
            wrong = [f.name for f in nullable if have.get(f.name) != f.dataType]
            if wrong:
                raise ValueError(f"{table.location}: columns that differ: {', '.join(wrong)}")
        else:
            _remember(spark, table, nullable)
        spark.createDataFrame([], nullable).write.mode("overwrite").parquet(f"{table.location}/_probe")
    elif table.format == "delta":
        from delta.tables import DeltaTable

        stated = T.StructType([f for f in table.schema if f.name != "load_tstamp_date"])
        made = DeltaTable.createIfNotExists(spark).location(table.location).addColumns(stated).partitionedBy(*PARTITIONS)
        made = made.addColumn("load_tstamp_date", "DATE", generatedAlwaysAs="CAST(load_tstamp AS DATE)")
        for k, v in ({"delta.dataSkippingStatsColumns": ",".join(STATS_COLUMNS)} | table.properties).items():
            made = made.property(k, v)
        made.execute()
    elif table.format == "iceberg":
        properties = {f"write.metadata.metrics.column.{c}": "full" for c in STATS_COLUMNS} | {"write.spark.accept-any-schema": "true"} | table.properties
        stated = ", ".join(f"'{k}'='{v}'" for k, v in properties.items())
        place = f" LOCATION '{table.options['location']}'" if "location" in table.options else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table.location} ({_columns(table.schema)}) USING iceberg PARTITIONED BY (days(load_tstamp), event_name){place} TBLPROPERTIES ({stated})")
        spark.createDataFrame([], table.schema).writeTo(table.location).append()
    elif table.format == "hudi":
        if "database" in table.options:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.options['database']}")
        stated = ", ".join(f"'{k}'='{v}'" for k, v in table.properties.items())
        spark.sql(f"CREATE TABLE IF NOT EXISTS {_hudi_name(table)} ({_columns(table.schema)}) USING hudi LOCATION '{table.location}'" + (f" TBLPROPERTIES ({stated})" if stated else ""))
        for call in ("run_clean", "archive_commits"):
            spark.sql(f"CALL {call}(table => '{_hudi_name(table)}')")
    else:
        raise ValueError(f"unknown table format {table.format}")


def _hudi_name(table: LakeTable) -> str:
    database = table.options.get("database")
    return (f"{database}." if database else "") + table.options.get("name", "events")


def _conflict(e: Exception) -> bool:
    return "Concurrent" in type(e).__name__ or "Concurrent" in str(e)[:500]


def _replaced(batch_id: int, new: list[File], old: list[File]) -> list[File]:
    if any(batch_id in f.batches and len(f.batches) > 1 for f in old):
        raise ValueError(f"batch {batch_id} was merged with others and cannot be written again")
    return [f for f in old if batch_id not in f.batches] + new


def append(df: DataFrame, table: LakeTable, batch_id: int) -> None:
    """One commit of one batch. A batch that is appended again replaces itself (Parquet), or is left out the second
    time (Delta, Iceberg). Hudi appends it again.
    """
    spark = df.sparkSession
    for attempt in range(1, table.attempts + 1):
        try:
            if table.format == "parquet":
                spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
                _remember(spark, table, T.StructType([T.StructField(f.name, f.dataType) for f in df.schema]))
                before = [x.rsplit("=", 1)[-1] for x in _listed(spark, f"{table.location}/data/part=b{batch_id}-*/load_tstamp_date=*")]
                new = _written(df, table, f"b{batch_id}-{uuid.uuid4().hex}", (batch_id,))
                for day in sorted({*new, *before}):
                    _commit(spark, table, day, partial(_replaced, batch_id, new.get(day, [])))
            elif table.format == "delta":
                own = {"txnAppId": "siltworks", "txnVersion": str(batch_id), "mergeSchema": "true"}
                df.write.format("delta").mode("append").options(**own, **table.options).save(table.location)
            elif table.format == "iceberg":
                if spark.sql(f"SELECT 1 FROM {table.location}.snapshots WHERE summary['siltworks-batch'] = '{batch_id}' LIMIT 1").count():
                    return
                own = {"merge-schema": "true", "check-ordering": "false", "distribution-mode": "none", "snapshot-property.siltworks-batch": str(batch_id)}
                df.writeTo(table.location).options(**own, **table.options).append()
            else:
                own = {"hoodie.datasource.write.operation": "bulk_insert", "hoodie.datasource.write.partitionpath.field": "load_tstamp_date", "hoodie.datasource.write.reconcile.schema": "true"}
                df.write.format("hudi").mode("append").options(**own, **table.options).save(table.location)
            return
        except Exception as e:
            if attempt == table.attempts or not _conflict(e):
                raise


def read(spark: SparkSession, table: LakeTable, since: date | None = None, until: date | None = None, times: Mapping[str, tuple[datetime, datetime]] | None = None) -> DataFrame:
    """The table with all columns that any commit has brought.

    Parquet: ``load_tstamp_date`` and ``event_name`` come back from the paths; an empty name is null. Load dates outside
    ``since`` and ``until`` are not listed, and files whose bounds exclude ``times`` are not opened; rows of the other
    files are not filtered. The other formats do both by themselves from a ``where``.
    """
    if table.format == "parquet":
        schema, found = stored_schema(spark, table), files(spark, table, since, until, times)
        if not found:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", f"{table.location}/data").parquet(*[f"{table.location}/data/{f.path}" for f in found]).drop("part")
    if table.format == "iceberg":
        return spark.table(table.location)
    return spark.read.format(table.format).load(table.location)


def compact(spark: SparkSession, table: LakeTable, since: date, small: int = 100 << 20, target: int = 500 << 20, below_batch: int | None = None) -> int:
    """Merge small files of partitions loaded on or after ``since``; returns how many batches changed.

    Parquet: the small files of a date and event name, of whichever batches, become as few as files of ``target`` bytes
    allow, neighbours in time together. They are planned by the lists of these dates, without listing or opening any,
    and each date is switched in one step. Only batches below ``below_batch`` (those committed) are touched, so it can run
    beside a load; maintain() removes what was replaced.
    """
    if table.format == "delta":
        spark.sql(f"OPTIMIZE delta.`{table.location}` WHERE load_tstamp_date >= '{since}'")
        return 0
    if table.format == "iceberg":
        spark.sql(f"CALL system.rewrite_data_files(table => '{table.location}', where => 'load_tstamp >= TIMESTAMP ''{since}''')")
        return 0
    if table.format == "hudi":
        raise ValueError("Hudi clusters inline: set hoodie.clustering.inline in the write options")
    schema, changed = stored_schema(spark, table), set()
    for day in days(spark, table, since):
        groups: list[list[File]] = []
        crowded: dict[str, list[File]] = {}
        for f in _files(spark, table, day)[1]:
            if f.bytes < small and (below_batch is None or max(f.batches) < below_batch):
                crowded.setdefault(f.partition, []).append(f)
        for mine in crowded.values():
            n = max(1, -(-sum(f.bytes for f in mine) // target))
            if n < len(mine):
                groups += _packed(mine, n)
        if not groups:
            continue
        number = local(spark, [(f.uri, k) for k, g in enumerate(groups) for f in g], "_path string, _group int")  # one row for each small file of a day
        data = f"{table.location}/data"
        rows = spark.read.schema(schema).option("basePath", data).parquet(*[f"{data}/{f.path}" for g in groups for f in g]).drop("part")
        rows = rows.withColumn("_path", F.regexp_extract("_metadata.file_path", "/(part=[^/]*/[^/]*/[^/]*/[^/]*)$", 1)).join(F.broadcast(number), "_path")
        rows = rows.repartitionById(len(groups), "_group").drop("_path", "_group").sortWithinPartitions("event_name", "collector_tstamp")
        of = {p: tuple(sorted({b for g in groups for f in g if f.partition == p for b in f.batches})) for p in crowded}
        new = _written(rows, table, f"m-{uuid.uuid4().hex}", of)
        old = {f.path for g in groups for f in g}
        try:
            _commit(spark, table, day, partial(_merged, old, new.get(day, [])))
        except LookupError:
            continue  # a batch was written again meanwhile; what was merged is in no list, and maintain() removes it
        changed |= {b for g in groups for f in g for b in f.batches}
    return len(changed)


def _packed(mine: list[File], n: int) -> list[list[File]]:
    """``n`` groups of files next to each other in time, of about the same bytes; groups of one file are left out."""
    total, at, out = sum(f.bytes for f in mine), 0, [[] for _ in range(n)]
    for f in sorted(mine, key=lambda f: (f.times.get("collector_tstamp", (0, 0)), f.path)):
        out[min(n - 1, at * n // max(1, total))].append(f)
        at += f.bytes
    return [g for g in out if len(g) > 1]


def _merged(old: set[str], new: list[File], held: list[File]) -> list[File]:
    if not old <= {f.path for f in held}:
        raise LookupError("a merged file is gone")
    return [f for f in held if f.path not in old] + new


def maintain(spark: SparkSession, table: LakeTable, keep_hours: int = 168) -> None:
    """Remove what old commits have left behind, by the format's own means.

    Parquet: parts of at least ``keep_hours`` that no list has, replaced or never finished, and lists but the last two.
    """
    if table.format == "parquet":
        fs, _ = _path(spark, table.location)
        to_path = spark._jvm.org.apache.hadoop.fs.Path
        old = lambda x: fs.getFileStatus(to_path(x)).getModificationTime() / 1000 <= time.time() - keep_hours * 3600
        live = {f.path.split("/")[0] for f in files(spark, table)}
        for part in parts(spark, table):
            if part not in live and old(at := f"{table.location}/data/{part}"):
                fs.delete(to_path(at), True)
        for day in days(spark, table):
            for list_ in _listed(spark, f"{_list_folder(table, day)}/*.json")[:-2]:
                fs.delete(to_path(list_), False)
        return
    if table.format == "delta":
        spark.sql(f"VACUUM delta.`{table.location}` RETAIN {keep_hours} HOURS")
    elif table.format == "iceberg":
        spark.sql(f"CALL system.expire_snapshots(table => '{table.location}', retain_last => 1)")
    elif table.format == "hudi":
        for call in ("run_clean", "archive_commits"):
            spark.sql(f"CALL {call}(table => '{_hudi_name(table)}')")
