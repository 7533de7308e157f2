"""Work that must stay spread, and be done once, as tables grow."""

from datetime import UTC, datetime

import duckdb
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from siltworks.functions.atomic import good, parse_lines
from siltworks.operators import entities, lake, layout
from siltworks.plans import lake_queries
from siltworks.sources import feed
from siltworks.streaming import loader

DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def several(folder, copies, sf_dir="/root/testdata/sf0.1"):
    """The events of ``sf_dir`` so many times, with shifted ids, in one row group."""
    t = pq.read_table(f"{sf_dir}/events.parquet")
    each = [t.set_column(0, "event_id", pc.add(t["event_id"], len(t) * k)) for k in range(copies)]
    pq.write_table(pa.concat_tables(each), f"{folder}/events.parquet")
    return str(folder)


def test_one_row_group_is_read_by_all_tasks(spark, tmp_path):
    at, before = several(tmp_path, 1, "/root/testdata/sf0.01"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")  # many splits, one of which has all rows
    try:
        sizes = [r["n"] for r in feed.feed(spark, at).groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sum(sizes) == 10_000 and len(sizes) >= 4 and max(sizes) < 5000


def test_schemas_are_taken_apart_after_they_are_counted(spark):
    rows = good(parse_lines(feed.feed(spark, DIR)))
    for found in (entities.inventory(rows), entities.distinct_keys(rows), entities.column_names(rows), lake_queries.entity_keys(spark, DIR), lake_queries.schema_counts(spark, DIR)):
        rest = plan_of(found).rsplit("Aggregate", 1)[1]
        assert "RLIKE" not in rest and "regexp_extract" not in rest


def test_counts_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def once(x):
        seen.add(1)
        return x

    rows = spark.range(1000).select(F.udf(once, "long")("id").alias("event_id")).select("event_id", F.concat(F.lit("n"), F.col("event_id") % 7).alias("event_name"))
    layout.cut_points(rows.groupBy("event_name").agg(F.count(F.lit(1)).alias("n")), 3)
    assert seen.value == 1000


def test_signatures_are_computed_once(spark):
    rows = good(parse_lines(feed.feed(spark, DIR))).persist()
    passes = spark.sparkContext.accumulator(0)
    mark = F.udf(lambda x: (passes.add(1), x)[1], "array<string>")
    total = rows.count()
    used = rows.select(mark(entities.signature()).alias("signature")).groupBy("signature").agg(F.count(F.lit(1)).alias("n"))
    entities.column_plan(used, feed.registry(spark))
    rows.unpersist()
    assert passes.value == total and not used.is_cached


def test_one_part_takes_what_all_tasks_made(spark):
    rows = spark.range(0, 1000, 1, 4).select(F.col("id").alias("event_id"), F.lit("a").alias("event_name"), F.spark_partition_id().alias("task"))
    out = layout.laid_out(rows, 1)
    assert out.select("task").distinct().count() == 4 and out.rdd.getNumPartitions() == 1


def test_rows_are_shredded_before_they_are_sent_to_their_part(spark, tmp_path, monkeypatch):
    plans, append = [], lake.append
    monkeypatch.setattr(lake, "append", lambda df, *a: (plans.append(plan_of(df)), append(df, *a)))
    load = loader.Load(lake_queries.table(spark, str(tmp_path / "lake")), feed.registry(spark), str(tmp_path / "bad"), str(tmp_path / "metrics"), value_col="line", write_partitions=2)
    lake.create(spark, load.table)
    loader.load_batch(feed.feed(spark, DIR), 0, load)
    lake_queries.written(spark, DIR)
    lake_queries.by_arrival(spark, DIR, lambda k: datetime(2024, 1, 1 + k, tzinfo=UTC))
    assert len(plans) == 12
    for plan in plans:
        above, below = plan.split("Repartition", 1)
        assert "try_variant_get" not in above and "try_variant_get" in below


def test_larger_files_are_compacted_too(spark, tmp_path):
    at = several(tmp_path, 3)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{at}/events.parquet'")
    got = lake_queries.QUERIES["lake_compact_batches"](spark, at)
    expected = con.execute(lake_queries.ORACLES["lake_compact_batches"])
    columns = [d[0] for d in expected.description]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(expected.fetchall())
