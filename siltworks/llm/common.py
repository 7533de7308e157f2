"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; read by Spark alone, so any store it can open will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 1,024 rows and 8 MB for this session.

    What a Python worker holds then depends neither on the length of texts nor on the rows of a task.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


_kept: dict[str, dict] = {}


def kept(owner: str) -> dict:
    """What this Python worker remembers from task to task for one kind of work.

    Spark gives a worker to one operator after the other. At its first task of another kind a worker forgets what it
    remembered and hands freed memory back to the system, so that operators do not add up in it.
    """
    if owner not in _kept:
        import pyarrow as pa

        _kept.clear()
        _kept[owner] = {}
        gc.collect()
        pa.default_memory_pool().release_unused()
        if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
            libc.malloc_trim(0)
    return _kept[owner]


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of this session, within the one named by ``spark.checkpoint.dir``.

    Only where that setting is absent on one machine (tests) a folder of our own is used; on a cluster that is an error.
    """
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return jsc.getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in ``shared_dir``."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in ``shared_dir``: like ``cut``, where readers need few of the columns."""
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_join(rows: DataFrame, groups: DataFrame, keys: list[str], how: str = "inner", keep_size: bool = False) -> DataFrame:
    """``rows`` joined with the one row that ``groups`` has for their key; no key is sent to one task.

    ``groups.size`` is how many rows hold the key. Keys of more than 1/20,000 of all rows (so 20,000 keys at
    most) are broadcast; the rest is joined by a shuffle. Both inputs are read twice.
    """
    total = groups.agg(F.sum("size")).first()[0] or 0
    hot = groups.where(F.col("size") > max(256, total // 20_000))
    cold = groups if keep_size else groups.drop("size")
    if not hot.limit(1).count():
        return rows.join(cold, keys, how)
    few = F.broadcast(hot if keep_size else hot.drop("size"))
    rest = groups.where(F.col("size") <= max(256, total // 20_000))
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(rest if keep_size else rest.drop("size"), keys, how)
    return rows.join(few, keys).unionByName(rest)


#: Bits of a map of keys for each key, and at most (128 MB); more keys than that only let more other rows through.
BITS_PER_KEY, MOST_BITS = 16, 1 << 30
_BLOCK = 1 << 15  # bits in a bitmap of Spark


def marked(rows: DataFrame, keys: DataFrame, key: str, flag: str) -> DataFrame:
    """``rows`` with a boolean ``flag``: true wherever ``keys`` has the row's ``key``, and for some 6 % of the others.

    A bitmap of the keys' hashes is broadcast (2 bytes a key), so that rows which meet nothing need not be shuffled to be
    left out. ``keys`` is read twice; a key may occur in it more than once.
    """
    blocks = max(1, -(-min(keys.count() * BITS_PER_KEY, MOST_BITS) // _BLOCK))
    hashed = F.xxhash64(key, F.lit("bits"))
    block, place = F.pmod(hashed, F.lit(blocks)), F.pmod(F.shiftrightunsigned(hashed, 40), F.lit(_BLOCK)).cast("int")
    at, words, where = (spare(rows, x) for x in ("block", "words", "place"))
    maps = keys.select(block.alias(at), place.alias(where)).repartition(at).groupBy(at).agg(F.bitmap_construct_agg(where).alias(words))
    # as longs, whose bits can be looked up: eight bytes each, the first one highest
    maps = maps.select(at, F.expr(f"transform(sequence(0, {_BLOCK // 64 - 1}), i -> cast(conv(hex(substring({words}, i * 8 + 1, 8)), 16, -10) as bigint))").alias(words))
    held = rows.withColumns({at: block, where: place}).join(F.broadcast(maps), at, "left")
    bit = F.getbit(F.get(words, F.shiftright(where, 6)), F.col(where).bitwiseAND(63).bitwiseXOR(56))
    return held.select(*rows.columns, F.coalesce(bit == 1, F.lit(False)).alias(flag))


def spare(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use yet."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def held_out(doc_id="doc_id"):
    """True for rows whose crc32(doc_id as text) mod 5 is 0 (never used to learn labels)."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node in ``links``; component is the smallest node reachable.

    Alternating large-star and small-star steps. Each is a minimum per node (combined before the
    shuffle) and an equi-join that can be split where a node has very many links. The links are
    checkpointed each round, so a lost executor costs one round at most, and few links are kept in few
    files. Done when every link leads straight to a node that is no link's larger end. Rounds grow like
    the logarithm of the longest path (a path of a million links takes about 20); past ``max_rounds`` it is an error, never
    a wrong result.
    """

    def kept(df: DataFrame) -> tuple[DataFrame, int]:
        df = cut(df)
        n = df.count()
        return df.coalesce(1 + n // 200_000), n

    edges, n = kept(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    for _ in range(max_rounds):
        ends = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        inner = edges.select(F.col("v").alias("u")).distinct().join(ends, "u", "left_semi").count()
        if not inner and ends.count() == n:
            break
        # large star: every larger neighbour of u moves to u's smallest neighbour
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large, _ = kept(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        # small star: the smaller neighbours of u, and u itself, move to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges, n = kept(small.distinct())
    else:
        raise RuntimeError("components: no fixed point")
    # a fixed point is a set of stars: u -> smallest node of its component
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
