"""Shared pieces: stored frames, words, 64-bit mixing, connected components."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmint.session import ship_package

U64 = np.uint64
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a local session (tests, one machine) may leave it unset; it then gets a
    temporary folder. On a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="segmint-shared-")
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def store(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table into the shared folder and read it again: cuts the lineage,
    so a lost executor costs one task of the table's readers, not the work above it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    # what the write shuffled isn't needed once the table is there
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def prepare(spark: SparkSession) -> None:
    """Make the package importable in the Python workers."""
    ship_package(spark)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply); a bijection, so it adds no collisions."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


class Cache:
    """A dictionary of two generations: when ``new`` is full it becomes ``old``, so at most
    2 * ``limit`` entries are held and what is used often stays."""

    def __init__(self, limit: int):
        self.limit, self.new, self.old = limit, {}, {}

    def find(self, key):
        got = self.new.get(key)
        if got is None:
            got = self.old.get(key)
            if got is not None:
                self.put(key, got)
        return got

    def put(self, key, value) -> None:
        if len(self.new) >= self.limit:
            self.old, self.new = self.new, {}
        self.new[key] = value


class ByteCache:
    """Bytes by string, in two generations of at most ``limit / 2`` bytes each; a string is kept from its
    second sight on (by a table of hash marks), so what occurs once takes no room."""

    ENTRY = 200  # of a dictionary entry and the two objects' headers

    def __init__(self, limit: int):
        self.limit, self.new, self.old, self.size = limit // 2, {}, {}, 0
        self.seen = bytearray(1 << 20)

    def find(self, key: str) -> bytes | None:
        got = self.new.get(key)
        if got is None:
            got = self.old.get(key)
            if got is not None:
                self._keep(key, got)
        return got

    def put(self, key: str, value: bytes) -> None:
        at = hash(key) & 0xFFFFF
        if self.seen[at]:
            self._keep(key, value)
        else:
            self.seen[at] = 1

    def _keep(self, key: str, value: bytes) -> None:
        if self.size >= self.limit:
            self.old, self.new, self.size = self.new, {}, 0
            self.seen = bytearray(len(self.seen))
        self.new[key] = value
        self.size += self.ENTRY + 4 * len(key) + len(value)


def byte_slices(batch: pa.RecordBatch, column: int, most: int):
    """``batch`` in slices whose texts in ``column`` hold at most ``most`` bytes; a longer text is a slice of its own."""
    texts = batch.column(column)
    if not (pa.types.is_string(texts.type) or pa.types.is_binary(texts.type)):
        texts = texts.cast(pa.string())
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    lo = 0
    while lo < len(size):
        before = ends[lo] - size[lo]
        hi = max(int(np.searchsorted(ends, before + most, side="right")), lo + 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def tidy(run):
    """``run`` over batches, after which the worker gives freed memory back: workers are kept for
    later stages, and what one stage's arrays took shouldn't count against the next."""
    def tidied(batches):
        yield from run(batches)
        give_back()

    return tidied


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not a glibc: its allocator keeps what it has
        pass


def per_worker(make, *args):
    """One ``make(*args)`` per Python worker process, kept between its tasks with its caches."""
    kept = _KEPT.get((make.__name__, args))
    if kept is None:
        kept = _KEPT[make.__name__, args] = make(*args)
    return kept


_KEPT: dict = {}


def release(*stored: DataFrame) -> None:
    """Empty tables made by ``store`` that nothing will read any more."""
    for df in stored:
        folder = df.inputFiles()[0].rsplit("/", 1)[0] if df.inputFiles() else None
        if folder:
            df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(folder)


def collect_garbage(spark: SparkSession) -> None:
    """Have the driver's JVM collect its heap: planning leaves much garbage, and the heap grows by it up to its
    limit; Spark also drops broadcasts and shuffles of finished jobs only when their handles are collected."""
    spark.sparkContext._jvm.System.gc()


def resized(docs: DataFrame, text_col: str, size_col: str) -> DataFrame:
    """``size_col``, if there, as the text's length in characters."""
    if size_col not in docs.columns:
        return docs
    kind = docs.schema[size_col].dataType
    return docs.select(*[F.char_length(text_col).cast(kind).alias(size_col) if c == size_col else F.col(c) for c in docs.columns])


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """Connected components of ``edges`` (a, b: long) as rows (node, component).

    ``component`` is the smallest node reachable. Alternating large-star and
    small-star rounds: every round is two aggregations and joins by node, partial
    minima first, so a node with very many neighbours reaches its reducer as one row
    per input partition. Edges and labels never leave Spark; the driver sees only
    one count and one checksum a round. An empty frame gives an empty result;
    self-loops, nulls and repeated edges are ignored.
    """
    spark = edges.sparkSession
    e = store(edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v")).distinct())
    state = None
    for _ in range(max_rounds):
        # a node's larger neighbours go to the smallest node of its neighbourhood, then the smaller ones to the smallest of them
        low = e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("v"), "m")
        large = e.join(low, "v", "left").select("u", F.coalesce("m", "v").alias("v"))
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()
        e = store(small)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    collect_garbage(spark)
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(nodes.select("component", "component").distinct())
