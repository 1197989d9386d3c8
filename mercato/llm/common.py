"""Helpers shared by the operators: words, shared-folder tables, small checked broadcasts, components."""

from __future__ import annotations

import ctypes
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.session import ensure_checkpoint_dir

#: A frame is broadcast only after its size was counted and found to be at most this.
BROADCAST_BYTES = 32 << 20


#: Rows of a batch handed to Python: whole texts, some of them long, must fit a task's memory several times.
BATCH_ROWS = 2_000


def table(spark: SparkSession, sf_dir: str, name: str, batch_rows: int = BATCH_ROWS) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    """``df`` written as a table in the shared folder (in folders ``by``) and read back: cuts the lineage, survives lost executors."""
    return stored_at(df, scratch_path(df.sparkSession, name), *by)


#: Shuffle files go when the job that wrote them ends, not when the driver happens to collect its garbage.
SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored_at(df: DataFrame, path: str, *by: str) -> DataFrame:
    conf = df.sparkSession.conf
    was = conf.get(SHUFFLES_END, None)
    conf.set(SHUFFLES_END, "true")  # for this write alone: nothing else reads its shuffles
    try:
        df.write.partitionBy(*by).parquet(path)
    finally:
        conf.unset(SHUFFLES_END) if was is None else conf.set(SHUFFLES_END, was)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table of :func:`scratch_path` that nothing reads any more."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


_scopes = threading.local()


@contextmanager
def broadcasts_end() -> Iterator[None]:
    """What :func:`hand_out` broadcasts inside is destroyed at the end, on the driver and in Python workers: write all that reads it inside."""
    outer, _scopes.now = getattr(_scopes, "now", None), []
    try:
        yield
    finally:
        for held in _scopes.now:
            held.destroy()
        _scopes.now = outer


def hand_out(spark: SparkSession, value):
    """A broadcast of a value of bounded size."""
    held = spark.sparkContext.broadcast(value)
    if getattr(_scopes, "now", None) is not None:
        _scopes.now.append(held)
    return held


def small(df: DataFrame, rows: int, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast of ``df`` only if its counted size is within ``limit``; else it joins by a shuffle."""
    return F.broadcast(df) if rows * row_bytes <= limit else df


def give_back() -> None:
    """Hand memory that this Python worker has freed back to the system: workers live on through the stages that follow."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library, where it has one
    if trim:
        trim(0)


def raw(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null becomes empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def strings(column: pa.Array) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case."""
    return text.lower().split()  # bytes: both touch ASCII only


def word_hashes(words: Iterable[bytes], n: int) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``links(a, b)``: one row (node, root) per linked node, root its smallest node.

    Alternating large-star and small-star rounds (each node sends its
    neighbours to the smallest node seen), so the number of rounds grows with
    the logarithm of the longest path; links and labels stay distributed and
    every star is written to the shared folder, which keeps the plans small. A round needs only the minimum
    per node, aggregated before its shuffle; the edges then join that aggregate by
    node, where a hub's edges meet in one task unless the minima are small enough to be broadcast.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    seen = None
    for _ in range(max_rounds):
        # large star: every neighbour above the node goes to the node's smallest neighbour (itself included)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        big = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        big = stored(big.where("a <> b"), "links")  # a row per edge at most
        # small star: the node and its smaller neighbours go to the smallest of them
        least = big.groupBy("a").agg(F.min("b").alias("m"))
        near = big.join(least, "a")
        new = near.select(F.greatest("b", "m").alias("a"), F.col("m").alias("b")).where("a <> b")
        new = stored(new.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = new.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        edges = new
        if now == seen or not now[0]:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


class PieceCache(dict):
    """What is known of each text piece; what is not is learnt many at a time.

    ``learn(list of pieces) -> list of values`` is called once for each block
    of texts. Memory is bounded by two generations of about ``limit`` pieces: a
    full one becomes the old one, and pieces met again move to the new one.
    """

    def __init__(self, learn, limit: int = 150_000):
        super().__init__()
        self.learn, self.limit, self.new, self.old = learn, limit, [], {}

    def __missing__(self, piece):
        known = self.old.get(piece)
        if known is None:
            self.new.append(piece)
        else:
            self[piece] = known
        return known

    def values_of(self, texts: list[list]) -> list[list]:
        """For each list of pieces, the list of their values."""
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()
        get, out = self.__getitem__, []
        for pieces in texts:
            before = len(self.new)
            out.append((list(map(get, pieces)), len(self.new) - before))
        new, self.new = self.new, []
        if new:
            distinct = list(dict.fromkeys(new))
            self.update(zip(distinct, self.learn(distinct), strict=True))
        late = map(get, new)
        return [[next(late) if v is None else v for v in vals] if missing else vals for vals, missing in out]
