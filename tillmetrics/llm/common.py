"""Shared pieces: registry, columns, stored tables, word arrays, components."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics.sources.shared_files import SharedFiles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- tables kept between steps ----------------------------------------------------


def shared_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which all executors reach.

    Where the session names none, a folder beside the warehouse is taken.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        top = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-shared"
    return f"{top.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The same rows, written once to the shared folder and cut from their lineage."""
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    with shuffles_removed(spark):
        # The setting holds for what is planned from here on, so the rows are asked for anew.
        return df.select("*").checkpoint()


#: Fixed value: with this setting Spark removes the shuffle files of an execution when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Executions that begin inside give their shuffle files back when they end.

    For tables that are written once and read from storage afterwards. A lost executor is made good while the
    execution runs, as always.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


# --- words of many texts at once ----------------------------------------------------

#: Space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[ord("A") : ord("Z") + 1] += 32
LOWER_BYTES = TO_LOWER.tobytes()

SLICE_BYTES = 4 << 20
LONG_WORD = 256
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (xor-shift and multiply)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def sliced(batch: pa.RecordBatch, text: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``max_bytes`` of text, one row at least."""
    column = batch.column(batch.schema.get_field_index(text))
    lengths = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(lengths, dtype=np.int64), 0
    while start < len(lengths):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the bounds of each (null: no bytes)."""
    column = pa.compute.fill_null(column, "").cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


class Words:
    """Words (runs of bytes other than the six spaces) of a run of texts.

    ``first[k]:first[k + 1]`` are the words of text k.
    """

    def __init__(self, column: pa.Array, lower: bool = True):
        data, self.bounds = text_bytes(column)
        solid = ~IS_SPACE[data]
        begins, ends = solid.copy(), solid.copy()
        begins[1:] &= ~solid[:-1]
        ends[:-1] &= ~solid[1:]
        inner = self.bounds[1:-1]
        edge = inner[(inner > 0) & (inner < len(data))]
        begins[edge] = solid[edge]
        ends[edge - 1] = solid[edge - 1]
        self.data = TO_LOWER[data] if lower else data
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, self.bounds)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, the same on every machine."""
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eight = np.lib.stride_tricks.as_strided(
            np.frombuffer(padded.tobytes(), dtype=np.uint64, count=1), shape=(len(self.data) + 1,), strides=(1,)
        )
        length = (self.end - self.start).astype(np.int64)
        out = mixed(length.astype(np.uint64) + U(0x9E3779B97F4A7C15))
        which = np.arange(len(length))
        for done in range(0, LONG_WORD, 8):
            if done:
                which = which[length[which] > done]
            if not len(which):
                break
            left = np.minimum(length[which] - done, 8)
            part = eight[self.start[which] + done]
            part = part & (U(0xFFFFFFFFFFFFFFFF) >> ((8 - left) * 8).astype(np.uint64))
            out[which] = mixed(out[which] ^ part) + U(done + 1)
        for k in which[length[which] > LONG_WORD] if len(which) else ():
            rest = self.data[self.start[k] + LONG_WORD : self.end[k]].tobytes()
            out[k] ^= U(xxhash.xxh3_64_intdigest(rest))
        return out

    def shingles(self, size: int, word: np.ndarray | None = None) -> Iterator[np.ndarray]:
        """Per text: hashes of its ``size``-word shingles in order (fewer words: one of them all).

        ``word``: the words' hashes, where they are known already.
        """
        word = self.hashes() if word is None else word
        many = max(0, len(word) - size + 1)
        rolled = np.zeros(many, np.uint64)
        for k in range(size):
            rolled = rolled * U(0x9E3779B97F4A7C15) + word[k : k + many]
        rolled = mixed(rolled + U(size))
        for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist()):
            if b - a >= size:
                yield rolled[a : b - size + 1]
            elif b > a:
                one = U(0)
                with np.errstate(over="ignore"):
                    for h in word[a:b]:
                        one = one * U(0x9E3779B97F4A7C15) + h
                yield mixed(np.array([one], np.uint64) + U(b - a))
            else:
                yield word[:0]


# --- connected components -------------------------------------------------------------


class Forest:
    """Union-find over integer ids; the smallest id of a set is its root."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = parent[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def stars(self) -> list[tuple[int, int]]:
        """(root, member) of each id that is not a root."""
        return [(self.root(x), x) for x in list(self.parent) if self.root(x) != x]


#: Ids that one local union-find holds before it gives its stars away and starts anew.
FOREST_IDS = 1_000_000


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(forest):
        stars = forest.stars()
        return pa.RecordBatch.from_pydict(
            {"a": pa.array([a for a, _ in stars], pa.int64()), "b": pa.array([b for _, b in stars], pa.int64())}
        )

    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.join(a, b)
        if len(forest.parent) >= FOREST_IDS:
            yield out(forest)
            forest = Forest()
    yield out(forest)


#: Edges that one task reduces to stars.
TASK_EDGES = 100_000


def _reduced(edges: DataFrame) -> DataFrame:
    """Stars of the stored edges, in as many tasks as their number asks for."""
    tasks = 1 + edges.count() // TASK_EDGES
    return stored(edges.coalesce(tasks).mapInArrow(_local_stars, "a long, b long"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether no id is both a centre and a member, and none has two centres."""
    ends = (F.struct(F.col(end).alias("id"), F.lit(member).alias("member")) for end, member in (("a", 0), ("b", 1)))
    ends = edges.select(F.inline(F.array(*ends)))
    of_id = ends.groupBy("id").agg(F.sum("member").alias("members"), F.count("*").alias("ends"))
    return of_id.where("members > 0 and ends > 1").count() == 0


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in ``edges`` (a long, b long): the smallest id it reaches.

    Each partition first reduces its edges to stars, and then tasks of at most about ``TASK_EDGES`` edges reduce these
    again, so few edges need no more. What is left is joined by large-star and small-star
    steps: each keeps what is connected and shortens paths, until all hang
    on their smallest id. Every step is a pre-aggregated minimum per id and a join;
    no list of neighbours is built, and nothing but a count goes to the driver.
    """
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b")
    edges = _reduced(stored(edges.mapInArrow(_local_stars, "a long, b long")))
    while not _are_stars(edges):
        # Large star: larger neighbours of an id move to the smallest it knows.
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
        # Small star: an id and its smaller neighbours move to the smallest of these.
        large = large.where("a < b").distinct()
        small_least = large.groupBy("b").agg(F.min("a").alias("m"))
        moved = large.join(small_least, "b")
        small = moved.where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        small = small.union(small_least.select(F.col("m").alias("a"), "b")).distinct()
        edges = _reduced(stored(small))
    return edges.select(F.col("b").alias("id"), F.col("a").alias("component")).union(
        edges.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    )


# --- state of a Python worker ------------------------------------------------------------


def worker_state(name: str, make: Callable[[], object]) -> object:
    """What ``make`` gives, made once for each Python worker and used by its later tasks."""
    home = sys.modules.setdefault("training_data_worker_state", types.ModuleType("training_data_worker_state"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)


#: Folders of the tables written inside each of the ``scratch_tables`` that are open.
_SCRATCH: list[list[str]] = []


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that ``written`` makes inside are removed at the end, but for ``lasting`` ones.

    Whatever is used later has to be written by then: a lazy result that still reads a removed table fails.
    """
    _SCRATCH.append([])
    try:
        yield
    finally:
        for folder in _SCRATCH.pop():
            SharedFiles(spark).delete(folder)


def written(df: DataFrame, by: str | None = None, lasting: bool = False) -> DataFrame:
    """The same rows as a Parquet table in the shared folder.

    Unlike ``stored``, its size is known to the planner, which broadcasts it in a join
    only below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    folder = shared_folder(df.sparkSession)
    if _SCRATCH and not lasting:
        _SCRATCH[-1].append(folder)
    with shuffles_removed(df.sparkSession):
        (df.write.partitionBy(by) if by else df.write).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
