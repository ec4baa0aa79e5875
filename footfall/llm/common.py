"""Shared helpers: scratch tables, word hashes of whole Arrow columns, connected components."""

from __future__ import annotations

import ctypes
import gc
from contextlib import contextmanager
from functools import wraps
from inspect import signature
from pathlib import Path
from typing import NamedTuple
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.session import scratch_dir

ROOT = str(Path(__file__).resolve().parents[2])


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers on the driver's machine find this package; clusters install it."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark


#: Spark's setting that drops shuffle files at the end of an execution.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffle_files_dropped(spark: SparkSession):
    """Drop the shuffle files of what is executed here as soon as it ends."""
    before = spark.conf.get(_CLEAN_UP, "false")
    spark.conf.set(_CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN_UP, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write ``df`` below the shared folder and read it back.

    The shuffle files of the write go with its end, for nothing reads them again.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label) + "/table"
    with shuffle_files_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _PATHS[table] = path
    return table


#: Paths of tables that ``stored`` has written.
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``stored``, once what was computed from them is itself a written table.

    A lost executor then goes back to that table, never to these.
    """
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(_PATHS.pop(table))
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def _free() -> None:
    """Give the memory that a task has used back to the system."""
    _POWERS[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def tidy_group(run):
    """The same for a function of whole groups, or of pairs of them: memory goes back after each."""

    def one(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            _free()

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return run(left, right)
        finally:
            _free()

    return one if len(signature(run).parameters) == 1 else two  # Spark counts the parameters


def tidy(run):
    """``run``, a function for ``mapInArrow``, that frees its memory when the task ends.

    Python workers live on for later tasks and stages; what they hold adds up on an executor.
    """

    @wraps(run)
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            _free()

    return tidied


# ---------------------------------------------------------------------------------------------
# words and their hashes, one numpy pass over the bytes of a column
# ---------------------------------------------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_CLOSING = np.zeros(256, bool)
_CLOSING[[ord(c) for c in ".,;:!?"]] = True
_EXACT = np.random.default_rng(20240101).integers(1, 2**63, 256, dtype=np.uint64)
_FOLD = _EXACT.copy()
_FOLD[65:91] = _EXACT[97:123]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
#: Bytes hashed at a time, to keep the 64-bit arrays in the processor's cache.
_SLICE = 1 << 20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.cumprod(p, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Words(NamedTuple):
    """Words of a column: hash, byte range in ``data``, and the first word of each row."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # rows + 1 entries
    data: np.ndarray
    prefix: np.ndarray | None = None

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def text_bytes(texts) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null counts as an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(texts) == 0 or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def words_of(texts, fold: bool = False, trim: bool = False, prefix: int = 0) -> Words:
    """Words (runs without ASCII white space) of every text; ``fold`` lower-cases A-Z.

    ``trim`` leaves up to three closing punctuation marks out of a word's hash; ``prefix`` also
    gives the hash of each word's first bytes, of that many.
    """
    data, offsets = text_bytes(texts)
    table = _FOLD if fold else _EXACT
    hashes, starts, ends, prefixes = [], [], [], []
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _SLICE, "right")) - 1)
        lo, hi = int(offsets[row]), int(offsets[stop])
        if hi > lo:
            part = data[lo:hi]
            space = _SPACE[part]
            edge = np.empty(hi - lo + 1, bool)  # a word may start or end before this byte
            edge[1:-1] = space[1:] != space[:-1]
            edge[0] = edge[-1] = True
            edge[offsets[row : stop + 1] - lo] = True
            cuts = np.flatnonzero(edge)
            s, e = cuts[:-1], cuts[1:]
            keep = ~space[s]
            s, e = s[keep], e[keep]
            power, inverse = _powers(hi - lo + 1)
            sums = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(table[part] * power[: hi - lo], out=sums[1:])
            starts.append(s + lo)
            ends.append(e + lo)
            if trim:
                for _ in range(3):
                    e = e - (_CLOSING[part[e - 1]] & (e - s > 1))
            hashes.append(mix((sums[e] - sums[s]) * inverse[s]))
            if prefix:
                prefixes.append(mix((sums[np.minimum(e, s + prefix)] - sums[s]) * inverse[s]))
        row = stop
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    start = join(starts, np.int64)
    first = np.searchsorted(start, offsets).astype(np.int64)
    heads = join(prefixes, np.uint64) if prefix else None
    return Words(join(hashes, np.uint64), start, join(ends, np.int64), first, data, heads)


def prefix_sums(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Karp-Rabin sums of all words before each place, and the factor that makes them comparable.

    ``(sums[i + n] - sums[i]) * factor[i]`` is the same for any two equal runs of ``n`` words.
    """
    total = len(words.hash)
    power, inverse = _powers(total + 1)
    sums = np.zeros(total + 1, np.uint64)
    np.cumsum(mix(words.hash + np.uint64(0x5851F42D4C957F2D)) * power[:total], out=sums[1:])
    return sums, inverse


def windows(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``n`` words from each word on, and whether they lie in one text."""
    total = len(words.hash)
    whole = np.zeros(total, bool)
    out = np.zeros(total, np.uint64)
    if total >= n:
        sums, inverse = prefix_sums(words)
        out[: total - n + 1] = mix((sums[n:] - sums[: total - n + 1]) * inverse[: total - n + 1])
        last = np.repeat(words.first[1:], np.diff(words.first))
        whole = np.arange(total) + n <= last
    return out, whole


# ---------------------------------------------------------------------------------------------
# chunks: documents dealt into groups of bounded size that two passes can meet at
# ---------------------------------------------------------------------------------------------


def n_chunks(docs: DataFrame, text: str, chunk_bytes: int) -> int:
    total = docs.agg(F.sum(F.octet_length(text))).collect()[0][0] or 0
    return max(1, -(-total // chunk_bytes))


def in_chunks(docs: DataFrame, key: str | list[str], n: int) -> DataFrame:
    """Adds ``chunk``: documents dealt evenly by a hash of ``key``, one column or several."""
    keys = [key] if isinstance(key, str) else key
    return docs.withColumn("chunk", F.pmod(F.xxhash64(F.lit("chunk"), *keys), F.lit(n)))


# ---------------------------------------------------------------------------------------------
# connected components
# ---------------------------------------------------------------------------------------------


#: Edges that a task contracts at a time, and tasks whose stars are contracted together.
_EDGES = 1 << 20
_FAN_IN = 16


def _forest(batches):
    """A forest of stars with the same components as the edges (a, b) of each run of batches."""

    def contract(run: list[pa.RecordBatch]):
        edges = pa.Table.from_batches(run)
        ends = np.concatenate([edges["a"].to_numpy(), edges["b"].to_numpy()])
        ids, at = np.unique(ends, return_inverse=True)
        a, b = at[: len(at) // 2], at[len(at) // 2 :]
        top = np.arange(len(ids))
        while len(a):
            np.minimum.at(top, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(top, higher := top[top]):
                top = higher
            a, b = top[a], top[b]
            a, b = a[a != b], b[a != b]
        low = np.flatnonzero(top != np.arange(len(ids)))
        return pa.record_batch([pa.array(ids[low]), pa.array(ids[top[low]])], ["a", "b"])

    run, n = [], 0
    for batch in batches:
        run.append(batch)
        n += batch.num_rows
        if n >= _EDGES:
            yield contract(run)
            run, n = [], 0
    if n:
        yield contract(run)


def _contracted(edges: DataFrame, label: str) -> DataFrame:
    """Stars with the same components, by contraction in a tree.

    Tasks contract what they read. Then the stars of up to ``_FAN_IN`` tasks are contracted
    together, and so on, while a task gets at most ``_EDGES`` edges: copies of one group that many
    tasks have seen become one star before any row of them is shuffled.
    """
    current = stored(edges.select("a", "b").mapInArrow(_forest, "a long, b long"), label)
    tasks = current.rdd.getNumPartitions()
    while tasks > 1:
        fewer = max(-(-tasks // _FAN_IN), -(-current.count() // _EDGES))
        if fewer > tasks // 2:
            break
        current = stored(current.coalesce(fewer).mapInArrow(_forest, "a long, b long"), label)
        tasks = fewer
    return current


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(id, component) of every id in ``edges`` (a, b); component is the smallest id reachable.

    The edges are first contracted to stars in a tree of tasks. Where more stars are left than a
    task may get, every id and all its neighbours go to the smallest of them, round by round, which
    keeps the components and shrinks the graph to stars in few rounds. Each round is written, so
    lineage stays short; a row of the graph is two longs, and minima are pre-aggregated. It ends
    when no id has two tops and no top has one of its own.
    """

    def gather(pairs: DataFrame) -> DataFrame:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        moved = both.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = least.select("a", F.col("m").alias("b"))
        return moved.union(own).where("a != b").distinct()

    def stars(pairs: DataFrame) -> bool:
        tops = pairs.select(F.col("b").alias("id"), F.lit(0).alias("low"))
        roles = pairs.select(F.col("a").alias("id"), F.lit(1).alias("low")).union(tops)
        roles = roles.groupBy("id").agg(F.sum("low").alias("lows"), F.max(1 - F.col("low")).alias("tops"))
        return roles.where("lows > 0 and lows + tops > 1").isEmpty()

    current = _contracted(edges, label)
    while not stars(current):
        current = stored(gather(current), label)
    tops = current.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
    return current.select(F.col("a").alias("id"), F.col("b").alias("component")).union(tops)
