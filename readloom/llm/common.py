"""Helpers shared by the operators: shared-folder tables, Arrow byte views, graph components."""

from __future__ import annotations

import ctypes
import uuid
from functools import wraps
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Words are maximal runs of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def work_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    ``spark.checkpoint.dir`` names it; where that is unset (tests on one machine) a
    folder beside the warehouse is used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/readloom-work"
    return base.rstrip("/")


def save(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    The shuffle files of the write are deleted with it, not when the driver happens to collect its plan.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{what}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables made by :func:`save` that no later step reads."""
    for df in tables:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(df._saved_at)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def bounded_batches(df: DataFrame, rows: int = 1000, size: str = "4m") -> DataFrame:
    """Texts are long: from now on the session passes rows to Python in batches of at most ``rows`` rows and about ``size``."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= rows:
        conf.set(key, str(rows))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    return df


def release_memory() -> None:
    """Hand freed memory back: a Python worker outlives its task, beside other stages' workers."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run):
    """``run``, a function of Arrow batches, which hands freed memory back when its task ends."""

    @wraps(run)
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()

    return tidied


def crc_fold(doc_id, folds: int = 5):
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def byte_views(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an Arrow binary column without copying: (buffer, offsets of n + 1 rows)."""
    if column.null_count:
        column = column.fill_null(b"")
    kind = np.int64 if "large" in str(column.type) else np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if offsets else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf, off


def row_chunks(offsets: np.ndarray, most: int):
    """Ranges of rows holding at most ``most`` bytes each (a longer row stands alone)."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
        stop = min(max(stop, start + 1), n)
        yield start, stop
        start = stop


def is_space(data: np.ndarray) -> np.ndarray:
    """True at ASCII white space: 0x20 and 0x09 to 0x0D."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def ascii_lower(data: np.ndarray) -> np.ndarray:
    """A copy with A-Z lower-cased."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (Stafford's thirteenth variant)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _WordKeys(dict):
    """64-bit keys of words, read off their BLAKE2b digests; short words are remembered, within a bound."""

    MOST, LONGEST = 100_000, 40

    def __missing__(self, word: bytes) -> int:
        key = int.from_bytes(blake2b(word, digest_size=8).digest(), "little", signed=True)
        if len(word) <= self.LONGEST:
            if len(self) >= self.MOST:
                self.clear()
            self[word] = key
        return key


_WORD_KEYS = _WordKeys()


def _word_pieces(data: np.ndarray, most: int):
    """``data`` in pieces of about ``most`` bytes that end at white space, so that no word is cut."""
    at, n = 0, len(data)
    while at < n:
        stop = min(at + most, n)
        while stop < n and not is_space(data[stop : stop + 1])[0]:
            space = np.flatnonzero(is_space(data[stop : stop + 4096]))
            stop = stop + int(space[0]) if len(space) else min(stop + 4096, n)
        yield data[at:stop]
        at = stop


def word_keys(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all words, A-Z lower-cased, of the rows that ``bounds`` cuts ``data`` into, and how many each row has.

    A text of any length goes through in pieces of a megabyte.
    """
    keys, counts = [np.zeros(0, np.int64)], np.zeros(len(bounds) - 1, np.int64)
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        for piece in _word_pieces(data[a:b], 1 << 20):
            words = piece.tobytes().lower().split()  # of bytes: A-Z only, and exactly the six ASCII white spaces
            keys.append(np.fromiter(map(_WORD_KEYS.__getitem__, words), np.int64, len(words)))
            counts[i] += len(words)
    return np.concatenate(keys), counts


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs): (id, component_id), the least id reachable.

    Alternating large-star and small-star rounds. Each is a least-neighbour aggregate, which
    combines before its shuffle, and an equi-join, whose hot keys adaptive execution splits;
    no vertex's neighbours are gathered into one row. Rounds are written to the shared folder.
    """
    spark = edges.sparkSession

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        if large:
            both = both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        joined = both.join(least, both.u == least.k)
        if large:
            out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("k").alias("a"), F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    now = save(edges.where("a <> b").select(F.col("a").cast("long"), F.col("b").cast("long")).distinct(), "edges")
    if now.isEmpty():
        return now.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
    digest = None
    for _ in range(most_rounds):
        new = save(star(star(now, True), False), "edges")
        forget(now)
        now = new
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first()
        if seen == digest:
            break
        digest = seen
    else:
        raise RuntimeError(f"components have not settled after {most_rounds} rounds")
    return now.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component_id")).union(now.select("b", "b").distinct())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
