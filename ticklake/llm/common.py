"""Shared helpers: scratch tables in the shared folder, text buffers, bounded samples."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space of the word definition ``[^\x20\x09-\x0D]+``.
SPACE = "[ \\t-\\r]+"


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that
    setting (tests) gets a temporary folder of its own; elsewhere its lack is an error,
    because executors do not share the driver's disk.
    """
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="ticklake-llm-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir() or base
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder through Hadoop's file system of its URI."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Written intermediate tables of one operator call.

    ``keep`` writes a frame to the shared folder and reads it back: lineage ends there, a
    lost executor costs only the tasks that read the files, and both sides of a later join
    get exchanges of their own, which AQE can split when a key is hot. ``drop`` deletes
    tables that nothing reads any more, ``close`` all but those that the operator's result
    still reads.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.tables: list[tuple[DataFrame, str]] = []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.tables.append((out, path))
        return out

    def drop(self, *unread: DataFrame) -> None:
        gone = [path for df, path in self.tables if any(df is x for x in unread)]
        self.tables = [(df, path) for df, path in self.tables if path not in gone]
        for path in gone:
            drop_path(self.spark, path)

    def close(self, *still_read: DataFrame) -> None:
        self.drop(*[df for df, _ in self.tables if not any(df is x for x in still_read)])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row (a lambda variable, which the
    optimizer does not expand into each use)."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Maximal runs ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3: the fold of a document."""
    return F.crc32(doc_id.cast("string")) % 3


def bucket_sample(df: DataFrame, id_col: str, by: list[str], size: int) -> DataFrame:
    """At most ``size`` ids per value of ``by``: one id (least hash) per hash bucket.

    A partial aggregate runs before the shuffle, so a hot group sends ``size`` rows per
    task; the result does not depend on partitioning or order.
    """
    h = F.xxhash64(F.col(id_col), F.lit(17))
    return (df.where(F.col(id_col).isNotNull())
            .groupBy(*by, F.pmod(h, F.lit(size)).alias("_bucket"))
            .agg(F.min_by(F.col(id_col), F.xxhash64(F.col(id_col), F.lit(29))).alias(id_col))
            .drop("_bucket"))


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; null is empty. No copy of
    the text unless it has nulls."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    base = int(offsets[0])
    size = int(offsets[-1]) - base
    raw = np.frombuffer(data, np.uint8)[base:base + size] if size else np.zeros(0, np.uint8)
    return raw, offsets - base


def byte_slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) of at most ``most`` bytes each (a longer row stands alone)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (multiply and xor-shift)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of them."""
    size = 1 << max(12, int(n).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _POWERS[size] = tuple(
            np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, b, np.uint64))])
            for b in (_BASE, inverse))
    return _POWERS[size]


#: Bytes hashed at once; a longer text is hashed piece by piece, cut at white space.
PIECE = 1 << 18


def spans(data: np.ndarray, row_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; a row's start also starts a word."""
    solid = ~_IS_SPACE[data]
    begin, end = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1]
    end[:-1] &= ~solid[1:]
    inner = row_starts[(row_starts > 0) & (row_starts < len(data))]
    begin[inner] = solid[inner]
    end[inner - 1] = solid[inner - 1]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of byte spans, from one running sum."""
    power, inverse = _powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts]
               + (ends - starts).astype(np.uint64))


def piece_hashes(data: np.ndarray, cut: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]],
                 ended_by_break: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Hashes (those of ``span_hashes``), sizes and last bytes of the spans of one long text,
    PIECE bytes at a time. ``cut`` gives the spans of a piece; a span at a piece's end goes on
    in the next one, unless (``ended_by_break``) its last byte is a line break or (else) the
    next piece begins with white space."""
    held, length, byte = 0, 0, 0  # the span that is open
    for at in range(0, len(data), PIECE):
        d = data[at:at + PIECE]
        starts, ends = cut(d)
        power, inverse = _powers(len(d))
        total = np.zeros(len(d) + 1, np.uint64)
        np.cumsum((d.astype(np.uint64) + np.uint64(1)) * power[:len(d)], out=total[1:])
        raw = (total[ends] - total[starts]) * inverse[starts]
        size, last = (ends - starts).astype(np.int64), d[ends - 1]
        if length:
            if len(starts) and starts[0] == 0:
                step = pow(int(_BASE), length, 1 << 64) * int(raw[0])
                raw[0] = np.uint64((held + step) & ((1 << 64) - 1))
                size[0] += length
            else:
                raw = np.concatenate([[np.uint64(held)], raw])
                size, last = np.concatenate([[length], size]), np.concatenate([[np.uint8(byte)], last])
            length = 0
        if len(ends) and ends[-1] == len(d) and not (ended_by_break and d[-1] == 10):
            held, length, byte = int(raw[-1]), int(size[-1]), int(last[-1])
            raw, size, last = raw[:-1], size[:-1], last[:-1]
        yield mix(raw + size.astype(np.uint64)), size, last
    if length:
        yield (mix(np.array([held], np.uint64) + np.uint64(length)), np.array([length]),
               np.array([byte], np.uint8))


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True
                ) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the rows in order, and the number of words of each row."""
    if len(offsets) == 2 and len(data) > 2 * PIECE:  # one long text: piece by piece
        parts, at = [], 0
        while at < len(data):
            cut = min(at + PIECE, len(data))
            while cut < len(data) and not _IS_SPACE[data[cut]]:
                blank = np.flatnonzero(_IS_SPACE[data[cut:cut + PIECE]])
                cut = cut + int(blank[0]) if len(blank) else min(cut + PIECE, len(data))
            parts.append(word_hashes(data[at:cut], np.array([0, 0, cut - at]), lower)[0])
            at = cut
        return np.concatenate(parts), np.array([sum(map(len, parts))])
    if lower:
        data = _LOWER[data]
    starts, ends = spans(data, offsets[:-1])
    counts = np.diff(np.searchsorted(starts, offsets))
    return span_hashes(data, starts, ends), counts
