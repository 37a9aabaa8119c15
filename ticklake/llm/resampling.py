"""Importance resampling towards a target distribution.

Hashed word n-grams of the corpus and of the target are counted over all texts; each bucket
gets an integer gain (its log ratio), and a document's weight is the sum of its features'
gains, taken from one array. Gumbel noise of the id makes the highest scores a weighted draw
without replacement. Scores are ranked by a distributed radix sort.

CRC-32 is linear over GF(2), so the code of an n-gram follows from the codes and lengths of
its words: tasks read each byte once and combine words in numpy.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import Scratch, byte_slices, utf8

BUCKETS = 10_000
#: Bits of a digit of the radix sort, and of the number of rows in a block of it.
DIGIT_BITS = 11
BLOCK_BITS = 16
#: Bytes and words handled at once.
PIECE = 1 << 20
WORDS = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True

#: Words of up to this many bytes take the table path.
SHORT = 64
_U32 = np.uint32
_ALL = 0xFFFFFFFF


def _byte_table() -> np.ndarray:
    """Effect of one byte on the reflected CRC-32 register."""
    t = np.arange(256, dtype=_U32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ _U32(0xEDB88320), t >> 1).astype(_U32)
    return t


_STEP = _byte_table()


def _shifted(t: np.ndarray) -> np.ndarray:
    """Registers after one more zero byte."""
    return (t >> 8) ^ _STEP[t & 255]


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """``near[n, v]``: register of byte v followed by n zero bytes. ``far[n, j, v]``: a
    register whose byte j is v, n zero bytes later."""
    near = [_STEP]
    far = [np.stack([np.arange(256, dtype=_U32) << _U32(8 * j) for j in range(4)])]
    for _ in range(SHORT + 1):
        near.append(_shifted(near[-1]))
        far.append(_shifted(far[-1]))
    return np.stack(near), np.stack(far)


_NEAR, _FAR = _tables()


def _doublings() -> list[np.ndarray]:
    """``[k][j, v]``: as ``far``, 2**k zero bytes later."""
    out = [_FAR[1]]
    for _ in range(47):
        t = out[-1]
        out.append(t[0][t & 255] ^ t[1][(t >> 8) & 255] ^ t[2][(t >> 16) & 255] ^ t[3][t >> 24])
    return out


_TWICE = _doublings()


def advance(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Registers ``crc`` after ``n`` zero bytes each."""
    short = np.minimum(n, SHORT + 1)
    out = (_FAR[short, 0, crc & 255] ^ _FAR[short, 1, (crc >> 8) & 255]
           ^ _FAR[short, 2, (crc >> 16) & 255] ^ _FAR[short, 3, crc >> 24])
    rest = n - short
    k = 0
    while rest.any():
        odd = np.flatnonzero(rest & 1)
        c, t = out[odd], _TWICE[k]
        out[odd] = t[0][c & 255] ^ t[1][(c >> 8) & 255] ^ t[2][(c >> 16) & 255] ^ t[3][c >> 24]
        rest, k = rest >> 1, k + 1
    return out


def word_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Register (from 0) and length of every word of the rows in order, and the words of each row."""
    if len(offsets) == 2 and len(data) > 2 * PIECE:  # one long text: piece by piece
        codes, sizes, at = [], [], 0
        while at < len(data):
            cut = min(at + PIECE, len(data))
            while cut < len(data) and _IS_WORD[_LOWER[data[cut]]]:
                other = np.flatnonzero(~_IS_WORD[_LOWER[data[cut:cut + PIECE]]])
                cut = cut + int(other[0]) if len(other) else min(cut + PIECE, len(data))
            c, n, _ = word_codes(data[at:cut], np.array([0, 0, cut - at]))
            codes.append(c)
            sizes.append(n)
            at = cut
        return np.concatenate(codes), np.concatenate(sizes), np.array([sum(map(len, codes))])
    data = _LOWER[data]
    solid = _IS_WORD[data]
    begin, end = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1]
    end[:-1] &= ~solid[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begin[inner], end[inner - 1] = solid[inner], solid[inner - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    sizes = ends - starts
    if not len(starts):
        return np.zeros(0, _U32), sizes, counts
    at = np.flatnonzero(solid)
    after = np.repeat(ends, sizes) - 1 - at
    effect = _NEAR[np.minimum(after, SHORT), data[at]]
    codes = np.bitwise_xor.reduceat(effect, np.concatenate([[0], np.cumsum(sizes)[:-1]]))
    for i in np.flatnonzero(sizes > SHORT):
        codes[i] = zlib.crc32(data[starts[i]:ends[i]], _ALL) ^ _ALL
    return codes, sizes, counts


def _finished(code: np.ndarray, size: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of features from their registers (from 0) and lengths."""
    whole = code ^ advance(np.full(len(size), _ALL, _U32), size) ^ _U32(_ALL)
    return (whole % _U32(buckets)).astype(np.int64)


def feature_buckets(codes: np.ndarray, sizes: np.ndarray, counts: np.ndarray, buckets: int
                    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(first word's index, bucket) of all runs of 1 to 3 words of a row, block by block."""
    row_end = np.repeat(np.cumsum(counts), counts)
    blank = _NEAR[np.minimum(sizes, SHORT + 1), 32]
    long = np.flatnonzero(sizes > SHORT + 1)
    blank[long] = advance(np.full(len(long), _STEP[32], _U32), sizes[long])
    tail = blank ^ codes  # a blank and the word
    for lo in range(0, len(codes), WORDS):
        first = np.arange(lo, min(lo + WORDS, len(codes)))
        code, size = codes[first], sizes[first]
        yield first, _finished(code, size, buckets)
        for k in (1, 2):
            inside = first + k < row_end[first]
            first, code, size = first[inside], code[inside], size[inside]
            code = advance(code, sizes[first + k] + 1) ^ tail[first + k]
            size = size + 1 + sizes[first + k]
            yield first, _finished(code, size, buckets)


def _texts(batches, column: int):
    """(batch, row range, codes, sizes, counts) of the texts of a batch in slices."""
    for batch in batches:
        data, offsets = utf8(batch.column(column))
        for i, j in byte_slices(offsets, PIECE):
            yield batch, i, j, *word_codes(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])


def count_features(df: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket. Each task sends one row per bucket."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for _, _, _, codes, sizes, counts in _texts(batches, 0):
            for _, b in feature_buckets(codes, sizes, counts, buckets):
                total += np.bincount(b, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())],
                                         ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    rows = df.select(F.col(text_col).cast("string")).mapInArrow(count, "bucket int, n long")
    for bucket, n in rows.groupBy("bucket").agg(F.sum("n")).collect():  # at most ``buckets`` rows
        out[bucket] = n
    return out


def gains(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares of each bucket, rounded down."""
    n, t_all, s_all = len(raw), int(target.sum()), int(raw.sum())
    return np.array([math.floor(1000 * math.log(
        float(t + 1) * float(s_all + n) / (float(s + 1) * float(t_all + n))))
        for t, s in zip(target.tolist(), raw.tolist(), strict=True)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight) of each row: the sum of its features' gains."""

    def score(batches):
        for batch, i, j, codes, sizes, counts in _texts(batches, 1):
            each = np.zeros(len(codes), np.int64)
            for first, b in feature_buckets(codes, sizes, counts, len(gain)):
                each[first] += gain[b]
            upto = np.concatenate([[0], np.cumsum(each)])
            at = np.concatenate([[0], np.cumsum(counts)])
            n = counts.astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array(n),
                 pa.array(n + np.maximum(n - 1, 0) + np.maximum(n - 2, 0)),
                 pa.array(upto[at[1:]] - upto[at[:-1]])], ["id", "n_words", "n_features", "weight"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string")).mapInArrow(
        score, "id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variate of the id, rounded down."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256),
                           1, 8), 16, 10).cast("long")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def radix_rank(rows: DataFrame, keys: list[tuple[str, bool]], scratch: Scratch) -> DataFrame:
    """``rows`` with their place (0, 1, 2...) in the order of ``keys``, (column, descending) pairs
    of long columns, in the column ``_place``; nulls come last, equal keys in any order.

    A least-significant-digit radix sort. Every key is cut into digits of DIGIT_BITS bits; a pass
    is a stable counting sort of one digit: rows per (block of places, digit) are counted, prefix
    sums of the counts, first over digits and then over blocks, say where each block's rows of a
    digit go, and a row's rank in its block and digit completes its new place. Groups never hold
    more than a block's rows, so equal keys cannot make one hot. Each pass is written.
    """
    parts: list[Column] = []
    for name, down in keys:
        c = F.coalesce(F.col(name), F.lit(0))
        halves = [F.shiftright(c, 32), c.bitwiseAND(F.lit(0xFFFFFFFF))]
        parts += [F.col(name).isNull().cast("long"), *([-h for h in halves] if down else halves)]
    low_high = rows.agg(*[f(p).alias(f"{f.__name__}{i}") for i, p in enumerate(parts) for f in (F.min, F.max)]).first()
    cur = scratch.keep(rows.withColumn("_place", F.monotonically_increasing_id()), "radix-input")
    passes = [(part - F.lit(low_high[f"min{i}"] or 0).cast("long"), shift)
              for i, part in reversed(list(enumerate(parts)))
              for shift in range(0, ((low_high[f"max{i}"] or 0) - (low_high[f"min{i}"] or 0)).bit_length(), DIGIT_BITS)]
    for value, shift in passes or [(F.lit(0).cast("long"), 0)]:
        digit = F.shiftright(value, shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))
        rows = cur.withColumns({"_block": F.shiftright("_place", BLOCK_BITS), "_digit": digit})
        counts = rows.groupBy("_block", "_digit").agg(F.count(F.lit(1)).alias("_n"))
        # at most 2**DIGIT_BITS rows
        before = counts.groupBy("_digit").agg(F.sum("_n").alias("_n")).select("_digit", (F.sum("_n").over(
            Window.orderBy("_digit")) - F.col("_n")).alias("_base"))
        blocks = Window.partitionBy("_digit").orderBy("_block")
        starts = counts.withColumn("_start", F.sum("_n").over(blocks) - F.col("_n")).join(before, "_digit").select(
            F.col("_block").alias("_b"), F.col("_digit").alias("_d"), (F.col("_start") + F.col("_base")).alias("_start"))
        rank = F.row_number().over(Window.partitionBy("_block", "_digit").orderBy("_place"))
        moved = rows.withColumn("_rank", rank.cast("long")).join(
            starts, (F.col("_block") == F.col("_b")) & (F.col("_digit") == F.col("_d")))
        new = scratch.keep(moved.withColumn("_place", F.col("_start") + F.col("_rank") - 1).select(*cur.columns), "radix")
        scratch.drop(cur)
        cur = new
    return cur


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42,
             id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             buckets: int = BUCKETS) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) per row of ``docs``.

    Words are runs of ``0-9``, ``a-z`` and non-ASCII characters after lower-casing A-Z; features
    are all runs of 1 to 3 words. Of the N rows with at least ``min_words`` words the
    ``floor(percent * N / 100)`` highest scores are drawn and ranked from 1; others have a null
    rank. Null and empty texts have no features and weight 0. Ties go to the smaller id, null ids
    come last (and take the noise of an empty id); repeated rows are documents of their own. An
    empty table gives no rows, an empty target gains that favour rare buckets. Texts are read in
    pieces, so a very long one needs 20 bytes of memory a word. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession)
    gain = gains(count_features(target, target_col, buckets), count_features(docs, text_col, buckets))
    scored = weigh(docs, gain, id_col, text_col)
    scored = scratch.keep(scored.withColumn("score", F.col("weight") + noise(F.col("id"), seed)), "scored")
    able = scored.where(F.col("n_words") >= min_words)
    drawn = able.count() * percent // 100
    ranked = radix_rank(able, [("score", True), ("id", False)], scratch)
    out = ranked.withColumn("rank", F.when(F.col("_place") < drawn, F.col("_place") + 1)).drop("_place").unionByName(
        scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long")))
    scratch.close(scored, ranked)
    return out.withColumnRenamed("id", id_col)
