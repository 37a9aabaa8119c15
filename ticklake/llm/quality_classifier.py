"""Quality classifier by Bradley-Terry pairwise ranking.

Pairs of a better and a worse labelled document teach a linear score: the probability that
one beats the other is the logistic function of the difference of their scores, so the
weights are fitted by logistic loss on feature differences. The score's threshold is its
quantile at the share of worse documents among the labelled ones; a document's quality is
the logistic function of its distance to that threshold.

All labelled documents teach. Their feature vectors are dealt into blocks that hold both labels
(the rarer label's rows in several, if it needs be), every row is paired in each of its blocks,
and a Newton step adds up the blocks' gradients and curvatures.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ticklake.llm.common import PIECE, Scratch, byte_slices, piece_hashes, span_hashes, spans, utf8

SLICE_BYTES = 1 << 18
#: Preference pairs drawn among vectors that are at hand together.
PAIRS = 60_000
#: Rows of the commoner label in a block, of the rarer one at least (where there are so many),
#: and pairs in which a row of the commoner label stands.
BLOCK_ROWS = 2048
LEAST_ROWS = 256
DRAWS = 8
#: Newton steps at most, and ranges that a pass of the threshold's search counts.
STEPS = 25
RANGES = 4096
#: Classes of bytes (all others are 0).
CLASSES = ["other", "lower", "upper", "digit", "blank", "newline", "symbol", "bang", "stop", "quote"]
_CLASS = np.zeros(256, np.int64)
for _k, _set in enumerate([b"", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b" \t\r\v\f",
                           b"\n", b"#*$%&|<>", b"!?", b".,;:", b"\"'()[]{}-_/\\=+~^@`"]):
    _CLASS[list(_set)] = _k
_WIDE = len(CLASSES)  # bytes beyond ASCII
_CLASS[128:] = _WIDE


def _distinct(h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Number of distinct values of each row; sorts the rows in place."""
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        h[a:b].sort()
    new = np.ones(len(h), np.int64)
    new[1:] = h[1:] != h[:-1]
    new[starts[ends > starts]] = 1
    total = np.concatenate([[0], np.cumsum(new)])
    return total[ends] - total[starts]


def _windows(h: np.ndarray) -> np.ndarray:
    """Hashes of the windows of five words that begin at each word (the last four are partial)."""
    out = h.copy()
    for i in range(0, len(h), PIECE):
        w = out[i:i + PIECE]
        for k in range(1, 5):
            n = max(0, min(len(w), len(h) - i - k))
            w[:n] = (w[:n] * np.uint64(0x9E3779B97F4A7C15)) ^ h[i + k:i + k + n]
    return out


def _long_features(data: np.ndarray) -> np.ndarray:
    """``features`` of one long text, read in pieces: beyond the text itself, memory grows by
    two hashes a word and one a line."""
    counts = np.zeros(_WIDE + 1, np.int64)
    for i in range(0, len(data), PIECE):
        counts += np.bincount(_CLASS[data[i:i + PIECE]], minlength=_WIDE + 1)
    parts, odd_tail, lone = [], 0, 0
    for h, size, last in piece_hashes(data, lambda d: spans(d, np.zeros(1, np.int64)), False):
        parts.append(h)
        odd_tail += int(np.isin(_CLASS[last], (6, 7)).sum())
        lone += int(((size == 1) & (_CLASS[last] == 6)).sum())
    h = np.concatenate(parts)
    del parts
    words = len(h)
    adjacent = int((h[1:] == h[:-1]).sum())
    win = max(words - 4, 0)
    none, end = np.zeros(1, np.int64), np.ones(1, np.int64)
    distinct5 = _distinct(_windows(h)[:win], none, end * win)
    distinct = _distinct(h, none, end * words)
    del h

    def lines_of(d):
        ends = np.flatnonzero(d == 10) + 1
        if not len(ends) or ends[-1] < len(d):
            ends = np.append(ends, len(d))
        return np.concatenate([none, ends[:-1]]), ends

    lh = np.concatenate([x for x, _, _ in piece_hashes(data, lines_of, True)])
    lines = end * len(lh)
    return _combine(end * len(data), counts[None], end * words, end * adjacent, end * odd_tail, end * lone,
                    end * win, distinct, distinct5, lines, lines - _distinct(lh, none, lines))


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Features of whole texts: byte classes, words, repetition and lines (rows x features)."""
    if len(offsets) == 2 and len(data) > 2 * PIECE:
        return _long_features(data)
    n = len(offsets) - 1
    size = np.diff(offsets)
    owner = np.repeat(np.arange(n), size)
    counts = np.bincount(owner * (_WIDE + 1) + _CLASS[data], minlength=n * (_WIDE + 1)).reshape(n, -1)
    w_start, w_end = spans(data, offsets[:-1])
    rows = np.searchsorted(w_start, offsets)
    a, b = rows[:-1], rows[1:]
    words = b - a
    h = span_hashes(data, w_start, w_end)
    same = np.zeros(len(h), np.int64)
    same[1:] = h[1:] == h[:-1]
    same[a[words > 0]] = 0
    run = np.concatenate([[0], np.cumsum(same)])
    adjacent = run[b] - run[a]
    # a word that ends in a symbol or a bang
    tail = np.concatenate([[0], np.cumsum(np.isin(_CLASS[data[w_end - 1]], (6, 7)))])
    odd_tail = tail[b] - tail[a]
    lone = np.concatenate([[0], np.cumsum((w_end - w_start == 1) & (_CLASS[data[w_start]] == 6))])
    lone = lone[b] - lone[a]
    win = np.maximum(words - 4, 0)
    w5 = _windows(h)
    distinct = _distinct(h, a, b)
    distinct5 = _distinct(w5, a, a + win)
    # lines: a break ends one, so does a text's end
    ends = data == 10
    ends[offsets[1:][size > 0] - 1] = True
    l_end = np.flatnonzero(ends) + 1
    l_start = np.concatenate([[0], l_end[:-1]]) if len(l_end) else l_end
    lrow = np.searchsorted(l_start, offsets)
    lines = np.diff(lrow)
    lh = span_hashes(data, l_start, l_end)
    dup_lines = lines - _distinct(lh, lrow[:-1], lrow[1:])
    return _combine(size, counts, words, adjacent, odd_tail, lone, win, distinct, distinct5, lines, dup_lines)


def _combine(size, counts, words, adjacent, odd_tail, lone, win, distinct, distinct5, lines, dup_lines) -> np.ndarray:
    total = np.maximum(size, 1)
    w1, l1 = np.maximum(words, 1), np.maximum(lines, 1)
    letters = np.maximum(counts[:, 1] + counts[:, 2] + counts[:, _WIDE], 1)
    share = counts / total[:, None]
    upper, symbol, bang = counts[:, 2] / letters, share[:, 6], share[:, 7]
    repeat5 = (win - distinct5) / np.maximum(win, 1)
    out = [np.log1p(words), np.minimum(words, 10) / 10, (total - counts[:, 4] - counts[:, 5]) / w1, upper,
           np.sqrt(upper), symbol, np.sqrt(symbol), bang, np.sqrt(bang), share[:, 3], np.sqrt(share[:, 3]),
           share[:, 8], share[:, 9], share[:, _WIDE], share[:, 5], distinct / w1,
           distinct / w1 * np.log1p(words), repeat5, np.sqrt(repeat5), adjacent / w1,
           np.sqrt(adjacent / w1), dup_lines / l1, np.sqrt(dup_lines / l1), np.log1p(words / l1),
           odd_tail / w1, np.sqrt(odd_tail / w1), lone / w1, np.sqrt(lone / w1)]
    return np.stack(out, 1).astype(np.float64)


N_FEATURES = 28


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def score(self, x: np.ndarray) -> np.ndarray:
        u = _standard(x, self.mean, self.scale) @ self.weights
        return 1 / (1 + np.exp(-np.clip(u - self.threshold, -30, 30)))


def _standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale, -8, 8)


def _sums(d: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Of pair differences: their number, gradient and curvature of the logistic loss, flat."""
    p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
    return np.concatenate([[len(d)], d.T @ (1 - p), ((d * (p * (1 - p))[:, None]).T @ d).ravel()])


def _newton(sums, k: int, ridge: float) -> np.ndarray:
    """Weights of least logistic loss; ``sums(w)`` gives ``_sums`` over all pairs."""
    w = np.zeros(k)
    for _ in range(STEPS):
        total = sums(w)
        grad = total[1:k + 1] / total[0] - ridge * w
        hess = total[k + 1:].reshape(k, k) / total[0] + ridge * np.eye(k)
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(x: np.ndarray, y: np.ndarray, share_worse: float, pairs: int = PAIRS, ridge: float = 1e-3) -> Model:
    """Bradley-Terry weights of features ``x`` and labels ``y`` (1: better)."""
    mean, scale = (x.mean(0), x.std(0)) if len(x) else (np.zeros(N_FEATURES), np.ones(N_FEATURES))
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = _standard(x, mean, scale)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):  # nothing to prefer: every score is 0.5
        return Model(mean, scale, np.zeros(N_FEATURES), 0.0)
    rng = np.random.default_rng(11)
    d = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    w = _newton(lambda w: _sums(d, w), d.shape[1], ridge)
    # the quantile of the scores at the share of worse documents, each label by its share
    u = np.concatenate([z[bad] @ w, z[good] @ w])
    mass = np.concatenate([np.full(len(bad), share_worse / len(bad)),
                           np.full(len(good), (1 - share_worse) / len(good))])
    order = np.argsort(u, kind="stable")
    at = int(np.searchsorted(np.cumsum(mass[order]), share_worse))
    at = min(at, len(u) - 1)
    nxt = min(at + 1, len(u) - 1)
    return Model(mean, scale, w, float((u[order[at]] + u[order[nxt]]) / 2))


def _vectors(batches):
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for i, j in byte_slices(offsets, SLICE_BYTES):
            x = features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            flat = pa.array(x.ravel())
            at = pa.array(np.arange(0, x.size + 1, N_FEATURES, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(at, flat)], ["_id", "x"])


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of feature lists as rows x features."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)


def _blocks(rows: DataFrame, n: dict[int, int]) -> DataFrame:
    """(block, bad, good): the vectors of ``rows`` by label, float64. A row of the commoner label
    is in one block; one of the rarer label in as many as give each block LEAST_ROWS of it, so
    that far more rows than BLOCK_ROWS never meet."""
    rare = 0 if n[0] <= n[1] else 1
    count = -(-n[1 - rare] // BLOCK_ROWS)
    times = min(count, -(-count * LEAST_ROWS // n[rare]))
    first = F.pmod(F.xxhash64("_id", "x", F.lit(17)), F.lit(count))
    dealt = rows.withColumn("block", F.explode(F.when(F.col("_y") == rare, F.transform(
        F.sequence(F.lit(0), F.lit(times - 1)), lambda k: F.pmod(first + k, F.lit(count)))).otherwise(F.array(first))))

    def pack(key, table):
        x = _matrix(table["x"].combine_chunks())
        y = table["_y"].to_numpy()
        x, y = (v[np.lexsort(x.T)] for v in (x, y))  # the same block whatever the order of its rows
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()),
                         **{c: pa.array([x[y == k].tobytes()], pa.binary()) for k, c in enumerate(("bad", "good"))}})

    return dealt.select("block", "_y", "x").groupBy("block").applyInArrow(pack, "block long, bad binary, good binary")


def _differences(block: int, bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Good less bad vectors of a block's pairs; every row stands in a pair, in about as many as
    the others of its label."""
    rng = np.random.default_rng([11, block])
    pairs = DRAWS * max(len(bad), len(good)) if len(bad) and len(good) else 0

    def side(z):
        return z[np.concatenate([rng.permutation(len(z)) for _ in range(-(-pairs // len(z)))])[:pairs]] if pairs else z[:0]

    return side(good) - side(bad)


def _block_sums(blocks: DataFrame, mean: np.ndarray, scale: np.ndarray, w: np.ndarray) -> np.ndarray:
    """``_sums`` over the pairs of all blocks; a task gives one row of a fixed size."""
    def run(batches):
        total = np.zeros(1 + N_FEATURES + N_FEATURES ** 2)
        for batch in batches:
            for k in range(batch.num_rows):
                bad, good = (_standard(np.frombuffer(batch.column(c)[k].as_buffer()).reshape(-1, N_FEATURES), mean, scale)
                             for c in (1, 2))
                total += _sums(_differences(batch.column(0)[k].as_py(), bad, good), w)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["sums"])

    got = blocks.select("block", "bad", "good").mapInArrow(run, "sums array<double>").collect()
    return np.sum([r["sums"] for r in got], 0)


def _moments(rows: DataFrame) -> tuple[dict[int, int], np.ndarray, np.ndarray]:
    """Number of rows of each label, mean and scale of the features; a task gives one row."""
    def run(batches):
        n, mean, m2 = [0, 0], np.zeros(N_FEATURES), np.zeros(N_FEATURES)
        for batch in batches:
            x, y = _matrix(batch.column(1)), batch.column(0).to_numpy()
            if len(x):
                mean, m2 = _merge(sum(n), mean, m2, len(x), x.mean(0), x.var(0) * len(x))
                n = [n[0] + int((y == 0).sum()), n[1] + int((y == 1).sum())]
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.list_(pa.float64())) for v in ([*map(float, n)], mean, m2)],
                                         ["n", "mean", "m2"])

    n, mean, m2 = np.zeros(2), np.zeros(N_FEATURES), np.zeros(N_FEATURES)
    for r in rows.select("_y", "x").mapInArrow(run, "n array<double>, mean array<double>, m2 array<double>").collect():
        if sum(r["n"]):
            mean, m2 = _merge(n.sum(), mean, m2, sum(r["n"]), np.array(r["mean"]), np.array(r["m2"]))
            n += r["n"]
    scale = np.sqrt(m2 / max(n.sum(), 1))
    return {k: int(n[k]) for k in (0, 1)}, mean, np.where(scale > 1e-9, scale, 1.0)


def _merge(n, mean, m2, n_more, mean_more, m2_more):
    """Mean and sum of squared deviations of two sets together."""
    step = mean_more - mean
    both = n + n_more
    return mean + step * n_more / both, m2 + m2_more + step ** 2 * n * n_more / both


def _quantile(scores: DataFrame, n: dict[int, int], share: float) -> float:
    """The exact quantile at ``share`` of (``_y``, ``u``), the mass of label 0 being ``share``: halfway
    between the value that reaches it and the next. A pass counts RANGES ranges of the values
    and the next one looks into one of them, so no list of values leaves the executors."""
    mass = [share / n[0], (1 - share) / n[1]]
    low, high = scores.agg(F.min("u"), F.max("u")).first()
    below = 0.0
    while True:
        place = F.least(F.floor((F.col("u") - low) / (high - low) * RANGES), F.lit(RANGES - 1)) if low < high else F.lit(0)
        ranges = scores.where(F.col("u").between(low, high)).groupBy(place.alias("r")).agg(
            F.count_if(F.col("_y") == 0).alias("bad"), F.count_if(F.col("_y") == 1).alias("good"),
            F.min("u").alias("low"), F.max("u").alias("high")).collect()
        for k, r in enumerate(sorted(ranges, key=lambda r: r["r"]), 1):
            reached = below + r["bad"] * mass[0] + r["good"] * mass[1]
            if reached >= share - 1e-12 or k == len(ranges):
                break
            below = reached
        low, high = r["low"], r["high"]
        if low == high:
            break
    last = mass[1] if r["good"] else mass[0]
    above = scores.where(F.col("u") > high).agg(F.min("u")).first()[0] if reached - last < share - 1e-12 else None
    return (high + (high if above is None else above)) / 2


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", ridge: float = 1e-3) -> Model:
    """Fit on all documents of ``docs`` that ``labels`` marks 0 or 1. Texts are not shuffled: their
    vectors meet the labels, are written once and read by every Newton step."""
    scratch = Scratch(docs.sparkSession)
    known = labels.where(F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
    listed = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    kind = docs.schema[id_col].dataType.simpleString()
    vectors = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).where("_id is not null").mapInArrow(
        _vectors, f"_id {kind}, x array<double>")
    # a shuffle join at every size: labels grow with the documents
    rows = scratch.keep(vectors.join(known.distinct().hint("merge"), "_id"), "vectors")
    n, mean, scale = _moments(rows)
    if not n[0] or not n[1]:  # nothing to prefer: every score is 0.5
        scratch.close()
        return Model(mean, scale, np.zeros(N_FEATURES), 0.0)
    blocks = scratch.keep(_blocks(rows, n), "blocks")
    w = _newton(lambda w: _block_sums(blocks, mean, scale, w), N_FEATURES, ridge)

    def score(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_standard(_matrix(batch.column(1)), mean, scale) @ w)], ["_y", "u"])

    scores = rows.select("_y", "x").mapInArrow(score, "_y int, u double")
    threshold = _quantile(scores, n, listed[0] / (listed[0] + listed[1]))
    scratch.close()
    return Model(mean, scale, w, float(threshold))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if score >= 0.5).

    Null texts are empty texts; an empty text has features of its own (no words) and so a
    score. Without labels of both kinds all scores are 0.5. Equal texts have equal scores.
    A column of ``docs`` that is named like a result is replaced; others pass through.
    """
    docs = docs.drop("score", "predicted")
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            parts = [model.score(features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]))
                     for i, j in byte_slices(offsets, SLICE_BYTES)]
            score = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())],
                                             [*batch.schema.names, "score"])

    schema = StructType([*docs.schema.fields, StructField("score", DoubleType())])
    return docs.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
