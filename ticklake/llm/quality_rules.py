"""Quality rules: base rules and a hashed n-gram log-likelihood ratio.

The words and word pairs of a text are hashed into buckets. Two multinomials over the
buckets are counted, one over all documents and one over trusted ones; a text's score is
the mean of log(trusted / raw) over its n-grams. The number of buckets grows with the text;
three quarters of the trusted documents teach the counts, and the others' scores set the
threshold: the value that all but a small share of them reach. Neither drifts with the size
of the corpus. Everything is DataFrame functions; a text's own statistics are array functions
on its row, and only bucket counts are shuffled.
"""

from __future__ import annotations

import math

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import let, words

#: Bits of the number of buckets, at least and at most (the table of weights goes through the driver to every
#: task: half a MB at most), and bytes of text for each bucket in between.
BITS = (13, 16)
BYTES_PER_BUCKET = 64
#: Share of the held-out trusted documents that may fall under the threshold, and how much the
#: mean of a text of one word may stray by chance (less with the root of the number of words).
LOST = 0.005
STRAY = 0.2
#: Steps of the threshold; ids of trusted documents up to which they are broadcast (a checked size).
STEP = 0.001
BROADCAST_IDS = 2_000_000
#: Words of a window, fixed by the rule on repetition.
WINDOW = 5
SYMBOLS = "#*$%&|<>"


def word_hashes(text: Column) -> Column:
    """The hashes of a text's words in order."""
    return F.transform(words(text), lambda x: F.xxhash64(x))


def _repeat_words(h: Column) -> Column:
    """Words (given by their hashes) that lie in a five-word window found twice or more, first ones
    included."""
    n = F.size(h)
    hashes = F.transform(F.sequence(F.lit(0), n - WINDOW),
                         lambda i: F.xxhash64(h[i], h[i + 1], h[i + 2], h[i + 3], h[i + 4]))

    def covered(h: Column) -> Column:
        # equal windows stand together once sorted; their positions in order then cover
        # five words each, less what the one before has covered
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = let(pairs, lambda s: F.filter(s, lambda x, k: (
            (k > 0) & (F.get(s, k - 1)["h"] == x["h"]))
            | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))))
        at = F.sort_array(F.transform(twice, lambda x: x["i"]))
        return let(at, lambda p: F.aggregate(F.transform(p, lambda x, k: F.when(
            k == 0, F.lit(WINDOW)).otherwise(F.least(F.lit(WINDOW), x - F.get(p, k - 1)))),
            F.lit(0), lambda a, x: a + x))

    counted = let(hashes, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    return F.when(n < WINDOW + 1, F.lit(0)).otherwise(counted).cast("long")


def base_columns(text: Column, hashes: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text (null: none) whose
    words have ``hashes``."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^ \\t-\\r]"))
    return {
        "n_words": F.size(hashes).cast("long"),
        "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": let(hashes, _repeat_words),
    }


def grams(hashes: Column, buckets: int) -> Column:
    """Buckets (a power of two) of the words and word pairs of a text whose words have ``hashes``."""
    low = F.lit(buckets - 1).cast("long")

    def of(h: Column) -> Column:
        rest = F.greatest(F.size(h) - 1, F.lit(0))
        pairs = F.zip_with(F.slice(h, F.lit(1), rest), F.slice(h, F.lit(2), rest),
                           lambda a, b: F.xxhash64(a, b).bitwiseAND(low))
        return F.concat(F.transform(h, lambda x: x.bitwiseAND(low)), pairs)
    return let(hashes, of)


def bucket_count(docs: DataFrame, text_col: str = "text") -> int:
    """A power of two in proportion to the bytes of text."""
    total = docs.agg(F.sum(F.octet_length(F.col(text_col)).cast("long"))).first()[0] or 0
    return 1 << min(max((total // BYTES_PER_BUCKET).bit_length(), BITS[0]), BITS[1])


def _with_trusted(docs: DataFrame, trusted_ids: DataFrame, id_col: str, text_col: str, how: str) -> DataFrame:
    """(_t, _trusted) of ``docs``; ids of trusted documents are broadcast up to a checked number and
    meet the documents in a shuffle join beyond it."""
    ids = trusted_ids.select(F.col(id_col).alias("_trusted")).where("_trusted is not null").distinct()
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids.hint("merge")
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).join(
        ids, F.col("_id") == F.col("_trusted"), how).drop("_id")


def fit_weights(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id",
                text_col: str = "text", buckets: int | None = None) -> list[float]:
    """log(trusted / raw) of each bucket, both smoothed by one count.

    The raw counts cover all documents, the trusted counts all documents whose id is in the
    column ``id_col`` of ``trusted_ids``. Without trusted documents all weights are 0 (nothing
    is rejected).
    """
    buckets = buckets or bucket_count(docs, text_col)
    flagged = _with_trusted(docs, trusted_ids, id_col, text_col, "left").select(
        F.col("_trusted").isNotNull().cast("long").alias("good"), grams(word_hashes(F.col("_t")), buckets).alias("g"))
    # at most ``buckets`` rows
    counted = (flagged.select("good", F.explode("g").alias("bucket"))
               .groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("good").alias("good")).collect())
    raw, good = [1] * buckets, [1] * buckets
    for r in counted:
        raw[r["bucket"]] += r["raw"]
        good[r["bucket"]] += r["good"]
    if sum(good) == buckets:
        return [0.0] * buckets
    shift = math.log(sum(raw) / sum(good))
    return [math.log(g / r) + shift for g, r in zip(good, raw, strict=True)]


@dataclass(frozen=True)
class Rules:
    """Weights of the buckets and the threshold of a text's mean weight."""

    weights: list[float]
    threshold: float


def _adjusted(llr: Column, n_words: Column, stray: float) -> Column:
    """The ratio in steps, with what a short text's mean may stray by chance."""
    return F.floor(F.round((llr + stray / F.sqrt(n_words)) / STEP, 6)).cast("long")


def fit(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        buckets: int | None = None, lost: float = LOST, stray: float = STRAY) -> Rules:
    """Weights from three quarters of the trusted documents (by a hash of the id), the threshold from
    the last quarter, of which at most a share ``lost`` is under it. Without that quarter nothing
    is rejected."""
    quarter = F.pmod(F.xxhash64(F.col(id_col), F.lit(41)), F.lit(4))
    weights = fit_weights(docs, trusted_ids.where(quarter != 1), id_col, text_col, buckets)
    judged = _with_trusted(docs, trusted_ids.where(quarter == 1), id_col, text_col, "inner").select(
        word_hashes(F.col("_t")).alias("h")).select(
        score_column(F.col("h"), weights).alias("llr"), F.size("h").alias("n")).where("n > 0")
    # one row per step of the score: some thousands
    steps = judged.groupBy(_adjusted(F.col("llr"), F.col("n"), stray).alias("step")).count().orderBy("step").collect()
    spare, threshold = math.floor(lost * sum(r["count"] for r in steps)), -math.inf
    for r in steps:
        if spare < r["count"]:
            threshold = r["step"] * STEP
            break
        spare -= r["count"]
    return Rules(weights, threshold)


def score_column(hashes: Column, weights: list[float]) -> Column:
    """Mean weight of the n-grams of a text whose words have ``hashes``; null without words."""
    # a foldable list: the optimizer makes one constant array of it
    table = F.split(F.lit(",".join(f"{w:.5f}" for w in weights)), ",").cast("array<double>")
    return let(grams(hashes, len(weights)), lambda g: F.when(F.size(g) > 0, F.aggregate(
        g, F.lit(0.0), lambda a, b: a + table[b]) / F.size(g)))


def judge(docs: DataFrame, rules: Rules, text_col: str = "text", stray: float = STRAY, min_words: int = 10,
          most_repeat: int = 20) -> DataFrame:
    """``docs`` with the base columns, ``base_failed``, ``llr`` and ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or over ``most_repeat`` percent of the
    words in repeated windows. ``kept``: not base_failed and
    ``llr + stray / sqrt(n_words) >= threshold``. Null, empty and blank texts have no words, so
    they fail. Repeated rows get equal results. A column of ``docs`` that is named like a result
    is replaced; others pass through.
    """
    text = F.col(text_col)
    # split and hashed once: a column that several others use stays a projection of its own
    h = F.col("_word_hashes")
    out = docs.withColumn("_word_hashes", word_hashes(text))
    out = out.withColumns({**base_columns(text, h), "llr": score_column(h, rules.weights)}).drop("_word_hashes")
    out = out.withColumn("base_failed", (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > most_repeat * F.col("n_words")))
    least = round(rules.threshold / STEP) if rules.threshold > -math.inf else -(1 << 62)
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(
        _adjusted(F.col("llr"), F.col("n_words"), stray) >= least, F.lit(False)))
