"""Document fingerprints: one-permutation MinHash with optimal densification, b-bit packed.

Each five-word shingle is hashed once. The hash's top bits deal it to one of BINS bins and
the smallest hash of a bin stands for it. An empty bin borrows from a filled one, found on
a random walk of its own over the bins (a start and an odd stride per bin). The low BITS
bits of each bin's value, hashed once more with the bin so that a value borrowed by many
bins is not one coin for them all, are stored as one hexadecimal digit a bin; equal digits
of two fingerprints estimate the Jaccard similarity once the chance agreement of 2**-BITS is taken out.
DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import Scratch, let, words

BINS = 256
BITS = 4
SHINGLE = 5
#: Bins tried one by one, from tables, before blocks of a walk are laid out.
TRIES = 24
#: Under so many filled bins an empty one looks at them instead of walking.
FEW = 10
#: Documents of one range of ids, about.
RANGE_ROWS = 1000

_LOW = 64 - int(math.log2(BINS))
_EMPTY = (1 << _LOW) - 1
_walk = np.random.default_rng(99)
_START = _walk.integers(0, BINS, BINS).tolist()
_STRIDE = (_walk.integers(0, BINS // 2, BINS) * 2 + 1).tolist()


def constant(values: list) -> Column:
    """A constant array: the optimizer folds it into one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """Hashes of the word shingles of a lower-cased text; with fewer words its whole
    sequence is one, without words there is none."""
    def of(h: Column) -> Column:
        n = F.size(h)
        windows = F.transform(F.sequence(F.lit(0), F.greatest(n - size, F.lit(0))),
                              lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)]))
        return F.when(n >= size, windows).otherwise(F.transform(F.slice(h, 1, 1), lambda x: F.xxhash64(h)))
    return let(F.transform(words(F.lower(text)), lambda x: F.xxhash64(x)), of)


def _sorted(text: Column, size: int = SHINGLE) -> Column:
    """The shingles' hashes and each bin's largest value, _EMPTY, in order: of all bins, signed.
    No element can be null, so compiled code sorts plain longs."""
    half = BINS // 2
    largest = F.array(*[F.lit(b << _LOW | _EMPTY).cast("bigint") for b in range(-half, half)])
    return F.sort_array(F.concat(shingle_hashes(F.coalesce(text, F.lit("")), size), largest))


def _all_bins(s: Column) -> Column:
    """The smallest hash of each bin, without the bin's number; null where none fell."""
    least = F.filter(s, lambda x, k: ~F.shiftright(x, _LOW).eqNullSafe(F.shiftright(F.get(s, k - 1), _LOW)))
    return F.transform(least, lambda x: F.when(
        x.bitwiseAND(F.lit(_EMPTY)) != _EMPTY, x.bitwiseAND(F.lit(_EMPTY))))


def _densified(v: Column, use: Callable[[Column, Column], Column]) -> Column:
    """``use(value, bin)`` of each bin, an empty one with the value of the first filled bin on its walk."""
    def of(start: Column, stride: Column, turn: Column, filled: Column) -> Column:
        def at(b: Column, t: Column) -> Column:
            return F.get(v, (F.get(start, b) + t * F.get(stride, b)).bitwiseAND(F.lit(BINS - 1)))

        def stepped(x: Column, b: Column) -> Column:
            # tries one by one, then in blocks of doubling size: about BINS / size(filled) are needed
            ends = [TRIES]
            while ends[-1] < BINS:
                ends.append(min(2 * ends[-1], BINS))
            tries = [F.get(v, F.get(integers([(i + t * s) % BINS for i, s in zip(_START, _STRIDE)]), b)) for t in range(TRIES)]
            blocks = [F.get(F.filter(F.transform(F.sequence(F.lit(i), F.lit(j - 1)), lambda t: at(b, t)),
                                     lambda y: y.isNotNull()), F.lit(0)) for i, j in zip(ends, ends[1:])]
            return use(F.coalesce(x, *tries, *blocks), b)

        def ranked(x: Column, b: Column) -> Column:
            # the step at which the walk meets each filled bin; the least counts
            steps = F.transform(filled, lambda f: (
                (f - F.get(start, b)) * F.get(turn, b)).bitwiseAND(F.lit(BINS - 1)))
            return use(F.coalesce(x, at(b, F.array_min(steps))), b)

        return F.when(F.size(filled) < FEW, F.transform(v, ranked)).otherwise(F.transform(v, stepped))

    def integers(values: list[int]) -> Column:
        return constant(values).cast("array<int>")

    filled = F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.get(v, b).isNotNull())
    return let(integers(_START), lambda start: let(integers(_STRIDE), lambda stride: let(
        integers([pow(s, -1, BINS) for s in _STRIDE]), lambda turn: let(filled, lambda f: of(start, stride, turn, f)))))


def _digits(s: Column) -> Column:
    """The fingerprint from what ``_sorted`` gives."""
    hexadecimal = F.split(F.lit(",".join("0123456789abcdef")), ",")

    def of(v: Column) -> Column:
        return _densified(v, lambda x, b: F.get(
            hexadecimal, F.xxhash64(x, b).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")))
    return F.when(F.size(s) > BINS, F.array_join(let(let(s, _all_bins), of), "")).otherwise(F.lit(""))


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    """The fingerprint of a text as BINS hexadecimal digits; '' without words or text."""
    return let(_sorted(text, size), _digits)


def with_fingerprint(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """``df`` with the fingerprint of a text column. In two steps, as two uses of a column keep
    the optimizer from joining them: the sort is then compiled, inside a lambda it is not."""
    return (df.withColumn(f"{name}_sorted", _sorted(F.col(text_col)))
            .withColumn(name, _digits(F.col(f"{name}_sorted"))).drop(f"{name}_sorted"))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints, chance agreement taken out; of two
    empty ones 1, of an empty and another 0."""
    def bits(fp: Column, i: Column) -> Column:
        return F.conv(F.substring(fp, i, F.lit(16)), 16, -10).cast("bigint")

    def unlike(x: Column) -> Column:  # digits that are not zero: their bits meet in the lowest
        return let(x.bitwiseOR(F.shiftright(x, 1)), lambda y: F.bit_count(
            y.bitwiseOR(F.shiftright(y, 2)).bitwiseAND(F.lit(0x1111111111111111))))

    differ = F.aggregate(F.sequence(F.lit(1), F.lit(BINS), F.lit(16)), F.lit(0), lambda n, i: n + let(
        bits(a, i).bitwiseXOR(bits(b, i)), unlike))
    same = (F.lit(BINS) - differ) / F.lit(float(BINS))
    chance = 2.0 ** -BITS
    return (F.when(a == b, F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0))
            .otherwise(F.greatest(F.lit(0.0), (same - chance) / (1 - chance))))


def _range_of(key: Column, cuts: list[int]) -> Column:
    """How many of the sorted cuts lie below the key, found in two steps; -1 for null. A long:
    joins on it then meet the partitioning that a window over it has."""
    if not cuts:
        return F.when(key.isNull(), F.lit(-1)).otherwise(F.lit(0)).cast("long")
    m = math.isqrt(len(cuts)) + 1
    whole, heads = constant(cuts), constant(cuts[::m])
    fine = let(F.size(F.filter(heads, lambda c: c < key)), lambda i: F.when(i == 0, F.lit(0)).otherwise(
        (i - 1) * m + F.size(F.filter(F.slice(whole, (i - 1) * m + 1, F.lit(m)), lambda c: c < key))))
    return F.when(key.isNull(), F.lit(-1)).otherwise(fine).cast("long")


def with_next(docs: DataFrame, scratch: Scratch, id_col: str, text_col: str,
              range_rows: int = RANGE_ROWS) -> DataFrame:
    """(id, text, fingerprint, next_text, next_fingerprint) in descending order of the ids.

    Ranges of ids between quantiles are sorted one by one; each range's last document gets
    its next one from the following range's first, of which there is one text a range.
    Rows with one id follow each other by their texts; null ids come last.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    ids = rows.select("id")
    ranges = min(1_000_000, max(1, ids.count() // range_rows))
    cuts: list[int] = []
    if ranges > 1:
        # ranges differ by a tenth of their rows at most; one task merges what this keeps
        at = ids.agg(F.percentile_approx("id", [k / ranges for k in range(1, ranges)],
                                           min(10 * ranges, 10_000_000))).first()[0]
        cuts = sorted(set(at or []))
    dealt = rows.withColumn("g", _range_of(F.col("id"), cuts))
    # one row for each range
    first = ids.withColumn("g", _range_of(F.col("id"), cuts)).groupBy("g").agg(F.max("id").alias("id"))
    tops = sorted(((r["g"], r["id"]) for r in first.collect()), reverse=True)
    if not tops:
        return rows.select("id", "text", F.lit("").alias("fp"), "text", F.lit("")).toDF(
            "id", "text", "fp", "next_text", "next_fp")
    after = [(tops[k - 1][0], g, i) for k, (g, i) in enumerate(tops)]  # the last's next is the first
    link = spark.createDataFrame(after, "g long, top_g long, top long")
    head = (dealt.join(F.broadcast(link), (dealt["g"] == link["top_g"]) & dealt["id"].eqNullSafe(link["top"]))
            .groupBy(link["g"]).agg(F.min("text").alias("head_text")))
    head = scratch.keep(with_fingerprint(head, "head_text", "head_fp"), "heads")
    order = Window.partitionBy("g").orderBy(F.desc_nulls_last("id"), "text")
    return (with_fingerprint(dealt, "text", "fp")
            .withColumn("own_next", F.lead("text").over(order))
            .withColumn("own_fp", F.lead("fp").over(order))
            .join(head, "g", "left")
            .select("id", "text", "fp", F.coalesce("own_next", "head_text").alias("next_text"),
                    F.coalesce("own_fp", "head_fp").alias("next_fp")))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likenesses.

    The edited text has the last half (rounded down) of the code points replaced by the
    first as many, or all, of the next document's. Null texts are empty; an empty text has
    the fingerprint '' and stays empty when edited. Equal texts have equal fingerprints. A
    single document is its own next. Repeated rows and null ids: see ``with_next``. Other
    columns of ``docs`` are not read; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession)
    pairs = with_next(docs, scratch, id_col, text_col)
    half = F.expr("n_chars div 2").cast("int")
    out = with_fingerprint(pairs.withColumn("n_chars", F.length("text").cast("long"))
                           .withColumn("edited", F.concat(
                               F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
                               F.substring("next_text", F.lit(1), half))), "edited", "edited_fp")
    return out.select(
        F.col("id").alias(id_col), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        F.col("fp").alias("fingerprint"), F.col("edited_fp").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
