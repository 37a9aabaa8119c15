"""MinHash near-duplicate detection.

Signatures of MINIMA universal hash minima over the distinct word shingles of each whole
text; documents with equal shingle sets are one class; classes meet in band buckets, whose
rows follow from the similarity asked for; pairs pass a check of their signatures and then an exact one of their full shingle sets,
and links become components by large-star and small-star.

Within a bucket no pairs are listed. A member is first checked against one class, the
smallest that any of its buckets holds. Members that lie outside the component of their
bucket's smallest class are then a query set, held in blocks against all members of the
bucket; only links leave a block, so no link is lost and no list of pairs is made.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import Scratch, byte_slices, mix, utf8, word_hashes
from ticklake.llm.components import components

MINIMA = 125
#: Greatest probability that a pair at the least similarity meets in no bucket.
MISS = 1e-4
#: Agreeing minima (a share) below which two signatures cannot belong to a link: 4.5
#: standard deviations under the threshold.
SLACK = 4.5
SLICE_BYTES = 1 << 18
#: Shingles of the members and of the queries of one block, about.
BLOCK_SHINGLES = 1 << 16
QUERY_SHINGLES = 1 << 18

_rng = np.random.default_rng(20240229)
_A = _rng.integers(1, 1 << 63, MINIMA, np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, MINIMA, np.uint64) * np.uint64(2)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted in the row, and their counts.

    A row with fewer words than ``size`` has its whole sequence as its one shingle; a row
    without words has none.
    """
    h, counts = word_hashes(data, offsets)
    rows = len(counts)
    n_sh = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    ends = np.cumsum(counts)
    starts = ends - counts
    sh_ends = np.cumsum(n_sh)
    sh_starts = sh_ends - n_sh
    # position of each shingle's first word; a short row's span is all its words
    first = np.arange(int(n_sh.sum())) + np.repeat(starts - sh_starts, n_sh)
    length = np.repeat(np.minimum(counts, size), n_sh)
    out = length.astype(np.uint64)
    for k in range(size):
        has = length > k
        if has.all():
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[first + k])
        else:
            out[has] = mix(out[has] * np.uint64(0x9E3779B97F4A7C15) + h[first[has] + k])
    for i in range(rows):
        out[sh_starts[i]:sh_ends[i]].sort()
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[sh_starts[n_sh > 0]] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    return out[new], kept[sh_ends] - kept[sh_starts]


def signatures(x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """uint32 minima (rows x MINIMA) of multiply-shift hashes; all ones for no shingle."""
    out = np.full((len(counts), len(_A)), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(counts)
    if len(full):
        starts = (np.cumsum(counts) - counts)[full]
        x32 = x >> np.uint64(32)
        buf = np.empty_like(x32)
        for k in range(len(_A)):
            np.multiply(x32, _A[k], out=buf)
            buf += _B[k]
            out[full, k] = np.minimum.reduceat(buf, starts) >> np.uint64(32)
    return out


def _sign(size: int):
    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in byte_slices(offsets, SLICE_BYTES):
                part = data[offsets[i]:offsets[j]]
                x, counts = shingle_sets(part, offsets[i:j + 1] - offsets[i], size)
                ends = np.cumsum(counts)
                sums = np.concatenate([[0], np.cumsum(x, dtype=np.uint64)]).astype(np.uint64)
                xors = np.concatenate([[0], np.bitwise_xor.accumulate(mix(x))]).astype(np.uint64)
                sig = signatures(x, counts)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.array(counts, pa.int64()),
                    pa.array((sums[ends] - sums[ends - counts]).view(np.int64)),
                    pa.array((xors[ends] ^ xors[ends - counts]).view(np.int64)),
                    pa.array([s.tobytes() for s in sig], pa.binary()),
                ], ["id", "n", "d1", "d2", "sig"])
    return run


def banding(percent: int) -> tuple[int, int]:
    """Bands and rows a band: the most rows with which a pair of similarity ``percent`` / 100 is
    missed with a probability of at most MISS (25 x 5 at 80, 62 x 2 at 50)."""
    for rows in range(MINIMA, 0, -1):
        if (1 - (percent / 100) ** rows) ** (MINIMA // rows) <= MISS:
            return MINIMA // rows, rows
    raise ValueError(f"{MINIMA} minima do not find pairs of {percent} percent")


def band_keys(sig: np.ndarray, bands: int = 25, rows: int = 5) -> np.ndarray:
    """One 64-bit key per row and band."""
    weights = np.random.default_rng(5).integers(0, 1 << 63, (bands, rows), np.uint64) * np.uint64(2) + np.uint64(1)
    cut = (sig[:, :bands * rows].reshape(len(sig), bands, rows).astype(np.uint64) * weights).sum(2)
    return mix(cut + np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _bands(bands: int, rows: int):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                raw, n = _fixed(batch.column(1))
                key = band_keys(raw.reshape(n, -1), bands, rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), bands)),
                     pa.array(key.ravel().view(np.int64))], ["id", "bucket"])
    return run


def _fixed(col: pa.Array) -> tuple[np.ndarray, int]:
    col = col.cast(pa.large_binary())
    at = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2], np.uint8)[at[0]:at[-1]].view(np.uint32), len(col)


def _agree(most_off: float):
    """Pairs whose signatures agree in at least the given share of their minima."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, n = _fixed(batch.column(2))
            b, _ = _fixed(batch.column(3))
            same = (a.reshape(n, -1) == b.reshape(n, -1)).mean(1)
            yield batch.select([0, 1]).filter(pa.array(same >= most_off))
    return run


def _sets(size: int):
    """Shingle sets as sorted hashes."""
    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in byte_slices(offsets, SLICE_BYTES):
                part = data[offsets[i]:offsets[j]]
                x, counts = shingle_sets(part, offsets[i:j + 1] - offsets[i], size)
                at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i),
                     pa.ListArray.from_arrays(pa.array(at), pa.array(x.view(np.int64)))], ["id", "s"])
    return run


def _flat(col: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and row lengths of a list column."""
    lens = np.concatenate([np.diff(c.offsets.to_numpy()) for c in col.chunks])
    return np.concatenate([c.flatten().to_numpy() for c in col.chunks]), lens


def _block_links(percent: int):
    """Links between the queries and the members of one block of a bucket that lie in
    different components."""
    def run(table: pa.Table) -> pa.Table:
        ids, comp = table.column("id").to_numpy(), table.column("c").to_numpy()
        query = table.column("query").to_numpy()
        values, lens = _flat(table.column("s"))
        _, code = np.unique(values, return_inverse=True)
        ends = np.cumsum(lens)
        m = np.flatnonzero(~query)
        u, v = [], []
        if len(m):
            member = np.concatenate([code[ends[k] - lens[k]:ends[k]] for k in m])
            starts = np.cumsum(lens[m]) - lens[m]
            has = np.zeros(int(code.max()) + 1, np.int32)
            for q in np.flatnonzero(query):
                may = (comp[m] != comp[q]) & (100 * np.minimum(lens[m], lens[q]) >= percent * np.maximum(lens[m], lens[q]))
                if may.any():
                    own = code[ends[q] - lens[q]:ends[q]]
                    has[own] = 1
                    common = np.add.reduceat(has[member], starts)
                    has[own] = 0
                    hit = m[may & (100 * common >= percent * (lens[m] + lens[q] - common))]
                    u += [ids[q]] * len(hit)
                    v += ids[hit].tolist()
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 5, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row of ``docs``.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Two documents are
    linked when ``100 * intersection >= percent * union`` of their shingle sets; a
    component's id is its smallest document id, and that document is kept. ``percent`` under
    about 8 is an error: the signatures are too short for it.

    Null or blank texts have no shingle, are linked with nothing and kept. A row with a
    null id has its shingles counted, is linked with nothing, has a null component and is
    kept. Rows sharing an id are one node: links of any of their texts count,
    and repeated rows of a kept id are all kept. An empty
    table gives an empty result. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = scratch.keep(rows.mapInArrow(
        _sign(shingle), "id long, n long, d1 long, d2 long, sig binary"), "signed")
    real = signed.where("n > 0 and id is not null")
    # classes of equal shingle sets: copies never meet each other again
    classes = scratch.keep(real.groupBy("d1", "d2", "n").agg(F.min("id").alias("rep")), "classes")
    member = scratch.keep(
        real.select("id", "d1", "d2", "n").join(classes, ["d1", "d2", "n"])
        .select("id", "rep", "n"), "member")
    # one row per class, of its smallest id (repeated rows of that id carry equal signatures)
    node = scratch.keep(
        real.join(classes.withColumnRenamed("rep", "id"), ["d1", "d2", "n", "id"])
        .select("id", "n", "d1", "d2", "sig").distinct().select("id", "n", "sig"), "node")
    counted = scratch.keep(signed.select("id", "n"), "counted")
    scratch.drop(signed, classes)  # what is not read again goes at once: signatures are large
    links = _links(rows, node, scratch, shingle, percent)
    # rows that share an id but not a text tie their classes together
    several = member.groupBy("id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo <> hi")
    ties = member.join(several.select("id"), "id", "left_semi").select(
        F.col("id").alias("u"), F.col("rep").alias("v"))
    found = components(links.unionByName(ties), scratch)
    # a document follows the representative of its class
    label = scratch.keep(
        member.groupBy("id").agg(F.min("rep").alias("rep")).join(
            found.withColumnRenamed("u", "rep"), "rep", "left")
        .select("id", F.coalesce("component", "rep").alias("component")), "label")
    out = (counted.select("id", F.col("n").alias("n_shingles"))
           .join(label, "id", "left")
           .select(F.col("id").alias(id_col), "n_shingles",
                   F.coalesce("component", "id").alias("component_id"))
           .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))
    out = scratch.keep(out, "near-duplicates")
    scratch.close(out)
    return out


def _links(rows: DataFrame, node: DataFrame, scratch: Scratch, shingle: int, percent: int) -> DataFrame:
    """Verified links (u, v) between class representatives, enough to connect all of them."""
    spark = rows.sparkSession
    share = percent / 100
    least = share - SLACK * (share * (1 - share) / MINIMA) ** 0.5
    buckets = scratch.keep(
        node.select("id", "sig").mapInArrow(_bands(*banding(percent)), "id long, bucket long"), "buckets")
    hubs = scratch.keep(
        buckets.groupBy("bucket").agg(F.min("id").alias("hub"), F.max("id").alias("top"))
        .where("hub <> top").select("bucket", "hub"), "hubs")
    met = scratch.keep(buckets.join(hubs, "bucket"), "met")  # members of shared buckets
    scratch.drop(buckets, hubs)
    star = scratch.keep(
        met.where("id <> hub").select(F.col("hub").alias("u"), F.col("id").alias("v")).distinct(), "star")
    sets: list[DataFrame] = []

    def text_sets() -> DataFrame:
        """Shingle sets of the documents that share a bucket, made once and only if asked."""
        if not sets:
            wanted = scratch.keep(star.select(F.col("u").alias("id")).union(
                star.select(F.col("v").alias("id"))).distinct(), "wanted")
            # grows with the corpus, as ``mixed`` does: a shuffle join at every size, never a broadcast
            made = rows.join(wanted.hint("merge"), "id", "left_semi").mapInArrow(_sets(shingle), "id long, s array<long>")
            sets.append(scratch.keep(made, "sets"))
            scratch.drop(wanted)
        return sets[0]

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """Of pairs (u, v) those that are links: sizes, then signatures, then full sets."""
        sig = node.select("id", "n", "sig")
        left = sig.toDF("u", "nu", "su")
        right = sig.toDF("v", "nv", "sv")
        close = (pairs.join(left, "u").join(right, "v")
                 .where(F.expr(f"100 * least(nu, nv) >= {percent} * greatest(nu, nv)"))
                 .select("u", "v", "su", "sv").mapInArrow(_agree(least), "u long, v long").distinct())
        close = scratch.keep(close, f"{name}-close")
        s = text_sets()
        both = (close.join(s.select(F.col("id").alias("u"), F.col("s").alias("a")), "u")
                .join(s.select(F.col("id").alias("v"), F.col("s").alias("b")), "v")
                .select("u", "v", F.size(F.array_intersect("a", "b")).cast("long").alias("x"),
                        F.size("a").cast("long").alias("na"), F.size("b").cast("long").alias("nb"))
                .where(F.expr(f"100 * x >= {percent} * (na + nb - x)")))
        out = scratch.keep(both.select("u", "v").distinct(), name)
        scratch.drop(close)
        return out

    # each member against the smallest class that any of its buckets holds
    nearest = scratch.keep(star.groupBy("v").agg(F.min("u").alias("u")).select("u", "v"), "nearest")
    links = verified(nearest, "first")
    scratch.drop(star)
    labels = scratch.keep(components(links, scratch), "labels")
    # members of one bucket that lie in different components
    c, d = labels.toDF("id", "c"), labels.toDF("hub", "d")
    tagged = scratch.keep(
        met.join(c, "id", "left").join(d, "hub", "left").join(nearest.toDF("near", "id"), "id", "left")
        .join(node.select("id", "n"), "id").select(
            "bucket", "id", "n", F.coalesce("c", "id").alias("c"), F.coalesce("d", "hub").alias("d"),
            (F.col("near") == F.col("hub")).alias("checked")), "tagged")
    scratch.drop(met, labels, nearest, node)
    # buckets with the same members need one look; of a bucket of two, the pair may be checked already
    open_ = F.when(F.col("c") != F.col("d"), F.col("n")).otherwise(0)
    split = tagged.groupBy("bucket").agg(
        F.count("*").alias("m"), F.bit_xor(F.xxhash64("id")).alias("x"), F.sum("id").alias("y"),
        F.sum("n").alias("all"), F.sum(open_).alias("asked"),
        F.sum(F.when(~F.coalesce("checked", F.lit(False)), open_).otherwise(0)).alias("unseen"))
    split = split.where(F.when(F.col("m") == 2, F.col("unseen")).otherwise(F.col("asked")) > 0)
    split = split.groupBy("m", "x", "y", "all", "asked").agg(F.min("bucket").alias("bucket")).select(
        "bucket", F.ceil(F.col("all") / BLOCK_SHINGLES).alias("blocks"),
        F.ceil(F.col("asked") / QUERY_SHINGLES).alias("parts"))  # blocks by the shingles they hold
    split = scratch.keep(split, "split")
    mixed = scratch.keep(tagged.join(split, "bucket").select(
        "bucket", "id", "c", (F.col("c") != F.col("d")).alias("query"), "blocks", "parts"), "mixed")
    scratch.drop(tagged, split)
    mixed = mixed.hint("merge").join(text_sets(), "id")
    deal = F.xxhash64("id")
    members = mixed.withColumn("block", F.pmod(deal, "blocks")).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    queries = mixed.where("query").withColumn("part", F.pmod(deal, "parts")).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cols = ["bucket", "block", "part", "id", "c", "query", "s"]
    blocks = members.withColumn("query", F.lit(False)).select(cols).union(queries.select(cols))
    rest = blocks.groupBy("bucket", "block", "part").applyInArrow(_block_links(percent), "u long, v long")
    found = scratch.keep(links.union(rest.distinct()), "links")
    scratch.drop(text_sets())
    return found
