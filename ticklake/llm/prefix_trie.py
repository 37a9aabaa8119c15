"""The prefix trie of conversations.

A turn's id is a digest of role and text. Conversations become rows of ``width`` positional
turn-id columns; a ROLLUP over these columns aggregates all prefixes together. A longer
conversation goes on in further rows, each keyed by the node at which the row before ended.
A node's id is that key XOR a digest of the row's block number and its ids up to the node,
so the last node of one block is the key of the next.

Sums over subtrees need no walk over the trie. Each node is owned by its smallest member; a
conversation owns a suffix of its path, so what a subtree holds once per node can be summed
over its members. With ``shared`` the code points of a conversation before its first own
node (all of them if it owns none) and ``before`` those before a node,

    saved(node) = sum of shared over members - (members - 1) * before - shared of the owner

Leaves are counted over the owners of childless ends, children over the conversations whose
first own node hangs below the node. A first ROLLUP finds the owners, a second one the sums.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import Scratch

#: Turn columns of a row; blocks of a conversation whose prefixes one window sums.
WIDTH = 8
SPAN = 1024
#: Characters of joined ids in a row on the way to a digest.
CHUNK = 1 << 16
ID = ["hi", "lo"]
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def _number(batches):
    """(part, conv_id, at, tid, n) of rows sorted by conversation: ``at`` counts the rows of a
    conversation in this partition."""
    last, seen = None, 0
    for batch in batches:
        conv = batch.column("conv_id").to_numpy()
        if not len(conv):
            continue
        new = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        at = np.arange(len(conv)) - np.repeat(new, np.diff(np.concatenate([new, [len(conv)]])))
        if last == conv[0]:
            at[:new[1] if len(new) > 1 else len(conv)] += seen
        last, seen = conv[-1], int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [batch.column("part"), batch.column("conv_id"), pa.array(at), batch.column("tid"), batch.column("n")],
            ["part", "conv_id", "at", "tid", "n"])


def number_turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, pos, tid, n): each turn's place from 0, its id, its text's code points.

    Turns are ordered by ``turn`` (null first), ties by role, then by id. Rows are sorted over
    the whole table and numbered within partitions; the at most two conversations that a
    partition shares with its neighbours get the rows of the partitions before added, so one
    conversation may hold any share of all rows.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    tid = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), tid.alias("tid"),
        F.length(text).cast("long").alias("n"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("tid")]
    rows = turns.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    rows = scratch.keep(rows.select("part", "conv_id", "tid", "n").mapInArrow(
        _number, "part int, conv_id long, at long, tid binary, n long"), "turns")
    # two rows a partition at most, here and in ``earlier``: broadcast at every size
    edge = rows.groupBy("part").agg(F.min("conv_id").alias("lo"), F.max("conv_id").alias("hi"))
    count = rows.join(F.broadcast(edge), "part").where("conv_id = lo or conv_id = hi").groupBy(
        "part", "conv_id").agg(F.count(F.lit(1)).alias("_n"))
    earlier = count.withColumn("_before", F.sum("_n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("_n"))
    earlier = scratch.keep(earlier.where("_before > 0").drop("_n"), "earlier")
    return rows.join(F.broadcast(earlier), ["part", "conv_id"], "left").select(
        "conv_id", (F.col("at") + F.coalesce("_before", F.lit(0))).alias("pos"), "tid", "n")


def with_shared_heads(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as the first of their hundred does: (turns, ids).

    Conversation c takes the first h turns of conversation ``c - c % every``, h the unsigned
    CRC-32 of its decimal id modulo ``most``, and its own turns after its first h. ``ids``
    (conv_id) holds every conversation, also one that is left without a turn.
    """
    size = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    ids = size.select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), head.alias("h"))
    bases = size.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.col("size").alias("_has"))
    ids = ids.join(bases, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("_has", F.lit(0))).alias("took"))
    first = turns.where((F.col("conv_id") % every == 0) & (F.col("pos") < most)).withColumnRenamed("conv_id", "base")
    heads = first.join(ids, "base").where("pos < h").select("conv_id", "pos", "tid", "n")
    own = turns.join(ids.select("conv_id", "h", "took"), "conv_id").where("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("took")).alias("pos"), "tid", "n")
    return heads.unionByName(own), ids.select("conv_id")


def _code(block: Column, ids: Column) -> tuple[Column, Column]:
    """A digest of a block's number and the ids of its first turns, as two 60-bit numbers."""
    sha = F.sha2(F.concat(block.cast("string"), F.lit(":"), F.array_join(F.transform(ids, F.hex), "")), 256)
    return tuple(F.conv(F.substring(sha, at, 15), 16, 10).cast("long") for at in (1, 16))


def _blocks(turns: DataFrame, ids: DataFrame, width: int, scratch: Scratch) -> DataFrame:
    """(conv_id, block, key_hi, key_lo, before, end_hi, end_lo, upto, t1...): a conversation's turns
    in rows of ``width``; the node and the code points before the row and at its end."""
    turn = F.struct("pos", F.struct(F.col("tid").alias("id"), "n").alias("t"))
    rows = turns.groupBy("conv_id", F.floor(F.col("pos") / width).alias("block")).agg(
        F.transform(F.array_sort(F.collect_list(turn)), lambda x: x["t"]).alias("ts"))  # at most ``width`` turns
    hi, lo = _code(F.col("block"), F.transform("ts", lambda t: t["id"]))
    size = F.aggregate("ts", F.lit(0).cast("long"), lambda a, t: a + t["n"])
    rows = scratch.keep(rows.select("conv_id", "block", "ts", hi.alias("hi"), lo.alias("lo"), size.alias("size"),
                                    F.floor(F.col("block") / SPAN).alias("span")), "blocks")
    sums = [("hi", F.bit_xor), ("lo", F.bit_xor), ("size", F.sum)]
    near = Window.partitionBy("conv_id", "span").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    far = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = rows.groupBy("conv_id", "span").agg(*[f(c).alias(c) for c, f in sums]).select(
        "conv_id", "span", *[f(c).over(far).alias(f"far_{c}") for c, f in sums]).where("span > 0")
    rows = rows.select("*", *[f(c).over(near).alias(f"near_{c}") for c, f in sums]).join(spans, ["conv_id", "span"], "left")
    zero = F.lit(0)
    key = {c: F.coalesce(f"near_{c}", zero).bitwiseXOR(F.coalesce(f"far_{c}", zero)) for c in ID}
    before = F.coalesce("near_size", zero) + F.coalesce("far_size", zero)
    cols = [f"t{i + 1}" for i in range(width)]
    rows = rows.select(
        "conv_id", "block", *[key[c].alias(f"key_{c}") for c in ID], before.alias("before"),
        *[key[c].bitwiseXOR(F.col(c)).alias(f"end_{c}") for c in ID], (before + F.col("size")).alias("upto"),
        *[F.get("ts", F.lit(i)).alias(c) for i, c in enumerate(cols)])
    none = ids.join(turns.select("conv_id").distinct(), "conv_id", "left_anti").select(
        "conv_id", *[F.lit(0).cast("long").alias(c) for c in rows.columns[1:8]],
        *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in cols])
    return scratch.keep(rows.unionByName(none), "rows")


def _nodes(rows: DataFrame, width: int, sums: str) -> DataFrame:
    """One row per prefix: its node's id, its parent's, its depth, the code points before its last
    turn, its members and what ``sums`` aggregates over them."""
    cols = ", ".join(f"t{i + 1}" for i in range(width))
    rolled = rows.sparkSession.sql(f"""
        SELECT block, key_hi, key_lo, before AS start, {cols}, {width} - bit_count(grouping_id()) AS level,
               min(conv_id) AS conv_id, count(*) AS n_convs{sums}
        FROM {{rows}} GROUP BY block, key_hi, key_lo, before, ROLLUP({cols})""", rows=rows)
    turns = F.array(*[F.col(f"t{i + 1}") for i in range(width)])
    level = F.col("level")
    rolled = rolled.where(F.when(level == 0, F.col("block") == 0).otherwise(F.get(turns, level - 1).isNotNull()))
    ids = F.transform(turns, lambda t: t["id"])
    here = _code(F.col("block"), F.slice(ids, F.lit(1), level))
    above = _code(F.col("block"), F.slice(ids, F.lit(1), F.greatest(level - 1, F.lit(0))))
    before = F.aggregate(F.slice(turns, F.lit(1), F.greatest(level - 1, F.lit(0))), F.col("start"), lambda a, t: a + t["n"])
    known = [c for c in rolled.columns if c not in ("block", "key_hi", "key_lo", "start", "level", *cols.split(", "))]
    key = [F.col("key_hi"), F.col("key_lo")]
    return rolled.select(
        *[F.when(level == 0, k).otherwise(k.bitwiseXOR(x)).alias(c) for c, k, x in zip(ID, key, here, strict=True)],
        *[F.when(level > 1, k.bitwiseXOR(x)).when(level == 1, k).alias(f"up_{c}")
          for c, k, x in zip(ID, key, above, strict=True)],
        (F.col("block") * width + level).alias("depth"), before.alias("before"), *known)


def _chunks(batches):
    """Joined ids of a node in rows of bounded length: (hi, lo, first id, text)."""
    node, first, held, size = None, None, [], 0
    for batch in batches:
        out = []
        for hi, lo, conv in zip(*(batch.column(c).to_pylist() for c in (*ID, "conv_id")), strict=True):
            if held and ((hi, lo) != node or size > CHUNK):
                out.append((*node, first, ",".join(held)))
                held, size = [], 0
            if not held:
                node, first = (hi, lo), conv
            held.append(str(conv))
            size += len(held[-1]) + 1
        if out:
            yield _batch(out)
    if held:
        yield _batch([(*node, first, ",".join(held))])


def _batch(rows):
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                      [*ID, "first", "text"])


def _digests(batches):
    """SHA-256 of each node's chunks in order, joined by commas: (hi, lo, sha256)."""
    node, sha = None, None
    for batch in batches:
        out = []
        for hi, lo, text in zip(*(batch.column(c).to_pylist() for c in (*ID, "text")), strict=True):
            if (hi, lo) != node:
                if node:
                    out.append((*node, sha.hexdigest()))
                node, sha = (hi, lo), hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(text.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], [*ID, "ends_sha256"])
    if node:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, sha.hexdigest())], [*ID, "ends_sha256"])


def ends_digest(ends: DataFrame) -> DataFrame:
    """(hi, lo, ends_sha256): SHA-256 of the ids that end at a node, ascending, joined by commas.
    Ids are joined in sorted ranges first, so a node at which very many end is read by its last
    task as a few long texts, one at a time."""
    order = [*ID, "conv_id"]
    chunks = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _chunks, "hi long, lo long, first long, text string")
    return chunks.repartition(*ID).sortWithinPartitions(*ID, "first").mapInArrow(
        _digests, "hi long, lo long, ends_sha256 string")


def prefix_trie(turns: DataFrame, ids: DataFrame, scratch: Scratch, width: int = WIDTH) -> DataFrame:
    """One row per distinct prefix of the conversations, the empty one (depth 0) included.

    ``turns`` (conv_id, pos, tid, n) as of :func:`number_turns`, ``ids`` (conv_id) every
    conversation, also those without a turn. Columns: conv_id (smallest member), depth,
    parent_conv_id (null at the root), n_convs (members), n_children, n_leaves (childless nodes
    of the subtree), saved_tokens (over the subtree, each node's members but one times the code
    points of its last text), ends_sha256 (of the ids that end here), and the node's id (hi, lo).
    An empty table has no nodes. Ids of turns and nodes are digests of 128 and 120 bits, taken
    as equal only for equal turns and prefixes.
    """
    rows = _blocks(turns, ids, width, scratch)
    found = scratch.keep(_nodes(rows, width, ""), "nodes")
    own = found.groupBy("conv_id").agg(
        F.min("depth").alias("first"), *[F.min_by(c, "depth").alias(c) for c in ("before", "up_hi", "up_lo")])
    own = scratch.keep(own, "own")
    children = own.where("up_hi is not null").groupBy(F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo")).agg(
        F.count(F.lit(1)).alias("below"))
    children = scratch.keep(children, "children")
    ends = scratch.keep(rows.groupBy("conv_id").agg(
        F.max_by("end_hi", "block").alias("hi"), F.max_by("end_lo", "block").alias("lo"),
        F.max("upto").alias("total"), F.max(F.col("block") * width + sum(
            F.col(f"t{i + 1}").isNotNull().cast("long") for i in range(width))).alias("size")), "ends")
    owners = found.select(F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), F.col("conv_id").alias("up"))
    facts = (own.join(owners, ["up_hi", "up_lo"], "left").select("conv_id", "first", "up", F.col("before").alias("own_before"))
             .join(ends, "conv_id", "right").join(children, ID, "left").select(
        "conv_id", "first", "up", "size", F.coalesce("own_before", "total").alias("shared"),
        (F.col("first").isNotNull() & F.col("below").isNull()).cast("long").alias("leaf")))
    facts = scratch.keep(facts, "facts")
    nodes = _nodes(rows.join(facts, "conv_id"), width, """, sum(shared) AS shared, sum(leaf) AS n_leaves,
        min_by(shared, conv_id) AS own_shared, min_by(first, conv_id) AS first, min_by(up, conv_id) AS up,
        min_by(size, conv_id) AS size""")
    out = nodes.join(children, ID, "left").join(ends_digest(ends), ID, "left").select(
        "conv_id", "depth", F.when(F.col("depth") > F.col("first"), F.col("conv_id")).otherwise(F.col("up")).alias(
            "parent_conv_id"), "n_convs",
        (F.coalesce("below", F.lit(0)) + (F.col("size") > F.col("depth")).cast("long")).alias("n_children"), "n_leaves",
        (F.col("shared") - (F.col("n_convs") - 1) * F.col("before") - F.col("own_shared")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"), *ID)
    return out


def trie_of(conversations: DataFrame, every: int = 100, most: int = 6, width: int = WIDTH) -> DataFrame:
    """:func:`prefix_trie` of conversations (conv_id, turn, role, text) with shared heads.

    Null role and text are empty, null turns come first; rows without a conv_id belong to no
    conversation. Equal turn numbers are ordered by role and then by the turn's digest; repeated
    rows are turns of their own. An empty table has no nodes. Texts are only digested where they
    stand, whatever their length. Other columns are not read.
    """
    scratch = Scratch(conversations.sparkSession)
    turns, ids = with_shared_heads(number_turns(conversations, scratch), every, most)
    out = scratch.keep(prefix_trie(turns, ids, scratch, width), "trie")
    scratch.close(out)
    return out
