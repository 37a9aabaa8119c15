"""Mixing sources to target weights by cube-method balanced sampling.

A source whose target is r times its size is taken floor(r) times whole; the fraction
f = r - floor(r) is sampled with inclusion probability f for each document. The cube
method's flight moves these probabilities along the null space of two constraints (the
expected number of words and of documents), so both totals stay exact while one document
after another is decided; of any three undecided documents one step decides at least one.

Flights run independently in blocks of bounded size (a hash of the id deals a source over
its blocks). At most two documents of a block stay undecided; they meet in the blocks of
the next level, until each source has a landing problem of two documents at most. Equal small
sizes leave the large documents undecided to the last, so the landing may be off by a share of
the largest document; small decided documents are then turned over until the words fit. The
words of a source count before its documents.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import Scratch, n_words

#: Documents of one flight block, about.
BLOCK_ROWS = 4096
#: Blocks whose undecided documents meet in one block of the next level.
FAN_IN = 1024
#: The weights dealt to sources in order, the share of all sizes to take, and
#: the most a source may be repeated.
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0


def targets(sizes: Sequence[float], weights: Sequence[float], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size; what is cut off is
    shared anew by weight among the others until none is above."""
    out = [0.0] * len(sizes)
    free, left = list(range(len(sizes))), float(total)
    while free:
        weight = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / weight > most * sizes[i]]
        if not over:
            for i in free:
                out[i] = left * weights[i] / weight
            break
        for i in over:
            out[i] = most * sizes[i]
        left -= sum(out[i] for i in over)
        free = [i for i in free if i not in set(over)]
    return out


def flight(prob: list[float], size: list[float], rng: np.random.Generator, land: bool) -> list[float]:
    """Inclusion probabilities after the flight: 0 or 1 but for at most two documents, none
    with ``land``."""
    eps = 1e-9
    prob = list(prob)
    draws = rng.random(len(prob) + 8).tolist()
    open_: list[int] = []
    for i in range(len(prob)):
        if eps < prob[i] < 1 - eps:
            open_.append(i)
        if len(open_) < 3:
            continue
        a, b, c = open_
        move = (size[b] - size[c], size[c] - size[a], size[a] - size[b])
        if move == (0, 0, 0):
            move = (1.0, -1.0, 0.0)
        up = down = math.inf
        for k, m in zip(open_, move, strict=True):
            if m > 0:
                up, down = min(up, (1 - prob[k]) / m), min(down, prob[k] / m)
            elif m < 0:
                up, down = min(up, prob[k] / -m), min(down, (1 - prob[k]) / -m)
        go = up if draws[i] * (up + down) < down else -down
        for k, m in zip(open_, move, strict=True):
            prob[k] += go * m
        open_ = [k for k in open_ if eps < prob[k] < 1 - eps]
        if len(open_) == 3:  # rounding: settle the one nearest to a side
            k = min(open_, key=lambda k: min(prob[k], 1 - prob[k]))
            prob[k] = float(round(prob[k]))
            open_.remove(k)
    if land and open_:  # what the landing adds or takes away, ``repair`` makes good
        want = sum(prob[k] * size[k] for k in open_)
        count = sum(prob[k] for k in open_)
        best = min(range(1 << len(open_)), key=lambda x: (
            abs(sum(size[k] for j, k in enumerate(open_) if x >> j & 1) - want),
            abs(bin(x).count("1") - count), x))
        for j, k in enumerate(open_):
            prob[k] = float(best >> j & 1)
    return [float(round(p)) if min(p, 1 - p) <= eps else p for p in prob]


def _fly(land: bool):
    def run(key, group: pd.DataFrame) -> pd.DataFrame:
        # large documents first, among their like; what stays undecided goes on to the next level
        group = group.sort_values(["size", "h", "unit"], ascending=[False, True, True],
                                  kind="stable", na_position="last")
        seed = abs(int(group["h"].min())) ^ len(group)
        group["prob"] = flight(group["prob"].tolist(), group["size"].astype(float).tolist(),
                               np.random.default_rng(seed), land)
        return group
    return run


def repair(excess: float, size: list[float], taken: list[bool]) -> list[int]:
    """Which documents to turn over (take or leave) so that ``excess`` words too many (or, below 0,
    too few) come near 0: each time the one that brings it nearest, until none does. ``size`` is
    ascending; a document turns over once."""
    free = {side: [i for i, t in enumerate(taken) if t == side and size[i] > 0] for side in (True, False)}
    turned = []
    while True:
        side = free[excess > 0]  # taken ones go if it is too much
        k = bisect_left(side, abs(excess), key=lambda i: size[i])
        near = [j for j in (k - 1, k) if 0 <= j < len(side)]
        best = min(near, key=lambda j: abs(abs(excess) - size[side[j]]), default=None)
        if best is None or abs(abs(excess) - size[side[best]]) >= abs(excess):
            return turned
        i = side.pop(best)
        excess -= size[i] if excess > 0 else -size[i]
        turned.append(i)


def _repair(key, group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["size", "h", "unit"], kind="stable", na_position="last")
    excess = float(group["got"].iloc[0]) - float(group["want"].iloc[0])
    turned = repair(excess, group["size"].astype(float).tolist(), group["hit"].astype(bool).tolist())
    out = group.iloc[turned]
    return out.assign(hit=~out["hit"].astype(bool))[["source", "unit", "hit"]]


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weights: Sequence[float] = WEIGHTS,
                share: float = SHARE, most: float = MOST, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken) per row of ``docs``.

    ``size`` counts the words of a text (null: 0). Sources in order of their code points,
    null last, get ``weights`` in turn. ``taken = copies * size``; ``copies`` is at most
    ``most``. Rows sharing source and id are one unit and get the same copies; a null id is
    an id like others within its source. A source without words has target 0 and is not
    taken. An empty table gives an empty result. Results do not depend on partitioning.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    rows = scratch.keep(docs.select(
        F.col(id_col).alias("unit"), F.col(source_col).cast("string").alias("source"),
        n_words(F.col(text_col)).alias("size")), "sizes")
    # one row per source: a dimension, not data
    known = rows.groupBy("source").agg(F.sum("size").alias("s"), F.count("*").alias("n")).collect()
    known.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-8")))
    sizes = [float(r["s"]) for r in known]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(known))],
                     share * sum(sizes), most)
    plan = spark.createDataFrame(
        [(r["source"], int(r["s"]), t, *_parts(t, r["s"]), -(-r["n"] // block_rows))
         for r, t in zip(known, wanted, strict=True)],
        "source string, source_size long, target double, base int, f double, blocks long")
    plan = plan.withColumnRenamed("source", "s3")  # as many rows as there are sources
    units = (rows.groupBy("source", "unit").agg(F.sum("size").alias("size"))
             .withColumn("h", F.xxhash64(F.col("unit").cast("string"), "source"))
             .join(plan, F.col("source").eqNullSafe(F.col("s3")))
             .select("source", "unit", "size", "source_size", F.col("f").alias("prob"), "h",
                     F.pmod(F.xxhash64("h", F.lit(3)), "blocks").alias("block")))
    units = scratch.keep(units, "units")
    level = units
    decided = []
    most_blocks = max([-(-r["n"] // block_rows) for r in known], default=1)
    while True:
        last = most_blocks <= 1
        done = level.groupBy("source", "block").applyInPandas(_fly(last), level.schema)
        done = scratch.keep(done, "flight")
        if last:
            decided.append(done)
            break
        decided.append(done.where("prob = 0 or prob = 1"))
        level = done.where("prob > 0 and prob < 1").withColumn(
            "block", F.floor(F.col("block") / FAN_IN).cast("long"))
        most_blocks = -(-most_blocks // FAN_IN)
    chosen = decided[0]
    for d in decided[1:]:
        chosen = chosen.unionByName(d)
    chosen = scratch.keep(chosen.where("prob = 1").select("source", "unit", "size"), "chosen")
    hits = chosen.select(F.col("source").alias("s2"), F.col("unit").alias("u2"), F.lit(True).alias("_hit"))
    # the landing may have rounded a large document: small ones of the source's first block, at most
    # ``block_rows`` or so, make good what it added or took away
    got = chosen.groupBy("source").agg(F.sum("size").alias("got")).withColumnRenamed("source", "s4")
    pool = units.where("block = 0 and prob > 0 and prob < 1").join(
        hits, F.col("source").eqNullSafe(hits["s2"]) & F.col("unit").eqNullSafe(hits["u2"]), "left").join(
        got, F.col("source").eqNullSafe(F.col("s4")), "left").select(
        "source", "unit", "size", "h", F.coalesce("_hit", F.lit(False)).alias("hit"),
        F.coalesce("got", F.lit(0)).cast("double").alias("got"), (F.col("prob") * F.col("source_size")).alias("want"))
    unit_type = rows.schema["unit"].dataType.simpleString()
    turned = scratch.keep(pool.groupBy("source").applyInPandas(_repair, f"source string, unit {unit_type}, hit boolean"), "turned")
    t = turned.select(F.col("source").alias("s5"), F.col("unit").alias("u5"), "hit")
    c = hits.join(t, F.col("s2").eqNullSafe(t["s5"]) & F.col("u2").eqNullSafe(t["u5"]), "left").where(
        "coalesce(hit, true)").select("s2", "u2", F.lit(1).alias("hit")).unionByName(
        t.where("hit").select(F.col("s5").alias("s2"), F.col("u5").alias("u2"), F.lit(1).alias("hit")))
    out = rows.join(c, rows["source"].eqNullSafe(c["s2"]) & rows["unit"].eqNullSafe(c["u2"]), "left")
    out = out.drop("s2", "u2").join(
        plan, F.col("source").eqNullSafe(F.col("s3"))).select(
        F.col("unit").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
        (F.col("base") + F.coalesce("hit", F.lit(0))).cast("long").alias("copies"))
    out = scratch.keep(out.withColumn("taken", F.col("copies") * F.col("size")), "mix")
    scratch.close(out)
    return out


def _parts(target: float, size: int) -> tuple[int, float]:
    """Whole copies and the inclusion probability of one more."""
    r = target / size if size else 0.0
    base = math.floor(r + 1e-9)
    return base, max(0.0, r - base)


def take(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    once = mixed.where("copies > 0").groupBy(id_col, source_col).agg(F.max("copies").alias("_copies"))
    once = once.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), "_copies")
    # what the mix takes grows with the corpus: a shuffle join at every size, never a broadcast
    joined = docs.join(once.hint("merge"), docs[id_col].eqNullSafe(once["_id"])
                       & docs[source_col].eqNullSafe(once["_source"]))
    return (joined.withColumn("_again", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")))
            .select(*[docs[c] for c in docs.columns]))
