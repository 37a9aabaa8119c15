"""Near-duplicates and components against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ticklake.llm import minhash
from ticklake.llm.common import Scratch, utf8
from ticklake.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text: str | None, size: int) -> set:
    w = WORD.findall((text or "").encode().lower().decode())
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def brute(docs: list[tuple], size: int, percent: int) -> dict:
    sets = [shingles(t, size) for _, t in docs]
    up = list(range(len(docs)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for i in range(len(docs)):
        for j in range(i):
            x = len(sets[i] & sets[j])
            linked = x and 100 * x >= percent * (len(sets[i]) + len(sets[j]) - x)
            if docs[i][0] is not None and (docs[i][0] == docs[j][0] or docs[j][0] is not None and linked):
                up[root(i)] = root(j)
    low: dict[int, int] = {}
    for i, (k, _) in enumerate(docs):
        if k is not None:
            low[root(i)] = min(low.get(root(i), k), k)
    return {(k, len(sets[i])): (low[root(i)] if k is not None else None) for i, (k, _) in enumerate(docs)}


def corpus(seed: int) -> list[tuple]:
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    bases = [[rnd.choice(vocabulary) for _ in range(rnd.choice((2, 8, 40, 120)))] for _ in range(12)]
    docs, ids = [], rnd.sample(range(10_000), 400)
    for k in range(150):
        w = list(rnd.choice(bases))
        for _ in range(rnd.choice((0, 0, 1, 2, 4, 8))):
            w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        docs.append((ids.pop(), " ".join(w) if k % 7 else " ".join(w).upper() + "\n"))
    hub = [rnd.choice(vocabulary) for _ in range(60)]  # a group of near copies of one text
    for _ in range(60):
        w = list(hub)
        for _ in range(rnd.randrange(7)):
            w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        docs.append((ids.pop(), " ".join(w)))
    docs += [(ids.pop(), t) for t in (None, "", " \n", "one", "one", "ONE", "two words")]
    return docs


@pytest.mark.parametrize("seed, size", [(1, 2), (2, 5)])
def test_components_match_brute_force(spark, seed, size):
    docs = corpus(seed)
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], "doc_id long, text string, n string, u int")
    rows = minhash.near_duplicates(df, shingle=size).collect()
    assert len(rows) == len(docs)
    want = brute(docs, size, 80)
    for r in rows:
        assert r["component_id"] == want[r["doc_id"], r["n_shingles"]], r
        assert r["kept"] == (r["component_id"] == r["doc_id"])


def test_small_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 128)
    monkeypatch.setattr(minhash, "QUERY_SHINGLES", 200)
    docs = corpus(3)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute(docs, 2, 80)
    for r in minhash.near_duplicates(df, shingle=2).collect():
        assert r["component_id"] == want[r["doc_id"], r["n_shingles"]]


def test_rows_that_share_or_lack_an_id(spark):
    docs = [(7, "a b c d e f"), (7, "a b c d e f"), (3, "x y z u v w"), (9, "a b c d e f"), (9, "x y z u v w"),
            (None, "a b c d e f"), (None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = minhash.near_duplicates(df, shingle=2).collect()
    got = sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in rows if r["doc_id"] is not None)
    assert got == [(3, 3, True), (7, 3, False), (7, 3, False), (9, 3, False), (9, 3, False)]
    assert [(r["component_id"], r["kept"]) for r in rows if r["doc_id"] is None] == [(None, True)] * 2


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_large_and_small_star_on_a_path_a_ring_and_a_hub(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100 + k, 100 + (k + 1) % 9) for k in range(9)]
    edges += [(200, 300 + k) for k in range(50)] + [(500, 500)]
    random.Random(4).shuffle(edges)
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r["u"]: r["component"] for r in components(df, Scratch(spark)).collect()}
    want = {k: 1 for k in range(1, 41)} | {100 + k: 100 for k in range(9)} | {k: 200 for k in (200, *range(300, 350))}
    assert got == want


def test_signature_agreement_estimates_similarity():
    a = " ".join(f"w{k}" for k in range(400))
    b = " ".join(f"w{k}" for k in range(100, 500))
    data, offsets = utf8(pa.array([a, b]))
    x, n = minhash.shingle_sets(data, offsets, 2)
    assert n.tolist() == [399, 399]
    sig = minhash.signatures(x, n)
    assert abs((sig[0] == sig[1]).mean() - 299 / 499) < 0.15
    assert np.array_equal(minhash.band_keys(sig)[0], minhash.band_keys(sig[:1])[0])


def test_bands_follow_the_similarity_asked_for(spark):
    assert minhash.banding(80) == (25, 5) and minhash.banding(50) == (62, 2) and minhash.banding(100) == (1, 125)
    with pytest.raises(ValueError):
        minhash.banding(5)
    rng = random.Random(8)
    docs = []
    for k in range(150):  # pairs of similarity about a half
        w = [f"{k}-{rng.random()}" for _ in range(90)]
        docs += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(w[:61] + [f"{k}+{i}" for i in range(29)]))]
    want = brute(docs, 1, 50)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df, shingle=1, percent=50).collect()}
    assert len(set(got.values())) == 150 == sum(2 * k == got[2 * k + 1] for k in range(150))
    assert {k: v for (k, _), v in want.items()} == got
