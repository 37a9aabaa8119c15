"""Prefix trie, repeated passages and importance resampling against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ticklake.llm import prefix_trie, repeats, resampling
from ticklake.llm.common import Scratch, utf8

LAST = 10**30
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TURNS = "conv_id long, turn long, role string, text string"
DOCS = "doc_id long, text string"


# --- prefix trie -----------------------------------------------------------------------------

def trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            r, t = role or "", text or ""
            sha = hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, r, sha, t))
    own = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    nodes, below = defaultdict(list), defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            nodes[built[c][:d]].append(c)
    for p in nodes:
        if p:
            below[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        leaves[p] = sum(leaves[x] for x in below[p]) if below[p] else 1
        saved[p] = sum(saved[x] for x in below[p]) + ((len(nodes[p]) - 1) * len(p[-1][1]) if p else 0)
    return sorted((m[0], len(p), nodes[p[:-1]][0] if p else -1, len(m), len(below[p]), leaves[p], saved[p], hashlib.sha256(
        ",".join(str(c) for c in m if len(built[c]) == len(p)).encode()).hexdigest()) for p, m in nodes.items())


def found(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children,
                   r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def conversations(seed):
    rng = random.Random(seed)
    rows = [(c, rng.choice([t, t, t, None, 3]), rng.choice(["u", "a", None]), rng.choice(["", "x", "yy", None, "é日"]))
            for c in [*range(25), *range(100, 120), *range(-30, -20), 205, 307, 308] for t in range(rng.randint(1, 14))]
    rows += [(c, t, "u", "same" * (t % 3)) for c in (150, 151, 152) for t in range(12)]
    return rows + rows[:3] + [(None, 1, "u", "x")]


@pytest.mark.parametrize("width", [2, 8])
def test_trie_equals_brute_force(spark, monkeypatch, width):
    monkeypatch.setattr(prefix_trie, "SPAN", 2)  # prefixes over several spans of blocks
    rows = conversations(width)
    df = spark.createDataFrame(rows, TURNS).repartition(5).withColumns({"hi": F.lit(1), "tid": F.lit(2), "pos": F.lit(3)})
    assert found(prefix_trie.trie_of(df, width=width)) == trie(rows)


def test_trie_of_one_conversation_over_all_partitions(spark):
    rows = [(100, t, "u", str(t)) for t in range(400)] + [(101, t, "u", str(t)) for t in range(7)]
    turns = prefix_trie.number_turns(spark.createDataFrame(rows, TURNS).repartition(8), Scratch(spark))
    assert sorted((r.conv_id, r.pos) for r in turns.collect()) == [(100, t) for t in range(400)] + [(101, t) for t in range(7)]
    assert found(prefix_trie.trie_of(spark.createDataFrame(rows, TURNS))) == trie(rows)


def test_trie_of_nothing(spark):
    assert found(prefix_trie.trie_of(spark.createDataFrame([], TURNS))) == []
    alone = [(101, None, None, None)]  # its only turn falls to an absent head
    assert found(prefix_trie.trie_of(spark.createDataFrame(alone, TURNS))) == trie(alone)


def test_joined_ids_pass_in_chunks(monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 10)
    ids = list(range(50))
    batch = pa.RecordBatch.from_pydict({"hi": [1] * 50 + [2], "lo": [5] * 51, "conv_id": [*ids, 9]})
    chunks = list(prefix_trie._chunks([batch.slice(0, 20), batch.slice(20)]))
    assert sum(b.num_rows for b in chunks) > 5
    out = [r for b in prefix_trie._digests(chunks) for r in b.to_pylist()]
    assert [r["ends_sha256"] for r in out] == [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), b"9")]


# --- repeated passages -----------------------------------------------------------------------

def cleaned(rows, size=13):
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for a in range(len(w) - size + 1):
            key = tuple(w[a:a + size])
            first[key] = min(first.get(key, LAST), LAST if i is None else i)
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = {x for a in range(len(w) - size + 1) if first[tuple(w[a:a + size])] < (LAST if i is None else i)
                for x in range(a, a + size)}
        out.append((LAST if i is None else i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


def passages(seed):
    rng = random.Random(seed)
    letters = ["a", "b", "é", "c,", "日本", "d"]
    known = [[rng.choice(letters) for _ in range(rng.randint(10, 90))] for _ in range(12)]
    rows = [(None, None), (1, ""), (2, " \n"), (3, "x " * 500), (4, "x\t" * 300), (3, "x " * 30), (5, "a b " * 14)]
    for i in range(6, 90):
        t = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(known)
            a = rng.randint(0, len(p) - 1)
            t += p[a:a + rng.randint(1, 60)] + [rng.choice(letters) for _ in range(rng.randint(0, 5))]
        rows.append((rng.choice([i, i, i, i // 2, None, -i]), rng.choice([" ", "\n", "  "]).join(t)))
    return rows


def test_repeats_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD", 2000)
    rows = passages(5)
    df = spark.createDataFrame(rows, DOCS).repartition(4).withColumns(
        {"id": F.lit(1), "anchor": F.lit(2), "shard": F.lit(3), "n_words": F.lit(4)})
    got = sorted((LAST if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.text)
                 for r in repeats.remove_repeats(df).collect())
    assert got == cleaned(rows)
    assert sum(r[2] for r in got) > 500


def test_shards_in_small_automata_and_pieces(monkeypatch):
    """Several automata a shard, documents in several rounds, long texts cut inside a window."""
    for name, n in (("MACHINE", 100), ("HELD", 500), ("PIECE", 64)):
        monkeypatch.setattr(repeats, name, n)
    rows = [(LAST if i is None else i, t or "") for i, t in passages(7)]
    ids = {x: k for k, x in enumerate(sorted({i for i, _ in rows}))}
    rows = [(ids[i], t) for i, t in rows]
    segments = []
    for i, t in rows:
        w = WORD.findall(t)
        segments += [(0, 0, i, " ".join(w[a:a + 76]), -1) for a in range(0, len(w) - 12, 64)]
    docs = [(0, 1, i, t, 0) for i, t in rows]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*segments, *docs, strict=True)], list("abcde"))
    out = [r for b in repeats._clean(13)([batch.slice(0, 40), batch.slice(40)]) for r in b.to_pylist()]
    assert sorted((r["id"], r["n_words"], r["n_removed"], r["text"]) for r in out) == cleaned(rows)


def test_long_text_and_nothing(spark):
    rng = random.Random(1)
    long = " ".join(str(rng.randint(0, 50)) for _ in range(700_000))
    rows = [(1, long[300_000:400_000]), (2, long), (3, "y" * 3_000_000)]
    got = {r.doc_id: (r.n_words, r.n_removed) for r in repeats.remove_repeats(spark.createDataFrame(rows, DOCS)).collect()}
    whole = len(long[300_000:400_000].split())
    assert got[1] == (whole, 0) and got[3] == (1, 0)
    assert got[2][0] == 700_000 and whole - 2 <= got[2][1] <= whole  # but for words cut in two at the ends
    assert repeats.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0


# --- importance resampling -------------------------------------------------------------------

def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def buckets(t, n=10_000):
    w = TOKEN.findall(lower(t))
    return [zlib.crc32(" ".join(w[i:i + k]).encode()) % n for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def resampled(docs, target, percent=5, least=20):
    s, t = Counter(b for _, x in docs for b in buckets(x)), Counter(b for x in target for b in buckets(x))
    big_s, big_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000))))

    rows = []
    for i, x in docs:
        w = sum(gain(b) for b in buckets(x))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(buckets(x)), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))),
                     len(TOKEN.findall(lower(x))) >= least])
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able):
        r.append(k + 1 if k < percent * len(able) // 100 else None)
    return Counter(tuple(r[:4]) + (r[5] if r[4] else None,) for r in rows)


def texts(seed, n=200):
    rng = random.Random(seed)
    return [None, "", "a", "Hello, World! ça va 12", "x" * 70 + " y " + "z" * 300 + " A b"] + [" ".join(
        "".join(rng.choice("abcXYZ019é日-,") for _ in range(rng.choice([1, 2, 3, 90]))) for _ in range(rng.randint(0, 40)))
        for _ in range(n)]


@pytest.mark.parametrize("piece", [1 << 20, 50])
def test_feature_buckets(monkeypatch, piece):
    monkeypatch.setattr(resampling, "PIECE", piece)
    monkeypatch.setattr(resampling, "WORDS", 7)
    for some in ([x] for x in texts(1, 20)) if piece == 50 else [texts(1)]:
        codes, sizes, counts = resampling.word_codes(*utf8(pa.array(some, pa.string())))
        row = np.repeat(np.arange(len(counts)), counts)
        got = defaultdict(list)
        for first, b in resampling.feature_buckets(codes, sizes, counts, 10_000):
            for r, x in zip(row[first], b, strict=True):
                got[r].append(int(x))
        assert all(sorted(got[k]) == sorted(buckets(t)) for k, t in enumerate(some))


def test_resample_equals_brute_force(spark):
    rng = random.Random(2)
    docs = [(rng.choice([k, k, -k, None, 2**40 + k, 7]), t) for k, t in enumerate(texts(3))]
    docs += [(8, docs[20][1])] * 3
    target = [t for _, t in docs[50:60]]
    df = spark.createDataFrame(docs, DOCS).repartition(4).withColumns({"id": F.lit(1), "score": F.lit("x"), "rank": F.lit(0)})
    out = resampling.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), percent=30)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in out.collect()) == resampled(docs, target, 30)


def test_resample_nothing(spark):
    none, docs = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b " * 20), (2, None)], DOCS)
    assert resampling.resample(none, docs).count() == 0
    got = {r.doc_id: r["rank"] for r in resampling.resample(docs, none, percent=100).collect()}
    assert got == {1: 1, 2: None}


def test_radix_rank(spark):
    rng = random.Random(4)
    ends = [-(2**63), 2**63 - 1, 0, -1, None]
    rows = [(rng.choice([*ends, rng.randint(-5, 5), rng.randint(-2**62, 2**62)]), rng.choice([*ends, rng.randint(-9, 9)]))
            for _ in range(500)]
    out = resampling.radix_rank(spark.createDataFrame(rows, "a long, b long").repartition(6), [("a", True), ("b", False)],
                                Scratch(spark)).orderBy("_place").collect()
    assert [r._place for r in out] == list(range(500))
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is None, r[1] or 0))
    assert [(r.a, r.b) for r in out] == order
    same = spark.createDataFrame([(1, 1)] * 5, "a long, b long")
    assert sorted(r._place for r in resampling.radix_rank(same, [("a", True)], Scratch(spark)).collect()) == list(range(5))
