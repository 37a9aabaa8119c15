"""Packing against the tokenizer and mixing against its targets."""

from __future__ import annotations

import random
import statistics
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from ticklake.llm import mixing, packing
from ticklake.llm.common import utf8
from ticklake.llm.queries import tokenizer_files

ODD = ["", "  ", " a", "a ", "a  b", "a\n b", "a \nb", "a   b\n\n  c \n d  ", "it's  'tis\t x  y 　 z",
       "\x1c \x1c a", "x\x85 \x85y", "foo \n", "foo\n ", "中文 é ß", "###&&& $$$", "\n\n\n", " \n a", "a\t b", None]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_files()[0])


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def test_word_table_gives_the_tokenizers_ids(tokenizer, documents, monkeypatch):
    texts = ODD + [r["text"] for r in documents.select("text").collect()]
    table = packing.WordTable(*tokenizer_files())
    for _ in range(2):  # with words new and known
        data, offsets = utf8(pa.array(texts, pa.string()))
        flat, n = table.encode(data, offsets)
        for t, ids in zip(texts, np.split(flat, np.cumsum(n)[:-1]), strict=True):
            assert ids.tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids, t
    monkeypatch.setattr(packing, "SLICE_BYTES", 64)  # a long text in pieces
    long = " ".join(t for t in texts[-20:])
    data, offsets = utf8(pa.array([long]))
    assert table.encode(data, offsets)[0].tolist() == tokenizer.encode(long, add_special_tokens=False).ids


def test_added_tokens_keep_their_ids(tokenizer, monkeypatch):
    table = packing.WordTable(*tokenizer_files())
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y <|endoftext", "|> plain", "< a", "<|endoftext|> <|endoftext|>"]

    def ids(rows):
        flat, n = table.encode(*utf8(pa.array(rows)))
        return [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])]

    assert ids(texts) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids(texts[:1]) == [[64, 220, 50256, 275]]
    monkeypatch.setattr(packing, "SLICE_BYTES", 16)  # also in a long text
    long = "word " * 99 + texts[0]
    assert ids([long]) == [tokenizer.encode(long, add_special_tokens=False).ids]


def check(rows, want, capacity=2048, open_share=packing.OPEN_SHARE):
    """want: the ids of each document, by its key."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert set(by_doc) == set(want)
    for key, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(want[key])
            part = np.array(want[key][at:at + p["length"]], "<u4")
            assert zlib.crc32(part.tobytes()) == p["ids_crc32"]
            at += p["length"]
        assert at == len(want[key])
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity and (at & (at - 1) == 0 or capacity - at <= open_share * capacity)


def test_pieces_cover_every_document_once(spark, tokenizer, documents):
    rows = packing.pack(documents, *tokenizer_files()).collect()
    want = {r["doc_id"]: tokenizer.encode(r["text"], add_special_tokens=False).ids + [1]
            for r in documents.select("doc_id", "text").collect()}
    check(rows, want)


def test_odd_documents(spark, tokenizer):
    texts = [*ODD, "word " * 9000]
    df = spark.createDataFrame([(k, t, 5, "s") for k, t in enumerate(texts)], "doc_id long, text string, start long, id string")
    rows = packing.pack(df, *tokenizer_files()).collect()
    check(rows, {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for k, t in enumerate(texts)})
    assert packing.pack(df.where("doc_id < 0"), *tokenizer_files()).count() == 0
    none = spark.createDataFrame([(None, "a"), (None, "a")], "doc_id long, text string")
    assert [r["doc_tokens"] for r in packing.pack(none, *tokenizer_files()).collect()] == [2, 2]


def test_classes_hold_a_fixed_count():
    packer = packing.Packer(0, 2048, 1 / 64)
    for k in range(40):
        packer.add((k, 512), np.arange(512))
    full = defaultdict(int)
    for _, _, ids, seq, _ in packer.rows:
        full[seq] += len(ids)
    assert list(full.values()) == [2048] * 10
    for tail in range(1, 2048):
        cut = packing.cuts(tail, 2048, 1 / 64)
        assert sum(cut) == tail
        assert all(2048 - (2048 // x) * x <= 2048 / 64 for x in cut)


def test_targets_reshare_what_stops():
    got = mixing.targets([10, 1000, 500, 0], [3, 1, 2, 3], 1510, 2)
    assert got[0] == 20 and got[3] == 0
    assert sum(got) == pytest.approx(1510)
    assert got[1] == pytest.approx(1490 / 3) and got[2] == pytest.approx(2 * 1490 / 3)


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(1)
    size = rng.integers(1, 900, 1500).astype(float).tolist()
    prob = [0.37] * 1500
    out = mixing.flight(prob, size, rng, land=False)
    assert sum(1 for p in out if 0 < p < 1) <= 2
    assert sum(out) == pytest.approx(sum(prob), abs=1e-6)
    assert np.dot(out, size) == pytest.approx(np.dot(prob, size), rel=1e-9)
    landed = mixing.flight(out, size, rng, land=True)
    assert set(landed) <= {0.0, 1.0}


def test_flight_includes_each_document_with_its_probability():
    size = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]
    hits = np.zeros(6)
    for seed in range(3000):
        hits += mixing.flight([0.4] * 6, size, np.random.default_rng(seed), land=False)
    assert np.allclose(hits / 3000, 0.4, atol=0.05)


def test_mix_meets_its_targets(spark, documents):
    rows = mixing.mix_sources(documents, block_rows=16).collect()
    assert len(rows) == documents.count()
    got, target, sizes = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        got[r["source"]] += r["taken"]
        sizes[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
    names = sorted(sizes)
    want = mixing.targets([sizes[s] for s in names], [mixing.WEIGHTS[i % 3] for i in range(len(names))],
                          1.5 * sum(sizes.values()), 2)
    median = {s: statistics.median(r["size"] for r in rows if r["source"] == s) for s in names}
    for s, t in zip(names, want, strict=True):
        assert target[s] == pytest.approx(t)
        assert abs(got[s] - t) <= median[s]
    again = mixing.mix_sources(documents.repartition(5), block_rows=16).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_every_source_is_within_its_median_document(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text", "source")
    by = mixing.mix_sources(docs).groupBy("source").agg(
        F.sum("taken").alias("got"), F.first("target").alias("target"), F.percentile("size", F.lit(0.5)).alias("median"))
    for r in by.collect():
        assert abs(r["got"] - r["target"]) <= r["median"], r


def test_repair_turns_small_documents_over():
    rng = random.Random(4)
    for _ in range(300):
        size = sorted(rng.choice([0, 30, 31, 40, 200, 2000]) + rng.randint(0, 9) for _ in range(rng.randint(0, 60)))
        taken = [rng.random() < 0.5 for _ in size]
        excess = rng.uniform(-3000, 3000)
        turned = mixing.repair(excess, size, taken)
        assert len(set(turned)) == len(turned)
        left = excess - sum(size[i] if taken[i] else -size[i] for i in turned)
        assert abs(left) <= abs(excess)
        again = [size[i] for i in range(len(size)) if i not in turned and taken[i] == (left > 0) and size[i] > 0]
        assert all(abs(abs(left) - x) >= abs(left) for x in again)  # no document brings it nearer


def test_mix_of_odd_rows(spark):
    rows = [(1, "a b", "s"), (1, "a b", "s"), (2, None, "s"), (None, "x y z", "t"), (3, "q", None), (4, "", None)]
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, source string, size int")
    got = mixing.mix_sources(df).collect()
    assert sorted(r["size"] for r in got) == [0, 0, 1, 2, 2, 3]
    assert len({r["copies"] for r in got if r["doc_id"] == 1}) == 1
    assert {r["source"]: r["source_size"] for r in got} == {"s": 4, "t": 3, None: 1}
    taken = mixing.take(df, mixing.mix_sources(df))
    assert taken.columns == df.columns
    assert taken.count() == sum(r["copies"] for r in got)
    assert mixing.mix_sources(df.where("doc_id < 0")).count() == 0
