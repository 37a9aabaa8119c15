"""Removal of passages that repeat across documents.

A window is a run of ``size`` consecutive words. Each word that lies in a window which a
document with a smaller id also holds is removed, judged on the input.

1. Recurring passages. Of the shorter word runs in a window the one with the least hash is its
   anchor, so equal windows have equal anchors and few runs are anchors. Anchors found in two
   documents mark the passages that may recur; passages are cut into segments, and the hashes
   of their windows confirm which recur and give the smallest document that holds each.
2. Automata. Documents are dealt into shards of bounded text. A shard gets the segments of
   smaller documents whose windows its documents hold, and compiles their windows, as sequences
   of word numbers, into Aho-Corasick automata of bounded size.
3. All documents of a shard are streamed through its automata, which find every occurrence
   word for word. Hashes only choose segments; they never remove a word.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from itertools import compress, repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import Scratch, byte_slices, mix, spans, utf8, word_hashes

SIZE = 13
#: Words of an anchor; windows of a segment (a power of two, at most the bits of a long).
GRAM = 6
SEGMENT = 64
#: Bytes of text in a shard of documents; windows and different words of an automaton beyond which
#: the next begins (numbers of words fit in 16 bits); bytes of a shard's documents held at once.
SHARD = 1 << 19
MACHINE = 100_000
NUMBERS = 60_000
HELD = 8 << 20
#: Bytes and words handled at once.
PIECE = 1 << 20
WORDS = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15)
_LAST = (1 << 63) - 1
_NOT = bytes([1, 0]) + bytes(254)


def _runs(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words."""
    n = len(words) - size + 1
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * _BASE + words[k:k + n]
    return mix(out)


def windows(words: np.ndarray, counts: np.ndarray, size: int, gram: int
            ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(first word, anchor's hash, window's hash) of all windows inside rows of ``counts`` words,
    block by block."""
    end = np.repeat(np.cumsum(counts), counts)
    for lo in range(0, len(words) - size + 1, WORDS):
        part = words[lo:lo + WORDS + size - 1]
        grams = _runs(part, gram)
        n = len(part) - size + 1
        anchor = grams[:n].copy()
        for k in range(1, size - gram + 1):
            np.minimum(anchor, grams[k:k + n], out=anchor)
        inside = np.flatnonzero(lo + np.arange(n) + size <= end[lo:lo + n])
        yield lo + inside, anchor[inside], _runs(part, size)[inside]


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _anchors(size: int, gram: int):
    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            ids = batch.column(0).to_numpy()
            for i, j in byte_slices(offsets, PIECE):
                words, counts = word_hashes(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], lower=False)
                row = np.repeat(np.arange(i, j), counts)
                for first, anchor, _ in windows(words, counts, size, gram):
                    if len(first):
                        doc = ids[row[first]]
                        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])])
                        yield pa.RecordBatch.from_arrays([_signed(anchor[new]), pa.array(doc[new])], ["anchor", "id"])
    return run


def _segments(size: int, gram: int):
    """Passages whose anchors recur, in segments: (id, start, text), cut where the number of the
    first word is a multiple of SEGMENT."""
    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            ids = batch.column(0).to_pylist()
            known = batch.column(2)
            sizes = known.value_lengths().to_numpy()
            # a row's anchors and those of other rows must not meet
            apart = mix(np.arange(len(ids), dtype=np.uint64))
            known = np.sort(known.flatten().to_numpy().view(np.uint64) ^ np.repeat(apart, sizes))
            for i, j in byte_slices(offsets, PIECE):
                raw, at = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                words, counts = word_hashes(raw, at, lower=False)
                row, base = np.repeat(np.arange(i, j), counts), np.cumsum(counts) - counts
                first = np.concatenate([np.zeros(0, np.int64)] + [
                    w[_among(anchor ^ apart[row[w]], known)] for w, anchor, _ in windows(words, counts, size, gram)])
                if not len(first):
                    continue
                place = first - base[row[first] - i]
                new = np.flatnonzero(np.concatenate([[True], (np.diff(first) > 1) | (np.diff(row[first]) > 0)
                                                     | (place[1:] % SEGMENT == 0)]))
                last = np.concatenate([new[1:], [len(first)]]) - 1
                starts, ends = spans(raw, at[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[k] for k in row[first[new]]], pa.int64()), pa.array(place[new]),
                     pa.array([raw[x:y].tobytes().decode() for x, y in zip(
                         starts[first[new]], ends[first[last] + size - 1], strict=True)], pa.string())],
                    ["id", "start", "text"])
    return run


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _window_hashes(size: int, gram: int):
    """(window, id, at) of all windows of segments, ``at`` the number of the first word."""
    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            ids, starts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i, j in byte_slices(offsets, PIECE):
                words, counts = word_hashes(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], lower=False)
                row, base = np.repeat(np.arange(i, j), counts), np.cumsum(counts) - counts
                for first, _, window in windows(words, counts, size, gram):
                    of = row[first]
                    yield pa.RecordBatch.from_arrays(
                        [_signed(window), pa.array(ids[of]), pa.array(starts[of] + first - base[of - i])],
                        ["window", "id", "at"])
    return run


def _letters(numbers: np.ndarray) -> str:
    """Two letters a word, the first below 256 and the second above: an automaton walks a node's
    edges one by one, so a node must not have one for every word. Windows match whole words only."""
    out = np.empty(2 * len(numbers), np.uint16)
    out[::2], out[1::2] = numbers >> 8, 256 + (numbers & 255)
    return out.tobytes().decode("utf-16-le")


def _machines(segments: list[tuple[int, int, str]], size: int):
    """(numbers of words, automaton) of the wanted windows of segments, each window with its smallest
    document; automata of bounded size, built one after the other."""
    numbers: dict[bytes, int] = {}
    least: dict[str, int] = {}
    for k, (doc, wanted, text) in enumerate(segments, 1):
        words = text.encode().split()
        seq = _letters(np.array([numbers.setdefault(w, len(numbers) + 1) for w in words], np.uint32))
        for i in range(len(words) - size + 1):
            if wanted >> i & 1:
                key = seq[2 * i:2 * (i + size)]
                if doc < least.get(key, _LAST):
                    least[key] = doc
        if k == len(segments) or len(least) > MACHINE or len(numbers) > NUMBERS:
            machine = ahocorasick.Automaton(ahocorasick.STORE_ANY)
            for key, doc in least.items():
                machine.add_word(key, doc)
            if least:
                machine.make_automaton()
                yield numbers, machine
            numbers, least = {}, {}


def _cut(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, piece by piece; ``bytes.split`` cuts at 09-0D and 20."""
    at = 0
    while at < len(raw):
        cut = at + PIECE
        while cut < len(raw) and raw[cut] not in b" \t\n\v\f\r":
            cut += 1
        yield raw[at:cut].split()
        at = cut


def _pieces(raw: bytes):
    """The words of a text in pieces: a short one's are kept, a long one's split again each time."""
    return [raw.split()] if len(raw) <= PIECE else None


def _mark(machine, pieces, doc: int, size: int, gone: bytearray) -> None:
    """Flag the words of a text that lie in a window of a smaller document."""
    numbers, automaton = machine
    hit = b"\1" * size
    at, before = 0, np.zeros(0, np.uint32)  # place of the piece; last words of the one before
    for words in pieces:
        seq = np.concatenate([before, np.array(list(map(numbers.get, words, repeat(0))), np.uint32)])
        start = at - len(before)
        for end, least in automaton.iter(_letters(seq)):
            if least < doc:
                first = start + end // 2 - size + 1
                gone[first:first + size] = hit
        at += len(words)
        before = seq[-(size - 1):]


def _clean(size: int):
    """Rows of a shard, segments (kind 0, their wanted windows as bits) before documents:
    (id, n_words, n_removed, text)."""
    def flush(segments, built, docs):
        texts = [(kind, doc, raw, _pieces(raw)) for kind, doc, raw in docs]
        gone = [bytearray(sum(map(len, pieces or _cut(raw)))) for _, _, raw, pieces in texts]
        used = 0
        for used, machine in enumerate(built or _machines(segments, size), 1):
            for (_, doc, raw, pieces), flags in zip(texts, gone, strict=True):
                if len(flags) >= size:
                    _mark(machine, pieces or _cut(raw), doc, size, flags)
        if not built and used == 1:
            built.append(machine)  # the shard's only automaton serves its next documents too
        kept = []
        for (_, _, raw, pieces), flags in zip(texts, gone, strict=True):
            parts, at = [], 0
            for words in pieces or _cut(raw):
                parts += compress(words, flags[at:at + len(words)].translate(_NOT)) if 1 in flags else words
                at += len(words)
            kept.append(b" ".join(parts).decode())
        return pa.RecordBatch.from_arrays(
            [pa.array([doc if kind == 1 else None for kind, doc, _, _ in texts], pa.int64()),
             pa.array([len(g) for g in gone], pa.int64()), pa.array([g.count(1) for g in gone], pa.int64()),
             pa.array(kept, pa.string())], ["id", "n_words", "n_removed", "text"])

    def run(batches):
        shard, segments, built, docs, n = None, [], [], [], 0
        for batch in batches:
            for at, kind, doc, text, wanted in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
                if at != shard or n > HELD:
                    if docs:
                        yield flush(segments, built, docs)
                    docs, n = [], 0
                    if at != shard:
                        shard, segments, built = at, [], []
                if kind:
                    docs.append((kind, doc, text.encode()))
                    n += len(text) + 100
                else:
                    segments.append((doc, wanted, text))
        if docs:
            yield flush(segments, built, docs)
    return run


def _let_go(docs: DataFrame) -> None:
    """Spark deletes the shuffle files of finished steps when their plans are garbage; its
    scheduler holds the last plan until another job has run."""
    docs.sparkSession.range(1).count()
    gc.collect()
    docs.sparkSession._jvm.System.gc()


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
                   gram: int = GRAM) -> DataFrame:
    """(id, n_words, n_removed, text) per row: the words that stay, joined by one blank.

    Words are runs ``[^\\x20\\x09-\\x0D]+``, compared as they are. Null and empty texts have no
    words, texts of fewer than ``size`` words lose none. Rows of one id are one document, whose
    rows never remove each other's words. Rows without an id count as larger than any other, and
    among themselves as one document. An empty table gives no rows. Texts are read in pieces; a
    very long one takes about twice its bytes of memory. Other columns are not read.

    Windows meet by 64-bit hashes: two different windows with one hash would hide one of them,
    which at 30 GB of text is expected less than once; removal itself compares the words.
    """
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    known = rows.select(F.coalesce("id", F.lit(_LAST)).alias("id"), "text")

    def anchors():
        return known.mapInArrow(_anchors(size, gram), "anchor long, id long")

    shared = scratch.keep(anchors().groupBy("anchor").agg(F.min("id").alias("a"), F.max("id").alias("b"))
                          .where("a < b").select("anchor"), "anchors")
    _let_go(docs)
    # the hashed sides have one small row a key, so their partitions are even; the others need no sort
    marked = scratch.keep(anchors().join(shared.hint("shuffle_hash"), "anchor").groupBy("id").agg(F.collect_set("anchor").alias("anchors")), "marked")
    _let_go(docs)
    segments = scratch.keep(known.join(marked.hint("shuffle_hash"), "id").select("id", "text", "anchors").mapInArrow(
        _segments(size, gram), "id long, start long, text string"), "segments")
    scratch.drop(shared, marked)
    _let_go(docs)
    found = segments.mapInArrow(_window_hashes(size, gram), "window long, id long, at long")
    recur = scratch.keep(found.groupBy("window").agg(
        F.min("id").alias("least"), F.max("id").alias("most"), F.min_by("at", "id").alias("place"))
        .where("least < most").select("window", "least", "place"), "windows")
    _let_go(docs)
    total = rows.agg(F.sum(F.octet_length("text") + 100)).first()[0] or 0
    shard = F.pmod(F.xxhash64(F.coalesce("id", F.lit(_LAST))), F.lit(max(1, -(-total // SHARD))))

    def segment(place):
        return F.floor(F.col(place) / SEGMENT)

    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % SEGMENT).cast("int"))
    wanted = found.join(recur.hint("shuffle_hash"), "window").where("id > least").groupBy(
        shard.alias("shard"), "least", segment("place").alias("segment")).agg(F.bit_or(bit).alias("wanted"))
    wanted = scratch.keep(wanted, "wanted")
    scratch.drop(recur)
    _let_go(docs)
    first = (F.col("start") % SEGMENT).cast("int")
    compiled = wanted.join(segments, (F.col("least") == F.col("id")) & (F.col("segment") == segment("start"))).select(
        "shard", F.lit(0).alias("kind"), "id", "text",
        F.call_function("shiftrightunsigned", F.col("wanted"), first).alias("wanted"))
    streamed = rows.select(shard.alias("shard"), F.when(F.col("id").isNull(), 2).otherwise(1).alias("kind"),
                           F.coalesce("id", F.lit(_LAST)).alias("id"), "text", F.lit(0).cast("long").alias("wanted"))
    out = compiled.unionByName(streamed).repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(
        _clean(size), "id long, n_words long, n_removed long, text string")
    out = scratch.keep(out.withColumnRenamed("id", id_col), "kept")
    scratch.close(out)
    return out
