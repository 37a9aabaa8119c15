"""Harmonic packing of token documents into sequences.

A piece of length l belongs to the reciprocal class k = floor(capacity / l): k such pieces
fill a sequence. Documents are cut freely, so each is cut into whole sequences and then
into pieces just under capacity / k, until what a class leaves open is a small share of a
sequence. Every worker packs each class's bins with the fixed count of k pieces, without
talking to others. What stays in bins that never filled is laid end to end and cut anew:
full sequences, then sequences whose length is a power of two, which need no padding.
"""

from __future__ import annotations

import base64
import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import byte_slices, span_hashes, utf8

CAPACITY = 2048
#: The share of a sequence that a class may leave open before a document is cut once more.
OPEN_SHARE = 1 / 64
#: Bytes tokenized at once; places of a worker's word table; ids it may hold.
SLICE_BYTES = 1 << 19
TABLE_BITS = 21
POOL_IDS = 1 << 24
#: White space in ASCII, and beyond it as UTF-8.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
WIDE_SPACES = [chr(c).encode() for c in (
    0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
#: Fixed value: the vocabulary's splitting rule.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PROBE = "It's 2024, naïve Größe — l'été.\n\tx  y 中文 ###"
SCHEMA = ("id {id}, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


class WordTable:
    """Ids of texts by a byte-level BPE vocabulary, each word's ids kept.

    The vocabulary's splitting rule never joins what a blank separates, and a single blank
    goes to the word after it; so the ids of a text are those of its spans, cut before each
    blank. That holds but where a blank with white space before it is followed by white
    space or the end: such texts (and those with white space beyond ASCII, or with a token
    that the vocabulary adds to its merges) go to the tokenizer whole. The table has one place for each hash value, so its memory is bounded;
    a word that lost its place is looked up again. Words are looked up in the same
    vocabulary given as merge ranks, which is faster; a probe makes sure that both agree.
    """

    def __init__(self, path: str, ranks_path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.added = [t["content"].encode() for t in json.load(f).get("added_tokens") or []]
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.ranks = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        if self.tokenizer.encode(PROBE, add_special_tokens=False).ids != self.ranks.encode_ordinary(PROBE):
            raise ValueError("the tokenizer and its ranks do not agree")
        self.id_bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, k in ranks.items():
            self.id_bytes[k] = len(token)
        self.clear()
        for token in self.added:
            probe = f"{PROBE}{token.decode()} x"
            if self.tokenizer.encode(probe, add_special_tokens=False).ids != self.encode(
                    *utf8(pa.array([probe])))[0].tolist():
                raise ValueError("an added token does not reach the tokenizer")

    def clear(self) -> None:
        self.keys = np.zeros(1 << TABLE_BITS, np.uint64)
        self.start = np.zeros(1 << TABLE_BITS, np.int64)
        self.lens = np.full(1 << TABLE_BITS, -1, np.int32)
        self.size = np.zeros(1 << TABLE_BITS, np.int32)
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _keep(self, ids: np.ndarray) -> None:
        while len(self.pool) < self.used + len(ids):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used:self.used + len(ids)] = ids
        self.used += len(ids)

    def _look_up(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
        """Place in the pool and number of ids of each span; the spans are distinct."""
        size = ends - starts
        last = SPACES[data[ends - 1]]
        safe = (data[starts] == 32) & (size > 1) & ~last
        safe[safe] = ~SPACES[data[starts[safe] + 1]]
        at, lens = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        for i in np.flatnonzero(~safe).tolist():
            ids = self.ranks.encode_ordinary(data[starts[i]:ends[i]].tobytes().decode())
            at[i], lens[i] = self.used, len(ids)
            self._keep(np.array(ids, np.uint32))
        safe = np.flatnonzero(safe)
        if len(safe):  # one text of them all: every span ends with an id
            n = size[safe]
            to = np.cumsum(n)
            text = data[np.arange(int(to[-1])) + np.repeat(starts[safe] - to + n, n)]
            ids = np.array(self.ranks.encode_ordinary(text.tobytes().decode()), np.uint32)
            reached = np.cumsum(self.id_bytes[ids])
            end = np.searchsorted(reached, to) + 1
            if not np.array_equal(reached[end - 1], to):
                raise ValueError("an id spans two words")
            lens[safe] = np.diff(end, prepend=0)
            at[safe] = self.used + end - lens[safe]
            self._keep(ids)
        return at, lens

    def _flat(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of plain rows in order, and the number of ids of each row."""
        cut = data == 32
        begins = offsets[:-1]
        cut[begins[begins < len(data)]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        key = span_hashes(data, starts, ends)
        slot = (key >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        hit = (self.keys[slot] == key) & (self.size[slot] == ends - starts) & (self.lens[slot] >= 0)
        at, lens = self.start[slot], self.lens[slot].astype(np.int64)
        miss = np.flatnonzero(~hit)
        if len(miss):
            _, first, inverse = np.unique(key[miss], return_index=True, return_inverse=True)
            one = miss[first]
            new_at, new_lens = self._look_up(data, starts[one], ends[one])
            at[miss], lens[miss] = new_at[inverse], new_lens[inverse]
            self.keys[slot[one]], self.size[slot[one]] = key[one], (ends - starts)[one]
            self.start[slot[one]], self.lens[slot[one]] = new_at, new_lens
        to = np.cumsum(lens)
        ids = self.pool[np.arange(int(to[-1]) if len(to) else 0) + np.repeat(at - to + lens, lens)]
        to = np.concatenate([[0], to])
        row = to[np.searchsorted(starts, offsets)]
        return ids, np.diff(row)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows in order, and the number of ids of each row."""
        if self.used > POOL_IDS:
            self.clear()
        if len(offsets) == 2 and len(data) > 8 * SLICE_BYTES and not odd_rows(data, offsets, self.added)[0]:
            parts, at = [], 0  # one long text, cut before blanks
            while at < len(data):
                blank = np.flatnonzero(data[at + SLICE_BYTES:] == 32) if at + SLICE_BYTES < len(data) else []
                to = at + SLICE_BYTES + int(blank[0]) if len(blank) else len(data)
                parts.append(self._flat(data[at:to], np.array([0, to - at]))[0])
                at = to
            ids = np.concatenate(parts)
            return ids, np.array([len(ids)])
        odd = odd_rows(data, offsets, self.added)
        if not odd.any():
            return self._flat(data, offsets)
        out = []
        for i in range(len(odd)):
            row = data[offsets[i]:offsets[i + 1]]
            if odd[i]:
                out.append(np.array(self.tokenizer.encode(
                    row.tobytes().decode(), add_special_tokens=False).ids, np.uint32))
            else:
                out.append(self._flat(row, np.array([0, len(row)]))[0])
        return np.concatenate(out), np.fromiter(map(len, out), np.int64, len(out))


def odd_rows(data: np.ndarray, offsets: np.ndarray, added: list[bytes] = ()) -> np.ndarray:
    """Rows that cannot be cut before each blank: white space beyond ASCII or an ``added``
    token anywhere, or a blank with white space before it and white space or the end after it."""
    n = len(data)
    if not n:
        return np.zeros(len(offsets) - 1, bool)
    space = SPACES[data]
    blank = data == 32
    after = np.ones(n, bool)
    after[:-1] = space[1:]
    full = offsets[1:][np.diff(offsets) > 0]
    after[full - 1] = True
    before = np.zeros(n, bool)
    before[1:] = space[:-1]
    before[offsets[:-1][np.diff(offsets) > 0]] = False
    bad = blank & before & after
    for lead in [*WIDE_SPACES, *added]:
        hits = np.flatnonzero(data[:max(0, n - len(lead) + 1)] == lead[0])
        for k in range(1, len(lead)):
            hits = hits[data[hits + k] == lead[k]] if k < len(lead) else hits
        bad[hits] = True
    total = np.concatenate([[0], np.cumsum(bad)])
    return total[offsets[1:]] > total[offsets[:-1]]


@lru_cache(maxsize=1)
def word_table(path: str, ranks_path: str) -> WordTable:
    """One table for each worker process."""
    return WordTable(path, ranks_path)


@lru_cache(maxsize=4096)
def cuts(tail: int, capacity: int, open_share: float) -> tuple[int, ...]:
    """Lengths into which the rest of a document, shorter than a sequence, is cut."""
    out = []
    while tail:
        k = capacity // tail
        if capacity - k * tail <= open_share * capacity:
            out.append(tail)
            break
        k += 1  # the next class that shorter pieces fill well enough
        while capacity - k * (capacity // k) > open_share * capacity:
            k += 1
        piece = capacity // k
        out.append(piece)
        tail -= piece
    return tuple(out)


class Packer:
    """Bins of one worker. Rows: (document, start, ids, sequence, offset)."""

    def __init__(self, base: int, capacity: int, open_share: float):
        self.next, self.capacity, self.open_share = base, capacity, open_share
        self.bins: dict[int, list[tuple]] = {}
        self.rows: list[tuple] = []

    def _close(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, start, ids in pieces:
            self.rows.append((doc, start, ids, self.next, at))
            at += len(ids)
        self.next += 1

    def add(self, doc, ids: np.ndarray) -> None:
        full = len(ids) - len(ids) % self.capacity
        for at in range(0, full, self.capacity):
            self._close([(doc, at, ids[at:at + self.capacity])])
        at = full
        for size in cuts(len(ids) - full, self.capacity, self.open_share):
            k = self.capacity // size
            held = self.bins.setdefault(k, [])
            held.append((doc, at, ids[at:at + size]))
            at += size
            if len(held) == k:
                self._close(self.bins.pop(k))

    def finish(self) -> None:
        """Lay the bins that never filled end to end and cut them anew."""
        rest = [p for k in sorted(self.bins) for p in self.bins[k]]
        self.bins = {}
        left = sum(len(p[2]) for p in rest)
        room, held = 0, []
        for doc, start, ids in rest:
            while len(ids):
                if not room:
                    room = self.capacity if left >= self.capacity else 1 << left.bit_length() - 1
                part = ids[:room]
                held.append((doc, start, part))
                ids, start = ids[len(part):], start + len(part)
                room -= len(part)
                left -= len(part)
                if not room:
                    self._close(held)
                    held = []


def pack(docs: DataFrame, tokenizer_path: str, ranks_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, open_share: float = OPEN_SHARE, end_id: int = 1) -> DataFrame:
    """One row per piece: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    A document is the tokenizer's ids of its whole text (null: none), then ``end_id``, so an
    empty text is one token. Each id lies in one piece; the pieces of a sequence follow each
    other without gaps from offset 0, and the lengths of a sequence add up to ``capacity``
    less at most ``open_share`` of it, or to a power of two. Sequence ids are unique; a
    worker numbers its own above its partition's base, so a lost task repeats itself alike.
    Repeated rows and null ids are packed as documents of their own. Other columns of
    ``docs`` are not read. An empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = SCHEMA.format(id=kind)

    def run(batches):
        from pyspark import TaskContext

        table = word_table(tokenizer_path, ranks_path)
        packer = Packer(TaskContext.get().partitionId() << 40, capacity, open_share)

        def flush():
            made, packer.rows = packer.rows, []
            cols = list(zip(*made, strict=True)) or [()] * 5
            ids = [np.ascontiguousarray(x, "<u4") for x in cols[2]]
            return pa.RecordBatch.from_arrays([
                pa.array([d[0] for d in cols[0]], kind_arrow), pa.array(cols[1], pa.int64()),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                pa.array([d[1] for d in cols[0]], pa.int64()),
                pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        kind_arrow = None
        for batch in batches:
            kind_arrow = batch.column(0).type
            keys = batch.column(0).to_pylist()
            data, offsets = utf8(batch.column(1))
            for i, j in byte_slices(offsets, SLICE_BYTES):
                flat, counts = table.encode(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                to = np.cumsum(counts)
                for key, a, b in zip(keys[i:j], (to - counts).tolist(), to.tolist(), strict=True):
                    packer.add((key, b - a + 1), np.append(flat[a:b], np.uint32(end_id)))
                yield flush()
        packer.finish()
        if packer.rows:
            yield flush()

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
