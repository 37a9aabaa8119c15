"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text per language knows every substring of that text. A
document is parsed greedily: each phrase is the longest match of what is left in the
language's text. With c phrases over n characters against a text of N characters the
cross-entropy is about ``c * log2(N) / n`` bits a character; the language needing the
fewest normalised phrases wins.

At a mismatch the next phrase begins at the automaton's root, so an automaton is a dense
table ``state x symbol -> state`` with a mark on mismatches, and one gather advances many
documents by one character. Documents are laid out in blocks of BLOCK characters (phrases
end at block ends, alike for all languages), so long and short texts fill the lanes evenly.
"""

from __future__ import annotations

import math
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ticklake.llm.common import Scratch, bucket_sample, byte_slices, utf8

BLOCK = 256
#: Characters laid out, and bytes of text taken from a batch, at once in a worker.
LAYOUT_CHARS = 1 << 19
SLICE = 1 << 20
UND = "und"
#: Letters of an alphabet written as one symbol each, at most.
ONE_SYMBOL = 250
#: Bytes of the automata that a worker holds at once.
GROUP_BYTES = 256 << 20


@dataclass
class Alphabet:
    """The letters of one language: a row of symbols per step, by the model's code of a
    character, and the number of symbols."""

    steps: np.ndarray
    width: int


@dataclass
class Model:
    """codes: code of each code point (0: padding, 1: not a letter, 2: a letter that no language
    taught). taught: per language the symbols of its text. bits: log2 of their numbers."""

    languages: list[str]
    codes: np.ndarray
    alphabets: list[Alphabet]
    taught: list[np.ndarray]
    bits: list[float]

    def groups(self, most: int | None = None) -> list[tuple[int, int]]:
        """Ranges of languages whose automata (at most two states a symbol) take at most
        ``most`` bytes together; a larger automaton is a group of its own."""
        most, out, size = most or GROUP_BYTES, [], 0
        for k, (text, alphabet) in enumerate(zip(self.taught, self.alphabets, strict=True)):
            need = 8 * (len(text) + 1) * alphabet.width
            if not out or size + need > most:
                out.append((k, k))
                size = 0
            out[-1] = (out[-1][0], k + 1)
            size += need
        return out

    def part(self, first: int, end: int) -> Part:
        """The automata of some languages."""
        return Part(self.languages[first:end], self.codes, self.alphabets[first:end],
                    [_automaton(t, a.width) for t, a in
                     zip(self.taught[first:end], self.alphabets[first:end], strict=True)], self.bits[first:end])


@dataclass
class Part:
    """Languages with their automata: flat tables, entries ``2 * (state * width) + mismatch``."""

    languages: list[str]
    codes: np.ndarray
    alphabets: list[Alphabet]
    tables: list[np.ndarray]
    bits: list[float]


def _symbols(texts: list[str], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, runs of non-letters as one, and each text's count."""
    low = [t.lower() for t in texts]
    lens = np.fromiter(map(len, low), np.int64, len(low))
    raw = np.frombuffer(bytearray("".join(low), "utf-32-le", "surrogatepass"), np.uint32)
    sym = codes[raw]
    blank = sym == 1
    keep = np.ones(len(sym), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    ends = np.cumsum(lens)
    first = (ends - lens)[lens > 0]
    keep[first] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return sym[keep], kept[ends] - kept[ends - lens]


def _automaton(symbols: np.ndarray, width: int) -> np.ndarray:
    """The suffix automaton of one text as a dense, marked table."""
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols.tolist():
        cur = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p != -1:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    # a mismatch starts the next phrase: the root's own step, marked. A symbol that the text
    # lacks is a phrase by itself; it leads to a last state where every symbol starts a phrase
    restart = np.full(width, len(step), np.int64)
    for c, s in step[0].items():
        restart[c] = s
    table = np.tile(2 * width * restart + 1, (len(step) + 1, 1))
    for s, out in enumerate(step):
        if out:
            table[s, list(out)] = 2 * width * np.fromiter(out.values(), np.int64, len(out))
    table[:, 0] = 2 * width * np.arange(len(step) + 1)  # padding stays where it is
    return table.astype(np.int32).ravel()


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", rows_per_language: int = 256,
          chars_per_language: int = 32_000) -> Model:
    """Fit the automata on a bounded sample: at most ``rows_per_language`` rows of each
    language, of each an excerpt, ``chars_per_language`` characters in all. Null texts or
    languages teach nothing. The model holds these characters, so it grows with the number of
    languages only; its automata are made in groups."""
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang"))
    chosen = bucket_sample(rows.select("_id", "_lang"), "_id", ["_lang"], rows_per_language)
    # at most rows_per_language ids of each language: a proven bound
    picked = rows.join(F.broadcast(chosen), ["_id", "_lang"], "left_semi").select(
        "_id", "_lang", F.expr(f"substring(_text, 1, {chars_per_language})").alias("_text"))
    by: dict[str, list[str]] = {}
    for r in sorted(picked.collect(), key=lambda r: (r["_lang"], str(r["_id"]), r["_text"])):
        if any(c.isalpha() for c in r["_text"]):
            by.setdefault(r["_lang"], []).append(r["_text"])
    return fit(by, chars_per_language)


def _alphabet(letters: list[int], codes: int) -> Alphabet:
    """Symbols of a language's letters (given by code) among all ``codes``."""
    n = len(letters)
    if n <= ONE_SYMBOL:
        steps = np.full((1, codes), 2, np.int32)
        steps[0, letters] = np.arange(3, n + 3)
        width = n + 3
    else:  # a leading and a trailing symbol, as many of each as of the other
        side = math.isqrt(n - 1) + 1
        steps = np.full((2, codes), 2, np.int32)
        steps[0, letters] = 3 + np.arange(n) // side
        steps[1, letters] = 3 + side + np.arange(n) % side
        width = 3 + 2 * side
    steps[:, 0], steps[:, 1] = 0, 1
    return Alphabet(steps, width)


def fit(by_language: dict[str, list[str]], chars: int = 32_000) -> Model:
    """The model of given texts, an even share of ``chars`` from each."""
    taught: dict[str, list[str]] = {}
    for lang, texts in sorted(by_language.items()):
        texts = sorted(set(texts), key=lambda t: (len(t), t))
        left, out = chars, []
        for k, t in enumerate(texts):  # short texts first, so their unused share passes on
            cut = t.lower()[:max(1, left // (len(texts) - k))]
            out.append(cut)
            left -= len(cut)
        taught[lang] = out
    seen = sorted({c for texts in taught.values() for t in texts for c in t if _is_letter(ord(c))})
    codes = np.ones(0x110000, np.int32)
    for cp in range(0x110000):
        if _is_letter(cp):
            codes[cp] = 2
    codes[[ord(c) for c in seen]] = np.arange(3, len(seen) + 3)
    model = Model([], codes, [], [], [])
    for lang, texts in taught.items():
        text, _ = _symbols([t + "\n" for t in texts], codes)
        alphabet = _alphabet(sorted(set(text[text > 2].tolist())), len(seen) + 3)
        text = alphabet.steps[:, text].T.ravel()
        model.languages.append(lang)
        model.alphabets.append(alphabet)
        model.taught.append(text.astype(np.int16))
        model.bits.append(math.log2(max(2, len(text))))
    return model


def _is_letter(cp: int) -> bool:
    return unicodedata.category(chr(cp))[0] == "L"


def phrases(model: Model | Part, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases of each text against each language, its characters and its letters."""
    if isinstance(model, Model):
        model = model.part(0, len(model.languages))
    sym, lens = _symbols(texts, model.codes)
    ends = np.cumsum(lens)
    letters = np.concatenate([[0], np.cumsum(sym > 1)])
    letters = letters[ends] - letters[ends - lens]
    blocks = -(-lens // BLOCK)
    first = np.cumsum(blocks) - blocks
    within = np.arange(len(sym)) - np.repeat(ends - lens, lens)
    lanes = int(blocks.sum())
    grid = np.zeros((BLOCK, lanes), np.int32)
    grid[within % BLOCK, np.repeat(first, lens) + within // BLOCK] = sym
    out = np.zeros((len(texts), len(model.languages)), np.int64)
    owner = np.repeat(np.arange(len(texts)), blocks)
    for k, (alphabet, table) in enumerate(zip(model.alphabets, model.tables, strict=True)):
        state = np.full(lanes, len(table) - alphabet.width, np.int32)  # the last state
        count = np.zeros(lanes, np.int32)
        for row in grid:
            for step in alphabet.steps:
                state += step.take(row)
                entry = table.take(state)
                count += entry & 1
                state = entry >> 1
        out[:, k] = np.bincount(owner, count, len(texts))
    return out, lens, letters


def _entropies(part: Part, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Bits a character of each text against each language, and its letters, whatever the
    texts' lengths, in bounded pieces."""
    pieces, owner = [], []
    for i, t in enumerate(texts):
        t = t or ""
        for at in range(0, max(1, len(t)), LAYOUT_CHARS):
            pieces.append(t[at:at + LAYOUT_CHARS])
            owner.append(i)
    n, m = len(texts), len(part.languages)
    count, lens, letters = np.zeros((n, m)), np.zeros(n), np.zeros(n)
    at = 0
    while at < len(pieces):
        to, size = at, 0
        while to < len(pieces) and (to == at or size + len(pieces[to]) <= LAYOUT_CHARS):
            size += len(pieces[to])
            to += 1
        c, s, x = phrases(part, pieces[at:to])
        np.add.at(count, owner[at:to], c)
        np.add.at(lens, owner[at:to], s)
        np.add.at(letters, owner[at:to], x)
        at = to
    return count * np.array(part.bits) / np.maximum(lens, 1)[:, None], letters


def _two_best(part: Part, texts: list[str | None]) -> tuple[list[str | None], np.ndarray, np.ndarray]:
    """The best language of each text (null: no letter), its bits and those of the second."""
    bits, letters = _entropies(part, texts)
    if not part.languages:
        return [None] * len(texts), np.full(len(texts), np.inf), np.full(len(texts), np.inf)
    best = bits.argmin(1)
    low = bits[np.arange(len(texts)), best]
    rest = bits.copy()
    rest[np.arange(len(texts)), best] = np.inf
    return [part.languages[b] if x else None for b, x in zip(best, letters, strict=True)], low, rest.min(1)


def _scores(low: np.ndarray, second: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The second's share of the two best entropies; 1 without a second, 0 for ``und``."""
    lone = np.isinf(second)
    share = np.where(lone, 1.0, np.where(lone, 0, second) / np.maximum(np.where(lone, 1, low + second), 1e-12))
    return np.where(known, share, 0.0)


def classify(model: Model | Part, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    if isinstance(model, Model):
        model = model.part(0, len(model.languages))
    lang, low, second = _two_best(model, texts)
    known = np.array([x is not None for x in lang], bool)
    return [x or UND for x in lang], _scores(low, second, known)


def _by_slices(batches, at: int, result):
    """Batches with the columns that ``result`` makes of their texts, a slice at a time."""
    for batch in batches:
        for i, j in byte_slices(utf8(batch.column(at))[1], SLICE):
            part = batch.slice(i, j - i)
            made = result(part, part.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*part.columns, *made.values()], [*part.schema.names, *made])


def predict(docs: DataFrame, model: Model, text_col: str = "text", group_bytes: int | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; all other columns pass through.

    A text that is null, empty or without a letter is ``und`` with score 0. Of languages
    with equal phrases the first by name wins, with score 0.5. Repeated rows get equal
    results; a column of ``docs`` that is named like a result is replaced by it. Languages
    whose automata take more than ``group_bytes`` (GROUP_BYTES) together are met in several
    passes over the documents, each written to the shared folder.
    """
    spark = docs.sparkSession
    docs = docs.drop("lang_pred", "score")
    at = docs.columns.index(text_col)
    groups = model.groups(group_bytes)
    if len(groups) > 1:
        return _predict_in_groups(docs, model, at, groups)
    shared = spark.sparkContext.broadcast(model.part(0, len(model.languages)))  # one group: bounded

    def run(batches):
        def result(_, texts):
            lang, score = classify(shared.value, texts)
            return {"lang_pred": pa.array(lang, pa.string()), "score": pa.array(score, pa.float64())}
        return _by_slices(batches, at, result)

    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()),
                         StructField("score", DoubleType())])
    return docs.mapInArrow(run, schema)


def _predict_in_groups(docs: DataFrame, model: Model, at: int, groups: list[tuple[int, int]]) -> DataFrame:
    """One pass a group: the two least entropies so far are carried from pass to pass."""
    scratch = Scratch(docs.sparkSession)
    own = [f"_c{k}" for k in range(len(docs.columns))]
    carried = ["_lang", "_low", "_second"]
    rows = docs.toDF(*own).withColumns({
        "_lang": F.lit(None).cast("string"), "_low": F.lit(float("inf")), "_second": F.lit(float("inf"))})
    for first, end in groups:
        shared = docs.sparkSession.sparkContext.broadcast(model.part(first, end))  # one group: bounded

        def run(batches, shared=shared):
            def result(part, texts):
                lang, low, second = _two_best(shared.value, texts)
                had = part.column("_lang").to_pylist()
                a, b = part.column("_low").to_numpy(), part.column("_second").to_numpy()
                better = low < a  # of equal ones the earlier language stays
                return {"_l": pa.array([n if x else h for n, h, x in zip(lang, had, better, strict=True)], pa.string()),
                        "_a": pa.array(np.minimum(low, a)),
                        "_b": pa.array(np.minimum(np.maximum(low, a), np.minimum(second, b)))}
            return _by_slices(batches, at, result)

        schema = StructType([*rows.schema.fields, StructField("_l", StringType()), StructField("_a", DoubleType()),
                             StructField("_b", DoubleType())])
        made = scratch.keep(rows.mapInArrow(run, schema).select(
            *own, *[F.col(c).alias(to) for c, to in zip(["_l", "_a", "_b"], carried, strict=True)]), "languages")
        scratch.close(made)
        shared.unpersist()
        rows = made
    lone = F.col("_second") == float("inf")
    score = F.when(lone, 1.0).otherwise(F.col("_second") / F.greatest(F.col("_low") + F.col("_second"), F.lit(1e-12)))
    return rows.select(*[F.col(c).alias(n) for c, n in zip(own, docs.columns, strict=True)],
                       F.coalesce("_lang", F.lit(UND)).alias("lang_pred"),
                       F.when(F.col("_lang").isNull(), 0.0).otherwise(score).alias("score"))
