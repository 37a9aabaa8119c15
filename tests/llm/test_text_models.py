"""Language ID, quality classifier and quality rules against brute force and held-out rows."""

from __future__ import annotations

import math
import random
import re
import sys
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_CHECK
from ticklake.llm import common, language_id, quality_classifier, quality_rules
from ticklake.llm.common import bucket_sample, remainder, utf8, word_hashes

SCHEMA = "doc_id long, text string, lang string, source string, score double, kept string"
ODD_TEXTS = [None, "", "  \n\t ", "a", "12 34 !!", "word " * 3000, "line\nline\nline\n", "x" * 5000]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def odd_docs(spark):
    rows = [(k, t, None if k == 2 else "en", None if k == 1 else "s", 1.0, "x") for k, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id here", "en", "s", 1.0, "x"), rows[5], rows[5]]
    return spark.createDataFrame(rows, SCHEMA)


def longest_match_phrases(text: str, taught: str) -> int:
    count = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at:at + size + 1] in taught:
            size += 1
        count, at = count + 1, at + size
    return count


def test_phrases_are_greedy_longest_matches():
    taught = {"xx": ["the cat sat on the mat and the hat"], "yy": ["der hund und die katze"]}
    model = language_id.fit(taught, 1000)
    for text in ("the hat and the katze", "und the der", "zzz the", "abc"):
        got, lens, _ = language_id.phrases(model, [text])
        for k, lang in enumerate(model.languages):
            known = taught[lang][0] + " "
            clean = "".join(c if any(c in t[0] for t in taught.values()) else "#" for c in text)
            assert got[0][k] == longest_match_phrases(clean, known), (text, lang)
        assert lens[0] == len(text)


def test_language_of_odd_texts(spark):
    model = language_id.fit({"en": ["the word is here and there"], "de": ["das wort ist hier und dort"]}, 500)
    rows = language_id.predict(odd_docs(spark), model).collect()
    assert len(rows) == len(ODD_TEXTS) + 3
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    for k, t in enumerate(ODD_TEXTS):
        blank = not any(c.isalpha() for c in t or "")
        assert (by[k]["lang_pred"] == "und") == blank
        assert 0 <= by[k]["score"] <= 1
    assert by[5]["kept"] == "x" and by[5]["source"] == "s"
    empty = language_id.predict(spark.createDataFrame([], SCHEMA), model)
    assert empty.count() == 0


def test_language_without_taught_rows_is_und(spark):
    model = language_id.learn(spark.createDataFrame([(1, None, "en", "s", 0.0, "")], SCHEMA))
    got = language_id.predict(odd_docs(spark), model).select("lang_pred", "score").distinct().collect()
    assert [tuple(r) for r in got] == [("und", 0.0)]


def test_pieces_of_a_long_text_add_up(monkeypatch):
    model = language_id.fit({"en": ["the word is here"], "fr": ["le mot est ici"]}, 500)
    text = "le mot est the word ici " * 400
    want = language_id.classify(model, [text, "the word"])
    monkeypatch.setattr(language_id, "LAYOUT_CHARS", 1024)
    got = language_id.classify(model, [text, "the word"])
    assert got[0] == want[0]
    assert np.allclose(got[1], want[1], atol=0.02)


def test_every_alphabet_is_whole_and_large_ones_take_two_symbols(spark):
    rng = random.Random(5)
    han = [chr(0x4E00 + k) for k in range(3000)]
    words = [[rng.choice(han) for _ in range(rng.randint(1, 3))] for _ in range(4000)]
    taught = {"zh": ["".join("".join(w) for w in words)], "en": ["the word is here and there " * 50]}
    model = language_id.fit(taught, 32_000)
    zh = model.languages.index("zh")
    assert len(model.alphabets[zh].steps) == 2 and model.alphabets[zh].width < 130
    assert len(model.taught[zh]) == 2 * (len(taught["zh"][0]) + 1)  # nothing of the sample is dropped
    assert (model.taught[zh] != 2).all()
    text = "".join("".join(w) for w in words[900:960])
    assert language_id.classify(model, [text, "the word and here"])[0] == ["zh", "en"]
    part = model.part(0, 2)
    assert sum(t.nbytes for t in part.tables) <= sum(
        8 * (len(t) + 1) * a.width + 8 * a.width for t, a in zip(model.taught, model.alphabets, strict=True))


def test_a_hundred_languages_in_groups(spark):
    rng = random.Random(9)
    by = {}
    for k in range(100):
        letters = rng.sample("abcdefghijklmnopqrstuvwxyz", 8)
        vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(60)]
        by[f"l{k:02d}"] = [" ".join(rng.choice(vocabulary) for _ in range(200))]
    model = language_id.fit(by, 2000)
    most = 1 << 20
    groups = model.groups(most)
    assert len(groups) > 3 and [k for a, b in groups for k in range(a, b)] == list(range(100))
    assert all(sum(t.nbytes for t in model.part(*g).tables) <= 1.1 * most for g in groups)
    docs = [(k, " ".join(by[f"l{k:02d}"][0].split()[20:60]), "clash") for k in range(100)]
    df = spark.createDataFrame([*docs, (100, None, "x"), (101, "12 !", None)], "doc_id long, text string, _lang string")
    whole = {r["doc_id"]: r for r in language_id.predict(df, model).collect()}
    split = {r["doc_id"]: r for r in language_id.predict(df, model, group_bytes=most).collect()}
    assert whole == split and [r["lang_pred"] for k, r in sorted(split.items())][-2:] == ["und", "und"]
    assert sum(split[k]["lang_pred"] == f"l{k:02d}" for k in range(100)) >= 99


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    model = language_id.learn(docs.where(remainder(F.col("doc_id")) != 1))
    held = language_id.predict(docs.where(remainder(F.col("doc_id")) == 1), model)
    right = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97


def test_bucket_sample_is_bounded_and_stable(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 3).alias("g"))
    a = {tuple(r) for r in bucket_sample(df, "doc_id", ["g"], 40).collect()}
    b = {tuple(r) for r in bucket_sample(df.repartition(7), "doc_id", ["g"], 40).collect()}
    assert a == b and all(v <= 40 for v in Counter(g for g, _ in a).values())


def test_word_hashes_match_words_whatever_the_pieces(monkeypatch):
    from ticklake.llm import common

    texts = ["Ab cd\tab\nCD", "", "x", " lead and trail ", "é ü 中文 é", "many words " * 700]
    data, offsets = utf8(pa.array([None, *texts]))
    h, n = word_hashes(data, offsets)
    want = [w for t in texts for w in WORD.findall(t.encode().lower().decode())]
    assert n.tolist() == [0] + [len(WORD.findall(t)) for t in texts]
    same: dict[str, int] = {}
    for w, x in zip(want, h.tolist(), strict=True):
        assert same.setdefault(w, x) == x
    assert len(set(same.values())) == len(same)
    monkeypatch.setattr(common, "PIECE", 64)
    data, offsets = utf8(pa.array([texts[-1]]))
    assert word_hashes(data, offsets)[0].tolist() == h[-1400:].tolist()


def base_rules(text: str | None) -> tuple:
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered))


def test_base_rules_match_brute_force(spark):
    texts = ODD_TEXTS + ["a b c d e f a b c d e", "p q r s t " * 2 + "x y z", "# a\n* b\n# a\n\n \n# a",
                         "Größe ß 中 | <x>\r\n\x0b\x0cend", "a a a a a a a", "1 2 3 4 5 6 1 2 3 4 5 9 4 5 6 1 2"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    rows = quality_rules.judge(docs, quality_rules.Rules([0.0] * 8, -math.inf)).collect()
    for r in rows:
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        want = base_rules(texts[r["doc_id"]])
        assert got == want, texts[r["doc_id"]]
        failed = want[0] < 10 or 100 * want[4] > 20 * want[0]
        assert r["base_failed"] == failed and r["kept"] == (not failed)


def test_base_rules_of_the_table(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text")
    for r in quality_rules.judge(docs, quality_rules.Rules([0.0] * 8, -math.inf)).collect():
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert got == base_rules(r["text"]), r["doc_id"]


def test_likelihood_ratio_matches_counts(spark):
    docs = spark.createDataFrame([(1, "good words here now"), (2, "bad bad junk"), (3, None), (4, "good bad")],
                                 "doc_id long, text string")
    trusted = spark.createDataFrame([(1,), (99,), (None,)], "doc_id long")
    n = 64
    weights = quality_rules.fit_weights(docs, trusted, buckets=n)
    grams = {r["doc_id"]: r["g"] for r in docs.select("doc_id", quality_rules.grams(quality_rules.word_hashes(F.col("text")), n).alias("g")).collect()}
    raw, good = Counter(b for g in grams.values() for b in g), Counter(grams[1])
    total_raw, total_good = sum(raw.values()) + n, sum(good.values()) + n
    want = [math.log((good[b] + 1) / total_good) - math.log((raw[b] + 1) / total_raw) for b in range(n)]
    assert np.allclose(weights, want)
    got = {r["doc_id"]: r["llr"] for r in quality_rules.judge(docs, quality_rules.Rules(weights, 0.0)).collect()}
    assert got[3] is None
    for k in (1, 2, 4):
        assert got[k] == pytest.approx(np.mean([want[b] for b in grams[k]]), abs=1e-4)


def test_quality_rules_on_odd_rows(spark):
    rules = quality_rules.fit(odd_docs(spark), spark.createDataFrame([], "doc_id long"))
    assert set(rules.weights) == {0.0}
    out = quality_rules.judge(odd_docs(spark), rules)
    assert out.where("kept = base_failed").count() == 0  # nobody to learn from: the base rules decide
    assert out.count() == len(ODD_TEXTS) + 3
    assert out.where("kept is null or base_failed is null").count() == 0
    assert quality_rules.judge(spark.createDataFrame([], SCHEMA), rules).count() == 0
    assert quality_rules.fit(spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1,)], "doc_id long")).threshold == -math.inf


def test_quality_rules_follow_labels(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    rules = quality_rules.fit(docs, labels.where("quality = 1").select("doc_id"))
    judged = quality_rules.judge(docs, rules).join(labels, "doc_id")
    rate = {r["quality"]: r["k"] for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert rate[1] > 0.97 and rate[0] < 0.1


def test_threshold_is_what_held_out_trusted_documents_reach(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text")
    trusted = spark.read.parquet(f"{SF_CHECK}/labels.parquet").where("quality = 1").select("doc_id")
    lost = 0.1
    rules = quality_rules.fit(docs, trusted, lost=lost)
    held = quality_rules.judge(docs, rules).join(trusted, "doc_id").where("pmod(xxhash64(doc_id, 41), 4) = 1 and n_words > 0")
    z = sorted(round((r.llr + quality_rules.STRAY / math.sqrt(r.n_words)) / quality_rules.STEP, 6) for r in held.collect())
    under = sum(math.floor(x) < round(rules.threshold / quality_rules.STEP) for x in z)
    assert under <= lost * len(z) < under + sum(math.floor(x) == round(rules.threshold / quality_rules.STEP) for x in z)
    monkeypatch.setattr(quality_rules, "BROADCAST_IDS", 0)  # the way beyond the checked size
    assert quality_rules.fit(docs, trusted, lost=lost) == rules


def test_buckets_grow_with_the_text(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    few, all_ = quality_rules.bucket_count(docs.limit(10)), quality_rules.bucket_count(docs)
    assert few == 1 << quality_rules.BITS[0] and all_ > few
    assert quality_rules.bucket_count(docs.limit(0)) == few


def test_classifier_features_and_scores(spark):
    data, offsets = utf8(pa.array(ODD_TEXTS, pa.string()))
    x = quality_classifier.features(data, offsets)
    assert x.shape == (len(ODD_TEXTS), quality_classifier.N_FEATURES) and np.isfinite(x).all()
    one = np.concatenate([quality_classifier.features(*utf8(pa.array([t], pa.string()))) for t in ODD_TEXTS])
    assert np.allclose(x, one)  # a text's features do not depend on its neighbours
    rng = np.random.default_rng(3)
    z = rng.normal(size=(400, quality_classifier.N_FEATURES))
    y = (z[:, 0] + 0.3 * z[:, 1] > 0.7).astype(int)
    model = quality_classifier.fit(z, y, float((y == 0).mean()))
    assert ((model.score(z) >= 0.5) == y).mean() > 0.95
    out = quality_classifier.predict(odd_docs(spark), model)
    assert out.count() == len(ODD_TEXTS) + 3
    assert out.where("score is null or score < 0 or score > 1 or predicted <> int(score >= 0.5)").count() == 0
    assert out.columns.count("score") == 1
    assert quality_classifier.predict(spark.createDataFrame([], SCHEMA), model).count() == 0


def test_features_of_long_texts_in_pieces(monkeypatch):
    rng = random.Random(2)
    words = ["alpha", "Beta#", "x", "#", "gamma!", "d" * 90, "ünï", "beta"]
    for sep in (" ", "\n", "  \n\n"):
        text = sep.join(rng.choice(words) for _ in range(900))
        for t in (text, text + "\n", " " + text, "y" * 700, "\n" * 700, text + " " * 300 + "z" * 500):
            data, offsets = utf8(pa.array([t], pa.string()))
            want = quality_classifier.features(data, offsets)
            for piece in (64, 97):
                monkeypatch.setattr(quality_classifier, "PIECE", piece)
                monkeypatch.setattr(common, "PIECE", piece)
                assert np.array_equal(quality_classifier.features(data, offsets), want), (sep, piece, t[:20])
                monkeypatch.undo()


def test_features_of_fifty_megabytes_are_bounded():
    line = np.frombuffer(b"some words of a very long text that goes on and on, line by line #1\n", np.uint8)
    data = np.tile(line, 50_000_000 // len(line))
    tracemalloc.start()
    x = quality_classifier.features(data, np.array([0, len(data)]))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.isfinite(x).all() and most < 600 << 20


def test_classifier_without_labels_is_undecided(spark):
    none = spark.createDataFrame([(1, None)], "doc_id long, quality int")
    model = quality_classifier.learn(odd_docs(spark), none)
    got = quality_classifier.predict(odd_docs(spark), model).select("score").distinct().collect()
    assert [r[0] for r in got] == [0.5]


def test_classifier_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    fold = remainder(F.col("doc_id")) == 1
    model = quality_classifier.learn(docs, labels.where(~fold))
    got = quality_classifier.predict(docs.where(fold), model).join(labels, "doc_id")
    assert got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0] > 0.95


assert sys.version_info >= (3, 10)


def test_every_labelled_document_teaches_quality(spark, monkeypatch):
    """More rows of a label than a block holds, the other rare: mean, weights and threshold are those
    of all rows, whatever the blocks."""
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["oak", "elm", "ash", "fir"], rng.integers(3, 30))) + (" ##" if k % 40 == 0 else ".")
             for k in range(5000)]
    y = [0 if k % 40 == 0 or k % 97 == 0 else 1 for k in range(5000)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, q) for k, q in enumerate(y)], "doc_id long, quality int")
    monkeypatch.setattr(quality_classifier, "BLOCK_ROWS", 500)
    model = quality_classifier.learn(docs, labels)
    x = quality_classifier.features(*utf8(pa.array(texts)))
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale, np.where(x.std(0) > 1e-9, x.std(0), 1))
    whole = quality_classifier.fit(x, np.array(y), y.count(0) / len(y), pairs=200_000)
    u = np.sort(np.clip((x - model.mean) / model.scale, -8, 8) @ model.weights)
    assert model.threshold == pytest.approx((u[y.count(0) - 1] + u[y.count(0)]) / 2)
    assert np.corrcoef(model.score(x), whole.score(x))[0, 1] > 0.99
    # every row of each label is in a pair
    z = rng.normal(size=(9, quality_classifier.N_FEATURES))
    d = quality_classifier._differences(0, z[:2], z[2:])
    pairs = {(i, j) for r in d for i in range(2) for j in range(2, 9) if np.allclose(r, z[j] - z[i])}
    assert {i for i, _ in pairs} == {0, 1} and {j for _, j in pairs} == set(range(2, 9))
