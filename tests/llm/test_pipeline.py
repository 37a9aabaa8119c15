"""The corpus pipeline: what each stage keeps, and the rows of the whole."""

from __future__ import annotations

from collections import defaultdict

import corpus_pipeline as P
import __spark_entry__ as E
from tests.conftest import SF_SMALL
from ticklake.llm import minhash, mixing


def test_stages_are_in_order():
    assert [name for name, _ in P.STAGES] == ["language_id", "quality_rules", "near_duplicates", "mix_sources", "packing"]
    assert E.queries()["pipeline"] is P.run
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in E.queries() if q.startswith("op")}


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    extra = [(9001, None, "en", "src1", 0), (9002, "123 ... !!", "en", "src1", 10),
             (9003, "too few words", None, None, 13)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema)).cache()
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    a = P.identify_language(spark, docs, SF_SMALL)
    assert a.columns == docs.columns
    assert not ids(a) & {9001, 9002} and len(ids(a)) >= 0.95 * docs.count()
    b = P.quality_filter(spark, a, SF_SMALL)
    assert b.columns == docs.columns and 9003 not in ids(b)
    c = P.drop_near_duplicates(spark, b, SF_SMALL)
    found = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(b).collect()}
    assert c.columns == docs.columns and ids(c) == set(found.values())
    d = P.mix(spark, c, SF_SMALL)
    assert d.columns == docs.columns
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(c).collect() if r["copies"]}
    got = defaultdict(int)
    for r in d.select("doc_id").collect():
        got[r["doc_id"]] += 1
    assert dict(got) == copies


def test_clashing_columns_pass_through(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60).select(
        "*", F.lit("own").alias("score"), F.lit(5).alias("kept"), F.lit("x").alias("lang_pred"), F.lit(2).alias("llr"))
    for stage in (P.identify_language, P.quality_filter, P.drop_near_duplicates, P.mix):
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns
        assert {(r["score"], r["kept"], r["lang_pred"], r["llr"]) for r in out.collect()} <= {("own", 5, "x", 2)}


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("doc_id < 0")
    for _, stage in P.STAGES:
        assert stage(spark, docs, SF_SMALL).count() == 0


def test_run_packs_what_the_stages_keep(spark):
    rows = P.run(spark, SF_SMALL).collect()
    assert rows
    by_seq = defaultdict(list)
    for r in rows:
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by_seq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
