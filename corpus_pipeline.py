"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm import language_id, minhash, mixing, packing, quality_rules
from ticklake.llm.common import Scratch
from ticklake.llm.queries import table, tokenizer_files


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; texts without a letter, or as near to two
    languages as to one, go."""
    model = language_id.learn(docs)
    judged = language_id.predict(docs.withColumnsRenamed({"score": "_s", "lang_pred": "_l"}), model)
    return judged.where((F.col("lang_pred") != language_id.UND) & (F.col("score") > 0.5)).select(
        *[F.col({"score": "_s", "lang_pred": "_l"}.get(c, c)).alias(c) for c in docs.columns])


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the likelihood ratio keep."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    rules = quality_rules.fit(docs, trusted)
    own = docs.select("*", F.struct(*docs.columns).alias("_row"))
    return quality_rules.judge(own, rules).where("kept").select("_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id."""
    found = minhash.near_duplicates(docs)
    gone = found.where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    # what goes grows with the corpus: a shuffle join at every size, never a broadcast
    return docs.join(gone.hint("merge"), docs["doc_id"] == gone["_gone"], "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.take(docs, mixing.mix_sources(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs, *tokenizer_files())


STAGES = [("language_id", identify_language), ("quality_rules", quality_filter),
          ("near_duplicates", drop_near_duplicates), ("mix_sources", mix), ("packing", pack)]

#: SQL cannot express the stages; tests compare them with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        scratch.close(docs)
    return docs
