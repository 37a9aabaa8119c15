"""The contract queries of the operators: thin digests of what the operators return."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm import (
    fingerprints, html_text, language_id, licenses, minhash, mixing, packing, prefix_trie,
    quality_classifier, quality_rules, repeats, resampling, warc)
from ticklake.llm.common import remainder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_files() -> tuple[str, str]:
    """Paths of the public vocabulary: as a tokenizer and as merge ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.learn(docs.where(remainder(F.col("doc_id")) != 1))
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        "lang_pred", "score")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def file_path():
    """Documents as files: source, language, a directory of a hundred ids, name."""
    return F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("und")),
                       F.floor(F.col("doc_id") / 100).cast("string"),
                       F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licenses.scan(docs.select("doc_id", file_path().alias("path"), "text"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = table(spark, sf_dir, "labels").where(remainder(F.col("doc_id")) != 1)
    model = quality_classifier.learn(docs, known)
    return quality_classifier.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        "score", "predicted")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    rules = quality_rules.fit(docs, trusted)
    return quality_rules.judge(docs.select("doc_id", "text"), rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "llr")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), *tokenizer_files())


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.length("text").cast("long"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_of(table(spark, sf_dir, "conversations")).drop("hi", "lo")


def op12_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_mix_sources, op3_warc, op4_near_duplicates, op5_license_scan,
    op6_quality_classifier, op7_quality_rules, op8_fingerprints, op9_packing, op10_main_text,
    op11_prefix_trie, op12_repeated_passages, op13_resample)}

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {1 + 5 * g}, 5))::BIGINT >> {s}) & 31)::INT, 1)"
    for g in range(8) for s in (15, 10, 5, 0))



def _crc32(blob: str) -> str:
    """Unsigned CRC-32 of a blob in SQL: bit by bit over the bytes of its hexadecimal form."""
    byte = f"list_transform(range(1, length(hex({blob})) + 1, 2), lambda i: ('0x' || substr(hex({blob}), i, 2))::BIGINT)"
    step = "list_reduce(range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), xor(a, b))"
    return f"xor(4294967295::BIGINT, list_reduce({byte}, lambda a, b: {step}, 4294967295::BIGINT))"


#: All runs of one to three words of the list ``w``.
_FEATURES = ("w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) || "
             "list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])")

ORACLE: dict[str, str] = {
    "op3_warc": f"""
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
             q AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
        SELECT page_id, n::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM q""",
    "op4_near_duplicates": """
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 2
                  THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
                  WHEN len(w) = 1 THEN w ELSE [] END) AS g FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        x AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS x FROM s a JOIN s b
              ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
        e AS (SELECT a, b FROM x JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
              WHERE 100 * x >= 80 * (na.n + nb.n - x)),
        both_ways AS (SELECT a AS u, b AS v FROM e UNION ALL SELECT b, a FROM e),
        reach(u, v) AS (SELECT doc_id, doc_id FROM documents
                        UNION SELECT r.u, t.v FROM reach r JOIN both_ways t ON r.v = t.u)
        SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(r.v) AS component_id,
               d.doc_id = min(r.v) AS kept
        FROM documents d JOIN reach r ON r.u = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
        GROUP BY d.doc_id, n.n""",
    "op11_prefix_trie": f"""
        WITH o AS (SELECT conv_id AS c, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                       coalesce(role, ''), sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
                   FROM conversations WHERE conv_id IS NOT NULL),
             own AS (SELECT c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY i) AS turns FROM o GROUP BY c),
             h AS (SELECT c, turns, {_crc32("encode(c::VARCHAR)")} % 6 AS h FROM own),
             rebuilt AS (SELECT h.c, coalesce(b.turns[1:h.h], []) || h.turns[h.h + 1:] AS turns
                         FROM h LEFT JOIN own b ON b.c = h.c - h.c % 100),
             member AS (SELECT c, unnest(range(0, len(turns) + 1)) AS d, turns FROM rebuilt),
             node AS (SELECT turns[1:d] AS p, d, min(c) AS conv_id, count(*) AS n_convs,
                             string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(turns) = d) AS ends
                      FROM member GROUP BY ALL),
             child AS (SELECT p[1:d - 1] AS p, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
             known AS (SELECT node.*, coalesce(child.n, 0) AS n_children FROM node LEFT JOIN child USING (p)),
             below AS (SELECT known.p[1:a.d] AS p, sum((n_children = 0)::INT) AS n_leaves,
                              sum(CASE WHEN known.d > 0 THEN (n_convs - 1) * length(known.p[known.d].t) ELSE 0 END) AS saved
                       FROM known, unnest(range(0, known.d + 1)) AS a(d) GROUP BY ALL)
        SELECT k.conv_id, k.d::BIGINT AS depth, up.conv_id AS parent_conv_id, k.n_convs, k.n_children::BIGINT AS n_children,
               b.n_leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, sha256(coalesce(k.ends, '')) AS ends_sha256
        FROM known k JOIN below b USING (p) LEFT JOIN node up ON k.d > 0 AND up.p = k.p[1:k.d - 1]""",
    "op12_repeated_passages": """
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
             win AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS s, w FROM d WHERE len(w) >= 13),
             seq AS (SELECT doc_id, s, array_to_string(w[s:s + 12], ' ') AS seq FROM win),
             least AS (SELECT seq, min(doc_id) AS least FROM seq GROUP BY seq),
             hit AS (SELECT doc_id, unnest(range(s, s + 13)) AS i FROM seq JOIN least USING (seq) WHERE doc_id > least),
             gone AS (SELECT doc_id, list(DISTINCT i) AS gone FROM hit GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
               sha256(coalesce(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(gone, []), i)), ' '), ''))
                   AS kept_sha256
        FROM d LEFT JOIN gone USING (doc_id)""",
    "op13_resample": f"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
             b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
             df AS (SELECT doc_id, f, count(*) AS n FROM (SELECT doc_id, unnest({_FEATURES}) AS f FROM d) GROUP BY ALL),
             bf AS (SELECT f, count(*) AS n FROM (SELECT unnest({_FEATURES}) AS f FROM b) GROUP BY ALL),
             code AS (SELECT f, {_crc32("encode(f)")} % 10000 AS bucket
                      FROM (SELECT f FROM df UNION SELECT f FROM bf)),
             s AS (SELECT bucket, sum(n) AS n FROM df JOIN code USING (f) GROUP BY bucket),
             t AS (SELECT bucket, sum(n) AS n FROM bf JOIN code USING (f) GROUP BY bucket),
             gain AS (SELECT k.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE
                          * (coalesce((SELECT sum(n) FROM df), 0) + 10000)::DOUBLE / ((coalesce(s.n, 0) + 1)::DOUBLE
                          * (coalesce((SELECT sum(n) FROM bf), 0) + 10000)::DOUBLE)))::BIGINT AS gain
                      FROM range(10000) k(bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
             weighed AS (SELECT doc_id, sum(n * gain) AS weight, sum(n) AS n_features
                         FROM df JOIN code USING (f) JOIN gain USING (bucket) GROUP BY doc_id),
             scored AS (SELECT d.doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                               len(w) >= 20 AS able, coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln(
                                   (('0x' || sha256('42:' || d.doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
                        FROM d LEFT JOIN weighed USING (doc_id)),
             ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE able)
        SELECT doc_id, n_features, weight, score,
               CASE WHEN rank <= (SELECT 5 * count(*) // 100 FROM ranked) THEN rank END AS rank
        FROM scored LEFT JOIN ranked USING (doc_id)""",
}
