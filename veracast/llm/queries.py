"""The registered queries of the operators, with their production parameters, and their DuckDB statements."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, collocations, decontamination, exact_dedup, html_text, importance_resampling, line_dedup, piecewise_hash, simhash, substring_dedup, suffix_dedup,
    token_counts, toxicity,
)
from .common import read


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.remove_boilerplate(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def _removed(spans: str) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["begin"]).alias("n_removed")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_passages(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", _removed("spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    n_spans = F.size("spans").cast("long").alias("n_spans")
    return kept.select("doc_id", "n_bytes", _removed("spans"), n_spans, F.sha2("kept", 256).alias("kept_sha256"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_duplicates(read(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piecewise_hash.fingerprint_edits(read(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_line_dedup": op2_line_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_simhash": op5_simhash,
    "op6_html": op6_html,
    "op7_decontamination": op7_decontamination,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_fingerprints": op11_fingerprints,
    "op12_collocations": op12_collocations,
    "op13_resampling": op13_resampling,
}

ORACLE = {
    "op7_decontamination": """
        WITH doc_words AS (
            SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents WHERE text IS NOT NULL
        ), item_words AS (
            SELECT item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM benchmark WHERE text IS NOT NULL
        ), doc_shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]
                                               WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM doc_words
        ), item_shingles AS (
            SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]
                                                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM item_words
        ), sizes AS (SELECT item_id, count(*) AS n FROM item_shingles GROUP BY item_id),
        shared AS (
            SELECT d.doc_id, i.item_id, count(*) AS k FROM doc_shingles d JOIN item_shingles i ON d.s = i.s GROUP BY ALL
        )
        SELECT doc_id, item_id, k::BIGINT AS n_shared, n::BIGINT AS n_shingles, k::DOUBLE / n AS containment
        FROM shared JOIN sizes USING (item_id) WHERE 10 * k >= 8 * n""",
    "op2_line_dedup": """
        WITH cut AS (
            SELECT doc_id, coalesce(source, '') AS site, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
            FROM documents
        ), keyed AS (
            SELECT *, trim(regexp_replace(line, '[\\x09-\\x0D]', ' ', 'g'), ' ') AS bare FROM cut
        ), wide AS (
            SELECT bare FROM keyed WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT site) >= 5
        )
        SELECT k.doc_id, count(*) FILTER (k.bare <> '')::BIGINT AS n_lines, count(w.bare)::BIGINT AS n_removed,
               sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.place) FILTER (w.bare IS NULL), '')) AS kept_sha256
        FROM keyed k LEFT JOIN wide w ON k.bare = w.bare
        GROUP BY k.doc_id""",
    "op9_exact_dedup": """
        WITH flat AS (
            SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS bare
            FROM documents
        ), grouped AS (
            SELECT bare, count(*)::BIGINT AS group_size, first(doc_id ORDER BY points DESC, doc_id) AS keep_id FROM flat GROUP BY bare
        )
        SELECT f.doc_id, g.keep_id, g.group_size, f.doc_id = g.keep_id AS kept, sha256(f.bare) AS text_sha256
        FROM flat f JOIN grouped g ON f.bare = g.bare""",
    "op13_resampling": """
        WITH crc_table AS (
            SELECT list(list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END)) ORDER BY i) AS steps
            FROM range(256) AS r(i)
        ), doc_words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
            FROM documents
        ), item_words AS (
            SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word
            FROM benchmark
        ), one AS (SELECT doc_id, unnest(w) AS word FROM doc_words),
        source_words AS (SELECT word, count(*) AS n FROM one GROUP BY word),
        target_words AS (SELECT word, count(*) AS n FROM item_words GROUP BY word),
        vocabulary AS (SELECT word FROM source_words UNION SELECT word FROM target_words),
        hashed AS (
            SELECT word, xor(list_reduce(list_concat([4294967295::BIGINT], [('0x' || substr(hex(encode(word)), 2 * k - 1, 2))::BIGINT FOR k IN range(1, octet_length(encode(word)) + 1)]),
                lambda c, b: xor(c >> 8, steps[xor(c, b) % 256 + 1])), 4294967295) % 10000 AS bucket
            FROM vocabulary, crc_table
        ), s AS (SELECT bucket, sum(n) AS n FROM source_words JOIN hashed USING (word) GROUP BY bucket),
        t AS (SELECT bucket, sum(n) AS n FROM target_words JOIN hashed USING (word) GROUP BY bucket),
        gain AS (
            SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM s), 0) + 10000)::DOUBLE
                / ((coalesce(s.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0) + 10000)::DOUBLE)))::BIGINT AS g
            FROM s FULL JOIN t USING (bucket)
        ), weighed AS (
            SELECT doc_id, count(*) AS n, sum(g) AS weight FROM one JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY doc_id
        ), scored AS (
            SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                   (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
            FROM documents d LEFT JOIN weighed USING (doc_id)
        ), placed AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS all_rows FROM scored WHERE n_features >= 20)
        SELECT s.doc_id, s.n_features, s.weight, s.score, CASE WHEN place <= 10 * all_rows // 100 THEN place END AS rank FROM scored s LEFT JOIN placed p ON s.doc_id = p.doc_id""",
}
