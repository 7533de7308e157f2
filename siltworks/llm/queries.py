"""The registered queries of this subpackage and the SQL they are compared with."""

from __future__ import annotations

import os
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from . import conversation_repair, embedding_dedup, html_text, mixing, near_dedup, packing, periodic_runs, quality, sentence_pieces, token_counts, toxicity, url_filter
from .common import bounded_batches, table
from .exact_dedup import exact_groups

#: Folder of the public tokenizer files; by default that of the package public_tokenizers.
TOKENIZERS: str | None = None


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file lies (the same on every machine)."""
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every row of ``pages``."""
    return html_text.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens; one row per piece."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), 2048).drop("row")


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all texts of ``documents``; one row per document with its class and group."""
    return near_dedup.groups(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document in byte_bpe_50k.json; one row per document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, tokenizer_path("byte_bpe_50k.json"), 1024).select("doc_id", "n_bytes", "n_tokens", "over_limit")


#: The rules of the URL filter, as (verdict, host and path prefix).
URL_RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every row of ``pages``."""
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies among all rows of ``documents``; one row per document."""
    return exact_groups(table(spark, sf_dir, "documents"))


def op7_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document in piece_bpe_32k.model, decoded again; one row per document."""
    path = tokenizer_path("piece_bpe_32k.model")
    coded = sentence_pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return sentence_pieces.digest(coded, path)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text of ``documents``, learnt from ``labels.toxic``."""
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text of ``documents``, learnt from ``labels.quality``."""
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all rows of ``embeddings`` with equal labels; one row per vector."""
    return embedding_dedup.near_copies(table(spark, sf_dir, "embeddings"), 0.98)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every conversation, after some of its rows were damaged; one row per conversation."""
    return conversation_repair.report(table(spark, sf_dir, "conversations"))


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document a mix of the sources takes; one row per document."""
    rows = mixing.mix(table(spark, sf_dir, "documents"), (5, 2, 1), 1.5, 2).rows
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in every text, some of which were made periodic; one row per document."""
    return periodic_runs.report(table(spark, sf_dir, "documents"), plant=True)


def _bounded(query):
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    "op1_html_text": op1_html_text,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_near_dedup": op3_near_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_url_filter": op5_url_filter,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_sentence_pieces": op7_sentence_pieces,
    "op8_toxicity": op8_toxicity,
    "op9_quality": op9_quality,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_source_mix": op12_source_mix,
    "op13_periodic_runs": op13_periodic_runs,
}
QUERIES = {name: _bounded(query) for name, query in QUERIES.items()}

ORACLES = {
    "op12_source_mix": mixing.SQL,
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op10_embedding_dedup": """
        WITH RECURSIVE r AS (SELECT row_number() OVER () AS rid, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
        v AS (SELECT * FROM r WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
        links AS (
            SELECT a.rid AS a, b.rid AS b FROM v a JOIN v b ON a.label = b.label AND a.rid <> b.rid AND len(a.e) = len(b.e)
            WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
        reach AS (SELECT rid AS n, rid AS r FROM r UNION SELECT l.a, reach.r FROM reach JOIN links l ON l.b = reach.n),
        least AS (SELECT reach.n, min(r.vec_id) AS component_id FROM reach JOIN r ON r.rid = reach.r GROUP BY reach.n)
        SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.rid) AS n_links, c.component_id, e.vec_id IS NOT DISTINCT FROM c.component_id AS kept
        FROM r e JOIN least c ON c.n = e.rid""",
}
