"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from parallaxis.llm import hidden_markov, html_extraction, jaccard_join, jpeg_media, mixing, multi_index, pattern_packing, substring_dedup, toxicity, url_filter
from parallaxis.llm.common import table


def op1_toxicity(spark, sf_dir):
    """Toxicity of every text of ``documents``, learned from ``labels``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.toxicity(docs, table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op2_html_extraction(spark, sf_dir):
    """Main text of every row of ``pages``."""
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def op3_embedding_dedup(spark, sf_dir):
    """All rows of ``embeddings`` with their links at cosine 0.98 within a label."""
    return multi_index.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_jaccard_join(spark, sf_dir):
    """All ``documents`` with their classes, links and components at 0.8."""
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op5_url_filter(spark, sf_dir):
    """Rule or host verdict of every url of ``pages``."""
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op6_media_columns(spark, sf_dir):
    """Baseline JPEG media of every text of ``documents``."""
    return jpeg_media.media_columns(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark, sf_dir):
    """What is left of all ``documents`` without 13-word windows of smaller documents."""
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), digest=True)


def op8_best_fit_packing(spark, sf_dir):
    """All ``documents`` in sequences of at most 2048 tokens."""
    return pattern_packing.pack(table(spark, sf_dir, "documents"))


def op9_hidden_markov(spark, sf_dir):
    """Base and model log10 probability of every text of ``documents``."""
    return hidden_markov.language_scores(table(spark, sf_dir, "documents"))


def op10_mixing(spark, sf_dir):
    """All ``documents`` mixed to the target weights of their sources."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def queries():
    return {f.__name__: f for f in (op1_toxicity, op2_html_extraction, op3_embedding_dedup, op4_jaccard_join, op5_url_filter, op6_media_columns, op7_substring_dedup, op8_best_fit_packing, op9_hidden_markov, op10_mixing)}


def oracle_sql():
    return {"op3_embedding_dedup": multi_index.oracle_sql(), "op4_jaccard_join": jaccard_join.oracle_sql(), "op5_url_filter": url_filter.oracle_sql(), "op7_substring_dedup": substring_dedup.oracle_sql(), "op10_mixing": mixing.oracle_sql()}
