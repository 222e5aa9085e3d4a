"""Corpus pipeline over ``documents``: five stages, each written and read again as the next one's input.

1. toxicity: documents that the classifier rejects go.
2. n-gram Jaccard join: one document of each group of near copies stays.
3. substring dedup: words of repeated 13-word windows go, the text becomes what is left.
4. mixing: documents become what the mix takes of them, once for each pass over their source.
5. best-fit packing: one row per piece, with its sequence and place.

All stages but the last return the columns of ``documents``; all take empty
tables, null texts and ids, repeated rows and further columns, also such as
share a name with an operator's own (see the operators). ``run`` cuts lineage between stages in the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parallaxis.llm import jaccard_join, mixing, pattern_packing, substring_dedup, toxicity
from parallaxis.llm.common import table
from parallaxis.runtime import cut_lineage

#: SQL cannot express training, tokenising and packing; tests compare with brute force.
ORACLE_SQL = None


def _sized(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_chars`` set to the text's length, where there is such a column."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below 0.5, learned from ``labels``."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    name = "_toxic"
    while name in docs.columns:
        name += "_"
    return toxicity.score(docs, model, score_col=name).where(f"`{name}` < 0.5").drop(name)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component at Jaccard similarity 0.8."""
    return jaccard_join.distinct_documents(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of windows that smaller documents hold."""
    return _sized(substring_dedup.remove_repeats(docs, counts=False))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: a row for each pass over a document, with the words taken."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their sequences of at most 2048 tokens."""
    return pattern_packing.pack(docs)


STAGES = [("toxicity", toxicity_stage), ("jaccard_join", jaccard_stage), ("substring_dedup", substring_stage), ("mixing", mixing_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents`` of the data folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
