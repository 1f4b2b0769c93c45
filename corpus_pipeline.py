"""The corpus pipeline: documents -> clean -> one of each near-copy group -> no repeated passages ->
mixed to target weights -> packed. Each stage takes what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from frondlake.llm import jaccard, mixing, packing, repeats, toxicity
from frondlake.session import durable, table

#: near copies: five-word shingles, at least 80 of 100 shared
SHINGLE, SHARE = 5, (80, 100)
#: a repeated passage: the window that op10 removes
PASSAGE = 13


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under one half by a model learned from the labelled ones among them."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return jaccard.keep_one(docs, SHINGLE, *SHARE)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that a document with a smaller id has in the same passage."""
    return repeats.remove_repeats(docs, PASSAGE)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    return mixing.take(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the mixed documents in sequences."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard_join", one_of_each), ("substring_dedup", drop_passages), ("mix_sources", mix),
          ("best_fit_packing", pack)]

#: a learned lexicon, a drawn sample and packing have no SQL form; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each one's rows written before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = durable(docs)
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
