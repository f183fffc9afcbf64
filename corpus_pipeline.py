"""Corpus pipeline over ``documents`` (part of the llm subpackage): each stage works on all that
the one before kept, and its decisions take effect.

1. language ID: documents without a language go;
2. n-gram Jaccard join: one document of each group of near-duplicates stays;
3. substring dedup: passages that an earlier document holds are cut out;
4. packing: the texts that remain become fixed-length training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from goalcast.llm.jaccard_join import keep_one
from goalcast.llm.langid import keep_identified
from goalcast.llm.packing import pack_documents
from goalcast.llm.substring_dedup import remove_repeats
from goalcast.session import cut_lineage, read_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with half of their letters or more in scripts of learned languages."""
    return keep_identified(docs, least_share=0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of links at Jaccard >= 0.8 of five-word shingles."""
    return keep_one(docs, k=5, num=4, den=5)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-word passages of documents with smaller ids."""
    return remove_repeats(docs, span=50, seed=20)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 ids."""
    import public_tokenizers
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates),
          ("repeated_passages", repeated_passages), ("packing", packing)]

#: The trained model and the tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; each result but the last is written as a
    table in the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
