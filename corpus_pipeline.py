"""A corpus pipeline: toxic documents go, one document of each near-duplicate group stays, repeated
passages are cut out, and what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the
next one's docs. All but the last return the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm.common import staged, table, unstaged
from gridloom.llm.packing import pack_documents
from gridloom.llm.simhash import keep_one
from gridloom.llm.suffix_dedup import without_repeats
from gridloom.llm.toxicity import drop_toxic

#: What the third stage calls a repeated passage: strings of so many bytes that start elsewhere too, joined to runs of over
#: 50 words. Passages of over 50 words are 224 bytes and longer; the grams are short for them, so that windows share seeds.
PASSAGE = {"length": 224, "gram": 32, "over_words": 50}


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go. Null and empty texts have all features zero and are judged like any other; rows of one
    key and text share a verdict; without labels of both classes the share of toxic labels decides for all; an empty table stays empty."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a similarity of 0.8 or more of their five-word shingles that of the smallest key stays, null keys last; so of
    repeated rows one stays. Texts without a word, null ones among them, are copies of each other; an empty table stays empty."""
    return keep_one(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of over 50 words that stand elsewhere too are cut out. Null, empty and short texts stay as they are; of a
    passage every copy goes; a row whose text is all repeated stays with an empty text; rows of equal texts repeat each other."""
    return without_repeats(docs, **PASSAGE)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 1024 ids, one row a piece. A null or empty text is the end
    id alone; repeated rows are packed each on its own; an empty table gives no rows."""
    return pack_documents(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("toxicity", toxicity), ("simhash near-dedup", simhash), ("suffix-array dedup", suffix_dedup), ("best-fit packing", packing)]
ORACLE_SQL = None  # SQL can express none of the stages; tests hold them against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, staged(stage(spark, docs, sf_dir), f"stage{i}")
        if i:
            unstaged(before)
    return STAGES[-1][1](spark, docs, sf_dir)
