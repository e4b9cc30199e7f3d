"""A corpus pipeline of five operators: language ID, near copies, repeated strings, secrets, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the columns
of documents. Extra columns are carried along, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import language_id, ngram_join, packing, secret_scan, suffix_dedup
from tidelog.llm.common import by_size, free_name, settled, table, with_key


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that language identification rejects: no letter, or like no training text.

    Rows of equal doc_id and text share their fate; a null lang teaches nothing; an empty table stays empty.
    """
    rid = free_name(docs, "rid")
    keyed = with_key(docs, rid)
    found = language_id.identify(keyed, key=rid)
    return keyed.join(by_size(found.filter("rejected").select(rid).distinct()), rid, "left_anti").select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents (five-word shingles, similarity 0.8) the one with the least doc_id.

    A document is a doc_id with a text: of rows that repeat both one stays, of those that share a doc_id but not a text
    each goes by its own text, and rows without doc_id come last. Texts without words all stay, repeated rows aside.
    """
    rid = free_name(docs, "rid")
    keyed = with_key(docs, rid)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(rid).alias("rid"))
    found = settled(ngram_join.ngram_components(keyed.select(rank.alias("doc_id"), "text"), ngram_join.Join(words=5, percent=80)), "near")
    copies = by_size(found.filter("component_id.rid != doc_id.rid").select(F.col("doc_id.rid").alias(rid)).distinct())
    again = settled(found.groupBy(F.col("doc_id.rid").alias(rid)).count().filter("count > 1").select(rid), "again")
    kept = keyed.join(copies, rid, "left_anti")
    if not again.isEmpty():
        again = by_size(again)
        kept = kept.join(again, rid, "left_anti").unionByName(kept.join(again, rid, "left_semi").dropDuplicates([rid]))
    return kept.select(*docs.columns)


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes that occur again in the corpus; every document stays, a null text null."""
    return suffix_dedup.remove_repeats(docs, length=200)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets masked; every document stays."""
    return secret_scan.redact_secrets(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids in windows of 1024, a row per piece; a null text is empty, repeated rows are packed each."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", keep_known_languages),
    ("ngram_join", keep_one_of_near_copies),
    ("suffix_dedup", cut_repeated_strings),
    ("secret_scan", mask_secrets),
    ("packing", pack_windows),
]

#: Language models, suffix sorts and tokenizers are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
