"""Documents made ready for training: judged, cleaned, deduplicated, checked, encoded.

Every stage takes all documents that the one before kept. Quality and contamination are judged by
row: by doc_id and text together, either of which may be null. Near duplicates go by doc_id, rows
without one or with one that other texts have too by a number of their own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimhistory import Staging
from dimhistory.llm import bpe, contamination, jaccard, lines, quality
from dimhistory.llm.frames import by_ids, read_table, unused

#: Numbers that rows get in place of a doc_id begin here, beyond the ids of documents.
LATE = 1 << 62


def row_key() -> Column:
    """64 bits of doc_id and text, null-safe. A verdict on one row meets another with 2^-64."""
    return F.xxhash64("doc_id", F.col("doc_id").isNull(), "text", F.col("text").isNull())


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the base rules and the learned list.

    A null or empty text fails the base rules. Repeated rows share a verdict; rows that share
    only the id, or have none, get their own.
    """
    row = unused(docs, "__row")
    keyed = docs.withColumn(row, row_key())
    judged = quality.judge(keyed, read_table(spark, sf_dir, "labels"), id_col=row)
    return by_ids(keyed, judged.where(~F.col("kept")), "left_anti", row).drop(row)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source.

    A null text stays null and an empty one empty; rows without source form one host; repeated
    rows stay and count once; an empty table gives no rows.
    """
    cleaned = lines.drop_boilerplate(docs).withColumn("n_chars", F.length("text").cast("long"))
    return cleaned.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked ones, once.

    Documents without words link with nothing and stay. Rows that repeat id and text are copies.
    A row without id, or whose id stands with another text as well, comes after all others.
    """
    staging, row = Staging(spark), unused(docs, "__row")
    own = F.lit(LATE) + row_key().bitwiseAND(F.lit(LATE - 1))
    texts = docs.where("doc_id IS NOT NULL").select("doc_id", row_key().alias("key"))
    shared = texts.groupBy("doc_id").agg(F.min("key").alias("a"), F.max("key").alias("b"))
    shared = staging.write(shared.where("a <> b").select("doc_id"), "shared")
    keyed = docs.withColumn(row, F.coalesce(F.col("doc_id").cast("long"), own))
    if not shared.isEmpty():
        clashing = by_ids(docs, shared, "left_semi").withColumn(row, own)
        keyed = by_ids(keyed, shared, "left_anti").unionByName(clashing)
    found = jaccard.similar_documents(keyed.select(F.col(row).alias("doc_id"), "text"))
    copies = found.where(F.col("component_id") != F.col("doc_id"))
    kept = by_ids(keyed, copies.select(F.col("doc_id").alias(row)), "left_anti", row)
    again = staging.write(kept.groupBy(row).agg(F.count("*").alias("n")).where("n > 1"), "again")
    if again.isEmpty():
        return kept.drop(row)
    once = by_ids(kept, again, "left_semi", row).dropDuplicates([row])
    return by_ids(kept, again, "left_anti", row).unionByName(once).drop(row)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that benchmark phrases don't make up a twentieth of.

    A null or empty text has no words and stays. Repeated rows share a verdict; rows that share
    only the id, or have none, get their own. An empty table gives no rows.
    """
    row = unused(docs, "__row")
    keyed = docs.withColumn(row, row_key())
    rows = keyed.select(F.col(row).alias("doc_id"), "text")
    found = contamination.contamination(rows, read_table(spark, sf_dir, "benchmark")).where("contaminated")
    return by_ids(keyed, found.select(F.col("doc_id").alias(row)), "left_anti", row).drop(row)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of what is left.

    A null text counts as empty; repeated rows stay; a null id stays null; an empty table gives
    no rows.
    """
    return bpe.encode_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", near_duplicates),
    ("decontamination", decontaminate),
    ("bpe", encode),
]

#: The learned list, the prefixes and the merges are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again as the next one's input.

    What a stage staged on its way, and the input it read, are dropped once its result is written.
    """
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        own, result = Staging(spark), Staging(spark)
        with own.holding():
            out = stage(spark, docs, sf_dir)
        docs = result.write(out, name)
        own.drop()
        if before is not None:
            before.drop()
        before = result
    return STAGES[-1][1](spark, docs, sf_dir)
