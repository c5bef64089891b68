"""One query per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimhistory.llm import (
    bpe,
    centroids,
    contamination,
    jaccard,
    language,
    lines,
    pages,
    pii,
    quality,
    resampling,
    tokens,
    topk,
    toxicity,
)
from dimhistory.llm.frames import held_out, read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = language.identify(docs, language.learn(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(read_table(spark, sf_dir, "documents"))
    kinds = F.array(*map(F.lit, pii.KINDS))

    def joined(spans: Column) -> Column:
        ordered = F.sort_array(
            F.transform(
                spans,
                lambda s: F.struct(F.array_position(kinds, s["kind"]).alias("at"), s["start"], s["end"], s["kind"]),
            )
        )
        return F.array_join(
            F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return tokens.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    classifier = toxicity.learn(docs, read_table(spark, sf_dir, "labels"))
    found = toxicity.score(docs, classifier)
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extract(read_table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(read_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return contamination.contamination(docs, read_table(spark, sf_dir, "benchmark"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.judge(docs, read_table(spark, sf_dir, "labels"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.drop_boilerplate(read_table(spark, sf_dir, "documents"))
    text = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return cleaned.select("doc_id", "n_lines", "n_dropped", text.alias("text_sha256"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return bpe.encode_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read_table(spark, sf_dir, "embeddings"))


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.best_products(read_table(spark, sf_dir, "embeddings"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return resampling.resample(docs, read_table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_language": op1_language,
    "op2_pii": op2_pii,
    "op3_token_counts": op3_token_counts,
    "op4_toxicity": op4_toxicity,
    "op5_html_text": op5_html_text,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_decontamination": op7_decontamination,
    "op8_quality_rules": op8_quality_rules,
    "op9_line_dedup": op9_line_dedup,
    "op10_bpe": op10_bpe,
    "op11_centroids": op11_centroids,
    "op12_topk": op12_topk,
    "op13_resampling": op13_resampling,
}
