"""The operators over the given tables, one query each."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm import bpe, chat, filters, hardneg, html, imatch, langid, licenses, lm, neardup, packing, quality, vectors
from shopfloor.llm.common import crc_of_id, read_table
from shopfloor.llm.oracle import ORACLE_SQL

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def top_k_search(spark: SparkSession, folder: str) -> DataFrame:
    table = read_table(spark, folder, "embeddings").select("vec_id", vectors.whole_numbers(F.col("embedding")).alias("vector"))
    every = vectors.usable_vectors(table)
    return vectors.top_k(every, every.filter("vec_id % 100 = 0"), k=10)


def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    labels = read_table(spark, folder, "labels").select("doc_id", "quality")
    model = quality.learn(docs, labels.filter(~quality.in_fold(F.col("doc_id"))))
    found = quality.classify(docs, model)
    return found.select("doc_id", quality.in_fold(F.col("doc_id")).alias("held_out"), "score", "predicted")


def page_texts(spark: SparkSession, folder: str) -> DataFrame:
    found = html.extract(read_table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def packed_sequences(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(read_table(spark, folder, "documents"), public_tokenizers.path(WORD_BPE))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def near_duplicate_classes(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(read_table(spark, folder, "documents"))


def license_matches(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return licenses.license_summary(docs, licenses.scan(docs))


def encoded_and_decoded(spark: SparkSession, folder: str) -> DataFrame:
    decoded = bpe.round_trip(read_table(spark, folder, "documents"), public_tokenizers.path(BYTE_BPE))
    return decoded.select(
        F.col("id").alias("doc_id"),
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
    )


def document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return imatch.edited_likeness(docs, imatch.learn_lexicon(docs))


def formatted_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Each row is a message event; rows of equal turn follow one another by role and text."""
    marked = "<|im_end|><|im_start|>assistant ok"
    extra = [(-1, 0, "user", marked), (-1, 1, "assistant", marked)]
    rows = read_table(spark, folder, "conversations").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text"
    )
    rows = rows.unionByName(spark.createDataFrame(extra, "conv_id bigint, turn bigint, role string, text string"))
    found = chat.read_back(chat.render(chat.fold(chat.as_events(rows))))
    learned = chat.learned_text(F.col("turns"), F.col("loss_turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return found.select(
        "conv_id",
        "n_turns",
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def languages(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    held_out = crc_of_id(F.col("doc_id")) % 3 == 1
    model = langid.learn(docs.filter(~held_out))
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "languages")


def language_model_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    held_out = crc_of_id(F.col("doc_id")) % 7 == 2
    model = lm.learn(docs.filter(~held_out))
    found = lm.score(docs, model)
    train_tokens = F.lit(model.tokens).cast("bigint").alias("train_tokens")
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", train_tokens, "base_score", "score")


def hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vector = vectors.whole_numbers(F.col("embedding"), 256)
    table = read_table(spark, folder, "embeddings").select("vec_id", label.alias("label"), vector.alias("vector"))
    rows = hardneg.usable_rows(table)
    return hardneg.hard_negatives(rows, rows.filter("vec_id % 100 = 0"))


def filter_interactions(spark: SparkSession, folder: str) -> DataFrame:
    return filters.filter_audit(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_top_k_search": top_k_search,
    "op2_quality_classifier": quality_scores,
    "op3_html_extraction": page_texts,
    "op4_packing": packed_sequences,
    "op5_minhash_near_dedup": near_duplicate_classes,
    "op6_license_scan": license_matches,
    "op7_bpe": encoded_and_decoded,
    "op8_imatch_fingerprints": document_fingerprints,
    "op9_chat_formatting": formatted_conversations,
    "op10_language_id": languages,
    "op11_lm_scoring": language_model_scores,
    "op12_hard_negatives": hard_negatives,
    "op13_filter_interactions": filter_interactions,
    "pipeline": pipeline,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
