"""The registered queries of the training-data operators: each applies its operator to whole tables.

They only derive the contracts' digest columns from what the operators return.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmark.llm import chat, decontaminate, langid, line_dedup, lm, ngram_join, packing, pii, prefix_trie, topk, toxicity, warc, whitening
from quillmark.llm.shared import checkpointed, held_out, new_folder, remove_folder

TOKENIZER = "byte_bpe_50k.json"
SUBWORDS = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "warc")
    index = checkpointed(warc.archive_and_index(spark, table(spark, sf_dir, "pages"), path))
    remove_folder(spark, path)
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.join_ngrams(table(spark, sf_dir, "documents"))
    return found.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0, k=5)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scorer = toxicity.train(documents, table(spark, sf_dir, "labels"))
    return toxicity.score(documents, scorer).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "evidence")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return out.select("doc_id", *[count(k).alias(f"n_{k}") for k in pii.BASE], F.sha2(pii.as_text(base).cast("binary"), 256).alias("base_sha256"), pii.as_text(F.col("spans")).alias("spans"), F.size(F.filter("spans", lambda s: s["kind"] == "secret")).cast("long").alias("n_secret"), F.size("spans").cast("long").alias("n_spans"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    said = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    formatted = chat.format_chats(given.unionByName(extra))
    turns = chat.parse_chats(F.col("formatted"))
    read = formatted.withColumn("turns", turns)
    loss = chat.masked_text(F.col("formatted"), F.col("loss_spans"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["content"], F.lit("\n"))), "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    model = langid.train(documents)
    return langid.identify(documents.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return lm.score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path(SUBWORDS)).select(*lm.SCORED)


def op13_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=4)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_decontaminate, op2_pack, op3_warc_index, op4_ngram_join, op5_topk, op6_toxicity, op7_line_dedup, op8_pii, op9_chat, op10_langid, op11_prefix_trie, op12_lm, op13_whiten)
}
