"""A training corpus in five stages: language ID, line dedup, n-gram Jaccard join, benchmark decontamination, packing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns
of ``documents``. ``run`` writes each stage's result as Parquet into the shared folder and reads it again, which also
cuts the lineage: a lost executor costs one stage's tasks, not the whole run. A stage's folder goes as soon as the next one is written;
the last, which the result is read from, stays.

Defined results: every stage takes null texts and ids, empty and very long texts, repeated rows, empty tables and columns with any other names, which it
leaves out. All else is as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm import decontaminate, langid, line_dedup, ngram_join, packing
from quillmark.llm.queries import table, tokenizer_path
from quillmark.llm.shared import Tables, checkpointed, new_folder, remove_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _columns(docs: DataFrame) -> DataFrame:
    """The columns of documents, with n_chars of the text as it now is."""
    return docs.select("doc_id", "text", "lang", "source", F.char_length("text").cast("long").alias("n_chars"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str, *, languages: tuple[str, ...] | None = None) -> DataFrame:
    """Documents whose language can be told and is among ``languages`` (any, if none are given); the others go.

    The predicted language fills ``lang`` where that is null. Texts without a letter are of no language (``und``). Without any labelled document
    every text is ``und``.
    """
    model = langid.train(docs)
    scored = langid.identify(docs.select(*COLUMNS), model)
    wanted = F.col("lang_pred") != "und" if languages is None else F.col("lang_pred").isin(*languages)
    return _columns(scored.where(wanted).withColumn("lang", F.coalesce("lang", "lang_pred")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat across documents; every document stays."""
    return _columns(line_dedup.dedup_lines(docs.select(*COLUMNS)))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies, that with the smallest doc_id; documents without words are no copies of each other.

    Rows are judged one by one: where ids repeat or are null, each row is a document of its own, and of equally small ids (null ones come last) one row stays.
    """
    docs = docs.select(*COLUMNS)
    rows, known, distinct = docs.agg(F.count("*"), F.count("doc_id"), F.count_distinct("doc_id")).first()
    if rows == known == distinct:
        found = ngram_join.join_ngrams(docs)
        return docs.join(found.where("component <> doc").select(F.col("doc").alias("doc_id")), "doc_id", "left_anti").select(*COLUMNS)
    tables = Tables(spark, "rows")
    numbered, _ = tables.keep(docs.withColumn("row", F.monotonically_increasing_id()))
    found = ngram_join.join_ngrams(numbered.select(F.col("row").alias("doc_id"), "text")).select(F.col("doc").alias("row"), "component")
    order = F.struct(F.col("doc_id").isNull().alias("x"), F.col("doc_id").alias("y"), F.col("row").alias("z"))
    stay = found.join(numbered.select("row", "doc_id"), "row").groupBy("component").agg(F.min_by("row", order).alias("row"))
    kept = checkpointed(numbered.join(stay.select("row"), "row", "left_semi").select(*COLUMNS))
    tables.drop()
    return kept


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark."""
    judged = decontaminate.decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return judged.where(~F.col("contaminated")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: a row per piece of a document with its place."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", ngram_jaccard),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packed),
]

#: A learned language model, near-duplicate components and a BPE tokenizer can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = new_folder(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            remove_folder(spark, f"{folder}/{k - 1}")
    return docs
