"""Readers with declared schemas: catalogue files, lists, price history, saved pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CATALOGUE = "`id` string, `console-name` string, `product-name` string, `loose-price` string"


def catalogue(spark: SparkSession, path: str, *, sets: DataFrame | None = None, ids: DataFrame | None = None, set_name: str | None = None) -> DataFrame:
    """id, console_name, product_name, loose_price, file, language of catalogue CSVs; rows without id or name go.

    ``sets`` (console_name) and ``ids`` (id) are filters by semi-join.
    """
    raw = spark.read.schema(CATALOGUE).option("header", True).option("quote", '"').option("escape", '"').csv(path)
    rows = raw.select(F.trim("id").alias("id"), F.trim(F.coalesce("console-name", F.lit(""))).alias("console_name"), F.trim("product-name").alias("product_name"), F.trim(F.coalesce("loose-price", F.lit(""))).alias("loose_price"), file_name(F.col("_metadata.file_path")).alias("file"))
    rows = rows.where("id <> '' and product_name <> ''").withColumn("language", file_language(F.col("file")))
    if set_name is not None:
        rows = rows.where(F.col("console_name") == set_name)
    if sets is not None:
        rows = rows.join(sets, "console_name", "left_semi")
    return rows if ids is None else rows.join(ids, "id", "left_semi")


def file_name(path):
    """The name of the file that a row comes from; what a Spark job wrote as a folder of parts is one file with the folder's name."""
    parts = F.split(F.url_decode(path), "/")
    last = F.element_at(parts, -1)
    return F.when(F.startswith(last, F.lit("part-")) & (F.size(parts) > 1), F.element_at(parts, -2)).otherwise(last)


def file_language(name):
    """``jp`` for files with japan in their name, in any case."""
    return F.when(F.contains(F.lower(name), F.lit("japan")), "jp").otherwise("en")


def lines(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One value a line; blanks go."""
    return spark.read.text(path).select(F.trim("value").alias(column)).where(F.col(column) != "")


def price_history(spark: SparkSession, path: str, columns: list[str], *, date: str | None = None) -> DataFrame:
    """Columns and day reach the scan; with the table partitioned by date only that day's files are read."""
    df = spark.read.parquet(path)
    return (df if date is None else df.where(F.col("date") == F.lit(date).cast("date"))).select(*columns)


def text_reports(spark: SparkSession, path: str) -> DataFrame:
    """(set_name, file, pos, block): the items of text reports, each as ``number``, tab and all lines up to the next item.

    A report's only tabs stand between an item's number and its name. With the tab as the line separator, Spark cuts files of any size into
    records at those places, on whichever split of a file they begin. A record's last line is the number of the next item, so each record takes its number
    from the one before it: within a split by a window over the split, which the largest partition size bounds, and at its first record from the last of
    the split before. The set's name is the partition column ``set_name`` if there is one, else the file's name without its ending.
    """
    raw = spark.read.text(path, lineSep="\t")
    name = F.col("set_name").cast("string") if "set_name" in raw.columns else F.regexp_replace(file_name(F.col("_metadata.file_path")), r"\.[^.]*$", "")
    rows = raw.select(name.alias("set_name"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("i"), F.regexp_replace("value", r"\r", "").alias("text"))
    rows = rows.withColumn("tail", F.trim(F.element_at(F.split(F.col("text"), "\n"), -1)))
    splits = rows.groupBy("file", "start").agg(F.max_by("tail", "i").alias("tail"), F.max("i").alias("i"))
    by_file = W.partitionBy("file").orderBy("start")
    splits = splits.select("file", "start", F.lag("tail").over(by_file).alias("before"), F.when(F.lead("i").over(by_file).isNull(), F.col("i")).alias("ends"))
    own = W.partitionBy("file", "start").orderBy("i")
    numbered = rows.withColumn("number", F.lag("tail").over(own)).join(splits, ["file", "start"]).withColumn("number", F.coalesce("number", "before"))
    cut = F.when(F.col("i") == F.col("ends"), F.col("text")).otherwise(F.regexp_replace("text", r"\n[^\n]*$", ""))
    items = numbered.where(F.rlike("number", F.lit("^[0-9]+$")))
    return items.select("set_name", "file", F.col("i").alias("pos"), F.concat("number", F.lit("\t"), cut).alias("block"))


def saved_pages(spark: SparkSession, path: str) -> DataFrame:
    """url (the file) and html of a folder of pages."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))


def console_counts(rows: DataFrame) -> DataFrame:
    """Rows per language and console, with the number of files that hold it; more than one is a duplicate."""
    return rows.groupBy("language", "console_name").agg(F.count("*").alias("n"), F.count_distinct("file").alias("files"), F.array_sort(F.collect_set("file")).alias("file_names")).withColumn("duplicate", F.col("files") > 1)
