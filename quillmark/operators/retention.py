"""Completed sales: grade keys, the newest N of each, and what a run keeps, adds and supersedes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DEFAULT_CAP = 5


def grade_key(section: Column, raw_or_graded: Column, company: Column, grade: Column) -> Column:
    """``Raw``, ``PSA 10``, a lone company or grade, or ``Graded``."""
    text = lambda x: F.trim(F.coalesce(x, F.lit("")))
    company, grade = text(company), text(grade)
    return (
        F.when((text(section) == "completed-auctions-used") | (text(raw_or_graded) == "raw"), "Raw")
        .when((company == "") & (grade == ""), "Graded")
        .when(grade == "", company)
        .when((company == "") | F.startswith(F.lower(grade), F.lower(company)), grade)
        .otherwise(F.concat_ws(" ", company, grade))
    )


def with_grade_key(sales: DataFrame) -> DataFrame:
    column = lambda c: F.col(c) if c in sales.columns else F.lit(None).cast("string")
    return sales.withColumn("grade_key", grade_key(column("observed_section"), column("raw_or_graded"), column("grading_company"), column("grade")))


def _newest_first() -> list[Column]:
    """Later date, higher confidence, larger key."""
    return [F.coalesce(F.col("sale_date").cast("string"), F.lit("")).desc(), F.coalesce("parse_confidence", F.lit(0)).desc(), F.coalesce("provider_sale_key", F.lit("")).desc()]


def newest_per_grade(sales: DataFrame, most: int | None = DEFAULT_CAP) -> DataFrame:
    """The newest ``most`` rows of each (item, grade key); later date, higher confidence, larger key first. None or less than 1 keeps all.

    Spark limits a rank filter before its shuffle, so a bucket with a third of all rows sends only its top rows from each task.
    """
    if most is None or most <= 0:
        return sales
    keyed = with_grade_key(sales)
    rank = F.row_number().over(W.partitionBy(F.coalesce(F.col("provider_card_id").cast("string"), F.lit("")), "grade_key").orderBy(*_newest_first()))
    return keyed.withColumn("__rank", rank).where(F.col("__rank") <= most).drop("__rank", *([] if "grade_key" in sales.columns else ["grade_key"]))


def reconcile(stored: DataFrame, scraped: DataFrame, most: int | None = DEFAULT_CAP) -> DataFrame:
    """``stored`` after a run that scraped ``scraped``: one atomic table instead of single updates. A sale's key belongs to one item.

    Of each item in the run, the keep set is the newest of (stored active and fine rows, scraped rows; scraped ones win). Scraped
    rows in it are added or replaced as active; stored active and fine rows outside it become superseded; scraped rows outside it
    never get in. Items that the run doesn't touch, and items whose keep set is empty, stay as they are.

    Both sides meet in one shuffle by item, where windows mark them; none of these needs more than the rows so far, however many an item has.
    """
    columns = stored.columns
    capped = newest_per_grade(with_grade_key(scraped), most).withColumn("__side", F.lit(1)).withColumn("__fine", F.lit(True))
    fine = F.coalesce((F.col("review_status") == "active") & (F.col("parse_status") == "ok") & F.col("provider_card_id").isNotNull(), F.lit(False))
    old = with_grade_key(stored).withColumn("__side", F.lit(0)).withColumn("__fine", fine)
    taken = lambda side: [c for c in dict.fromkeys([*columns, "sale_date", "parse_confidence", "grade_key", "__side", "__fine"]) if c in side.columns]
    both = old.select(*taken(old)).unionByName(capped.select(*taken(capped)), allowMissingColumns=True).repartition("provider_card_id")

    card, key, first = "provider_card_id", "provider_sale_key", W.unboundedPreceding
    counts = F.col("__fine") & F.coalesce(F.col(key) != "", F.lit(False))
    of_key = W.partitionBy(card, key).orderBy(F.desc("__counts"), F.desc("__side"), *_newest_first())
    both = both.withColumn("__counts", counts).withColumn("__wins", F.col("__counts") & (F.row_number().over(of_key) == 1))
    both = both.withColumn("__scraped", F.first(F.col("__counts") & (F.col("__side") == 1)).over(of_key.rowsBetween(first, 0)))
    rank = F.row_number().over(W.partitionBy(card, "grade_key").orderBy(F.desc("__wins"), *_newest_first()))
    both = both.withColumn("__keep", F.col("__wins") & (F.lit(True) if most is None or most <= 0 else rank <= most))
    both = both.withColumn("__kept", F.first("__keep").over(W.partitionBy(card, key).orderBy(F.desc("__keep")).rowsBetween(first, 0)))
    # An item's scraped rows come first, then its stored rows that count: both are known at any other row.
    of_card = W.partitionBy(card).orderBy(F.desc("__side"), F.desc("__counts")).rowsBetween(first, 0)
    both = both.withColumn("__touched", (F.max("__side").over(of_card) == 1) & F.max("__counts").over(of_card))

    new = F.col("__side") == 1
    both = both.where(F.when(new, F.col("__kept")).otherwise(~(F.col("__kept") & F.col("__scraped"))))
    gone = F.col("__fine") & F.col("__touched") & ~F.col("__kept")
    return both.withColumn("review_status", F.when(new, "active").when(gone, "superseded").otherwise(F.col("review_status"))).select(*columns)


def run_report(sales: DataFrame) -> DataFrame:
    """Counts by page status, row status, marketplace, section and reasons, per file and overall."""
    names = ["file", "parse_status", "marketplace", "observed_section", "reason"]
    sets = [[], *[[n] for n in names], ["file", "parse_status"]]
    return sales.groupingSets([[F.col(c) for c in g] for g in sets], *names).agg(F.count("*").alias("n"), F.grouping_id().alias("level"))
