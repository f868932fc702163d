"""Catalogue seeding: rows from catalogue files, differences to what is stored, language collisions, bulk manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions import text as x


def seed_rows(catalogue: DataFrame, set_name: str, language: str, printed_total: int | None = None, release_date: str | None = None) -> DataFrame:
    """Card rows of one set; the release date is a column only when it is known, so an upsert can't erase one."""
    if language not in ("en", "jp"):
        raise ValueError(f"unknown language {language!r}")
    number = x.trailing_number(F.col("product_name"))
    total = F.lit(str(printed_total) if printed_total else None).cast("string")
    out = catalogue.select(
        F.col("id").alias("card_slug"), F.col("product_name").alias("card_name"), F.lit(set_name).alias("set_name"), number.alias("card_number"), x.display_number(number, total).alias("card_number_display"),
        total.alias("set_printed_total"), number.isNull().alias("is_sealed"), x.site_slug(F.col("product_name")).alias("card_url_slug"), x.stored_page_url(F.col("console_name"), F.col("product_name")).alias("pc_url"), F.lit(language).alias("language"),
    )
    return out if release_date is None else out.withColumn("set_release_date", F.lit(release_date).cast("date"))


def import_rows(catalogue: DataFrame, set_name: str, printed_total: int) -> DataFrame:
    """Card rows by the import's rules: any number, keywords for sealed products."""
    number, sealed = x.any_number(F.col("product_name")), x.contains_any(F.col("product_name"), x.IMPORT_SEALED)
    return catalogue.select(
        F.col("id").alias("card_slug"), F.col("product_name").alias("card_name"), F.lit(set_name).alias("set_name"), number.alias("card_number"),
        F.when(~sealed, x.display_number(number, F.lit(str(printed_total)))).alias("card_number_display"), sealed.alias("is_sealed"),
        x.import_slug(F.col("product_name")).alias("card_url_slug"), x.import_page_url(F.col("console_name"), F.col("product_name")).alias("pc_url"),
    )


def set_metadata(cards: DataFrame, release_year: int | None) -> DataFrame:
    out = cards.groupBy("set_name", "language").agg(F.count("*").cast("int").alias("total_cards"))
    return out if release_year is None else out.withColumn("release_year", F.lit(release_year))


def diff(new: DataFrame, stored: DataFrame, key: str = "card_slug") -> DataFrame:
    """(key, side): new, overlap or only_stored; one full outer join of keys."""
    a, b = new.select(key).distinct().withColumn("__n", F.lit(True)), stored.select(key).distinct().withColumn("__s", F.lit(True))
    return a.join(b, key, "full_outer").select(key, F.when(F.col("__n") & F.col("__s"), "overlap").when(F.col("__n"), "new").otherwise("only_stored").alias("side"))


def classify_collisions(proposed: DataFrame, stored: DataFrame, allowed: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """proposed rows with stored set and language and ``verdict``: safe, allowed (a named id may change language) or blocked."""
    old = stored.select("card_slug", F.col("language").alias("stored_language"), F.col("set_name").alias("stored_set"))
    j = proposed.join(old, "card_slug", "left")
    same: Column = F.col("stored_language").isNull() | (F.col("stored_language") == F.col("language"))
    named = F.col("card_slug").isin(*allowed) if allowed else F.lit(False)
    return j.withColumn("verdict", F.when(same, "safe").when(named, "allowed").otherwise("blocked"))


def collision_report(classified: DataFrame) -> DataFrame:
    line = F.format_string("%s: stored as %s in %s, proposed as %s in %s", "card_slug", "stored_language", "stored_set", "language", "set_name")
    return classified.where("verdict = 'blocked'").select("card_slug", "stored_language", "stored_set", F.col("language").alias("proposed_language"), F.col("set_name").alias("proposed_set"), line.alias("report"))


def bulk_plan(manifest: DataFrame, catalogue: DataFrame, *, only: list[str] | None = None, skip: list[str] | None = None) -> DataFrame:
    """Manifest sets (console_name, set_name, printed_total, official_total) with their catalogue counts, the denominator and ``problem``.

    The printed total is preferred to the official one; a set without either, or without rows, is refused.
    """
    m = manifest
    if only:
        m = m.where(F.col("set_name").isin(*only))
    if skip:
        m = m.where(~F.col("set_name").isin(*skip))
    j = m.join(catalogue.groupBy("console_name").agg(F.count("*").alias("rows")), "console_name", "left")
    total = F.coalesce("printed_total", "official_total")
    return j.withColumn("denominator", total).withColumn("problem", F.when(total.isNull(), "no denominator").when(F.coalesce("rows", F.lit(0)) == 0, "no rows"))


def merged_prices(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Two extracts side by side; where both have a field the second counts."""
    names = [c for c in dict.fromkeys([*first.columns, *second.columns]) if c != key]
    a, b = first.alias("a"), second.alias("b")
    side = lambda d, t, c: F.col(f"{t}.{c}") if c in d.columns else F.lit(None)
    return a.join(b, key, "full_outer").select(key, *[F.coalesce(side(second, "b", c), side(first, "a", c)).alias(c) for c in names])


def pages_of(source: DataFrame, name: str) -> DataFrame:
    """Active pages of one source."""
    return source.where(F.col("scrape_active") & (F.col("source") == name))


def console_gate(catalogue: DataFrame, console: str) -> tuple[DataFrame, DataFrame]:
    """Rows of a required console, and how many others there are."""
    return catalogue.where(F.col("console_name") == console), catalogue.where(F.col("console_name") != console).agg(F.count("*").alias("skipped"))
