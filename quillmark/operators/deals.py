"""Listings that are cheap against the fair value of their item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions.numbers import rounded, usd_cents
from quillmark.functions.text import contains_any

#: graders' names, bounds of the cost ratio, least value, least feedback, terms of titles to leave alone.
GRADERS = ("psa", "cgc", "bgs", "sgc", "ace", "ags", "tag", "gma", "mnt")
LOW_GRADE_GRADERS = GRADERS[:6]
MIN_RATIO, MAX_RATIO, MIN_VALUE, MIN_FEEDBACK, MIN_GRADE = 0.30, 0.85, 1000, 50, 7
JUNK = (
    "metal card", "metal pokemon", "gold metal", "gold plated", "gold card", "display", "binder", "acrylic", "handmade", "extended art",
    "case only", "box only", "pick your card", "pick a card", "choose your card", "you pick", "u pick", "jumbo", "oversized",
    "empty", "no cards", "custom", "proxy", "replica", "iron card", "artwork case", "coin", "topper", "sticker",
)


def _grade(condition: Column) -> Column:
    return F.regexp_extract(F.coalesce(condition, F.lit("")), r"([0-9]+\.?[0-9]*)", 1).try_cast("double")


def fair_value_for_condition(condition: Column, raw: Column, nine: Column, ten: Column) -> Column:
    """Struct (cents, kind): raw unless graded; from 10 psa10, from 9 psa9, falling through where a price is missing."""
    graded = contains_any(F.trim(condition), GRADERS) | (F.lower(F.trim(condition)) == "graded")
    n = _grade(condition)
    value = lambda x, kind: F.struct(x.cast("bigint").alias("cents"), kind.alias("kind"))
    return (
        F.when(~F.coalesce(graded, F.lit(False)), value(raw, F.lit("Raw")))
        .when((n >= 10) & (ten > 0), value(ten, F.lit("PSA 10")))
        .when((n >= 9) & (nine > 0), value(nine, F.lit("PSA 9")))
        .when(n.isNotNull(), value(raw, F.lit("Raw (no data for grade)")))
        .otherwise(value(raw, F.lit("Raw (grade unknown)")))
    )


def judged(listings: DataFrame, trends: DataFrame) -> DataFrame:
    """Every listing with its fair value, cost in US cents, ratio and ``reason``: the first test that it fails, or ``deal``."""
    known = trends.where("current_raw > 0").select("card_slug", "card_name", "set_name", "current_raw", "current_psa9", "current_psa10")
    j = listings.join(known, "card_slug", "left")
    value = fair_value_for_condition(F.col("condition"), F.col("current_raw"), F.col("current_psa9"), F.col("current_psa10"))
    j = j.withColumn("fair_value_cents", value["cents"]).withColumn("value_type", value["kind"]).withColumn("total_usd", usd_cents(F.col("total_cost_cents"), F.col("currency")))
    j = j.withColumn("price_ratio", F.try_divide(F.col("total_usd"), F.col("fair_value_cents")))
    low_grade = contains_any(F.col("condition"), LOW_GRADE_GRADERS) & (_grade(F.col("condition")) < MIN_GRADE)
    reason = (
        F.when(F.col("current_raw").isNull(), "no_trend")
        .when(~F.coalesce(F.col("match_confidence").isin("high", "medium"), F.lit(False)), "low_confidence")
        .when(contains_any(F.col("title"), JUNK), "low_confidence")
        .when(F.coalesce(F.col("fair_value_cents"), F.lit(0)) < MIN_VALUE, "low_value")
        .when(low_grade, "low_value")
        .when(F.coalesce("seller_feedback_score", F.lit(0)) < MIN_FEEDBACK, "low_feedback")
        .when(F.coalesce("total_usd", F.lit(0)) <= 0, "no_cost")
        .when(F.col("price_ratio") < MIN_RATIO, "wrong_card")
        .when(F.col("price_ratio") > MAX_RATIO, "not_cheap")
        .otherwise("deal")
    )
    return j.withColumn("reason", reason)


def deals(listings: DataFrame, trends: DataFrame) -> DataFrame:
    found = judged(listings, trends).where("reason = 'deal'")
    keep = [c for c in listings.columns if not c.startswith("_")]
    return found.select(*keep, "card_name", "set_name", "fair_value_cents", "value_type", "total_usd", rounded((1 - F.col("price_ratio")) * 100, 1).alias("discount_pct"))


def funnel(listings: DataFrame, trends: DataFrame) -> DataFrame:
    """How many listings each test stops."""
    return judged(listings, trends).groupBy("reason").agg(F.count("*").alias("n"))
