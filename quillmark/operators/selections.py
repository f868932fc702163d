"""Ranked selections for articles and feeds. Limits come where the rules put them: before the quality filters, never after."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmark.functions.numbers import rounded
from quillmark.functions.text import SEARCH_SEALED, bare_slug, contains_any

MIN_ROWS = 30
MAX_WEEK, MAX_MONTH = 100, 200


#: Sets with deep history, to which articles keep.
ALLOWED_SETS = (
    "Base Set", "Jungle", "Fossil", "Team Rocket", "Neo Genesis", "Neo Destiny",
    "Hidden Fates", "Cosmic Eclipse", "Unified Minds", "Team Up", "Unbroken Bonds",
    "Rebel Clash", "Darkness Ablaze", "Champion's Path", "Vivid Voltage", "Shining Fates", "Battle Styles", "Chilling Reign", "Evolving Skies", "Celebrations", "Fusion Strike",
    "Brilliant Stars", "Astral Radiance", "Lost Origin", "Silver Tempest", "Crown Zenith",
    "Scarlet & Violet", "Paldea Evolved", "Obsidian Flames", "151", "Paradox Rift", "Paldean Fates", "Temporal Forces", "Twilight Masquerade", "Stellar Crown", "Surging Sparks", "Prismatic Evolutions",
)


def allowed(rows: DataFrame, set_names: DataFrame | tuple[str, ...] | None) -> DataFrame:
    """Rows of the allowed sets: a tuple of names, a table with ``set_name``, or None for all."""
    if set_names is None:
        return rows
    return rows.where(F.col("set_name").isin(*set_names)) if isinstance(set_names, tuple) else rows.join(set_names.select("set_name"), "set_name", "left_semi")


def credible(week: Column, month: Column) -> Column:
    """Changes that can be believed; a missing one passes."""
    return (F.coalesce(F.abs(week), F.lit(0)) <= MAX_WEEK) & (F.coalesce(F.abs(month), F.lit(0)) <= MAX_MONTH)


def row_counts(prices: DataFrame) -> DataFrame:
    return prices.groupBy(bare_slug(F.col("card_slug")).alias("card_slug")).agg(F.count("*").alias("n"))


def with_history(rows: DataFrame, prices: DataFrame, least: int = MIN_ROWS) -> DataFrame:
    """Items with at least ``least`` price rows. Only the few selected items are counted."""
    own = prices.withColumn("card_slug", bare_slug(F.col("card_slug"))).join(rows.select("card_slug"), "card_slug", "left_semi")
    return rows.join(own.groupBy("card_slug").agg(F.count("*").alias("n")).where(F.col("n") >= least), "card_slug", "left_semi")


def _top(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    return rows.orderBy(*order, "card_slug").limit(n)


def top_items(trends: DataFrame, n: int) -> DataFrame:
    """The n dearest items, then without sealed products."""
    return _top(trends.where("current_raw > 0"), n, F.desc("current_raw")).where(~contains_any(F.col("card_name"), SEARCH_SEALED))


def movers(trends: DataFrame, prices: DataFrame, set_names: DataFrame | tuple[str, ...] | None = ALLOWED_SETS, least: int = MIN_ROWS) -> DataFrame:
    """Up to 8 risers and 6 fallers of the week, with ``side``."""
    base = trends.where("current_raw > 2000")
    up = _top(base.where("raw_pct_7d > 0 and raw_pct_7d <= 100 and raw_pct_30d <= 200"), 60, F.desc("raw_pct_7d")).withColumn("side", F.lit("riser"))
    down = _top(base.where("raw_pct_7d < 0 and raw_pct_7d >= -100"), 60, F.asc("raw_pct_7d")).withColumn("side", F.lit("faller"))
    fine = lambda d: with_history(allowed(d, set_names).where(credible(F.col("raw_pct_7d"), F.col("raw_pct_30d"))), prices, least)
    return _top(fine(up), 8, F.desc("raw_pct_7d")).unionByName(_top(fine(down), 6, F.asc("raw_pct_7d")))


def grading_premiums(trends: DataFrame, prices: DataFrame, set_names: DataFrame | tuple[str, ...] | None = ALLOWED_SETS, least: int = MIN_ROWS) -> DataFrame:
    """Of the 80 dearest tens, the 10 with the largest multiple of raw and enough history, taken from the best 12."""
    dear = _top(trends.where("current_psa10 > 0 and current_raw > 0"), 80, F.desc("current_psa10"))
    rated = allowed(dear, set_names).withColumn("multiplier", rounded(F.col("current_psa10") / F.col("current_raw"), 1))
    return _top(_top(with_history(rated, prices, least), 12, F.desc("multiplier")), 10, F.desc("multiplier"))


def low_population(population: DataFrame, most: int = 500) -> DataFrame:
    return population.where((F.col("psa_10") > 0) & (F.col("psa_10") < most)).orderBy("psa_10", "set_name", "card_number").limit(10)


def sleepers(trends: DataFrame, prices: DataFrame, set_names: DataFrame | tuple[str, ...] | None = ALLOWED_SETS, least: int = MIN_ROWS) -> DataFrame:
    found = trends.where("raw_pct_30d > 5 and raw_pct_30d <= 200 and raw_pct_90d > 5 and raw_pct_90d <= 500 and current_raw > 2000 and current_raw < 30000")
    return _top(with_history(allowed(_top(found, 80, F.desc("raw_pct_30d")), set_names), prices, least), 10, F.desc("raw_pct_30d"))


def pulse(index: DataFrame, n: int = 35) -> DataFrame:
    """The last n index rows in ascending order, with dollars."""
    last = index.orderBy(F.desc("date")).limit(n)
    dollars = lambda c, least: F.when(F.col(c) > least, F.col(c) / 100).otherwise(F.col(c).cast("double"))
    return last.select("date", dollars("total_raw_usd", 1_000_000).alias("total_raw"), dollars("median_raw_usd", 10_000).alias("median_raw"), "raw_pct_7d", "raw_pct_30d").orderBy("date")


def history_pick(trends: DataFrame, prices: DataFrame, seed: int, set_names: DataFrame | tuple[str, ...] | None = ALLOWED_SETS, least: int = MIN_ROWS) -> DataFrame:
    """The 365 earliest prices of one item of at least $20, picked by a seeded hash among 15 eligible ones of the top 80."""
    top = _top(trends.where("current_raw >= 2000 and raw_pct_90d is not null"), 80, F.desc("current_raw"))
    some = _top(with_history(allowed(top, set_names), prices, least), 15, F.desc("current_raw"))
    one = some.orderBy(F.md5(F.concat_ws("|", F.lit(seed), "card_slug")), "card_slug").limit(1).select("card_slug", "card_name")
    own = prices.select(bare_slug(F.col("card_slug")).alias("card_slug"), "date", "raw_usd").where("raw_usd > 0")
    return own.join(one, "card_slug").orderBy("date").limit(365)


def busiest_set(trends: DataFrame, least: int = 8) -> DataFrame:
    """The set with the largest mean absolute week change among sets of at least ``least`` such items, with its risers and fallers."""
    c = F.col("raw_pct_7d")
    sets = trends.where(c.isNotNull() & (F.col("current_raw") > 0)).groupBy("set_name").agg(
        F.count("*").alias("cards"), rounded(F.avg(F.abs(c)), 1).alias("activity"), F.count_if(c > 0).alias("risers"), F.count_if(c < 0).alias("fallers"),
        F.max_by("card_name", F.struct(c, "card_name")).alias("top_riser"), F.min_by("card_name", F.struct(c, "card_name")).alias("top_faller"),
    )
    return sets.where(F.col("cards") >= least).orderBy(F.desc("activity"), "set_name").limit(1)


def collector_sets(set_metrics: DataFrame, trends: DataFrame, n: int = 8) -> DataFrame:
    """The n most valuable sets with their dearest item and number of items from $20."""
    best = set_metrics.select("set_name", "set_total_value").orderBy(F.desc("set_total_value"), "set_name").limit(n)
    own = trends.where("current_raw > 0").join(best, "set_name")
    return own.groupBy("set_name", "set_total_value").agg(F.max("current_raw").alias("top_price"), F.max_by("card_name", F.struct("current_raw", "card_name")).alias("top_card"), F.count_if(F.col("current_raw") >= 2000).alias("from_20"))


def nth_of_day(rows: DataFrame, day: dt.date, most: int, *order: Column) -> DataFrame:
    """The row at place ``day of year mod min(most, rows)`` of the first ``most`` in order."""
    top = rows.orderBy(*order).limit(most)
    place = F.row_number().over(W.orderBy(*order)) - 1
    return top.withColumn("place", place).withColumn("of", F.count("*").over(W.partitionBy())).where(F.col("place") == F.lit(day.timetuple().tm_yday) % F.col("of")).drop("place", "of")


def deal_of_day(deals: DataFrame, day: dt.date) -> DataFrame:
    fine = deals.where((F.col("discount_pct") >= 15) & (F.col("total_usd") > 500) & ~contains_any(F.col("card_name"), SEARCH_SEALED))
    return nth_of_day(fine, day, 5, F.desc("discount_pct"), F.asc("listing_id"))


def riser_of_day(trends: DataFrame, day: dt.date) -> DataFrame:
    fine = trends.where((F.col("raw_pct_7d") >= 5) & (F.col("raw_pct_7d") <= 150) & ~contains_any(F.col("card_name"), SEARCH_SEALED))
    return nth_of_day(fine, day, 3, F.desc("raw_pct_7d"), F.asc("card_slug"))


def population_angle(population: DataFrame, day: dt.date, least: int = 100, n: int = 5) -> DataFrame:
    """By day: lowest rate of tens, most graded, highest rate."""
    rated = population.where(F.col("total_graded") >= least).withColumn("gem_rate", rounded(F.col("psa_10") / F.col("total_graded") * 100, 2))
    orders = ([F.asc("gem_rate")], [F.desc("total_graded")], [F.desc("gem_rate")])
    angle = day.timetuple().tm_yday % len(orders)
    return rated.orderBy(*orders[angle], "set_name", "card_number").limit(n).withColumn("angle", F.lit(("low_gem_rate", "most_graded", "high_gem_rate")[angle]))


def data_facts(population: DataFrame, least: int = 1) -> DataFrame:
    """Most graded, most tens, and fewest tens among graded items."""
    key = ["set_name", "card_number"]
    one = lambda d, name, *o: d.orderBy(*o, *key).limit(1).withColumn("fact", F.lit(name))
    p = population.where(F.col("total_graded") >= least)
    return one(p, "most_graded", F.desc("total_graded")).unionByName(one(p, "most_tens", F.desc("psa_10"))).unionByName(one(p.where("psa_10 > 0"), "fewest_tens", F.asc("psa_10")))


def releases(calendar: DataFrame, day: dt.date) -> DataFrame:
    """Up to 3 sets of the next 60 days; only without any, those of the last 30 days."""
    away = F.datediff("release_date", F.lit(day))
    rows = calendar.withColumn("days_away", away).withColumn("kind", F.when(away.between(0, 60), 0).when(away.between(-30, -1), 1)).where("kind is not null")
    first = F.min("kind").over(W.partitionBy())
    return rows.withColumn("__first", first).where("kind = __first").orderBy(F.abs("days_away"), "set_name").limit(3).select("set_name", "release_date", "days_away")


def market_trend(index: DataFrame) -> DataFrame:
    """The newest index row, if there are two and it has a week's change."""
    last = index.orderBy(F.desc("date")).limit(2).withColumn("n", F.count("*").over(W.partitionBy())).withColumn("rk", F.row_number().over(W.orderBy(F.desc("date"))))
    return last.where("n = 2 and rk = 1 and raw_pct_7d is not null").drop("n", "rk")
