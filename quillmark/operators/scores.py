"""The market index and the scores of items and sets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions.numbers import clamp, rounded
from quillmark.functions.text import era
from quillmark.operators.medians import exact_medians

NEAR_DAYS = 5


def index_row(prices: DataFrame, as_of: dt.date) -> DataFrame:
    """Totals, counts and medians of one day; zeros and no medians for a day without prices."""
    day = prices.sparkSession.range(1).select(F.lit(as_of).cast("date").alias("date"))
    found = day.join(index_history(prices.where(F.col("date") == F.lit(as_of))), "date", "left")
    return found.fillna(0, [c for c in found.columns if c.startswith(("total_raw", "total_psa10", "total_cards", "cards_"))])


def index_history(prices: DataFrame) -> DataFrame:
    """The index of every day at once. Medians are exact and floored, and selected by counting, so a day may have any number of items."""
    raw, ten = (F.when(F.col(c) > 0, F.col(c)) for c in ("raw_usd", "psa10_usd"))
    whole = F.coalesce("raw_usd", F.lit(0)) + F.coalesce("psa9_usd", F.lit(0)) + F.coalesce("psa10_usd", F.lit(0))
    totals = prices.groupBy("date").agg(
        F.coalesce(F.sum(raw), F.lit(0)).alias("total_raw_usd"), F.count(raw).alias("cards_with_raw_price"),
        F.coalesce(F.sum(ten), F.lit(0)).alias("total_psa10_usd"), F.count(ten).alias("cards_with_psa10_price"),
        F.sum(whole).alias("total_combined_usd"), F.count("*").alias("total_cards_tracked"),
    )
    both = prices.select("date", F.explode(F.array(F.struct(F.lit("raw").alias("kind"), raw.cast("bigint").alias("cents")), F.struct(F.lit("psa10").alias("kind"), ten.cast("bigint").alias("cents")))).alias("p")).select("date", "p.kind", "p.cents")
    middle = exact_medians(both, ["date", "kind"], "cents").groupBy("date").agg(*[F.max(F.when(F.col("kind") == k, F.col("median"))).alias(f"median_{k}_usd") for k in ("raw", "psa10")])
    return totals.join(middle, "date", "left")


def nearest_index(history: DataFrame, targets: DataFrame, days: int = NEAR_DAYS) -> DataFrame:
    """(date, key, past): for each row (date, key, target) the total of the newest index row on or before the target, else the
    earliest after it, both within ``days``. The row's own date doesn't count.

    Each target meets at most 2 * days + 1 dates, by an equi-join on the dates around it.
    """
    around = targets.withColumn("near", F.explode(F.sequence(F.date_sub("target", days), F.date_add("target", days)))).where(F.col("near") != F.col("date"))
    met = around.join(history.select(F.col("date").alias("near"), F.col("total_raw_usd").alias("past")), "near")
    order = F.struct((F.col("near") > F.col("target")).alias("after"), F.abs(F.datediff("near", "target")).alias("distance"))
    return met.groupBy("date", "key").agg(F.min_by("past", order).alias("past"))


def market_index(history: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Index rows (of ``dates``, default all) with 1-, 7- and 30-day changes to four places."""
    own = history if dates is None else history.join(dates.select("date"), "date", "left_semi")
    pairs = ", ".join(f"'raw_pct_{d}d', date_sub(date, {d})" for d in (1, 7, 30))
    past = nearest_index(history, own.select("date", F.expr(f"stack(3, {pairs}) as (key, target)")))
    wide = past.where("past > 0").groupBy("date").agg(*[F.max(F.when(F.col("key") == f"raw_pct_{d}d", F.col("past"))).alias(f"past_{d}") for d in (1, 7, 30)])
    out = own.join(wide, "date", "left")
    return out.select(*own.columns, *[rounded((F.col("total_raw_usd") - F.col(f"past_{d}")) / F.col(f"past_{d}") * 100, 4).alias(f"raw_pct_{d}d") for d in (1, 7, 30)])


def liquidity(sales: Column, days: Column) -> Column:
    fresh = F.when(days <= 7, 40).when(days <= 14, 30).when(days <= 30, 20).when(days <= 60, 10).otherwise(0)
    return F.least(F.lit(100), F.least(F.lit(60), F.coalesce(sales, F.lit(0)) * 10) + fresh).cast("int")


def momentum(week: Column, month: Column, quarter: Column) -> Column:
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    return clamp(rounded(zero(week) * 0.2 + zero(month) * 0.5 + zero(quarter) * 0.3 + 50), 0, 100).cast("int")


def volatility_score(v: Column) -> Column:
    return F.when(v.isNull(), 50).otherwise(clamp(rounded(v * 200), 0, 100).cast("int"))


def card_scores(metrics: DataFrame, volume: DataFrame, spread: DataFrame, trends: DataFrame, population: DataFrame, *, legacy_zero: bool = False) -> DataFrame:
    """Scores of raw metrics rows. Five left joins on the item; each right side has one row an item.

    ``legacy_zero`` takes a last sale 0 days ago as unknown, and zero drawdown and recovery as null.
    """
    m = metrics.where("grade = 'raw'")
    v = volume.where("grade = 'Ungraded'").select("card_slug", "sales_30d", "days_since_last_sale")
    s = spread.select("card_slug", "ratio_10_to_raw", "best_value_grade", "premium_10_trend")
    p = population.select("card_slug", F.col("population").alias("psa10_pop"))
    j = m.join(v, "card_slug", "left").join(s, "card_slug", "left").join(trends.select("card_slug", "card_name", "set_name"), "card_slug", "left").join(p, "card_slug", "left")
    days = F.coalesce("days_since_last_sale", F.lit(999))
    days = F.when(days == 0, 999).otherwise(days) if legacy_zero else days
    zero = (lambda c: F.when(F.col(c) != 0, F.col(c))) if legacy_zero else F.col
    sales, pop = F.coalesce("sales_30d", F.lit(0)), F.coalesce("psa10_pop", F.lit(9999))
    gem = F.least(F.lit(40), F.greatest(F.lit(0), F.coalesce("pct_30d", F.lit(0.0)).cast("int") + 20)) + F.least(F.lit(30), F.greatest(F.lit(0), 30 - F.floor(pop / 10))) + F.least(F.lit(20), sales * 5) + F.when(F.col("confidence") == "high", 10).otherwise(0)
    out = j.withColumn("liquidity_score", liquidity(F.col("sales_30d"), days))
    v30 = F.col("volatility_30d")
    return out.select(
        "card_slug", "card_name", "set_name", "liquidity_score",
        volatility_score(v30).alias("volatility_score"),
        momentum(F.col("pct_7d"), F.col("pct_30d"), F.col("pct_90d")).alias("momentum_score"),
        F.when(F.col("confidence") == "high", 90).when(F.col("confidence") == "medium", 60).otherwise(25).alias("confidence_score"),
        F.when(F.col("liquidity_score") >= 70, "High").when(F.col("liquidity_score") >= 35, "Medium").otherwise("Low").alias("liquidity_label"),
        F.when(v30.isNull(), "Unknown").when(v30 > 0.3, "Extreme").when(v30 > 0.15, "Volatile").when(v30 > 0.06, "Moderate").otherwise("Stable").alias("volatility_label"),
        "ath_price", "ath_date", "current_price", zero("drawdown_pct").alias("drawdown_pct"), "bottom_price", zero("recovery_pct").alias("recovery_pct"),
        "best_value_grade", "ratio_10_to_raw", "premium_10_trend",
        clamp(gem, 0, 100).cast("int").alias("hidden_gem_score"), "as_of",
    )


def set_scores(set_metrics: DataFrame, *, legacy_zero: bool = False) -> DataFrame:
    """Scores of the newest row of each set."""
    newest = set_metrics.where("set_name <> ''").groupBy("set_name").agg(F.max_by(F.struct(*[c for c in set_metrics.columns if c != "set_name"]), "as_of").alias("r")).select("set_name", "r.*")
    top1 = F.coalesce("top1_share_pct", F.lit(100.0))
    top1 = F.when(top1 == 0, 100.0).otherwise(top1) if legacy_zero else top1
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    value = clamp(rounded(F.log(F.greatest(F.lit(1.0), F.coalesce("set_total_value", F.lit(0)) / 100_000)) * 6), 0, 40).cast("int")
    change = clamp(rounded(zero("set_pct_90d") + 20), 0, 40).cast("int")
    spread = clamp(rounded((100 - top1) / 5), 0, 20).cast("int")
    return newest.select(
        "set_name", "total_cards", "priced_cards", "set_total_value", "set_median_value", top1.alias("top1_share_pct"), "top1_card_name", "top1_card_price",
        zero("set_pct_30d").alias("set_pct_30d"), zero("set_pct_90d").alias("set_pct_90d"), zero("set_pct_365d").alias("set_pct_365d"), zero("divergence_90d").alias("divergence_90d"),
        value.alias("value_score"), change.alias("momentum_score"), spread.alias("concentration_score"), (value + change + spread).alias("strength_score"), era(F.col("set_name")).alias("era"), "as_of",
    )
