"""Per-item, per-grade time series metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmark.functions.numbers import pct_change, rounded, slope, variation
from quillmark.functions.text import bare_slug

GRADES = {"raw": "raw_usd", "psa10": "psa10_usd", "psa9": "psa9_usd", "psa8": "psa8_usd", "psa7": "psa7_usd"}
LOOKBACKS = (7, 30, 90, 180, 365)


def latest_date(prices: DataFrame) -> dt.date | None:
    """The one scalar that jobs read ahead: the newest date of the data."""
    return prices.agg(F.max("date")).first()[0]


def long_prices(prices: DataFrame, grades: dict[str, str] | None = None) -> DataFrame:
    """(card_slug, grade, date, price) of positive prices; grade columns that the table lacks are left out."""
    found = [(g, c) for g, c in (grades or GRADES).items() if c in prices.columns]
    pairs = ", ".join(f"'{g}', cast({c} as bigint)" for g, c in found)
    stacked = prices.select(bare_slug(F.col("card_slug")).alias("card_slug"), "date", F.expr(f"stack({len(found)}, {pairs}) as (grade, price)"))
    return stacked.where("price > 0")


def as_of_price(as_of: Column, days: int) -> Column:
    """Aggregate: the newest price on or before ``as_of`` minus ``days``."""
    return F.max_by("price", F.when(F.col("date") <= F.date_sub(as_of, days), F.col("date")))


def metrics_daily(prices: DataFrame, as_of: dt.date | None = None, *, require_current: bool = True) -> DataFrame:
    """One row per item and grade that has a price on ``as_of`` (default: the newest date of the data).

    One shuffle by (item, grade): the window that finds the high and the aggregate share it, with partial
    aggregates ruled out only because the bottom depends on the date of the high.
    """
    as_of = as_of or latest_date(prices)
    today = F.lit(as_of).cast("date")
    own = W.partitionBy("card_slug", "grade")
    rows = long_prices(prices).where(F.col("date") <= today)
    high = F.min(F.struct((-F.col("price")).alias("minus"), F.col("date").alias("at"))).over(own)
    rows = rows.withColumn("high", high).withColumn("last", F.max("date").over(own))
    if require_current:
        rows = rows.where(F.col("last") == today)
    rows = rows.withColumn("ago", F.datediff(today, "date"))
    within = lambda days, x: F.when(F.col("ago") <= days, x)
    price = F.col("price")
    after = F.when(F.col("date") >= F.col("high.at"), F.struct("price", "date"))
    year = within(365, F.struct((-price).alias("minus"), F.col("date").alias("at")))
    out = rows.groupBy("card_slug", "grade").agg(
        F.max_by("price", "date").alias("current_price"),
        F.first(-F.col("high.minus")).alias("ath_price"),
        F.first("high.at").alias("ath_date"),
        F.min(after).alias("bottom"),
        F.min(year).alias("year_high"),
        *[slope(within(d, price.cast("double")), within(d, (d - F.col("ago")).cast("double"))).alias(f"slope_{d}d") for d in (30, 90, 365)],
        *[variation(within(d, price.cast("double"))).alias(f"volatility_{d}d") for d in (30, 90)],
        *[as_of_price(today, d).alias(f"old_{d}") for d in LOOKBACKS],
        F.count("*").alias("data_points_total"),
        F.count(within(90, F.lit(1))).alias("data_points_90d"),
        F.min("ago").alias("freshness_days"),
    )
    now, top, low = F.col("current_price"), F.col("ath_price"), F.col("bottom.price")
    total, recent = F.col("data_points_total"), F.col("data_points_90d")
    return out.select(
        "card_slug", "grade", "current_price", "ath_price", "ath_date",
        pct_change(now, top).alias("drawdown_pct"),
        low.alias("bottom_price"), F.col("bottom.date").alias("bottom_date"),
        F.when(top > low, rounded((now - low) / (top - low) * 100, 2)).otherwise(F.lit(100.0)).alias("recovery_pct"),
        (-F.col("year_high.minus")).alias("high_12m"), F.col("year_high.at").alias("high_12m_date"),
        F.coalesce(now >= -F.col("year_high.minus"), F.lit(False)).alias("is_new_12m_high"),
        "slope_30d", "slope_90d", "slope_365d", "volatility_30d", "volatility_90d",
        *[pct_change(now, F.col(f"old_{d}")).alias(f"pct_{d}d") for d in LOOKBACKS],
        "data_points_total", "data_points_90d", F.col("freshness_days").cast("bigint").alias("freshness_days"),
        F.when((total >= 12) & (recent >= 2), "high").when(total >= 6, "medium").when(total >= 3, "low").otherwise("very_low").alias("confidence"),
        today.alias("as_of"),
    )
