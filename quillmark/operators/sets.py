"""Set-level totals, concentration and weighted trends."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmark.functions.numbers import rounded
from quillmark.operators.medians import exact_medians

PERIODS = ("30d", "90d", "180d", "365d")


def weighted_trend(change: Column, weight: Column) -> Column:
    """Aggregate: mean of the changes that are there, weighted by price, to one place."""
    return rounded(F.try_divide(F.sum(change * weight), F.sum(F.when(change.isNotNull(), weight))), 1)


def set_metrics_daily(trends: DataFrame, cards: DataFrame, as_of: dt.date) -> DataFrame:
    """One row per set with at least two priced items.

    Ranks come from a window by set, which the aggregate reuses, so trends are shuffled once. Counts of the catalogue
    are aggregated before the join; medians are selected by counting.
    """
    priced = trends.where("set_name <> '' and current_raw > 0")
    rank = F.row_number().over(W.partitionBy("set_name").orderBy(F.desc("current_raw"), "card_slug"))
    ranked = priced.withColumn("rk", rank)
    raw, rk = F.col("current_raw"), F.col("rk")
    top = lambda n: F.sum(F.when(rk <= n, raw))
    mean = lambda test: rounded(F.avg(F.when(test, F.col("raw_pct_90d"))), 1)
    total, n = F.sum("current_raw"), F.count("*")
    grouped = ranked.groupBy("set_name").agg(
        n.alias("priced_cards"),
        F.count(F.when(raw >= 1000, 1)).alias("cards_over_10"),
        F.count(F.when(raw >= 10_000, 1)).alias("cards_over_100"),
        total.alias("set_total_value"),
        rounded(top(1) / total * 100, 1).alias("top1_share_pct"),
        F.when(n >= 5, rounded(top(5) / total * 100, 1)).alias("top5_share_pct"),
        F.when(n >= 10, rounded(top(10) / total * 100, 1)).alias("top10_share_pct"),
        F.max(F.when(rk == 1, F.col("card_name"))).alias("top1_card_name"),
        F.max(F.when(rk == 1, raw)).alias("top1_card_price"),
        *[weighted_trend(F.col(f"raw_pct_{p}"), raw).alias(f"set_pct_{p}") for p in PERIODS],
        mean(rk <= 5).alias("top5_avg_pct_90d"),
        mean(rk > 5).alias("rest_avg_pct_90d"),
    )
    counts = cards.where("set_name <> ''").groupBy("set_name").agg(F.count("*").alias("total_cards"))
    medians = exact_medians(priced, ["set_name"], "current_raw").withColumnRenamed("median", "set_median_value")
    out = grouped.where("priced_cards >= 2").join(medians, "set_name").join(counts, "set_name", "left").withColumn("total_cards", F.coalesce("total_cards", "priced_cards"))
    return out.withColumn("set_avg_value", F.expr("set_total_value div total_cards")).withColumn("divergence_90d", rounded(F.col("rest_avg_pct_90d") - F.col("top5_avg_pct_90d"), 1)).withColumn("as_of", F.lit(as_of).cast("date"))
