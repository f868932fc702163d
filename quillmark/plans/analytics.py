"""Registered queries of the price analytics, each with its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.operators import scores, sets, spread, timeseries, trends
from quillmark.plans import oracle_base as o
from quillmark.sources import standins as t

_DAILY = "(SELECT max(date) FROM prices)"
_MONTHLY = "DATE '2001-10-01'"
_DAILY_GRADES = ("raw", "psa10", "psa9", "psa8", "psa7")


def metrics_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeseries.metrics_daily(t.daily_prices(spark, sf_dir))


def metrics_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeseries.metrics_daily(t.monthly_prices(spark, sf_dir), t.MONTHLY_AS_OF)


def spread_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread.spread_daily(t.daily_prices(spark, sf_dir))


def spread_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread.spread_daily(t.monthly_prices(spark, sf_dir), t.MONTHLY_AS_OF)


def card_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.card_trends(t.monthly_prices(spark, sf_dir), t.cards(spark, sf_dir), t.MONTHLY_AS_OF)


def trend_null_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.null_rates(card_trends(spark, sf_dir))


def set_metrics_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.set_metrics_daily(card_trends(spark, sf_dir), t.cards(spark, sf_dir), t.MONTHLY_AS_OF)


def market_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores.market_index(scores.index_history(t.daily_prices(spark, sf_dir)))


def market_index_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = t.daily_prices(spark, sf_dir)
    return scores.index_row(prices, timeseries.latest_date(prices))


def volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of the last month: line items by part, and days since the newest."""
    line = t.read(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("card_slug"), F.to_date("l_shipdate").alias("d")).where(F.col("d") <= F.lit(t.MONTHLY_AS_OF))
    ago = F.datediff(F.lit(t.MONTHLY_AS_OF), "d")
    return line.groupBy("card_slug").agg(F.count(F.when(ago < 30, 1)).alias("sales_30d"), F.min(ago).alias("days_since_last_sale")).withColumn("grade", F.lit("Ungraded"))


def card_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    population = t.population(spark, sf_dir).select(F.col("card_number").alias("card_slug"), F.col("psa_10").alias("population"))
    return scores.card_scores(metrics_monthly(spark, sf_dir), volume(spark, sf_dir), spread_monthly(spark, sf_dir), card_trends(spark, sf_dir), population)


def weekly_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.card_trends(t.weekly_prices(spark, sf_dir), t.supplier_cards(spark, sf_dir), t.WEEKLY_AS_OF)


def weekly_set_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.set_metrics_daily(weekly_trends(spark, sf_dir), t.supplier_cards(spark, sf_dir), t.WEEKLY_AS_OF)


def set_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores.set_scores(weekly_set_metrics(spark, sf_dir))


_WITH_MONTHLY = f"WITH {o.MONTHLY},{o.CARDS},{o.trends(_MONTHLY)}"
_C = o.cents("l_extendedprice / l_quantity") + " // 10"
_WEEKLY = f"""
prices AS (SELECT CAST(l_suppkey AS VARCHAR) AS card_slug, CAST(date_trunc('week', l_shipdate) AS DATE) AS date, max({_C}) AS raw_usd, max(CASE WHEN l_returnflag = 'A' THEN 2 * ({_C}) END) AS psa9_usd, max(CASE WHEN l_returnflag = 'R' THEN 3 * ({_C}) END) AS psa10_usd FROM lineitem GROUP BY 1, 2),
cards AS (SELECT CAST(s_suppkey AS VARCHAR) AS card_slug, s_name || CASE WHEN s_suppkey % 19 = 0 THEN ' Booster Box' ELSE '' END AS card_name, [{", ".join(f"'{n}'" for n in t.SETS)}][s_suppkey % {len(t.SETS)} + 1] AS set_name FROM supplier)"""
WITH_WEEKLY = f"WITH {_WEEKLY},{o.trends(f"DATE '{t.WEEKLY_AS_OF}'")}"
_ERA = """CASE WHEN regexp_matches(set_name, 'Base|Jungle|Fossil|Rocket|Gym|Neo|Skyridge|Aquapolis') THEN 'wotc' WHEN regexp_matches(set_name, 'EX |FireRed|Emerald|Delta|Legend') THEN 'ex'
 WHEN regexp_matches(set_name, 'HeartGold|Black|White|XY|BW') THEN 'mid' WHEN regexp_matches(set_name, 'Sun|Moon|Sword|Shield') THEN 'modern'
 WHEN regexp_matches(set_name, 'Scarlet|Violet|Paldea|Paradox|Obsidian|Temporal|Stellar') THEN 'recent' ELSE 'other' END"""
_VALUE = f"CAST(greatest(0, least(40, {o.r('ln(greatest(1, CAST(set_total_value AS DOUBLE) / 100000)) * 6')})) AS INTEGER)"
_CHANGE = f"CAST(greatest(0, least(40, {o.r('coalesce(set_pct_90d, 0) + 20')})) AS INTEGER)"
_SPREAD = f"CAST(greatest(0, least(20, {o.r('(100 - coalesce(top1_share_pct, 100)) / 5')})) AS INTEGER)"
_LIQUIDITY = "least(100, least(60, coalesce(sales_30d, 0) * 10) + CASE WHEN days_since_last_sale <= 7 THEN 40 WHEN days_since_last_sale <= 14 THEN 30 WHEN days_since_last_sale <= 30 THEN 20 WHEN days_since_last_sale <= 60 THEN 10 ELSE 0 END)"

QUERIES = {f.__name__: f for f in (metrics_daily, metrics_monthly, spread_daily, spread_monthly, card_trends, trend_null_rates, set_metrics_daily, market_index, market_index_today, card_scores, weekly_trends, set_scores)}

SQL = {
    "metrics_daily": f"WITH {o.PRICES},{o.metrics(_DAILY, _DAILY_GRADES)} SELECT * FROM metrics",
    "metrics_monthly": f"WITH {o.MONTHLY},{o.metrics(_MONTHLY, ('raw', 'psa10', 'psa9'))} SELECT * FROM metrics",
    "spread_daily": f"WITH {o.PRICES},{o.spread(_DAILY, _DAILY_GRADES)} SELECT * FROM spread",
    "spread_monthly": f"WITH {o.MONTHLY},{o.spread(_MONTHLY, ('raw', 'psa9', 'psa10'))} SELECT * FROM spread",
    "card_trends": f"{_WITH_MONTHLY} SELECT * FROM trends",
    "trend_null_rates": f"{_WITH_MONTHLY} " + " UNION ALL ".join(f"SELECT '{h}' AS horizon, count(*) FILTER (raw_{h}_ago IS NULL) AS missing, count(*) AS cards, CAST(count(*) FILTER (raw_{h}_ago IS NULL) AS DOUBLE) / count(*) AS share FROM trends" for h in o.HORIZONS),
    "set_metrics_daily": f"{_WITH_MONTHLY},{o.sets()} SELECT * FROM sets",
    "market_index": f"WITH {o.PRICES},{o.index()} SELECT * FROM idx_pct",
    "market_index_today": f"WITH {o.PRICES},{o.index()} SELECT * FROM idx WHERE date = {_DAILY}",
    "card_scores": f"""{_WITH_MONTHLY},{o.metrics(_MONTHLY, ("raw", "psa10", "psa9"))},{o.spread(_MONTHLY, ("raw", "psa9", "psa10"))},
vol AS (SELECT CAST(l_partkey AS VARCHAR) AS card_slug, count(*) FILTER (date_diff('day', CAST(l_shipdate AS DATE), {_MONTHLY}) < 30) AS sales_30d, min(date_diff('day', CAST(l_shipdate AS DATE), {_MONTHLY})) AS days_since_last_sale
  FROM lineitem WHERE CAST(l_shipdate AS DATE) <= {_MONTHLY} GROUP BY 1),
pop AS (SELECT CAST(l_partkey AS VARCHAR) AS card_slug, count(*) FILTER (l_linenumber = 1) AS pop FROM lineitem GROUP BY 1),
j AS (SELECT m.*, sales_30d, days_since_last_sale, s.ratio_10_to_raw, s.best_value_grade, s.premium_10_trend, card_name, set_name, pop, CAST({_LIQUIDITY} AS INTEGER) AS liquidity_score
  FROM metrics m LEFT JOIN vol USING (card_slug) LEFT JOIN spread s USING (card_slug) LEFT JOIN trends t USING (card_slug) LEFT JOIN pop USING (card_slug) WHERE grade = 'raw')
SELECT card_slug, card_name, set_name, liquidity_score, CAST(CASE WHEN volatility_30d IS NULL THEN 50 ELSE greatest(0, least(100, {o.r("volatility_30d * 200")})) END AS INTEGER) AS volatility_score,
  CAST(greatest(0, least(100, {o.r("coalesce(pct_7d, 0) * 0.2::DOUBLE + coalesce(pct_30d, 0) * 0.5::DOUBLE + coalesce(pct_90d, 0) * 0.3::DOUBLE + 50")})) AS INTEGER) AS momentum_score,
  CASE confidence WHEN 'high' THEN 90 WHEN 'medium' THEN 60 ELSE 25 END AS confidence_score, CASE WHEN liquidity_score >= 70 THEN 'High' WHEN liquidity_score >= 35 THEN 'Medium' ELSE 'Low' END AS liquidity_label,
  CASE WHEN volatility_30d IS NULL THEN 'Unknown' WHEN volatility_30d > 0.3 THEN 'Extreme' WHEN volatility_30d > 0.15 THEN 'Volatile' WHEN volatility_30d > 0.06 THEN 'Moderate' ELSE 'Stable' END AS volatility_label,
  ath_price, ath_date, current_price, drawdown_pct, bottom_price, recovery_pct, best_value_grade, ratio_10_to_raw, premium_10_trend,
  CAST(greatest(0, least(100, least(40, greatest(0, CAST(trunc(coalesce(pct_30d, 0)) AS INTEGER) + 20)) + least(30, greatest(0, 30 - coalesce(pop, 9999) // 10)) + least(20, coalesce(sales_30d, 0) * 5) + CASE WHEN confidence = 'high' THEN 10 ELSE 0 END)) AS INTEGER) AS hidden_gem_score, as_of FROM j""",
    "weekly_trends": f"{WITH_WEEKLY} SELECT * FROM trends",
    "set_scores": f"""{WITH_WEEKLY},{o.sets()} SELECT set_name, total_cards, priced_cards, set_total_value, set_median_value, coalesce(top1_share_pct, 100) AS top1_share_pct, top1_card_name, top1_card_price,
  coalesce(set_pct_30d, 0) AS set_pct_30d, coalesce(set_pct_90d, 0) AS set_pct_90d, coalesce(set_pct_365d, 0) AS set_pct_365d, coalesce(divergence_90d, 0) AS divergence_90d,
  {_VALUE} AS value_score, {_CHANGE} AS momentum_score, {_SPREAD} AS concentration_score, {_VALUE} + {_CHANGE} + {_SPREAD} AS strength_score, {_ERA} AS era, as_of FROM sets""",
}
