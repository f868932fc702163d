"""Registered queries over price history that is stored by date and read at the days that count."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from quillmark.operators import history, spread, trends
from quillmark.plans import analytics
from quillmark.sources import readers
from quillmark.sources import standins as t
from quillmark.sources.sinks import new_folder


def _stored(spark: SparkSession, prices: DataFrame, name: str) -> DataFrame:
    path = new_folder(spark, name)
    history.write_history(prices, path)
    return history.read_history(spark, path)


def history_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.history_trends(_stored(spark, t.monthly_prices(spark, sf_dir), "history"), t.cards(spark, sf_dir), t.MONTHLY_AS_OF)


def history_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread.history_spread(_stored(spark, t.monthly_prices(spark, sf_dir), "history"), t.MONTHLY_AS_OF)


def fetched_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day and three columns of the stored history."""
    path = new_folder(spark, "history")
    history.write_history(t.daily_prices(spark, sf_dir), path)
    return readers.price_history(spark, path, ["card_slug", "raw_usd", "psa10_usd"], date=dt.date(2024, 1, 30).isoformat())


QUERIES = {f.__name__: f for f in (history_trends, history_spread, fetched_history)}

SQL = {
    "history_trends": analytics.SQL["card_trends"],
    "history_spread": analytics.SQL["spread_monthly"],
    "fetched_history": f"WITH {analytics.o.PRICES} SELECT 'pc-' || card_slug AS card_slug, raw_usd, psa10_usd FROM prices WHERE date = DATE '2024-01-30'",
}
