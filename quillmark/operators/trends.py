"""Changes against global anchor dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions.numbers import pct_change
from quillmark.functions.text import bare_slug
from quillmark.operators.history import anchor_days, on_anchor_days
from quillmark.operators.spread import anchor_dates
from quillmark.operators.timeseries import latest_date

HORIZONS = {"7d": 7, "30d": 30, "90d": 90, "180d": 180, "365d": 365, "2y": 730, "5y": 1825}
FALLBACK_DAYS = (40, 20)


def card_trends(prices: DataFrame, cards: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """One row per catalogued item with a price row on ``as_of``.

    The newest date on or before each horizon is its anchor for all items. Only for items without a row at
    the 30-day anchor, the newest row between 40 and 20 days back stands in. One scan of the anchor and fallback dates
    and one aggregate by item replace a join per horizon.
    """
    as_of = as_of or latest_date(prices)
    if as_of is None:
        as_of = dt.date(1970, 1, 1)
    anchors = anchor_dates(prices, as_of, tuple(HORIZONS.values()))
    low, high = (as_of - dt.timedelta(days=d) for d in FALLBACK_DAYS)
    dates = sorted({as_of, *(d for d in anchors.values() if d)})
    rows = prices.where(F.col("date").isin(dates) | F.col("date").between(F.lit(low), F.lit(high))).select(bare_slug(F.col("card_slug")).alias("card_slug"), "date", "raw_usd", "psa9_usd", "psa10_usd")
    on = lambda d: F.col("date") == F.lit(d).cast("date")
    at = lambda d, c: F.max(F.when(on(d), F.col(c)))
    near = F.col("date").between(F.lit(low), F.lit(high))
    fallback = F.max_by(F.struct("raw_usd", "psa10_usd"), F.when(near & ~on(anchors[30]), F.col("date"))) if anchors[30] else F.first(F.lit(None).cast("struct<raw_usd:bigint,psa10_usd:bigint>"))
    wide = rows.groupBy("card_slug").agg(
        F.max(F.when(on(as_of), True)).alias("today"),
        F.max(F.when(on(anchors[30]), True)).alias("at_30"),
        fallback.alias("fallback"),
        *[at(as_of, f"{g}_usd").alias(f"current_{g}") for g in ("raw", "psa10", "psa9")],
        *[at(anchors[d], "raw_usd").alias(f"raw_{h}") for h, d in HORIZONS.items()],
        *[at(anchors[d], "psa10_usd").alias(f"psa10_{h}") for h, d in HORIZONS.items() if h in ("30d", "90d")],
    )
    return _changes(wide, cards, as_of)


def _changes(wide: DataFrame, cards: DataFrame, as_of: dt.date) -> DataFrame:
    """Catalogued items with their prices at the anchors, and the changes since."""
    instead = lambda g, h: F.when((F.lit(h) == "30d") & F.col("at_30").isNull(), F.col("fallback")[f"{g}_usd"]).otherwise(F.col(f"{g}_{h}"))
    raw: dict[str, Column] = {h: instead("raw", h) for h in HORIZONS}
    ten: dict[str, Column] = {h: instead("psa10", h) for h in ("30d", "90d")}
    found = wide.where("today").join(cards.select("card_slug", "card_name", "set_name"), "card_slug")
    return found.select(
        "card_slug", "card_name", "set_name", "current_raw", "current_psa9", "current_psa10",
        *[x.cast("bigint").alias(f"raw_{h}_ago") for h, x in raw.items()], *[x.cast("bigint").alias(f"psa10_{h}_ago") for h, x in ten.items()],
        *[pct_change(F.col("current_raw"), x).alias(f"raw_pct_{h}") for h, x in raw.items()], *[pct_change(F.col("current_psa10"), x).alias(f"psa10_pct_{h}") for h, x in ten.items()],
        F.lit(as_of).cast("date").alias("as_of"),
    )


def history_trends(history: DataFrame, cards: DataFrame, as_of: dt.date) -> DataFrame:
    """``card_trends`` over a history that is partitioned by date: the anchor days are a table, and the join with it prunes the scan to their partitions."""
    days = anchor_days(history, as_of, HORIZONS | {"today": 0}, fallback=("30d", *FALLBACK_DAYS))
    rows = on_anchor_days(history, days).select(bare_slug(F.col("card_slug")).alias("card_slug"), "kind", "date", "raw_usd", "psa9_usd", "psa10_usd")
    at = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    today = (F.col("kind") == "today") & (F.col("date") == F.lit(as_of))
    wide = rows.groupBy("card_slug").agg(
        F.max(F.when(today, True)).alias("today"),
        F.max(F.when(F.col("kind") == "30d", True)).alias("at_30"),
        F.max_by(F.struct("raw_usd", "psa10_usd"), F.when(F.col("kind") == "near", F.col("date"))).alias("fallback"),
        *[F.max(F.when(today, F.col(f"{g}_usd"))).alias(f"current_{g}") for g in ("raw", "psa10", "psa9")],
        *[at(h, "raw_usd").alias(f"raw_{h}") for h in HORIZONS],
        *[at(h, "psa10_usd").alias(f"psa10_{h}") for h in ("30d", "90d")],
    )
    return _changes(wide, cards, as_of)


def null_rates(trends: DataFrame) -> DataFrame:
    """How often each horizon has no earlier price."""
    counts = [F.count(F.when(F.col(f"raw_{h}_ago").isNull(), 1)).alias(h) for h in HORIZONS]
    total = trends.agg(F.count("*").alias("cards"), *counts)
    pairs = ", ".join(f"'{h}', `{h}`" for h in HORIZONS)
    return total.select("cards", F.expr(f"stack({len(HORIZONS)}, {pairs}) as (horizon, missing)")).select("horizon", "missing", "cards", F.try_divide(F.col("missing"), F.col("cards")).alias("share"))
