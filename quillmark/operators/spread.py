"""Premiums between grades: ratios today and at two earlier anchors, their direction, and the best-value grade."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions.numbers import ratio
from quillmark.functions.text import bare_slug
from quillmark.operators.history import anchor_days, on_anchor_days
from quillmark.operators.timeseries import latest_date

PRICES = ("raw_usd", "psa7_usd", "psa8_usd", "psa9_usd", "cgc95_usd", "psa10_usd")
PAIRS = {"10_to_raw": ("psa10_usd", "raw_usd"), "10_to_9": ("psa10_usd", "psa9_usd"), "9_to_raw": ("psa9_usd", "raw_usd")}


def anchor_dates(prices: DataFrame, as_of: dt.date, days: tuple[int, ...]) -> dict[int, dt.date | None]:
    """For each number of days the newest date of the data on or before ``as_of`` minus it: one scan of the date column."""
    row = prices.select("date").where(F.col("date") <= F.lit(as_of)).agg(*[F.max(F.when(F.col("date") <= F.lit(as_of - dt.timedelta(days=d)), F.col("date"))).alias(f"d{d}") for d in days]).first()
    return {d: row[f"d{d}"] for d in days}


def premium_direction(now: Column, then: Column) -> Column:
    diff = now - then
    return F.when(diff.isNull(), "insufficient_data").when(F.abs(diff) < 0.1, "stable").when(diff > 0, "expanding").otherwise("compressing")


def spread_daily(prices: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """One row per item with a raw and a graded price on ``as_of``. Only three dates are read; one shuffle by item."""
    as_of = as_of or latest_date(prices)
    anchors = {0: as_of} | anchor_dates(prices, as_of, (30, 90)) if as_of else {0: None, 30: None, 90: None}
    wanted = sorted({d for d in anchors.values() if d})
    have = [c for c in PRICES if c in prices.columns]
    rows = prices.where(F.col("date").isin(wanted)).select(bare_slug(F.col("card_slug")).alias("card_slug"), "date", *have)
    at = lambda d, c: F.max(F.when(F.col("date") == F.lit(anchors[d]).cast("date"), F.col(c) if c in have else F.lit(None).cast("bigint"))).alias(f"{c}_{d}")
    wide = rows.groupBy("card_slug").agg(*[at(0, c) for c in PRICES], *[at(d, c) for d in (30, 90) for c in ("raw_usd", "psa9_usd", "psa10_usd")])
    return _premiums(wide, as_of)


def history_spread(history: DataFrame, as_of: dt.date) -> DataFrame:
    """``spread_daily`` over a history that is partitioned by date: only the partitions of three days are read."""
    kinds = {"0": 0, "30": 30, "90": 90}
    have = [c for c in PRICES if c in history.columns]
    rows = on_anchor_days(history, anchor_days(history, as_of, kinds)).where((F.col("kind") != "0") | (F.col("date") == F.lit(as_of)))
    at = lambda k, c: F.max(F.when(F.col("kind") == k, F.col(c) if c in have else F.lit(None).cast("bigint"))).alias(f"{c}_{k}")
    wide = rows.groupBy(bare_slug(F.col("card_slug")).alias("card_slug")).agg(*[at("0", c) for c in PRICES], *[at(k, c) for k in ("30", "90") for c in ("raw_usd", "psa9_usd", "psa10_usd")])
    return _premiums(wide, as_of)


def _premiums(wide: DataFrame, as_of: dt.date | None) -> DataFrame:
    """Ratios of an item's prices today (``_0``) and at two anchors, for items with a raw and a graded price today."""
    now = lambda c: F.col(f"{c}_0")
    graded = [now(c) for c in ("psa7_usd", "psa8_usd", "psa9_usd", "psa10_usd")]
    wide = wide.where((now("raw_usd") != 0) & (F.greatest(*[F.coalesce(g, F.lit(0)) for g in graded]) > 0))
    old = {f"ratio_{n}_{d}d": ratio(F.col(f"{a}_{d}"), F.col(f"{b}_{d}")) for d in (30, 90) for n, (a, b) in PAIRS.items()}
    r = {n: ratio(now(a), now(b)) for n, (a, b) in PAIRS.items()}
    # The lowest multiple of raw; ties go to psa9, psa10, psa8.
    options = F.array(*[F.when(ratio(now(c), now("raw_usd")) > 0, F.struct(ratio(now(c), now("raw_usd")).alias("r"), F.lit(k).alias("k"), F.lit(c.removesuffix("_usd")).alias("g"))) for k, c in enumerate(("psa9_usd", "psa10_usd", "psa8_usd"))])
    trend = lambda n: premium_direction(r[n], F.coalesce(old[f"ratio_{n}_90d"], old[f"ratio_{n}_30d"]))
    return wide.select(
        "card_slug",
        *[now(c).alias(c.replace("_usd", "_price")) for c in PRICES],
        r["10_to_raw"].alias("ratio_10_to_raw"), r["10_to_9"].alias("ratio_10_to_9"), r["9_to_raw"].alias("ratio_9_to_raw"),
        ratio(now("psa9_usd"), now("psa8_usd")).alias("ratio_9_to_8"), ratio(now("psa9_usd"), now("psa7_usd")).alias("ratio_9_to_7"),
        *[x.alias(n) for n, x in old.items()],
        trend("10_to_raw").alias("premium_10_trend"), trend("9_to_raw").alias("premium_9_trend"),
        F.array_min(options)["g"].alias("best_value_grade"),
        F.lit(as_of).cast("date").alias("as_of"),
    )
