"""History by date: the join with the anchor days prunes partitions, and gives what the whole table gives."""

import datetime as dt

from pyspark.sql import functions as F

from quillmark.operators import history, spread, trends

AS_OF = dt.date(2024, 6, 30)


def prices(spark):
    days = [AS_OF - dt.timedelta(days=d) for d in (0, 1, 5, 8, 25, 29, 31, 39, 41, 95, 200, 400, 800, 2000)] + [AS_OF + dt.timedelta(days=1)]
    rows = [(f"pc-{c}", d, 100 + 7 * c + d.day, None if c % 3 else 500 + d.day, 900 + d.month * c) for c in range(9) for k, d in enumerate(days) if (c + k) % 4]
    return spark.createDataFrame(rows, "card_slug string, date date, raw_usd bigint, psa9_usd bigint, psa10_usd bigint")


def stored(spark, folder):
    path = f"file://{folder}/history"
    history.write_history(prices(spark), path)
    return history.read_history(spark, path)


def cards(spark):
    return spark.createDataFrame([(str(c), f"Card {c}", "Set") for c in range(8)], "card_slug string, card_name string, set_name string")


def same(a, b):
    assert sorted(map(str, a.select(sorted(a.columns)).collect())) == sorted(map(str, b.select(sorted(a.columns)).collect()))


def test_same_as_from_one_table(spark, tmp_path):
    kept = stored(spark, tmp_path)
    for as_of in (AS_OF, AS_OF - dt.timedelta(days=1), AS_OF - dt.timedelta(days=900), dt.date(2000, 1, 1)):
        same(trends.history_trends(kept, cards(spark), as_of), trends.card_trends(prices(spark), cards(spark), as_of))
        same(spread.history_spread(kept, as_of), spread.spread_daily(prices(spark), as_of))
    empty = kept.where("false")
    assert trends.history_trends(empty, cards(spark), AS_OF).count() == 0 and spread.history_spread(empty, AS_OF).count() == 0


def test_partitions_are_pruned_while_running(spark, tmp_path):
    found = trends.history_trends(stored(spark, tmp_path), cards(spark), AS_OF)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression" in plan
    found.collect()
    # The files that the big scan opened: fewer than there are days.
    after = found._jdf.queryExecution().executedPlan().toString()
    assert after.count("dynamicpruningexpression(true)") == 0
    days = history.anchor_days(prices(spark), AS_OF, trends.HORIZONS | {"today": 0}, fallback=("30d", 40, 20)).select("date").distinct().count()
    read = history.on_anchor_days(history.read_history(spark, f"file://{tmp_path}/history"), history.anchor_days(history.read_history(spark, f"file://{tmp_path}/history"), AS_OF, trends.HORIZONS | {"today": 0}, fallback=("30d", 40, 20)))
    assert read.select("date").distinct().count() == days < prices(spark).select("date").distinct().count()


def test_a_day_replaces_itself_only(spark, tmp_path):
    path = f"file://{tmp_path}/history"
    kept = stored(spark, tmp_path)
    before = kept.count()
    history.write_history(prices(spark).where(F.col("date") == F.lit(AS_OF)).limit(1), path)
    now = history.read_history(spark, path)
    assert now.where(F.col("date") == F.lit(AS_OF)).count() == 1
    assert now.count() == before - prices(spark).where(F.col("date") == F.lit(AS_OF)).count() + 1
