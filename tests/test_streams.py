"""Streams give what the batch forms give."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quillmark.operators import scheduling
from quillmark.sources import sinks
from quillmark.streaming import events as ev
from quillmark.streaming import runs

pytest.importorskip("google.protobuf")

STATES = ["unknown", "sold_out", "in_stock", "in_stock", "coming_soon", "preorder_open"]


def observations(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(f"p{i % 3}", i, STATES[(i * 7) % 6], None if i % 5 == 0 else 100.0 - (i % 4) * 6, start + dt.timedelta(minutes=13 * i), None if i % 11 else "timeout") for i in range(60)]
    return spark.createDataFrame(rows, "page_id string, event_id bigint, stock_state string, price double, observed_at timestamp, error string")


def in_batches(spark, df, folder, parts, order):
    """Files that a stream reads one at a time, in order."""
    path = f"{folder}/in"
    total = df.count()
    for k in range(parts):
        rows = df.orderBy(order).collect()[k * total // parts : (k + 1) * total // parts]
        spark.createDataFrame(rows, df.schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def run(stream, folder, name, mode="append"):
    q = stream.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert q.exception() is None
    return stream.sparkSession.table(name)


def test_changes(spark, tmp_path):
    rows = observations(spark)
    found = run(ev.change_stream(in_batches(spark, rows, tmp_path, 3, "event_id")), tmp_path, "changes_out")
    columns = ["page_id", "event_id", "event_type", "new_value", "significance", "alert"]
    assert sorted(map(tuple, found.select(columns).collect())) == sorted(map(tuple, ev.changes(rows).select(columns).collect()))


def test_streaks(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    kinds = ["page_reached_no_price", "priced", "timeout", "page_reached_no_price", "page_reached_no_price"]
    rows = spark.createDataFrame([(f"c{i % 4}", i, kinds[(i * 3 + i // 7) % 5], start + dt.timedelta(minutes=i)) for i in range(48)], "card_slug string, event_id bigint, category string, attempted_at timestamp")
    found = run(ev.streak_stream(in_batches(spark, rows, tmp_path, 3, "event_id")), tmp_path, "streaks_out", "update")
    last = found.groupBy("card_slug").agg(F.max_by("no_price_streak", "last_attempted_at").alias("n"))
    assert {r["card_slug"]: r["n"] for r in last.collect()} == {r["card_slug"]: r["no_price_streak"] for r in scheduling.streaks(rows).collect()}


def test_hourly_counts_and_dedup(spark, tmp_path):
    events = ev.changes(observations(spark)).select("page_id", "event_type", "new_value", "observed_at")
    stream = in_batches(spark, events, tmp_path, 2, "observed_at")
    found = run(ev.deduplicated(stream).select("event_hash"), tmp_path, "dedup_out")
    assert found.count() == ev.deduplicated(events).count()
    total = run(ev.hourly_counts(stream), f"{tmp_path}/h", "hourly_out", "complete").agg(F.sum("n")).first()[0]
    assert total == events.count()


def test_sales_ingest(spark, tmp_path):
    from tests.test_jobs import SALES, sale

    path = f"file://{tmp_path}/sales"
    rows = spark.createDataFrame([sale(f"{c}{i:02d}", f"2024-01-{i + 1:02d}", c) for i in range(12) for c in "cd"], SALES)
    ingest = ev.sales_batches(path, SALES, buckets=4)
    q = in_batches(spark, rows, tmp_path, 3, "sale_date").writeStream.foreachBatch(ingest).option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    q.awaitTermination(240)
    assert q.exception() is None
    active = lambda: sorted(r["provider_sale_key"] for r in sinks.stored(spark, path, SALES).where("review_status = 'active'").collect())
    assert active() == sorted(f"{c}{i:02d}" for i in range(7, 12) for c in "cd")
    ingest(spark.createDataFrame([sale("c99", "2024-02-01")], SALES), 0)
    assert "c99" not in active()  # batch 0 is done
    ingest(spark.createDataFrame([sale("c99", "2024-02-01")], SALES), 3)
    assert active() == sorted(["c99", *(f"c{i:02d}" for i in range(8, 12)), *(f"d{i:02d}" for i in range(7, 12))])


def test_listings_expire(spark, tmp_path):
    schema = "card_slug string, marketplace string, ebay_item_id string, price int, scraped_at timestamp"
    path, start = f"file://{tmp_path}/listings", dt.datetime(2024, 1, 1)
    ingest = ev.listing_batches(path, schema, buckets=1)
    batch = lambda *rows: spark.createDataFrame([("c", "m", i, p, start + dt.timedelta(hours=h)) for i, p, h in rows], schema)
    found = lambda: sorted((r["ebay_item_id"], r["price"]) for r in sinks.stored(spark, path, schema).collect())
    ingest(batch(("a", 1, 0), ("b", 2, 1), ("b", 3, 2)), 0)
    assert found() == [("a", 1), ("b", 3)]
    ingest(batch(("b", 9, 1), ("d", 4, 25)), 1)  # an older row of b changes nothing, a is older than a day
    assert found() == [("b", 3), ("d", 4)]
    ingest(batch(("b", 5, 49)), 2)
    ingest(batch(("b", 5, 49)), 2)
    assert found() == [("b", 5), ("d", 4)]
    ingest(spark.createDataFrame([], schema), 3)
    assert found() == [("b", 5), ("d", 4)]


def test_run_metrics(spark, tmp_path):
    """Every micro-batch's metrics have come when the block ends, those of other names aren't taken."""
    rows = observations(spark)
    with ev.run_metrics(spark) as seen:
        run(ev.observed(ev.change_stream(in_batches(spark, rows, tmp_path, 3, "event_id"))), tmp_path, "observed_out")
    found = spark.table("observed_out")
    assert len(seen) == 3 and [r["batch_id"] for r in seen] == [0, 1, 2] and {r["query"] for r in seen} == {"observed_out"}
    assert sum(r["rows"] for r in seen) == found.count() and sum(r["alerts"] for r in seen) == found.where("alert = 'true'").count()


LISTINGS = "card_slug string, marketplace string, ebay_item_id string, price double, scraped_at timestamp"
START = dt.datetime(2024, 1, 1)


def listed(spark, *rows):
    return spark.createDataFrame([("c", "m", i, p, None if h is None else START + dt.timedelta(hours=h)) for i, p, h in rows], LISTINGS)


def arrivals(spark, folder, *batches):
    """What the listing stream says when these batches arrive one after the other."""
    for k, batch in enumerate(batches):
        batch.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        with runs.stateful(spark):
            runs.to_the_end(ev.listing_stream(spark.readStream.schema(LISTINGS).parquet(f"{folder}/in")), f"{folder}/out", f"{folder}/state", f"listings-{k}")
    return spark.read.schema(ev.LISTINGS).parquet(f"{folder}/out")


def test_timers_forget_listings_without_new_input(spark, tmp_path):
    found = arrivals(spark, tmp_path, listed(spark, ("a", 1.0, 0), ("b", 2.0, 1), ("b", 3.0, 2), ("n", 1.0, None)), listed(spark, ("d", 4.0, 25)), listed(spark, ("b", 5.0, 26), ("a", 9.0, 26)), listed(spark, ("z", None, 60)))
    said = [(r["ebay_item_id"], r["price"], (r["scraped_at"] - START).total_seconds() / 3600, r["kind"]) for r in found.collect()]
    # a is forgotten at hour 24 though nothing came for it, and comes back as new; b, d and a are over by hour 60.
    assert sorted(said, key=str) == sorted([("a", 1.0, 0, "listed"), ("b", 3.0, 2, "listed"), ("a", 1.0, 0, "expired"), ("d", 4.0, 25, "listed"), ("b", 5.0, 26, "updated"), ("a", 9.0, 26, "listed"), ("b", 5.0, 26, "expired"), ("a", 9.0, 26, "expired"), ("d", 4.0, 25, "expired"), ("z", None, 60, "listed")], key=str)
    assert [r["ebay_item_id"] for r in ev.live_listings(found).collect()] == ["z"]
    # The state itself holds live listings only.
    with runs.stateful(spark):
        state = spark.read.format("statestore").option("stateVarName", "newest").load(f"{tmp_path}/state")
        assert [r["key"]["ebay_item_id"] for r in state.collect()] == ["z"]


def test_a_day_is_kept_and_a_moment_more_is_not(spark, tmp_path):
    batch = [("x", 1.0, 0), ("y", 1.0, 0.001), ("now", 1.0, 24.0005)]
    found = arrivals(spark, tmp_path, listed(spark, *batch))
    assert {r["ebay_item_id"] for r in ev.live_listings(found).collect()} == {"y", "now"}
    assert {r["ebay_item_id"] for r in ev.newest_listings(listed(spark, *batch), F.lit(START + dt.timedelta(hours=24.0005))).collect()} == {"y", "now"}


def test_streak_keeps_every_stored_field(spark, tmp_path):
    schema = "card_slug string, event_id bigint, category string, http_status bigint, attempted_at timestamp"
    at = lambda h: START + dt.timedelta(hours=h)
    rows = spark.createDataFrame([("a", 1, "timeout", None, at(0)), ("b", 2, "page_reached_no_price", 200, at(1)), ("a", 3, "not_found", 404, at(2)), ("c", 4, "timeout", None, at(3)), ("a", 5, "timeout", None, at(4))], schema)
    prior = spark.createDataFrame([("a", 4, "priced", 200, at(-9), at(-9)), ("c", 2, None, None, None, None), ("b", 1, "timeout", 500, at(-5), at(-6))], ev.STREAKS)
    states = runs.in_slices(rows, "attempted_at", lambda s: ev.streak_stream(s, prior), "streak-test", slices=2)
    last = {r["card_slug"]: tuple(r)[1:] for r in states.orderBy("last_attempted_at").collect()}
    expected = {"a": (4, "timeout", 404, at(4), at(-9)), "b": (2, "page_reached_no_price", 200, at(1), at(1)), "c": (2, "timeout", None, at(3), None)}
    assert last == expected
    batch = scheduling.streaks(rows, prior, order=("attempted_at", "event_id"))
    assert {r["card_slug"]: tuple(r)[1:] for r in batch.select(ev.STREAKS.names).collect()} == expected


def test_slices_of_an_empty_table(spark):
    empty = spark.createDataFrame([], LISTINGS)
    assert runs.in_slices(empty, "scraped_at", ev.listing_stream, "empty-test").count() == 0


def test_buckets_of_listings_say_what_single_listings_say(spark, tmp_path):
    """Random rows in several runs, among them late ones, ends on the watermark itself, and keys and prices that are null."""
    rng = random.Random(5)
    batches = [[(rng.choice("abcdefgh"), rng.choice("mn"), rng.choice(["1", "2", None]), rng.choice([None, 1.0, 2.0]), START + dt.timedelta(hours=rng.randrange(20) + 12 * k, milliseconds=rng.choice([0, 1]))) for _ in range(40)] for k in range(5)]

    def said(buckets):
        folder = f"{tmp_path}/{buckets}"
        for k, batch in enumerate(batches):
            spark.createDataFrame(batch, LISTINGS).coalesce(1).write.mode("append").parquet(f"{folder}/in")
            with runs.stateful(spark):
                runs.to_the_end(ev.listing_stream(spark.readStream.schema(LISTINGS).parquet(f"{folder}/in"), buckets=buckets), f"{folder}/out", f"{folder}/state", f"both-{k}")
        found = spark.read.schema(ev.LISTINGS).parquet(f"{folder}/out")
        with runs.stateful(spark):
            return sorted(map(str, found.collect())), spark.read.format("statestore").option("stateVarName", "newest" if buckets is None else "bucket").load(f"{folder}/state").count()

    (single, listings), (bucketed, states) = said(None), said(3)
    assert single == bucketed and states <= 3 < listings


def test_streams_keep_state_by_bucket(spark, tmp_path):
    """A call and a state a bucket, not a page."""
    rows = observations(spark).withColumn("page_id", F.concat("page_id", F.col("event_id").cast("string")))
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    with runs.stateful(spark):
        runs.to_the_end(ev.change_stream(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"), buckets=4), f"{tmp_path}/out", f"{tmp_path}/state", "by-bucket")
        assert spark.read.format("statestore").option("stateVarName", "bucket").load(f"{tmp_path}/state").count() <= 4
    assert spark.read.parquet(f"{tmp_path}/out").count() == ev.changes(rows).count()
