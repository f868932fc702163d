"""Registered queries that run stateful streams to their end over slices of ``events``; the oracles say what a batch would."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.plans import tables
from quillmark.sources import standins as t
from quillmark.streaming import events as ev
from quillmark.streaming.runs import in_slices


def state_change_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes of every page, its state carried from one run to the next."""
    return in_slices(t.observations(spark, sf_dir), "observed_at", ev.change_stream, "changes").select(*tables.CHANGE)


def attempt_streak_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last state of every card, started from the stored rows."""
    stored = t.stored_streaks(spark, sf_dir)
    # Initial state belongs to a query's first batch; later runs find it in the checkpoint.
    states = in_slices(t.attempts(spark, sf_dir), "attempted_at", lambda rows: ev.streak_stream(rows, stored), "streaks")
    names = ev.STREAKS.names[1:]
    last = states.groupBy("card_slug").agg(F.max_by(F.struct(*names), "last_attempted_at").alias("s")).select("card_slug", "s.*")
    return last.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("last_attempted_at", "last_successful_fetch_at")})


def live_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings that are left when the stream has seen all: timers let the others expire a day after their newest row."""
    happened = in_slices(t.scraped_listings(spark, sf_dir), "scraped_at", lambda rows: ev.listing_stream(rows, buckets=ev.BUCKETS), "listings")
    return ev.live_listings(happened).withColumn("scraped_at", F.col("scraped_at").cast("timestamp_ntz"))


def stream_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row a run of the change stream with what the run itself observed."""
    with ev.run_metrics(spark) as rows:
        in_slices(t.observations(spark, sf_dir), "observed_at", lambda s: ev.observed(ev.change_stream(s)), "observed")
    return spark.createDataFrame([(r["batch_id"], r["rows"], r["alerts"]) for r in rows], "batch_id bigint, rows bigint, alerts bigint")


QUERIES = {f.__name__: f for f in (state_change_stream, attempt_streak_stream, live_listings, stream_runs)}

SQL = {
    "state_change_stream": tables.SQL["state_changes"],
    "attempt_streak_stream": tables.SQL["attempt_streaks"],
    "live_listings": """SELECT CAST(user_id AS VARCHAR) AS card_slug, CASE WHEN event_type = 'error' THEN 'uk' ELSE 'us' END AS marketplace, user_id || '-' || event_type AS ebay_item_id, arg_max(value, (ts, value)) AS price, max(ts) AS scraped_at
FROM events GROUP BY user_id, event_type HAVING max(ts) >= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""",
    "stream_runs": f"""WITH b AS (SELECT epoch_us(min(ts)) AS low, epoch_us(max(ts)) AS high FROM events), {tables._CHANGES.strip()}
SELECT CAST(CASE WHEN epoch_us(ts) >= low + (high - low) * 2 // 3 THEN 2 WHEN epoch_us(ts) >= low + (high - low) // 3 THEN 1 ELSE 0 END AS BIGINT) AS batch_id, count(*) AS rows, count(*) FILTER (alert = 'true') AS alerts FROM ch, b GROUP BY 1""",
}
