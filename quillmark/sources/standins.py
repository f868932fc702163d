"""The analytics' input tables as views over the star-schema tables, in cents.

They let every job run on tables of any scale: ``events`` stand for daily prices of the last month, ``lineitem`` for
monthly prices of several years and for marketplace listings, ``part`` for the catalogue. Each view reads only the
columns it needs, so filters and columns reach the scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.functions.numbers import dollars_to_cents
from quillmark.operators.scheduling import attempt_category

#: Which event type or return flag stands for which grade column.
DAILY_GRADES = {"view": "raw_usd", "click": "psa9_usd", "purchase": "psa10_usd", "signup": "psa8_usd", "error": "psa7_usd"}
MONTHLY_GRADES = {"N": "raw_usd", "A": "psa9_usd", "R": "psa10_usd"}
#: The last month of the monthly prices has few items; the one before is complete.
MONTHLY_AS_OF = dt.date(2001, 10, 1)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pivoted(rows: DataFrame, kinds: dict[str, str], kind: str) -> DataFrame:
    grades = [F.max(F.when(F.col(kind) == k, F.col("cents"))).alias(g) for k, g in kinds.items()]
    return rows.groupBy("card_slug", "date").agg(*grades)


def daily_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """card_slug (with the ``pc-`` prefix), date, one column a grade; 30 days."""
    e = read(spark, sf_dir, "events").select(F.concat(F.lit("pc-"), F.col("user_id").cast("string")).alias("card_slug"), F.to_date("ts").alias("date"), "event_type", dollars_to_cents(F.col("value")).alias("cents"))
    return _pivoted(e, DAILY_GRADES, "event_type")


def monthly_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """card_slug, date (first of the month), raw, psa9 and psa10; 83 months."""
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    rows = read(spark, sf_dir, "lineitem").select(F.concat(F.lit("pc-"), F.col("l_partkey").cast("string")).alias("card_slug"), F.trunc("l_shipdate", "month").alias("date"), "l_returnflag", dollars_to_cents(unit).alias("cents"))
    return _pivoted(rows, MONTHLY_GRADES, "l_returnflag")


#: Names of the sets of ``supplier_cards``; five are on the articles' list.
SETS = ("Base Set", "Neo Genesis", "Evolving Skies", "Paldea Evolved", "Obsidian Flames", "EX Legends", "XY Origins", "Sun & Moon", "Sword & Shield", "Promos")
#: A Monday with prices of most items.
WEEKLY_AS_OF = dt.date(2001, 8, 6)


def weekly_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as items with long histories: card_slug, date (Mondays), a tenth of the dearest unit price of all, twice of the A and three times of the R lines."""
    line = read(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_returnflag", dollars_to_cents(F.col("l_extendedprice") / F.col("l_quantity")).alias("c"))
    cents = F.expr("c div 10")
    of = lambda flag, n: F.max(F.when(F.col("l_returnflag") == flag, cents * n))
    rows = line.groupBy(F.concat(F.lit("pc-"), F.col("l_suppkey").cast("string")).alias("card_slug"), F.to_date(F.date_trunc("week", "l_shipdate")).alias("date"))
    return rows.agg(F.max(cents).alias("raw_usd"), of("A", 2).alias("psa9_usd"), of("R", 3).alias("psa10_usd"))


def supplier_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue of the suppliers, in ten sets; every nineteenth is a sealed product."""
    s = read(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(k.cast("string").alias("card_slug"), F.concat("s_name", F.when(k % 19 == 0, " Booster Box").otherwise(F.lit(""))).alias("card_name"), F.get(F.array(*[F.lit(n) for n in SETS]), (k % len(SETS)).cast("int")).alias("set_name"))


def supplier_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graded counts of suppliers by line number, of which there are hundreds."""
    line = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("card_slug"), "l_linenumber")
    counts = line.groupBy("card_slug").agg(*[F.count(F.when(F.col("l_linenumber") == k, 1)).alias(name) for k, name in ((1, "psa_10"), (2, "psa_9"), (3, "psa_8"), (4, "psa_7"))], F.count("*").alias("total_graded"))
    return counts.join(supplier_cards(spark, sf_dir), "card_slug").select("set_name", F.col("card_slug").alias("card_number"), "card_name", "psa_7", "psa_8", "psa_9", "psa_10", "total_graded")


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").cast("string").alias("card_slug"), F.concat("p_name", F.lit(" #"), F.col("p_size").cast("string")).alias("card_name"), F.col("p_brand").alias("set_name"))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers of items: cost from the discounted unit price, condition by line number, feedback by supplier."""
    line = read(spark, sf_dir, "lineitem")
    cost = F.col("l_extendedprice") * (1 - F.col("l_discount")) / F.col("l_quantity")
    n = F.col("l_linenumber")
    return line.select(
        F.col("l_partkey").cast("string").alias("card_slug"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), n.cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("listing_id"),
        F.when(n % 3 == 0, "PSA 9").when(n % 3 == 1, "Ungraded").otherwise("PSA 10").alias("condition"),
        F.when(n == 7, "low").when(n % 2 == 0, "high").otherwise("medium").alias("match_confidence"),
        F.when(n == 6, "GBP").otherwise("USD").alias("currency"),
        F.when(n == 5, F.lit("Mixed lot of cards")).otherwise(F.lit("Single card")).alias("title"),
        F.col("l_suppkey").alias("seller_feedback_score"),
        dollars_to_cents(cost).alias("total_cost_cents"),
    )


def fair_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current prices of items by their retail price."""
    p = read(spark, sf_dir, "part")
    raw = dollars_to_cents(F.col("p_retailprice"))
    return p.select(
        F.col("p_partkey").cast("string").alias("card_slug"), F.col("p_name").alias("card_name"), F.col("p_brand").alias("set_name"),
        F.when(F.col("p_partkey") % 11 != 0, raw).alias("current_raw"), F.when(F.col("p_partkey") % 5 != 0, raw * 2).alias("current_psa9"), F.when(F.col("p_partkey") % 7 != 0, raw * 3).alias("current_psa10"),
    )


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graded counts of items: line items by line number as grades 1 to 10."""
    line, part = read(spark, sf_dir, "lineitem").select("l_partkey", "l_linenumber"), read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    counts = line.groupBy("l_partkey").agg(*[F.count(F.when(F.col("l_linenumber") == k, 1)).alias(name) for k, name in ((1, "psa_10"), (2, "psa_9"), (3, "psa_8"), (4, "psa_7"))], F.count("*").alias("total_graded"))
    joined = counts.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(F.col("p_brand").alias("set_name"), F.col("p_partkey").cast("string").alias("card_number"), F.col("p_name").alias("card_name"), "psa_7", "psa_8", "psa_9", "psa_10", "total_graded")


#: Which event type stands for which state of a page.
STATES = {"view": "in_stock", "click": "sold_out", "purchase": "unavailable", "signup": "preorder_open", "error": "low_stock"}


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page observations: users as pages, event types as states; every thirteenth failed."""
    e = read(spark, sf_dir, "events")
    state = F.lit("unknown")
    for kind, name in STATES.items():
        state = F.when(F.col("event_type") == kind, name).otherwise(state)
    failed = F.when(F.col("event_id") % 13 == 0, "timeout")
    return e.select(F.col("user_id").cast("string").alias("page_id"), F.col("event_id"), state.alias("stock_state"), F.col("value").alias("price"), F.col("ts").cast("timestamp").alias("observed_at"), failed.alias("error"))


#: Which event type stands for which result of a fetch, whether a price was there, and the status of the answer.
FETCHES = {"purchase": ("ok", True, 200), "view": ("ok", False, 200), "click": ("transient_http_failure", False, 503), "error": ("timeout", False, None), "signup": ("not_found", False, 404)}


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch attempts by event type, with the category that result and price make."""
    e = read(spark, sf_dir, "events")
    fetch, priced, status = F.lit(None).cast("string"), F.lit(False), F.lit(None).cast("bigint")
    for kind, (result, found, code) in FETCHES.items():
        own = F.col("event_type") == kind
        fetch, priced, status = F.when(own, result).otherwise(fetch), F.when(own, found).otherwise(priced), F.when(own, F.lit(code).cast("bigint")).otherwise(status)
    return e.select(F.col("user_id").cast("string").alias("card_slug"), "event_id", attempt_category(fetch, priced).alias("category"), status.alias("http_status"), F.col("ts").cast("timestamp").alias("attempted_at"))


def stored_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state before the attempts: every third customer has a stored row."""
    c = read(spark, sf_dir, "customer").where("c_custkey % 3 = 0")
    k = F.col("c_custkey")
    reached = F.timestamp_seconds(F.lit(1_701_388_800) + k * 60)
    return c.select(k.cast("string").alias("card_slug"), (k % 5).cast("bigint").alias("no_price_streak"), F.lit("page_reached_no_price").alias("last_result_category"), F.lit(200).cast("bigint").alias("last_http_status"), reached.alias("last_attempted_at"), F.when(k % 2 == 0, reached).alias("last_successful_fetch_at"))


def scraped_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings by user and event type, scraped at the event's time."""
    e = read(spark, sf_dir, "events")
    return e.select(F.col("user_id").cast("string").alias("card_slug"), F.when(F.col("event_type") == "error", "uk").otherwise("us").alias("marketplace"), F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("ebay_item_id"), F.col("value").alias("price"), F.col("ts").cast("timestamp").alias("scraped_at"))
