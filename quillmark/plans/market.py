"""Registered queries over listings, populations and selections, with their oracles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.functions.numbers import dollars_to_cents
from quillmark.functions.text import JUNK
from quillmark.operators import deals as d
from quillmark.operators import matching as m
from quillmark.operators import population as p
from quillmark.operators import retention as rt
from quillmark.operators import selections as s
from quillmark.plans import analytics as a
from quillmark.plans import oracle_base as o
from quillmark.sources import standins as t

DAY = dt.date(2001, 10, 1)
_CARD = ["card_slug", "card_name", "set_name", "current_raw"]


def deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.deals(t.listings(spark, sf_dir), t.fair_values(spark, sf_dir))


def deal_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.funnel(t.listings(spark, sf_dir), t.fair_values(spark, sf_dir))


def deal_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.deal_of_day(deals(spark, sf_dir), DAY).select("listing_id", "card_slug", "discount_pct", "total_usd")


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = t.read(spark, sf_dir, "part")
    tag = F.when(F.col("p_size") % 3 == 0, " [1st Edition]").when(F.col("p_size") % 3 == 1, " [Reverse Holo]").otherwise("")
    return part.select(F.col("p_partkey").cast("string").alias("card_slug"), F.concat("p_name", tag, F.lit(" #"), F.col("p_size").cast("string")).alias("card_name"), F.col("p_brand").alias("set_name"))


#: Line items whose listings a task finds at a time, about.
TASK_LINES = 250_000


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of line items, written from their part: with a grade, an edition or a finish, and its number.

    Lines are dealt by item before they become listings, over at least as many tasks as a shuffle has, so that whatever joins them by item later finds
    them in place; equal lines, which have one item, are found there too.
    """
    slug = F.col("l_partkey").cast("string").alias("card_slug")
    line = t.read(spark, sf_dir, "lineitem").select(slug, "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice")
    line = line.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-line.count() // TASK_LINES)), "card_slug")
    n = F.col("l_linenumber")
    name = F.concat_ws("-", F.col("l_orderkey").cast("string"), n.cast("string"), "card_slug", F.col("l_suppkey").cast("string"), F.col("l_quantity").cast("string"))
    line = line.withColumn("listing_id", name).dropDuplicates(["card_slug", "listing_id"])
    part = t.read(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("card_slug"), "p_name", "p_size").dropDuplicates(["card_slug"])
    words = F.when(n % 4 == 0, " PSA 10").when(n % 4 == 1, " 1st edition").when(n % 4 == 2, " reverse holo").otherwise(" graded")
    title = F.concat("p_name", words, F.lit(" #"), (F.col("p_size") + F.when(n == 7, 1).otherwise(0)).cast("string"))
    line = line.withColumn("cents", dollars_to_cents(F.col("l_extendedprice") / F.col("l_quantity")))
    return line.join(part, "card_slug").select(
        "listing_id", "card_slug", title.alias("title"), F.format_string("%d.%02d", F.expr("cents div 100"), F.expr("cents % 100")).alias("price"), F.lit(None).cast("string").alias("shipping"),
        F.lit("USD").alias("currency"), F.lit("EBAY_US").alias("marketplace"), F.lit("").alias("image"), F.lit("").alias("web_url"),
    )


def listing_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(spark, sf_dir)
    searched = _found(spark, sf_dir).select("listing_id", "title", "card_slug").join(items, "card_slug")
    return m.match_listings(searched, items).select("listing_id", "searched_slug", "card_slug", F.col("points").cast("int").alias("points"), "match_confidence")


def match_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.match_counts(listing_matches(spark, sf_dir))


def listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.process_listings(_found(spark, sf_dir), _items(spark, sf_dir), t.fair_values(spark, sf_dir))


def population_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.set_totals(t.population(spark, sf_dir))


def population_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.snapshot(t.population(spark, sf_dir), DAY)


def population_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.top_of_sets(t.population(spark, sf_dir))


def population_angle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The angles of three days in a row, which are all there are."""
    population = t.supplier_population(spark, sf_dir)
    angles = [s.population_angle(population, DAY + dt.timedelta(days=k)).select("set_name", "card_number", "gem_rate", "total_graded", "angle") for k in range(3)]
    return angles[0].unionByName(angles[1]).unionByName(angles[2])


def data_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.data_facts(t.population(spark, sf_dir)).select("fact", "set_name", "card_number", "psa_10", "total_graded")


def low_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.low_population(t.population(spark, sf_dir)).select("set_name", "card_number", "psa_10")


def movers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.movers(a.weekly_trends(spark, sf_dir), t.weekly_prices(spark, sf_dir)).select(*_CARD, "raw_pct_7d", "side")


def grading_premiums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.grading_premiums(a.weekly_trends(spark, sf_dir), t.weekly_prices(spark, sf_dir)).select(*_CARD, "current_psa10", "multiplier")


def sleepers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.sleepers(a.weekly_trends(spark, sf_dir), t.weekly_prices(spark, sf_dir)).select(*_CARD, "raw_pct_30d", "raw_pct_90d")


def index_pulse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.pulse(a.market_index(spark, sf_dir))


def market_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.market_trend(a.market_index(spark, sf_dir)).select("date", "total_raw_usd", "raw_pct_7d")


def busiest_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.busiest_set(a.weekly_trends(spark, sf_dir))


def collector_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.collector_sets(a.weekly_set_metrics(spark, sf_dir), a.weekly_trends(spark, sf_dir))


def top_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.top_items(a.card_trends(spark, sf_dir), 100).select(*_CARD)


def riser_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.riser_of_day(a.card_trends(spark, sf_dir), DAY).select(*_CARD, "raw_pct_7d")


def history_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.history_pick(a.weekly_trends(spark, sf_dir), t.weekly_prices(spark, sf_dir), 7)


def price_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.row_counts(t.monthly_prices(spark, sf_dir))


def upcoming_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands as sets, released on the first day that one of their parts shipped after the feed's day."""
    line, part = t.read(spark, sf_dir, "lineitem"), t.read(spark, sf_dir, "part").select("p_partkey", "p_brand")
    first = line.where(F.to_date("l_shipdate") >= F.lit(DAY)).join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_brand").alias("set_name")).agg(F.min(F.to_date("l_shipdate")).alias("release_date"))
    return s.releases(first, DAY)


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as completed sales of a part, graded by return flag."""
    line = t.read(spark, sf_dir, "lineitem")
    return line.select(
        F.col("l_partkey").cast("string").alias("provider_card_id"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int")).alias("provider_sale_key"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("sale_date"), (F.col("l_linenumber") * 10).alias("parse_confidence"),
        F.when(F.col("l_returnflag") == "N", "completed-auctions-used").otherwise("completed-auctions-manual-only").alias("observed_section"),
        F.when(F.col("l_returnflag") == "A", "PSA").alias("grading_company"), F.when(F.col("l_returnflag") == "A", "PSA 10").when(F.col("l_returnflag") == "R", "9").alias("grade"),
        F.when(F.col("l_linenumber") == 3, "active").otherwise(F.when(F.col("l_linenumber") < 3, "active").otherwise("new")).alias("review_status"), F.lit("ok").alias("parse_status"), F.col("l_linenumber").alias("n"),
    )


def newest_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.newest_per_grade(_sales(spark, sf_dir)).select("provider_card_id", "provider_sale_key", "sale_date")


def reconciled_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines 1 to 3 are stored, 3 and later are scraped."""
    sales = _sales(spark, sf_dir)
    return rt.reconcile(sales.where("n <= 3").drop("n"), sales.where("n >= 3").drop("n")).select("provider_card_id", "provider_sale_key", "review_status")


def sales_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = _sales(spark, sf_dir).select(F.lit("lineitem").alias("file"), "parse_status", F.coalesce("grading_company", F.lit("none")).alias("marketplace"), "observed_section", F.when(F.col("n") == 7, "late").otherwise("fine").alias("reason"))
    return rt.run_report(sales)


QUERIES = {
    f.__name__: f
    for f in (
        deals, deal_funnel, deal_of_day, listing_matches, match_counts, listing_rows, population_totals, population_snapshot, population_top, population_angle, data_facts, low_population, movers, grading_premiums,
        sleepers, index_pulse, market_trend, busiest_set, collector_sets, top_items, riser_of_day, history_pick, price_row_counts, upcoming_releases, newest_sales, reconciled_sales, sales_report,
    )
}

_LIST = f"""
l AS (SELECT CAST(l_partkey AS VARCHAR) AS card_slug, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS listing_id,
  CASE l_linenumber % 3 WHEN 0 THEN 'PSA 9' WHEN 1 THEN 'Ungraded' ELSE 'PSA 10' END AS condition, CASE WHEN l_linenumber = 7 THEN 'low' WHEN l_linenumber % 2 = 0 THEN 'high' ELSE 'medium' END AS match_confidence,
  CASE WHEN l_linenumber = 6 THEN 'GBP' ELSE 'USD' END AS currency, CASE WHEN l_linenumber = 5 THEN 'Mixed lot of cards' ELSE 'Single card' END AS title, l_suppkey AS seller_feedback_score,
  {o.cents("l_extendedprice * (1 - l_discount) / l_quantity")} AS total_cost_cents FROM lineitem),
v AS (SELECT CAST(p_partkey AS VARCHAR) AS card_slug, p_name AS card_name, p_brand AS set_name, {o.cents("p_retailprice")} AS raw0, p_partkey FROM part),
j AS (SELECT l.*, card_name, set_name, p_partkey % 11 <> 0 AS known, CASE WHEN condition = 'Ungraded' THEN raw0 WHEN condition = 'PSA 10' AND p_partkey % 7 <> 0 THEN raw0 * 3 WHEN p_partkey % 5 <> 0 THEN raw0 * 2 ELSE raw0 END AS fair_value_cents,
  CASE WHEN condition = 'Ungraded' THEN 'Raw' WHEN condition = 'PSA 10' AND p_partkey % 7 <> 0 THEN 'PSA 10' WHEN p_partkey % 5 <> 0 THEN 'PSA 9' ELSE 'Raw (no data for grade)' END AS value_type,
  CASE WHEN currency = 'GBP' THEN CAST(trunc(total_cost_cents / 0.79::DOUBLE) AS BIGINT) ELSE total_cost_cents END AS total_usd FROM l LEFT JOIN v USING (card_slug)),
q AS (SELECT *, CAST(total_usd AS DOUBLE) / fair_value_cents AS ratio FROM j),
r AS (SELECT *, CASE WHEN NOT coalesce(known, false) THEN 'no_trend' WHEN match_confidence = 'low' THEN 'low_confidence' WHEN fair_value_cents < 1000 THEN 'low_value' WHEN seller_feedback_score < 50 THEN 'low_feedback'
  WHEN total_usd <= 0 THEN 'no_cost' WHEN ratio < 0.3::DOUBLE THEN 'wrong_card' WHEN ratio > 0.85::DOUBLE THEN 'not_cheap' ELSE 'deal' END AS reason FROM q),
deals AS (SELECT card_slug, listing_id, condition, match_confidence, currency, title, seller_feedback_score, total_cost_cents, card_name, set_name, fair_value_cents, value_type, total_usd, {o.r("(1 - ratio) * 100", 1)} AS discount_pct FROM r WHERE reason = 'deal')"""

_MATCH = """
items AS (SELECT CAST(p_partkey AS VARCHAR) AS card_slug, p_partkey, p_brand AS set_name, lower(p_name) AS base, split_part(lower(p_name), ' ', 1) AS word, p_size AS number, CASE WHEN p_size % 3 = 0 THEN 1 ELSE 0 END AS first_ed, CASE WHEN p_size % 3 = 1 THEN 1 ELSE 0 END AS rev FROM part),
found AS (SELECT DISTINCT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || l_quantity AS listing_id, l_partkey, l_linenumber AS n FROM lineitem),
pairs AS (SELECT f.listing_id, CAST(f.l_partkey AS VARCHAR) AS searched_slug, c.card_slug, 20 + CASE WHEN c.number = i.number + CASE WHEN n = 7 THEN 1 ELSE 0 END THEN 15 ELSE -20 END
   + CASE WHEN c.first_ed = 1 AND n % 4 = 1 THEN 10 WHEN c.first_ed = 1 OR n % 4 = 1 THEN -50 ELSE 0 END + CASE WHEN c.rev = 1 AND n % 4 = 2 THEN 3 WHEN c.rev = 1 OR n % 4 = 2 THEN -10 ELSE 0 END AS points
  FROM found f JOIN items i ON f.l_partkey = i.p_partkey JOIN items c ON c.set_name = i.set_name AND c.base = i.base),
best AS (SELECT *, CASE WHEN points >= 35 THEN 'high' WHEN points >= 20 THEN 'medium' WHEN points >= 0 THEN 'low' ELSE 'none' END AS match_confidence FROM pairs QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY points DESC, card_slug) = 1)"""

_ROWS = f"""
{_MATCH},
said AS (SELECT DISTINCT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || l_quantity AS listing_id, l_linenumber AS n, p_name || CASE l_linenumber % 4 WHEN 0 THEN ' PSA 10' WHEN 1 THEN ' 1st edition' WHEN 2 THEN ' reverse holo' ELSE ' graded' END || ' #' || (p_size + CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END) AS title,
  CAST(trunc(CAST(({o.cents("l_extendedprice / l_quantity")} // 100) || '.' || lpad(CAST({o.cents("l_extendedprice / l_quantity")} % 100 AS VARCHAR), 2, '0') AS DOUBLE) * 100) AS BIGINT) AS price_cents FROM lineitem JOIN part ON p_partkey = l_partkey),
fv AS (SELECT CAST(p_partkey AS VARCHAR) AS card_slug, {o.cents("p_retailprice")} AS raw, p_partkey % 11 <> 0 AS has_raw, p_partkey % 5 <> 0 AS has_nine, p_partkey % 7 <> 0 AS has_ten FROM part)"""
_LISTING_ROWS = f"""WITH {_ROWS} SELECT b.card_slug, searched_slug, 'EBAY_US' AS marketplace, listing_id AS ebay_item_id, title, price_cents, 'USD' AS currency, CAST(0 AS BIGINT) AS shipping_cents, price_cents AS total_cost_cents,
  CASE n % 4 WHEN 0 THEN 'PSA 10' WHEN 3 THEN 'Graded' ELSE 'Ungraded' END AS condition, '' AS item_image_url, 'https://www.ebay.com/itm/' || listing_id AS item_web_url, match_confidence, points,
  CASE WHEN n % 4 = 0 AND has_ten THEN raw * 3 WHEN n % 4 IN (0, 3) AND has_nine THEN raw * 2 WHEN has_raw THEN raw ELSE 0 END AS fair_value_cents,
  CASE WHEN n % 4 = 0 AND has_ten THEN 'PSA 10' WHEN n % 4 = 0 AND has_nine THEN 'PSA 9' WHEN n % 4 = 3 AND has_nine THEN 'PSA 9 (estimate)' ELSE 'Raw' END AS fair_value_kind
FROM best b JOIN said USING (listing_id) JOIN fv ON fv.card_slug = b.card_slug WHERE match_confidence <> 'none' AND NOT ({" OR ".join(f"contains(lower(title), '{w}')" for w in JUNK)})"""

_POP = """
pop AS (SELECT p_brand AS set_name, CAST(p_partkey AS VARCHAR) AS card_number, p_name AS card_name, count(*) FILTER (l_linenumber = 1) AS psa_10, count(*) FILTER (l_linenumber = 2) AS psa_9, count(*) FILTER (l_linenumber = 3) AS psa_8,
  count(*) FILTER (l_linenumber = 4) AS psa_7, count(*) AS total_graded FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3)"""

_T = a._WITH_MONTHLY  # noqa: SLF001
_W = a.WITH_WEEKLY
_ALLOWED = "set_name IN (" + ", ".join("'" + n.replace("'", "''") + "'" for n in s.ALLOWED_SETS) + ")"
_ENOUGH = f"card_slug IN (SELECT card_slug FROM prices GROUP BY 1 HAVING count(*) >= 30) AND {_ALLOWED}"
_RATED = f"WITH p AS (SELECT [{', '.join(f"'{n}'" for n in t.SETS)}][l_suppkey % {len(t.SETS)} + 1] AS set_name, CAST(l_suppkey AS VARCHAR) AS card_number, count(*) FILTER (l_linenumber = 1) AS tens, count(*) AS total_graded FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier) GROUP BY 1, 2), q AS (SELECT set_name, card_number, {o.r('CAST(tens AS DOUBLE) / total_graded * 100', 2)} AS gem_rate, total_graded FROM p WHERE total_graded >= 100)"
_SALES = """
s AS (SELECT CAST(l_partkey AS VARCHAR) AS provider_card_id, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(l_quantity AS INTEGER) AS provider_sale_key, strftime(l_shipdate, '%Y-%m-%d') AS sale_date, l_linenumber * 10 AS conf,
  CASE l_returnflag WHEN 'N' THEN 'Raw' WHEN 'A' THEN 'PSA 10' ELSE '9' END AS k, l_linenumber AS n, l_returnflag FROM lineitem)"""
_RANK = "row_number() OVER (PARTITION BY provider_card_id, k ORDER BY sale_date DESC, conf DESC, provider_sale_key DESC)"

SQL = {
    "deals": f"WITH {_LIST} SELECT * FROM deals",
    "deal_funnel": f"WITH {_LIST} SELECT reason, count(*) AS n FROM r GROUP BY 1",
    "deal_of_day": f"""WITH {_LIST}, top AS (SELECT * FROM deals WHERE discount_pct >= 15 AND total_usd > 500 ORDER BY discount_pct DESC, listing_id LIMIT 5)
SELECT listing_id, card_slug, discount_pct, total_usd FROM (SELECT *, row_number() OVER (ORDER BY discount_pct DESC, listing_id) - 1 AS p, count(*) OVER () AS c FROM top) WHERE p = 274 % c""",
    "listing_matches": f"WITH {_MATCH} SELECT listing_id, searched_slug, card_slug, CAST(points AS INTEGER) AS points, match_confidence FROM best",
    "match_counts": f"WITH {_MATCH} SELECT match_confidence, count(*) AS n, count(*) FILTER (card_slug <> searched_slug) AS rematched FROM best GROUP BY 1",
    "listing_rows": _LISTING_ROWS,
    "population_totals": f"WITH {_POP}, z AS (SELECT set_name, CAST(sum(total_graded) AS BIGINT) AS total_graded, CAST(sum(psa_10) AS BIGINT) AS total_psa_10, CAST(sum(psa_9) AS BIGINT) AS total_psa_9, CAST(sum(psa_8) AS BIGINT) AS total_psa_8 FROM pop GROUP BY 1) SELECT *, {o.r('CAST(total_psa_10 AS DOUBLE) / total_graded * 100', 2)} AS gem_rate FROM z",
    "population_snapshot": f"WITH {_POP} SELECT set_name, card_number, card_name, psa_8, psa_9, psa_10, total_graded, {o.r('CAST(psa_10 AS DOUBLE) / total_graded * 100', 2)} AS gem_rate, DATE '2001-10-01' AS snapshot_date FROM pop WHERE total_graded > 0",
    "population_top": f"WITH {_POP} SELECT set_name, CAST(rk AS INTEGER) AS rank, card_number, card_name, total_graded, CAST(set_total AS BIGINT) AS set_total FROM (SELECT *, row_number() OVER (PARTITION BY set_name ORDER BY total_graded DESC, card_number) AS rk, sum(total_graded) OVER (PARTITION BY set_name) AS set_total FROM pop) WHERE rk <= 5",
    "population_angle": _RATED + " " + " UNION ALL ".join(f"SELECT *, '{n}' AS angle FROM (FROM q ORDER BY {k}, set_name, card_number LIMIT 5)" for n, k in (("low_gem_rate", "gem_rate"), ("most_graded", "total_graded DESC"), ("high_gem_rate", "gem_rate DESC"))),
    "data_facts": f"""WITH {_POP} SELECT * FROM (SELECT 'most_graded' AS fact, set_name, card_number, psa_10, total_graded FROM pop ORDER BY total_graded DESC, set_name, card_number LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'most_tens', set_name, card_number, psa_10, total_graded FROM pop ORDER BY psa_10 DESC, set_name, card_number LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'fewest_tens', set_name, card_number, psa_10, total_graded FROM pop WHERE psa_10 > 0 ORDER BY psa_10, set_name, card_number LIMIT 1)""",
    "low_population": f"WITH {_POP} SELECT set_name, card_number, psa_10 FROM pop WHERE psa_10 > 0 AND psa_10 < 500 ORDER BY psa_10, set_name, card_number LIMIT 10",
    "movers": f"""{_W}, up AS (SELECT *, 'riser' AS side FROM trends WHERE current_raw > 2000 AND raw_pct_7d > 0 AND raw_pct_7d <= 100 AND raw_pct_30d <= 200 ORDER BY raw_pct_7d DESC, card_slug LIMIT 60),
down AS (SELECT *, 'faller' AS side FROM trends WHERE current_raw > 2000 AND raw_pct_7d < 0 AND raw_pct_7d >= -100 ORDER BY raw_pct_7d, card_slug LIMIT 60)
SELECT card_slug, card_name, set_name, current_raw, raw_pct_7d, side FROM (SELECT * FROM up WHERE coalesce(abs(raw_pct_30d), 0) <= 200 AND {_ENOUGH} ORDER BY raw_pct_7d DESC, card_slug LIMIT 8)
UNION ALL SELECT card_slug, card_name, set_name, current_raw, raw_pct_7d, side FROM (SELECT * FROM down WHERE coalesce(abs(raw_pct_30d), 0) <= 200 AND {_ENOUGH} ORDER BY raw_pct_7d, card_slug LIMIT 6)""",
    "grading_premiums": f"""{_W}, dear AS (SELECT *, {o.r("CAST(current_psa10 AS DOUBLE) / current_raw", 1)} AS multiplier FROM trends WHERE current_psa10 > 0 AND current_raw > 0 ORDER BY current_psa10 DESC, card_slug LIMIT 80)
SELECT card_slug, card_name, set_name, current_raw, current_psa10, multiplier FROM dear WHERE {_ENOUGH} ORDER BY multiplier DESC, card_slug LIMIT 10""",
    "sleepers": f"""{_W}, c AS (SELECT * FROM trends WHERE raw_pct_30d > 5 AND raw_pct_30d <= 200 AND raw_pct_90d > 5 AND raw_pct_90d <= 500 AND current_raw > 2000 AND current_raw < 30000 ORDER BY raw_pct_30d DESC, card_slug LIMIT 80)
SELECT card_slug, card_name, set_name, current_raw, raw_pct_30d, raw_pct_90d FROM c WHERE {_ENOUGH} ORDER BY raw_pct_30d DESC, card_slug LIMIT 10""",
    "history_pick": f"""{_W}, c AS (SELECT * FROM trends WHERE current_raw >= 2000 AND raw_pct_90d IS NOT NULL ORDER BY current_raw DESC, card_slug LIMIT 80),
b AS (SELECT * FROM c WHERE {_ENOUGH} ORDER BY current_raw DESC, card_slug LIMIT 15), one AS (SELECT card_slug, card_name FROM b ORDER BY md5('7|' || card_slug), card_slug LIMIT 1)
SELECT card_slug, date, raw_usd, card_name FROM prices JOIN one USING (card_slug) WHERE raw_usd > 0 ORDER BY date LIMIT 365""",
    "index_pulse": f"""WITH {o.PRICES},{o.index()} SELECT date, CASE WHEN total_raw_usd > 1000000 THEN CAST(total_raw_usd AS DOUBLE) / 100 ELSE CAST(total_raw_usd AS DOUBLE) END AS total_raw,
CASE WHEN median_raw_usd > 10000 THEN CAST(median_raw_usd AS DOUBLE) / 100 ELSE CAST(median_raw_usd AS DOUBLE) END AS median_raw, raw_pct_7d, raw_pct_30d FROM idx_pct ORDER BY date DESC LIMIT 35""",
    "market_trend": f"WITH {o.PRICES},{o.index()} SELECT date, total_raw_usd, raw_pct_7d FROM idx_pct WHERE raw_pct_7d IS NOT NULL AND date = (SELECT max(date) FROM idx_pct)",
    "busiest_set": f"""{_W} SELECT set_name, count(*) AS cards, {o.r("avg(abs(raw_pct_7d))", 1)} AS activity, count(*) FILTER (raw_pct_7d > 0) AS risers, count(*) FILTER (raw_pct_7d < 0) AS fallers,
arg_max(card_name, (raw_pct_7d, card_name)) AS top_riser, arg_min(card_name, (raw_pct_7d, card_name)) AS top_faller
FROM trends WHERE raw_pct_7d IS NOT NULL AND current_raw > 0 GROUP BY 1 HAVING count(*) >= 8 ORDER BY activity DESC, set_name LIMIT 1""",
    "collector_sets": f"""{_W},{o.sets()}, b AS (SELECT set_name, set_total_value FROM sets ORDER BY set_total_value DESC, set_name LIMIT 8)
SELECT set_name, set_total_value, max(current_raw) AS top_price, arg_max(card_name, (current_raw, card_name)) AS top_card, count(*) FILTER (current_raw >= 2000) AS from_20 FROM trends JOIN b USING (set_name) WHERE current_raw > 0 GROUP BY 1, 2""",
    "top_items": f"{_T} SELECT card_slug, card_name, set_name, current_raw FROM trends WHERE current_raw > 0 ORDER BY current_raw DESC, card_slug LIMIT 100",
    "riser_of_day": f"""{_T}, top AS (SELECT * FROM trends WHERE raw_pct_7d >= 5 AND raw_pct_7d <= 150 ORDER BY raw_pct_7d DESC, card_slug LIMIT 3)
SELECT card_slug, card_name, set_name, current_raw, raw_pct_7d FROM (SELECT *, row_number() OVER (ORDER BY raw_pct_7d DESC, card_slug) - 1 AS p, count(*) OVER () AS c FROM top) WHERE p = 274 % c""",
    "price_row_counts": f"WITH {o.MONTHLY} SELECT card_slug, count(*) AS n FROM prices GROUP BY 1",
    "upcoming_releases": """SELECT set_name, release_date, CAST(date_diff('day', DATE '2001-10-01', release_date) AS INTEGER) AS days_away FROM (SELECT p_brand AS set_name, CAST(min(l_shipdate) AS DATE) AS release_date FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE CAST(l_shipdate AS DATE) >= DATE '2001-10-01' GROUP BY 1) WHERE date_diff('day', DATE '2001-10-01', release_date) BETWEEN 0 AND 60 ORDER BY 3, set_name LIMIT 3""",
    "newest_sales": f"WITH {_SALES} SELECT provider_card_id, provider_sale_key, sale_date FROM s QUALIFY {_RANK} <= 5",
    "reconciled_sales": f"""WITH {_SALES}, cap AS (SELECT * FROM s WHERE n >= 3 QUALIFY {_RANK} <= 5), cards AS (SELECT DISTINCT provider_card_id FROM s WHERE n >= 3),
uni AS (SELECT * FROM s WHERE n <= 3 AND provider_card_id IN (SELECT provider_card_id FROM cards) AND provider_sale_key NOT IN (SELECT provider_sale_key FROM cap) UNION ALL SELECT * FROM cap),
keep AS (SELECT provider_sale_key, provider_card_id FROM uni QUALIFY {_RANK} <= 5), added AS (SELECT cap.* FROM cap WHERE provider_sale_key IN (SELECT provider_sale_key FROM keep))
SELECT provider_card_id, provider_sale_key, 'active' AS review_status FROM added UNION ALL
SELECT provider_card_id, provider_sale_key, CASE WHEN provider_card_id IN (SELECT provider_card_id FROM keep) AND provider_sale_key NOT IN (SELECT provider_sale_key FROM keep) THEN 'superseded' ELSE 'active' END
FROM s WHERE n <= 3 AND provider_sale_key NOT IN (SELECT provider_sale_key FROM added)""",
    "sales_report": f"""WITH {_SALES}, z AS (SELECT 'lineitem' AS file, 'ok' AS parse_status, CASE l_returnflag WHEN 'A' THEN 'PSA' ELSE 'none' END AS marketplace, CASE l_returnflag WHEN 'N' THEN 'completed-auctions-used' ELSE 'completed-auctions-manual-only' END AS observed_section, CASE WHEN n = 7 THEN 'late' ELSE 'fine' END AS reason FROM s)
SELECT file, parse_status, marketplace, observed_section, reason, count(*) AS n, CAST(grouping(file, parse_status, marketplace, observed_section, reason) AS BIGINT) AS level FROM z
GROUP BY GROUPING SETS ((), (file), (parse_status), (marketplace), (observed_section), (reason), (file, parse_status))""",
}
