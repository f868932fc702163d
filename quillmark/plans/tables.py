"""Registered queries over the catalogue, pages, texts, events and sinks, with their oracles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.functions import numbers as n
from quillmark.functions import text as x
from quillmark.operators import catalogue as c
from quillmark.operators import pages as pg
from quillmark.operators import scheduling as sc
from quillmark.operators import species as sp
from quillmark.plans import oracle_base as o
from quillmark.sources import sinks
from quillmark.sources import standins as t
from quillmark.streaming import events as ev

TODAY = dt.datetime(2024, 1, 30)
CHANGE = ("page_id", "event_id", "event_type", "old_value", "new_value", "significance", "alert")


def state_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.changes(t.observations(spark, sf_dir)).select(*CHANGE)


def deduplicated_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (page, type, value, hour) of the changes."""
    return ev.deduplicated(ev.changes(t.observations(spark, sf_dir)).where("event_type = 'stock_change'")).select("page_id", "event_type", "new_value", F.date_trunc("hour", "observed_at").cast("timestamp_ntz").alias("hour"))


def attempt_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sc.streaks(t.attempts(spark, sf_dir), t.stored_streaks(spark, sf_dir), order=("attempted_at", "event_id")).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("last_attempted_at", "last_successful_fetch_at")})


def hourly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = t.observations(spark, sf_dir).withColumn("event_type", F.col("stock_state"))
    return ev.hourly_counts(e).withColumn("hour", F.col("hour").cast("timestamp_ntz"))


def cohort_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sc.cohort_counts(_cohorts(spark, sf_dir))


def _cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = t.read(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("card_slug")).distinct()
    prices = t.daily_prices(spark, sf_dir).groupBy(x.bare_slug(F.col("card_slug")).alias("card_slug")).agg((F.max_by("raw_usd", F.when(F.col("raw_usd").isNotNull(), F.col("date"))) % 500).alias("current_raw"))
    return sc.cohorts(users, prices, attempt_streaks(spark, sf_dir))


def cohort_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sc.due(_cohorts(spark, sf_dir), "weekly").select("card_slug", "cohort")


def set_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands as sets, types as languages, balanced over three batches."""
    counts = t.read(spark, sf_dir, "part").groupBy(F.col("p_type").alias("language"), F.col("p_brand").alias("name")).agg(F.count("*").alias("n"))
    return sc.pack_batches(counts, 3)


def rotation_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = t.read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("provider_card_id"))
    return sc.rotation_slice(ids, 700, 300)


def species_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and word pairs of part names as species."""
    part = t.read(spark, sf_dir, "part")
    words = part.select(F.explode(F.split(F.lower("p_name"), " ")).alias("name")).union(part.select(F.replace(F.lower("p_name"), F.lit(" "), F.lit("-")).alias("name"))).distinct()
    prices = part.select(F.col("p_partkey").cast("string").alias("card_slug"), n.dollars_to_cents(F.col("p_retailprice")).alias("raw_usd"))
    return sp.species_stats(t.cards(spark, sf_dir), words, prices)


def catalogue_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t.read(spark, sf_dir, "part")
    name = F.concat(F.col("p_name"), F.lit(" & Co's ["), F.col("p_type"), F.lit("] #"), F.col("p_size").cast("string"))
    return p.select("p_partkey", x.site_slug(name).alias("site"), x.path_slug(name).alias("path"), x.import_slug(name).alias("imported"), x.trailing_number(name).alias("number"), x.display_number(x.trailing_number(name), F.lit("50")).alias("display"))


def catalogue_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of brand order: those with sales in 1998 against those with sales in 2000."""
    line = t.read(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("card_slug"), F.year("l_shipdate").alias("y"), F.col("l_linenumber").alias("k"))
    return c.diff(line.where("y = 1998 and k = 1"), line.where("y = 2000 and k = 2"))


def keyword_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword rules over whole texts."""
    d = t.read(spark, sf_dir, "documents")
    return d.select("doc_id", x.contains_any(F.col("text"), x.JUNK).alias("junk"), x.contains_any(F.col("text"), x.SALE_LOT).alias("lot"), x.is_foreign(F.col("text")).alias("foreign_variant"), x.sha_key(F.col("lang"), F.col("source"), F.lit(None), F.col("n_chars")).alias("key"))


def page_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t.read(spark, sf_dir, "pages")
    return p.select("page_id", pg.layout_signature(F.col("html"), F.col("url")).alias("signature"))


def page_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = t.read(spark, sf_dir, "pages")
    return p.select("page_id", x.clean_url(F.col("url")).alias("clean"), x.host_of(F.col("url")).alias("host"), x.language_of_url(F.col("url")).alias("language"))


def page_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.availability(t.read(spark, sf_dir, "pages"), "basket").select("page_id", "stock_state", "confidence")


def number_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scalar rules over line items, summed by flag."""
    line = t.read(spark, sf_dir, "lineitem")
    cents = n.dollars_to_cents(F.col("l_extendedprice"))
    return line.groupBy("l_returnflag").agg(
        F.sum(n.usd_cents(cents, F.when(F.col("l_linenumber") % 2 == 0, "GBP").otherwise("USD"))).alias("usd"), F.sum(n.gbp_cents(cents)).alias("gbp"), F.sum(n.listing_cents(F.format_string("%.2f", F.col("l_extendedprice")))).alias("listing"),
        F.sum(F.when(n.volume_confidence(F.col("l_quantity")) == "high", 1).otherwise(0)).alias("high"), F.count_if(n.volume_label(F.col("l_quantity")) == "1 sale per day").alias("daily"),
    )


def upserted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers with even keys replace stored ones of early dates; the result is the new table by status."""
    orders = t.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    old = orders.where("o_orderdate < date '1998-01-01'").withColumn("v", F.lit(1))
    new = orders.where("o_orderdate >= date '1997-01-01'").withColumn("v", F.lit(2))
    return sinks.upserted(old, new, ["o_orderkey"]).groupBy("o_orderstatus", "v").agg(F.count("*").alias("n"))


def inserted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = t.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    old = orders.where("o_orderdate < date '1998-01-01'").withColumn("v", F.lit(1))
    new = orders.where("o_orderdate >= date '1997-01-01'").withColumn("v", F.lit(2))
    return sinks.inserted(old, new, ["o_orderkey"]).groupBy("o_orderstatus", "v").agg(F.count("*").alias("n"))


def unexpired_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = t.read(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("scraped_at"))
    return sinks.unexpired(e, TODAY).select("event_id")


def filled_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing raw prices take the nines, by the rule for missing pictures."""
    p = t.daily_prices(spark, sf_dir).withColumn("k", F.concat_ws("|", "card_slug", F.col("date").cast("string")))
    new = p.select("k", F.col("psa9_usd").alias("raw_usd"))
    return sinks.filled(p.select("k", "raw_usd", "psa9_usd"), new, "k", ["raw_usd"], "raw_usd").agg(F.count("raw_usd").alias("n"), F.sum("raw_usd").alias("total"))


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = lambda name: t.read(spark, sf_dir, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
    return one("part").unionByName(one("lineitem"))


def fetched_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day of price history; only its columns and day are read."""
    e = t.read(spark, sf_dir, "events").where(F.to_date("ts") == F.lit(TODAY.date()))
    return e.select("event_id", "user_id", "value")


def set_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily series side by side, days of either kept: the median and total of one event type each."""
    e = t.read(spark, sf_dir, "events").select(F.to_date("ts").alias("date"), "event_type", n.dollars_to_cents(F.col("value")).alias("cents"))
    a = e.where("event_type = 'view'").groupBy("date").agg(F.floor(F.median("cents")).cast("bigint").alias("median_usd"))
    b = e.where("event_type = 'signup'").groupBy("date").agg(F.sum("cents").alias("value_usd"))
    return a.join(b, "date", "full_outer")


def set_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.cards(spark, sf_dir).select("set_name").distinct().orderBy("set_name")


def allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as allowed ids and order keys as the catalogue: which are in it, and which not."""
    ids = t.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    known = t.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    return ids.join(known, "k", "left_semi").withColumn("side", F.lit("known")).unionByName(ids.join(known, "k", "left_anti").withColumn("side", F.lit("missing")))


def collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts proposed in a language by size against the one stored by key."""
    p = t.read(spark, sf_dir, "part")
    lang = lambda k: F.when(F.col(k) % 2 == 0, "en").otherwise("jp")
    new = p.select(F.col("p_partkey").cast("string").alias("card_slug"), F.col("p_brand").alias("set_name"), lang("p_size").alias("language"))
    old = p.where("p_partkey % 3 <> 0").select(F.col("p_partkey").cast("string").alias("card_slug"), F.col("p_brand").alias("set_name"), lang("p_partkey").alias("language"))
    return c.classify_collisions(new, old, ["7", "11"]).groupBy("verdict").agg(F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        state_changes, deduplicated_changes, attempt_streaks, hourly_events, cohort_counts, cohort_cards, set_batches, rotation_slice, species_counts, catalogue_slugs, catalogue_diff, keyword_texts, page_layouts,
        page_addresses, page_availability, number_rules, upserted_orders, inserted_orders, unexpired_events, filled_prices, table_counts, fetched_prices, set_series, set_names, allow_list, collisions,
    )
}

_SIG = "CASE {0} WHEN 'in_stock' THEN 10 ELSE 0 END"
_STATE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in t.STATES.items()) + " ELSE 'unknown' END"
_SIGN = "CASE {0} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in ev.SIGNIFICANCE.items()) + " ELSE 0 END"
_ALERT = "(old, st) IN (" + ", ".join(f"('{a}', '{b}')" for a, b in ev.ALERTS) + ")"
_CHANGES = f"""
good AS (SELECT *, {_STATE} AS st FROM events WHERE event_id % 13 <> 0),
w AS (SELECT *, coalesce(lag(st) OVER u, 'unknown') AS old, last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM good WINDOW u AS (PARTITION BY user_id ORDER BY ts, event_id)),
ch AS (SELECT CAST(user_id AS VARCHAR) AS page_id, event_id, ts, CASE WHEN old <> st THEN 'stock_change' ELSE 'price_change' END AS kind, CASE WHEN old <> st THEN old ELSE CAST(before AS VARCHAR) END AS old_value, CASE WHEN old <> st THEN st ELSE CAST(value AS VARCHAR) END AS new_value,
       CAST(CASE WHEN old <> st THEN greatest({_SIGN.format("old")}, {_SIGN.format("st")}) ELSE 7 END AS BIGINT) AS significance, CASE WHEN old = st OR {_ALERT} THEN 'true' ELSE 'false' END AS alert
       FROM w WHERE old <> st OR (before <> 0 AND value <> 0 AND value < before * 0.95::DOUBLE))"""
_STREAKS = """
att AS (SELECT CAST(user_id AS VARCHAR) AS card_slug, ts, event_id, CASE event_type WHEN 'purchase' THEN 'priced' WHEN 'view' THEN 'page_reached_no_price' WHEN 'click' THEN 'transient_http_failure' WHEN 'error' THEN 'timeout' ELSE 'not_found' END AS category,
        CASE event_type WHEN 'purchase' THEN 200 WHEN 'view' THEN 200 WHEN 'click' THEN 503 WHEN 'signup' THEN 404 END AS status FROM events),
lp AS (SELECT *, max(CASE WHEN category = 'priced' THEN (ts, event_id) END) OVER (PARTITION BY card_slug) AS lp FROM att),
ag AS (SELECT card_slug, count(*) FILTER (category = 'page_reached_no_price' AND (lp IS NULL OR (ts, event_id) > lp)) AS n, bool_or(lp IS NOT NULL) AS priced, arg_max(category, (ts, event_id)) AS last_result_category, arg_max(status, (ts, event_id)) FILTER (status IS NOT NULL) AS status,
       max(ts) AS last_attempted_at, max(ts) FILTER (category IN ('priced', 'page_reached_no_price')) AS reached FROM lp GROUP BY 1),
pri AS (SELECT CAST(c_custkey AS VARCHAR) AS card_slug, c_custkey % 5 AS n0, CASE WHEN c_custkey % 2 = 0 THEN TIMESTAMP '2023-12-01' + to_minutes(c_custkey) END AS reached0 FROM customer WHERE c_custkey % 3 = 0),
st AS (SELECT ag.card_slug, CAST(n + CASE WHEN priced THEN 0 ELSE coalesce(n0, 0) END AS BIGINT) AS no_price_streak, last_result_category, CAST(coalesce(status, CASE WHEN n0 IS NOT NULL THEN 200 END) AS BIGINT) AS last_http_status, last_attempted_at, coalesce(reached, reached0) AS last_successful_fetch_at FROM ag LEFT JOIN pri USING (card_slug))"""
_COHORTS = f"""{_STREAKS}, pr AS (SELECT card_slug, arg_max(raw_usd, date) FILTER (raw_usd IS NOT NULL) % 500 AS price FROM prices GROUP BY 1),
co AS (SELECT st.card_slug, CASE WHEN price >= 200 THEN 'DAILY_VALUE' WHEN price > 0 THEN 'WEEKLY_LOW' WHEN last_result_category IN ('transient_http_failure', 'timeout') THEN 'DAILY_DISCOVERY' WHEN no_price_streak >= 3 THEN 'WEEKLY_UNPRICED' ELSE 'DAILY_DISCOVERY' END AS cohort FROM st LEFT JOIN pr USING (card_slug))"""


def _any(text: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


def _dash(expr: str) -> str:
    return f"regexp_replace(regexp_replace({expr}, '\\s+', '-', 'g'), '-+', '-', 'g')"


_NAME = "lower(p_name || ' & Co''s [' || p_type || '] #' || p_size)"
_TEXT = r"""lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<script\b.*?</script\s*>', ' ', 'g'), '(?is)<style\b.*?</style\s*>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')))"""

SQL = {
    "state_changes": f"WITH {_CHANGES} SELECT page_id, event_id, kind AS event_type, old_value, new_value, significance, alert FROM ch",
    "deduplicated_changes": f"WITH {_CHANGES} SELECT DISTINCT page_id, kind AS event_type, new_value, date_trunc('hour', ts) AS hour FROM ch WHERE kind = 'stock_change'",
    "attempt_streaks": f"WITH {_STREAKS} SELECT * FROM st",
    "hourly_events": f"SELECT date_trunc('hour', ts) AS hour, {_STATE} AS event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "cohort_counts": f"WITH {o.PRICES},{_COHORTS} SELECT c AS cohort, count(co.cohort) AS n FROM (VALUES ('DAILY_VALUE'), ('WEEKLY_LOW'), ('DAILY_DISCOVERY'), ('WEEKLY_UNPRICED')) x(c) LEFT JOIN co ON co.cohort = c GROUP BY 1",
    "cohort_cards": f"WITH {o.PRICES},{_COHORTS} SELECT card_slug, cohort FROM co WHERE cohort IN ('WEEKLY_LOW', 'WEEKLY_UNPRICED')",
    "set_batches": """WITH RECURSIVE r AS (SELECT p_type AS language, p_brand AS name, count(*) AS n, row_number() OVER (PARTITION BY p_type ORDER BY count(*) DESC, p_brand) AS k FROM part GROUP BY 1, 2),
f AS (SELECT language, name, n, k, 0 AS batch, [n, 0, 0] AS loads FROM r WHERE k = 1
UNION ALL SELECT r.language, r.name, r.n, r.k, CAST(list_position(loads, list_min(loads)) - 1 AS INTEGER), list_transform(loads, lambda x, i: x + CASE WHEN i = list_position(loads, list_min(loads)) THEN r.n ELSE 0 END) FROM f JOIN r ON r.language = f.language AND r.k = f.k + 1)
SELECT language, name, n, CAST(batch AS INTEGER) AS batch FROM f""",
    "rotation_slice": """SELECT CAST(c_custkey AS VARCHAR) AS provider_card_id, p AS position, p - s + 1 AS number FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS p, 700 % count(*) OVER () AS s FROM customer) WHERE p >= s AND p < s + 300""",
    "species_counts": f"""WITH {o.CARDS}, nm AS (SELECT DISTINCT unnest(string_split(lower(p_name), ' ')) AS name FROM part UNION SELECT replace(lower(p_name), ' ', '-') FROM part),
m AS (SELECT DISTINCT name, card_slug FROM nm JOIN cards ON regexp_matches(' ' || lower(card_name) || ' ', '[^a-z]' || replace(name, '-', '[- ]') || '[^a-z]'))
SELECT name, count(*) AS card_count, max({o.cents("p_retailprice")}) AS max_raw_usd FROM m JOIN part ON CAST(p_partkey AS VARCHAR) = card_slug GROUP BY 1""",
    "catalogue_slugs": f"""SELECT p_partkey, {_dash(f"regexp_replace({_NAME}, '[^a-z0-9 -]', '', 'g')")} AS site, {_dash(f"regexp_replace({_NAME}, '[^a-z0-9 &''-]', '', 'g')")} AS path,
{_dash(f"regexp_replace(replace({_NAME}, '''s', 's'), '[^a-z0-9 -]', '', 'g')")} AS imported, CAST(p_size AS VARCHAR) AS number, p_size || '/50' AS display FROM part""",
    "catalogue_diff": """WITH a AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE year(l_shipdate) = 1998 AND l_linenumber = 1), b AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE year(l_shipdate) = 2000 AND l_linenumber = 2)
SELECT CAST(coalesce(a.k, b.k) AS VARCHAR) AS card_slug, CASE WHEN a.k IS NULL THEN 'only_stored' WHEN b.k IS NULL THEN 'new' ELSE 'overlap' END AS side FROM a FULL JOIN b ON a.k = b.k""",
    "keyword_texts": f"""SELECT doc_id, {_any("lower(text)", x.JUNK)} AS junk, {_any("lower(text)", x.SALE_LOT)} AS lot, regexp_matches(text, '(?i)\\b({"|".join(x.FOREIGN_LANGUAGES)})\\b') AS foreign_variant, sha256(lang || '|' || source || '||' || n_chars) AS key FROM documents""",
    "page_layouts": """WITH m AS (SELECT page_id, regexp_extract_all(html, '(?is)<a\\b[^>]*\\sclass=["'']([^"'']*)["'']', 1) AS links FROM pages)
SELECT page_id, sha256('lang=unknown|anchor=0|full_prices=0|section_classes=|anchor_classes=' || array_to_string(list_sort(list_distinct(list_filter(flatten(list_transform(links, lambda c: string_split(c, ' '))), lambda n: n LIKE 'js-%-completed-sale'))), ',') || '|row_cell_classes=') AS signature FROM m""",
    "page_addresses": """SELECT page_id, lower(regexp_extract(url, '^(https?://[^/?#]*)', 1)) || regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) AS clean, lower(regexp_extract(url, '^https?://([^/?#:]*)', 1)) AS host, 'unknown' AS language FROM pages""",
    "page_availability": f"""WITH p AS (SELECT page_id, {_TEXT} AS t FROM pages) SELECT page_id, CASE WHEN contains(t, 'add to basket') OR contains(t, 'add to cart') OR contains(t, 'buy now') THEN 'in_stock' WHEN contains(t, 'out of stock') OR contains(t, 'sold out') THEN 'sold_out' WHEN contains(t, 'pre-order') THEN 'preorder_open'
WHEN contains(t, 'notify') THEN 'notify_me' ELSE 'unknown' END AS stock_state, CAST(CASE WHEN contains(t, 'add to basket') OR contains(t, 'add to cart') OR contains(t, 'buy now') THEN 0.85 WHEN contains(t, 'out of stock') OR contains(t, 'sold out') THEN 0.85 WHEN contains(t, 'pre-order') THEN 0.82 WHEN contains(t, 'notify') THEN 0.75 ELSE 0.3 END AS DOUBLE) AS confidence FROM p""",
    "number_rules": f"""SELECT l_returnflag, CAST(sum(CASE WHEN l_linenumber % 2 = 0 THEN CAST(trunc({o.cents("l_extendedprice")} / 0.79::DOUBLE) AS BIGINT) ELSE {o.cents("l_extendedprice")} END) AS BIGINT) AS usd, CAST(sum(CAST(trunc({o.cents("l_extendedprice")} / 1.27::DOUBLE) AS BIGINT)) AS BIGINT) AS gbp,
CAST(sum(CAST(trunc(CAST(printf('%.2f', l_extendedprice) AS DOUBLE) * 100::DOUBLE) AS BIGINT)) AS BIGINT) AS listing, count(*) FILTER (l_quantity >= 8) AS high, count(*) FILTER (l_quantity >= 30 AND l_quantity < 60) AS daily FROM lineitem GROUP BY 1""",
    "upserted_orders": "SELECT o_orderstatus, CASE WHEN o_orderdate >= DATE '1997-01-01' THEN 2 ELSE 1 END AS v, count(*) AS n FROM orders GROUP BY 1, 2",
    "inserted_orders": "SELECT o_orderstatus, CASE WHEN o_orderdate < DATE '1998-01-01' THEN 1 ELSE 2 END AS v, count(*) AS n FROM orders GROUP BY 1, 2",
    "unexpired_events": "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-29'",
    "filled_prices": f"WITH {o.PRICES} SELECT count(coalesce(raw_usd, psa9_usd)) AS n, CAST(sum(coalesce(raw_usd, psa9_usd)) AS BIGINT) AS total FROM prices",
    "table_counts": "SELECT 'part' AS name, count(*) AS n FROM part UNION ALL SELECT 'lineitem', count(*) FROM lineitem",
    "fetched_prices": "SELECT event_id, user_id, value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-30'",
    "set_series": f"""WITH a AS (SELECT CAST(ts AS DATE) AS date, CAST(floor(median({o.cents("value")})) AS BIGINT) AS median_usd FROM events WHERE event_type = 'view' GROUP BY 1), b AS (SELECT CAST(ts AS DATE) AS date, CAST(sum({o.cents("value")}) AS BIGINT) AS value_usd FROM events WHERE event_type = 'signup' GROUP BY 1)
SELECT coalesce(a.date, b.date) AS date, median_usd, value_usd FROM a FULL JOIN b ON a.date = b.date""",
    "set_names": "SELECT DISTINCT p_brand AS set_name FROM part",
    "allow_list": "SELECT c_custkey AS k, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 'known' ELSE 'missing' END AS side FROM customer",
    "collisions": "SELECT CASE WHEN p_partkey % 3 = 0 OR p_size % 2 = p_partkey % 2 THEN 'safe' WHEN p_partkey IN (7, 11) THEN 'allowed' ELSE 'blocked' END AS verdict, count(*) AS n FROM part GROUP BY 1",
}
