"""Registered queries of seeding, text rules, set charts and table writes, with their oracles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.functions import numbers as n
from quillmark.functions import text as x
from quillmark.operators import catalogue as c
from quillmark.operators import matching as m
from quillmark.operators import pages as pg
from quillmark.operators import scheduling as sc
from quillmark.plans import oracle_base as o
from quillmark.plans.tables import _dash
from quillmark.sources import sinks
from quillmark.sources import standins as t

DAY = dt.date(2001, 10, 1)


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as catalogue rows."""
    return t.read(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_brand").alias("console_name"), F.concat("p_name", F.lit(" #"), F.col("p_size").cast("string")).alias("product_name"))


def bulk_seeding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest of types and brands as sets: some without a total, some of a console that has no rows, one skipped."""
    part = t.read(spark, sf_dir, "part")
    sets = part.groupBy(F.col("p_brand").alias("brand"), F.col("p_type").alias("type")).agg(F.min("p_size").alias("low"), F.max("p_size").alias("high"))
    manifest = sets.select(F.when(F.col("low") % 5 == 0, F.concat(F.lit("No "), "brand")).otherwise(F.col("brand")).alias("console_name"), F.concat_ws(" ", "brand", "type").alias("set_name"), F.when(F.col("high") % 3 != 0, F.col("high")).alias("printed_total"), F.when(F.col("high") % 2 != 0, F.col("high") + 7).alias("official_total"))
    return c.bulk_plan(manifest, _rows(spark, sf_dir), skip=["Brand#11 ECONOMY"]).select("console_name", "set_name", "rows", "denominator", "problem")


def collision_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two languages for one id: parts proposed as Japanese meet stored English ones of another set."""
    part = t.read(spark, sf_dir, "part")
    slug = F.col("p_partkey").cast("string").alias("card_slug")
    proposed = part.where("p_partkey % 2 = 0").select(slug, F.when(F.col("p_size") % 4 == 0, "en").otherwise("jp").alias("language"), F.concat("p_brand", F.lit(" JP")).alias("set_name"))
    stored = part.where("p_partkey % 3 = 0").select(slug, F.lit("en").alias("language"), F.col("p_brand").alias("set_name"))
    return c.collision_report(c.classify_collisions(proposed, stored, allowed=("6", "12")))


def set_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets of the gated consoles with their cards, their release year, and how many rows of other consoles were skipped."""
    kept, skipped = c.console_gate(_rows(spark, sf_dir), "Brand#1")
    cards = c.seed_rows(kept, "A set", "en", 102)
    return c.set_metadata(cards, 1999).unionByName(skipped.select(F.lit("skipped").alias("set_name"), F.lit(None).cast("string").alias("language"), F.col("skipped").cast("int").alias("total_cards"), F.lit(None).cast("int").alias("release_year")))


def active_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = t.read(spark, sf_dir, "pages").select("page_id", (F.col("page_id") % 3 != 0).alias("scrape_active"), F.when(F.col("page_id") % 2 == 0, "store_a").otherwise("store_b").alias("source"))
    return c.pages_of(source, "store_b").select("page_id")


def merged_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two extracts of an item's prices side by side; the second counts where both have one."""
    line = t.read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k"), "l_linenumber", "l_orderkey", n.dollars_to_cents(F.col("l_extendedprice") / F.col("l_quantity")).alias("c"))
    of = lambda k: F.max(F.when(F.col("l_linenumber") == k, F.col("c")))
    first = line.where("l_orderkey % 2 = 0").groupBy("k").agg(of(1).alias("raw"), of(2).alias("nine"))
    second = line.where("l_orderkey % 2 = 1").groupBy("k").agg(of(1).alias("raw"), of(3).alias("ten"))
    return c.merged_prices(first, second, "k")


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = t.read(spark, sf_dir, "part")
    size = F.col("p_size")
    words = F.when(size % 5 == 0, " 1st Edition").when(size % 5 == 1, " Unlimited print").otherwise("")
    tags = F.when(size % 4 == 0, " [Holo] [Staff ]").when(size % 4 == 1, " shadowless").when(size % 4 == 2, " [SHADOWLESS]").otherwise("")
    number = F.when(size % 3 == 0, F.concat(F.lit(" #00"), size.cast("string"))).when(size % 3 == 1, F.concat(F.lit(" "), (size + 1).cast("string"), F.lit("/102"))).otherwise("")
    foreign = F.when(size % 7 == 0, " ピカ").otherwise("")
    return part.select("p_partkey", "p_size", "p_retailprice", F.concat("p_name", words, tags, number, foreign).alias("title"))


def sale_text_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Editions, variants, numbers, scripts and stored words of titles."""
    kind = F.when(F.col("p_size") % 2 == 0, "recent_sales_pilot").otherwise("backfill")
    condition = F.element_at(F.array(*map(F.lit, x.STORED_CONDITIONS)), (F.col("p_size") % len(x.STORED_CONDITIONS) + 1).cast("int"))
    offer = F.element_at(F.array(*map(F.lit, [*x.BEST_OFFER, "odd"])), (F.col("p_size") % 4 + 1).cast("int"))
    number = F.when(F.col("p_size") % 6 != 0, F.col("p_size").cast("string"))
    return _titles(spark, sf_dir).select(
        "p_partkey", x.first_edition(F.col("title")).alias("edition"), x.variant_text(F.col("title")).alias("variant"), x.is_wrong_number(F.concat(F.col("p_size").cast("string"), F.lit("")), F.col("title")).alias("wrong_number"), x.has_non_latin(F.col("title")).alias("non_latin"),
        x.import_source(kind).alias("source"), x.lookup(x.STORED_CONDITIONS, condition).alias("stored_condition"), x.lookup(x.BEST_OFFER, offer, "unknown").alias("best_offer"), x.display_number(number, F.when(F.col("p_size") % 9 != 0, F.lit(102))).alias("display"), n.cents_to_dollars(n.dollars_to_cents(F.col("p_retailprice"))).alias("dollars"),
    )


def slug_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every form of slug and address of names with signs."""
    name = F.concat("p_name", F.lit(" & Co's ["), "p_type", F.lit("] Été - #"), F.col("p_size").cast("string"))
    console = F.concat(F.lit("Set, "), "p_brand")
    return t.read(spark, sf_dir, "part").select(
        "p_partkey", x.site_slug(name).alias("site"), x.path_slug(name).alias("path"), x.import_slug(name).alias("imported"), x.image_slug(name).alias("image"), x.import_page_slug(name).alias("import_page"), x.set_slug(console).alias("set"),
        x.article_slug(F.lit("movers"), F.concat("p_name", F.lit(" & more!")), F.lit(DAY)).alias("article"), x.page_url(console, name, "http://h").alias("fetched"), x.stored_page_url(console, name, "http://h").alias("stored"), x.import_page_url(console, name, "http://h").alias("import_url"),
    )


def search_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = t.read(spark, sf_dir, "part")
    tag = F.when(F.col("p_size") % 3 == 0, " [1ST Edition]").when(F.col("p_size") % 3 == 1, " [Reverse Holo]").otherwise("")
    name = F.concat("p_name", tag, F.lit(" #"), F.col("p_size").cast("string"))
    return part.select("p_partkey", m.search_text(name, F.concat(F.lit("Pokemon "), "p_brand")).alias("search"))


def set_chart_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Charts of set pages, a page a brand: medians and values by the order's day, zeros among them."""
    line, part = t.read(spark, sf_dir, "lineitem"), t.read(spark, sf_dir, "part").select("p_partkey", "p_brand")
    rows = line.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand", F.to_date("l_shipdate").alias("day")).agg(F.max(F.when(F.col("l_linenumber") == 1, n.dollars_to_cents(F.col("l_extendedprice")))).alias("a"), F.max(F.when(F.col("l_linenumber") == 2, n.dollars_to_cents(F.col("l_extendedprice")))).alias("b"), F.count("*").alias("k"))
    points = lambda v: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(v).isNotNull(), F.struct("day", F.when(F.col("k") % 5 == 0, 0).otherwise(F.col(v)).alias("c"))))), lambda p: F.concat(F.lit("["), (F.unix_date(p["day"]).cast("bigint") * 86_400_000).cast("string"), F.lit(","), p["c"].cast("string"), F.lit("]"))), ",")
    pages = rows.groupBy("p_brand").agg(points("a").alias("a"), points("b").alias("b")).select(F.col("p_brand").alias("page_id"), F.concat(F.lit('<script>VGPC.chart_data = {"median":['), "a", F.lit('],"value":['), "b", F.lit('],"other":[[0,5]]};</script>')).alias("html"))
    return pg.set_chart(pages)


def replaced_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by day, two days of which a second load replaces."""
    e = t.read(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("as_of"), "value")
    path = sinks.new_folder(spark, "days")
    sinks.replace_day(e, path)
    sinks.replace_day(e.where("as_of between '2024-01-05' and '2024-01-06' and event_id % 2 = 0").withColumn("value", F.col("value") + 1000), path)
    return spark.read.schema(e.schema).parquet(path).groupBy("as_of").agg(F.count("*").alias("n"), F.count_if(F.col("value") >= 1000).alias("replaced"))


def reloaded_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers loaded twice, the second load alone stays, and exported as CSV, read back with its header."""
    customers = t.read(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit('say "hi", '), "c_name").alias("name"))
    path = sinks.new_folder(spark, "load")
    sinks.truncate_and_load(customers, f"{path}/table")
    sinks.truncate_and_load(customers.where("c_custkey % 2 = 1"), f"{path}/table")
    sinks.export_csv(spark.read.schema(customers.schema).parquet(f"{path}/table"), f"{path}/csv")
    return spark.read.option("header", True).schema("c_custkey bigint, name string").csv(f"{path}/csv")


def card_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second of four contiguous slices of the customers."""
    return sc.slices(t.read(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", 4, 1)


#: For each store the texts of its stand-in pages: every phrase of its rules, and one that says nothing.
_SAID = {store: [*(phrase for phrases, *_ in rules for phrase in phrases), "nothing to see"] for store, rules in pg.STORES.items()}


def _store_pages(spark: SparkSession, sf_dir: str, store: str) -> DataFrame:
    """Product pages of a store, a part each: some with structured data, some scarce, some with a cart button, some without heading or price."""
    k, size, cents = F.col("p_partkey"), F.col("p_size"), n.dollars_to_cents(F.col("p_retailprice"))
    pounds = lambda c: F.format_string("%d.%02d", F.floor(c / 100), c % 100)
    said = F.get(F.array(*map(F.lit, _SAID[store])), (k % len(_SAID[store])).cast("int"))
    told = F.get(F.array(*[F.lit(p) for p, _ in pg.STRUCTURED]), (size % len(pg.STRUCTURED)).cast("int"))
    blob = F.concat(F.lit('<script type="application/ld+json">{"name":"J '), "p_name", F.lit('","offers":{"availability":"http://schema.org/'), told, F.lit('","price":"'), pounds(cents + 1), F.lit('"}}</script>'))
    button = F.when(size % 6 == 0, '<button class="single_add_to_cart_button">x</button>').when(size % 6 == 1, '<button class="single_add_to_cart_button disabled">x</button>').otherwise("")
    html = F.concat(
        F.lit("<html>"), F.when(size % 4 == 0, blob).otherwise(""), F.when(size % 9 != 0, F.concat(F.lit("<h1 id='t'><b>"), "p_name", F.lit("</b></h1>"))).otherwise(""), F.when(size % 5 != 0, F.concat(F.lit('<p class="the price">now £'), pounds(cents), F.lit("</p>"))).otherwise(""),
        F.lit("<p>"), F.initcap(said), F.when(size % 7 == 0, "</p><p>Hurry").otherwise(""), F.lit("</p>"), button, F.lit("</html>"),
    )
    return t.read(spark, sf_dir, "part").select(k.alias("page_id"), html.alias("html"))


def store_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State, confidence, price and title of product pages of all four stores."""
    out = None
    for store in pg.STORES:
        rows = pg.availability(_store_pages(spark, sf_dir, store), store).select(F.lit(store).alias("store"), "page_id", "stock_state", F.col("confidence").cast("double").alias("confidence"), F.col("price").cast("double").alias("price"), "title")
        out = rows if out is None else out.unionByName(rows)
    return out


QUERIES = {f.__name__: f for f in (bulk_seeding, collision_report, set_rows, active_pages, merged_quotes, sale_text_rules, slug_forms, search_texts, set_chart_rows, replaced_days, reloaded_table, card_slices, store_availability)}

_NAME = "lower(p_name || ' & Co''s [' || p_type || '] Été - #' || p_size)"
_CONSOLE = "lower('Set, ' || p_brand)"
_TRIMMED = lambda e: f"regexp_replace({e}, '^-+|-+$', '', 'g')"
_KEPT = lambda allow, name=_NAME: _dash(f"trim(regexp_replace({name}, '[^{allow}]', '', 'g'))")
_STORED = "[" + ", ".join(f"'{v}'" for v in x.STORED_CONDITIONS.values()) + "]"



def _by_rule(store: str, said: str) -> tuple[str, float]:
    return next(((name, sure) for phrases, name, sure in pg.STORES[store] if any(p in said for p in phrases)), ("unknown", 0.30))


def _store_sql(store: str) -> str:
    found = [_by_rule(store, said) for said in _SAID[store]]
    at = f"[p_partkey % {len(found)} + 1]"
    rule = f"SELECT *, [{', '.join(f"'{a}'" for a, _ in found)}]{at} AS st, [{', '.join(str(b) for _, b in found)}]{at} AS su FROM part"
    if store == "official":
        rule = f"SELECT * REPLACE (CASE WHEN st = 'in_stock' AND p_size % 7 = 0 THEN 'low_stock' ELSE st END AS st, CASE WHEN st = 'in_stock' AND p_size % 7 = 0 THEN 0.85 ELSE su END AS su) FROM ({rule})"
    if store == "cart_button":
        rule = f"SELECT * REPLACE (CASE p_size % 6 WHEN 0 THEN 'in_stock' WHEN 1 THEN 'sold_out' ELSE st END AS st, CASE p_size % 6 WHEN 0 THEN 0.90 WHEN 1 THEN 0.88 ELSE su END AS su) FROM ({rule})"
    sure = pg.STRUCTURED_CONFIDENCE.get(store)
    told = f"p_size % 4 = 0 AND su <> 0.10 AND {sure is not None}" if store == "official" else f"p_size % 4 = 0 AND {sure is not None}"
    names = "[" + ", ".join(f"'{b}'" for _, b in pg.STRUCTURED) + f"][p_size % {len(pg.STRUCTURED)} + 1]"
    cents = o.cents("p_retailprice")
    return f"""SELECT '{store}' AS store, p_partkey AS page_id, CASE WHEN {told} THEN {names} ELSE st END AS stock_state, CAST(CASE WHEN {told} THEN {sure or 0} ELSE su END AS DOUBLE) AS confidence,
CASE WHEN p_size % 5 <> 0 THEN CAST({cents} AS DOUBLE) / 100 WHEN p_size % 4 = 0 THEN CAST({cents} + 1 AS DOUBLE) / 100 END AS price, CASE WHEN p_size % 9 <> 0 THEN p_name WHEN p_size % 4 = 0 THEN 'J ' || p_name END AS title FROM ({rule})"""


SQL = {
    "store_availability": " UNION ALL ".join(map(_store_sql, pg.STORES)),
    "bulk_seeding": """WITH s AS (SELECT p_brand, p_type, min(p_size) AS low, max(p_size) AS high FROM part GROUP BY 1, 2), m AS (SELECT CASE WHEN low % 5 = 0 THEN 'No ' || p_brand ELSE p_brand END AS console_name, p_brand || ' ' || p_type AS set_name, CASE WHEN high % 3 <> 0 THEN high WHEN high % 2 <> 0 THEN high + 7 END AS denominator FROM s)
SELECT console_name, set_name, n AS rows, denominator, CASE WHEN denominator IS NULL THEN 'no denominator' WHEN n IS NULL THEN 'no rows' END AS problem FROM m LEFT JOIN (SELECT p_brand AS console_name, count(*) AS n FROM part GROUP BY 1) USING (console_name) WHERE set_name <> 'Brand#11 ECONOMY'""",
    "collision_report": """SELECT CAST(p_partkey AS VARCHAR) AS card_slug, 'en' AS stored_language, p_brand AS stored_set, 'jp' AS proposed_language, p_brand || ' JP' AS proposed_set, p_partkey || ': stored as en in ' || p_brand || ', proposed as jp in ' || p_brand || ' JP' AS report FROM part WHERE p_partkey % 6 = 0 AND p_size % 4 <> 0 AND p_partkey NOT IN (6, 12)""",
    "set_rows": """SELECT 'A set' AS set_name, 'en' AS language, CAST(count(*) AS INTEGER) AS total_cards, 1999 AS release_year FROM part WHERE p_brand = 'Brand#1' HAVING count(*) > 0 UNION ALL SELECT 'skipped', NULL, CAST(count(*) AS INTEGER), NULL FROM part WHERE p_brand <> 'Brand#1'""",
    "active_pages": "SELECT page_id FROM pages WHERE page_id % 3 <> 0 AND page_id % 2 <> 0",
    "merged_quotes": f"""WITH l AS (SELECT l_partkey AS k, l_linenumber AS n, l_orderkey % 2 AS side, {o.cents("l_extendedprice / l_quantity")} AS c FROM lineitem),
a AS (SELECT k, max(c) FILTER (n = 1) AS raw, max(c) FILTER (n = 2) AS nine FROM l WHERE side = 0 GROUP BY 1), b AS (SELECT k, max(c) FILTER (n = 1) AS raw, max(c) FILTER (n = 3) AS ten FROM l WHERE side = 1 GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, coalesce(b.raw, a.raw) AS raw, nine, ten FROM a FULL JOIN b ON a.k = b.k""",
    "sale_text_rules": f"""SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'first_edition' WHEN 1 THEN 'unlimited' ELSE 'unknown' END AS edition, CASE p_size % 4 WHEN 0 THEN 'Holo; Staff' WHEN 1 THEN 'Shadowless' WHEN 2 THEN 'SHADOWLESS' END AS variant, p_size % 3 = 1 AS wrong_number, p_size % 7 = 0 AS non_latin,
CASE WHEN p_size % 2 = 0 THEN 'pilot' ELSE 'backfill' END AS source, {_STORED}[p_size % {len(x.STORED_CONDITIONS)} + 1] AS stored_condition, ['none', 'accepted', 'unknown', 'unknown'][p_size % 4 + 1] AS best_offer, CASE WHEN p_size % 6 <> 0 AND p_size % 9 <> 0 THEN p_size || '/102' END AS display, CAST({o.cents("p_retailprice")} AS DOUBLE) / 100 AS dollars FROM part""",
    "slug_forms": f"""SELECT p_partkey, {_TRIMMED(_KEPT("a-z0-9 -"))} AS site, {_TRIMMED(_KEPT("a-z0-9 &''-"))} AS path, {_KEPT("a-z0-9 -", f"replace({_NAME}, '''s', 's')")} AS imported, {_dash(f"trim(regexp_replace(replace({_NAME}, '''s', 's'), '[^a-z0-9_é ]', '', 'g'))")} AS image, {_KEPT("a-z0-9 &")} AS import_page,
replace({_CONSOLE}, ' ', '-') AS set, '2001-10-01-movers-' || regexp_replace(regexp_replace(replace(lower(p_name || ' & more!'), ' ', '-'), '[^a-z0-9-]', '', 'g'), '-+', '-', 'g') AS article,
'http://h/' || replace(replace({_CONSOLE}, ',', ''), ' ', '-') || '/' || {_KEPT("a-z0-9 &''-")} AS fetched, 'http://h/' || replace({_CONSOLE}, ' ', '-') || '/' || {_TRIMMED(_KEPT("a-z0-9 &''-"))} AS stored, 'http://h/' || replace({_CONSOLE}, ' ', '-') || '/' || {_KEPT("a-z0-9 &")} AS import_url FROM part""",
    "search_texts": """SELECT p_partkey, 'Pokemon ' || p_name || CASE WHEN p_size % 3 = 0 THEN ' 1ST Edition' ELSE '' END || ' ' || p_brand || ' ' || p_size AS search FROM part""",
    "set_chart_rows": f"""WITH g AS (SELECT p_brand, CAST(l_shipdate AS DATE) AS date, max({o.cents("l_extendedprice")}) FILTER (l_linenumber = 1) AS a, max({o.cents("l_extendedprice")}) FILTER (l_linenumber = 2) AS b, count(*) AS k FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
SELECT p_brand AS page_id, date, a AS median_usd, b AS value_usd FROM g WHERE k % 5 <> 0 AND coalesce(a, b) > 0""",
    "replaced_days": """SELECT CAST(ts AS DATE) AS as_of, count(*) FILTER (CAST(ts AS DATE) NOT BETWEEN DATE '2024-01-05' AND DATE '2024-01-06' OR event_id % 2 = 0) AS n, count(*) FILTER (CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-06' AND event_id % 2 = 0) AS replaced FROM events GROUP BY 1""",
    "reloaded_table": """SELECT c_custkey, 'say "hi", ' || c_name AS name FROM customer WHERE c_custkey % 2 = 1""",
    "card_slices": "SELECT c_custkey FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS p, count(*) OVER () // 4 + 1 AS size FROM customer) WHERE p >= size AND p < 2 * size",
}
