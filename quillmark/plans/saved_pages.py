"""Registered queries over saved pages, which stand-ins write from parts and line items, with oracles that never see a page."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.functions.numbers import dollars_to_cents
from quillmark.operators import catalogue as c
from quillmark.operators import pages as pg
from quillmark.operators import population as po
from quillmark.plans import oracle_base as o
from quillmark.sources import readers, sinks
from quillmark.sources import standins as t

DAY = dt.date(2001, 10, 1)


def _money(cents: Column) -> Column:
    rest = cents % 100
    return F.coalesce(F.concat(F.lit("$"), F.format_number(F.floor(cents / 100), 0), F.lit("."), F.when((rest >= 0) & (rest < 10), "0").otherwise(""), rest.cast("string")), F.lit("$null.null"))


#: Pages that a task takes at a time, about.
TASK_PAGES = 5_000


def price_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per part: cells of current prices, the full table, tabs of volumes and pictures.

    Parts are few bytes and their pages much work, so parts are dealt over as many tasks as their pages fill.
    """
    part = t.read(spark, sf_dir, "part").select("p_partkey", "p_size", dollars_to_cents(F.col("p_retailprice")).alias("c"))
    part = part.repartition(max(1, -(-part.count() // TASK_PAGES)), "p_partkey")
    k, cents = F.col("p_size"), F.col("c")
    cell = lambda name, price: F.concat(F.lit(f'<td id="{name}" x><a></a><span class="price js-price"> '), price, F.lit("</span></td>"))
    row = lambda label, price: F.concat(F.lit(f'<tr><td>{label}</td><td class="price js-price">'), price, F.lit("</td></tr>"))
    period = F.when(F.col("p_partkey") % 4 == 0, "day").when(F.col("p_partkey") % 4 == 1, "week").when(F.col("p_partkey") % 4 == 2, "month").otherwise("year")
    html = F.concat(
        cell("used_price", _money(cents)), F.when(k % 3 == 0, "").otherwise(cell("graded_price", _money(2 * cents))), cell("manual_only_price", F.when(k % 5 == 0, "$0.00").otherwise(_money(3 * cents))),
        F.lit('<div id="full-prices"><table>'), row("Ungraded", _money(cents + 1)), row("Grade   9", _money(2 * cents + 1)), row("BGS 10 Black", F.when(k % 4 == 0, "-").otherwise(_money(5 * cents))), row("Odd", F.lit("$1.00")), row("Ungraded", F.when(k % 2 == 0, _money(cents + 2)).otherwise("N/A")), F.lit("</table></div>"),
        F.lit('<td data-show-tab="completed-auctions-used"><span>volume:&nbsp;</span> <a href="#">'), k.cast("string"), F.lit(" sales per "), period, F.lit('</a></td><td data-show-tab="completed-auctions-graded"><span>volume:&nbsp;</span> <a href="#">'), F.when(k % 2 == 0, "rare").otherwise("3 sales per week"), F.lit("</a></td>"),
        F.lit('<div id="product_image"><img src="//site.example/logo.png"></div><img alt="x" src="https://img.example/'), F.col("p_partkey").cast("string"), F.when(k % 2 == 0, '.jpg" id="photo">').otherwise('.jpg">'),
    )
    return part.select(F.col("p_partkey").cast("bigint").alias("page_id"), F.concat(F.lit("https://site.example/game/pokemon-set/"), F.col("p_partkey").cast("string")).alias("url"), html.alias("html"))


#: Line items that a task takes at a time, about.
TASK_LINES = 250_000


def chart_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per part with a chart of its line items: a series per return flag, a point per item; the seventh lines have no price.

    Lines are dealt by part over as many tasks as they fill, so a task holds as much of a large table as of a small one. All that is grouped by page later
    stays in these tasks.
    """
    line = t.read(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
    line = line.repartition(max(1, -(-line.count() // TASK_LINES)), "l_partkey")
    cents = F.when(F.col("l_linenumber") == 7, 0).otherwise(dollars_to_cents(F.col("l_extendedprice") / F.col("l_quantity")))
    name = F.when(F.col("l_returnflag") == "N", "used").when(F.col("l_returnflag") == "A", "graded").otherwise("manualonly")
    points = line.groupBy("l_partkey", name.alias("series")).agg(F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber", F.unix_date(F.to_date("l_shipdate")).alias("day"), cents.alias("c")))).alias("p"))
    text = F.concat(F.lit('"'), F.col("series"), F.lit('":['), F.array_join(F.transform("p", lambda x: F.format_string("[%d,%d]", x["day"].cast("bigint") * 86_400_000, x["c"])), ","), F.lit("]"))
    charts = points.groupBy(F.col("l_partkey").cast("bigint").alias("page_id")).agg(F.array_join(F.array_sort(F.collect_list(text)), ",").alias("body"))
    return charts.select("page_id", F.concat(F.lit("<script>VGPC.chart_data = {"), "body", F.lit("};</script>")).alias("html"))


#: Line items whose sales a task writes and reads at a time, about.
TASK_SALES = 50_000


def sale_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per part with a table of completed sales, a row per line item; some rows can't be used and some stand twice.

    Parts of a size divisible by ten have pages in a layout that isn't read, those of size seven pages without sales. Lines are dealt by part over as many
    tasks as they fill, before they become rows of a page, so no page is shuffled.
    """
    text = lambda v: v.cast("string")

    def row(r: Column) -> Column:
        n, key = r["l_linenumber"], r["l_orderkey"]
        ebay, item = n % 2 == 1, text(key * 10 + n)
        section = F.element_at(F.array(*map(F.lit, ("used", "graded", "manual-only", "grade-seventeen", "odd-section", "used", "new"))), n)
        price = F.floor(r["l_extendedprice"] * 100 / r["l_quantity"]).cast("bigint")
        money = F.when(key % 13 == 0, "").when(
            key % 7 == 0, F.concat(F.lit('<span class="js-price" title="best offer accepted price">'), _money(price), F.lit('</span><span class="js-price listed-price-inline">'), _money(price + 100), F.lit("</span>"))
        ).otherwise(F.concat(F.lit('<span class="js-price">'), _money(price), F.lit("</span>")))
        html = F.concat(
            F.lit('<div class="completed-auctions-'), section, F.lit('"><table class="hoverable-rows sortable"><tbody><tr id="'), F.when(ebay, F.concat(F.lit("ebay-"), item)).otherwise("x"),
            F.lit('"><td class="date">'), F.when(key % 17 == 0, "Jan 4").otherwise(F.date_format(r["l_shipdate"], "yyyy-MM-dd")), F.lit('</td><td class="title"><a '),
            F.when(ebay, F.concat(F.lit('class="js-ebay-completed-sale" href="https://www.ebay.co.uk/itm/'), item)).otherwise(F.concat(F.lit('href="https://www.tcgplayer.com/p/'), item)), F.lit('?x=1">'),
            F.when(key % 11 == 0, "Lot of cards ").otherwise("Near Mint card "), item, F.lit("</a> ["), F.when(ebay, "eBay").otherwise("TCGPlayer"), F.lit(']</td><td class="numeric">'), money, F.lit("</td></tr></tbody></table></div>"),
        )
        return F.repeat(html, F.when(key % 19 == 0, 2).otherwise(1))

    line = t.read(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_shipdate")
    # Of fewer parts than a shuffle has, a join would shuffle the pages again.
    line = line.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-line.count() // TASK_SALES)), "l_partkey")
    line = line.groupBy("l_partkey", "l_orderkey", "l_linenumber").agg(*[F.min(c).alias(c) for c in ("l_extendedprice", "l_quantity", "l_shipdate")])
    # Lines are collected, not their rows, which are ten times as long.
    sales = line.groupBy(F.col("l_partkey").cast("bigint").alias("page_id")).agg(F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_shipdate"))).alias("sales"))
    tables = sales.select("page_id", F.array_join(F.transform("sales", row), "").alias("body"))
    part = t.read(spark, sf_dir, "part").select(F.col("p_partkey").cast("bigint").alias("page_id"), "p_size").hint("merge")
    path = F.when(F.col("p_size") % 10 == 0, "jp-pokemon-set/").otherwise("pokemon-set/")
    body = F.when(F.col("p_size") == 7, "<p>no sales</p>").otherwise(F.coalesce("body", F.lit("")))
    return part.join(tables, "page_id", "left").select("page_id", F.concat(F.lit("https://site.example/game/"), path, F.col("page_id").cast("string")).alias("url"), F.concat(F.lit("<html><h1>x</h1>"), body, F.lit("</html>")).alias("html"), F.col("page_id").cast("string").alias("provider_card_id"))


#: Items that a saved page of a report lists at most.
REPORT_ITEMS = 500


def report_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A population report per brand, a row per part: saved pages of about ``REPORT_ITEMS`` parts each, whatever the size of the brand, and one more with the row of totals."""
    part = t.read(spark, sf_dir, "part")
    count = lambda k: F.when(F.col("p_partkey") % (k + 2) == 0, "–").otherwise(F.format_number(F.col("p_partkey") * (k + 3) % 4000, 0))
    cells = lambda values: F.concat(*[F.concat(F.lit("<td><div>"), v, F.lit("</div><div>x</div></td>")) for v in values])
    variant = F.when(F.col("p_size") % 5 == 0, "German").when(F.col("p_size") % 5 == 1, "Holo Shop with Affiliates").otherwise("")
    row = F.concat(F.lit("<tr><td></td><td>"), F.col("p_partkey").cast("string"), F.lit("</td><td><strong>"), F.col("p_name"), F.lit("</strong><br>"), variant, F.lit("</td><td></td>"), cells([*[count(k) for k in range(12)], F.format_number(F.col("p_partkey") * 14 % 4000 + 1000, 0)]), F.lit("</tr>"))
    # A brand's parts are dealt over pages by their number, so no page and no group grows with the table.
    n = max(1, -(-part.count() // REPORT_ITEMS))
    brand = F.regexp_extract("p_brand", "([0-9]+)", 1)
    page = lambda block, body: (F.xxhash64("p_brand", block).alias("page_id"), F.concat(F.lit("<title>2001 Pokemon "), "p_brand", F.lit(" TCG Cards | PSA</title><table><tbody>"), body, F.lit("</tbody></table>")).alias("html"), brand.alias("heading"))
    block = F.pmod(F.xxhash64("p_partkey"), F.greatest(F.lit(1), F.lit(n) / F.lit(25)).cast("bigint"))
    items = part.groupBy("p_brand", block.alias("block")).agg(F.array_join(F.array_sort(F.collect_list(F.struct("p_partkey", row.alias("html"))))["html"], "").alias("body"))
    total = F.concat(F.lit("<tr><td></td><td></td><td>TOTAL POPULATION</td><td></td>"), cells([F.format_number(F.col("n") * (k + 1), 0) for k in range(13)]), F.lit("</tr>"))
    totals = part.groupBy("p_brand").agg(F.count("*").alias("n"))
    return items.select(*page(F.col("block"), F.col("body"))).unionByName(totals.select(*page(F.lit("totals"), total)))


def page_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.current_prices(price_pages(spark, sf_dir)).select("page_id", "raw_usd", "psa9_usd", "psa10_usd", "psa7_usd")


def page_full_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.full_prices(price_pages(spark, sf_dir)).select("page_id", "raw_usd", "psa9_usd", "bgs10black_usd", "grade1_usd")


def page_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.sales_volume(price_pages(spark, sf_dir)).select("page_id", "grade", "sales_30d", "volume_label", "confidence")


def page_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_pages(spark, sf_dir).select("page_id", pg.image_url(F.col("html"), hosts=("img.example",)).alias("image"))


def page_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.price_history(chart_pages(spark, sf_dir)).select("page_id", "date", "raw_usd", "psa9_usd", "psa10_usd")


def page_daily_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = price_pages(spark, sf_dir)
    return pg.daily_rows(pg.current_prices(p), pg.full_prices(p), pg.price_history(chart_pages(spark, sf_dir)), DAY).select("page_id", "date", "raw_usd", "psa9_usd", "psa10_usd", "bgs10black_usd")


def page_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.recent_sales(sale_pages(spark, sf_dir)).select(
        "page_id", "listing_title", "sale_date", "observed_section", "grade", "marketplace_source", "marketplace_country", "marketplace_item_id", "listing_url", "sale_price_cents", "original_price_cents",
        "best_offer_status", "condition_bucket", "parse_status", "parse_confidence", "rejection_reason", "provider_sale_key",
    )


def page_sales_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = sale_pages(spark, sf_dir)
    return pg.page_report(pages, pg.recent_sales(pages)).select("page_id", "status", "rows", "ok", "quarantined", "rejected")


def page_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sale_pages(spark, sf_dir).select("page_id", pg.layout_signature(F.col("html"), F.col("url")).alias("signature"))


def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item rows of population reports; their sets by title."""
    pages = report_pages(spark, sf_dir)
    sets = po.set_identity(pages, spark.createDataFrame([], "heading_id string, name string, year string"))
    rows = po.population_rows(po.report_cells(pages), sets, DAY)
    return rows.select("set_name", "release_year", "card_number", "card_name", "variant", "full_name", "auth", "psa_9", "psa_10", "total_graded", F.col("gem_rate").cast("double").alias("gem_rate"), "scraped_date")


def report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports' own totals; their sets by the heading's id."""
    pages = report_pages(spark, sf_dir)
    heads = pages.withColumn("html", F.concat(F.lit('{"headingID": '), "heading", F.lit("}"), "html"))
    known = t.read(spark, sf_dir, "part").select(F.regexp_extract("p_brand", "([0-9]+)", 1).alias("heading_id"), F.concat(F.lit("Known "), "p_brand").alias("name"), F.lit(None).cast("string").alias("year")).distinct()
    found = po.reported_totals(po.report_cells(pages), po.set_identity(heads, known), DAY)
    return found.select("set_name", "release_year", "total_graded", "total_psa_10", "total_psa_9", "total_psa_8")


def _catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as a catalogue file and read back."""
    path = sinks.new_folder(spark, "catalogue")
    _catalogue_rows(t.read(spark, sf_dir, "part")).write.option("header", True).option("escape", '"').csv(path)
    return readers.catalogue(spark, path)


def _catalogue_rows(part: DataFrame) -> DataFrame:
    name = F.concat("p_name", F.when(F.col("p_size") % 3 == 0, ' booster "box"').otherwise(F.concat(F.lit(", the one #"), F.col("p_size").cast("string"), F.when(F.col("p_size") % 4 == 0, "a").otherwise(""))))
    return part.select(F.when(F.col("p_partkey") % 10 != 0, F.col("p_partkey").cast("string")).alias("id"), F.col("p_brand").alias("console-name"), name.alias("product-name"), F.lit("").alias("loose-price"))


def seeded_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.seed_rows(_catalogue(spark, sf_dir), "A set", "en", 102).select("card_slug", "card_name", "card_number", "card_number_display", "is_sealed", "language")


def imported_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.import_rows(_catalogue(spark, sf_dir), "A set", 102).select("card_slug", "card_number", "card_number_display", "is_sealed")


#: Catalogue files: their names and which parts they list.
FILES = {"english-a.csv": "p_partkey % 2 = 0", "english-b.csv": "p_partkey % 3 = 0 and p_size > 40", "Japan-c.csv": "p_partkey % 5 = 0"}


def catalogue_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consoles by language over several files, with the files that list them; a console in more than one is a duplicate."""
    folder = sinks.new_folder(spark, "catalogues")
    for file, rule in FILES.items():
        _catalogue_rows(t.read(spark, sf_dir, "part").where(rule)).write.option("header", True).option("escape", '"').csv(f"{folder}/{file}")
    wanted = t.read(spark, sf_dir, "part").where("p_size > 45").select(F.col("p_brand").alias("console_name")).distinct()
    counted = readers.console_counts(readers.catalogue(spark, f"{folder}/*", sets=wanted))
    return counted.select("language", "console_name", "n", "files", F.array_join("file_names", ",").alias("file_names"), "duplicate")


def text_report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as text reports, a set a folder, read back as records."""
    part = t.read(spark, sf_dir, "part")
    value = lambda k: (F.col("p_size") * (k + 1) * 37 + F.col("p_partkey") % 11).cast("bigint")
    grades = [F.when((F.col("p_size") + k) % 9 == 0, "-").otherwise(F.format_number(value(k), 0)) for k in range(13)]
    values = F.concat_ws("\n", *[v for g in grades for v in (g, F.lit("0"), F.lit("3"))])
    block = F.concat_ws("\n", F.concat(F.col("p_partkey").cast("string"), F.lit("\t"), F.col("p_name"), F.when(F.col("p_size") % 2 == 0, "Shop with Affiliates").otherwise("")), F.when(F.col("p_size") % 3 == 0, F.col("p_type")), F.lit("Grade"), F.lit("+"), F.lit("Q"), F.when(F.col("p_size") % 10 == 0, F.substring_index(values, "\n", 30)).otherwise(values))
    folder = sinks.new_folder(spark, "reports")
    part.select(F.col("p_brand").alias("set_name"), block.alias("text")).write.partitionBy("set_name").text(folder)
    return po.report_items(readers.text_reports(spark, folder)).select("set_name", "card_number", "card_name", "variant", "full_name", "auth", "psa_1_5", "psa_10", "total_graded", "gem_rate")


def sales_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse and store the sales of all pages; the audit row comes from the job that writes them."""
    start = dt.datetime(2024, 1, 30, 3)
    row = sinks.write_run(sale_pages(spark, sf_dir), pg.recent_sales, sinks.new_folder(spark, "sales"), started=start, ended=start + dt.timedelta(seconds=90), notes={"pages": "none", "kind": "nightly"})
    return row.select("status", "pages_processed", "rows_ok", "rows_quarantined", "rows_rejected", "duration_ms", F.get_json_object("notes", "$.pages").alias("noted_pages"), F.get_json_object("notes", "$.kind").alias("kind"))


QUERIES = {
    f.__name__: f
    for f in (page_prices, page_full_prices, page_volumes, page_images, page_history, page_daily_rows, page_sales, page_sales_report, page_signatures, report_rows, report_totals, seeded_cards, imported_cards, catalogue_counts, text_report_rows, sales_run)
}

_PART = f"p AS (SELECT CAST(p_partkey AS BIGINT) AS page_id, p_size AS k, {o.cents('p_retailprice')} AS c FROM part)"
_NOW = "now AS (SELECT page_id, c AS raw_usd, CASE WHEN k % 3 <> 0 THEN 2 * c END AS psa9_usd, CASE WHEN k % 5 <> 0 THEN 3 * c END AS psa10_usd FROM p)"
_FULL = "full_ AS (SELECT page_id, CASE WHEN k % 2 = 0 THEN c + 2 ELSE c + 1 END AS raw_usd, 2 * c + 1 AS psa9_usd, CASE WHEN k % 4 <> 0 THEN 5 * c END AS bgs10black_usd FROM p)"
_PRICE = f"CASE WHEN l_linenumber = 7 THEN 0 ELSE {o.cents('l_extendedprice / l_quantity')} END"
_LAST = lambda flag: f"arg_max(c, (l_orderkey, l_linenumber)) FILTER (l_returnflag = '{flag}' AND c > 0)"
_HISTORY = f"h AS (SELECT CAST(l_partkey AS BIGINT) AS page_id, CAST(l_shipdate AS DATE) AS date, {_LAST('N')} AS raw_usd, {_LAST('A')} AS psa9_usd, {_LAST('R')} AS psa10_usd FROM (SELECT *, {_PRICE} AS c FROM lineitem) GROUP BY 1, 2)"
_SALES = """
l AS (SELECT CAST(l_partkey AS BIGINT) AS page_id, l_orderkey AS o, l_linenumber AS n, l_orderkey * 10 + l_linenumber AS item, CAST(floor(l_extendedprice * 100 / l_quantity) AS BIGINT) AS c, strftime(l_shipdate, '%Y-%m-%d') AS d, p_size FROM (SELECT l_partkey, l_orderkey, l_linenumber, min(l_extendedprice) AS l_extendedprice, min(l_quantity) AS l_quantity, min(l_shipdate) AS l_shipdate FROM lineitem GROUP BY 1, 2, 3) JOIN part ON l_partkey = p_partkey WHERE p_size % 10 <> 0 AND p_size <> 7),
s AS (SELECT *, n % 2 = 1 AS ebay, ['used', 'graded', 'manual-only', 'grade-seventeen', 'odd-section', 'used', 'new'][n] AS section, CASE WHEN o % 11 = 0 THEN 'Lot of cards ' ELSE 'Near Mint card ' END || item AS title,
  CASE WHEN o % 17 = 0 THEN 'malformed_date' WHEN o % 13 = 0 THEN 'missing_final_price' WHEN c <= 0 THEN 'invalid_final_price' END AS bad, o % 7 = 0 AND o % 13 <> 0 AS accepted FROM l),
q AS (SELECT *, CASE WHEN bad IS NOT NULL THEN 'rejected' WHEN o % 11 = 0 OR n = 5 THEN 'quarantined' ELSE 'ok' END AS parse_status, CASE WHEN ebay THEN 'ebay' ELSE 'tcgplayer' END AS market FROM s)"""

SQL = {
    "page_prices": f"WITH {_PART}, {_NOW} SELECT *, CAST(NULL AS BIGINT) AS psa7_usd FROM now",
    "page_full_prices": f"WITH {_PART}, {_FULL} SELECT *, CAST(NULL AS BIGINT) AS grade1_usd FROM full_",
    "page_volumes": f"""WITH {_PART}, v AS (SELECT page_id, 'Ungraded' AS grade, greatest(1, CAST(floor(k * CASE page_id % 4 WHEN 0 THEN 30::DOUBLE WHEN 1 THEN 4.33::DOUBLE WHEN 2 THEN 1::DOUBLE ELSE 1::DOUBLE / 12 END + 0.5) AS BIGINT)) AS sales_30d FROM p UNION ALL SELECT page_id, 'PSA 9', 13 FROM p WHERE k % 2 = 1)
SELECT *, CASE WHEN sales_30d >= 60 THEN '2 sales per day' WHEN sales_30d >= 30 THEN '1 sale per day' WHEN sales_30d >= 17 THEN '4 sales per week' WHEN sales_30d >= 12 THEN '3 sales per week' WHEN sales_30d >= 8 THEN '2 sales per week' WHEN sales_30d >= 4 THEN '1 sale per week' WHEN sales_30d >= 3 THEN '3 sales per month' WHEN sales_30d >= 2 THEN '2 sales per month' ELSE '1 sale per month' END AS volume_label,
CASE WHEN sales_30d >= 8 THEN 'high' WHEN sales_30d >= 3 THEN 'medium' ELSE 'low' END AS confidence FROM v""",
    "page_images": "SELECT CAST(p_partkey AS BIGINT) AS page_id, 'https://img.example/' || p_partkey || '.jpg' AS image FROM part",
    "page_history": f"WITH {_HISTORY} SELECT * FROM h",
    "page_daily_rows": f"""WITH {_PART}, {_NOW}, {_FULL}, {_HISTORY} SELECT page_id, DATE '2001-10-01' AS date, coalesce(f.raw_usd, n.raw_usd) AS raw_usd, coalesce(f.psa9_usd, n.psa9_usd) AS psa9_usd, psa10_usd, bgs10black_usd FROM now n JOIN full_ f USING (page_id)
UNION ALL SELECT page_id, date, raw_usd, psa9_usd, psa10_usd, NULL FROM h WHERE date <> DATE '2001-10-01' AND coalesce(raw_usd, psa9_usd, psa10_usd) IS NOT NULL""",
    "page_sales": f"""WITH {_SALES} SELECT page_id, title AS listing_title, CASE WHEN o % 17 <> 0 THEN d END AS sale_date, 'completed-auctions-' || section AS observed_section,
CASE section WHEN 'used' THEN 'Ungraded' WHEN 'graded' THEN 'Grade 9' WHEN 'manual-only' THEN 'PSA 10' WHEN 'grade-seventeen' THEN 'CGC 10' WHEN 'new' THEN 'Grade 8' END AS grade, market AS marketplace_source,
CASE WHEN ebay THEN 'GB' END AS marketplace_country, CASE WHEN ebay THEN CAST(item AS VARCHAR) END AS marketplace_item_id, CASE WHEN ebay THEN 'https://www.ebay.co.uk/itm/' ELSE 'https://www.tcgplayer.com/p/' END || item AS listing_url,
CASE WHEN bad IS NULL THEN c END AS sale_price_cents, CASE WHEN accepted THEN c + 100 END AS original_price_cents, CASE WHEN bad IS NOT NULL THEN 'unknown' WHEN accepted THEN 'accepted' ELSE 'not_best_offer' END AS best_offer_status,
CASE WHEN section = 'used' THEN CASE WHEN o % 11 = 0 THEN 'raw_unknown' ELSE 'near_mint' END WHEN section = 'odd-section' THEN CASE WHEN o % 11 = 0 THEN 'unknown' ELSE 'near_mint' END ELSE 'graded' END AS condition_bucket, parse_status,
CASE parse_status WHEN 'rejected' THEN 0 WHEN 'quarantined' THEN 60 ELSE CASE WHEN ebay THEN 100 ELSE 80 END END AS parse_confidence,
coalesce(bad, CASE WHEN o % 11 = 0 AND n = 5 THEN 'lot_or_bundle,unknown_section_class' WHEN o % 11 = 0 THEN 'lot_or_bundle' WHEN n = 5 THEN 'unknown_section_class' END) AS rejection_reason,
CASE WHEN bad IS NULL THEN sha256(CASE WHEN ebay THEN concat_ws('|', 'pricecharting', page_id, 'ebay', item, 'completed-auctions-' || section) ELSE concat_ws('|', 'pricecharting', page_id, d, market, 'completed-auctions-' || section, c, lower(title)) END) END AS provider_sale_key FROM q""",
    "page_sales_report": f"""WITH {_SALES}, g AS (SELECT page_id, count(*) AS rows, count(*) FILTER (parse_status = 'ok') AS ok, count(*) FILTER (parse_status = 'quarantined') AS quarantined, count(*) FILTER (parse_status = 'rejected') AS rejected FROM q GROUP BY 1)
SELECT CAST(p_partkey AS BIGINT) AS page_id, CASE WHEN p_size % 10 = 0 THEN 'unsupported_layout' WHEN p_size = 7 OR p_partkey NOT IN (SELECT l_partkey FROM lineitem) THEN 'no_section' ELSE 'ok' END AS status,
coalesce(rows, 0) AS rows, coalesce(ok, 0) AS ok, coalesce(quarantined, 0) AS quarantined, coalesce(rejected, 0) AS rejected FROM part LEFT JOIN g ON g.page_id = p_partkey""",
    "page_signatures": f"""WITH {_SALES}, g AS (SELECT page_id, array_to_string(list_sort(list_distinct(list(section))), ',') AS sections, bool_or(ebay) AS e FROM q GROUP BY 1)
SELECT CAST(p_partkey AS BIGINT) AS page_id, sha256(CASE WHEN p_size % 10 = 0 THEN 'lang=ja|anchor=0|full_prices=0|chart=0|unsupported' ELSE 'lang=en|anchor=0|full_prices=0|section_classes=' || coalesce(sections, '') || '|anchor_classes=' || CASE WHEN e THEN 'js-ebay-completed-sale' ELSE '' END || '|row_cell_classes=' || CASE WHEN sections IS NOT NULL THEN 'date,numeric,title' ELSE '' END END) AS signature
FROM part LEFT JOIN g ON g.page_id = p_partkey""",
    "report_rows": f"""WITH r AS (SELECT *, CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE p_partkey * 3 % 4000 END AS auth, CASE WHEN p_partkey % 12 = 0 THEN 0 ELSE p_partkey * 13 % 4000 END AS psa_9, CASE WHEN p_partkey % 13 = 0 THEN 0 ELSE p_partkey * 14 % 4000 END AS psa_10, p_partkey * 14 % 4000 + 1000 AS total_graded FROM part WHERE p_size % 5 <> 0)
SELECT 'Pokemon ' || p_brand AS set_name, '2001' AS release_year, CAST(p_partkey AS VARCHAR) AS card_number, p_name AS card_name, CASE WHEN p_size % 5 = 1 THEN 'Holo' ELSE '' END AS variant, p_name || CASE WHEN p_size % 5 = 1 THEN ' (Holo)' ELSE '' END AS full_name,
CAST(auth AS INTEGER) AS auth, CAST(psa_9 AS INTEGER) AS psa_9, CAST(psa_10 AS INTEGER) AS psa_10, CAST(total_graded AS INTEGER) AS total_graded, {o.r("CAST(psa_10 AS DOUBLE) / total_graded * 100", 2)} AS gem_rate, DATE '2001-10-01' AS scraped_date FROM r""",
    "report_totals": "SELECT 'Known ' || p_brand AS set_name, '2001' AS release_year, CAST(count(*) * 13 AS INTEGER) AS total_graded, CAST(count(*) * 12 AS INTEGER) AS total_psa_10, CAST(count(*) * 11 AS INTEGER) AS total_psa_9, CAST(count(*) * 10 AS INTEGER) AS total_psa_8 FROM part GROUP BY p_brand",
    "seeded_cards": """SELECT CAST(p_partkey AS VARCHAR) AS card_slug, p_name || CASE WHEN p_size % 3 = 0 THEN ' booster "box"' ELSE ', the one #' || p_size || CASE WHEN p_size % 4 = 0 THEN 'a' ELSE '' END END AS card_name, CASE WHEN p_size % 3 <> 0 THEN p_size || CASE WHEN p_size % 4 = 0 THEN 'a' ELSE '' END END AS card_number,
CASE WHEN p_size % 3 <> 0 THEN p_size || CASE WHEN p_size % 4 = 0 THEN 'a' ELSE '' END || '/102' END AS card_number_display, p_size % 3 = 0 AS is_sealed, 'en' AS language FROM part WHERE p_partkey % 10 <> 0""",
    "imported_cards": """SELECT CAST(p_partkey AS VARCHAR) AS card_slug, CASE WHEN p_size % 3 <> 0 THEN p_size || CASE WHEN p_size % 4 = 0 THEN 'a' ELSE '' END END AS card_number,
CASE WHEN p_size % 3 <> 0 THEN p_size || CASE WHEN p_size % 4 = 0 THEN 'a' ELSE '' END || '/102' END AS card_number_display, p_size % 3 = 0 AS is_sealed FROM part WHERE p_partkey % 10 <> 0""",
    "catalogue_counts": "WITH f AS (" + " UNION ALL ".join(f"SELECT *, '{n}' AS file, '{'jp' if 'japan' in n.lower() else 'en'}' AS language FROM part WHERE {r}" for n, r in FILES.items()) + """)
SELECT language, p_brand AS console_name, count(*) AS n, count(DISTINCT file) AS files, string_agg(DISTINCT file, ',' ORDER BY file) AS file_names, count(DISTINCT file) > 1 AS duplicate FROM f WHERE p_partkey % 10 <> 0 AND p_brand IN (SELECT p_brand FROM part WHERE p_size > 45) GROUP BY 1, 2""",
    "text_report_rows": f"""WITH q AS (SELECT p_brand AS set_name, CAST(p_partkey AS VARCHAR) AS card_number, p_name AS card_name, CASE WHEN p_size % 3 = 0 THEN p_type ELSE '' END AS variant, {", ".join(f"CASE WHEN (p_size + {k}) % 9 = 0 THEN 0 ELSE CAST(p_size * {k + 1} * 37 + p_partkey % 11 AS BIGINT) END AS {g}" for k, g in enumerate(po.GRADES))} FROM part WHERE p_size % 10 <> 0)
SELECT set_name, card_number, card_name, variant, card_name || CASE WHEN variant <> '' THEN ' (' || variant || ')' ELSE '' END AS full_name, auth, psa_1_5, psa_10, total_graded, CASE WHEN total_graded > 0 THEN {o.r("CAST(psa_10 AS DOUBLE) / total_graded * 100", 2)} ELSE 0 END AS gem_rate FROM q""",
    "sales_run": f"""WITH {_SALES} SELECT 'success' AS status, (SELECT count(*) FROM part) AS pages_processed, count(*) FILTER (parse_status = 'ok') AS rows_ok, count(*) FILTER (parse_status = 'quarantined') AS rows_quarantined, count(*) FILTER (parse_status = 'rejected') AS rows_rejected,
CAST(90000 AS BIGINT) AS duration_ms, CAST((SELECT count(*) FROM part) AS VARCHAR) AS noted_pages, 'nightly' AS kind FROM q""",
}
