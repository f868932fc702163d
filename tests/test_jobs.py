"""Vectors and properties of jobs: matching, retention, scheduling, pages, populations, sinks."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillmark.operators import catalogue, matching, medians, pages, population, retention, scheduling, scores, selections, species
from quillmark.sources import readers, sinks

ITEMS = [("1", "Charizard #4"), ("2", "Charizard [1st Edition] #4"), ("3", "Charizard [Shadowless] #4"), ("4", "Charizard [Reverse Holo] #4"), ("5", "Charizard #11")]


@pytest.mark.parametrize(
    ("title", "slug", "confidence"),
    [
        ("Charizard 4/102 Base Set PSA 9", "1", "high"),
        ("Charizard 1st Edition 4/102", "2", "high"),
        ("Charizard Shadowless #4", "3", "high"),
        ("Charizard reverse holo 4/102", "4", "high"),
        ("Charizard #011", "5", "high"),
        ("Pikachu 25/102", "1", "none"),
    ],
)
def test_best_match(spark, title, slug, confidence):
    items = spark.createDataFrame(ITEMS, "card_slug string, card_name string").withColumn("set_name", F.lit("Base Set"))
    searched = items.where("card_slug = '1'").select("*", F.lit("L").alias("listing_id"), F.lit(title).alias("title"))
    row = matching.match_listings(searched, items.withColumn("card_name", F.regexp_replace("card_name", "^[A-Za-z]+", "Charizard"))).first()
    assert (row["card_slug"], row["match_confidence"]) == (slug, confidence)


def all_pairs(searched, items):
    """Every title against every item of its set and base name, or the searched item alone."""
    base = lambda c: F.lower(matching.item_features(F.col(c))["base"])
    right = items.select(F.col("card_slug").alias("slug"), F.col("card_name").alias("name"), "set_name", base("card_name").alias("base"))
    met = searched.withColumn("base", base("card_name")).join(right, ["set_name", "base"], "left").withColumn("name", F.coalesce("name", "card_name")).withColumn("slug", F.coalesce("slug", "card_slug"))
    scored = met.select("listing_id", "slug", matching.score(matching.title_features(F.col("title")), matching.item_features(F.col("name"))).alias("points"))
    return scored.groupBy("listing_id").agg(F.min_by(F.struct("slug", "points"), F.struct(-F.col("points"), F.col("slug"))).alias("b")).select("listing_id", "b.*")


def test_matching_meets_the_best_of_all_pairs(spark):
    rng = random.Random(12)
    tags = ["", "", " [1st Edition]", " [Shadowless]", " [Reverse Holo]", " [Holo] [1st Edition]", " [Staff Prerelease]"]
    said = ["", " 1st edition", " shadowless", " reverse holo", " holo", " staff", " psa 9"]
    name = lambda base: base + rng.choice(tags) + rng.choice(["", f" #{rng.randrange(12)}", f" #0{rng.randrange(12)}", " #TG03"])
    items = [(str(i), name("Mew" if i % 3 else rng.choice(["Mewtwo", "Mr. Mime", "mew"])), rng.choice(["A", "A", "A", "B", None])) for i in range(220)]
    df = spark.createDataFrame(items, "card_slug string, card_name string, set_name string")
    titles = [(f"L{k}", rng.choice(["Mew", "mew two", "Mewtwo", "Mr. Mime", "Pikachu", ""]) + rng.choice(said) + rng.choice(["", f" {rng.randrange(12)}/102", " #TG03", f" #{rng.randrange(12)}"]), rng.choice(items)) for k in range(400)]
    rows = [(k, t, *card) for k, t, card in titles] + [("gone", "Abra 5/10", "x", "Abra #5", "A"), ("noset", "Abra", "y", "Abra", None)]
    searched = spark.createDataFrame(rows, "listing_id string, title string, card_slug string, card_name string, set_name string")
    expected = sorted(map(tuple, all_pairs(searched, df).collect()))
    for few in (200_000, 0):
        got = matching.match_listings(searched, df, broadcast_rows=few).select("listing_id", F.col("card_slug").alias("slug"), "points")
        assert sorted(map(tuple, got.collect())) == expected
    # A base name on two thirds of the items: a title meets a few of them.
    index = matching.item_index(df)
    most = index.where("base = 'mew' and set_name = 'A'").groupBy("at").count().agg(F.max("count")).first()[0]
    assert most <= 2 * df.select(matching.item_features(F.col("card_name"))["value"].alias("v"), matching.item_features(F.col("card_name"))["cosmetic"].alias("c")).distinct().count()


def test_a_title_is_read_once_a_row(spark):
    searched = spark.createDataFrame([("L", "Mew 8/10", "1", "Mew #8", "A")], "listing_id string, title string, card_slug string, card_name string, set_name string")
    items = searched.select("card_slug", "card_name", "set_name")
    for few in (200_000, 0):
        out = matching.match_listings(searched, items, broadcast_rows=few).select("listing_id", "card_slug", "points")
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("lower(title") <= 1 and plan.count("extract_all(card_name") <= 20


def test_listings_are_shuffled_once_by_their_item(spark):
    """As lines, before they are listings; neither for equal listings nor to join the searched or the matched item."""
    from quillmark.plans import market

    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = market.listing_rows(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line and "l_orderkey" in line)
    # What the lines go through is what encloses their scan.
    above, depth = [], len(lines[scan]) - len(lines[scan].lstrip(" :+-"))
    for line in reversed(lines[:scan]):
        at = len(line) - len(line.lstrip(" :+-"))
        if at < depth:
            above, depth = [*above, line], at
    assert sum("Exchange" in line for line in above) == 1 and any("SortMergeJoin" in line for line in above)


def test_fair_values_of_matched_and_of_searched_items(spark):
    items = spark.createDataFrame([("1", "Mew #8", "A"), ("2", "Mew [1st Edition] #8", "A"), ("3", "Abra #5", None)], "card_slug string, card_name string, set_name string")
    trends = spark.createDataFrame([("1", 10, None, 30), ("2", 11, 21, None), ("3", 12, None, None), ("3", 13, None, None)], "card_slug string, current_raw bigint, current_psa9 bigint, current_psa10 bigint")
    titles = [("a", "1", "Mew #8"), ("b", "1", "Mew 1st edition #8"), ("c", "2", "Mew PSA 10 #8"), ("d", "3", "Abra #5"), ("e", "2", "Mew 1st edition PSA 10 #8")]
    raw = spark.createDataFrame([(k, slug, title, "1.00", None, "USD", "EBAY_US", "", "") for k, slug, title in titles], "listing_id string, card_slug string, title string, price string, shipping string, currency string, marketplace string, image string, web_url string")
    rows = matching.process_listings(raw, items, trends).select("ebay_item_id", "card_slug", "fair_value_cents", "fair_value_kind").collect()
    assert sorted(map(tuple, rows)) == [("a", "1", 10, "Raw"), ("b", "2", 11, "Raw"), ("c", "1", 30, "PSA 10"), ("d", "3", 12, "Raw"), ("d", "3", 13, "Raw"), ("e", "2", 21, "PSA 9")]


def test_title_features(spark):
    t = spark.createDataFrame([("Mew CGC 9.5 Reverse Holo 007/102 Gold Star",)], "t string").select(matching.title_features(F.col("t")).alias("f")).first()["f"]
    assert (t["number"], t["grader"], t["grade"], t["graded"], t["value"], t["cosmetic"]) == ("7", "CGC", "9.5", True, ["gold star"], ["reverse holo"])


def test_search_text(spark):
    row = spark.createDataFrame([("Mew [1st Edition] #8", "Pokemon Fossil")], "n string, s string")
    assert row.select(matching.search_text(F.col("n"), F.col("s")).alias("v")).first()["v"] == "Pokemon Mew 1st Edition Fossil 8"


SALES = "provider_card_id string, provider_sale_key string, sale_date string, parse_confidence int, observed_section string, grading_company string, grade string, review_status string, parse_status string"


def sale(key, day, card="c", confidence=100, grade="PSA 9", status="active"):
    return (card, key, day, confidence, "completed-auctions-graded", "PSA", grade, status, "ok")


def test_reconcile_supersedes_and_skips(spark):
    old = [sale(f"e{i}", f"2024-01-0{i}") for i in range(1, 6)]
    out = retention.reconcile(spark.createDataFrame(old, SALES), spark.createDataFrame([sale("s1", "2024-02-01"), sale("s2", "2023-01-01")], SALES), 5).collect()
    state = {r["provider_sale_key"]: r["review_status"] for r in out}
    assert state == {"e1": "superseded", "e2": "active", "e3": "active", "e4": "active", "e5": "active", "s1": "active"}


def test_reconcile_caps_each_grade_and_spares_others(spark):
    old = [sale(f"a{i}", f"2024-01-0{i}", grade="PSA 9") for i in range(1, 7)] + [sale(f"b{i}", f"2024-01-0{i}", grade="PSA 10") for i in range(1, 7)] + [sale(f"x{i}", "2020-01-01", card="other") for i in range(9)]
    out = retention.reconcile(spark.createDataFrame(old, SALES), spark.createDataFrame([sale("a6", "2024-01-06")], SALES), 5).collect()
    active = [r["provider_sale_key"] for r in out if r["review_status"] == "active"]
    assert sorted(k for k in active if k[0] == "a") == ["a2", "a3", "a4", "a5", "a6"]
    assert sum(k[0] == "b" for k in active) == 5 and sum(k[0] == "x" for k in active) == 9


def test_reconcile_meets_in_one_shuffle_by_item(spark):
    old = [sale("k", "2024-01-09"), sale("", "2024-01-01"), sale("gone", "2024-01-02"), sale("hidden", "2024-01-03", status="superseded"), sale("o", "2024-01-01", card="other"), sale("n", "2024-01-01", card=None)]
    new = [sale("k", "2024-01-05"), sale("hidden", "2024-01-08"), sale(None, "2024-01-09"), sale("late", "2023-01-01"), sale("m", "2024-01-01", card=None)]
    out = retention.reconcile(spark.createDataFrame(old, SALES), spark.createDataFrame(new, SALES), 2)
    found = {(r["provider_sale_key"], r["review_status"], r["sale_date"]) for r in out.collect()}
    assert found == {("hidden", "active", "2024-01-08"), ("k", "active", "2024-01-09"), ("", "superseded", "2024-01-01"), ("gone", "superseded", "2024-01-02"), ("o", "active", "2024-01-01"), ("n", "active", "2024-01-01"), ("m", "active", "2024-01-01")}
    plan = out._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("Initial Plan")[-1]
    assert plan.count("Exchange ") <= 2 and "Join" not in plan  # scraped rows by item and grade, then both sides by item


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 28), st.sampled_from(["PSA 9", "PSA 10"]), st.integers(0, 100)), max_size=25), st.integers(1, 4))
def test_newest_per_grade_is_capped_and_idempotent(spark, drawn, most):
    sales = spark.createDataFrame([sale(f"k{i}", f"2024-01-{d:02d}", confidence=c, grade=g) for i, (d, g, c) in enumerate(drawn)], SALES)
    once = retention.newest_per_grade(sales, most)
    counts: dict = {}
    kept = once.collect()
    for r in kept:
        counts[r["grade"]] = counts.get(r["grade"], 0) + 1
    assert all(v <= most for v in counts.values())
    assert sorted(r["provider_sale_key"] for r in retention.newest_per_grade(once, most).collect()) == sorted(r["provider_sale_key"] for r in kept)
    assert retention.newest_per_grade(sales, 0).count() == len(drawn)


def test_pack_batches(spark):
    sets = [("en", f"s{i}", n) for i, n in enumerate((9, 7, 6, 5, 4, 3))] + [("jp", "t", 8)]
    out = scheduling.pack_batches(spark.createDataFrame(sets, "language string, name string, n bigint"), 2).collect()
    load: dict = {}
    for r in out:
        load[r["language"], r["batch"]] = load.get((r["language"], r["batch"]), 0) + r["n"]
    assert len(out) == len(sets) and abs(load["en", 0] - load["en", 1]) <= 2


def test_rotation_slice(spark):
    ids = spark.createDataFrame([(str(i),) for i in range(1, 1001)], "provider_card_id string")
    tail = scheduling.rotation_slice(ids, 900, 300).orderBy("position").collect()
    assert [r["provider_card_id"] for r in tail] == [str(i) for i in range(901, 1001)]
    assert [r["provider_card_id"] for r in scheduling.rotation_slice(ids, 1000, 3).orderBy("number").collect()] == ["1", "2", "3"]
    texts = spark.createDataFrame([("10",), ("9",), ("a",)], "provider_card_id string")
    assert [r["provider_card_id"] for r in scheduling.rotation_slice(texts, 0, 3).orderBy("number").collect()] == ["10", "9", "a"]


def test_streaks(spark):
    at = lambda k: dt.datetime(2024, 1, 1, k)
    rows = [("a", "page_reached_no_price", at(1)), ("a", "timeout", at(2)), ("b", "page_reached_no_price", at(1)), ("b", "priced", at(2)), ("b", "page_reached_no_price", at(3)), ("c", "not_found", at(1))]
    df = spark.createDataFrame(rows, "card_slug string, category string, attempted_at timestamp")
    prior = spark.createDataFrame([("a", 2), ("b", 7), ("c", 4)], "card_slug string, no_price_streak bigint")
    assert {r["card_slug"]: r["no_price_streak"] for r in scheduling.streaks(df, prior).collect()} == {"a": 3, "b": 1, "c": 4}
    with pytest.raises(Exception, match="invalid attempt category"):
        scheduling.streaks(df.withColumn("category", F.lit("odd"))).collect()


def by_regex(cards, names):
    """The rule itself, comparing all pairs."""
    form = F.concat(F.lit("(?<![a-z])"), F.regexp_replace(F.regexp_replace(F.lower("name"), r"\.", "\\\\."), "-", "[- ]"), F.lit("(?![a-z])"))
    pairs = cards.select("card_slug", "card_name").join(names.where("name <> ''").select("name", form.alias("form")), F.expr("lower(card_name) rlike form"))
    return pairs.select("card_slug", "name").distinct()


def test_species(spark):
    cards = spark.createDataFrame([("1", "Mr. Mime #6"), ("2", "Mr Mime GX"), ("3", "Mewtwo #10"), ("4", "Mew 151"), ("5", "Ho-Oh & Lugia"), ("6", "Ho Oh v2"), ("7", "mew2")], "card_slug string, card_name string")
    names = spark.createDataFrame([("mr-mime",), ("mew",), ("mewtwo",), ("ho-oh",), ("lugia",)], "name string")
    fast = sorted(map(tuple, species.mentions(cards, names).collect()))
    assert fast == sorted(map(tuple, by_regex(cards, names).collect()))
    assert ("7", "mew") in fast and ("3", "mew") not in fast


def test_species_of_other_forms(spark):
    cards = spark.createDataFrame([("1", "Porygon2 #6"), ("2", "Porygon-Z"), ("3", "Tapu the great Koko V"), ("4", "Tapu-the great koko"), ("5", "Nidoran\u2640 8")], "card_slug string, card_name string")
    names = spark.createDataFrame([("porygon",), ("porygon2",), ("tapu-the-great-koko",), ("nidoran\u2640",)], "name string")
    fast = sorted(map(tuple, species.mentions(cards, names).collect()))
    assert fast == sorted(map(tuple, by_regex(cards, names).collect()))
    assert {("1", "porygon2"), ("3", "tapu-the-great-koko"), ("4", "tapu-the-great-koko"), ("5", "nidoran\u2640")} <= set(fast)


def test_thousands_of_names_without_comparing_all(spark):
    rng = random.Random(9)
    part = lambda: "".join(rng.choice("abé 2-.'♀") for _ in range(rng.randrange(1, 7)))
    cards = spark.createDataFrame([(str(i), "".join(part() for _ in range(4))) for i in range(150)] + [("e", ""), ("n", None)], "card_slug string, card_name string")
    names = spark.createDataFrame([(n,) for n in sorted({part() for _ in range(3000)} | {"a+b", "(ab)", "é[a2]", ""})], "name string")
    found = species.mentions(cards, names)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, by_regex(cards, names).collect()))
    assert found.count() > 1000 and "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="patterns"):
        species.mentions(cards, names, max_patterns=2)


def test_exact_medians(spark):
    rng = random.Random(10)
    rows = [(g, "x", None if rng.random() < 0.1 else rng.choice([rng.randrange(-50, 50), rng.randrange(10**7), 7])) for g in [1, 1, 2, 2, 2, None] * 60]
    rows += [(3, "x", None), (4, "x", 5), (5, "y", 4), (5, "y", 7), (6, "z", -(2**61)), (6, "z", 2**61 - 1), (7, "z", -3), (7, "z", -2)]
    df = spark.createDataFrame(rows, "g int, h string, v bigint")
    values = {}
    for g, h, v in rows:
        if v is not None:
            values.setdefault((g, h), []).append(v)
    middle = lambda v: (sorted(v)[(len(v) - 1) // 2] + sorted(v)[len(v) // 2]) // 2
    expected = {k: middle(v) for k, v in values.items()}
    for parts, groups in ((1024, 100_000), (16, 0)):
        found = medians.exact_medians(df, ["g", "h"], "v", parts=parts, broadcast_groups=groups)
        assert {(r["g"], r["h"]): r["median"] for r in found.collect()} == expected
    assert medians.exact_medians(df.where("false"), ["g"], "v").count() == 0


def test_index_of_a_day_without_prices(spark):
    empty = spark.createDataFrame([], "date date, raw_usd bigint, psa9_usd bigint, psa10_usd bigint")
    row = scores.index_row(empty, dt.date(2024, 1, 1)).first()
    assert (row["date"], row["total_raw_usd"], row["cards_with_raw_price"], row["median_raw_usd"]) == (dt.date(2024, 1, 1), 0, 0, None)


PAGE = """<html><h1>x</h1><div class="completed-auctions-used tab available"></div>
<div class="completed-auctions-used"><table class="hoverable-rows sortable"><tbody>
<tr id="ebay-123456"><td class="date">2024-01-05</td><td class="title"><a class="js-ebay-completed-sale" href="https://www.ebay.co.uk/itm/123456?x=1">Mew near mint #8</a> [eBay]</td><td class="numeric"><span class="js-price">$1,050.00</span></td></tr>
<tr id="ebay-123456"><td class="date">2024-01-05</td><td class="title"><a class="js-ebay-completed-sale" href="https://www.ebay.co.uk/itm/123456">Mew again</a> [eBay]</td><td class="numeric"><span class="js-price">$9.00</span></td></tr>
<tr id="x"><td class="date">2024-01-04</td><td class="title"><a href="https://www.tcgplayer.com/p">Lot of Mew</a> [TCGPlayer]</td><td class="numeric"><span class="js-price" title="best offer accepted price">$7.00</span><span class="js-price listed-price-inline">$9.00</span></td></tr>
<tr><td class="date">Jan 4</td><td class="title"><a href="https://www.ebay.com/itm/999999">Bad date</a></td><td class="numeric"><span class="js-price">$1.00</span></td></tr>
<tr><td class="date">2024-01-03</td><td class="title"><a href="javascript:x">Bad link</a></td><td class="numeric"><span class="js-price">$1.00</span></td></tr>
<tr><td class="date">2024-01-02</td><td class="title"><a class="js-ebay-completed-sale" href="https://www.ebay.com/itm/777777">No price</a></td><td class="numeric"></td></tr>
<tr><td class="date">2024-01-02</td><td class="title"><a class="js-ebay-completed-sale" href="https://www.ha.com/z">Conflict</a></td><td class="numeric"><span class="js-price">$3.00</span></td></tr>
</tbody></table></div></html>"""


def test_recent_sales(spark):
    df = spark.createDataFrame([(1, "https://h/game/pokemon-x/y", PAGE, "77", "8")], "page_id bigint, url string, html string, provider_card_id string, expected_card_number string")
    found = pages.recent_sales(df)
    by = {r["pos"]: r for r in found.collect()}
    first = by[0]
    assert (first["parse_status"], first["sale_price_cents"], first["marketplace_source"], first["marketplace_country"], first["marketplace_item_id"], first["condition_bucket"], first["parse_confidence"]) == ("ok", 105000, "ebay", "GB", "123456", "near_mint", 100)
    assert first["listing_url"] == "https://www.ebay.co.uk/itm/123456" and first["language"] == "en"
    assert 1 not in by  # the same sale key
    lot = by[2]
    assert (lot["parse_status"], lot["best_offer_status"], lot["sale_price_cents"], lot["original_price_cents"], lot["rejection_reason"], lot["parse_confidence"]) == ("quarantined", "accepted", 700, 900, "lot_or_bundle", 60)
    assert [by[k]["rejection_reason"] for k in (3, 4, 5)] == ["malformed_date", "unsafe_url", "missing_final_price"]
    assert by[6]["rejection_reason"] == "conflicting_marketplace" and by[6]["marketplace_source"] == "ebay"
    assert tuple(pages.page_report(df, found).first()) == (1, "ok", 1, 6, 1, 2, 3)


def test_price_extracts(spark):
    html = """<td id="used_price" x><a></a><span class="price js-price"> $1,234.50 </span></td><td id="graded_price"><span class="price js-price">$0.00</span></td>
<div id="full-prices"><table><tr><td>Grade  9</td><td class="price js-price">$12.00</td></tr><tr><td>Odd</td><td class="price js-price">$1</td></tr></table></div>
<script>VGPC.chart_data = {"used":[[1704067200000,100],[1704067200000,200],[1706745600000,0]],"median":[[1704067200000,5]],"value":[[1706745600000,7]]};</script>
<td data-show-tab="completed-auctions-used"><span>volume:&nbsp;</span> <a href="#">3 sales per week</a></td><img src="//x/logo.png" id="photo"><img src="https://a.pricecharting.b/c.jpg">"""
    df = spark.createDataFrame([(1, html)], "page_id bigint, html string")
    now = pages.current_prices(df).first()
    assert (now["raw_usd"], now["psa9_usd"]) == (123450, None)
    assert pages.full_prices(df).first()["psa9_usd"] == 1200
    history = {r["date"]: r["raw_usd"] for r in pages.price_history(df).collect()}
    assert history == {dt.date(2024, 1, 1): 200, dt.date(2024, 2, 1): None}
    chart = {r["date"]: (r["median_usd"], r["value_usd"]) for r in pages.set_chart(df).collect()}
    assert chart == {dt.date(2024, 1, 1): (5, None), dt.date(2024, 2, 1): (None, 7)}
    assert tuple(pages.sales_volume(df).first())[1:] == ("Ungraded", 13, "3 sales per week", "3 sales per week", "high")
    assert df.select(pages.image_url(F.col("html")).alias("u")).first()["u"] == "https://a.pricecharting.b/c.jpg"
    rows = pages.daily_rows(pages.current_prices(df), pages.full_prices(df), pages.price_history(df), dt.date(2024, 2, 1))
    assert len(rows.columns) == 24
    assert sorted((str(r["date"]), r["raw_usd"], r["psa9_usd"]) for r in rows.collect()) == [("2024-01-01", 200, None), ("2024-02-01", 123450, 1200)]


def test_an_image_is_looked_for_once_a_place(spark):
    html = '<div id="product_image"><img src="//a.b/logo.png"></div><img itemprop="image" src="//a.b/d.png">'
    out = spark.createDataFrame([(html,), ("<p>",), (None,)], "html string").select(pages.image_url(F.col("html")).alias("u"))
    assert [r["u"] for r in out.collect()] == ["https://a.b/d.png", None, None]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("product_image") == 1


def test_layout_signature_ignores_data(spark):
    advert = PAGE.replace("<h1>x</h1>", "<h1>x</h1><p class='advert'>buy</p>").replace("$9.00", "$8.00")
    df = spark.createDataFrame([(PAGE, "https://h/game/pokemon-x/y"), (advert, "https://h/game/pokemon-x/z"), (PAGE.replace('"numeric"', '"number"'), "https://h/game/pokemon-x/y"), (PAGE, "https://h/game/jp-pokemon-x/y"), (None, None)], "h string, u string")
    a, b, other, cheap, empty = (r["s"] for r in df.select(pages.layout_signature(F.col("h"), F.col("u")).alias("s")).collect())
    assert a == b and len({a, other, cheap, empty}) == 4 and len(a) == 64


def test_page_statuses(spark):
    rows = [(1, "https://h/game/jp-pokemon-x/y", PAGE), (2, "https://h/game/pokemon-x/y", "<p></p>"), (3, "https://h/game/pokemon-x/y", '<div class="completed-auctions-used"><table class="hoverable-rows sortable"></table></div>'), (None, "https://h/game/pokemon-x/y", None)]
    df = spark.createDataFrame([(*r, "77") for r in rows], "page_id bigint, url string, html string, provider_card_id string")
    sales = pages.recent_sales(df)
    assert sales.count() == 0
    assert {r["page_id"]: r["status"] for r in pages.page_report(df, sales).collect()} == {1: "unsupported_layout", 2: "no_section", 3: "ok", None: "no_section"}


def test_a_status_looks_no_further_than_the_first_table_of_sales(spark):
    table = '<div class="completed-auctions-used"><table class="hoverable-rows sortable"></table></div>'
    rows = [(1, table), (2, "<table></table>" + table), (3, "<table></table>"), (4, table.replace("</table>", "")), (5, None)]
    df = spark.createDataFrame([(k, "https://h/game/pokemon-x/y", h, "77") for k, h in rows], "page_id bigint, url string, html string, provider_card_id string")
    report = pages.page_report(df, pages.recent_sales(df))
    assert {r["page_id"]: r["status"] for r in report.collect()} == {1: "ok", 2: "ok", 3: "no_section", 4: "no_section", 5: "no_section"}
    assert "instr(html" in report._jdf.queryExecution().optimizedPlan().toString().replace("coalesce(html", "html").replace("instr(html#", "instr(html")


def test_availability(spark):
    html = """<h1>Box</h1><p class="price">£12.50</p><button>Add to basket</button><script type="application/ld+json">{"offers":{"availability":"https://schema.org/OutOfStock"}}</script>"""
    df = spark.createDataFrame([(1, html), (2, "<p>Checking your browser</p>"), (3, "Add to basket, only 2 left"), (4, "")], "page_id bigint, html string")
    state = {r["page_id"]: (r["stock_state"], r["confidence"]) for r in pages.availability(df).collect()}
    assert state == {1: ("sold_out", 0.98), 2: ("unknown", 0.10), 3: ("low_stock", 0.85), 4: ("unknown", 0.30)}
    assert pages.availability(df).where("page_id = 1").first()["price"] == 12.5
    assert pages.availability(df, "basket").where("page_id = 1").first()["stock_state"] == "in_stock"


def test_population_report(spark):
    counts = "".join(f"<td><div>{v}</div><div>x</div></td>" for v in ("1", "–", "0", "2", "0", "0", "0", "0", "3", "4", "5", "10", "1,025"))
    row = lambda number, name: f"<tr><td></td><td>{number}</td><td>{name}</td><td></td>{counts}</tr>"
    html = f"""<title>2023 Pokemon Sword TCG Cards | PSA</title><table><tbody>{row("4", '<strong>Mew</strong><br>Holo Shop with Affiliates<a class="shop-link" data-id="9">s</a>')}
{row("5", "<strong>Mew</strong><br>German")}{row("", "TOTAL POPULATION")}<tr><td>1</td></tr></tbody></table>"""
    df = spark.createDataFrame([(1, html)], "page_id bigint, html string")
    sets = population.set_identity(df, spark.createDataFrame([], "heading_id string, name string, year string"))
    cells, day = population.report_cells(df), dt.date(2024, 1, 1)
    rows = population.population_rows(cells, sets, day).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["set_name"], r["release_year"], r["card_number"], r["full_name"], r["psa_spec_id"], r["psa_10"], r["psa_1"], r["total_graded"], float(r["gem_rate"])) == ("Pokemon Sword", "2023", "4", "Mew (Holo)", "9", 10, 0, 1025, 0.98)
    assert population.reported_totals(cells, sets, day).first()["total_psa_10"] == 10
    assert population.population_rows(cells, sets, day, keep_foreign=True).count() == 2


def test_population_text_report(spark):
    values = "\n".join(str(v) for k in range(13) for v in (k, "-", "0"))
    text = f"Card No.\nTOTAL POPULATION\n1\n2\n4\tMew Shop with Affiliates\nHolo\nGrade\n+\nQ\n{values}\n5\tBad\nGrade\n+\nQ\n1\n2"
    rows = population.text_report(spark.createDataFrame([("s", text)], "set_name string, text string")).collect()
    assert [(r["card_number"], r["full_name"], r["auth"], r["psa_10"], r["total_graded"]) for r in rows] == [("4", "Mew (Holo)", 0, 11, 12)]


def test_catalogue_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,console-name,product-name,loose-price\n1,Pokemon Base,"Mew, the #8",$1.00\n,Pokemon Base,No id,\n2,Pokemon Base,Box,\n')
    (tmp_path / "Japan_b.csv").write_text("id,console-name,product-name,loose-price\n3,Pokemon Base,Mew #9,\n")
    rows = readers.catalogue(spark, f"file://{tmp_path}")
    assert sorted((r["id"], r["product_name"], r["language"]) for r in rows.collect()) == [("1", "Mew, the #8", "en"), ("2", "Box", "en"), ("3", "Mew #9", "jp")]
    assert readers.console_counts(rows).where("console_name = 'Pokemon Base'").count() == 2
    cards = catalogue.seed_rows(rows.where("language = 'en'"), "Base", "en", 102)
    by = {r["card_slug"]: r for r in cards.collect()}
    assert (by["1"]["card_number_display"], by["1"]["is_sealed"], by["2"]["is_sealed"], by["1"]["card_url_slug"]) == ("8/102", False, True, "mew-the-8")
    assert "set_release_date" not in cards.columns
    assert catalogue.import_rows(rows, "Base", 9).where("is_sealed").count() == 1


def test_collisions(spark):
    new = spark.createDataFrame([("1", "A", "en"), ("2", "A", "en"), ("3", "A", "en"), ("4", "A", "en")], "card_slug string, set_name string, language string")
    old = spark.createDataFrame([("1", "B", "jp"), ("2", "B", "en"), ("4", "B", "jp")], "card_slug string, set_name string, language string")
    found = catalogue.classify_collisions(new, old, ["4"])
    assert {r["card_slug"]: r["verdict"] for r in found.collect()} == {"1": "blocked", "2": "safe", "3": "safe", "4": "allowed"}
    assert "stored as jp in B" in catalogue.collision_report(found).first()["report"]


def test_bulk_plan(spark):
    manifest = spark.createDataFrame([("c1", "A", 102, 110), ("c2", "B", None, 50), ("c3", "C", None, None), ("c9", "D", 5, 5)], "console_name string, set_name string, printed_total int, official_total int")
    rows = spark.createDataFrame([("c1",), ("c1",), ("c2",), ("c3",)], "console_name string")
    found = {r["set_name"]: (r["denominator"], r["problem"]) for r in catalogue.bulk_plan(manifest, rows).collect()}
    assert found == {"A": (102, None), "B": (50, None), "C": (None, "no denominator"), "D": (5, "no rows")}


def test_merged_buckets(spark, tmp_path):
    path, schema = f"file://{tmp_path}/t", "k int, v string"
    rows = lambda *r: spark.createDataFrame(list(r), schema)
    for batch, step in ((rows((1, "a"), (2, "b"), (None, "n")), sinks.upserted), (rows((2, "c"), (3, "d")), sinks.upserted), (rows((3, "e"), (4, "f")), sinks.inserted)):
        sinks.merge_buckets(batch, path, schema, "k", lambda old, new, step=step: step(old, new, ["k"]), buckets=3)
    assert sorted(map(tuple, sinks.stored(spark, path, schema).collect()), key=str) == [(1, "a"), (2, "c"), (3, "d"), (4, "f"), (None, "n")]


def test_sleepers_need_the_quarter_too(spark):
    trends = spark.createDataFrame(
        [("up", 5000, 10.0, 20.0), ("fell", 5000, 30.0, -5.0), ("unknown", 5000, 30.0, None), ("dear", 30000, 10.0, 20.0), ("few", 5000, 12.0, 20.0)],
        "card_slug string, current_raw int, raw_pct_30d double, raw_pct_90d double",
    )
    prices = spark.range(30).selectExpr("explode(array('up', 'fell', 'unknown', 'dear')) as card_slug").union(spark.createDataFrame([("few",)], "card_slug string"))
    assert [r["card_slug"] for r in selections.sleepers(trends, prices, None).collect()] == ["up"]


def test_replace_day(spark, tmp_path):
    path = f"file://{tmp_path}/d"
    rows = lambda *r: spark.createDataFrame(list(r), "k int, as_of string")
    sinks.replace_day(rows((1, "2024-01-01"), (2, "2024-01-02")), path)
    sinks.replace_day(rows((3, "2024-01-02")), path)
    assert sorted(r["k"] for r in spark.read.parquet(path).collect()) == [1, 3]


def test_run_row(spark, tmp_path):
    start, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 2)
    row = sinks.run_row(spark, {"ok": 2, "rejected": 1}, pages=3, started=start, ended=end, status="completed", notes={"pages": "9", "x": "y"}).first()
    assert (row["status"], row["rows_ok"], row["rows_quarantined"], row["rows_rejected"], row["duration_ms"]) == ("failed", 2, 0, 1, 2000)
    assert '"pages":"3"' in row["notes"] and '"x":"y"' in row["notes"]


def test_run_row_of_the_writing_job(spark, tmp_path):
    pages = spark.createDataFrame([(1, "ok,ok,rejected"), (2, ""), (3, "quarantined")], "page_id int, html string")
    parse = lambda p: p.select("page_id", F.explode(F.split("html", ",")).alias("parse_status")).where("parse_status <> ''")
    row = sinks.write_run(pages, parse, f"file://{tmp_path}/sales", started=dt.datetime(2024, 1, 1), ended=dt.datetime(2024, 1, 2)).first()
    assert (row["pages_processed"], row["rows_ok"], row["rows_quarantined"], row["rows_rejected"], row["status"]) == (3, 2, 1, 1, "success")
    assert spark.read.parquet(f"file://{tmp_path}/sales").count() == 4


def test_a_bucket_that_empties_goes(spark, tmp_path):
    path, schema = f"file://{tmp_path}/buckets", "k string, v int"
    put = lambda rows, merge: sinks.merge_buckets(spark.createDataFrame(rows, schema), path, schema, "k", merge, buckets=1)
    put([("a", 1), ("b", 2)], lambda old, new: new)
    put([("a", 1)], lambda old, new: old.where("false"))
    assert sinks.stored(spark, path, schema).count() == 0
    put([("c", 3)], lambda old, new: old.unionByName(new))
    assert [tuple(r) for r in sinks.stored(spark, path, schema).collect()] == [("c", 3)]


def test_releases_prefer_upcoming(spark):
    day = dt.date(2024, 1, 31)
    calendar = spark.createDataFrame([("soon", dt.date(2024, 2, 10)), ("past", dt.date(2024, 1, 20)), ("far", dt.date(2025, 1, 1))], "set_name string, release_date date")
    assert [r["set_name"] for r in selections.releases(calendar, day).collect()] == ["soon"]
    assert [r["set_name"] for r in selections.releases(calendar.where("set_name <> 'soon'"), day).collect()] == ["past"]


def report_text(n):
    values = lambda i: "\n".join(str(v) for k in range(13) for v in (f"{1000 * i + k:,}" if k % 4 else "–", "0", "3"))
    items = [f"{i}\tName {i}{'Shop with Affiliates' if i % 2 else ''}\n{'Holo' + chr(10) if i % 3 == 0 else ''}Grade\n+\nQ\n{values(i) if i % 7 else '1'}" for i in range(n)]
    return "Card No.\tDescription\nTOTAL POPULATION\n1\n2\n3\n" + "\n".join(items)


def test_reports_larger_than_a_partition(spark, tmp_path):
    """Files cut into many splits give what whole texts give, with every item's own number."""
    for name, n in (("Set A", 120), ("Set B", 1), ("Empty", 0)):
        (tmp_path / f"{name}.txt").write_text(report_text(n))
    (tmp_path / "crlf.txt").write_bytes(report_text(9).replace("\n", "\r\n").encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("700", "5000", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            blocks = readers.text_reports(spark, f"file://{tmp_path}")
            found = population.report_items(blocks)
            whole = spark.read.text(f"file://{tmp_path}", wholetext=True).select(F.regexp_extract(F.url_decode(F.col("_metadata.file_name")), r"^(.*)\.txt$", 1).alias("set_name"), F.col("value").alias("text"))
            expected = population.text_report(whole)
            assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
            assert found.count() == 120 - 18 + 0 + 9 - 2
            if size == "700":
                assert spark.read.text(f"file://{tmp_path}", lineSep="\t").select("_metadata.file_block_start").distinct().count() > 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["en", "jp"]), st.text("abc", min_size=1, max_size=3), st.integers(0, 9)), max_size=14, unique_by=lambda r: r[:2]), st.integers(1, 4))
def test_batches_are_dealt_greedily(spark, sets, batches):
    expected = []
    for language in ("en", "jp"):
        load = [0] * batches
        for _, name, n in sorted((r for r in sets if r[0] == language), key=lambda r: (-r[2], r[1])):
            to = load.index(min(load))
            load[to] += n
            expected.append((language, name, n, to))
    found = scheduling.pack_batches(spark.createDataFrame(sets, "language string, name string, n int"), batches)
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_file_names(spark):
    paths = ["file:/a/Japan%20b.csv", "file:/a/x.csv/part-00000-1.csv", "part-0"]
    rows = spark.createDataFrame([(p,) for p in paths], "p string").select(readers.file_name(F.col("p")).alias("n"))
    assert [r["n"] for r in rows.collect()] == ["Japan b.csv", "x.csv", "part-0"]


def test_saved_pages_are_whole(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>\none\n</p>\n")
    rows = readers.saved_pages(spark, f"file://{tmp_path}").collect()
    assert [(r["url"].rsplit("/", 1)[1], r["html"]) for r in rows] == [("a.html", "<p>\none\n</p>\n")]


def test_sale_cells_come_in_bounded_batches_with_their_pages_columns(spark):
    """A page of many rows is handed on in pieces, and each page is read once: a repeated page's rows don't meet those of its copy."""
    row = '<tr id="ebay-{0}"><td class="date">2024-01-05</td><td class="title"><a class="js-ebay-completed-sale" href="https://www.ebay.com/itm/{0}">Card</a></td><td class="numeric"><span class="js-price">$5.00</span></td></tr>'
    html = '<div class="completed-auctions-used"><table class="hoverable-rows sortable"><tbody>' + "".join(row.format(100_000 + i) for i in range(5_001)) + "</tbody></table></div>"
    df = spark.createDataFrame([(1, "https://h/game/pokemon-x/y", html, "77"), (2, None, None, "78")], "page_id bigint, url string, html string, provider_card_id string").coalesce(1)
    cells = pages.sale_cells(df, "provider_card_id", "url")
    assert (cells.count(), cells.select("provider_card_id").distinct().count()) == (5_001, 1)
    found = pages.recent_sales(df)
    assert found.count() == 5_001 and "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_plain_pages_are_read_as_the_parser_reads_them():
    rng = random.Random(4)
    row = '<tr id="ebay-1"><td class="date"> 2001-01-15 </td> <td class="title"><a title="x" href="h?a=1&amp;b">N&amp;M\xa0é </a> [e] </td><td class="numeric"><span class="js-price"> $1 </span> <span class="js-price">$2</span></td></tr>'
    bits = [
        row, row.replace(' class="numeric"', ""), "<", ">", '"', "&amp;", "&lt", "<br>", "<br/>", "<!-- x -->", "<!--> -->", "<script>a<b</script>", "<script>x", "</SCRIPT>", "<style>p</style>", "</td>", '<td class="date">', '<td class="title">',
        '<td class="numeric">', "<td class=date>", "<tr>", "</tr>", '<tr id="ebay-9">', "</table>", '<table class="sortable hoverable-rows">', '<div class="completed-auctions-used tab">', '<div class="completed-auctions-new">', "</div>", "</p>", '<a href="x&amp;y">',
        "</a>", '<span class="js-price" title="Best offer list price">', "<span class='js-price'>", "</span>", "text ", "<B CLASS='x'>", '<img src="a>b">', "<!doctype html>", "<title>a</title>", "<?x?>", '<div class="completed-auctions-">', "<input checked>", "\x00",
    ]
    start, seen, plain, rows = '<div class="completed-auctions-used"><table class="hoverable-rows sortable">', {}, 0, 0
    assert pages._plain_rows(PAGE, seen) == pages._parsed_rows(PAGE) != []
    for _ in range(6_000):
        html = rng.choice(["", start, start + '<tr id="a"><td class="date">2001-01-01</td><td class="title">']) + "".join(rng.choice(bits) for _ in range(rng.randrange(1, 9)))
        found = pages._plain_rows(html, seen)
        if found is not None:
            plain, rows = plain + 1, rows + len(found)
            assert found == pages._parsed_rows(html), html
    assert plain > 1_000 and rows > 300


def test_sales_are_shuffled_as_lines_and_as_rows_of_one_key(spark):
    """No page is shuffled; a row has one key until the window is over, and titles need no second Python task."""
    from quillmark.plans import saved_pages

    plan = saved_pages.page_sales(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert [line.split("hashpartitioning(")[1].split("#")[0] for line in exchanges] == ["page_id", "page_id", "l_partkey"]
    assert "ArrowEvalPython" not in plan and plan.count("provider_sale_key") == 1


def test_pages_of_a_run_are_dealt_by_their_lines(spark, monkeypatch):
    """A run's pages stay where their lines were dealt to, in tasks that don't grow with the table."""
    from quillmark.plans import saved_pages

    monkeypatch.setattr(saved_pages, "TASK_SALES", 500)
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    rows = F.size(F.split("html", "<tr")) - 1
    dealt = saved_pages.sale_pages(spark, "/root/testdata/sf0.001").select(F.spark_partition_id().alias("task"), rows.alias("n")).groupBy("task").agg(F.sum("n").alias("n")).collect()
    assert len(dealt) == -(-lines // 500) and max(r["n"] for r in dealt) < 1_000
    run = saved_pages.sales_run(spark, "/root/testdata/sf0.001").first()
    assert run["pages_processed"] == spark.read.parquet("/root/testdata/sf0.001/part.parquet").count() and run["rows_ok"] > 0


def test_a_title_is_compared_in_its_compatibility_form(spark):
    html = PAGE.split("<tr")[0] + "".join(f'<tr id="x"><td class="date">2024-01-05</td><td class="title"><a href="https://www.tcgplayer.com/p/1">{t}</a> [TCGPlayer]</td><td class="numeric"><span class="js-price">$5.00</span></td></tr>' for t in ("Mew #4", "  Ｍｅｗ　＃4 ", "mew #5", "Mew  # 4")) + "</tbody></table></div>"
    df = spark.createDataFrame([(1, "https://h/game/pokemon-x/y", html, "77")], "page_id bigint, url string, html string, provider_card_id string")
    assert sorted(r["pos"] for r in pages.recent_sales(df).collect()) == [0, 2]


def test_reports_of_any_size_are_parsed_in_pieces(spark, monkeypatch):
    """Rows across the cuts between pieces are whole, and no saved page of the stand-in lists a whole brand when that is large."""
    from quillmark.plans import saved_pages

    cells = "".join(f"<td><div>{k}</div><div>x</div></td>" for k in range(13))
    html = "<table><tbody>" + "".join(f"<tr><td></td><td>{n}</td><td><strong>Card {n} &amp; co</strong></td><td></td>{cells}</tr>" for n in range(3_000)) + "</tbody></table>"
    found = population.report_cells(spark.createDataFrame([(1, html), (2, None)], "page_id bigint, html string")).select("pos", "number", "strong", F.element_at("counts", 17).alias("last")).collect()
    assert sorted(map(tuple, found)) == [(n, str(n), f"Card {n} & co", "12") for n in range(3_000)]
    monkeypatch.setattr(saved_pages, "REPORT_ITEMS", 2)
    pages_ = saved_pages.report_pages(spark, "/root/testdata/sf0.001")
    rows = F.size(F.split("html", "<tr>")) - 1
    assert pages_.agg(F.max(rows)).first()[0] < 20 and pages_.agg(F.sum(rows)).first()[0] == spark.read.parquet("/root/testdata/sf0.001/part.parquet").count() + pages_.where(F.contains("html", F.lit("TOTAL POPULATION"))).count()


def test_texts_across_the_cuts_of_a_report_are_whole(spark):
    cells = "".join(f"<td><div>1,0{k:02d}</div><div>x</div></td>" for k in range(13))
    row = lambda n: f"<tr><td></td><td>{n}</td><td><strong>red  ring</strong><!-- c --><br>Holo Shop with Affiliates<a>s</a></td><td></td>{cells}</tr>"
    html = f"<table><tbody>{row(10)}{row(11)}</tbody></table>"

    def parsed(size: int) -> list[dict]:
        parser = population._Rows()
        for k in range(0, len(html), size):
            parser.feed(html[k : k + size])
        return parser.rows

    whole = parsed(len(html))
    assert (whole[0]["strong"], whole[0]["after_break"]) == ("red  ring", "Holo Shop with Affiliates")
    assert all(parsed(size) == whole for size in range(1, len(html)))
    # Names and variants at every place of a cut between pieces of a page.
    bodies = [(k, "<table><tbody>" + " " * (population._PIECE - k) + row(10) + "</tbody></table>") for k in range(40, 110)]
    found = population.report_cells(spark.createDataFrame(bodies, "page_id bigint, html string")).select("number", "strong", "after_break")
    assert set(map(tuple, found.collect())) == {("10", "red  ring", "Holo Shop with Affiliates")}


def test_names_of_few_species_are_broadcast(spark):
    cards = spark.createDataFrame([(str(i), "Mew ex") for i in range(50)] + [(None, "Mew")], "card_slug string, card_name string")
    names = spark.createDataFrame([("mew",), ("mew",), ("mew-ex",)], "name string")
    plan = lambda **k: species.mentions(cards, names, **k)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan() and "strategy=broadcast" not in plan(broadcast_names=1)
    prices = spark.createDataFrame([("1", 5), ("1", 9), ("2", 0)], "card_slug string, raw_usd bigint")
    assert sorted(map(tuple, species.species_stats(cards, names, prices).collect())) == [("mew", 50, 9), ("mew-ex", 50, 9)]


def test_chart_points_are_grouped_in_tasks_that_dont_grow(spark, monkeypatch):
    from quillmark.plans import saved_pages

    monkeypatch.setattr(saved_pages, "TASK_LINES", 1_000)
    history = saved_pages.page_history(spark, "/root/testdata/sf0.001")
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    plan = history._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == plan.count(f", {-(-lines // 1_000)}), REPARTITION_BY_NUM") == 1
