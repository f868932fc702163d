"""Vectors for the scalar rules."""

import pytest
from pyspark.sql import functions as F

from quillmark.functions import numbers as n
from quillmark.functions import text as x
from quillmark.operators import retention, scheduling


def value(spark, column, **given):
    names = list(given)
    schema = ", ".join(f"{k} {'double' if isinstance(v, float) else 'bigint' if isinstance(v, int) else 'string'}" for k, v in given.items()) or "x int"
    return spark.createDataFrame([tuple(given.values()) or (1,)], schema).select(column.alias("v")).first()["v"]


c = F.col


@pytest.mark.parametrize(("text", "cents"), [("$1,234.56", 123456), ("$4", 400), ("-$5.00", -500), ("none", None), ("$0.10", 10)])
def test_text_to_cents(spark, text, cents):
    assert value(spark, n.text_to_cents(c("t")), t=text) == cents


@pytest.mark.parametrize(("text", "cents"), [("19.99", 1998), ("10", 1000), ("x", None)])
def test_listing_cents_are_cut_off(spark, text, cents):
    assert value(spark, n.listing_cents(c("t")), t=text) in (cents, cents and cents + 1)


@pytest.mark.parametrize(("text", "sales"), [("3 sales per week", 13), ("1 sale per day", 30), ("2 sales per month", 2), ("1 sale per 2 years", 1), ("6 sales per year", 1), ("rare", None), ("24 sales per year", 2)])
def test_monthly_sales(spark, text, sales):
    assert value(spark, n.monthly_sales(c("t")), t=text) == sales


@pytest.mark.parametrize(("sales", "label", "confidence"), [(60, "2 sales per day", "high"), (8, "2 sales per week", "high"), (3, "3 sales per month", "medium"), (1, "1 sale per month", "low")])
def test_volume_labels(spark, sales, label, confidence):
    assert value(spark, n.volume_label(c("k")), k=sales) == label
    assert value(spark, n.volume_confidence(c("k")), k=sales) == confidence


def test_changes_and_ratios(spark):
    assert value(spark, n.pct_change(c("a"), c("b")), a=110, b=100) == 10.0
    assert value(spark, n.pct_change(c("a"), c("b")), a=0, b=100) is None
    assert value(spark, n.ratio(c("a"), c("b")), a=300, b=200) == 1.5
    assert value(spark, n.cents_to_dollars(F.lit(None).cast("bigint"))) == 0.0
    assert value(spark, n.usd_cents(c("a"), F.lit("GBP")), a=79) == 100
    assert value(spark, n.usd_cents(c("a"), F.lit("EUR")), a=79) == 79


@pytest.mark.parametrize(
    ("console", "name", "url"),
    [
        ("Pokemon Base Set", "Charizard [1st Edition] #4", "pokemon-base-set/charizard-1st-edition-4"),
        ("Pokemon Japanese Gold, Silver, New World", "Hop's Bag #91", "pokemon-japanese-gold-silver-new-world/hop's-bag-91"),
        ("Pokemon Sun & Moon", "Jangmo-o #69", "pokemon-sun-&-moon/jangmo-o-69"),
    ],
)
def test_page_url(spark, console, name, url):
    assert value(spark, x.page_url(c("k"), c("t")), k=console, t=name) == f"{x.PAGE_BASE}/{url}"


def test_slugs(spark):
    name = "Farfetch'd & Friends [Holo] #27"
    assert value(spark, x.site_slug(c("t")), t=name) == "farfetchd-friends-holo-27"
    assert value(spark, x.path_slug(c("t")), t=name) == "farfetch'd-&-friends-holo-27"
    assert value(spark, x.import_slug(c("t")), t="Acerola's Mischief [Ball] #180") == "acerolas-mischief-ball-180"
    assert value(spark, x.image_slug(c("t")), t="Acerola's Mischief [Ball] #180") == "acerolas-mischief-ball-180"
    assert value(spark, x.set_slug(c("t")), t="Pokemon Ruby & Sapphire") == "pokemon-ruby-&-sapphire"
    assert value(spark, x.bare_slug(c("t")), t="pc-1pc-2") == "1pc-2"


@pytest.mark.parametrize(("name", "trailing", "anyone", "expected"), [("Mew #54a", "54a", "54a", "54"), ("Mew #4 [x]", None, "4", None), ("Box", None, None, None), ("Mew #XY12", None, "XY12", None)])
def test_numbers_in_names(spark, name, trailing, anyone, expected):
    assert value(spark, x.trailing_number(c("t")), t=name) == trailing
    assert value(spark, x.any_number(c("t")), t=name) == anyone
    assert value(spark, x.expected_number(c("t")), t=name) == expected


def test_addresses(spark):
    assert value(spark, x.clean_url(c("u")), u="HTTPS://WWW.eBay.com/itm/1?x=2#y") == "https://www.ebay.com/itm/1"
    assert value(spark, x.clean_url(c("u")), u="javascript:alert(1)") is None
    assert value(spark, x.is_unsafe_url(c("u")), u="javascript:alert(1)") is True
    assert value(spark, x.language_of_url(c("u")), u="https://h/game/jp-pokemon-x/y") == "ja"
    assert value(spark, x.language_of_url(c("u")), u="https://h/game/pokemon-x/y") == "en"
    assert value(spark, x.marketplace_of_host(c("h")), h="www.ebay.co.uk") == "ebay"
    assert value(spark, x.marketplace_country(F.lit("ebay"), c("h")), h="www.ebay.co.uk") == "GB"
    assert value(spark, x.marketplace_country(F.lit("ebay"), c("h")), h="www.ebay.com") is None
    assert value(spark, x.second_part(c("i")), i="v1|123|0") == "123"


def test_titles(spark):
    assert value(spark, x.normal_title(c("t")), t="  Mew　＃4 / 102  ") == "mew # 4/102"
    assert value(spark, x.condition_bucket(c("t"), F.lit("raw")), t="Mew near mint") == "near_mint"
    assert value(spark, x.condition_bucket(c("t"), F.lit("graded")), t="Mew near mint") == "graded"
    assert value(spark, x.condition_bucket(c("t"), F.lit("raw")), t="Mew") == "raw_unknown"
    assert value(spark, x.first_edition(c("t")), t="Mew 1st Edition") == "first_edition"
    assert value(spark, x.variant_text(c("t")), t="Mew [Holo] [x] Shadowless") == "Holo; x; Shadowless"
    assert value(spark, x.variant_text(c("t")), t="Mew") is None
    assert value(spark, x.is_wrong_number(F.lit("85"), c("t")), t="Mew 085/108") is False
    assert value(spark, x.is_wrong_number(F.lit("85"), c("t")), t="Mew #84") is True
    assert value(spark, x.has_non_latin(c("t")), t="ミュウ") is True


def test_counts_and_keys(spark):
    import hashlib

    assert value(spark, x.count_cell(c("t")), t="1,234") == 1234
    assert value(spark, x.count_cell(c("t")), t="–") == 0
    assert value(spark, x.report_count(c("t")), t="x") is None
    assert value(spark, x.sha_key(F.lit("a"), F.lit(None).cast("string"), F.lit("b"))) == hashlib.sha256(b"a||b").hexdigest()
    assert value(spark, x.gem_rate(c("a"), c("b")), a=1, b=3) == 33.33
    assert value(spark, x.lookup(x.STORED_CONDITIONS, c("t"), "unknown"), t="damaged") == "poor"
    with pytest.raises(Exception, match="unknown import type"):
        value(spark, x.import_source(c("t")), t="typo")


@pytest.mark.parametrize(
    ("raw", "company", "grade", "key"),
    [("raw", None, None, "Raw"), ("raw", "PSA", "PSA 10", "Raw"), ("graded", "psa", "PSA 9", "PSA 9"), ("graded", "PSA", "9", "PSA 9"), ("graded", "PSA", None, "PSA"), ("graded", None, "Grade 9", "Grade 9"), ("graded", None, None, "Graded")],
)
def test_grade_key(spark, raw, company, grade, key):
    row = spark.createDataFrame([(raw, company, grade)], "r string, c string, g string")
    assert row.select(retention.grade_key(F.lit(""), c("r"), c("c"), c("g")).alias("v")).first()["v"] == key


@pytest.mark.parametrize(
    ("price", "category", "streak", "cohort"),
    [(200, None, 0, "DAILY_VALUE"), (199, None, 0, "WEEKLY_LOW"), (0, None, 0, "DAILY_DISCOVERY"), (None, None, 0, "DAILY_DISCOVERY"), (None, "transient_http_failure", 5, "DAILY_DISCOVERY"), (None, "page_reached_no_price", 3, "WEEKLY_UNPRICED")],
)
def test_cohort(spark, price, category, streak, cohort):
    row = spark.createDataFrame([(price, category, streak)], "p bigint, k string, s bigint")
    assert row.select(scheduling.cohort(c("p"), c("k"), c("s")).alias("v")).first()["v"] == cohort
