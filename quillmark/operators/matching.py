"""Matching of marketplace titles to catalogue items, and fair values of the matches."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions.numbers import listing_cents
from quillmark.functions.text import JUNK, contains_any, item_url, larger_image, second_part
from quillmark.sources.sinks import checkpointed

#: Variants that change an item's worth, with the phrases that tell them, in order.
VALUE_VARIANTS = {
    "1st edition": ("1st edition", "1st ed", "1st ed.", "first edition"),
    "gold star": ("gold star", "goldstar", "gold ★", " ★ "),
    "shadowless": ("shadowless", "shadow less"),
    "1999-2000": ("1999-2000", "1999 2000", "uk print", "4th print"),
    "black dot error": ("black dot error", "black dot"),
    "tekno": ("tekno", "techno"),
    "sparkle": ("sparkle", "spectra"),
    "for position only": ("for position only", "fpo", "test print"),
    "trainer deck a": ("trainer deck a",),
    "trainer deck b": ("trainer deck b",),
    "prerelease staff": ("prerelease staff", "pre-release staff", "staff prerelease"),
    "prerelease": ("prerelease", "pre-release", "pre release"),
    "staff": ("staff",),
    "error": ("error", "misprint"),
    "double holo error": ("double holo", "double holo error"),
    "stadium challenge": ("stadium challenge",),
    "cosmos professor program": ("cosmos professor program", "cosmos professor"),
    "professor program": ("professor program", "professor promo"),
    "championships": ("championship", "championships", "worlds"),
    "quarter-finalist": ("quarter-finalist", "quarter finalist", "qf"),
    "semi-finalist": ("semi-finalist", "semi finalist", "sf"),
    "top thirty-two": ("top thirty-two", "top 32", "top thirty two"),
    "top 8": ("top 8", "top eight"),
    "ultra ball league": ("ultra ball league",),
    "premier ball league": ("premier ball league",),
    "regional championship staff": ("regional championship staff",),
}
#: Variants of finish.
COSMETIC_VARIANTS = {
    "reverse holo": ("reverse holo", "reverse holographic", "rev holo", "reverse"),
    "holo": ("holo", "holographic", "holofoil"),
    "foil": ("foil",),
    "rainbow foil": ("rainbow foil", "rainbow"),
    "non-holo": ("non-holo", "non holo", "nonholo"),
}
#: Points of the score and least scores of the confidence levels.
NAME, NO_NAME, NUMBER, WRONG_NUMBER, SHARED, ONE_SIDED, FINISH, OTHER_FINISH = 20, -100, 15, -20, 10, -50, 3, -10
CONFIDENCE = ((35, "high"), (20, "medium"), (0, "low"))


def _named(text: Column, variants: dict[str, tuple[str, ...]]) -> Column:
    """Names of the variants of which the text holds a phrase, in order."""
    return F.array_compact(F.array(*[F.when(reduce(or_, [F.contains(text, F.lit(p)) for p in phrases]), name) for name, phrases in variants.items()]))


def _some(x: Column) -> Column:
    return F.when(x != "", x)


def title_features(title: Column) -> Column:
    """Struct of what a title says: low, number, grader, grade, graded, value and cosmetic variants."""
    low = F.lower(title)
    return _title_struct(title, low, _number(title), _named(low, VALUE_VARIANTS), _cosmetic(_named(low, COSMETIC_VARIANTS)))


def _number(title: Column) -> Column:
    slashed = _some(F.regexp_extract(title, r"([0-9]{1,4})\s*/\s*[0-9]{1,4}", 1))
    hashed = _some(F.regexp_extract(title, r"#\s*([A-Za-z]*[0-9]+[A-Za-z]*)", 1))
    return F.coalesce(F.regexp_replace(slashed, r"^0+(?=.)", ""), hashed)


def _cosmetic(finish: Column) -> Column:
    return F.when(F.array_contains(finish, "reverse holo"), F.array_remove(finish, "holo")).otherwise(finish)


def _title_struct(title: Column, low: Column, number: Column, value: Column, cosmetic: Column) -> Column:
    graded_form = r"(?i)\b(PSA|CGC|BGS|SGC|ACE|AGS|TAG|GMA|MNT)\s*([0-9]+\.?[0-9]*)\b"
    return F.struct(
        low.alias("low"),
        number.alias("number"),
        F.upper(_some(F.regexp_extract(title, graded_form, 1))).alias("grader"),
        _some(F.regexp_extract(title, graded_form, 2)).alias("grade"),
        (F.rlike(title, F.lit(graded_form)) | F.rlike(low, F.lit(r"\bgraded\b"))).alias("graded"),
        value.alias("value"),
        cosmetic.alias("cosmetic"),
    )


def _read_titles(titles: DataFrame) -> DataFrame:
    """``titles`` (title and other columns) and what a title says as columns t_low, t_number, t_value, t_cosmetic.

    Spark works a plain column out once, however many expressions use it, while a field of a struct is written out wherever it is used: the phrases
    alone use the lower-cased title some sixty times.
    """
    low = F.col("t_low")
    found = titles.withColumn("t_low", F.lower("title")).select("*", _number(F.col("title")).alias("t_number"), _named(low, VALUE_VARIANTS).alias("t_value"), _named(low, COSMETIC_VARIANTS).alias("t_finish"))
    return found.withColumn("t_cosmetic", _cosmetic(F.col("t_finish"))).drop("t_finish")


def _read_names(names: DataFrame) -> DataFrame:
    """``names`` (card_name and other columns) and their lower-cased base."""
    return names.withColumn("base", F.lower(item_features(F.col("card_name"))["base"]))


def _compared(read: DataFrame) -> DataFrame:
    """Whether the title holds the base's first word, and the title's signature."""
    found = read.withColumn("found", _names_first(F.col("t_low"), F.col("base")))
    return found.select("*", *_signature(F.col("t_number"), F.col("t_value"), F.col("t_cosmetic")))


def item_features(name: Column) -> Column:
    """Struct of an item's name: base, number, value and cosmetic variants of its bracketed tags.

    A tag stands for the first value variant, in the fixed order, whose name it holds; only without any, for the first
    cosmetic one.
    """
    tags = F.transform(F.regexp_extract_all(name, F.lit(r"\[(.*?)\]"), F.lit(1)), F.lower)

    def first_of(variants: dict[str, tuple[str, ...]]):
        return lambda tag: F.element_at(F.concat(F.array_compact(F.array(*[F.when(F.contains(tag, F.lit(v)), v) for v in variants])), F.array(F.lit(""))), 1)

    value, finish = first_of(VALUE_VARIANTS), first_of(COSMETIC_VARIANTS)
    clean = F.trim(F.regexp_replace(name, r"\[.*?\]", ""))
    return F.struct(
        F.trim(F.regexp_replace(clean, r"#\S+", "")).alias("base"),
        _some(F.regexp_extract(clean, r"#(\S+)", 1)).alias("number"),
        F.filter(F.transform(tags, value), lambda v: v != "").alias("value"),
        F.filter(F.transform(F.filter(tags, lambda t: value(t) == ""), finish), lambda v: v != "").alias("cosmetic"),
    )


def _plain(number: Column) -> Column:
    return F.lower(F.regexp_replace(number, r"^0+(?=.)", ""))


def names_first_word(title: Column, base: Column) -> Column:
    """Whether a title's features hold the first word of a base name."""
    return _names_first(title["low"], F.lower(base))


def _names_first(low: Column, base: Column) -> Column:
    first = F.get(F.split(base, r"\s+"), F.lit(0))
    return F.coalesce((first != "") & F.contains(low, first), F.lit(False))


def points(found: Column, title: Column, item: Column) -> Column:
    """Points of what a title says (number, value, cosmetic) against what an item's name says; ``NO_NAME`` alone if the item's first word wasn't found."""
    number = F.when(title["number"].isNull() | item["number"].isNull(), 0).when(_plain(title["number"]) == _plain(item["number"]), NUMBER).otherwise(WRONG_NUMBER)

    def variants(kind: str, shared: int, apart: int) -> Column:
        mine, yours = F.array_distinct(item[kind]), F.array_distinct(title[kind])
        return F.size(F.array_intersect(mine, yours)) * shared + (F.size(F.array_except(mine, yours)) + F.size(F.array_except(yours, mine))) * apart

    return F.when(found, NAME + number + variants("value", SHARED, ONE_SIDED) + variants("cosmetic", FINISH, OTHER_FINISH)).otherwise(NO_NAME)


def score(title: Column, item: Column) -> Column:
    return points(names_first_word(title, item["base"]), title, item)


def confidence(points: Column) -> Column:
    out = F.lit("none")
    for least, name in reversed(CONFIDENCE):
        out = F.when(points >= least, name).otherwise(out)
    return out


def fair_value(graded: Column, grade: Column, raw: Column, nine: Column, ten: Column) -> Column:
    """Struct (cents, kind) for a matched item: tens by psa10, nines by psa9, other grades by psa9 as an estimate, else raw."""
    n = grade.try_cast("double")
    usable = lambda x: F.coalesce(x, F.lit(0)) > 0
    value = lambda x, kind: F.struct(x.cast("bigint").alias("cents"), F.lit(kind).alias("kind"))
    return (
        F.when(graded & (grade == "10") & usable(ten), value(ten, "PSA 10"))
        .when(graded & (n >= 9) & usable(nine), value(nine, "PSA 9"))
        .when(graded & usable(nine), value(nine, "PSA 9 (estimate)"))
        .otherwise(value(F.coalesce(raw, F.lit(0)), "Raw"))
    )


def search_text(name: Column, set_name: Column) -> Column:
    """What to search for an item: game, base name, value tags as printed, set, number."""
    item = item_features(name)
    tags = F.regexp_extract_all(name, F.lit(r"\[(.*?)\]"), F.lit(1))
    printed = F.transform(item["value"], lambda v: F.element_at(F.concat(F.filter(tags, lambda t: F.contains(F.lower(t), v)), F.array(F.lit(""))), 1))
    clean_set = F.trim(F.regexp_replace(F.coalesce(set_name, F.lit("")), r"(?i)^Pokemon\s+", ""))
    parts = F.concat(F.array(F.lit("Pokemon"), item["base"]), printed, F.array(clean_set, F.coalesce(item["number"], F.lit(""))))
    return F.trim(F.regexp_replace(F.array_join(parts, " "), r"\s+", " "))


#: Copies of the index rows that every title of a base name meets; titles are dealt over them.
DEALT = 16


def _signature(number: Column, value: Column, cosmetic: Column) -> list[Column]:
    """What the score sees of a title or an item, as plain columns."""
    names = lambda kind: F.sort_array(F.array_distinct(kind))
    return [_plain(number).alias("number"), names(value).alias("value"), names(cosmetic).alias("cosmetic")]


def item_index(items: DataFrame) -> DataFrame:
    """(set_name, base, at, i_slug, i_number, i_value, i_cosmetic): the items that can be a title's best, by what the title must say to meet them.

    Items of one set and base name that say the same score the same, and the smallest slug wins, so one item stands for each signature. Of a number
    that differs from the title's only that it does matters: two items with different numbers stand for all of a variant signature. So a title
    meets its own number (``=number``), the items without one (``none``), and two others a signature (``other``); a title without a
    number meets one item a signature (``any``). A base name on a third of all items has no more candidates a title than its variants.
    """
    f = item_features(F.col("card_name"))
    own = items.where("set_name is not null").select("set_name", F.lower(f["base"]).alias("base"), F.col("card_slug").alias("slug"), *_signature(f["number"], f["value"], f["cosmetic"]))
    said = ["set_name", "base", "value", "cosmetic"]
    by_number = own.groupBy(*said, "number").agg(F.min("slug").alias("slug"))
    numbered = by_number.where("number is not null")
    first = numbered.groupBy(*said).agg(F.min(F.struct("slug", "number")).alias("a"))
    second = numbered.join(first, said).where(F.col("number") != F.col("a.number")).groupBy(*said).agg(F.min(F.struct("slug", "number")).alias("a"))
    form = lambda df, at, slug="slug", number="number": df.select("set_name", "base", at.alias("at"), F.col(slug).alias("i_slug"), F.col(number).alias("i_number"), F.col("value").alias("i_value"), F.col("cosmetic").alias("i_cosmetic"))
    anyone = by_number.groupBy(*said).agg(F.min("slug").alias("slug")).withColumn("number", F.lit(None).cast("string"))
    others = first.unionByName(second)
    return (
        form(numbered, F.concat(F.lit("="), F.col("number")))
        .unionByName(form(by_number.where("number is null"), F.lit("none")))
        .unionByName(form(others, F.lit("other"), "a.slug", "a.number"))
        .unionByName(form(anyone, F.lit("any")))
    )


def match_listings(searched: DataFrame, items: DataFrame, key: str = "listing_id", *, broadcast_rows: int = 200_000, known: DataFrame | None = None) -> DataFrame:
    """(key, title, searched_slug, card_slug, points, match_confidence, said): the best item of the searched one's set and base name; the searched item itself if there is none.

    ``searched`` has key, title, card_slug, card_name and set_name. Ties go to the smaller slug. Titles that say the same are scored once, against the
    ``item_index``. What is asked (title, name and set of the searched item) is shuffled once for its distinct rows, and read once. ``said`` are the title's
    features. Up to ``broadcast_rows`` distinct titles, names and sayings, counted, are broadcast back to the listings; of more, titles and names are
    read in each row, and sayings are joined by a shuffle.

    ``known`` has card_slug and other columns; what it has of the best item comes along as ``known``, an array of its rows or null. It is joined to the
    sayings and to the searched items, where listings are by item already, so listings aren't shuffled by the item they were matched to.
    """
    asked = checkpointed(searched.select("title", "card_name", "set_name").distinct())

    def read(rows: DataFrame, column: str, reader) -> DataFrame:
        """Of few different texts each is read once and they are broadcast; of many, each row's is read where the row is."""
        texts = asked.select(column).distinct()
        if texts.count() > broadcast_rows:
            return reader(rows)
        once = reader(texts.withColumnRenamed(column, "__text").withColumn(column, F.col("__text")))
        return rows.join(F.broadcast(once.drop(column)), F.col(column).eqNullSafe(F.col("__text"))).drop("__text")

    own = [] if known is None else ["own"]
    if known is not None:
        facts = known.groupBy("card_slug").agg(F.collect_list(F.struct(*[c for c in known.columns if c != "card_slug"])).alias("own"))
        searched = searched.join(facts, "card_slug", "left")
    left = read(read(searched.select(key, "title", "card_slug", "card_name", "set_name", *own), "title", _read_titles), "card_name", _read_names)
    left = _compared(left)
    same = ["set_name", "base", "found", "number", "value", "cosmetic"]
    sayings = _compared(_read_names(_read_titles(asked.where("set_name is not null")))).select(*same).distinct()
    meets = F.when(F.col("number").isNull(), F.array(F.lit("any"))).otherwise(F.array(F.concat(F.lit("="), F.col("number")), F.lit("none"), F.lit("other")))
    dealt = F.pmod(F.xxhash64("number", "value", "cosmetic"), F.lit(DEALT)).cast("int")
    index = item_index(items).withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))))
    met = sayings.withColumn("at", F.explode(meets)).withColumn("deal", dealt).join(index, ["set_name", "base", "at", "deal"])
    met = met.where((F.col("at") != "other") | (F.col("i_number") != F.col("number")))
    item = F.struct(F.col("i_number").alias("number"), F.col("i_value").alias("value"), F.col("i_cosmetic").alias("cosmetic"))
    scored = met.withColumn("points", points(F.col("found"), F.struct("number", "value", "cosmetic"), item))
    best = checkpointed(scored.groupBy(*same).agg(F.min_by(F.struct(F.col("i_slug").alias("slug"), "points"), F.struct((-F.col("points")).alias("p"), F.col("i_slug").alias("s"))).alias("b")))
    right = best.select(*[F.col(c).alias(f"b_{c}") for c in same], "b")
    if known is not None:
        right = right.join(facts.select(F.col("card_slug").alias("__slug"), F.col("own").alias("b_own")), F.col("b.slug") == F.col("__slug"), "left").drop("__slug")
    few = best.count() <= broadcast_rows
    equal = F.lit(True)
    for c in same:
        equal = equal & F.col(c).eqNullSafe(F.col(f"b_{c}"))
    out = left.join(F.broadcast(right) if few else right, equal, "left")
    # Worked out only for listings without another item: most have one.
    scored_own = points(F.col("found"), F.struct("number", "value", "cosmetic"), item_features(F.col("card_name")))
    n = F.coalesce("b.points", scored_own)
    said = _title_struct(F.col("title"), F.col("t_low"), F.col("t_number"), F.col("t_value"), F.col("t_cosmetic"))
    return out.select(key, "title", F.col("card_slug").alias("searched_slug"), F.coalesce("b.slug", "card_slug").alias("card_slug"), n.alias("points"), confidence(n).alias("match_confidence"), said.alias("said"), *[F.when(F.col("b.slug").isNull(), F.col("own")).otherwise(F.col("b_own")).alias("known") for _ in own])


def process_listings(raw: DataFrame, items: DataFrame, trends: DataFrame) -> DataFrame:
    """Listings as found (listing_id, card_slug, title, price, shipping, currency, marketplace, image, web_url) to stored rows.

    Junk titles, unreadable prices and listings without a match go; the item is the matched one, not the searched one. A title's features are worked out once.
    """
    fine = raw.where(~contains_any(F.col("title"), JUNK)).withColumn("price_cents", listing_cents(F.col("price"))).where("price_cents is not null and title <> ''")
    searched = fine.join(items.select("card_slug", "card_name", "set_name"), "card_slug")
    kept = F.struct("listing_id", "price_cents", F.coalesce(listing_cents(F.col("shipping")), F.lit(0).cast("bigint")).alias("shipping_cents"), F.coalesce("currency", F.lit("USD")).alias("currency"), "marketplace", "image", "web_url")
    trends = trends.select("card_slug", "current_raw", "current_psa9", "current_psa10")
    matched = match_listings(searched.withColumn("kept", kept), items, "kept", known=trends).where("match_confidence <> 'none'")
    out = matched.withColumn("fact", F.explode_outer("known")).select("*", "kept.*", "fact.*")
    said = F.col("said")
    condition = F.when(said["graded"] & said["grader"].isNotNull() & said["grade"].isNotNull(), F.concat_ws(" ", said["grader"], said["grade"])).when(said["graded"], "Graded").otherwise("Ungraded")
    value = fair_value(said["graded"], said["grade"], F.col("current_raw"), F.col("current_psa9"), F.col("current_psa10"))
    item = second_part(F.col("listing_id"))
    return out.select(
        "card_slug", "searched_slug", "marketplace", item.alias("ebay_item_id"), F.left("title", F.lit(500)).alias("title"), "price_cents", "currency", "shipping_cents",
        (F.col("price_cents") + F.col("shipping_cents")).alias("total_cost_cents"), condition.alias("condition"), larger_image(F.col("image")).alias("item_image_url"),
        item_url(F.col("marketplace"), item, F.col("web_url")).alias("item_web_url"), "match_confidence", "points", value["cents"].alias("fair_value_cents"), value["kind"].alias("fair_value_kind"),
    )


def match_counts(listings: DataFrame) -> DataFrame:
    """Listings by confidence, and how many were matched to another item than searched."""
    return listings.groupBy("match_confidence").agg(F.count("*").alias("n"), F.count_if(F.col("card_slug") != F.col("searched_slug")).alias("rematched"))
