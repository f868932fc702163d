"""Column expressions over text: slugs, numbers in names, addresses, titles, keys, vocabularies."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

PAGE_BASE = "https://www.pricecharting.com/game"


# -- slugs ---------------------------------------------------------------------------------------


def slug(text: Column, *, allow: str, drop: str = "", possessive: bool = False, trim_dashes: bool = False) -> Column:
    """Lower case; ``drop`` characters vanish; what isn't in the class ``allow`` vanishes; white space and dashes become one dash.

    ``possessive`` turns 's into s first, and drops other apostrophes.
    """
    s = F.lower(text)
    if possessive:
        s = F.replace(F.replace(s, F.lit("'s"), F.lit("s")), F.lit("'"), F.lit(""))
    if drop:
        s = F.translate(s, drop, "")
    s = F.regexp_replace(s, f"[^{allow}]", "")
    s = F.regexp_replace(F.regexp_replace(F.regexp_replace(s, r"^\s+|\s+$", ""), r"\s+", "-"), "-+", "-")
    return F.regexp_replace(s, "^-+|-+$", "") if trim_dashes else s


_LETTERS = r"a-z0-9\s"


def site_slug(name: Column) -> Column:
    """For the web site's own routes: letters, digits and dashes."""
    return slug(name, allow=_LETTERS + r"\-", trim_dashes=True)


def path_slug(name: Column) -> Column:
    """For stored page addresses: keeps ``&`` and ``'`` too."""
    return slug(name, allow=_LETTERS + r"\-&'", trim_dashes=True)


def import_slug(name: Column) -> Column:
    return slug(name, allow=_LETTERS + "-", possessive=True)


def image_slug(name: Column) -> Column:
    """Keeps every word character, of any script."""
    s = F.replace(F.replace(F.lower(name), F.lit("'s"), F.lit("s")), F.lit("'"), F.lit(""))
    s = F.regexp_replace(s, r"(?U)[^\w\s]", "")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(s, r"^\s+|\s+$", ""), r"\s+", "-"), "-+", "-")


def import_page_slug(name: Column) -> Column:
    return slug(name, allow=_LETTERS + "&")


def set_slug(name: Column) -> Column:
    """Only spaces change."""
    return F.replace(F.lower(name), F.lit(" "), F.lit("-"))


def article_slug(theme: Column, suffix: Column, day: Column) -> Column:
    tail = F.regexp_replace(F.replace(F.lower(suffix), F.lit(" "), F.lit("-")), "[^a-z0-9-]", "")
    return F.concat_ws("-", F.date_format(day, "yyyy-MM-dd"), theme, F.regexp_replace(F.regexp_replace(tail, "-+", "-"), "^-|-$", ""))


def page_url(console: Column, name: Column, base: str = PAGE_BASE) -> Column:
    """The address used for fetching: console without commas, name with ``&``, ``'`` and dashes."""
    console = F.regexp_replace(F.replace(F.replace(F.lower(console), F.lit(","), F.lit("")), F.lit(" "), F.lit("-")), "-+", "-")
    return F.concat(F.lit(base + "/"), console, F.lit("/"), slug(name, allow=_LETTERS + r"&'\-"))


def stored_page_url(console: Column, name: Column, base: str = PAGE_BASE) -> Column:
    return F.concat(F.lit(base + "/"), set_slug(console), F.lit("/"), path_slug(name))


def import_page_url(console: Column, name: Column, base: str = PAGE_BASE) -> Column:
    return F.concat(F.lit(base + "/"), set_slug(console), F.lit("/"), import_page_slug(name))


def bare_slug(card_slug: Column) -> Column:
    """Without the ``pc-`` prefix, which is stripped at the front only."""
    return F.regexp_replace(card_slug, "^pc-", "")


# -- numbers and kinds in names ------------------------------------------------------------------


def _empty_to_null(x: Column) -> Column:
    return F.when(x != "", x)


def trailing_number(name: Column) -> Column:
    """``#54a`` at the end gives 54a."""
    return _empty_to_null(F.regexp_extract(name, r"#([0-9]+[A-Za-z]*)\s*$", 1))


def any_number(name: Column) -> Column:
    """The first word after a ``#``."""
    return _empty_to_null(F.regexp_extract(name, r"(?U)#(\w+)", 1))


def expected_number(name: Column) -> Column:
    """Digits of a trailing number, letters dropped."""
    return _empty_to_null(F.regexp_extract(name, r"#([0-9]+)[A-Za-z]*\s*$", 1))


def display_number(number: Column, total: Column) -> Column:
    return F.when(number.isNotNull() & total.isNotNull() & (total.cast("string") != ""), F.concat_ws("/", number, total.cast("string")))


def contains_any(text: Column, keywords: tuple[str, ...] | list[str]) -> Column:
    """Whether the lower-cased text holds one of the literal keywords, also inside words."""
    # The text is bound to a variable first: inside the inner function it would be lower-cased again for every keyword.
    once = F.array(F.lower(F.coalesce(text, F.lit(""))))
    return F.exists(once, lambda low: F.exists(F.array(*map(F.lit, keywords)), lambda k: F.contains(low, k)))


def holds_any(low: Column, keywords: tuple[str, ...]) -> Column:
    """The same of a text that is lower-cased already and in a column of its own."""
    return reduce(or_, [F.contains(low, F.lit(k)) for k in keywords])


#: Keywords of sealed products at import.
IMPORT_SEALED = ("booster", "pack", "box", "blister", "bundle", "collection", "tin", "etb", "elite trainer", "build & battle", "build and battle", "case", "display")
#: Keywords of sealed products among the top items of a search.
SEARCH_SEALED = (
    "booster box", "booster pack", "blister pack", "elite trainer box", "etb", "theme deck", "starter deck", "tin ", "collection box",
    "premium collection", "vstar universe", "build & battle", "2-pack blister", "booster bundle", "garchomp c lv", "dialga lv", "sylveon collection",
)
#: Keywords of listings that are no single genuine English item.
JUNK = (
    "mystery", "repack", "custom", "proxy", "fake", "replica", "lot of", "bundle of", "bulk ", "empty box", "read descrip",
    "keyring", "keychain", "key ring", "key chain", "pin badge", "pin ", "sticker", "magnet", "playmat", "play mat", "sleeves", "deck box",
    "metal card", "metal pokemon", "gold metal", "gold plated", "gold card", "iron card", "display", "binder insert", "acrylic", "handmade",
    "extended art", "artwork case", "case only", "box only", "pick your card", "pick a card", "choose your card", "you pick", "u pick",
    "jumbo", "oversized", "coin", "topper", "no cards", "empty", "italian", "italiano", "ita ", " ita", "german", "deutsch", "deu ", " deu", "glurak",
    "french", "français", "francais", "spanish", "español", "espanol", "japanese", "japan", " jpn", "jpn ", "korean", " kor", "kor ",
    "chinese", "china", "portuguese", "portugues", "dutch", "nederlands", "polish", "polski",
)
#: Keywords of lots and of proxies among completed sales.
SALE_LOT = ("lot of", "bundle of", "x10", "x20", " repack", " mystery", "collection lot", "binder full")
SALE_PROXY = ("proxy", "replica", "fake ", " fake", "custom card", "custom print", "metal card", "metal pokemon", "gold metal", "gold plated")
#: Eras by the first group with a keyword in the set's name.
ERAS = (
    ("wotc", ("Base", "Jungle", "Fossil", "Rocket", "Gym", "Neo", "Skyridge", "Aquapolis")),
    ("ex", ("EX ", "FireRed", "Emerald", "Delta", "Legend")),
    ("mid", ("HeartGold", "Black", "White", "XY", "BW")),
    ("modern", ("Sun", "Moon", "Sword", "Shield")),
    ("recent", ("Scarlet", "Violet", "Paldea", "Paradox", "Obsidian", "Temporal", "Stellar")),
)


def era(set_name: Column) -> Column:
    """By case-sensitive keywords, in order; else ``other``."""
    out = F.lit("other")
    for name, keywords in reversed(ERAS):
        hit = F.exists(F.array(*map(F.lit, keywords)), lambda k: F.contains(set_name, k))
        out = F.when(hit, name).otherwise(out)
    return out


#: Languages that mark a variant as foreign.
FOREIGN_LANGUAGES = ("german", "french", "italian", "spanish", "portuguese", "korean", "japanese", "chinese", "dutch", "russian", "thai", "indonesian", "polish", "czech", "turkish")


def is_foreign(variant: Column, languages: tuple[str, ...] = FOREIGN_LANGUAGES) -> Column:
    """A language's name as a whole word, in any case."""
    return F.coalesce(F.rlike(variant, F.lit(rf"(?i)\b({'|'.join(languages)})\b")), F.lit(False))


# -- addresses -----------------------------------------------------------------------------------


def language_of_url(url: Column) -> Column:
    path = F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))
    return F.when(F.rlike(path, F.lit("(?i)^/game/jp-pokemon-")), "ja").when(F.rlike(path, F.lit("(?i)^/game/pokemon-")), "en").otherwise("unknown")


def clean_url(url: Column) -> Column:
    """Lower-case scheme and host with the path, without query and fragment; null unless it is http or https."""
    u = F.trim(url)
    return whole_url(*[F.coalesce(F.try_parse_url(u, F.lit(name)), F.lit("")) for name in ("PROTOCOL", "HOST", "AUTHORITY", "PATH")])


def whole_url(protocol: Column, host: Column, authority: Column, path: Column) -> Column:
    """``clean_url`` of an address that is taken apart already; missing parts are empty."""
    scheme = F.lower(protocol)
    return F.when(scheme.isin("http", "https") & (host != ""), F.concat(scheme, F.lit("://"), F.lower(authority), path))


def is_unsafe_url(url: Column) -> Column:
    """An address that is there but isn't http or https."""
    u = F.trim(F.coalesce(url, F.lit("")))
    return (u != "") & ~F.rlike(u, F.lit("(?i)^https?:"))


def host_of(url: Column) -> Column:
    return _empty_to_null(F.lower(F.coalesce(F.try_parse_url(F.trim(url), F.lit("HOST")), F.lit(""))))


#: Country of a marketplace's national hosts; the international host tells none.
HOST_COUNTRIES = {
    "ebay.co.uk": "GB", "ebay.de": "DE", "ebay.fr": "FR", "ebay.it": "IT", "ebay.es": "ES", "ebay.com.au": "AU", "ebay.ca": "CA", "ebay.ie": "IE", "ebay.at": "AT",
    "ebay.ch": "CH", "ebay.be": "BE", "ebay.nl": "NL", "ebay.pl": "PL", "ebay.com.hk": "HK", "ebay.com.sg": "SG", "ebay.com.my": "MY", "ebay.ph": "PH", "ebay.com.tw": "TW",
}
#: Hosts of the marketplaces.
HOST_MARKETPLACES = ((r"(^|\.)ebay\.[a-z.]+$", "ebay"), (r"(^|\.)tcgplayer\.com$", "tcgplayer"), (r"(^|\.)ha\.com$", "heritage_auctions"), (r"(^|\.)pwccmarketplace\.com$", "pwcc"), (r"(^|\.)pwcc\.com$", "pwcc"))


def lookup(values: Mapping[str, str], key: Column, default: str | None = None) -> Column:
    """A small fixed vocabulary as a map expression."""
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    found = F.try_element_at(table, F.coalesce(key, F.lit("")))
    return found if default is None else F.coalesce(found, F.lit(default))


def marketplace_of_host(host: Column) -> Column:
    out = F.lit(None).cast("string")
    for form, name in reversed(HOST_MARKETPLACES):
        out = F.when(F.rlike(host, F.lit(form)), name).otherwise(out)
    return out


def marketplace_country(marketplace: Column, host: Column) -> Column:
    return F.when(marketplace == "ebay", lookup(HOST_COUNTRIES, F.regexp_replace(host, r"^www\.", "")))


def item_url(marketplace: Column, item_id: Column, fallback: Column) -> Column:
    there = F.coalesce(item_id, F.lit("")) != ""
    return F.when(there & (marketplace == "EBAY_GB"), F.concat(F.lit("https://www.ebay.co.uk/itm/"), item_id)).when(there, F.concat(F.lit("https://www.ebay.com/itm/"), item_id)).otherwise(F.coalesce(fallback, F.lit("")))


def second_part(item_id: Column) -> Column:
    """``v1|123|0`` gives 123; ids without bars stay."""
    return F.coalesce(F.get(F.split(item_id, r"\|"), F.lit(1)), item_id)


def larger_image(url: Column) -> Column:
    return F.regexp_replace(url, r"s-l[0-9]+\.", "s-l500.")


# -- titles of completed sales -------------------------------------------------------------------


@F.pandas_udf(StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Compatibility normalisation, which has no built-in function."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def normal_title(title: Column) -> Column:
    return normal_form(nfkc(F.coalesce(title, F.lit(""))))


def normal_form(text: Column) -> Column:
    """The rest of ``normal_title``, for a text that is normalised already. Most titles are words with single spaces, which only change their case."""
    s = plain = F.lower(text)
    for form, to in ((r"(?U)^\s+|\s+$", ""), (r"(?U)\s+", " "), (r"(?U)\s*#\s*", " # "), (r"(?U)\s*/\s*", "/"), (r"(?U)\s+", " "), (r"^ | $", "")):
        s = F.regexp_replace(s, form, to)
    return F.when(F.rlike(plain, F.lit(r"[^!-~ ]|[#/]|  |^ | $")), s).otherwise(plain)


#: Condition buckets and the phrases that tell them, in order.
CONDITIONS = (
    ("near_mint", (" nm ", " nm/", "near mint", "near-mint")),
    ("lightly_played", (" lp ", "lightly played", "light play")),
    ("moderately_played", (" mp ", "moderately played")),
    ("heavily_played", (" hp ", "heavily played", "heavy play")),
    ("damaged", ("damaged", " dmg ", "poor condition", "creased", "water damage")),
)


def condition_bucket(title: Column, raw_or_graded: Column) -> Column:
    """The first bucket with a phrase in the title; a graded section overrules it, a raw one without any is ``raw_unknown``."""
    return condition_in(F.lower(F.coalesce(title, F.lit(""))), raw_or_graded)


def condition_in(low: Column, raw_or_graded: Column) -> Column:
    bucket = F.lit(None).cast("string")
    for name, phrases in reversed(CONDITIONS):
        bucket = F.when(holds_any(low, phrases), name).otherwise(bucket)
    return F.when(raw_or_graded == "graded", "graded").when(raw_or_graded == "raw", F.coalesce(bucket, F.lit("raw_unknown"))).otherwise(F.coalesce(bucket, F.lit("unknown")))


def first_edition(title: Column) -> Column:
    return F.when(F.rlike(title, F.lit(r"(?i)\b(1st edition|first edition|1st ed\.?)\b")), "first_edition").when(F.rlike(title, F.lit(r"(?i)\bunlimited\b")), "unlimited").otherwise("unknown")


def variant_text(title: Column) -> Column:
    """Bracketed texts joined by ``; ``, and Shadowless if only the title says so; null if neither."""
    bits = F.transform(F.regexp_extract_all(title, F.lit(r"\[([^\]]+)\]"), F.lit(1)), lambda b: F.trim(b))
    extra = F.rlike(title, F.lit(r"(?i)\bshadowless\b")) & ~F.exists(bits, lambda b: F.lower(b) == "shadowless")
    all_bits = F.when(extra, F.concat(bits, F.array(F.lit("Shadowless")))).otherwise(bits)
    return F.when(F.size(all_bits) > 0, F.array_join(all_bits, "; "))


def is_wrong_number(expected: Column, title: Column) -> Column:
    """The title's number is there and differs from the expected one; leading zeros and letters don't count."""
    hashed = _empty_to_null(F.regexp_extract(title, r"#([0-9]{1,4})", 1))
    slashed = _empty_to_null(F.regexp_extract(title, r"\b([0-9]{1,4})[A-Za-z]?/[0-9]{1,4}\b", 1))
    plain = lambda x: F.regexp_replace(x, r"^0+(?=.)", "")
    return F.coalesce(plain(F.coalesce(hashed, slashed)) != plain(_empty_to_null(expected)), F.lit(False))


def has_non_latin(title: Column) -> Column:
    """Japanese, Chinese or Korean characters."""
    return F.coalesce(F.rlike(title, F.lit("[\\u3040-\\u30FF\\u4E00-\\u9FFF\\u3400-\\u4DBF\\uAC00-\\uD7AF]")), F.lit(False))


# -- keys and vocabularies -----------------------------------------------------------------------


def sha_key(*parts: Column) -> Column:
    """SHA-256 of the parts joined by bars; null counts as empty text."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


#: Stored words for parsed ones.
BEST_OFFER = {"not_best_offer": "none", "accepted": "accepted", "unknown": "unknown"}
STORED_CONDITIONS = {
    "near_mint": "near_mint", "lightly_played": "lightly_played", "moderately_played": "played", "heavily_played": "played",
    "damaged": "poor", "graded": "unknown", "raw_unknown": "unknown", "unknown": "unknown",
}
IMPORT_SOURCES = {
    "recent_sales_pilot": "pilot", "recent_sales_scraper_nightly": "scraper_nightly", "recent_sales_admin_manual": "admin_manual", "recent_sales_backfill": "backfill",
    "pilot": "pilot", "scraper_nightly": "scraper_nightly", "admin_manual": "admin_manual", "backfill": "backfill",
}
RUN_STATUSES = ("running", "success", "partial", "failed")


def import_source(kind: Column) -> Column:
    """The stored source; an unknown kind fails the job."""
    return F.coalesce(lookup(IMPORT_SOURCES, kind), F.raise_error(F.concat(F.lit("unknown import type "), F.coalesce(kind, F.lit("null")))).cast("string"))


def run_status(status: Column) -> Column:
    return F.when(status.isin(*RUN_STATUSES), status).otherwise("failed")


def raw_or_graded(section: Column) -> Column:
    return F.when(section == "completed-auctions-used", "raw").when(F.startswith(section, F.lit("completed-auctions-")), "graded")


def count_cell(text: Column) -> Column:
    """A count in a table cell: dashes, blanks and anything unreadable are 0; thousands separators go."""
    return F.coalesce(F.translate(F.trim(text), ",", "").try_cast("bigint"), F.lit(0).cast("bigint"))


def report_count(text: Column) -> Column:
    """The same in a text report: dashes and blanks are 0, but what can't be read is null."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return F.when(t.isin("", "-", "–", "—"), F.lit(0).cast("bigint")).otherwise(F.translate(t, ",", "").try_cast("bigint"))


def gem_rate(tens: Column, total: Column) -> Column:
    from quillmark.functions.numbers import rounded

    return F.when(total > 0, rounded(tens / total * 100, 2)).otherwise(F.lit(0.0))
