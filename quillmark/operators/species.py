"""Which species an item's name mentions, and statistics by species."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.sources.sinks import checkpointed

MAX_WORDS = 3
#: Names that the equi-join finds: up to MAX_WORDS letter runs with marks between them that the rule takes as they stand (or, a hyphen, as a space too).
SIMPLE = rf"^[a-z]+([^a-z \\^$|?*+()\[\]{{}}]+[a-z]+){{0,{MAX_WORDS - 1}}}$"
#: Signs by which a name is a pattern and not a text, as the rule takes it.
PATTERN = r"[\\^$|?*+()\[\]{}]"
#: Length of the beginnings by which other names are found.
BEGINNING = 4


def _spaced(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit("-"), F.lit(" "))


def _stretched(cards: DataFrame, species: DataFrame) -> DataFrame:
    """Names of letter runs by an equi-join on an item's stretches of runs."""
    plain = _spaced(F.col("card_name"))
    runs = F.regexp_extract_all(plain, F.lit(r"[a-z]+"), F.lit(0))
    marks = F.split(plain, r"[a-z]+", -1)

    def stretch(n: int):
        last = F.greatest(F.size(runs) - n, F.lit(-1))
        one = lambda i: F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.when(k == 0, F.array(F.get(runs, i))).otherwise(F.array(F.get(marks, i + k), F.get(runs, i + k))))), "")
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), one)).otherwise(F.array().cast("array<string>"))

    stretches = F.array_distinct(F.concat(*[stretch(n) for n in range(1, MAX_WORDS + 1)]))
    exploded = cards.select("card_slug", F.explode(stretches).alias("key"))
    return exploded.join(species.select("name", _spaced(F.col("name")).alias("key")), "key").select("card_slug", "name")


def _begun(cards: DataFrame, species: DataFrame) -> DataFrame:
    """Names of any characters, by an equi-join of their beginnings with those of the places of an item's name where a match can begin.

    It is the first level of a trie over all names. A place follows anything but a letter. At a place the rest of the name is compared
    as text; nothing is compared with all names, however many there are.
    """
    low = F.lower("card_name")
    letter = lambda c: F.coalesce(c.between("a", "z"), F.lit(False))
    places = F.filter(F.sequence(F.lit(1), F.greatest(F.char_length(low), F.lit(1))), lambda i: ~letter(F.substr(low, F.greatest(i - 1, F.lit(1)), F.lit(1))) | (i == 1))
    at = cards.where(F.char_length("card_name") > 0).select("card_slug", low.alias("low"), F.explode(places).alias("i"))
    keys = F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(BEGINNING)), lambda n: F.struct(n.alias("n"), F.substr(F.col("plain"), F.col("i"), n).alias("key"))))
    begun = at.withColumn("plain", F.replace("low", F.lit("-"), F.lit(" "))).withColumn("k", F.explode(keys)).where(F.char_length("k.key") == F.col("k.n")).select("card_slug", "low", "plain", "i", F.col("k.key").alias("key"))
    names = species.select("name", F.lower("name").alias("said"), _spaced(F.col("name")).alias("want"), F.left(_spaced(F.col("name")), F.lit(BEGINNING)).alias("key"))
    met = begun.join(names, "key").where(F.substr("plain", F.col("i"), F.char_length("want")) == F.col("want"))
    # A space in a name is a space only; hyphens were read as spaces on both sides.
    here = F.substr("low", F.col("i"), F.char_length("want"))
    strict = F.forall(F.sequence(F.lit(1), F.greatest(F.char_length("said"), F.lit(1))), lambda k: (F.substr("said", k, F.lit(1)) != " ") | (F.substr(here, k, F.lit(1)) == " "))
    ends = ~letter(F.substr("low", F.col("i") + F.char_length("want"), F.lit(1)))
    return met.where(ends & (~F.contains("said", F.lit(" ")) | strict)).select("card_slug", "name")


def _patterned(cards: DataFrame, names: list[str]) -> DataFrame:
    """Names with signs of the pattern language, as patterns, all in one pass over the items."""
    form = lambda n: "(?<![a-z])" + n.lower().replace("-", "[- ]").replace(".", "\\.") + "(?![a-z])"
    found = F.array_compact(F.array(*[F.when(F.rlike(F.lower("card_name"), F.lit(form(n))), F.lit(n)) for n in names]))
    return cards.select("card_slug", F.explode(found).alias("name"))


def mentions(cards: DataFrame, species: DataFrame, *, max_patterns: int = 200, broadcast_names: int = 100_000) -> DataFrame:
    """(card_slug, name): the names that an item's name holds, in any case, with no letter next to them; a hyphen also matches a space.

    Most species names are letters and marks between them (``SIMPLE``). An item's name yields every stretch of up to ``MAX_WORDS`` letter runs with
    the marks as they stand, and equal stretches, hyphens read as spaces, are exactly the matches. Other names (``porygon2``, with a space, with more
    runs) are found by their beginnings. Names with signs of the pattern language, of which there may be ``max_patterns``, are patterns.
    An empty name is in no item. Up to ``broadcast_names`` distinct names, counted, are broadcast to the items' stretches, so a word that a third of
    all items hold doesn't bring these together in one task.
    """
    species = checkpointed(species.where("name <> ''").select("name").distinct())
    species = F.broadcast(species) if species.count() <= broadcast_names else species
    plain, pattern = F.lower("name").rlike(SIMPLE), F.col("name").rlike(PATTERN)
    patterns = [r["name"] for r in species.where(pattern & ~plain).limit(max_patterns + 1).collect()]
    if len(patterns) > max_patterns:
        raise ValueError(f"more than {max_patterns} names are patterns")
    own = cards.select("card_slug", "card_name")
    found, others = _stretched(own, species.where(plain)), species.where(~plain & ~pattern)
    found = found if others.isEmpty() else found.unionByName(_begun(own, others))
    return (found.unionByName(_patterned(own, sorted(patterns))) if patterns else found).distinct()


def species_stats(cards: DataFrame, species: DataFrame, prices: DataFrame) -> DataFrame:
    """Items and highest raw price by species; species without items don't appear."""
    best = prices.groupBy("card_slug").agg(F.max(F.when(F.col("raw_usd") > 0, F.col("raw_usd"))).alias("raw"))
    # A pair of item and name is one row, and an item has one price, so rows are counted.
    j = mentions(cards, species).join(best, "card_slug", "left")
    return j.groupBy("name").agg(F.count("card_slug").alias("card_count"), F.max("raw").alias("max_raw_usd"))
