"""Scraping cohorts, balanced batches, rotation slices and streaks of attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Cohorts, their rhythm, categories of attempts and what they do to a streak.
COHORTS = ("DAILY_VALUE", "WEEKLY_LOW", "DAILY_DISCOVERY", "WEEKLY_UNPRICED")
RHYTHMS = {"daily": ("DAILY_VALUE", "DAILY_DISCOVERY"), "weekly": ("WEEKLY_LOW", "WEEKLY_UNPRICED"), "all": COHORTS}
CATEGORIES = ("priced", "page_reached_no_price", "not_found", "transient_http_failure", "timeout", "incorrect_product_rejected")
TRANSIENT = ("transient_http_failure", "timeout")
REACHED = ("priced", "page_reached_no_price")
VALUE_CENTS, UNPRICED_STREAK = 200, 3


def cohort(price: Column, category: Column, streak: Column) -> Column:
    return (
        F.when(price >= VALUE_CENTS, COHORTS[0])
        .when(price > 0, COHORTS[1])
        .when(category.isin(*TRANSIENT), COHORTS[2])
        .when(streak >= UNPRICED_STREAK, COHORTS[3])
        .otherwise(COHORTS[2])
    )


def cohorts(cards: DataFrame, trends: DataFrame, attempts: DataFrame) -> DataFrame:
    """Cards with price, last category, streak and cohort; either side may lack a card."""
    prices = trends.select("card_slug", F.col("current_raw").alias("price"))
    state = prices.join(attempts.select("card_slug", "last_result_category", "no_price_streak"), "card_slug", "full_outer")
    j = cards.join(state, "card_slug", "left").withColumn("no_price_streak", F.coalesce("no_price_streak", F.lit(0)))
    return j.withColumn("cohort", cohort(F.col("price"), F.col("last_result_category"), F.col("no_price_streak")))


def due(with_cohort: DataFrame, rhythm: str) -> DataFrame:
    """Cards of a rhythm: daily, weekly or all."""
    if rhythm not in RHYTHMS:
        raise ValueError(f"unknown cadence {rhythm!r}; expected one of {sorted(RHYTHMS)}")
    return with_cohort.where(F.col("cohort").isin(*RHYTHMS[rhythm]))


def cohort_counts(with_cohort: DataFrame) -> DataFrame:
    """Cards by cohort, empty cohorts too."""
    all_cohorts = with_cohort.sparkSession.createDataFrame([(c,) for c in COHORTS], "cohort string")
    counted = with_cohort.groupBy("cohort").agg(F.count("*").alias("n"))
    return all_cohorts.join(counted, "cohort", "left").select("cohort", F.coalesce("n", F.lit(0)).alias("n"))


def pack_batches(counts: DataFrame, batches: int) -> DataFrame:
    """(language, name, n, batch): the largest set goes to the lightest batch; names break ties; a language's batches are its own.

    A fold over a language's sorted sets: the state is the load of every batch, and each set takes the first of the lightest. ``counts`` has one row
    a set: thousands of rows however many cards there are.
    """
    one = F.struct((-F.col("n")).alias("order"), F.col("name"), F.col("n"))
    sets = counts.select("language", "name", F.col("n").cast("bigint").alias("n")).groupBy("language").agg(F.array_sort(F.collect_list(one)).alias("sets"))
    start = F.struct(F.array_repeat(F.lit(0).cast("bigint"), batches).alias("loads"), F.array().cast("array<int>").alias("dealt"))

    def put(state: Column, one_set: Column) -> Column:
        to = (F.array_position(state["loads"], F.array_min(state["loads"])) - 1).cast("int")
        return F.struct(F.transform(state["loads"], lambda load, k: load + F.when(k == to, one_set["n"]).otherwise(0)).alias("loads"), F.concat(state["dealt"], F.array(to)).alias("dealt"))

    dealt = sets.withColumn("dealt", F.aggregate("sets", start, put, lambda state: state["dealt"]))
    return dealt.select("language", F.explode(F.arrays_zip("sets", "dealt")).alias("s")).select("language", "s.sets.name", "s.sets.n", F.col("s.dealt").alias("batch"))


def slices(rows: DataFrame, order: str, parts: int, part: int) -> DataFrame:
    """Part ``part`` (from 0) of ``parts`` contiguous slices of ``len // parts + 1`` rows."""
    size = rows.count() // parts + 1
    ranked = with_position(rows, [F.col(order)])
    return ranked.where((F.col("position") >= part * size) & (F.col("position") < (part + 1) * size)).drop("position")


def with_position(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Global position from 0 without sorting in one task: ranges are sorted on their own and shifted by the counts before them."""
    from quillmark.sources.sinks import checkpointed

    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id() % (1 << 33))
    dealt = checkpointed(dealt)
    sizes = dealt.groupBy("__part").agg(F.count("*").alias("__n"))
    before = sizes.alias("a").join(sizes.alias("b"), F.col("b.__part") < F.col("a.__part"), "left").groupBy(F.col("a.__part").alias("__part")).agg(F.coalesce(F.sum("b.__n"), F.lit(0)).alias("__before"))
    return dealt.join(F.broadcast(before), "__part").withColumn("position", F.col("__before") + F.col("__i")).drop("__part", "__i", "__before")


def rotation_slice(ids: DataFrame, offset: int, size: int, column: str = "provider_card_id") -> DataFrame:
    """(id, position, number): ids by number if all are digits, else by text; from ``offset mod n``, no wrap inside the slice; number counts from 1."""
    own = ids.select(F.col(column).cast("string").alias(column)).distinct()
    n, digits = own.agg(F.count("*"), F.coalesce(F.min(F.rlike(column, F.lit("^[0-9]+$"))), F.lit(False))).first()
    if not n:
        return own.withColumn("position", F.lit(0).cast("bigint")).withColumn("number", F.lit(0).cast("bigint"))
    order = [F.char_length(F.regexp_replace(column, "^0+(?=.)", "")), F.regexp_replace(column, "^0+(?=.)", ""), F.col(column)] if digits else [F.col(column)]
    start = offset % n
    found = with_position(own, order).where((F.col("position") >= start) & (F.col("position") < start + size))
    return found.withColumn("position", F.col("position").cast("bigint")).withColumn("number", (F.col("position") - start + 1).cast("bigint"))


def attempt_category(fetch: Column, has_price: Column) -> Column:
    """An attempt's category from the fetch result and whether a price was found."""
    return F.when((fetch == "ok") & has_price, "priced").when(fetch == "ok", "page_reached_no_price").otherwise(fetch)


def checked_category(category: Column) -> Column:
    return F.when(category.isin(*CATEGORIES), category).otherwise(F.raise_error(F.concat(F.lit("invalid attempt category "), F.coalesce(category, F.lit("null")))))


def streaks(attempts: DataFrame, prior: DataFrame | None = None, order: tuple[str, ...] = ("attempted_at",)) -> DataFrame:
    """Final state per card of a batch of attempts: streak of reached pages without price since the last price, last category, last reach.

    A priced attempt resets, a reached page without price adds one, others carry. ``prior`` (card_slug, no_price_streak and whatever else is
    stored) gives the streak when the batch has no priced attempt, and every field for which the batch has nothing new. One aggregate: the streak is
    the number of unpriced pages after the last priced attempt. Cards that only ``prior`` has are not returned.
    """
    at = F.struct(*order)
    last_priced = F.max(F.when(F.col("category") == "priced", at)).over(W.partitionBy("card_slug"))
    status = F.col("http_status") if "http_status" in attempts.columns else F.lit(None)
    rows = attempts.withColumn("category", checked_category(F.col("category"))).withColumn("__status", status.cast("bigint")).withColumn("__last", last_priced)
    after = F.col("__last").isNull() | (at > F.col("__last"))
    out = rows.groupBy("card_slug").agg(
        F.count(F.when((F.col("category") == "page_reached_no_price") & after, 1)).alias("n"),
        F.max(F.col("__last").isNotNull()).alias("priced"),
        F.max_by("category", at).alias("last_result_category"),
        F.max_by("__status", F.when(F.col("__status").isNotNull(), at)).alias("last_http_status"),
        F.max("attempted_at").alias("last_attempted_at"),
        F.max(F.when(F.col("category").isin(*REACHED), F.col("attempted_at"))).alias("last_successful_fetch_at"),
    )
    kept = {"no_price_streak": "bigint", "last_http_status": "bigint", "last_successful_fetch_at": "timestamp"}
    stored = [(F.col(c) if prior is not None and c in prior.columns else F.lit(None)).cast(t).alias(f"__{c}") for c, t in kept.items()]
    out = out.select("*", *stored) if prior is None else out.join(prior.select("card_slug", *stored), "card_slug", "left")
    streak = F.col("n") + F.when(F.col("priced"), 0).otherwise(F.coalesce("__no_price_streak", F.lit(0)))
    newer = lambda c: F.coalesce(c, f"__{c}").alias(c)
    return out.select("card_slug", streak.cast("bigint").alias("no_price_streak"), "last_result_category", newer("last_http_status"), "last_attempted_at", newer("last_successful_fetch_at"))
