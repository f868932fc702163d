"""Column expressions over numbers: rounding, changes, ratios, money, volumes.

Rounding is half up on the binary value, ``floor(x * 10**n + 0.5) / 10**n``, which any SQL engine can repeat.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

USD_PER_GBP_DIVISOR = 0.79
GBP_PER_USD_DIVISOR = 1.27


def rounded(x: Column, places: int = 0) -> Column:
    scale = F.lit(float(10**places))
    return F.floor(x.cast("double") * scale + F.lit(0.5)).cast("double") / scale


def _both(a: Column, b: Column) -> Column:
    return a.isNotNull() & b.isNotNull() & (a != 0) & (b != 0)


def pct_change(current: Column, old: Column) -> Column:
    """Change in per cent to one place; null where either side is null or zero."""
    return F.when(_both(current, old), rounded((current - old) / old * 100, 1))


def ratio(a: Column, b: Column) -> Column:
    """a / b to two places; null where either side is null or zero."""
    return F.when(_both(a, b), rounded(a / b, 2))


def variation(values: Column) -> Column:
    """Aggregate: sample deviation over mean to four places; null for fewer than two values or a zero mean."""
    mean = F.avg(values)
    return F.when(mean != 0, rounded(F.stddev_samp(values) / mean, 4))


def slope(y: Column, x: Column) -> Column:
    """Aggregate: least-squares slope to four places; null for fewer than two points or one x."""
    return rounded(F.regr_slope(y, x), 4)


def cents_to_dollars(cents: Column) -> Column:
    return rounded(F.coalesce(cents, F.lit(0)) / 100, 2)


def dollars_to_cents(dollars: Column) -> Column:
    return F.floor(dollars.cast("double") * 100 + F.lit(0.5)).cast("bigint")


_AMOUNT = r"(-?)\s*\$?\s*([0-9][0-9,]*(?:\.[0-9]+)?)"


def text_to_cents(text: Column) -> Column:
    """``$1,234.56`` to 123456; a leading minus is kept so that callers can reject it; null if there is no amount."""
    amount = F.replace(F.regexp_extract(text, _AMOUNT, 2), F.lit(","), F.lit("")).try_cast("decimal(20,4)")
    cents = F.round(amount * 100).cast("bigint")
    return F.when(F.regexp_extract(text, _AMOUNT, 1) == "-", -cents).otherwise(cents)


def listing_cents(text: Column) -> Column:
    """Whole cents of a listing's price, cut off, not rounded; null if it is no number."""
    return (text.try_cast("double") * 100).cast("bigint")


def usd_cents(cents: Column, currency: Column) -> Column:
    """GBP amounts in US cents, cut off; other currencies stay."""
    return F.when(currency == "GBP", (cents / F.lit(USD_PER_GBP_DIVISOR)).cast("bigint")).otherwise(cents)


def gbp_cents(usd: Column) -> Column:
    return (usd / F.lit(GBP_PER_USD_DIVISOR)).cast("bigint")


#: Period named in a volume text and its share of a month.
_PERIODS = (("per day", 30.0), ("per week", 4.33), ("per month", 1.0), ("per 2 year", 1 / 24), ("per year", 1 / 12))
#: Least monthly sales and their label.
_VOLUME_LABELS = (
    (60, "2 sales per day"), (30, "1 sale per day"), (17, "4 sales per week"), (12, "3 sales per week"), (8, "2 sales per week"),
    (4, "1 sale per week"), (3, "3 sales per month"), (2, "2 sales per month"),
)


def monthly_sales(text: Column) -> Column:
    """``3 sales per week`` and the like as sales a month, at least 1; null for anything else."""
    low = F.lower(F.trim(text))
    n = F.regexp_extract(low, r"([0-9]+(?:\.[0-9]+)?)\s+sales?", 1).try_cast("double")
    per = F.lit(None).cast("double")
    for name, share in reversed(_PERIODS):
        per = F.when(F.contains(low, F.lit(name)), n * share).otherwise(per)
    return F.when(per.isNotNull(), F.greatest(F.lit(1).cast("bigint"), rounded(per).cast("bigint")))


def volume_label(sales: Column) -> Column:
    out = F.lit("1 sale per month")
    for least, label in reversed(_VOLUME_LABELS):
        out = F.when(sales >= least, label).otherwise(out)
    return out


def volume_confidence(sales: Column) -> Column:
    return F.when(sales >= 8, "high").when(sales >= 3, "medium").otherwise("low")


def clamp(x: Column, low: float, high: float) -> Column:
    """x within bounds; a null x gives the upper bound, so test for null first."""
    return F.greatest(F.lit(low), F.least(F.lit(high), x))
