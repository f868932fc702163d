"""Price history stored by date, and reading it at anchor days only."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_history(prices: DataFrame, path: str, column: str = "date") -> None:
    """A folder a day. Rows are rebalanced by day, so small days are one file and a large one is split."""
    prices.hint("rebalance", column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def read_history(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if columns is None else df.select("date", *columns)


def anchor_days(history: DataFrame, as_of: dt.date, horizons: dict[str, int], fallback: tuple[str, int, int] | None = None) -> DataFrame:
    """(kind, date): for each horizon the newest day of the data that is at least so many days before ``as_of``.

    ``fallback`` (horizon, from, to) adds the days between so many days before as kind ``near``, without that horizon's own anchor and only if it has one.
    Only the partition column is read, and the table has a row a horizon and a day of the fallback at most.
    """
    before = lambda n: as_of - dt.timedelta(days=n)
    newest = [F.max(F.when(F.col("date") <= F.lit(before(n)), F.col("date"))).alias(f"at_{h}") for h, n in horizons.items()]
    horizon, low, high = fallback or (next(iter(horizons)), 0, 0)
    near = F.collect_set(F.when(F.col("date").between(F.lit(before(low)), F.lit(before(high))), F.col("date"))).alias("near")
    found = history.select("date").where(F.col("date") <= F.lit(as_of)).agg(*newest, near)
    kinds = F.array(*[F.struct(F.lit(h).alias("kind"), F.col(f"at_{h}").alias("date")) for h in horizons])
    others = F.transform(F.filter("near", lambda d: d != F.col(f"at_{horizon}")), lambda d: F.struct(F.lit("near").alias("kind"), d.alias("date")))
    return found.select(F.explode(F.concat(kinds, others) if fallback else kinds).alias("a")).select("a.kind", "a.date").where(F.col("date") <= F.lit(as_of))


def on_anchor_days(history: DataFrame, days: DataFrame) -> DataFrame:
    """Rows of the history at ``days`` (``anchor_days``, tens of rows), with their kind. The broadcast days prune partitions before files are opened."""
    return history.join(F.broadcast(days), "date")
