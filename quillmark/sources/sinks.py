"""Writes: upsert, insert-only, day replacement, expiry, fill-nulls; and tables that are rewritten by buckets of a key.

Plain Parquet can't be updated in place. What changes is worked out first and checkpointed, then whole partitions are replaced.
"""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder that the session names; one of our own only where it names none."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(new_folder(df.sparkSession, "checkpoint"))
    return df.checkpoint(eager=True)


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path below the folder that driver and executors share; local sessions without one get a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


# -- new states of a table ------------------------------------------------------------------------


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with equal keys; one shuffle by key on each side, no window."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def inserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Only rows of ``new`` with unseen keys are added."""
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def unexpired(rows: DataFrame, as_of: dt.datetime, column: str = "scraped_at", days: int = 1) -> DataFrame:
    return rows.where(F.col(column) >= F.lit(as_of - dt.timedelta(days=days)))


def filled(old: DataFrame, new: DataFrame, key: str, columns: list[str], guard: str) -> DataFrame:
    """``columns`` take the new values only where ``guard`` is null."""
    side = new.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    j = old.join(side, key, "left")
    empty = F.col(guard).isNull()
    return j.select(*[F.when(empty, F.coalesce(F.col(f"__{c}"), F.col(c))).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in old.columns])


# -- tables in place ------------------------------------------------------------------------------


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The columns of ``schema`` under ``path``; no rows before the first write."""
    none = spark.createDataFrame([], schema)
    try:
        return spark.read.schema(schema).parquet(path).select(*none.columns)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return none


def merge_buckets(batch: DataFrame, path: str, schema: str, key: str, merge: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = 256) -> None:
    """Replace the buckets of ``key`` that ``batch`` touches by merge(their rows, batch); the others are neither read nor written.

    ``merge`` must give the same rows when it meets its own result, as a batch that fails while its partitions are replaced comes again.
    One writer at a time. A bucket of which nothing is left goes. Null keys share a bucket. The batch is computed once.
    """
    spark = batch.sparkSession
    bucket = F.coalesce(F.pmod(F.xxhash64(key), F.lit(buckets)), F.lit(0)).cast("int")
    batch = checkpointed(batch)
    touched = {r["bucket"] for r in batch.select(bucket.alias("bucket")).distinct().collect()}  # at most ``buckets``
    old = stored(spark, path, f"{schema}, bucket int").where(F.col("bucket").isin(*touched)).drop("bucket")
    rows = checkpointed(merge(old, batch).withColumn("bucket", bucket))
    kept = {r["bucket"] for r in rows.select("bucket").distinct().collect()}
    rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    for gone in touched - kept:
        remove(spark, f"{path}/bucket={gone}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete through Hadoop's file system, so that any shared store works; what isn't there is gone already."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def replace_day(rows: DataFrame, path: str, column: str = "as_of") -> None:
    """Replace the days that ``rows`` hold and keep all others: dynamic partition overwrite."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def truncate_and_load(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def export_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


STATUSES = ("ok", "quarantined", "rejected")


def run_row(spark: SparkSession, counts: dict[str, int], *, pages: int, started: dt.datetime, ended: dt.datetime, status: str, notes: dict[str, str] | None = None) -> DataFrame:
    """One audit row of a run with the numbers of rows by parse status. Built-in notes win over given ones of the same name; an unknown status is ``failed``."""
    from quillmark.functions.text import run_status

    ms = int((ended - started).total_seconds() * 1000)
    given = {str(k): str(v) for k, v in (notes or {}).items() if k not in ("pages", "duration_ms")}
    pairs = [F.lit(x) for item in {**given, "pages": str(pages), "duration_ms": str(ms)}.items() for x in item]
    rows = [F.lit(counts.get(s, 0)).cast("bigint").alias(f"rows_{s}") for s in STATUSES]
    return spark.range(1).select(run_status(F.lit(status)).alias("status"), F.lit(started).alias("started_at"), F.lit(ended).alias("completed_at"), F.lit(pages).cast("bigint").alias("pages_processed"), *rows, F.lit(ms).cast("bigint").alias("duration_ms"), F.to_json(F.create_map(*pairs)).alias("notes"))


def write_run(pages: DataFrame, parse: Callable[[DataFrame], DataFrame], path: str, *, started: dt.datetime, ended: dt.datetime | None = None, status: str = "success", notes: dict[str, str] | None = None) -> DataFrame:
    """Write the sales that ``parse`` finds in ``pages`` and return the run's audit row.

    Pages and rows are counted by the job that writes them; nothing is read a second time. A failed write raises, after which ``run_row``
    can say so with the counts that are known.
    """
    spark = pages.sparkSession
    seen, found = Observation(), Observation()
    sales = parse(pages.observe(seen, F.count("*").alias("pages")))
    counts = [F.count_if(F.col("parse_status") == s).alias(s) for s in STATUSES]
    sales.observe(found, *counts).write.mode("overwrite").parquet(path)
    return run_row(spark, found.get, pages=seen.get["pages"], started=started, ended=ended or dt.datetime.now(), status=status, notes=notes)
