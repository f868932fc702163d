"""Helpers that several training-data operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Characters the contracts call white space.
SPACES = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or one of our own where a local session leaves that unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint; lost executors then cost a re-read, not a recomputation."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


class Tables:
    """Intermediate tables of one run, written to the shared folder and read again.

    Iterative jobs use them instead of checkpoints: a checkpoint keeps the size estimate of the plan that it replaces, which
    every join multiplies, until planning takes longer than the work. A table's size is that of its files, and small ones
    are read by few tasks.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self.made = spark, new_folder(spark, name), 0

    def keep(self, df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
        """The table, and metrics that the writing job observes: no second pass, nothing else reaches the driver."""
        self.made += 1
        path, seen = f"{self.path}/{self.made:04d}", Observation()
        (df.observe(seen, *[m.alias(n) for n, m in metrics.items()]) if metrics else df).write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), seen.get if metrics else {}

    def drop(self) -> None:
        remove_folder(self.spark, self.path)


def join_counted(left: DataFrame, right: DataFrame, on: str | list[str], how: str, rows: int, most: int) -> DataFrame:
    """``right`` has at most ``rows`` rows: it is broadcast within ``most`` rows, and joined by shuffle beyond."""
    return left.join(F.broadcast(right) if rows <= most else right, on, how)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/quillmark/{name}-{uuid.uuid4().hex}"


def make_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(where)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete through Hadoop's file system, so that any shared store works."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def hash_pair(value: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes with different seeds: 128 bits name a string for all practical purposes."""
    return F.xxhash64(value), F.xxhash64(F.lit("second"), value)


def held_out(doc_id: Column) -> Column:
    """The fold that training must not read: crc32 of the id as text leaves remainder 1 modulo 3. A null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(3)) == 1


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop input columns whose names an operator is about to add (names compare as Spark does, ignoring case)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])
