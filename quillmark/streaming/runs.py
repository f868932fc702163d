"""Running a stream over a table to its end, a slice of time after the other, as a scheduled job does."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.sources.sinks import new_folder
from quillmark.streaming.events import ROCKSDB


@contextmanager
def stateful(spark: SparkSession) -> Iterator[None]:
    """The session's state store is the one that stateful processors need; afterwards it is what it was."""
    before = {k: spark.conf.get(k, None) for k in ROCKSDB}
    try:
        for k, v in ROCKSDB.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def to_the_end(stream: DataFrame, sink: str, state: str, name: str) -> None:
    """All that has arrived, then stop. The next run goes on from the checkpoint under ``state``."""
    query = stream.writeStream.queryName(name).outputMode("append").format("parquet").option("path", sink).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()


def in_slices(rows: DataFrame, time: str, build: Callable[[DataFrame], DataFrame], name: str, slices: int = 3) -> DataFrame:
    """What the stream ``build`` makes of ``rows`` when they arrive in ``slices`` equal stretches of ``time``, each met by a run of its own.

    Arrivals, state, checkpoint and output are in the shared folder. A slice reads only its stretch of the table. Rows without a time
    arrive first. An empty table gives an empty result.
    """
    spark = rows.sparkSession
    folder = new_folder(spark, f"stream-{name}")
    low, high = rows.agg(F.min(F.unix_micros(time)), F.max(F.unix_micros(time))).first()
    bounds = [] if low is None else [low + (high - low) * k // slices for k in range(1, slices)]
    arrivals, sink = f"{folder}/in", f"{folder}/out"
    edge = lambda us: F.timestamp_micros(F.lit(us).cast("bigint"))
    out = None
    with stateful(spark):
        for k in range(len(bounds) + 1):
            part = rows if k == 0 else rows.where(F.col(time) >= edge(bounds[k - 1]))
            if k < len(bounds):
                part = part.where((F.col(time) < edge(bounds[k])) | F.col(time).isNull() if k == 0 else F.col(time) < edge(bounds[k]))
            part.write.mode("append").parquet(arrivals)
            stream = build(spark.readStream.schema(rows.schema).parquet(arrivals))
            out = stream.schema
            to_the_end(stream, sink, f"{folder}/state", f"{name}-{k}")
    return spark.read.schema(out).parquet(sink)
