"""Line dedup over levelled sorted runs of line hashes, in DataFrame operations only.

Documents are taken in batches of descending ``doc_id``, cut at quantiles of the ids. The first pass turns every batch into one row per line
key, with the number of its documents in the batch and the largest document. ``LineRuns`` then admits the batches one after the other. A
batch is merge-joined with the runs that are there: its keys found in none of them (the anti-joined part) become a new run with
their holder, sorted by the key's hash; of the others only the counts are kept, apart from the runs. So every key stands in one run
only, and the runs are never aggregated again. Whenever a level has ``fanout`` runs they are compacted into one run of
the next level, so a store of n batches has about fanout * log(n) runs.

As batches descend, the holder that a key's run names is the largest document with it. Keys in at least ``min_docs`` documents lose all
lines but the holder's. Hot lines are counted by partial aggregates before any shuffle, and the join of lines with such
keys has one row a key on the other side, so adaptive execution may split a hot key.

Defined results: a null or empty text is one empty line. A text whose lines all go becomes empty. Rows that repeat a
doc_id count as documents of their own, but all rows under the holder's id keep the line. A null doc_id ranks below all
others. Keys are compared by 128 bits of hash. An empty table gives no rows. Input columns named ``n_lines`` or ``n_dropped`` are replaced;
others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm.shared import SPACES, ascii_lower, checkpointed, hash_pair, new_folder, remove_folder, without

_LOWEST = -(2**63)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def _keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc) for every long line key of every document row, once a row."""
    keys = F.array_distinct(F.filter(F.transform(_lines(F.col("text")), line_key), lambda k: F.char_length(k) >= min_chars))
    exploded = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST)).alias("doc"), F.explode(keys).alias("key"))
    h1, h2 = hash_pair(F.col("key"))
    return exploded.select("doc", h1.alias("h1"), h2.alias("h2"))


class LineRuns:
    """Sorted runs (h1, h2, n, holder) in levels and the later counts of their keys, as Parquet in the shared folder. No key is in two runs."""

    def __init__(self, spark: SparkSession, fanout: int = 3):
        self.spark, self.fanout, self.path = spark, fanout, new_folder(spark, "line-runs")
        self.levels: list[list[str]] = []
        self.counts: list[str] = []
        self.made = 0

    def _write(self, rows: DataFrame) -> str:
        self.made += 1
        path = f"{self.path}/run-{self.made:06d}"
        rows.write.parquet(path)
        return path

    def _read(self, paths: list[str], columns: str) -> DataFrame:
        return self.spark.read.schema(columns).parquet(*paths)

    def _sorted(self, run: DataFrame) -> DataFrame:
        return run.repartition("h1").sortWithinPartitions("h1", "h2")

    def runs(self) -> list[str]:
        return [p for level in self.levels for p in level]

    def admit(self, batch: DataFrame) -> None:
        """Merge-anti-join the batch (h1, h2, n, holder) with all runs: new keys are a run, known ones add to the counts."""
        old = self.runs()
        if not old:
            self._add(self._write(self._sorted(batch)), 0)
            return
        there = self._read(old, "h1 long, h2 long").withColumn("known", F.lit(True))
        # One merge join, written once, serves both parts; each is read back by its folder.
        met = batch.join(there.hint("merge"), ["h1", "h2"], "left").withColumn("known", F.coalesce("known", F.lit(False)))
        self.made += 1
        path = f"{self.path}/met-{self.made:06d}"
        met.write.partitionBy("known").parquet(path)
        met = self.spark.read.schema("h1 long, h2 long, n long, holder long, known boolean").parquet(path)
        self._add(self._write(self._sorted(met.where(~F.col("known")).select("h1", "h2", "n", "holder"))), 0)
        self.counts.append(self._write(met.where("known").select("h1", "h2", "n")))
        remove_folder(self.spark, path)

    def _add(self, path: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            merged = self._write(self._sorted(self._read(full, "h1 long, h2 long, n long, holder long")))
            for p in full:
                remove_folder(self.spark, p)
            self._add(merged, level + 1)

    def repeated(self, min_docs: int) -> DataFrame:
        """(h1, h2, holder) of the keys of at least ``min_docs`` documents."""
        runs = self._read(self.runs(), "h1 long, h2 long, n long, holder long")
        if not self.counts:
            return runs.where(F.col("n") >= min_docs).select("h1", "h2", "holder")
        later = self._read(self.counts, "h1 long, h2 long, n long").groupBy("h1", "h2").agg(F.sum("n").alias("later"))
        return runs.join(later, ["h1", "h2"], "left").where(F.col("n") + F.coalesce("later", F.lit(0)) >= min_docs).select("h1", "h2", "holder")

    def drop(self) -> None:
        remove_folder(self.spark, self.path)


def repeated_keys(docs: DataFrame, *, min_chars: int = 40, min_docs: int = 5, batches: int = 4, fanout: int = 3) -> DataFrame:
    """(h1, h2, holder) of the keys found in at least ``min_docs`` documents."""
    spark = docs.sparkSession
    ids = docs.select(F.col("doc_id").cast("long").alias("doc"))
    cuts = ids.agg(F.percentile_approx("doc", [k / batches for k in range(1, batches)])).first()[0] or []
    # Batch 0 has the largest ids; null ids come last. All rows of one id are in one batch.
    batch = F.lit(0)
    for cut in cuts:
        batch = batch + F.when(F.col("doc") <= cut, 1).otherwise(0)
    staged = new_folder(spark, "line-batches")
    counted = _keys(docs, min_chars).groupBy(batch.alias("batch"), "h1", "h2").agg(F.count("*").alias("n"), F.max("doc").alias("holder"))
    counted.write.partitionBy("batch").parquet(staged)
    runs = LineRuns(spark, fanout)
    for k in range(batches):
        runs.admit(spark.read.schema("h1 long, h2 long, n long, holder long, batch int").parquet(staged).where(F.col("batch") == k).drop("batch"))
    found = checkpointed(runs.repeated(min_docs))
    runs.drop()
    remove_folder(spark, staged)
    return found


def dedup_lines(docs: DataFrame, *, min_chars: int = 40, min_docs: int = 5, batches: int = 4, fanout: int = 3) -> DataFrame:
    """``docs`` with ``text`` reduced to the lines that stay, plus n_lines and n_dropped."""
    docs = without(docs, "n_lines", "n_dropped", "__doc", "__gone")
    repeated = repeated_keys(docs, min_chars=min_chars, min_docs=min_docs, batches=batches, fanout=fanout)
    gone = _keys(docs, min_chars).join(repeated, ["h1", "h2"]).where(F.col("doc") != F.col("holder"))
    gone = gone.groupBy(F.col("doc").alias("__doc")).agg(F.collect_set(F.struct("h1", "h2")).alias("__gone"))
    joined = docs.withColumn("__doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST))).join(gone.hint("shuffle_hash"), "__doc", "left")
    lines = _lines(F.col("text"))
    kept = F.when(F.col("__gone").isNull(), lines).otherwise(F.filter(lines, lambda x: (F.char_length(line_key(x)) < min_chars) | ~F.array_contains(F.col("__gone"), F.struct(*[h.alias(n) for n, h in zip(("h1", "h2"), hash_pair(line_key(x)), strict=True)]))))
    out = joined.withColumn("__lines", lines).withColumn("__kept", kept)
    return out.select(
        *[F.array_join("__kept", "\n").alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size("__kept")).cast("long").alias("n_dropped"),
    )
