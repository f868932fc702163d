"""Toxicity by the nearest labelled examples under exact TF-IDF cosine, found in a block-max inverted index.

Terms are a text's words and the leading ``stem`` characters of longer words. Labelled rows outside the held-out fold,
at most about ``max_examples`` by a hash of the id, are the examples, toxic and clean ones. Every term of an example is in the
vocabulary, and texts are normalised over all their terms in it. A term weighs tf * idf * delta: its inverse document frequency is
counted over all documents, by partial counts in tasks, and its delta is the difference between its (smoothed) document frequencies among toxic
and clean examples on a log scale ("Delta TF-IDF"), which lets a few telling words outweigh a long text's topic. ``smooth`` imagined examples
of the usual make-up keep rare terms' deltas small; no term is left out.

The index keeps the examples in blocks of neighbours in kind. Short lists of postings are summed for all examples. The long lists, those of terms
in more than one of ``1 / frequent`` examples, are not gone through: their largest weight in each block bounds what they can add. The
examples with the largest bounds are scored in full first and after them only those whose bound reaches the k-th best cosine, so the k
nearest are exact. They vote with the square of their cosine. Votes are calibrated by a
monotone step function fitted to the examples' own leave-one-out votes. A text that shares no term with any example gets the share of toxic ones
among examples without a term, drawn towards that among all. ``evidence`` names the neighbours.

The number of examples doesn't grow with the input; scoring reads every whole text and shuffles nothing.

Defined results: a null or empty text has no terms. Null labels don't count; where a document has several, toxic wins. Without any label, as in
empty tables, the score is 0. Ties between examples go to the smaller doc_id. Repeated rows are scored alike. Input columns with
the names of result columns are replaced; others stay.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Collection, Iterator
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmark.llm.shared import checkpointed, held_out, without

_WORD = re.compile(r"[^\W\d_]+")
EVIDENCE = "array<struct<doc_id:bigint,cosine:double,toxic:int>>"


def words(text: str | None) -> Counter:
    return Counter(_WORD.findall(text.lower())) if text else Counter()


def with_stems(counted: Counter, stem: int) -> Counter:
    out = Counter(counted)
    for w, n in counted.items():
        if len(w) > stem:
            out[w[:stem] + "*"] += n
    return out


class Vocabulary:
    """Terms by number, with their inverse document frequencies and deltas; makes unit vectors."""

    def __init__(self, terms: list[str], stem: int):
        self.stem, self.terms, self.idf, self.delta = stem, terms, np.ones(len(terms)), np.ones(len(terms))
        self.whole = {t: i for i, t in enumerate(terms) if not t.endswith("*")}
        self.stems = {t[:-1]: i for i, t in enumerate(terms) if t.endswith("*")}

    def __len__(self) -> int:
        return len(self.idf)

    def __getstate__(self) -> tuple:
        return self.stem, self.idf, self.delta, zlib.compress("\n".join(self.terms).encode(), 1)

    def __setstate__(self, state: tuple) -> None:
        stem, idf, delta, packed = state
        joined = zlib.decompress(packed).decode()
        self.__init__(joined.split("\n") if joined else [], stem)
        self.idf, self.delta = idf, delta

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the terms that a text has, ascending, and how often it has each."""
        own = words(text)
        found = self._looked_up(own)
        n = np.tile(np.fromiter(own.values(), "float64", len(own)), 2)
        known = found >= 0
        terms, at = np.unique(found[known], return_inverse=True)
        return terms, np.bincount(at, n[known], minlength=len(terms))

    def present(self, text: str | None) -> np.ndarray:
        """The numbers of the terms that a text has, and -1 if it has words that aren't terms."""
        return np.unique(self._looked_up(set(_WORD.findall(text.lower())) if text else set()))

    def _looked_up(self, own: Collection[str]) -> np.ndarray:
        """The numbers of the words, then those of their stems; -1 for what isn't a term."""
        stem, stems = self.stem, self.stems.get
        return np.array([*map(self.whole.get, own, repeat(-1)), *[stems(w[:stem], -1) if len(w) > stem else -1 for w in own]], "int64")

    def weighted(self, terms: np.ndarray, n: np.ndarray) -> np.ndarray:
        weights = (1 + np.log(n)) * self.idf[terms] * self.delta[terms]
        return weights / max(np.sqrt((weights**2).sum()), 1e-300)

    def learn_delta(self, toxic: list[int], counts: list[tuple[np.ndarray, np.ndarray]], smooth: float) -> None:
        """Deltas of all terms from the examples' labels and terms; all ones where a class has no example."""
        size, n = np.bincount(toxic, minlength=2).astype(float), np.zeros((2, len(self)))
        if not size.all():
            return
        for label, (terms, _) in zip(toxic, counts, strict=True):
            n[label, terms] += 1
        imagined = smooth * size / size.sum()
        clean, bad = (n + imagined[:, None]) / (size + imagined)[:, None]
        self.delta = np.abs(np.log(bad / clean))

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        terms, n = self.counts(text)
        return terms, self.weighted(terms, n)


class BlockMaxIndex:
    """Short postings by term; long ones as columns of a matrix with their largest weights in each block of examples.

    Examples are laid out by label and strongest term, so that those of a block are alike and its maxima say much.
    """

    def __init__(self, ids: list[int], toxic: list[int], vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, *, block: int = 16, frequent: float = 1 / 8):
        strongest = [int(t[np.argmax(w)]) for t, w in vectors]
        order = sorted(range(len(ids)), key=lambda i: (-toxic[i], strongest[i], ids[i]))
        self.ids, self.toxic = np.array([ids[i] for i in order], "int64"), np.array([toxic[i] for i in order], "int32")
        terms = np.concatenate([vectors[i][0] for i in order]).astype("intp") if len(order) else np.empty(0, "intp")
        weights = np.concatenate([vectors[i][1] for i in order]) if len(order) else np.empty(0)
        examples = np.repeat(np.arange(len(order), dtype="intp"), [len(vectors[i][0]) for i in order])
        long = np.flatnonzero(np.bincount(terms, minlength=n_terms) > frequent * len(order))
        self.column = np.full(n_terms, -1, "intp")
        self.column[long] = np.arange(len(long))
        at = self.column[terms]
        n_blocks = -(-len(order) // block)
        self.matrix = np.zeros((n_blocks * block, len(long)))
        self.matrix[examples[at >= 0], at[at >= 0]] = weights[at >= 0]
        self.maxima = self.matrix.reshape(n_blocks, block, len(long)).max(1)
        self.block_of = np.arange(len(order)) // block
        terms, weights, examples = terms[at < 0], weights[at < 0], examples[at < 0]
        by_term = np.argsort(terms, kind="stable")
        self.examples, self.weights = examples[by_term], weights[by_term]
        self.starts = np.searchsorted(terms[by_term], np.arange(n_terms + 1))

    def _short(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Every example's sum over the terms with short lists."""
        a, sizes = self.starts[terms], self.starts[terms + 1] - self.starts[terms]
        at = np.arange(sizes.sum()) + np.repeat(a - np.cumsum(sizes) + sizes, sizes)
        return np.bincount(self.examples[at], self.weights[at] * np.repeat(weights, sizes), minlength=len(self.ids))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, leave_out: int | None = None) -> list[tuple[float, int]]:
        """(cosine, example) of the k nearest with a positive cosine."""
        if not len(self.ids) or not len(terms):
            return []
        column = self.column[terms]
        long = column >= 0
        query = np.zeros(self.matrix.shape[1])
        query[column[long]] = weights[long]
        partial = self._short(terms[~long], weights[~long])
        bound = partial + (self.maxima @ query)[self.block_of]
        if leave_out is not None:
            bound[self.ids == leave_out] = -1.0  # neither found nor among those that set the least cosine
        first = np.argpartition(-bound, 2 * k)[: 2 * k] if len(bound) > 2 * k else np.arange(len(bound))
        first = first[bound[first] >= 0]
        cosines = partial[first] + self.matrix[first] @ query
        least = np.partition(cosines, -k)[-k] if len(cosines) >= k else 0.0
        found = np.flatnonzero((bound > 0) & (bound >= least - 1e-9))
        rest = self.matrix[found] @ query if 4 * len(found) < len(bound) else (self.matrix @ query)[found]
        cosines = np.round(partial[found] + rest, 12)
        found, cosines = found[cosines > 0], cosines[cosines > 0]
        if len(found) > 4 * k:  # all that could be among the k, ties included
            fine = cosines >= np.partition(cosines, -k)[-k]
            found, cosines = found[fine], cosines[fine]
        order = np.lexsort((self.ids[found], -cosines))[:k]
        return list(zip(cosines[order].tolist(), found[order].tolist(), strict=True))


class Scorer:
    """Goes to the tasks once, as packed counts; a worker lays out the index when it first needs it."""

    def __init__(self, vocabulary: Vocabulary, ids: list[int], toxic: list[int], counts: list[tuple[np.ndarray, np.ndarray]], k: int):
        """counts: an example's ascending terms and how often it has each."""
        self.vocabulary, self.ids, self.toxic, self.k = vocabulary, ids, toxic, k
        steps = [np.diff(t, prepend=0).astype("int32") for t, _ in counts]
        self.packed = [zlib.compress(b"".join(a.tobytes() for a in part), 1) for part in (steps, [n.astype("int32") for _, n in counts])]
        self.sizes = [len(t) for t, _ in counts]
        self.shared: Broadcast | None = None
        self.edges, self.levels, self.silent = np.array([0.0]), np.array([0.0]), 0.0

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("index", "shared")}

    @cached_property
    def index(self) -> BlockMaxIndex:
        ends = np.cumsum(self.sizes)[:-1] if self.sizes else []
        steps, n = (np.split(np.frombuffer(zlib.decompress(p), "int32"), ends) for p in self.packed)
        vectors = [(t, self.vocabulary.weighted(t, m)) for t, m in zip(map(np.cumsum, steps), n, strict=True) if len(t)]
        return BlockMaxIndex(self.ids, self.toxic, vectors, len(self.vocabulary))

    def vote(self, text: str | None, leave_out: int | None = None) -> tuple[float | None, list[tuple[float, int]]]:
        near = self.index.nearest(*self.vocabulary.vector(text), self.k, leave_out)
        if not near:
            return None, []
        by = [s * s for s, _ in near]
        return sum(w * int(self.index.toxic[e]) for w, (_, e) in zip(by, near, strict=True)) / sum(by), near

    def calibrated(self, vote: float | None) -> float:
        return self.silent if vote is None else float(np.interp(vote, self.edges, self.levels))


def monotone(points: list[tuple[float, float, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over (vote, rate, weight); knots for interpolation."""
    pools: list[list[float]] = []
    for x, y, w in sorted(points):
        pools.append([x * w, y * w, w])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def train(docs: DataFrame, labels: DataFrame, *, max_examples: int = 4000, stem: int = 5, k: int = 15, smooth: float = 50.0) -> Scorer:
    spark = docs.sparkSession
    known = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.where(~held_out(F.col("doc_id")))
    share = min(1.0, max_examples / max(1, known.count()))
    if share < 1:
        known = known.where(F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id")), F.lit(1 << 30)) < int(share * (1 << 30)))
    # ``known`` has a bounded number of ids and labels; the documents are filtered by them before anything is counted.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = checkpointed(texts.join(F.broadcast(known), "doc_id").select("doc_id", "text", "toxic").dropDuplicates(["doc_id", "text"]))

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[str] = set()
            for text in batch.column(0).to_pylist():
                seen.update(with_stems(words(text), stem))
            yield pa.RecordBatch.from_pydict({"term": pa.array(list(seen), pa.string())})

    terms = sample.select("text").mapInArrow(distinct, "term string").distinct().toArrow().column(0).to_pylist()
    vocabulary = Vocabulary(sorted(terms), stem)
    shared = spark.sparkContext.broadcast(vocabulary)

    def to_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shared.value.counts(t) for t in batch.column(1).to_pylist()]
            packed = [pa.array([m[part].astype("int32").tobytes() for m in made], pa.binary()) for part in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *packed], names=["doc_id", "toxic", "terms", "n"])

    vocabulary.idf = _idf(texts, shared, len(vocabulary))
    ids, toxic, counts, silent = [], [], [], [0, 0]
    for r in sample.mapInArrow(to_counts, "doc_id long, toxic int, terms binary, n binary").collect():
        if r["terms"]:
            ids.append(r["doc_id"]), toxic.append(r["toxic"]), counts.append((np.frombuffer(r["terms"], "int32"), np.frombuffer(r["n"], "int32")))
        else:
            silent[0] += r["toxic"]
            silent[1] += 1
    shared.destroy()
    n1, n = sum(toxic) + silent[0], len(toxic) + silent[1]
    vocabulary.learn_delta(toxic, counts, smooth)
    scorer = Scorer(vocabulary, ids, toxic, counts, k)
    scorer.silent = (silent[0] + 1) / (silent[1] + n / n1) if n1 else 0.0
    scorer.shared = spark.sparkContext.broadcast(scorer)
    scorer.edges, scorer.levels = _calibration(sample, scorer.shared)
    return scorer


def _idf(texts: DataFrame, shared: Broadcast[Vocabulary], size: int) -> np.ndarray:
    """Inverse document frequencies over all documents, by the term's number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, df, total = shared.value, np.zeros(size + 1, "int64"), 0  # the last place takes what isn't a term
        for batch in batches:
            for text in batch.column(0).to_pylist():
                df[vocabulary.present(text)] += 1
                total += 1
        some = np.flatnonzero(df[:size])
        yield pa.RecordBatch.from_pydict({"term": pa.array(np.append(some, -1), pa.int64()), "n": pa.array(np.append(df[some], total), pa.int64())})

    found = texts.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    terms, n = found.column(0).to_numpy(), found.column(1).to_numpy()
    df, total = np.zeros(size), int(n[terms == -1].sum())
    df[terms[terms >= 0]] = n[terms >= 0]
    return np.log((1 + total) / (1 + df)) + 1


def _calibration(sample: DataFrame, shared: Broadcast[Scorer], bins: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Monotone rates from leave-one-out votes; tasks return counts by bin."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for doc_id, text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                v, _ = shared.value.vote(text, doc_id)
                if v is not None:
                    seen[round(v * bins), toxic] += 1
            yield pa.RecordBatch.from_pydict({"bin": pa.array([b for b, _ in seen], pa.int64()), "toxic": pa.array([t for _, t in seen], pa.int64()), "n": pa.array(list(seen.values()), pa.int64())})

    rows = sample.select("doc_id", "text", "toxic").mapInArrow(vote, "bin long, toxic long, n long").groupBy("bin").agg(F.sum("n").alias("n"), F.sum(F.expr("n * toxic")).alias("toxic")).collect()
    if not rows:
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    # Each bin starts with two imagined rows at its own vote, so a nearly empty bin says little.
    return monotone([(r["bin"] / bins, (r["toxic"] + 2 * r["bin"] / bins) / (r["n"] + 2), float(r["n"])) for r in rows])


def score(docs: DataFrame, scorer: Scorer, *, threshold: float = 0.7) -> DataFrame:
    """``docs`` with score, predicted and evidence."""
    docs = without(docs, "score", "predicted", "evidence")
    shared, edges, levels = scorer.shared, scorer.edges, scorer.levels
    added = T._parse_datatype_string(f"score double, evidence {EVIDENCE}")  # noqa: SLF001
    schema = T.StructType([*docs.schema, *added])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        s.edges, s.levels = edges, levels
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))
        for batch in batches:
            found = [s.vote(t) for t in batch.column(batch.schema.get_field_index("text")).cast(pa.string()).to_pylist()]
            scores = pa.array([s.calibrated(v) for v, _ in found], pa.float64())
            evidence = pa.array([[{"doc_id": int(s.index.ids[e]), "cosine": c, "toxic": int(s.index.toxic[e])} for c, e in near] for _, near in found], kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, scores, evidence], names=[*batch.schema.names, "score", "evidence"])

    return docs.mapInArrow(judge, schema).withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
