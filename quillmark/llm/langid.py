"""Language identification by word-first backoff.

The model holds per-language log frequencies of whole words. A word of the text that the model knows adds its log
frequencies; an unseen word falls back to its character n-grams, from ``max_n`` down to single characters, and adds the
mean log frequency of those of the longest order of which the model knows any. The language with the largest sum wins; the score is
its posterior with the evidence of a long text scaled to ``evidence_words`` words, so that mixed texts score lower.

Training reads rows with text and language outside the held-out fold. It is a classifier fitted on a bounded sample: of
more than ``max_rows`` labelled rows a hash of the id picks about that many. Words and n-grams are counted by Spark, and the
model holds every word and n-gram of the sample. Scoring reads every whole text and shuffles nothing.

Defined results: a null text, or one without a letter, is ``und`` with score 0. A text with letters of which the model knows
nothing gets the language with the most words in training and its share of them as score. Without any labelled row every text is
``und``; an empty table gives no rows. Ties between languages go to the first in order. Repeated rows are scored alike. Input columns named
``lang_pred`` or ``score`` are replaced; others stay.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmark.llm.shared import checkpointed, held_out, without

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, set(text)))


def grams(word: str, n: int) -> list[str]:
    """Character n-grams with the word's ends marked; single characters have no marks."""
    if n == 1:
        return list(word)
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


class Model:
    """Log frequencies of words and n-grams: a row of ``table`` for each, a column for each language."""

    def __init__(self, counts: pa.Table | list[tuple[str, str, int]], totals: dict[tuple[str, str], int], max_n: int, evidence_words: int):
        """counts: (feature, language, n); a feature is ``w`` + word or the order of the n-gram + the n-gram."""
        if not isinstance(counts, pa.Table):
            counts = pa.table({"feature": pa.array([c[0] for c in counts], pa.string()), "lang": pa.array([c[1] for c in counts], pa.string()), "n": pa.array([c[2] for c in counts], pa.int64())})
        self.languages = sorted({lang for _, lang in totals})
        self.max_n, self.evidence_words = max_n, evidence_words
        column = {lang: i for i, lang in enumerate(self.languages)}
        kinds = sorted({k for k, _ in totals})
        sums = {k: np.array([totals.get((k, lang), 0) for lang in self.languages], float) for k in kinds}
        coded, langs = (counts.column(c).combine_chunks().dictionary_encode() for c in ("feature", "lang"))
        features = coded.dictionary.to_pylist()
        table = np.zeros((len(features), len(self.languages)))
        columns = np.array([column[x] for x in langs.dictionary.to_pylist()], int)
        table[coded.indices.to_numpy(), columns[langs.indices.to_numpy()] if len(columns) else columns] = counts.column("n").to_numpy()
        of_kind = Counter(f[0] for f in features)
        spread = np.array([sums[f[0]] + 0.5 * (of_kind[f[0]] + 1) for f in features]).reshape(table.shape)
        self.prior = sums.get("w", np.zeros(len(self.languages)))
        self.table = np.log((table + 0.5) / spread).astype("float64")
        self.word_row = {f[1:]: i for i, f in enumerate(features) if f[0] == "w"}
        self.gram_row = [{f[1:]: i for i, f in enumerate(features) if f[0] == str(n)} for n in range(max_n + 1)]
        self.seen: dict[str, list[int]] = {}

    def backoff(self, word: str) -> list[int]:
        """Rows of the n-grams of the longest known order."""
        for n in range(min(self.max_n, len(word) + 2), 0, -1):
            known = self.gram_row[n]
            found = [known[g] for g in grams(word, n) if g in known]
            if found:
                return found
        return []

    def score(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not has_letter(text):
            return "und", 0.0
        counted = Counter(words(text))
        rows: list[int] = []
        weights: list[float] = []
        n_words = 0
        for word, n in counted.items():
            n_words += n
            r = self.word_row.get(word)
            if r is not None:
                rows.append(r)
                weights.append(n)
            else:
                found = self.seen.get(word)
                if found is None:
                    if len(self.seen) > 20_000:
                        self.seen.clear()
                    found = self.seen[word] = self.backoff(word)
                rows += found
                weights += [n / len(found)] * len(found) if found else []
        if not rows:
            best = int(self.prior.argmax())
            return self.languages[best], float(self.prior[best] / max(1.0, self.prior.sum()))
        total = np.asarray(weights) @ self.table[rows]
        total *= min(1.0, self.evidence_words / max(1, n_words))
        p = np.exp(total - total.max())
        best = int(p.argmax())
        return self.languages[best], float(min(1.0, p[best] / p.sum()))


def train(docs: DataFrame, *, max_rows: int = 2_000, max_n: int = 5, evidence_words: int = 30) -> Model:
    labelled = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    share = min(1.0, max_rows / max(1, labelled.select("lang").count()))
    if share < 1:
        labelled = labelled.where(F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id")), F.lit(1 << 30)) < int(share * (1 << 30)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        held = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen.setdefault(lang, Counter()).update(words(text or ""))
            held = sum(map(len, seen.values()))
            if held > 100_000:
                yield from _flush(seen)
        yield from _flush(seen)

    def _flush(seen: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counter in seen.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(counter), pa.string()), "word": pa.array(list(counter), pa.string()), "n": pa.array(list(counter.values()), pa.int64())})
        seen.clear()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (batch.slice(at, 2000) for batch in batches for at in range(0, batch.num_rows, 2000)):
            seen: Counter = Counter()
            for lang, word, n in zip(*(c.to_pylist() for c in part.columns), strict=True):
                for k in range(1, max_n + 1):
                    for g in grams(word, k):
                        seen[f"{k}{g}", lang] += n
            yield pa.RecordBatch.from_pydict({"feature": pa.array([f for f, _ in seen], pa.string()), "lang": pa.array([x for _, x in seen], pa.string()), "n": pa.array(list(seen.values()), pa.int64())})

    columns = labelled.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    by_word = columns.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    by_word = checkpointed(by_word)
    by_gram = by_word.select("lang", "word", "n").mapInArrow(split, "feature string, lang string, n long").groupBy("feature", "lang").agg(F.sum("n").alias("n"))
    by_gram = checkpointed(by_gram)
    by_word = by_word.select(F.concat(F.lit("w"), "word").alias("feature"), "lang", "n")
    totals = {(r["k"], r["lang"]): r["n"] for table in (by_word, by_gram) for r in table.groupBy(F.substring("feature", 1, 1).alias("k"), "lang").agg(F.sum("n").alias("n")).collect()}
    counts = pa.concat_tables([table.select("feature", "lang", "n").toArrow() for table in (by_word, by_gram)])
    return Model(counts.sort_by([("feature", "ascending"), ("lang", "ascending")]), totals, max_n, evidence_words)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score; every whole text is read."""
    docs = without(docs, "lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.string()).to_pylist()
            found = [shared.value.score(t) for t in texts]
            more = [pa.array([a for a, _ in found], pa.string()), pa.array([b for _, b in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(score, schema)


