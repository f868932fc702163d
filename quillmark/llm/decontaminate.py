"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is cut into windows of ``window`` consecutive words (an item with fewer words is one window). A document
contains a window when the window's words stand in it side by side. For exact containment the necessary prefix of a
window, its words ordered from rare to frequent in the corpus, is its rarest word: a document without that word cannot
contain the window. So each pass over the documents

1. counts in how many documents each benchmark word occurs (partial counts per task, then one small shuffle),
2. meets document words with the windows' prefix words only,
3. drops candidates by position and length (the window must start and end inside the document), and
4. verifies the rest word by word.

The benchmark reaches the tasks in blocks of at most ``block_words`` words, a bound that doesn't depend on the data; a
larger benchmark means more passes, each over all documents, and the hits of all passes are merged per document. The
documents are never shuffled.

Defined results: a null or wordless text has no words, no hits and isn't contaminated. A null or wordless item has no
windows. Windows of a null ``item_id`` count as hits but name no item. Repeated documents are judged one by one,
repeated items count once. Input columns with the names of result columns are replaced; others stay.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Every byte that isn't part of a word becomes a space; A-Z become a-z. Bytes above 127 are parts of words.
_TO_WORDS = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_HITS, _ITEMS = "__hits", "__items"


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_TO_WORDS).split() if text else []


def windows_of(item: list[bytes], size: int) -> set[tuple[bytes, ...]]:
    return {tuple(item[i : i + size]) for i in range(max(1, len(item) - size + 1))} if item else set()


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index("text")).cast(pa.large_binary()).to_pylist()


def _blocks(benchmark: DataFrame, size: int, block_words: int) -> Iterator[dict[tuple[bytes, ...], set[str]]]:
    """Windows with the ids of their items, in blocks of a bounded number of words."""
    block: dict[tuple[bytes, ...], set[str]] = {}
    held = 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").cast("string").alias("t")).toLocalIterator():
        item = words((row["t"] or "").encode())
        for w in windows_of(item, size):
            if held + len(w) > block_words and block:
                yield block
                block, held = {}, 0
            if w not in block:
                block[w] = set()
                held += len(w)
            if row["i"] is not None:
                block[w].add(row["i"])
    if block:
        yield block


def _frequencies(docs: DataFrame, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """Documents that hold each benchmark word. The result has at most a block's words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in _texts(batch):
                seen.update(vocabulary.intersection(words(text)))
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.binary()), "n": pa.array(list(seen.values()), pa.int64())})

    partial = docs.select("text").mapInArrow(count, "word binary, n long")
    return {bytes(r["word"]): r["n"] for r in partial.groupBy("word").agg(F.sum("n").alias("n")).toLocalIterator()}


def _match(docs: DataFrame, block: dict[tuple[bytes, ...], set[str]], first: bool) -> DataFrame:
    """Add the block's hits to the documents' columns ``__hits`` (starts and ends of hit stretches) and ``__items``."""
    df = _frequencies(docs, frozenset(w for window in block for w in window))
    index: dict[bytes, list[tuple[int, list[bytes], list[str]]]] = {}
    for window, items in block.items():
        at = min(range(len(window)), key=lambda i: (df.get(window[i], 0), window[i], i))
        index.setdefault(window[at], []).append((at, list(window), sorted(items)))
    prefixes = frozenset(index)
    schema = T.StructType([f for f in docs.schema if f.name not in (_HITS, _ITEMS, "n_words")]).add("n_words", T.LongType()).add(_HITS, T.ArrayType(T.IntegerType())).add(_ITEMS, T.ArrayType(T.StringType()))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, hits, found = [], [], []
            before = [[]] * batch.num_rows if first else batch.column(batch.schema.get_field_index(_HITS)).to_pylist()
            names = [[]] * batch.num_rows if first else batch.column(batch.schema.get_field_index(_ITEMS)).to_pylist()
            for text, old, ids in zip(_texts(batch), before, names, strict=True):
                own = words(text)
                spans, items = {(old[i], old[i + 1]) for i in range(0, len(old), 2)}, set(ids)
                if not prefixes.isdisjoint(own):
                    for i, word in enumerate(own):
                        if word in prefixes:
                            for at, window, of in index[word]:
                                start = i - at
                                end = start + len(window)
                                if start >= 0 and end <= len(own) and own[start:end] == window:
                                    spans.add((start, end))
                                    items.update(of)
                n_words.append(len(own))
                hits.append(_merged(spans))
                found.append(sorted(items))
            kept = [(n, batch.column(i)) for i, n in enumerate(batch.schema.names) if n not in (_HITS, _ITEMS, "n_words")]
            more = [("n_words", pa.array(n_words, pa.int64())), (_HITS, pa.array(hits, pa.list_(pa.int32()))), (_ITEMS, pa.array(found, pa.list_(pa.string())))]
            yield pa.RecordBatch.from_arrays([c for _, c in kept + more], names=[n for n, _ in kept + more])

    return docs.mapInArrow(match, schema)


def _merged(spans: set[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for start, end in sorted(spans):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, window: int = 13, one_in: int = 20, block_words: int = 1_000_000) -> DataFrame:
    """``docs`` with n_words, n_hit, items (array, sorted as strings) and contaminated (n_hit > 0 and one_in * n_hit >= n_words)."""
    from quillmark.llm.shared import without

    out = without(docs, "n_words", "n_hit", "items", "contaminated", _HITS, _ITEMS)
    out = out.withColumn("text", F.col("text").cast("string"))
    first = True
    for block in _blocks(benchmark, window, block_words):
        out = _match(out, block, first)
        first = False
    if first:  # nothing to look for: the words are still counted
        out = _match(out, {}, True)
    hit = F.aggregate(F.sequence(F.lit(0), F.size(_HITS) - 2, F.lit(2)), F.lit(0).cast("long"), lambda n, i: n + F.get(F.col(_HITS), i + 1) - F.get(F.col(_HITS), i))
    out = out.withColumn("n_hit", F.when(F.size(_HITS) > 0, hit).otherwise(F.lit(0).cast("long"))).withColumnRenamed(_ITEMS, "items").drop(_HITS)
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words")))
