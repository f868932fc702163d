"""N-gram Jaccard self-join with PartEnum signatures, and the components of its links.

A document's set is the 64-bit hashes of its distinct shingles of ``n`` words. Documents with equal sets form a class that is
represented by its smallest id. For two sets of sizes r <= s with a Jaccard similarity of at least t, s <= r / t and the sets
differ in at most K = (r + s)(1 - t) / (1 + t) elements.

**Signatures** (PartEnum). The domain of hashes is divided into n1 parts and each of these into n2 smaller ones. With n1 (k + 1) > K, sets that
differ in at most K elements differ in at most k within one of the parts, so they agree on n2 - k of its smaller parts: the contents of every subset
of n2 - k smaller parts are a signature, and similar sets share one. Bands of up to ``ENUMERATED`` signatures take n2 = 3 and k = 1, three subsets
of two parts each; there texts are short, and a passage that many texts share fills whole parts, which larger subsets tell apart. Longer texts, of which
parts hold little else than their own, take n2 = 1 and k = 0, every part on its own, a third fewer signatures. n1 depends on the sizes only
through bands, since both sets must use the same parts: every set signs in the scheme of its own band, and near a
band's edge also in the scheme of that edge, which only sets within a factor of t of it use. A subset that is empty in
both sets would be shared by all. A part is covered if none of its subsets is empty; a set with c covered parts leaves empty subsets out when c (k + 1) > K, as
then a subset that isn't empty agrees, and signs them otherwise.

**Candidates.** Rows (signature, document) are sorted by signature. Buckets of up to ``small`` documents give all their
pairs, larger ones only a star and a chain of pairs at first. Pairs are pruned by sizes and by a parity sketch whose
Hamming distance never exceeds that of the sets, so nothing similar is lost. The rest is verified on whole sets, the most
promising pair of each document first, then the best between each two components, then all that remains between
components. Pairs within one component need no proof.

**Large buckets** are then revisited: their members, in square blocks of at most ``block`` by ``block`` documents, give pairs between different
components that pass the same exact-safe tests, and these go through the same verification. So no bucket emits all its
pairs, no task holds more than two blocks, and every link between documents of different components is found.

Tables of up to ``broadcast_rows`` ids are broadcast after they have been counted, larger ones are joined by shuffle.

Defined results: a null, empty or wordless text has an empty set, links with nothing and is its own component. With fewer
than n words the whole sequence is the one shingle. Rows with a null id have no component. Rows that repeat an id are one
node. White space is ``[ \\t-\\r]``, and only A-Z are lower-cased.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.components import components
from quillmark.llm.shared import Tables, checkpointed, join_counted

_U = np.uint64
BAND_STEPS = 4
#: The most signatures of a set in a scheme that enumerates subsets of two of three parts.
ENUMERATED = 96


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit values (splitmix64's constants)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts data[starts[i]:ends[i]] (adjacent), and each word's text."""
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    space = _SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[starts] = True
    first = np.flatnonzero(~space & (edge[:n] | np.append(True, space[:-1])))
    edge[:] = False
    edge[ends] = True
    last = np.flatnonzero(~space & (edge[1:] | np.append(space[1:], True))) + 1
    # A word's hash is a polynomial in its bytes; prefix sums give all of them at once, odd powers have inverses.
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, n), out=sums[1:])
    value = (sums[last] - sums[first]) * _powers(_INVERSE, n)[first]
    return mix(value + (last - first).astype(np.uint64) * _U(0x632BE59BD9B4E019)), np.searchsorted(starts, first, side="right") - 1


def shingle_sets(texts: pa.Array, n: int = 5) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each text. Texts go through the arrays in groups of about a megabyte."""
    raw = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    at = 0
    while at < len(raw):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + (1 << 20), side="right")) - 1)
        own = offsets[at : end + 1] - offsets[at]
        data = np.frombuffer(raw.buffers()[2], np.uint8)[offsets[at] : offsets[end]] if own[-1] else np.empty(0, np.uint8)
        # Empty texts have no place of their own; they are put back below.
        full = np.flatnonzero(np.diff(own))
        words, of = _word_hashes(data, own[full], own[full + 1])
        rolled = np.zeros(max(0, len(words) - n + 1), np.uint64)
        for j in range(n):
            rolled = rolled * _U(0xD6E8FEB86659FD93) + words[j : j + len(rolled)]
        rolled = mix(rolled)
        counts = np.zeros(end - at, np.int64)
        counts[full] = np.bincount(of, minlength=len(full)) if len(full) else 0
        first = np.concatenate([[0], np.cumsum(counts)])
        for i in range(end - at):
            a, b = first[i], first[i + 1]
            if b - a >= n:
                yield np.unique(rolled[a : b - n + 1])
            elif b > a:
                h = np.zeros(1, np.uint64)
                for w in words[a:b]:
                    h = mix(h * _U(0xD6E8FEB86659FD93) + w + _U(1))
                yield h
            else:
                yield np.empty(0, np.uint64)
        at = end


class Schemes:
    """Bands of sizes and their numbers of parts for one threshold, kept as whole per cent so that bounds are exact."""

    def __init__(self, percent: int):
        self.percent = percent
        self.edges = [1]
        step = (100 / percent) ** BAND_STEPS
        while self.edges[-1] < 1 << 40:
            self.edges.append(max(self.edges[-1] + 2, int(self.edges[-1] * step)))
        self.edges_array = np.array(self.edges)

    def differ(self, total: int) -> int:
        """The most elements in which two sets of ``total`` elements together may differ."""
        return total * (100 - self.percent) // (100 + self.percent)

    def largest(self, size: int) -> int:
        return size * 100 // self.percent

    def of(self, size: int) -> list[tuple[int, tuple[int, int, int], int]]:
        """(scheme, (n1, n2, k), most differences) for a set of ``size`` elements."""
        band = int(np.searchsorted(self.edges_array, size, side="right")) - 1
        low, high = self.edges[band], self.edges[band + 1] - 1
        out = [(2 * band, self._parts(self.differ(2 * high)), self.differ(size + min(high, self.largest(size))))]
        for k, edge in ((band, low), (band + 1, high + 1)):
            # Across an edge: one set below it, the other at or above it.
            if k and (size >= edge and size * self.percent <= (edge - 1) * 100 or size < edge and self.largest(size) >= edge):
                most = self.differ((edge - 1) + self.largest(edge - 1))
                own = self.differ(size + self.largest(size)) if size < edge else self.differ(size + edge - 1)
                out.append((2 * k + 1, self._parts(most), min(own, most)))
        return out

    @staticmethod
    def _parts(most: int) -> tuple[int, int, int]:
        """n1, n2, k, with some parts more than needed, since few may be empty."""
        enough = most + 1 + most // 32 + (2 if most else 0)
        two = (enough + 2) // 2
        return (two, 3, 1) if most and 3 * two <= ENUMERATED else (enough, 1, 0)


def signatures(own: np.ndarray, schemes: Schemes) -> np.ndarray:
    """48-bit signatures of a set in every scheme it takes part in."""
    out = []
    for scheme, (n1, n2, k), most in schemes.of(len(own)):
        part = ((own >> _U(20)) % _U(n1 * n2)).astype(np.int64)
        seed = (scheme * 0x9E3779B97F4A7C15) % 2**64
        total = np.zeros(n1 * n2, np.uint64)
        np.add.at(total, part, mix(own + _U(seed)))
        full = (np.bincount(part, minlength=n1 * n2) > 0).reshape(n1, n2)
        enough = np.count_nonzero(full.sum(1) > k) * (k + 1) > most
        content = mix(total + mix(np.arange(1, n1 * n2 + 1, dtype=np.uint64) + _U(seed))).reshape(n1, n2)
        for subset in combinations(range(n2), n2 - k):
            sign = full[:, subset].any(1) if enough else np.ones(n1, bool)
            # The contents of a part depend on its place, so their sum names the subset with them.
            out.append(mix(content[sign][:, subset].sum(1, dtype=np.uint64) + _U(seed)) >> _U(16))
    return np.concatenate(out).astype(np.int64)


def sketch(own: np.ndarray) -> np.ndarray:
    """Parities of the set's hashes by their low bits; about two bits an element, a power of two of them."""
    bits = 1 << max(8, min(17, math.ceil(math.log2(2 * len(own) + 1))))
    return np.packbits(np.bincount((own & _U(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little")


_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """The sketch with fewer bits: halves are added modulo 2."""
    while len(bits) > size:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def may_link(n: int, m: int, a: np.ndarray, b: np.ndarray, schemes: Schemes) -> bool:
    if min(n, m) * 100 < max(n, m) * schemes.percent:
        return False
    size = min(len(a), len(b))
    return int(_ONES[folded(a, size) ^ folded(b, size)].sum()) <= schemes.differ(n + m)


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"))


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _buckets(signed: DataFrame, small: int) -> DataFrame:
    """From rows (sig, doc): (sig, a, b, n) with pairs, and (sig, a, null, 0) for the members of buckets over ``small``."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sig = np.empty(0, np.int64)
        doc = np.empty(0, np.int64)
        hot: list[int] | None = None  # a large bucket that goes on: its signature, first and last document

        def flush(sig: np.ndarray, doc: np.ndarray, last: bool) -> tuple[list, np.ndarray, np.ndarray]:
            nonlocal hot
            out: list = []
            if hot is not None:
                end = int(np.searchsorted(sig, hot[0], side="right"))
                if end:
                    out.append(_large(hot[0], doc[:end], hot[1], hot[2]))
                    hot[2] = int(doc[end - 1])
                if end < len(sig) or last:
                    hot = None
                sig, doc = sig[end:], doc[end:]
            starts = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])) if len(sig) else np.empty(0, np.int64)
            sizes = np.diff(np.append(starts, len(sig)))
            if len(starts) and not last:  # the last bucket may go on
                keep = int(starts[-1])
                if sizes[-1] > 4096:
                    hot = [int(sig[keep]), int(doc[keep]), int(doc[-1])]
                    out.append(_large(hot[0], doc[keep:], None, None))
                    keep = len(sig)
                starts, sizes, rest = starts[:-1], sizes[:-1], (sig[keep:], doc[keep:])
            else:
                rest = (sig[:0], doc[:0])
            some = sizes > 1
            for size in np.unique(sizes[some & (sizes <= small)]):
                rows = starts[sizes == size][:, None] + np.arange(size)
                i, j = np.triu_indices(size, 1)
                members = doc[rows]
                out.append((np.zeros(len(rows) * len(i), np.int64), members[:, i].ravel(), members[:, j].ravel(), np.ones(len(rows) * len(i), np.int64)))
            for start, size in zip(starts[some & (sizes > small)], sizes[some & (sizes > small)], strict=True):
                out.append(_large(int(sig[start]), doc[start : start + size], None, None))
            return out, *rest

        def _large(of: int, members: np.ndarray, first: int | None, before: int | None) -> tuple:
            star = np.full(len(members), members[0] if first is None else first)
            chain = np.append(members[0] if before is None else before, members[:-1])
            a, b = np.concatenate([star, chain]), np.concatenate([members, members])
            fine = a != b
            a, b = np.minimum(a, b)[fine], np.maximum(a, b)[fine]
            return np.concatenate([np.full(len(members), of), np.zeros(len(a), np.int64)]), np.concatenate([members, a]), np.concatenate([np.full(len(members), -1), b]), np.concatenate([np.zeros(len(members), np.int64), np.ones(len(a), np.int64)])

        def rows(out: list) -> Iterator[pa.RecordBatch]:
            if not out:
                return
            s, a, b, n = (np.concatenate(x) for x in zip(*out, strict=True))
            member = n == 0
            # Pairs of one batch are counted here, so that the shuffle sees each once.
            both, counts = np.unique(np.stack([a[~member], b[~member]]), axis=1, return_counts=True) if (~member).any() else (np.empty((2, 0), np.int64), np.empty(0, np.int64))
            yield pa.RecordBatch.from_pydict(
                {
                    "sig": pa.array(np.concatenate([s[member], np.zeros(both.shape[1], np.int64)])),
                    "a": pa.array(np.concatenate([a[member], both[0]])),
                    "b": pa.array(np.concatenate([np.zeros(member.sum(), np.int64), both[1]])),
                    "n": pa.array(np.concatenate([np.zeros(member.sum(), np.int64), counts]).astype(np.int64)),
                }
            )

        for batch in batches:
            sig, doc = np.append(sig, batch.column(0).to_numpy()), np.append(doc, batch.column(1).to_numpy())
            if len(sig) < 100_000:
                continue
            out, sig, doc = flush(sig, doc, False)
            yield from rows(out)
        out, *_ = flush(sig, doc, True)
        yield from rows(out)

    return signed.repartition("sig").sortWithinPartitions("sig", "doc").mapInArrow(meet, "sig long, a long, b long, n long")


class NgramJoin:
    """One run of the join over a table of documents; ``result`` is the table of classes and components."""

    def __init__(self, docs: DataFrame, *, n: int = 5, percent: int = 80, small: int = 32, block: int = 2048, broadcast_rows: int = 400_000):
        self.texts, self.n, self.schemes = _texts(docs), n, Schemes(percent)
        self.small, self.block, self.broadcast_rows, self.labelled = small, block, broadcast_rows, 0
        self.tables = Tables(docs.sparkSession, "ngram-join")
        self.result = checkpointed(self._run())
        self.tables.drop()

    def _shingled(self) -> DataFrame:
        """(doc, n_shingles, k1, k2): the set's size and a 128-bit digest of it."""
        n = self.n

        def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes, k1, k2 = [], [], []
                for own in shingle_sets(batch.column(1), n):
                    sizes.append(len(own))
                    k1.append(int((own * _U(0x9FB21C651E98DF25)).sum(dtype=np.uint64).view(np.int64)) if len(own) else 0)
                    k2.append(int(mix(own + _U(0xC2B2AE3D27D4EB4F)).sum(dtype=np.uint64).view(np.int64)) if len(own) else 0)
                yield pa.RecordBatch.from_pydict({"doc": batch.column(0), "n_shingles": pa.array(sizes, pa.int64()), "k1": pa.array(k1, pa.int64()), "k2": pa.array(k2, pa.int64())})

        return self.texts.mapInArrow(digest, "doc long, n_shingles long, k1 long, k2 long")

    def _signed(self) -> DataFrame:
        n, schemes = self.n, self.schemes

        def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sigs, docs, held = [], [], 0
                for doc, own in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), n), strict=True):
                    if len(own):
                        sigs.append(signatures(own, schemes))
                        docs.append(np.full(len(sigs[-1]), doc, np.int64))
                        held += len(docs[-1])
                    if held > 200_000:
                        yield pa.RecordBatch.from_pydict({"sig": pa.array(np.concatenate(sigs)), "doc": pa.array(np.concatenate(docs))})
                        sigs, docs, held = [], [], 0
                if held:
                    yield pa.RecordBatch.from_pydict({"sig": pa.array(np.concatenate(sigs)), "doc": pa.array(np.concatenate(docs))})

        # A copy's signatures are those of its representative.
        return join_counted(self.texts.where("doc is not null"), self.copies, "doc", "left_anti", self.n_copies, self.broadcast_rows).mapInArrow(sign, "sig long, doc long")

    def _profiles(self, wanted: DataFrame, rows: int) -> DataFrame:
        """(doc, size, sketch, own) of the wanted documents, read again from their texts."""
        n = self.n

        def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 1000):  # whole sets are held for so many documents at a time
                    part = batch.slice(at, 1000)
                    sets = list(shingle_sets(part.column(1), n))
                    yield pa.RecordBatch.from_pydict({"doc": part.column(0), "size": pa.array([len(s) for s in sets], pa.int64()), "sketch": pa.array([sketch(s).tobytes() for s in sets], pa.binary()), "own": pa.array([s.tobytes() for s in sets], pa.binary())})

        found = join_counted(self.texts, wanted.select("doc"), "doc", "left_semi", rows, self.broadcast_rows)
        return found.mapInArrow(profile, "doc long, size long, sketch binary, own binary")

    def _run(self) -> DataFrame:
        base, _ = self.tables.keep(self._shingled())
        classes = base.where("n_shingles > 0 and doc is not null").groupBy("k1", "k2").agg(F.min("doc").alias("rep"), F.count("*").alias("n"))
        copies = classes.where("n > 1").select("k1", "k2", "rep")
        based, _ = self.tables.keep(base.join(copies, ["k1", "k2"], "left").select("doc", "n_shingles", F.coalesce("rep", "doc").alias("rep")))
        # An id that repeats with different texts is one node with all of their sets, so it signs for them; an id with one copied text doesn't sign.
        of = based.where("doc is not null").groupBy("doc").agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
        self.copies, found = self.tables.keep(of.where("low = high and low <> doc").select("doc"), n=F.count("*"))
        self.n_copies = found["n"]

        met, _ = self.tables.keep(_buckets(self._signed(), self.small))
        pairs = met.where("n > 0 and a <> b")
        pairs, _ = self.tables.keep(pairs.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("n").alias("n")))
        # A document has a bounded number of signatures; what is asked of documents is asked once each.
        large, _ = self.tables.keep(met.where("n = 0").groupBy(F.col("a").alias("doc")).agg(F.collect_set("sig").alias("sigs")))
        wanted, found = self.tables.keep(pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).union(large.select("doc")).distinct(), n=F.count("*"))
        rows = found["n"]
        labels = None
        if rows:
            self.profiles, _ = self.tables.keep(self._profiles(wanted, rows))
            labels = self._verified(self._pruned(pairs), None)
            labels = self._large_buckets(large, labels)
        if labels is None:
            return based.select("doc", "n_shingles", "rep", F.col("rep").alias("component"))
        found = join_counted(based, labels.select(F.col("node").alias("rep"), "label"), "rep", "left", self.labelled, self.broadcast_rows)
        return found.select("doc", "n_shingles", "rep", F.coalesce("label", "rep").alias("component"))

    def _pruned(self, pairs: DataFrame) -> DataFrame:
        """Pairs that sizes and sketches allow."""
        schemes = self.schemes
        side = lambda x: self.profiles.select(F.col("doc").alias(x), F.col("size").alias(f"size_{x}"), F.col("sketch").alias(f"sketch_{x}"))
        met = pairs.join(side("a"), "a").join(side("b"), "b").where(100 * F.least("size_a", "size_b") >= schemes.percent * F.greatest("size_a", "size_b"))

        def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                a, b = ([np.frombuffer(x, np.uint8) for x in _column(batch, f"sketch_{s}").to_pylist()] for s in "ab")
                keep = [may_link(n, m, x, y, schemes) for n, m, x, y in zip(_column(batch, "size_a").to_pylist(), _column(batch, "size_b").to_pylist(), a, b, strict=True)]
                yield pa.RecordBatch.from_arrays([_column(batch, c) for c in "abn"], names=list("abn")).filter(pa.array(keep, pa.bool_()))

        return met.mapInArrow(prune, "a long, b long, n long").dropDuplicates(["a", "b"])

    def _linked(self, pairs: DataFrame, rows: int) -> tuple[DataFrame, int]:
        """(a, b, linked) for each of ``rows`` pairs, by its whole sets, and how many are. Every set goes only where its pairs are."""
        percent = self.schemes.percent
        sent = pairs.select(F.explode(F.array("a", "b")).alias("doc"), "a", "b")
        sets = join_counted(self.profiles.select("doc", "own"), sent, "doc", "inner", 2 * rows, self.broadcast_rows)

        def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, of = (None, None), {}
            out: dict[str, list] = {"a": [], "b": [], "linked": []}

            def close() -> None:
                if now[0] is not None:
                    first, second = of.get(now[0], []), of.get(now[1], [])
                    for name, value in zip(out, (*now, any(links(x, y, percent) for x in first for y in second)), strict=True):
                        out[name].append(value)

            for batch in batches:
                for doc, a, b, own in zip(*(_column(batch, c).to_pylist() for c in ("doc", "a", "b", "own")), strict=True):
                    if (a, b) != now:
                        close()
                        now, of = (a, b), {}
                    of.setdefault(doc, []).append(np.frombuffer(own, np.uint64))
            close()
            yield pa.RecordBatch.from_pydict({"a": pa.array(out["a"], pa.int64()), "b": pa.array(out["b"], pa.int64()), "linked": pa.array(out["linked"], pa.bool_())})

        met = sets.select("doc", "a", "b", "own").repartition("a", "b").sortWithinPartitions("a", "b")
        out, seen = self.tables.keep(met.mapInArrow(verify, "a long, b long, linked boolean"), n=F.count_if("linked"))
        return out, seen["n"]

    def _verified(self, pairs: DataFrame, labels: DataFrame | None) -> DataFrame | None:
        """Labels (node, label) after all links among ``pairs`` between different components have been found.

        Two rounds take the most promising pairs, one each document and then one each two components; the third verifies
        all that is still between components. Each is one verification, whatever the input.
        """
        left, seen = self.tables.keep(pairs, n=F.count("*"))
        rounds = ("document", "components", "rest") if labels is None else ("components", "rest")
        for kind in rounds:
            if not seen["n"]:
                break
            if kind == "document":
                ends = left.select(F.explode(F.array("a", "b")).alias("doc"), F.struct("n", (-F.col("a")).alias("x"), (-F.col("b")).alias("y")).alias("p"))
                best = ends.groupBy("doc").agg(F.max("p").alias("p")).select((-F.col("p.x")).alias("a"), (-F.col("p.y")).alias("b")).distinct()
            elif kind == "components":
                best = left.groupBy("la", "lb").agg(F.max(F.struct("n", (-F.col("a")).alias("x"), (-F.col("b")).alias("y"))).alias("p")).select((-F.col("p.x")).alias("a"), (-F.col("p.y")).alias("b"))
            else:
                best = left.select("a", "b")
            verdict, yes = self._linked(best, seen["n"])  # at most as many pairs as are left
            if yes:
                labels = self._merge(labels, verdict.where("linked"))
            if kind != "rest":
                left = join_counted(left.select("a", "b", "n"), verdict.select("a", "b"), ["a", "b"], "left_anti", seen["n"], self.broadcast_rows)
                left, seen = self.tables.keep(self._apart(left, labels), n=F.count("*"))
        return labels

    def _apart(self, pairs: DataFrame, labels: DataFrame | None) -> DataFrame:
        """Pairs whose ends are in different components, with those components as la < lb."""
        out = self._label(self._label(pairs, "a", "x", labels), "b", "y", labels).where("x <> y")
        return out.select("a", "b", "n", F.least("x", "y").alias("la"), F.greatest("x", "y").alias("lb"))

    def _label(self, df: DataFrame, column: str, name: str, labels: DataFrame | None) -> DataFrame:
        if labels is None:
            return df.withColumn(name, F.col(column))
        known = labels.select(F.col("node").alias(column), F.col("label").alias("__label"))
        return join_counted(df, known, column, "left", self.labelled, self.broadcast_rows).withColumn(name, F.coalesce("__label", column)).drop("__label")

    def _merge(self, labels: DataFrame | None, yes: DataFrame) -> DataFrame:
        """New labels once the linked pairs are added; the step works on components, not on documents."""
        if labels is None:
            labels, self.labelled = components(yes.select("a", "b"), self.tables, broadcast_rows=self.broadcast_rows)
            return labels
        edges = self._label(self._label(yes.select("a", "b"), "a", "x", labels), "b", "y", labels).select(F.col("x").alias("a"), F.col("y").alias("b"))
        more, rows = components(edges, self.tables, broadcast_rows=self.broadcast_rows)
        old = join_counted(labels, more.select(F.col("node").alias("label"), F.col("label").alias("__low")), "label", "left", rows, self.broadcast_rows).select("node", F.coalesce("__low", "label").alias("label"))
        new = join_counted(more, labels.select("node"), "node", "left_anti", self.labelled, self.broadcast_rows).select("node", "label")
        labels, seen = self.tables.keep(old.union(new), n=F.count("*"))
        self.labelled = seen["n"]
        return labels

    def _large_buckets(self, large: DataFrame, labels: DataFrame | None) -> DataFrame | None:
        members = self._label(large, "doc", "label", labels).select(F.explode("sigs").alias("sig"), "doc", "label")
        mixed = members.groupBy("sig").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("sig", F.expr(f"cast(ceil(n / {self.block}) as int)").alias("blocks"))
        members, seen = self.tables.keep(members.join(mixed, "sig"), n=F.count("*"))
        if not seen["n"]:
            return labels
        schemes = self.schemes
        # Buckets with the same members are one: only the first is looked at.
        same = members.groupBy("sig").agg(F.count("*").alias("n"), F.sum(F.xxhash64("doc").cast("decimal(38,0)")).alias("h")).groupBy("n", "h").agg(F.min("sig").alias("sig"))
        members = members.join(same.select("sig"), "sig", "left_semi")
        own = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")
        met = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        met = met.select("sig", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "doc", "label").join(self.profiles.select("doc", "size", "sketch"), "doc")

        def cross(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["size", "doc"], ignore_index=True)
            own, size, label, doc = rows["own"].to_numpy(), rows["size"].to_numpy(), rows["label"].to_numpy(), rows["doc"].to_numpy()
            bits = [np.frombuffer(x, np.uint8) for x in rows["sketch"]]
            # About one bit an element already tells unrelated sets apart; what passes meets the whole sketches.
            short = min(min(map(len, bits)), 1 << max(3, int(size[-1]).bit_length() - 3))
            flat = np.stack([folded(x, short) for x in bits]).view(np.uint64)
            last = np.searchsorted(size, size * 100 // schemes.percent, side="right")
            out = []
            for at in range(0, len(rows), 16):  # by size: a stretch of documents meets those up to 1 / t times its largest
                p, q = np.arange(at, min(at + 16, len(rows))), np.arange(at, last[min(at + 16, len(rows)) - 1])
                far = np.bitwise_count(flat[p][:, None] ^ flat[q][None]).sum(2, dtype=np.int64)
                fine = (far <= (size[p][:, None] + size[q]) * (100 - schemes.percent) // (100 + schemes.percent)) & (label[p][:, None] != label[q]) & (p[:, None] < q) & (q < last[p][:, None])
                if key[1] != key[2]:
                    fine &= own[p][:, None] != own[q]
                for i, j in zip(*np.nonzero(fine), strict=True):
                    x, y = p[i], q[j]
                    if may_link(int(size[x]), int(size[y]), bits[x], bits[y], schemes):
                        out.append((min(doc[x], doc[y]), max(doc[x], doc[y])))
            return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

        pairs = met.groupBy("sig", "i", "j").applyInPandas(cross, "a long, b long").groupBy("a", "b").agg(F.count("*").alias("n"))
        return self._verified(pairs if labels is None else self._apart(pairs, labels), labels)


def join_ngrams(docs: DataFrame, **options) -> DataFrame:
    """(doc, n_shingles, rep, component) per row of ``docs``: rep is the smallest id with an equal set, component the smallest id linked to it over any path."""
    return NgramJoin(docs, **options).result
