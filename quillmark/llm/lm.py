"""Language-model scores of texts: a causal self-attention model over subword ids, beside a smoothed unigram of words.

Words are the runs of characters that aren't white space, A-Z lower-cased; a text is its words and one end. The **base score** adds
log10((c + 1) / (N + V + 1)) over these tokens. Counts are exact over the whole corpus: tasks count words, Spark adds them up.
Scoring holds only the ``hot_words`` most frequent words in memory, which are most of any text; all other words meet their counts in a join, so neither a
frequent word nor a large vocabulary comes to one task.

The **model** reads a word as the subword ids of " word" by a public byte-level BPE, the end as an id of its own. A token's
embedding attends causally to the tokens before it (learned bias by distance), then goes through one hidden layer. A
token's probability is a product of binary decisions along its path in a Huffman tree of the corpus' subword counts; without training these give the
counts' frequencies. Ids that training texts don't have share one leaf evenly, so every text has a probability above zero and
all continuations' probabilities add up to one.

Training is numpy in tasks, over every token of every training text once: a hash deals texts to rounds. In each round every task goes on from the same
model over its own texts (Adagrad); Spark averages the rows that changed, each over the tasks that changed it. Only the model, whose size the BPE's vocabulary bounds,
comes to the driver. With ``stretch`` only a segment of ``segment`` subwords is learnt from in each started ``stretch`` words, at a place that a hash picks.

Scoring cuts a text's ids into windows of ``STRIDE`` tokens to be scored and up to ``CONTEXT`` before them. Windows overlap, every
token is scored once, and attention runs over batches of windows under the causal mask.

Defined results: a null or empty text is the end alone. A null doc_id counts as empty text for the fold. Repeated rows count and are scored each. Without a
training text, base counts are 0 and all ids are as likely. An empty table gives no rows. Other columns aren't used.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.llm.shared import Tables

CONTEXT, STRIDE = 16, 32
_WIDTH, _HIDDEN = 16, 16
#: No word is empty, so the empty one stands for the end of a text.
END = b""
SCORED = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def words(text: str | None) -> list[bytes]:
    """``bytes.lower`` and ``bytes.split`` know ASCII letters and the white space \\x20, \\x09-\\x0D only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


#: White space beyond the one space between words; it may join what stands on both sides of that.
_ODD_SPACE = re.compile(r"[^\S ]")


class Subwords:
    """Ids of " word" for words; the end's id, ``end``, is the largest.

    Many words are encoded as one text with single spaces. The BPE's pattern never crosses such a space, and exactly the first id of a word begins with one, so the ids
    fall apart again. Words that hold other white space are encoded alone. In a text of single spaces the pattern's lookahead, which needs a
    slow engine, never matters.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
        pattern = public_tokenizers.PATTERN
        self._whole = tiktoken.Encoding("subwords", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._plain = tiktoken.Encoding("plain", pat_str=pattern.replace(r"|\s+(?!\S)", ""), mergeable_ranks=ranks, special_tokens={})
        self.end = max(ranks.values()) + 1
        self._first = np.zeros(self.end, bool)
        self._first[[i for token, i in ranks.items() if token[:1] == b" "]] = True

    def one(self, word: bytes) -> list[int]:
        return self._whole.encode_ordinary(" " + word.decode("utf-8", "replace")) if word else [self.end]

    def many(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after the other, and how many each has."""
        text = (b" " + b" ".join(words)).decode("utf-8", "replace") if words else ""
        if words and all(words) and not _ODD_SPACE.search(text):
            ids = self._plain.encode_to_numpy(text).astype(np.int64)
            starts = np.flatnonzero(self._first[ids])
            if len(starts) == len(words):
                return ids, np.diff(np.append(starts, len(ids)))
        lists = [self.one(w) for w in words]
        return np.array([i for x in lists for i in x], np.int64), np.array([len(x) for x in lists], np.int64)

    def all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``many`` for any number of words, among them odd ones and the end."""
        if all(words) and not _ODD_SPACE.search(b" ".join(words).decode("utf-8", "replace")):
            return self.many(words)
        odd = np.array([not w or bool(_ODD_SPACE.search(w.decode("utf-8", "replace"))) for w in words], bool)
        out_sizes = np.zeros(len(words), np.int64)
        plain = [w for w, o in zip(words, odd, strict=True) if not o]
        ids, sizes = self.many(plain)
        out_sizes[~odd] = sizes
        alone = {int(k): self.one(words[k]) for k in np.flatnonzero(odd)}
        for k, x in alone.items():
            out_sizes[k] = len(x)
        stops = np.cumsum(out_sizes)
        flat = np.empty(int(stops[-1]), np.int64)
        inside = np.repeat(~odd, out_sizes)
        flat[inside] = ids
        for k, x in alone.items():
            flat[stops[k] - len(x) : stops[k]] = x
        return flat, out_sizes


@lru_cache(maxsize=1)
def subwords(path: str) -> Subwords:
    return Subwords(path)


# Corpus statistics


def _counted(most: int = 300_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> Iterator[pa.RecordBatch]:
            train, held = seen
            names = list(train.keys() | held.keys())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array([train[w] + held[w] for w in names], pa.int64()), pa.array([train[w] for w in names], pa.int64())], ["word", "n_all", "n"])
            train.clear(), held.clear()

        for batch in batches:
            for held, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counter = seen[held]
                counter.update(words(text.as_py()))
                counter[END] += 1
                if len(counter) > most:
                    yield from flush()
        yield from flush()

    return run


def _subword_counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = subwords(path)
        total = np.zeros(bpe.end + 1, np.int64)
        for batch in batches:
            ids, sizes = bpe.all(batch.column(0).to_pylist())
            # Whole numbers: counts of large corpora are beyond what sums of doubles hold.
            np.add.at(total, ids, np.repeat(batch.column(1).to_numpy(), sizes))
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids])], ["id", "n"])

    return run


def _segments(path: str, segment: int, stretch: int):
    """Lists of subword ids for training: from a place in every started ``stretch`` words on, with the end where the text ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = subwords(path)
        for batch in batches:
            taken, begins, lengths = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = words(text.as_py())
                for k in range(0, max(1, len(found)), stretch):
                    room = max(1, min(stretch, len(found) - k) - segment // 3)
                    at = k + zlib.crc32(f"{doc}:{k}".encode()) % room
                    own = found[at : at + segment]  # a word has one subword at least
                    own += [END] if at + len(own) == len(found) else []
                    taken += own
                    begins.append(at == 0)
                    lengths.append(len(own))
            ids, sizes = bpe.all(taken)
            stops = np.cumsum(np.append(0, sizes))[np.cumsum(np.append(0, lengths))]
            out = [[*([bpe.end] if first else []), *ids[i:j]][: segment + 1] for first, i, j in zip(begins, stops[:-1], stops[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int32()))], ["ids"])

    return run


def _whole(path: str, at_once: int = 200_000, cache: int = 200_000):
    """Lists of subword ids for training: every text from its begin to its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = subwords(path).end
        known = _Words(path, np.arange(end + 1, dtype=np.int32), {})
        for batch in batches:
            texts, done = batch.column(1), 0
            while done < batch.num_rows:
                if len(known) > cache:
                    known = _Words(path, np.arange(end + 1, dtype=np.int32), {})
                found, sizes = [], []
                while done < batch.num_rows and len(found) < at_once:
                    # An end stands before every text too, as its begin.
                    own = [END, *words(texts[done].as_py()), END]
                    found += own
                    sizes.append(len(own))
                    done += 1
                _, _, flat, lengths = known.look_up(found)
                stops = np.append(0, np.cumsum(lengths))[np.append(0, np.cumsum(sizes))]
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(stops.astype(np.int32)), pa.array(flat))], ["ids"])

    return run


# The model


class Tree:
    """A Huffman tree over ``counts``: for every leaf its path of inner nodes, and the side it takes at each, as the sign of the log odds against it.

    Inner nodes are numbered by ascending counts. The part of a path at the last ``DENSE`` ones is a row of ``columns`` and ``sides`` (padded with a column beyond the last and 0), the rest is in ``nodes`` and ``signs``.

    Leaves are dealt to groups, each below one place of the tree. ``members`` has a row of frequent nodes for every group: those above its place, then those below it. ``places`` says
    where in that row the nodes of ``columns`` are (padded with its last place, which is no node's).
    """

    DENSE, GROUPS = 256, 16

    def __init__(self, counts: np.ndarray):
        n = len(counts)
        heap = [(int(c), i) for i, c in enumerate(counts)]
        heapq.heapify(heap)
        weight = np.zeros(2 * n - 1, np.float64)
        weight[:n] = counts
        above, side = np.full(2 * n - 1, -1), np.zeros(2 * n - 1, np.int8)
        bias = np.zeros(max(1, n - 1))
        below, frequent = np.zeros((max(0, n - 1), 2), np.int64), np.zeros(2 * n - 1, np.int64)
        self.top = top = max(0, n - 1 - self.DENSE)
        for k in range(n - 1):
            (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
            below[k] = i, j
            frequent[n + k] = frequent[i] + frequent[j] + (k >= top)
            above[i] = above[j] = k
            side[i], side[j] = -1, 1
            bias[k] = np.log((a + 1e-9) / (b + 1e-9))
            heapq.heappush(heap, (a + b, n + k))
        self.bias = bias.astype(np.float32)
        nodes, signs, starts = [], [], [0]
        often: list[list[tuple[int, int]]] = []
        for leaf in range(n):
            i, own = leaf, []
            while above[i] >= 0:
                if above[i] >= top:
                    own.append((above[i] - top, side[i]))
                else:
                    nodes.append(above[i])
                    signs.append(side[i])
                i = n + above[i]
            often.append(own)
            starts.append(len(nodes))
        self.nodes, self.signs, self.starts = np.array(nodes, np.int32), np.array(signs, np.float32), np.array(starts, np.int64)
        depth = max(map(len, often), default=0)
        self.columns, self.sides = np.full((n, depth), len(bias) - top), np.zeros((n, depth), np.float32)
        for leaf, own in enumerate(often):
            for k, (column, at) in enumerate(own):
                self.columns[leaf, k], self.sides[leaf, k] = column, at
        self.padding = (np.log(2) * (self.sides == 0).sum(1)).astype(np.float32)  # a margin of 0 costs log 2
        self._deal(n, above, below, frequent)

    def _deal(self, n: int, above: np.ndarray, below: np.ndarray, frequent: np.ndarray) -> None:
        """Groups of leaves; ``frequent`` is the number of frequent nodes from a place on downwards."""
        tops = [(-int(frequent[2 * n - 2]), 2 * n - 2)]  # what has most frequent nodes is split next
        while len(tops) < self.GROUPS and tops[0][0] < -1:
            _, i = heapq.heappop(tops)
            for j in below[i - n]:
                heapq.heappush(tops, (-int(frequent[j]), int(j)))
        self.group = np.zeros(n, np.uint16)
        shared, owned = [], []
        for g, (_, i) in enumerate(tops):
            up, found, rest = i, [], [i]
            while above[up] >= 0:
                found.append(above[up] - self.top)
                up = n + above[up]
            shared.append(found)
            found = []
            while rest:
                j = rest.pop()
                if j < n:
                    self.group[j] = g
                else:
                    if j - n >= self.top:
                        found.append(j - n - self.top)
                    rest += below[j - n].tolist()
            owned.append(found)
        width, pad = max(len(a) + len(b) for a, b in zip(shared, owned, strict=True)) + 1, len(self.bias) - self.top
        self.members = np.full((len(tops), width), pad)
        place = np.full((len(tops), pad + 1), width - 1)
        for g, own in enumerate(a + b for a, b in zip(shared, owned, strict=True)):
            self.members[g, : len(own)] = own
            place[g, own] = np.arange(len(own))
        self.places = place[self.group[:, None], self.columns]
        # Where the members are that only one group has, and the others by node.
        flat, mine = self.members.ravel(), np.zeros(self.members.shape, bool)
        for g, (a, b) in enumerate(zip(shared, owned, strict=True)):
            mine[g, len(a) : len(a) + len(b)] = True
        self.single = np.flatnonzero(mine)
        several = np.flatnonzero(~mine.ravel() & (flat < pad))
        order, cuts, self.several_nodes = _sorted(flat[several])
        self.several, self.several_cuts = several[order], cuts

    def order(self, leaves: np.ndarray) -> np.ndarray:
        """An order in which each group's leaves are together."""
        return np.argsort(self.group.take(leaves), kind="stable")


class Visits:
    """The decisions on the way to each of ``leaves``, which are in the tree's order. The nodes with the largest counts, which most of any path goes through, are a product of matrices a group."""

    def __init__(self, tree: Tree, leaves: np.ndarray):
        self.tree, self.leaves = tree, leaves
        width = tree.members.shape[1]
        self.sides = tree.sides.take(leaves, axis=0)
        self.cells = tree.places.take(leaves, axis=0)
        self.cells += (np.arange(len(leaves)) * width)[:, None]
        stops = np.cumsum(np.bincount(tree.group.take(leaves), minlength=len(tree.members))).tolist()
        self.stretches = [(g, slice(i, j)) for g, (i, j) in enumerate(zip([0, *stops], stops)) if i < j]  # noqa: B905
        first = tree.starts.take(leaves)
        self.lengths = tree.starts.take(leaves + 1) - first
        self.ends = np.cumsum(self.lengths)
        self.owner = np.repeat(np.arange(len(leaves)), self.lengths)
        at = np.repeat(first - self.ends + self.lengths, self.lengths)
        at += np.arange(len(at))
        self.nodes, self.signs = tree.nodes.take(at), tree.signs.take(at)

    def _dense(self, u: np.ndarray) -> np.ndarray:
        """The rows of the frequent nodes, and one of zeros for the column that pads."""
        return np.concatenate([u[self.tree.top :], np.zeros((1, *u.shape[1:]), u.dtype)])

    def doubts(self, h: np.ndarray, u: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each decision's log odds against the side that is taken: at frequent nodes as a matrix, where padding is 0, and at the others."""
        # A column of ones beside h brings the biases, and later their gradients, into the products.
        self.h = np.ones((len(h), h.shape[1] + 1), h.dtype)
        self.h[:, :-1] = h
        self.frequent = np.concatenate([self._dense(u), self._dense(b)[:, None]], axis=1).take(self.tree.members, axis=0)
        dense = np.empty((len(h), self.frequent.shape[1]), h.dtype)
        for g, own in self.stretches:
            np.matmul(self.h[own], self.frequent[g].T, out=dense[own])
        often = dense.ravel().take(self.cells)
        often *= self.sides
        self.before = h.take(self.owner, axis=0)
        self.rows = u.take(self.nodes, axis=0)
        rare = np.einsum("ij,ij->i", self.before, self.rows)
        rare += b.take(self.nodes)
        rare *= self.signs
        return often, rare

    def losses(self, doubts: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """-log of each leaf's probability."""
        with np.errstate(over="ignore"):
            parts = [np.exp(d) for d in doubts]
        for part in parts:
            part += 1
            np.log(part, out=part)
        out = self._summed(*parts)
        if not np.isfinite(out).all():  # log odds beyond what exp can take
            out = self._summed(*(np.maximum(d, 0) + np.log1p(np.exp(-np.abs(d))) for d in doubts))
        return out

    def _summed(self, often: np.ndarray, rare: np.ndarray) -> np.ndarray:
        return often @ np.ones(often.shape[1], often.dtype) - self.tree.padding.take(self.leaves) + np.bincount(self.owner, rare, minlength=len(often))

    def gradients(self, doubts: tuple[np.ndarray, np.ndarray], scale: float, u: np.ndarray) -> tuple[np.ndarray, tuple, tuple]:
        """Those of h, of the rows of u, and of the biases, for the sum of losses times ``scale``."""
        top = self.tree.top
        often, rare = (_sigmoid(d) for d in doubts)
        often *= self.sides
        often *= np.float32(scale)
        rare *= self.signs
        rare *= np.float32(scale)
        dense = np.zeros((len(self.h), self.frequent.shape[1]), self.h.dtype)
        dense.ravel()[self.cells] = often
        dh, by_member = np.empty((len(self.h), u.shape[1]), u.dtype), np.zeros(self.frequent.shape, u.dtype)
        for g, own in self.stretches:
            np.matmul(dense[own], self.frequent[g, :, :-1], out=dh[own])
            np.matmul(dense[own].T, self.h[own], out=by_member[g])
        self.rows *= rare[:, None]
        self.before *= rare[:, None]
        some = np.flatnonzero(self.lengths)
        dh[some] += _sums(self.rows, (self.ends - self.lengths).take(some))
        order, cuts, rows = _sorted(self.nodes)
        rows = np.append(rows, np.arange(top, len(u)))
        tree, by_member = self.tree, by_member.reshape(-1, by_member.shape[-1])
        often = np.zeros((len(u) - top, by_member.shape[1]), u.dtype)
        often[tree.members.ravel().take(tree.single)] = by_member.take(tree.single, axis=0)
        often[tree.several_nodes] = _sums(by_member.take(tree.several, axis=0), tree.several_cuts)
        return dh, (rows, np.concatenate([_sums(self.before.take(order, axis=0), cuts), often[:, :-1]])), (rows, np.append(_sums(rare.take(order), cuts), often[:, -1])[:, None])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    out = np.negative(x)
    with np.errstate(over="ignore"):  # one by infinity is 0
        np.exp(out, out=out)
    out += 1
    return np.reciprocal(out, out=out)


class Net:
    """Parameters and gradients. Ids are compact: 0 .. n - 1, the last one for all ids that training doesn't have."""

    DISTANCE = np.subtract.outer(np.arange(CONTEXT, CONTEXT + STRIDE), np.arange(CONTEXT + STRIDE))

    def __init__(self, tree: Tree, n: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) * shape[-1] ** -0.5).astype(np.float32)
        self.tree = tree
        self.p = {
            "E": draw(n, _WIDTH), "q": draw(_WIDTH, _WIDTH), "k": draw(_WIDTH, _WIDTH), "v": draw(_WIDTH, _WIDTH), "near": np.zeros((CONTEXT + STRIDE, 1), np.float32),
            "w1": draw(_WIDTH, _HIDDEN), "c1": np.zeros((1, _HIDDEN), np.float32), "w2": draw(_HIDDEN, _WIDTH), "U": np.zeros((len(tree.bias), _WIDTH), np.float32), "b": tree.bias[:, None].copy(),
        }

    @staticmethod
    def windows(ids: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows over inputs ``ids`` (documents one after the other, ``doc`` says which): rows of positions, which of them may be seen, which are scored."""
        starts = np.flatnonzero(np.diff(doc, prepend=-1))
        sizes = np.diff(np.append(starts, len(ids)))
        count = -(-sizes // STRIDE)
        total = int(count.sum())
        own = np.repeat(np.arange(len(starts)), count)
        first = starts[own] + STRIDE * (np.arange(total) - np.repeat(np.cumsum(count) - count, count))
        at = first[:, None] + np.arange(-CONTEXT, STRIDE)
        seen = (at >= starts[own][:, None]) & (at < (starts + sizes)[own][:, None])
        return np.clip(at, 0, max(0, len(ids) - 1)), seen, seen[:, CONTEXT:]

    def causal(self) -> np.ndarray:
        """The bias of every query of a window for every key: by distance, and closed for what comes later."""
        return np.where(self.DISTANCE >= 0, self.p["near"][np.maximum(self.DISTANCE, 0), 0], np.float32(-1e4))

    def crossed(self) -> np.ndarray:
        """The product of queries' and keys' projections: a logit is a query's embedding times this times a key's embedding."""
        return (self.p["q"] * np.float32(_WIDTH**-0.5)) @ self.p["k"].T

    def step(self, ids: np.ndarray, targets: np.ndarray, at: np.ndarray, seen: np.ndarray, scored: np.ndarray, with_loss: bool = True) -> tuple[float, dict[str, tuple[np.ndarray | None, np.ndarray]]]:
        """The mean loss of a batch of windows (0 unless asked for), and gradients as (rows, values); rows None means all.

        Keys and values aren't projected one by one: queries take both projections of a logit, and values are projected after their mean. Attention weights stay without
        their divisor, which scales what comes out of them and its gradient: both are narrower. A row of ones below the embeddings takes the mean out of the weights' gradient.
        """
        p, n = self.p, len(at)
        flat = lambda t: t.reshape(-1, t.shape[-1])
        tokens = ids.take(at)
        x = p["E"].take(tokens, axis=0)
        xq = np.ascontiguousarray(x[:, CONTEXT:])
        across = np.ones((n, _WIDTH + 1, CONTEXT + STRIDE), x.dtype)
        across[:, :-1] = x.transpose(0, 2, 1)
        crossed = self.crossed()
        # Weights above their logits' gradients, and what each of them multiplies: the gradients of what weights give above queries.
        left = np.empty((n, 2 * STRIDE, CONTEXT + STRIDE), x.dtype)
        right = np.empty((n, 2 * STRIDE, _WIDTH), x.dtype)
        a, ds, g, q = left[:, :STRIDE], left[:, STRIDE:], right[:, :STRIDE], right[:, STRIDE:]
        q[:] = (flat(xq) @ crossed).reshape(xq.shape)
        np.matmul(q, across[:, :-1], out=a)
        a += self.causal()
        part = _partly(seen)
        a[part] += np.where(seen[part], np.float32(0), np.float32(-1e4))[:, None, :]
        if a.max(initial=0) > 60:  # no more than a row's largest may leave its exponential
            a -= a.max(2, keepdims=True)
        np.exp(a, out=a)
        divisor = a @ np.ones((CONTEXT + STRIDE, 1), x.dtype)
        np.maximum(divisor, np.finfo(np.float32).tiny, out=divisor)
        mean = a @ x
        mean /= divisor
        live = np.flatnonzero(scored.ravel())
        goal = targets.take(at[:, CONTEXT:].ravel().take(live))
        order = self.tree.order(goal)
        live, goal = live.take(order), goal.take(order)
        z = flat(mean) @ p["v"]
        z += flat(xq)
        z = z.take(live, axis=0)
        u = z @ p["w1"]
        u += p["c1"]
        r = np.maximum(u, 0)
        h = r @ p["w2"]
        h += z
        visits = Visits(self.tree, goal)
        doubts = visits.doubts(h, p["U"], p["b"][:, 0])
        loss = float(visits.losses(doubts).sum()) if with_loss else 0.0
        out = {}
        dh, out["U"], out["b"] = visits.gradients(doubts, 1 / max(1, len(h)), p["U"])
        du = dh @ p["w2"].T
        du *= u > 0
        out["w2"] = None, r.T @ dh
        out["w1"], out["c1"] = (None, z.T @ du), (None, (np.ones(len(du), du.dtype) @ du)[None])
        dh += du @ p["w1"].T
        dz = np.zeros((n * STRIDE, _WIDTH), x.dtype)
        dz[live] = dh
        out["v"] = None, flat(mean).T @ dz
        np.divide((dz @ p["v"].T).reshape(g.shape), divisor, out=g)
        below = np.empty((n, STRIDE, _WIDTH + 1), x.dtype)
        below[..., :-1] = g
        np.negative(np.einsum("ijk,ijk->ij", g, mean), out=below[..., -1])
        np.matmul(below, across, out=ds)
        ds *= a
        near = np.bincount(np.maximum(self.DISTANCE, 0).ravel(), (np.ones(n, x.dtype) @ ds.reshape(n, -1)) * (self.DISTANCE >= 0).ravel(), minlength=CONTEXT + STRIDE)
        out["near"] = None, near[:, None].astype(np.float32)
        dq = flat(ds @ x)
        d_crossed = flat(xq).T @ dq
        scale = np.float32(_WIDTH**-0.5)
        out["q"], out["k"] = (None, d_crossed @ p["k"] * scale), (None, d_crossed.T @ p["q"] * scale)
        dx = left.transpose(0, 2, 1) @ right
        dz += dq @ crossed.T
        dx[:, CONTEXT:] += dz.reshape(xq.shape)
        order, cuts, rows = _sorted(tokens.ravel())
        out["E"] = rows, _sums(flat(dx).take(order, axis=0), cuts)
        return loss / max(1, len(h)), out

    def fit(self, ids: np.ndarray, targets: np.ndarray, doc: np.ndarray, rate: float, batch: int, rng: np.random.Generator, memory: dict[str, np.ndarray]) -> None:
        """One pass of Adagrad over all windows of these texts, ``batch`` at a time, in an order of its own."""
        at, seen, scored = self.windows(ids, doc)
        order = rng.permutation(len(at))
        for k in range(0, len(order), batch):
            own = order[k : k + batch]
            _, gradients = self.step(ids, targets, at[own], seen[own], scored[own], with_loss=False)
            for name, (rows, g) in gradients.items():
                rows = np.arange(len(g)) if rows is None else rows
                squares = g * g
                squares += memory[name].take(rows, axis=0)
                memory[name][rows] = squares
                np.sqrt(squares, out=squares)
                squares += 1e-8
                np.divide(g, squares, out=squares)
                squares *= rate
                self.p[name][rows] = np.subtract(self.p[name].take(rows, axis=0), squares, out=squares)


def _partly(seen: np.ndarray) -> np.ndarray:
    """Windows that don't see all of their places; what one sees is a stretch."""
    return np.flatnonzero(~(seen[:, 0] & seen[:, -1]))


def _sorted(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that sorts ``rows``, where each begins in it, and the distinct rows."""
    if len(rows) and rows.max() < 1 << 16:
        rows = rows.astype(np.uint16)  # sorted in linear time
    order = np.argsort(rows, kind="stable")
    rows = rows.take(order)
    new = np.ones(len(rows), bool)
    np.not_equal(rows[1:], rows[:-1], out=new[1:])
    cuts = np.flatnonzero(new)
    return order, cuts, rows.take(cuts).astype(np.int64)


def _sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sums of the stretches of ``values`` that begin at ``cuts``."""
    if not len(cuts):
        return values[:0]
    if values.ndim == 2 and values.dtype == np.float32 and values.shape[1] % 2 == 0:  # two columns are added at a time, as one complex number
        return np.add.reduceat(values.view(np.complex64), cuts).view(np.float32)
    return np.add.reduceat(values, cuts)


class Scorer:
    """A trained model that scores windows of many texts at a time."""

    def __init__(self, net: Net, compact: np.ndarray, unseen: int, path: str, block: int = 256):
        p = net.p
        self.net, self.compact, self.path, self.block = net, compact, path, block
        self.log_unseen = float(np.log10(max(1, unseen)))
        self.rare = len(p["E"]) - 1
        self.crossed = net.crossed()
        # Without this bound a window's largest logit would have to be taken out before exponentials.
        self.bounded = np.linalg.norm(p["E"] @ self.crossed, axis=1).max() * np.linalg.norm(p["E"], axis=1).max() + np.abs(p["near"]).max() < 80
        self.b = p["b"][:, 0].copy()
        self.causal = net.causal()

    ones = np.ones((CONTEXT + STRIDE, 1), np.float32)

    def token_scores(self, ids: np.ndarray, targets: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """log10 probability of every target after its inputs; compact ids."""
        out = np.zeros(len(targets))
        at, seen, scored = self.net.windows(ids, doc)
        p = self.net.p
        for k in range(0, len(at), self.block):
            a, live = at[k : k + self.block], np.flatnonzero(scored[k : k + self.block])
            where = a[:, CONTEXT:].ravel().take(live)
            goal = targets.take(where)
            order = self.net.tree.order(goal)
            live, where, goal = live.take(order), where.take(order), goal.take(order)
            x = p["E"].take(ids.take(a), axis=0)
            xq = x[:, CONTEXT:].reshape(-1, _WIDTH)
            s = (xq @ self.crossed).reshape(len(a), STRIDE, _WIDTH) @ np.ascontiguousarray(x.transpose(0, 2, 1))
            s += self.causal
            part = _partly(seen[k : k + self.block])
            s[part] += np.where(seen[k : k + self.block][part], np.float32(0), np.float32(-1e4))[:, None, :]
            if not self.bounded:
                s -= s.max(2, keepdims=True)
            np.exp(s, out=s)
            mean = s @ x
            mean /= s @ self.ones
            z = mean.reshape(-1, _WIDTH) @ p["v"]
            z += xq
            z = z.take(live, axis=0)
            r = z @ p["w1"]
            r += p["c1"]
            z += np.maximum(r, 0, out=r) @ p["w2"]
            visits = Visits(self.net.tree, goal)
            out[where] = visits.losses(visits.doubts(z, p["U"], self.b)) / -np.log(10)
            out[where[goal == self.rare]] -= self.log_unseen
        return out


def new_net(counts: dict[int, int], end: int) -> tuple[Net, np.ndarray, int]:
    """An untrained net for these subword counts, the map from ids to compact ones, and the number of ids that share the last."""
    ids = np.array(sorted(counts), int)
    compact = np.full(end + 1, len(ids), np.int32)
    compact[ids] = np.arange(len(ids))
    unseen = end + 1 - len(ids)
    weights = np.array([counts[i] for i in ids] + ([1] if unseen else []), np.int64)
    return Net(Tree(weights), len(ids) + 1), compact, unseen


def _trained(read: Callable, net: Net, compact: np.ndarray, round_: int, rate: float, batch: int, passes: int):
    """Rows of the parameters that a task's texts changed, by how much; ``read`` makes lists of ids of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Net.__new__(Net)
        own.tree, own.p = net.tree, {k: v.copy() for k, v in net.p.items()}
        rng = np.random.default_rng(round_)
        memory = {k: np.zeros_like(v) for k, v in own.p.items()}
        for b in read(batches):
            lists = b.column(0)
            offsets, flat = lists.offsets.to_numpy(), compact[lists.values.to_numpy()]
            sizes = np.diff(offsets)
            doc = np.repeat(np.arange(len(sizes)), np.maximum(sizes - 1, 0))
            inside = np.ones(len(flat), bool)
            inside[offsets[1:][sizes > 0] - 1] = False  # a text's last id is no input, its first one no target
            inputs = np.flatnonzero(inside)
            for _ in range(passes):
                own.fit(flat[inputs], flat[inputs + 1], doc, rate, batch, rng, memory)
        for t, (name, after) in enumerate(own.p.items()):
            rows, values = _rows(after - net.p[name])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), t, np.int32)), pa.array(rows.astype(np.int32)), *[pa.array(values[:, i].astype(float)) for i in range(_WIDTH)]], ["tab", "row", *[f"x{i}" for i in range(_WIDTH)]])

    return run


def _rows(delta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A matrix as rows of ``_WIDTH`` numbers, without those that are zero."""
    flat = np.zeros(-(-delta.size // _WIDTH) * _WIDTH, np.float32)
    flat[: delta.size] = delta.ravel()
    flat = flat.reshape(-1, _WIDTH)
    rows = np.flatnonzero(flat.any(1))
    return rows, flat[rows]


def train(texts: DataFrame, read: Callable, net: Net, compact: np.ndarray, *, rounds: int, passes: int, rate: float, batch: int) -> None:
    """Rounds of local training and averaging, each over its share of the ``texts`` (doc_id, text); ``net`` is changed."""
    columns = [f"x{i}" for i in range(_WIDTH)]
    schema = "tab int, row int, " + ", ".join(f"{c} double" for c in columns)
    for k in range(rounds):
        own = texts.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds)) == k)
        changed = own.mapInArrow(_trained(read, net, compact, k, rate, batch, passes), schema)
        mean = changed.groupBy("tab", "row").agg(*[F.avg(c).alias(c) for c in columns]).toArrow()
        tab, row = (mean.column(c).to_numpy() for c in ("tab", "row"))
        values = np.stack([mean.column(c).to_numpy() for c in columns], axis=1).astype(np.float32) if mean.num_rows else np.zeros((0, _WIDTH), np.float32)
        for t, name in enumerate(net.p):
            flat = np.zeros((-(-net.p[name].size // _WIDTH), _WIDTH), np.float32)
            flat[row[tab == t]] = values[tab == t]
            net.p[name] = net.p[name] + flat.ravel()[: net.p[name].size].reshape(net.p[name].shape)


# Scoring


class _Places(dict):
    """A new word gets the next place."""

    def __init__(self):
        self.names: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self.names)
        self.names.append(word)
        return place


class _Words:
    """What is known of words, in growing arrays: their ids, their number of them, their counts."""

    def __init__(self, path: str, compact: np.ndarray, hot: dict[bytes, int]):
        self.bpe, self.compact, self.hot = subwords(path), compact, hot
        self.places = _Places()
        self.ids, self.sizes, self.counts = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def __len__(self) -> int:
        return len(self.sizes)

    @property
    def names(self) -> list[bytes]:
        return self.places.names

    def look_up(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places and counts of words, all their ids one after the other, and how many each has."""
        take = np.fromiter(map(self.places.__getitem__, found), np.int64, len(found))
        new = self.names[len(self) :]
        if new:
            ids, sizes = self.bpe.all(new)
            self.ids = np.append(self.ids, self.compact[ids])
            self.sizes = np.append(self.sizes, sizes)
            self.counts = np.append(self.counts, np.fromiter(map(self.hot.get, new, repeat(-1)), np.int64, len(new)))
        ends = np.cumsum(self.sizes)
        lengths = self.sizes[take]
        stops = np.cumsum(lengths)
        at = np.arange(stops[-1]) + np.repeat((ends - self.sizes)[take] - stops + lengths, lengths)
        return take, self.counts[take], self.ids[at], lengths


def _scored(scorer: Scorer, hot: pa.Table, at_once: int = 200_000, cache: int = 200_000):
    names = ["part", "row", "doc_id", "held_out", "n_tokens", "hot_known", "hot_log", "score", "rare", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = dict(zip(hot.column("word").to_pylist(), hot.column("n").to_pylist(), strict=True))
        known = _Words(scorer.path, scorer.compact, counts)
        begin = int(scorer.compact[-1])
        row = 0
        for batch in batches:
            part, ids, folds, texts = (batch.column(i) for i in range(4))
            done = 0
            while done < batch.num_rows:
                if len(known) > cache:
                    known = _Words(scorer.path, scorer.compact, counts)
                first, found, sizes = done, [], []
                while done < batch.num_rows and len(found) < at_once:
                    own = words(texts[done].as_py())
                    found += own
                    found.append(END)
                    sizes.append(len(own) + 1)
                    done += 1
                take, count, flat, lengths = known.look_up(found)
                n = np.array(sizes, np.int64)
                starts = np.cumsum(n) - n
                owner = np.repeat(np.arange(len(n)), n)
                log = np.where(count > 0, np.log10(np.maximum(count, 0) + 1.0), 0.0)
                doc = np.repeat(owner, lengths)
                inputs = np.empty_like(flat)
                inputs[1:] = flat[:-1]
                inputs[np.flatnonzero(np.diff(doc, prepend=-1))] = begin
                scores = np.bincount(doc, scorer.token_scores(inputs, flat, doc), minlength=len(n))
                pairs, times = np.unique(owner[count < 0] * np.int64(len(known)) + take[count < 0], return_counts=True)
                offsets = np.searchsorted(pairs // len(known), np.arange(len(n) + 1)).astype(np.int32)
                rare = pa.array(list(map(known.names.__getitem__, (pairs % len(known)).tolist())), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.slice(first, len(n)), pa.array(np.arange(row, row + len(n))), ids.slice(first, len(n)), folds.slice(first, len(n)), pa.array(n), pa.array(np.add.reduceat((count > 0).astype(np.int64), starts)),
                        pa.array(np.add.reduceat(log, starts)), pa.array(scores), pa.ListArray.from_arrays(pa.array(offsets), rare), pa.ListArray.from_arrays(pa.array(offsets), pa.array(times.astype(np.int64))),
                    ],
                    names,
                )
                row += len(n)

    return run


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(7)) == 2


def score_texts(
    documents: DataFrame,
    vocabulary: str,
    *,
    rounds: int = 3,
    passes: int = 1,
    rate: float = 0.1,
    batch: int = 128,
    segment: int = 48,
    stretch: int | None = None,
    hot_words: int = 100_000,
) -> DataFrame:
    """A row per row of ``documents`` (doc_id, text), columns ``SCORED``; ``vocabulary`` is a tiktoken file of ranks."""
    spark = documents.sparkSession
    given = documents.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("held_out", fold(F.col("doc_id")))
    tables = Tables(spark, "lm")
    counted = given.select("held_out", "text").mapInArrow(_counted(), "word binary, n_all long, n long").groupBy("word").agg(F.sum("n_all").alias("n_all"), F.sum("n").alias("n"))
    counts, seen = tables.keep(counted, tokens=F.sum("n"), distinct=F.count_if(F.col("n") > 0))
    total, distinct = seen["tokens"] or 0, seen["distinct"] or 0

    # Words are hot from the power of two on above which there are at most hot_words.
    sizes = {r["size"]: r["count"] for r in counts.groupBy(F.floor(F.log2("n_all")).cast("int").alias("size")).count().collect()}
    least, kept = 64, 0
    while least > 0 and kept + sizes.get(least - 1, 0) <= hot_words:
        least -= 1
        kept += sizes.get(least, 0)
    hot = counts.where(F.col("n_all") >= F.lit(2.0) ** least).select("word", "n").toArrow()

    end = subwords(vocabulary).end
    of_subwords = {r["id"]: r["n"] for r in counts.where("n > 0").select("word", "n").mapInArrow(_subword_counts(vocabulary), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()}
    net, compact, unseen = new_net(of_subwords, end)
    if total:
        read = _segments(vocabulary, segment, stretch) if stretch else _whole(vocabulary)
        train(given.where(~F.col("held_out")).select("doc_id", "text"), read, net, compact, rounds=rounds, passes=passes, rate=rate, batch=batch)

    id_type = documents.select("doc_id").schema[0].dataType.simpleString()
    schema = f"part long, row long, doc_id {id_type}, held_out boolean, n_tokens long, hot_known long, hot_log double, score double, rare array<binary>, times array<long>"
    scored, _ = tables.keep(given.select(F.spark_partition_id().cast("long").alias("part"), "doc_id", "held_out", "text").mapInArrow(_scored(Scorer(net, compact, unseen, vocabulary), hot), schema))
    rare = scored.select("part", "row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("part", "row", F.col("w.rare").alias("word"), "w.times")
    met = rare.join(counts.where("n > 0").select("word", "n"), "word").groupBy("part", "row").agg(F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_log"))
    both = scored.drop("rare", "times").join(met, ["part", "row"], "left")
    base = F.col("hot_log") + F.coalesce("rare_log", F.lit(0.0)) - F.col("n_tokens") * F.lit(float(np.log10(total + distinct + 1)))
    return both.select("doc_id", "held_out", "n_tokens", (F.col("hot_known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
