"""Best-fit packing of tokenized documents into sequences, improved by swap-based local search.

Tokens are made by the byte-level BPE named by path, in tasks. A document longer than a sequence is cut from its end, so
that all its pieces but the first are full; full pieces are sequences of their own. The other pieces are dealt by a hash
of (doc_id, piece) over shards of about ``shard_pieces`` pieces, a number that doesn't grow with the input, and each
shard is packed on its own: best fit by descending length, then local search. What stays in sequences that are less than three quarters full is dealt
over fewer shards and packed again, until one shard holds all of it, so hardly a sequence is due to the sharding. Pieces that fill such
sequences in every shard, since nothing fits beside them, end it too, after shards of eight times the size. The search takes underfull bins from the emptiest up
and moves documents out of them into other bins, exchanges one for one or two for one, whenever that makes the sum
of squared fills grow, until bins empty or no step helps. Every bin and every pair of a donor's documents is tried; bins with equal
contents are tried once.

Defined results: a null or empty text is the end token alone. Ties go by (length, doc_id, piece), so a lost task packs
the same again. Repeated rows are packed as often as they come, rows without an id too. An empty table gives no rows. Other columns aren't used.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.shared import Tables, checkpointed

#: Where a run of white space that another character follows must be cut: the BPE's pattern keeps its last character for the next word.
_RUN = regex.compile(r"\p{White_Space}(?=\p{White_Space}\P{White_Space})")
_SPECIAL, _SPECIAL_ID = "<|endoftext|>", 50256
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@lru_cache(maxsize=2)
def encoder(ranks_path: str):
    """tiktoken's form of the vocabulary, which gives the ids of the ``tokenizers`` file and is faster.

    The published pattern's ``\\s+(?!\\S)`` needs a slow engine. It matters only where white space of two or more
    characters is followed by something else; texts are cut there and the rest of the pattern is the same without it.
    """
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
    bpe = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN.replace(r"|\s+(?!\S)", ""), mergeable_ranks=ranks, special_tokens={_SPECIAL: _SPECIAL_ID})

    def encode(text: str) -> np.ndarray:
        ids = []
        for k, between in enumerate(text.split(_SPECIAL)):  # the special token ends a text like the text's own end does
            if k:
                ids.append(np.array([_SPECIAL_ID]))
            at = 0
            for m in _RUN.finditer(between):
                ids.append(bpe.encode_to_numpy(between[at : m.end()], disallowed_special=()))
                at = m.end()
            ids.append(bpe.encode_to_numpy(between[at:], disallowed_special=()))
        return np.concatenate(ids).astype("<u4")

    return encode


def ranks_path(json_path: str) -> str:
    return json_path.removesuffix(".json") + ".tiktoken"


def cut(total: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: the first takes what the full ones leave."""
    first = total % size or size
    return [(0, min(first, total))] + [(s, size) for s in range(first, total, size)]


def tokenized(docs: DataFrame, tokenizer: str, *, size: int = 1024, end_id: int = 2) -> DataFrame:
    """A row per piece with the checksum of its ids."""
    ranks = ranks_path(tokenizer)

    def encode_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks)
        for batch in batches:
            out: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(encode(text), np.uint32(end_id)).astype("<u4") if text else np.array([end_id], "<u4")
                for k, (start, length) in enumerate(cut(len(ids), size)):
                    for name, value in zip(out, (doc_id, k, start, length, zlib.crc32(ids[start : start + length].tobytes())), strict=True):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict({n: pa.array(v, pa.int32() if n == "piece" else pa.int64()) for n, v in out.items()})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(encode_all, PIECES)


class Bins:
    """Bins of one shard: the members' lengths and the room left, with the bins ordered by room."""

    def __init__(self, size: int):
        self.size, self.members, self.room, self.order = size, [], [], []

    def best_fit(self, length: int, item: int) -> None:
        k = bisect_left(self.order, (length, -1))
        if k == len(self.order):
            b = len(self.room)
            self.members.append([])
            self.room.append(self.size)
        else:
            b = self.order.pop(k)[1]
        self.members[b].append(item)
        self.room[b] -= length
        if self.room[b]:
            insort(self.order, (self.room[b], b))


class OpenBins:
    """The underfull bins of a search, by room and by contents; bins with the same lengths in them stand for each other."""

    def __init__(self, members: list[list[int]], lengths: list[int], size: int):
        self.members, self.lengths, self.size = members, lengths, size
        self.fill = [sum(lengths[i] for i in m) for m in members]
        self.rooms: list[tuple[int, int]] = []
        self.alike: dict[tuple[int, ...], set[int]] = {}
        for b in range(len(members)):
            self._put(b)

    def _contents(self, b: int) -> tuple[int, ...]:
        return tuple(sorted(self.lengths[i] for i in self.members[b]))

    def is_open(self, b: int) -> bool:
        return 0 < self.fill[b] < self.size

    def _put(self, b: int) -> None:
        if self.is_open(b):
            insort(self.rooms, (self.size - self.fill[b], b))
            self.alike.setdefault(self._contents(b), set()).add(b)

    def _take(self, b: int) -> None:
        if self.is_open(b):
            self.rooms.pop(bisect_left(self.rooms, (self.size - self.fill[b], b)))
            same = self.alike[self._contents(b)]
            same.discard(b)
            if not same:
                del self.alike[self._contents(b)]

    def exchange(self, donor: int, to: int, out: list[int], back: int | None) -> None:
        self._take(donor), self._take(to)
        for x in out:
            self.members[donor].remove(x)
            self.members[to].append(x)
        if back is not None:
            self.members[to].remove(back)
            self.members[donor].append(back)
        moved = sum(self.lengths[x] for x in out) - (self.lengths[back] if back is not None else 0)
        self.fill[donor] -= moved
        self.fill[to] += moved
        self._put(donor), self._put(to)

    def step(self, donor: int, i: int) -> tuple[int, list[int], int | None] | None:
        """(bin, documents that go there, document that comes back) of a helpful step for document i of the donor, or None."""
        k = bisect_left(self.rooms, (self.lengths[i], -1))
        if k < len(self.rooms) and self.rooms[k][1] == donor:
            k += 1
        # A move: the tightest bin that takes it is the fullest one, so if it doesn't help none does.
        if k < len(self.rooms) and self.fill[self.rooms[k][1]] + self.lengths[i] > self.fill[donor]:
            return self.rooms[k][1], [i], None
        others = {self.lengths[j]: j for j in self.members[donor] if j != i}
        out = {self.lengths[i]: [i]} | {self.lengths[i] + n: [i, j] for n, j in others.items() if n <= self.lengths[i]}
        best: tuple[int, int, int, int] | None = None
        for contents, same in self.alike.items():
            fill = sum(contents)
            if same == {donor}:
                continue
            for back in set(contents):
                for gone in out:
                    # The step helps when the receiver ends fuller than the donor was; the fullest such end is taken.
                    end = fill + gone - back
                    if gone > back and end <= self.size and end > self.fill[donor] and (best is None or (-end, gone, back) < best[:3]):
                        best = -end, gone, back, min(same - {donor})
            if best is not None and best[0] == -self.size:
                break
        if best is None:
            return None
        _, gone, back, to = best
        return to, out[gone], next(x for x in self.members[to] if self.lengths[x] == back)


def improve(members: list[list[int]], lengths: list[int], size: int) -> list[list[int]]:
    """Local search over the underfull bins; every step raises the sum of squared fills, so it ends.

    A donor bin, taken from the emptiest up, gives away its documents: by a move into a bin with room, else by swapping
    one of them for one smaller, or two for one smaller, in another bin. A step raises the squared fill exactly when
    the receiving bin ends up fuller than the donor was before. The search ends with a round in which no step helps.
    """
    bins = OpenBins([list(m) for m in members], lengths, size)
    changed = True
    while changed:
        changed = False
        for donor in [b for _, b in reversed(bins.rooms)]:
            tried: set[int] = set()  # lengths without a helpful step since the donor last changed
            while bins.is_open(donor):
                i = max((x for x in bins.members[donor] if lengths[x] not in tried), key=lambda x: (lengths[x], -x), default=None)
                if i is None:
                    break
                step = bins.step(donor, i)
                if step is None:
                    tried.add(lengths[i])
                else:
                    bins.exchange(donor, *step)
                    tried.clear()
                    changed = True
    return [m for m in bins.members if m]


def pack_shard(lengths: list[int], size: int) -> list[list[int]]:
    """Lists of indices into ``lengths``, one a sequence."""
    bins = Bins(size)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        bins.best_fit(lengths[i], i)
    return improve(bins.members, lengths, size)


def pack(docs: DataFrame, tokenizer: str, *, size: int = 1024, end_id: int = 2, shard_pieces: int = 8192) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    tables = Tables(docs.sparkSession, "packing")
    schema = PIECES + ", sequence_id long, offset long, open boolean"

    def packer(level: int):
        def pack_one(rows: pa.Table) -> pa.Table:
            rows = rows.sort_by([(c, "ascending") for c in ("length", "doc_id", "piece", "ids_crc32")])
            sequence, offset, is_open = np.zeros(len(rows), "int64"), np.zeros(len(rows), "int64"), np.zeros(len(rows), bool)
            lengths = rows["length"].to_pylist()
            for s, members in enumerate(pack_shard(lengths, size)):
                at = 0
                for i in members:
                    sequence[i], offset[i] = (((level << 24) + rows["shard"][0].as_py()) << 32) + s, at
                    at += lengths[i]
                is_open[members] = 4 * at < 3 * size
            columns = {"sequence_id": pa.array(sequence), "offset": pa.array(offset), "open": pa.array(is_open)}
            rows = rows.select([c.split()[0] for c in PIECES.split(", ")])
            for name, column in columns.items():
                rows = rows.append_column(name, column)
            return rows

        return pack_one

    left, seen = tables.keep(tokenized(docs, tokenizer, size=size, end_id=end_id), n=F.count("*"))
    full, level, n, room = None, 0, seen["n"], shard_pieces
    while True:
        shards = max(1, -(-n // room))
        dealt = left.withColumn("shard", F.pmod(F.xxhash64(F.lit(level), "doc_id", "piece", "ids_crc32"), F.lit(shards)))
        packed, seen = tables.keep(dealt.groupBy("shard").applyInArrow(packer(level), schema), n=F.count_if("open"))
        # Sequences that are less than three quarters full are packed again together, in fewer shards each time; where hardly any got fuller, in larger ones.
        stuck = 5 * seen["n"] > 4 * n
        last = shards == 1 or not seen["n"] or (stuck and room >= 8 * shard_pieces)
        done = packed if last else packed.where("not open")
        full = done if full is None else full.unionByName(done)
        if last:
            break
        room = 2 * room if stuck else room
        left, n, level = packed.where("open").select(*[c.split()[0] for c in PIECES.split(", ")]), seen["n"], level + 1
    out = checkpointed(full.drop("open"))
    tables.drop()
    return out
