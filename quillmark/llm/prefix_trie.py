"""The prefix trie of conversations that share other conversations' first turns, by composable fingerprints.

A rebuilt conversation is the head of a base conversation and its own turns after its own head. Its text is never built. A sequence of
turns has the fingerprint P(empty) = 0, P(s + turn) = P(s) * r + key(turn) modulo a prime, with two keys and two r. Sequences under
concatenation are a monoid, and so are their fingerprints: P(s + t) = P(s) * r**len(t) + P(t). The product of a suffix comes from two prefix products
of the same conversation, P(t) = P(s + t) - P(s) * r**len(t). So one pass over the turns in order, in which every turn
keeps its conversation's product up to it, gives every prefix of every rebuilt conversation: the base's product at the head's
end, combined with the product of the conversation's own turns between its head and a later turn.

The pass is a segmented scan. Turns are sorted by ranges over all partitions, whatever their conversation; a first pass hands the product of each partition's
last conversation to the next partition (a row a partition reaches the driver), a second one multiplies it in. A conversation with a
third of all turns is spread over many tasks.

Prefixes of equal depth and fingerprint form a node. Equality is verified, by induction over depths: the members of a
node must all come from one parent node and refer to stored turns of one key, and turns of one key must all have one role and text. If that fails
anywhere, everything is done again with other keys and other r, so a collision costs time and never changes a result.

Sums over subtrees use the path that a smallest member takes: the nodes with one smallest member are consecutive depths. Paths add up along
their tree by doubling the distance of the ancestor that they add to, in as many rounds as the logarithm of its height; sums within a path are taken
in chunks of depths. Member ids that end at a node are sorted by ranges, cut into strings of bounded size and hashed in order.

Defined results: null role or text is empty, rows with a null conv_id are left out. Turns are ordered by (turn, null first, role,
SHA-256 of the text); repeated rows are turns of their own. ``%`` has the sign of its left side, as in SQL. A conversation whose base is absent has no head, one
without turns after its head may be turnless, and is a member of the root. An empty table has no nodes. Other columns aren't used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmark.llm.shared import Tables, checkpointed, join_counted

#: Fingerprints are numbers below these primes.
MODULI = (2**61 - 1,)
NODES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


class Fingerprints:
    """Products of turns modulo a prime, for two values of r; a fingerprint is a pair of whole numbers."""

    EMPTY = (0, 0)

    def __init__(self, seed: int, modulus: int):
        self.m = modulus
        self.r = tuple(int.from_bytes(hashlib.blake2b(f"{seed}:{k}".encode()).digest()[:16], "big") % (modulus - 1) + 1 for k in range(2))
        self.inverse = tuple(pow(r, -1, modulus) for r in self.r)

    def extend(self, p: tuple[int, int], key: tuple[int, int]) -> tuple[int, int]:
        return (p[0] * self.r[0] + key[0]) % self.m, (p[1] * self.r[1] + key[1]) % self.m

    def parent(self, p: tuple[int, int], key: tuple[int, int]) -> tuple[int, int]:
        """The fingerprint before the last turn."""
        return (p[0] - key[0]) * self.inverse[0] % self.m, (p[1] - key[1]) * self.inverse[1] % self.m

    def combine(self, head: tuple[int, int], tail: tuple[int, int], length: int) -> tuple[int, int]:
        """The fingerprint of a sequence and ``length`` turns after it."""
        return tuple((h * pow(r, length, self.m) + t) % self.m for h, t, r in zip(head, tail, self.r, strict=True))

    def after(self, whole: tuple[int, int], head: tuple[int, int], length: int) -> tuple[int, int]:
        """The fingerprint of the last ``length`` turns, from those of the whole and of what comes before them."""
        return tuple((w - h * pow(r, length, self.m)) % self.m for w, h, r in zip(whole, head, self.r, strict=True))


def _pairs(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def _last_segments(prints: Fingerprints):
    """A row a partition: its first and last conversation, how many turns it has of the last one and their product."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        n, p, part = 0, prints.EMPTY, 0
        for batch in batches:
            for part, conv, k1, k2 in _pairs(batch, "part", "conv", "k1", "k2"):  # noqa: B007
                if first is None:
                    first = conv
                if conv != last:
                    last, n, p = conv, 0, prints.EMPTY
                n, p = n + 1, prints.extend(p, (k1, k2))
        if first is not None:
            yield _batch([(part, first, last, n, *p)], ["part", "first", "last", "n", "p1", "p2"])

    return run


def _scan(prints: Fingerprints, carried: dict[int, tuple[int, int, tuple[int, int]]]):
    """Every turn with its position and its conversation's product up to it; ``carried`` is what earlier partitions hold of a partition's first conversation."""
    names = ["conv", "pos", "p1", "p2", "k1", "k2", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n, p, started = None, 0, prints.EMPTY, False
        for batch in batches:
            out = []
            for part, conv, k1, k2, size in _pairs(batch, "part", "conv", "k1", "k2", "bytes"):
                if not started:
                    started = True
                    if part in carried:
                        last, n, p = carried[part]
                if conv != last:
                    last, n, p = conv, 0, prints.EMPTY
                p = prints.extend(p, (k1, k2))
                out.append((conv, n, *p, k1, k2, size))
                n += 1
            yield _batch(out, names)

    return run


def _carried(prints: Fingerprints, segments: list) -> dict[int, tuple[int, int, tuple[int, int]]]:
    """For each partition whose first conversation began earlier: that conversation, its turns so far and their product."""
    out, before = {}, None
    for s in sorted(segments, key=lambda s: s["part"]):
        own = (s["n"], (s["p1"], s["p2"]))
        if before is not None and before[0] == s["first"]:
            out[s["part"]] = before
            if s["first"] == s["last"]:
                own = (before[1] + own[0], prints.combine(before[2], own[1], own[0]))
        before = (s["last"], *own)
    return out


def _own_prefixes(prints: Fingerprints):
    """Prefixes that end at a conversation's own turn: the base's head combined with the product of the own turns up to it."""
    names = ["conv", "depth", "f1", "f2", "g1", "g2", "k1", "k2", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, pos, p1, p2, k1, k2, size, h, hb, s1, s2, o1, o2 in _pairs(batch, "conv", "pos", "p1", "p2", "k1", "k2", "bytes", "h", "hb", "s1", "s2", "o1", "o2"):
                n = pos + 1 - h
                f = prints.combine((o1, o2), prints.after((p1, p2), (s1, s2), n), n)
                out.append((conv, hb + n, *f, *prints.parent(f, (k1, k2)), k1, k2, size))
            yield _batch(out, names)

    return run


def _ends(prints: Fingerprints):
    """The node at which each rebuilt conversation ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, hb, n, s1, s2, o1, o2, e1, e2 in _pairs(batch, "conv", "hb", "n_own", "s1", "s2", "o1", "o2", "e1", "e2"):
                f = prints.combine((o1, o2), prints.after((e1, e2), (s1, s2), n), n) if n else (o1, o2)
                out.append((hb + n, *f, conv))
            yield _batch(out, ["depth", "f1", "f2", "conv"])

    return run


def _id_strings(most: int):
    """Strings of a node's next member ids, at most ``most`` ids each; rows come sorted by node and id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*[pa.array([d[i] for d in done], pa.int64()) for i in range(4)], pa.array([d[4] for d in done], pa.large_string())], ["depth", "f1", "f2", "first", "ids"])

        node, ids, done = None, [], []
        for batch in batches:
            for depth, f1, f2, conv in _pairs(batch, "depth", "f1", "f2", "conv"):
                if ids and ((depth, f1, f2) != node or len(ids) >= most):
                    done.append((*node, ids[0], ",".join(map(str, ids))))
                    ids = []
                node = (depth, f1, f2)
                ids.append(conv)
            if done:
                yield flush(done)
                done = []
        if ids:
            yield flush([(*node, ids[0], ",".join(map(str, ids)))])

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's strings in order; only the hash's state is kept between them."""

    def flush(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*[pa.array([d[i] for d in done], pa.int64()) for i in range(3)], pa.array([d[3] for d in done], pa.string())], ["depth", "f1", "f2", "ends_sha256"])

    node, digest, done = None, None, []
    for batch in batches:
        for depth, f1, f2, ids in _pairs(batch, "depth", "f1", "f2", "ids"):
            if (depth, f1, f2) != node:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = (depth, f1, f2), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        if done:
            yield flush(done)
            done = []
    if node is not None:
        yield flush([(*node, digest.hexdigest())])


def _keyed(conversations: DataFrame, seed: int) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    given = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), text.alias("text"))
    return given.withColumn("k1", F.xxhash64(F.lit(2 * seed), "role", "text")).withColumn("k2", F.xxhash64(F.lit(2 * seed + 1), "role", "text"))


def _prefix_nodes(conversations: DataFrame, tables: Tables, prints: Fingerprints, seed: int, base: Callable, head: Callable, max_head: int, chunk: int) -> tuple[DataFrame, DataFrame, int, bool]:
    """Nodes (depth, f, parent's g, conv, n_convs, bytes), the rebuilt conversations, the number of nodes, and whether all is verified."""
    keyed = _keyed(conversations, seed)
    classes = keyed.groupBy("k1", "k2").agg(F.min(F.struct("role", "text")).alias("low"), F.max(F.struct("role", "text")).alias("high"))
    _, seen = tables.keep(classes.select("k1", (F.col("low") != F.col("high")).alias("mixed")).where("mixed"), mixed=F.count("*"))
    if seen["mixed"]:
        return None, None, 0, False

    order = ["conv", "turn", "role", "tie"]
    turns = keyed.select("conv", "turn", "role", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("tie"), "k1", "k2", F.octet_length("text").cast("long").alias("bytes"))
    turns = checkpointed(turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "k1", "k2", "bytes")).withColumn("part", F.spark_partition_id().cast("long"))
    segments = turns.mapInArrow(_last_segments(prints), "part long, first long, last long, n long, p1 long, p2 long").collect()
    scanned, _ = tables.keep(turns.mapInArrow(_scan(prints, _carried(prints, segments)), "conv long, pos long, p1 long, p2 long, k1 long, k2 long, bytes long"))

    first = F.when(F.col("pos") < max_head, F.struct("pos", "p1", "p2", "k1", "k2", "bytes"))
    convs = scanned.groupBy("conv").agg((F.max("pos") + 1).alias("len"), F.max(F.struct("pos", "p1", "p2")).alias("end"), F.array_sort(F.collect_list(first)).alias("own"))
    convs, _ = tables.keep(convs)
    h = F.when(head(F.col("conv")) <= max_head, head(F.col("conv"))).otherwise(F.raise_error(F.lit(f"a head is longer than {max_head} turns"))).cast("long")
    rebuilt = convs.withColumn("h", h).withColumn("base", base(F.col("conv"))).join(convs.select(F.col("conv").alias("base"), F.col("own").alias("other")), "base", "left")
    rebuilt = rebuilt.withColumn("other", F.coalesce("other", F.slice("own", 1, 0))).withColumn("hb", F.least("h", F.size("other")).cast("long")).withColumn("other", F.slice("other", F.lit(1), F.col("hb").cast("int")))
    n_own = F.greatest(F.col("len") - F.col("h"), F.lit(0)).cast("long")
    at = lambda turns, n, p: F.coalesce(F.get(turns, (n - 1).cast("int"))[p], F.lit(0).cast("long"))
    rebuilt, _ = tables.keep(
        rebuilt.select(
            "conv", "len", "h", "hb", "other", n_own.alias("n_own"), *[at(F.col("own"), F.col("h"), f"p{k}").alias(f"s{k}") for k in (1, 2)],
            *[at(F.col("other"), F.col("hb"), f"p{k}").alias(f"o{k}") for k in (1, 2)], F.col("end.p1").alias("e1"), F.col("end.p2").alias("e2"),
        )
    )

    zero = F.lit(0).cast("long")
    root = rebuilt.select("conv", zero.alias("depth"), *[zero.alias(c) for c in ("f1", "f2", "g1", "g2", "k1", "k2", "bytes")])
    earlier = lambda p: F.coalesce(F.get("other", F.col("i") - 1)[p], zero)
    heads = rebuilt.select("conv", "other", F.posexplode("other").alias("i", "t"))
    heads = heads.select("conv", (F.col("i") + 1).cast("long").alias("depth"), F.col("t.p1").alias("f1"), F.col("t.p2").alias("f2"), earlier("p1").alias("g1"), earlier("p2").alias("g2"), F.col("t.k1").alias("k1"), F.col("t.k2").alias("k2"), F.col("t.bytes").alias("bytes"))
    # A long conversation's turns meet copies of its one row, a chunk of positions each.
    sides = rebuilt.where("n_own > 0").select("conv", "h", "hb", "s1", "s2", "o1", "o2", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("len") - 1) / chunk).cast("long"))).alias("chunk"))
    own = scanned.withColumn("chunk", F.floor(F.col("pos") / chunk).cast("long")).join(sides, ["conv", "chunk"]).where("pos >= h").drop("chunk")
    own = own.mapInArrow(_own_prefixes(prints), "conv long, depth long, f1 long, f2 long, g1 long, g2 long, k1 long, k2 long, bytes long")
    prefixes = root.unionByName(heads).unionByName(own)
    same = ("g1", "g2", "k1", "k2")
    nodes = prefixes.groupBy("depth", "f1", "f2").agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv"), F.max("bytes").alias("bytes"), *[F.min(c).alias(c) for c in same], *[F.max(c).alias(f"{c}_max") for c in same])
    mixed = F.count_if(~(F.struct(*same) == F.struct(*[F.col(f"{c}_max").alias(c) for c in same])))
    nodes, seen = tables.keep(nodes, mixed=mixed, n=F.count("*"))
    return nodes, rebuilt, seen["n"], not seen["mixed"]


def _subtree_sums(nodes: DataFrame, n_nodes: int, tables: Tables, broadcast_rows: int, chunk: int) -> DataFrame:
    """nodes with n_leaves and saved_tokens; ``nodes`` has conv, depth, parent_conv_id, leaf, saved."""
    crossing = F.col("parent_conv_id") != F.col("conv")
    paths = nodes.groupBy("conv").agg(F.max(F.when(crossing, F.col("parent_conv_id"))).alias("up"), (F.min("depth") - 1).alias("at"), F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    paths, seen = tables.keep(paths.withColumn("anc", F.col("up")), n=F.count("*"), live=F.count("up"))
    rows = seen["n"]
    while seen["live"]:
        gained = paths.where("anc is not null").groupBy(F.col("anc").alias("conv")).agg(F.sum("leaf").alias("more_leaf"), F.sum("saved").alias("more_saved"))
        stepped = join_counted(paths, gained, "conv", "left", rows, broadcast_rows)
        # Ancestors without an ancestor of their own need no partner, and most paths hang from the root's.
        further = paths.where("anc is not null").select(F.col("conv").alias("anc"), F.col("anc").alias("next"))
        stepped = join_counted(stepped, further, "anc", "left", rows, broadcast_rows)
        add = lambda c: (F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c)
        paths, seen = tables.keep(stepped.select("conv", "up", "at", add("leaf"), add("saved"), F.col("next").alias("anc")), live=F.count("anc"))
    hung = paths.where("up is not null").groupBy(F.col("up").alias("conv"), F.col("at").alias("depth")).agg(F.sum("leaf").alias("hung_leaf"), F.sum("saved").alias("hung_saved"))
    full = join_counted(nodes, hung, ["conv", "depth"], "left", n_nodes, broadcast_rows).withColumn("chunk", F.floor(F.col("depth") / chunk).cast("long"))
    below = W.partitionBy("conv", "chunk").orderBy(F.desc("depth"))
    for c in ("leaf", "saved"):
        full = full.withColumn(c, F.sum(F.col(c) + F.coalesce(f"hung_{c}", F.lit(0))).over(below))
    full, _ = tables.keep(full.drop("hung_leaf", "hung_saved"))
    totals = full.groupBy("conv", "chunk").agg(F.max("leaf").alias("later_leaf"), F.max("saved").alias("later_saved"))
    after = W.partitionBy("conv").orderBy(F.desc("chunk")).rowsBetween(W.unboundedPreceding, -1)
    later = totals.select("conv", "chunk", *[F.sum(c).over(after).alias(c) for c in ("later_leaf", "later_saved")]).where("later_leaf is not null")
    full = full.join(later, ["conv", "chunk"], "left")
    return full.withColumn("n_leaves", F.col("leaf") + F.coalesce("later_leaf", F.lit(0))).withColumn("saved_tokens", F.col("saved") + F.coalesce("later_saved", F.lit(0)))


def every_fifth(conv: Column) -> Column:
    return conv - conv % 5


def crc_head(conv: Column) -> Column:
    return F.crc32(conv.cast("string")) % 9


def prefix_trie(
    conversations: DataFrame,
    *,
    base: Callable[[Column], Column] = every_fifth,
    head: Callable[[Column], Column] = crc_head,
    max_head: int = 8,
    moduli: tuple[int, ...] = MODULI,
    chunk: int = 4096,
    ids_at_once: int = 50_000,
    broadcast_rows: int = 400_000,
) -> DataFrame:
    """A row a node, columns ``NODES``. ``base`` and ``head`` say whose first turns a conversation takes and how many; heads have at most ``max_head`` turns.

    ``moduli``: primes of the first attempts, the last one holds for all further ones.
    """
    spark = conversations.sparkSession
    attempt = 0
    while True:
        tables = Tables(spark, "prefix-trie")
        prints = Fingerprints(attempt, moduli[min(attempt, len(moduli) - 1)])
        nodes, rebuilt, n_nodes, verified = _prefix_nodes(conversations, tables, prints, attempt, base, head, max_head, chunk)
        if verified:
            break
        tables.drop()
        attempt += 1
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("g1").alias("f1"), F.col("g2").alias("f2")).agg(F.count("*").alias("n_children"))
    linked = join_counted(nodes, children, ["depth", "f1", "f2"], "left", n_nodes, broadcast_rows).withColumn("above", F.col("depth") - 1)
    parents = nodes.select(F.col("depth").alias("above"), F.col("f1").alias("g1"), F.col("f2").alias("g2"), F.col("conv").alias("parent_conv_id"))
    linked = join_counted(linked, parents, ["above", "g1", "g2"], "left", n_nodes, broadcast_rows)
    n_children = F.coalesce("n_children", F.lit(0).cast("long"))
    linked, _ = tables.keep(linked.select("depth", "f1", "f2", "conv", "parent_conv_id", "n_convs", n_children.alias("n_children"), (n_children == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")))
    summed = _subtree_sums(linked, n_nodes, tables, broadcast_rows, chunk)
    node = ["depth", "f1", "f2"]
    ends = rebuilt.mapInArrow(_ends(prints), "depth long, f1 long, f2 long, conv long").repartitionByRange(*node, "conv").sortWithinPartitions(*node, "conv")
    strings = ends.mapInArrow(_id_strings(ids_at_once), "depth long, f1 long, f2 long, first long, ids string")
    digests = strings.repartition(*node).sortWithinPartitions(*node, "first").mapInArrow(_digests, "depth long, f1 long, f2 long, ends_sha256 string")
    out = summed.join(digests, node, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))).withColumnRenamed("conv", "conv_id")
    out = checkpointed(out.select(*[c if c == "ends_sha256" else F.col(c).cast("long").alias(c) for c in NODES]))
    tables.drop()
    return out
