"""The language model: base scores against brute force, the model against a plain token-by-token computation, gradients, probabilities that add up."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from quillmark.llm import lm
from quillmark.llm.queries import SUBWORDS, op12_lm
from tests.conftest import SMALL

PATH = public_tokenizers.path(SUBWORDS)
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER)), ""]


def check_base(rows, got):
    counts = Counter(t for doc_id, text in rows if not held(doc_id) for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    expected = sorted((str(d), held(d), len(tokens(x)), sum(counts[t] > 0 for t in tokens(x)), total, round(sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in tokens(x)), 6)) for d, x in rows)
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == expected
    assert all(-math.inf < r["score"] < 0 for r in got)


def test_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = op12_lm(spark, SMALL).collect()
    check_base(rows, got)
    held_rows = [r for r in got if r["held_out"]]
    per_token = sum(r["score"] for r in held_rows) / sum(r["n_tokens"] for r in held_rows)
    counts = Counter(i for d, x in rows if not held(d) for w in lm.words(x) + [lm.END] for i in lm.subwords(PATH).one(w))
    total = sum(counts.values())
    flat = sum(math.log10((counts[i] + 0.5) / (total + 30_000)) for d, x in rows if held(d) for w in lm.words(x) + [lm.END] for i in lm.subwords(PATH).one(w)) / sum(r["n_tokens"] for r in held_rows)
    assert per_token > flat + 0.5  # training beats the frequencies of subwords


def test_awkward_rows(spark):
    rng = random.Random(4)
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "no id"), (4, "x" * 3000), (5, " ".join(rng.choice("ab cd EF gh".split()) for _ in range(9000)))]
    rows += [(6, "É é \u00a0nbsp\u2003em \x1cfile \x0bvt"), (7, "Same text here")] + [(7, "Same text here")] * 3 + [(11, "rare1 rare2 rare1"), (12, "unseen words only zzzqq"), (13, "\u4f60\u597d \U0001f600")]
    df = spark.createDataFrame([(d, x, "n", 0.5) for d, x in rows], "doc_id int, text string, word string, score double")
    for most in (0, 4, 100_000):  # no hot words, some, all
        check_base(rows, lm.score_texts(df, PATH, hot_words=most, rounds=1).collect())
    empty = lm.score_texts(spark.createDataFrame([], "doc_id int, text string"), PATH)
    assert empty.columns == list(lm.SCORED) and empty.count() == 0
    # Only held-out rows: base counts are 0, every id is as likely.
    alone = [d for d in range(40) if held(d)][:2]
    got = lm.score_texts(spark.createDataFrame([(d, "some words") for d in alone], "doc_id int, text string"), PATH).collect()
    check_base([(d, "some words") for d in alone], got)
    encode, end = lm.subwords(PATH).one, lm.subwords(PATH).end
    n = len(encode(b"some") + encode(b"words")) + 1
    assert got[0]["score"] == pytest.approx(-n * math.log10(end + 1), rel=1e-6)


def random_net(n=150, seed=3):
    rng = np.random.default_rng(seed)
    net, compact, unseen = lm.new_net({i: int(rng.integers(1, 100)) for i in range(0, 3 * n, 3)}, 3 * n)
    for name in ("U", "near"):
        net.p[name] = rng.standard_normal(net.p[name].shape).astype(np.float32)
    net.p["c1"] = rng.standard_normal(net.p["c1"].shape).astype(np.float32) * 0.1
    return net, compact, unseen


def log_probability(net, inputs, goal):
    """The definition for one token: inputs are those of its window up to its own."""
    p = {k: v.astype(float) for k, v in net.p.items()}
    x = p["E"][inputs]
    logits = (x[-1] @ p["q"]) @ (x @ p["k"]).T * lm._WIDTH**-0.5 + p["near"][np.arange(len(inputs))[::-1], 0]
    a = np.exp(logits - logits.max())
    z = x[-1] + (a / a.sum()) @ (x @ p["v"])
    h = z + np.maximum(z @ p["w1"] + p["c1"][0], 0) @ p["w2"]
    tree = net.tree
    path = [(k, s) for k, s in zip(tree.nodes[tree.starts[goal] : tree.starts[goal + 1]], tree.signs[tree.starts[goal] : tree.starts[goal + 1]], strict=True)]
    path += [(tree.top + k, s) for k, s in zip(tree.columns[goal], tree.sides[goal], strict=True) if s]
    return -sum(math.log1p(math.exp(s * (h @ p["U"][k] + p["b"][k, 0]))) for k, s in path)


def test_windows_score_each_token_once_like_the_definition():
    net, compact, unseen = random_net()
    scorer = lm.Scorer(net, compact, unseen, PATH, block=2)
    rng = np.random.default_rng(5)
    sizes = [1, 31, 32, 33, 70, 200, 2]
    targets = rng.integers(0, len(net.p["E"]), sum(sizes)).astype(np.int32)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    inputs = np.append(0, targets[:-1]).astype(np.int32)
    starts = np.cumsum(sizes) - sizes
    inputs[starts] = 1
    for bounded in (True, False):
        scorer.bounded = bounded
        got = scorer.token_scores(inputs, targets, doc)
        for start, size in zip(starts, sizes, strict=True):
            for i in range(size):
                low = max(0, i // lm.STRIDE * lm.STRIDE - lm.CONTEXT)
                expected = log_probability(net, inputs[start + low : start + i + 1], targets[start + i]) / math.log(10) - (math.log10(unseen) if targets[start + i] == scorer.rare else 0)
                assert got[start + i] == pytest.approx(expected, abs=2e-4)


def test_probabilities_add_up_to_one():
    net, compact, unseen = random_net()
    scorer = lm.Scorer(net, compact, unseen, PATH)
    n = len(net.p["E"])
    total = 0.0
    for goal in range(n):
        inputs, targets = np.array([1, 5, 9], np.int32), np.array([5, 9, goal], np.int32)
        total += 10 ** scorer.token_scores(inputs, targets, np.zeros(3, int))[2] * (unseen if goal == n - 1 else 1)
    assert total == pytest.approx(1, abs=1e-4)


def test_gradients():
    net, compact, _ = random_net(100)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    net.p["c1"][:] = np.where(np.arange(lm._HIDDEN) % 3, 9, -9)  # away from the kinks of the hidden layer
    net.p["w2"] *= 0.05
    rng = np.random.default_rng(6)
    ids, targets = rng.integers(0, 100, 90), rng.integers(0, 100, 90)
    doc = np.repeat([0, 1], [50, 40])
    windows = net.windows(ids, doc)
    _, gradients = net.step(ids, targets, *windows)
    for name, (rows, g) in gradients.items():
        full = np.zeros_like(net.p[name])
        full[slice(None) if rows is None else rows] = g
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in full.shape)
            plain = net.p[name][at]
            losses = []
            for move in (1e-3, -1e-3):
                net.p[name][at] = plain + move
                losses.append(net.step(ids, targets, *windows)[0])
            net.p[name][at] = plain
            assert full[at] == pytest.approx((losses[0] - losses[1]) / 2e-3, abs=2e-4), name


def test_segments_grow_with_the_corpus():
    import pyarrow as pa

    texts = ["one two", "", "w " * 5000]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(texts)], ["doc_id", "text"])
    lists = next(lm._segments(PATH, 64, 1024)(iter([batch]))).column(0).to_pylist()
    assert len(lists) == 2 + 5 and all(1 <= len(x) <= 65 for x in lists)
    assert lists[0][0] == lists[0][-1] == lists[1][0] == lm.subwords(PATH).end


def test_many_words_are_encoded_like_one():
    rng = random.Random(9)
    bpe = lm.subwords(PATH)
    letters = "abcXYZ\u00e9\u00df\u4f60\U0001f600'\u2019.,;:!?()[]{}<>|-_=+*/\\\\0123456789\u0301\u200b\x00\x7f\u0130"
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))).encode() for _ in range(4000)] + [b"'s", b"'re'll", b"don't", b"x" * 5000, b"<|endoftext|>"]
    ids, sizes = bpe.all(made)
    assert ids.tolist() == [i for w in made for i in bpe.one(w)] and sizes.tolist() == [len(bpe.one(w)) for w in made]
    odd = [*made[:50], "a\u00a0".encode(), "\u2003b".encode(), b"\x1c", lm.END, "\u0085".encode(), *made[50:90]]
    ids, sizes = bpe.all(odd)
    assert ids.tolist() == [i for w in odd for i in bpe.one(w)] and sizes.tolist() == [len(bpe.one(w)) for w in odd]
    assert [len(x) for x in bpe.all([])] == [0, 0]


def test_training_sees_every_token_once(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(d, " ".join(rng.choice("ab cd EF gh ijk \u4f60".split()) for _ in range(rng.choice([0, 1, 40, 3000])))) for d in range(60)] + [(1000, None), (1001, "")]
    rows += [(None, "null id"), (1003, "a\u00a0b c")]
    given = []

    def local(texts, read, net, compact, *, rounds, passes, rate, batch):
        """One round in this process, counting the targets."""
        seen = Counter()
        fit = lm.Net.fit
        monkeypatch.setattr(lm.Net, "fit", lambda self, ids, targets, *rest: (seen.update(targets.tolist()), fit(self, ids, targets, *rest))[1])
        list(lm._trained(read, net, compact, 0, rate, batch, passes)(iter(texts.toArrow().to_batches())))
        given.append((seen, compact))

    monkeypatch.setattr(lm, "train", local)
    lm.score_texts(spark.createDataFrame(rows, "doc_id int, text string"), PATH)
    (seen, compact), bpe = given[0], lm.subwords(PATH)
    assert seen == Counter(int(compact[i]) for d, x in rows if not held(d) for w in [*lm.words(x), lm.END] for i in bpe.one(w))


def test_rounds_share_all_texts(spark, monkeypatch):
    import pyarrow as pa

    rows = [(d, f"text {d}") for d in range(50)] + [(None, None)] * 3

    def counted(read, net, compact, round_, *rest):
        def run(batches):
            n = sum(b.num_rows for b in batches)
            yield pa.RecordBatch.from_arrays([pa.array([3], pa.int32()), pa.array([0], pa.int32()), *[pa.array([float(n)]) for _ in range(lm._WIDTH)]], ["tab", "row", *[f"x{i}" for i in range(lm._WIDTH)]])

        return run

    monkeypatch.setattr(lm, "_trained", counted)
    net, compact, _ = random_net(20)
    before = net.p["v"][0].copy()
    lm.train(spark.createDataFrame(rows, "doc_id int, text string").coalesce(1), None, net, compact, rounds=3, passes=1, rate=0.1, batch=8)
    assert net.p["v"][0] - before == pytest.approx(np.full(lm._WIDTH, len(rows)), abs=1e-3)


def test_frequent_decisions_are_worked_out_by_groups_of_leaves():
    rng = np.random.default_rng(8)
    for n in (1, 2, 3, 40, 3000):
        tree = lm.Tree((1e6 / np.arange(1, n + 1)).astype(np.int64) + 1)
        width = tree.members.shape[1]
        assert width <= 64  # one matrix for all leaves had a column for every frequent node
        goals = rng.integers(0, n, 500)
        goals = goals[tree.order(goals)]
        assert (np.diff(tree.group[goals].astype(int)) >= 0).all()
        for leaf in range(n):
            live = tree.sides[leaf] != 0
            assert (tree.members[tree.group[leaf], tree.places[leaf][live]] == tree.columns[leaf][live]).all()
            assert (tree.places[leaf][~live] == width - 1).all()
        assert (tree.members[:, -1] == len(tree.bias) - tree.top).all()
        u, b = rng.standard_normal((len(tree.bias), 4)).astype(np.float32), tree.bias
        h = rng.standard_normal((500, 4)).astype(np.float32)
        visits = lm.Visits(tree, goals)
        doubts = visits.doubts(h, u, b)
        losses = visits.losses(doubts)
        dh, (rows, du), (rows_b, db) = visits.gradients(doubts, 1.0, u)
        assert len(set(rows.tolist())) == len(rows) and (rows == rows_b).all()
        expected, full_h, full_u, full_b = np.zeros(500), np.zeros((500, 4)), np.zeros(u.shape), np.zeros(len(b))
        for i, leaf in enumerate(goals):
            path = list(zip(tree.nodes[tree.starts[leaf] : tree.starts[leaf + 1]], tree.signs[tree.starts[leaf] : tree.starts[leaf + 1]], strict=True))
            path += [(tree.top + k, s) for k, s in zip(tree.columns[leaf], tree.sides[leaf], strict=True) if s]
            for k, s in path:
                doubt = s * (h[i].astype(float) @ u[k] + b[k])
                expected[i] += np.logaddexp(0, doubt)
                slope = s / (1 + np.exp(-doubt))
                full_h[i] += slope * u[k]
                full_u[k] += slope * h[i]
                full_b[k] += slope
        got_u, got_b = np.zeros(u.shape), np.zeros(len(b))
        got_u[rows], got_b[rows_b] = du, db[:, 0]
        assert losses == pytest.approx(expected, abs=1e-4)
        assert dh == pytest.approx(full_h, abs=1e-3) and got_u == pytest.approx(full_u, abs=1e-2) and got_b == pytest.approx(full_b, abs=1e-2)


def test_words_get_places_as_they_come():
    known = lm._Words(PATH, np.arange(lm.subwords(PATH).end + 1, dtype=np.int32), {b"ab": 7})
    for found in ([b"ab", b"cd", b"ab", lm.END], [b"cd", b"ef", lm.END, b"ef"]):
        take, counts, ids, sizes = known.look_up(found)
        assert [known.names[i] for i in take] == found and counts.tolist() == [7 if w == b"ab" else -1 for w in found]
        assert ids.tolist() == [i for w in found for i in lm.subwords(PATH).one(w)] and sizes.tolist() == [len(lm.subwords(PATH).one(w)) for w in found]
    assert len(known) == len(known.names) == 4
