"""The registered queries against brute force, on the smallest data set and on awkward rows."""

import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from quillmark.llm import queries as q
from quillmark.llm import warc
from tests.conftest import SMALL
from tests.llm import brute

LONG = "Lorem ipsum dolor sit amet consectetur adipiscing elit sed"


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    """Tables with nulls, empty and very long texts, ties, repeats, and extra columns whose names clash with results."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "ñandú", "ça", "Ünder", "a.b", "x-y"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base = text(120)
    passage = text(40)
    texts = [None, "", " ", "\n", "one", "One two", "a b c d e", "a b c d e", base, base, base + " tail", base.replace("w1 ", "W1 "), text(4), text(5), text(6), text(20_000), passage + "\n" + text(30), text(3) + " " + passage]
    for i in range(8):
        texts.append(f"{text(5)}\n   {LONG.upper() if i % 2 else LONG}\t\n{text(3)}\n{LONG}")
    words = base.split()
    for i in range(25):  # near copies along a chain
        w = list(words)
        w[(3 * i) % len(w)] = f"edit{i // 3}"
        texts.append(" ".join(w))
    texts += ["mail a.b+c@d-e.f.g, x@y, 1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255", "card 4111 1111 1111 1111 and 4111-1111-1111-1112, 5500005555555559 0445617099674829", "call +1 (132) 555-1352 or +49 30 1234567890123456 or +1 2", "a@b.c_d@e.f +12345678901 9" * 3, "é" * 50 + " me@é.com you@x.yz " + "1" * 40, "9" * 5000, "a" * 5000 + "@x.com", "1." * 2000, "http 10.0.0.1/24", "<|endoftext|> x  y\n\n\n z    q"]
    ids = [None if t == " " else 7 * k for k, t in enumerate(texts)]
    ids[9] = ids[8]  # a repeated row
    n = len(texts)
    folder = tmp_path_factory.mktemp("odd")
    write = lambda name, table: pq.write_table(pa.table(table), f"{folder}/{name}.parquet")
    langs = [None if i % 7 == 0 else ["en", "fr"][i % 2] for i in range(n)]
    docs = {"doc_id": pa.array(ids, pa.int64()), "text": texts, "lang": langs, "source": ["s"] * n, "n_chars": pa.array([len(t or "") for t in texts], pa.int64())}
    clash = ("n_words", "n_hit", "items", "contaminated", "n_lines", "n_dropped", "score", "predicted", "evidence", "lang_pred", "found", "spans", "sig", "label", "shard")
    write("documents", docs | {c: ["x"] * n for c in clash})
    windows = [" ".join(words[:20]), passage, "one", "", None, "a b c d e", "w1", "zz " * 30, " ".join(words[5:18])]
    write("benchmark", {"item_id": pa.array([*range(len(windows) - 1), None], pa.int64()), "text": windows})
    vectors = [[float(np.float32(rng.uniform(-1, 1))) for _ in range(6)] for _ in range(140)]
    vectors[3], vectors[4], vectors[5], vectors[6] = None, [None] * 6, [float("nan")] + [0.0] * 5, [float("inf")] * 6
    vectors[10] = vectors[11] = vectors[12]
    vectors[20] = vectors[20][:3]
    vectors[30], vectors[31], vectors[32] = [1e6, -3e5, 7.5, 0.25, 1e5, 2.0], [9e5, -2e5, 1.5, 3.25, 1e5, 2.0], [1e20, 0.0, 0.0, 0.0, 0.0, 0.0]
    write("embeddings", {"vec_id": pa.array(range(140), pa.int64()), "embedding": pa.array(vectors, pa.list_(pa.float32())), "label": [0] * 140})
    htmls = [None, "", "x", "x", "x", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n", "é\r\n\r\n" * 5, "\r\n", "y" * 70_000]
    write("pages", {"page_id": pa.array(range(len(htmls)), pa.int64()), "url": [None, "http://A.com/b?c", "https://www.a.com:80/", "a b\nc%0A", "http://[bad", "x", "", "//h/p", "http://b.org"], "html": htmls})
    write("labels", {"doc_id": pa.array([i for i in ids if i is not None], pa.int64()), "quality": [1] * (n - 1), "toxic": pa.array([None if i % 5 == 0 else i % 2 for i in range(n - 1)], pa.int64())})
    said = ["hi", None, "", "\\b \\l <turn:user>\n </turn>\n \\\\l", "### Assistant: x", "é<", "\n"]
    chats = [(c, k, r, said[(c + k) % len(said)]) for c in range(6) for k, r in enumerate(["system", "user", "assistant", None, "assistant"])] + [(None, 0, "user", "x"), (3, 1, "user", "again")]
    write("conversations", {"conv_id": pa.array([c[0] for c in chats], pa.int64()), "turn": pa.array([c[1] for c in chats], pa.int64()), "role": [c[2] for c in chats], "text": [c[3] for c in chats]})
    return str(folder)


@pytest.fixture(scope="module", params=["odd", "small", "empty"])
def data(request, odd, tmp_path_factory):
    if request.param == "small":
        if not os.path.isdir(SMALL):
            pytest.skip("the small tables aren't here")
        return SMALL
    if request.param == "odd":
        return odd
    folder = tmp_path_factory.mktemp("empty")
    for name in os.listdir(odd):
        pq.write_table(pq.read_table(f"{odd}/{name}").slice(0, 0), f"{folder}/{name}")
    return str(folder)


def rows(data, table, *columns):
    t = pq.read_table(f"{data}/{table}.parquet", columns=list(columns))
    return list(zip(*(t[c].to_pylist() for c in columns), strict=True))


def got(spark, query, data, *columns):
    return sorted((tuple(r) for r in q.QUERIES[query](spark, data).select(*columns).collect()), key=str)


def same(found, expected):
    assert found == sorted(expected, key=str)


def test_op1(spark, data):
    same(got(spark, "op1_decontaminate", data, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"), _op1(data))


def _op1(data):
    items = rows(data, "benchmark", "item_id", "text")
    docs = rows(data, "documents", "doc_id", "text")
    both = brute.op1(docs, [(-1 if i is None else i, t) for i, t in items])
    named = {(d, k): r for k, (d, *r) in enumerate(brute.op1(docs, [(i, t) for i, t in items if i is not None]))}
    return [(d, words, hit, named[d, k][2], named[d, k][3], bad) for k, (d, words, hit, _, _, bad) in enumerate(both)]


def test_op2(spark, data):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = rows(data, "documents", "doc_id", "text")
    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = []
    for (d, _), e in zip(docs, bpe.encode_batch([t or "" for _, t in docs], add_special_tokens=False), strict=True):
        ids = np.array([*e.ids, 2], "<u4")
        first = len(ids) % 1024 or 1024
        starts = [0, *range(first, len(ids), 1024)]
        expected += [(d, k, s, len(ids[s : (first if k == 0 else s + 1024)]), zlib.crc32(ids[s : (first if k == 0 else s + 1024)].tobytes())) for k, s in enumerate(starts)]
    same(got(spark, "op2_pack", data, "doc_id", "piece", "start", "length", "ids_crc32"), expected)
    by: dict = {}
    for s, o, n in got(spark, "op2_pack", data, "sequence_id", "offset", "length"):
        by.setdefault(s, []).append((o, n))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 1024
    total = sum(n for parts in by.values() for _, n in parts)
    assert len(by) <= 1.05 * total / 1024 + 2


def test_op3(spark, data):
    same(got(spark, "op3_warc_index", data, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"), brute.op3(rows(data, "pages", "page_id", "url", "html")))


def test_op3_order(spark, data, tmp_path):
    index = warc.archive_and_index(spark, q.table(spark, data, "pages"), f"file://{tmp_path}/warc")
    found = [tuple(r) for r in index.select("url_key", "captured_at", "page_id").collect()]
    assert found == sorted(found) and len(found) == len(rows(data, "pages", "page_id"))


def test_op4(spark, data):
    docs = rows(data, "documents", "doc_id", "text")
    named = brute.op4([(d, t) for d, t in docs if d is not None])
    nulls = [(None, len(brute.shingles(t)), None) for d, t in docs if d is None]
    same(got(spark, "op4_ngram_join", data, "doc_id", "n_shingles", "component_id"), named + nulls)


def test_op5(spark, data):
    same(got(spark, "op5_topk", data, "query_id", "rank", "vec_id", "score"), brute.op5(rows(data, "embeddings", "vec_id", "embedding")))


def test_op6(spark, data):
    found = q.QUERIES["op6_toxicity"](spark, data).collect()
    assert sorted((r["doc_id"] for r in found), key=str) == sorted((d for d, in rows(data, "documents", "doc_id")), key=str)
    for r in found:
        assert r["held_out"] == (brute.held_out("" if r["doc_id"] is None else r["doc_id"]))
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)


def test_op7(spark, data):
    docs = rows(data, "documents", "doc_id", "text")
    expected = brute.op7([(-1 if d is None else d, t) for d, t in docs])
    same(got(spark, "op7_line_dedup", data, "doc_id", "n_lines", "n_dropped", "kept_sha256"), [(None if d == -1 else d, *r) for d, *r in expected])


def test_op8(spark, data):
    found = got(spark, "op8_pii", data, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    same(found, brute.op8(rows(data, "documents", "doc_id", "text")))


def test_op8_keeps_base(spark, data):
    texts = dict(rows(data, "documents", "doc_id", "text"))
    for d, s in got(spark, "op8_pii", data, "doc_id", "spans"):
        base = [f"{k}:{a}:{b}" for a, _, k, b in brute.spans(texts[d])]
        assert set(base) <= set(s.split(","))
        starts = [int(x.split(":")[1]) for x in s.split(",") if x]
        assert starts == sorted(starts)


def test_op9(spark, data):
    extra = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
    given = [(c, t, r, x) for c, t, r, x in rows(data, "conversations", "conv_id", "turn", "role", "text")]
    same(got(spark, "op9_chat", data, "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"), brute.op9(given + extra))


def test_op10(spark, data):
    found = {r["doc_id"]: r for r in q.QUERIES["op10_langid"](spark, data).collect()}
    docs = rows(data, "documents", "doc_id", "text", "lang")
    assert set(found) == {d for d, *_ in docs}
    for d, t, _ in docs:
        if t is None or not any(c.isalpha() for c in t):
            assert found[d]["lang_pred"] == "und"
        assert 0 <= found[d]["score"] <= 1
    if data == SMALL:
        held = [(found[d]["lang_pred"], lang) for d, _, lang in docs if brute.held_out(d) and lang]
        assert np.mean([a == b for a, b in held]) > 0.95
