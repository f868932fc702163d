"""Parts of the operators that the queries' tests don't reach."""

import gzip
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillmark.llm import chat, components, langid, line_dedup, ngram_join, packing, pii, toxicity, warc
from quillmark.llm.queries import tokenizer_path
from quillmark.llm.shared import Tables
from tests.conftest import SMALL
from tests.llm import brute


def test_shingle_sets_of_slices():
    texts = pa.array(["a b c d e f", None, "", "x", "é è ñ ü ö ä ß", " q  w e\tr t y u ", "zz"] * 3)
    whole, part = list(ngram_join.shingle_sets(texts)), list(ngram_join.shingle_sets(texts.slice(3, 9)))
    assert all(np.array_equal(a, b) for a, b in zip(whole[3:12], part, strict=True))
    assert [len(s) for s in whole] == [len(brute.shingles(t)) for t in texts.to_pylist()]


@pytest.mark.parametrize("size", [1, 3, 5, 8, 9, 17, 40, 41, 99, 100, 101, 500, 2440])
def test_similar_sets_share_a_signature(size):
    """Sets at the very threshold: whatever is changed, one signature is shared, and the tests that prune let the pair pass."""
    rng, schemes = np.random.default_rng(size), ngram_join.Schemes(80)
    for trial in range(40):
        base = rng.integers(0, 2**63, size, dtype=np.uint64)
        gone = rng.integers(0, size - (size * 80 + 99) // 100 + 1)
        other = base[gone:]
        room = (100 * len(other) - 80 * size) // 80
        other = np.concatenate([other, rng.integers(0, 2**63, max(0, rng.integers(0, room + 1)), dtype=np.uint64)])
        a, b = np.unique(base), np.unique(other)
        if not ngram_join.links(a, b, 80):
            continue
        assert set(ngram_join.signatures(a, schemes).tolist()) & set(ngram_join.signatures(b, schemes).tolist()), (size, trial)
        assert ngram_join.may_link(len(a), len(b), ngram_join.sketch(a), ngram_join.sketch(b), schemes)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100 + rng.randrange(40), 100 + rng.randrange(40)) for _ in range(30)]
    tables = Tables(spark, "test")
    for most in (400_000, 0):
        found, _ = components.components(spark.createDataFrame(edges, "a long, b long"), tables, broadcast_rows=most)
        label = {r["node"]: r["label"] for r in found.collect()}
        for a, b in edges:
            if a != b:
                assert label[a] == label[b] <= min(a, b)
        assert all(label[i] == 0 for i in range(61))
    tables.drop()


def test_large_buckets_and_shuffled_joins(spark):
    """A group of near copies with small buckets, blocks and no broadcasts still gives the components of brute force."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(90)]
    docs = []
    for i in range(120):
        w = list(words)
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(90)] = f"x{rng.randrange(30)}"
        docs.append((i, " ".join(w)))
    docs += [(200 + i, " ".join(words[:20] + [f"q{i}-{k}" for k in range(60)])) for i in range(60)]
    expected = {d: c for d, _, c in brute.op4(docs)}
    for options in ({"small": 3, "block": 16, "broadcast_rows": 0}, {}):
        found = ngram_join.join_ngrams(spark.createDataFrame(docs, "doc_id long, text string"), **options)
        assert {r["doc"]: r["component"] for r in found.collect()} == expected


def test_line_runs_hold_every_key_once(spark):
    """Holders come from the anti-joined part, counts from all batches, whatever the order of the levels."""
    rng = random.Random(7)
    runs, expected = line_dedup.LineRuns(spark, 2), {}
    for b in range(5):
        rows = {rng.randrange(40): (rng.randrange(1, 4), 100 - b) for _ in range(25)}
        for k, (n, holder) in rows.items():
            old = expected.get(k, (0, holder))
            expected[k] = (old[0] + n, old[1])
        runs.admit(spark.createDataFrame([(k, -k, n, h) for k, (n, h) in rows.items()], "h1 long, h2 long, n long, holder long"))
        stored = runs._read(runs.runs(), "h1 long, h2 long, holder long").collect()
        assert {r["h1"]: r["holder"] for r in stored} == {k: h for k, (_, h) in expected.items()} and len(stored) == len(expected)
    assert {r["h1"]: r["holder"] for r in runs.repeated(5).collect()} == {k: h for k, (n, h) in expected.items() if n >= 5}
    assert len(runs.runs()) <= 4
    runs.drop()


def test_loser_tree():
    rng = random.Random(2)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(0, 30))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)


def test_warc_revisits_need_size(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc"), (3, "u", "x" * 50), (4, "u", "x" * 50)], "page_id long, url string, html string")
    rows = {r["page_id"]: r["record_type"] for r in warc.archive_and_index(spark, pages, f"file://{tmp_path}/a", min_bytes=10).collect()}
    assert rows == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_warc_external_merge(spark, tmp_path):
    """Short runs, several merge passes and many ranges give the whole index in order; records can be fetched by it."""
    rng, path = random.Random(11), f"file://{tmp_path}/w"
    rows = [(i, f"http://h{rng.randrange(3) if i % 3 else 0}.org/{rng.randrange(4)}", f"<p>{rng.randrange(150)}</p>") for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    warc.write_archive(pages, f"{path}/archive", file_bytes=4000)
    captures = warc.read_archive(spark, f"{path}/archive")
    index = warc.build_index(captures, f"{path}/runs", run_rows=20, fan_in=3, range_rows=30)
    found = index.collect()
    keys = [(r["url_key"], r["captured_at"], r["page_id"]) for r in found]
    assert keys == sorted(keys) and sorted(k[2] for k in keys) == list(range(400)) and index.rdd.getNumPartitions() > 1
    assert len({r["file"] for r in found}) > 3
    texts = {i: h for i, _, h in rows}
    for r in rng.sample(found, 20):
        data = warc.fetch(f"{path}/archive", r["file"], r["offset"], r["length"])
        assert f"<urn:capture:{r['page_id']}>".encode() in data and (r["record_type"] == "revisit" or texts[r["page_id"]].encode() in data)
    warc.write_archive(pages, f"{path}/again", file_bytes=4000, broadcast_rows=0)
    plain = lambda df: sorted((r["page_id"], r["record_type"], r["refers_to"] or -1) for r in df.collect())
    assert plain(warc.read_archive(spark, f"{path}/again")) == plain(captures)
    with pytest.raises(ValueError, match="cut off"):
        list(warc.members(gzip.compress(b"x" * 100)[:-3]))


def test_packing_improves():
    rng = random.Random(3)
    lengths = [rng.randrange(1, 1025) for _ in range(3000)]
    bins = packing.pack_shard(lengths, 1024)
    assert sorted(i for b in bins for i in b) == list(range(3000))
    assert all(sum(lengths[i] for i in b) <= 1024 for b in bins)
    halves = sum(x > 512 for x in lengths)  # no two of them share a bin
    assert len(bins) <= 1.02 * max(sum(lengths) / 1024, halves) + 2
    worse = [[i] for i in range(3000)]
    better = packing.improve(worse, lengths, 1024)
    squares = lambda m: sum(sum(lengths[i] for i in b) ** 2 for b in m)
    assert squares(better) > squares(worse) and len(better) < len(worse)


def test_packing_leaves_no_helpful_step():
    rng = random.Random(4)
    for lengths in ([rng.randrange(1, 200) for _ in range(60)], [rng.choice([60, 61, 33, 34, 35, 51]) for _ in range(80)], [40] * 30):
        bins = packing.pack_shard(lengths, 100)
        fill = [sum(lengths[i] for i in b) for b in bins]
        open_ = [b for b in range(len(bins)) if 0 < fill[b] < 100]
        for d in open_:
            for b in open_:
                if b != d:
                    for i in bins[d]:
                        for out in [(i,), *[(i, j) for j in bins[d] if j != i]]:
                            for back in [None, *bins[b]] if len(out) == 1 else bins[b]:
                                end = fill[b] + sum(lengths[x] for x in out) - (lengths[back] if back is not None else 0)
                                assert not fill[d] < end <= 100 or end <= fill[b]


def test_packing_keeps_large_ids_beside_null(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(None, "x"), (2**60 + 1, "y"), (2**60 + 3, None)]
    found = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), path).collect()
    assert {r["doc_id"] for r in found} == {None, 2**60 + 1, 2**60 + 3}
    rng, bpe = random.Random(9), Tokenizer.from_file(path)
    pieces = ["<|endoftext|>", " ", "  ", "\n", "\t", "\x85", "\xa0", "\u2003", "a", "B1", "'s", "é", "<|", "endoftext", "|>", "漢", "."]
    encode = packing.encoder(packing.ranks_path(path))
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9)))
        assert encode(text).tolist() == bpe.encode(text, add_special_tokens=False).ids, repr(text)


def test_an_id_with_a_copy_and_a_text_of_its_own(spark):
    """One node with both texts: it joins what is like either of them."""
    a, b = (" ".join(f"{x}{i}" for i in range(80)) for x in "ab")
    rows = [(1, a), (2, a), (2, b), (3, b + " more"), (4, b), (5, "alone " + " ".join(f"c{i}" for i in range(30))), (6, a), (6, a), (7, "d " * 3 + "e f g h i j"), (8, "d " * 3 + "e f g h i j"), (9, a), (9, "d " * 3 + "e f g h i j")]
    found = ngram_join.join_ngrams(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc"], r["component"]) for r in found) == [(1, 1), (2, 1), (2, 1), (3, 1), (4, 1), (5, 5), (6, 1), (6, 1), (7, 1), (8, 1), (9, 1), (9, 1)]


def test_subsets_of_parts_are_enumerated():
    """Small bands take subsets of two of three parts; a shared stretch fills fewer of them than single parts."""
    schemes = ngram_join.Schemes(80)
    forms = {size: schemes.of(size)[0][1] for size in (1, 10, 60, 200, 400, 5000)}
    assert forms[60][1:] == forms[200][1:] == (3, 1) and forms[5000][1:] == (1, 0)
    rng = np.random.default_rng(4)
    fresh = lambda n: rng.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64)
    shared = fresh(46)
    docs = [np.unique(np.concatenate([shared, fresh(110)])) for _ in range(40)]
    seen: dict[int, int] = {}
    for d in docs:
        own = ngram_join.signatures(d, schemes)
        assert len(own) <= 2 * ngram_join.ENUMERATED
        for s in set(own.tolist()):
            seen[s] = seen.get(s, 0) + 1
    two = sum(n - 1 for n in seen.values())
    single = lambda d: {(int(p), tuple(np.sort(d[(d >> np.uint64(20)) % np.uint64(60) == p]).tolist())) for p in range(60)}
    plain: dict[tuple, int] = {}
    for d in docs:
        for s in single(d):
            plain[s] = plain.get(s, 0) + 1
    assert two < sum(n - 1 for n in plain.values())


def test_chat_parts(spark):
    rows = [
        (1, 0, "user", [("text", "see <part:image:0> ", None, None), ("image", None, "a.png", 256), ("text", " and ", None, None), ("audio", None, "b.wav", 90)]),
        (1, 1, "assistant", [("text", "fine", None, None)]),
        (1, 2, "user", [("document", None, "c.pdf", 700)]),
        (2, 0, "assistant", []),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, parts array<struct<kind:string,text:string,ref:string,tokens:bigint>>")
    found = {r["conv_id"]: r for r in chat.format_chats(df).collect()}
    one = found[1]
    assert one["formatted"] == "<turn:user>\nsee \\lpart:image:0\\g <part:image:0> and <part:audio:1></turn>\n<turn:assistant>\nfine</turn>\n<turn:user>\n<part:document:2></turn>\n"
    assert [(a["n"], a["kind"], a["ref"], a["tokens"]) for a in one["attachments"]] == [(0, "image", "a.png", 256), (1, "audio", "b.wav", 90), (2, "document", "c.pdf", 700)]
    assert one["expanded_tokens"] == 1046 and found[2]["formatted"] == "<turn:assistant>\n</turn>\n"
    s = one["loss_spans"][0]
    assert one["formatted"][s["start"] : s["end"]] == "fine"


def test_langid_backs_off():
    counts = [("wthe", "en", 50), ("wdie", "de", 50), ("3<th", "en", 60), ("3sch", "de", 80), ("1x", "en", 1), ("1x", "de", 3)]
    totals = {(k, lang): 100 for k in "w31" for lang in ("de", "en")}
    model = langid.Model(counts, totals, 5, 30)
    assert model.score("the")[0] == "en" and model.score("Schule")[0] == "de" and model.score("x")[0] == "de"
    assert model.backoff("these") == [model.gram_row[3]["<th"]] and model.score("123 !") == ("und", 0.0)


def test_langid_keeps_every_feature(spark):
    """200,000 words in a few rows: all of them are in the model."""
    rows = [(3 * i, "en", " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676 % 26)}{chr(97 + k // 17576)}" for k in range(20_000 * i, 20_000 * (i + 1)))) for i in range(15)]
    rows = [r for r in rows if not brute.held_out(r[0])]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    assert len(model.word_row) == 20_000 * len(rows) >= 150_000
    assert {len(w) for w in model.word_row} == {5}


def test_packing_does_not_depend_on_shards(spark):
    """Open sequences of all shards are packed again together: hardly more of them than in one shard, however small the shards are."""
    rng = random.Random(8)
    docs = spark.createDataFrame([(i, " ".join("ab" for _ in range(rng.choice([3, 40, 90, 200, 333])))) for i in range(700)], "doc_id long, text string")
    few = None
    for pieces in (10_000, 90, 20):
        out = packing.pack(docs, tokenizer_path(), size=400, shard_pieces=pieces)
        total = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.min("offset").alias("low"), F.max(F.col("offset") + F.col("length")).alias("high")).collect()
        assert all(r["low"] == 0 and r["high"] == r["n"] <= 400 for r in total)
        few = few or len(total)
        assert out.count() == 700 and len(total) <= few + 3


def test_langid_names_every_text_with_letters(spark):
    rows = [(i, "en", " ".join(f"{a}{b}ing" for a in "bcdfghklmn" for b in "aeiou") + " the") for i in range(60)] + [(100 + i, "zh", "\u6c34\u706b\u6728 \u91d1\u571f") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = langid.train(docs)
    assert model.score("\u6c34\u706b")[0] == "zh"
    name, score = model.score("\u0e20\u0e32\u0e29\u0e32")
    assert name == "en" and 0 < score < 1 and model.score("12 !") == ("und", 0.0)
    unseen = spark.createDataFrame([(900, "\u0e20\u0e32", None, "web", 2), (901, "12", None, "web", 2)], "doc_id long, text string, lang string, source string, n_chars long")
    given = docs.selectExpr("doc_id", "text", "lang", "'web' source", "cast(length(text) as long) n_chars").unionByName(unseen)
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, given, "").collect()}
    assert 900 in kept and 901 not in kept


def test_nearest_without_oneself_is_exact():
    """Leave-one-out searches in small indexes, where the example itself is among the first that are scored."""
    rng = np.random.default_rng(11)
    for n in (2, 3, 5, 9, 14, 25, 60):
        for _ in range(6):
            vectors = []
            for _ in range(n):
                terms = np.sort(rng.choice(40, rng.integers(1, 12), replace=False))
                w = rng.random(len(terms))
                vectors.append((terms, w / np.linalg.norm(w)))
            dense = np.zeros((n, 40))
            for i, (t, w) in enumerate(vectors):
                dense[i, t] = w
            index = toxicity.BlockMaxIndex(list(range(n)), [i % 2 for i in range(n)], vectors, 40, block=4, frequent=0.2)
            for i, (t, w) in enumerate(vectors):
                cosines = np.round(dense @ dense[i], 12)
                expected = sorted(((-c, j) for j, c in enumerate(cosines) if j != i and c > 0))[:5]
                got = [(-c, int(index.ids[e])) for c, e in index.nearest(t, w, 5, leave_out=i)]
                assert [j for _, j in got] == [j for _, j in expected] and np.allclose([c for c, _ in got], [c for c, _ in expected])


def test_toxicity_separates(spark):
    rng = random.Random(4)
    plain = [f"word{i}" for i in range(200)]
    docs, labels = [], []
    for i in range(600):
        w = [rng.choice(plain) for _ in range(60)]
        if bad := i % 6 == 0:
            w[5:5] = [rng.choice(["vilely", "nastyish", "rotten"]) for _ in range(3)]
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    scored = toxicity.score(d, toxicity.train(d, lab)).collect()
    held = [(r["predicted"], labels[r["doc_id"]][1]) for r in scored if brute.held_out(r["doc_id"])]
    assert np.mean([a == b for a, b in held]) > 0.97
    toxic = next(r for r in scored if r["predicted"])
    assert toxic["evidence"][0]["toxic"] == 1 and toxic["evidence"][0]["cosine"] >= toxic["evidence"][-1]["cosine"]


def test_toxicity_cosine_is_over_all_terms(spark):
    plain = [" ".join(f"{'abcdefghij'[i % 10]}{'klmnopqrst'[j]}word" for j in range(10)) for i in range(60)]
    docs = [(i, t + (" vilely" if i % 3 == 0 else "")) for i, t in enumerate(plain)] + [(100, plain[1] + " vilely"), (101, plain[1])]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, toxic int")
    found = {r["doc_id"]: r["evidence"] for r in toxicity.score(d, toxicity.train(d, lab, k=100)).collect()}
    own = [toxicity.with_stems(toxicity.words(t), 5) for _, t in docs]
    idf = {t: np.log((1 + len(docs)) / (1 + sum(t in o for o in own))) + 1 for o in own for t in o}
    learned = [i for i in range(60) if not brute.held_out(i)]
    size = [sum(i % 3 != 0 for i in learned), sum(i % 3 == 0 for i in learned)]
    delta = {}
    for t in {t for i in learned for t in own[i]}:
        rate = [(sum(t in own[i] for i in learned if (i % 3 == 0) == bad) + 50 * size[bad] / sum(size)) / (size[bad] + 50 * size[bad] / sum(size)) for bad in (0, 1)]
        delta[t] = abs(np.log(rate[1] / rate[0]))
    unit = {i: {t: (1 + np.log(n)) * idf[t] * delta[t] for t, n in o.items() if t in delta} for (i, _), o in zip(docs, own)}
    cosine = lambda a, b: sum(w * b.get(t, 0) for t, w in a.items()) / np.sqrt(sum(w * w for w in a.values()) * sum(w * w for w in b.values()))
    for q in (100, 101):
        expected = {e: cosine(unit[q], unit[e]) for e in learned if cosine(unit[q], unit[e]) > 0}
        assert {e["doc_id"] for e in found[q]} == set(expected) and expected
        assert all(abs(e["cosine"] - expected[e["doc_id"]]) < 1e-9 for e in found[q])
    assert {e["toxic"] for e in found[101]} == {0, 1}


def test_toxicity_of_the_small_tables(spark):
    """Held-out labels of the driver's documents: the votes decide, with evidence of both kinds."""
    data = SMALL.replace("0.001", "0.01")
    if not os.path.isdir(data):
        pytest.skip("the tables aren't here")
    docs, labels = (spark.read.parquet(f"{data}/{n}.parquet") for n in ("documents", "labels"))
    rows = toxicity.score(docs.select("doc_id", "text"), toxicity.train(docs, labels)).join(labels, "doc_id").collect()
    held = [(r["predicted"], r["toxic"], r["score"]) for r in rows if brute.held_out(r["doc_id"]) and r["toxic"] is not None]
    ranked = sorted(held, key=lambda x: -x[2])[: sum(t for _, t, _ in held)]
    assert np.mean([t for _, t, _ in ranked]) >= 0.75  # as many as there are toxic ones, by score
    assert np.mean([t for p, t, _ in held if p]) >= 0.9 and sum(p and t for p, t, _ in held) >= 0.7 * sum(t for _, t, _ in held)
    assert len({round(r["score"], 6) for r in rows}) > 20 and {e["toxic"] for r in rows for e in r["evidence"]} == {0, 1}


def test_nearest_is_exact():
    rng = np.random.default_rng(6)
    vectors = []
    for _ in range(700):
        t = np.sort(rng.choice(40, rng.integers(1, 6), replace=False))
        w = rng.random(len(t))
        vectors.append((t, w / np.sqrt((w**2).sum())))
    for frequent in (1.0, 0.12, 0.0):
        _check_nearest(toxicity.BlockMaxIndex(list(range(700)), [i % 2 for i in range(700)], vectors, 40, block=16, frequent=frequent), vectors)


def _check_nearest(index, vectors):
    dense = np.zeros((700, 40))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for q in range(0, 700, 7):
        scores = np.round(dense @ dense[q], 12)
        order = [i for i in np.lexsort((np.arange(700), -scores))[:15] if scores[i] > 0]
        assert [int(index.ids[e]) for _, e in index.nearest(*vectors[q], 15)] == order


def test_pii_adds_credentials(spark):
    """Credentials with a cue or a known prefix become spans in their full length, runs of words and numbers don't."""
    rng, letters = random.Random(8), "abcdefghijkmnpqrstuvwxyzABCDEFGHIJKLMNPQRSTUVWXYZ0123456789"
    key = lambda n: "".join(rng.choice(letters) for _ in range(n))
    rows = [(i, f"say token = \"{'%040x' % (i * 7919 + 2**150)}\" here, mail me{i}@x.org or +1 (132) 555-0{i:03d}") for i in range(40)]
    rows += [(100 + i, f"our release-candidate-{2000 + i}-final-build and see part-{i}/of/the-{i}-year-plan") for i in range(40)]
    rows += [(200 + i, f"password: {key(300)} then") for i in range(10)] + [(300 + i, f"left AKIA{key(16).upper()} there") for i in range(10)]
    found = {r["doc_id"]: r["spans"] for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(40):
        assert [s["kind"] for s in found[i]] == ["secret", "email", "phone"] and not found[100 + i]
    assert all([(s["kind"], s["end"] - s["start"]) for s in found[200 + i]] == [("secret", 300)] for i in range(10))
    assert sum([s["kind"] for s in found[300 + i]] == ["secret"] for i in range(10)) >= 8
    assert all(0 <= s["probability"] <= 1 for spans in found.values() for s in spans)


def test_pii_classifier_follows_the_votes(spark):
    """Posteriors of expectation-maximisation in numpy, and classifier scores that agree with confident posteriors."""
    data = SMALL.replace("0.001", "0.01")
    if not os.path.isdir(data):
        pytest.skip("the tables aren't here")
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    found = pii.candidates(docs).cache()
    rows = pii.estimate(found).collect()
    counted = {tuple(r["pattern"]): r["n"] for r in found.selectExpr("explode(found) as s").select(pii.votes(F.col("s")).alias("pattern")).groupBy("pattern").agg(F.count("*").alias("n")).collect()}
    votes, n = np.array(list(counted)), np.array(list(counted.values()), float)
    q = np.zeros(len(n))
    for base in (0, 1):
        mine = votes[:, 0] == base
        v, m = votes[mine], n[mine]
        prior, rates = 0.5, [np.tile(r, (5, 1)) for r in (pii._TRUE, pii._FALSE)]
        sides = lambda: [np.stack([r[i][v[:, i] + 1] for i in range(5)]).prod(0) for r in rates]  # noqa: E731, B023
        for _ in range(20):
            a, b = sides()
            t = m * prior * a / (prior * a + (1 - prior) * b)
            prior = (t.sum() + 1) / (m.sum() + 2)
            rates = [np.array([[(w[v[:, i] == k].sum() + 4 * r[k + 1]) / (w.sum() + 4) for k in (-1, 0, 1)] for i in range(5)]) for w, r in ((t, pii._TRUE), (m - t, pii._FALSE))]
        a, b = sides()
        q[mine] = prior * a / (prior * a + (1 - prior) * b)
    expected = dict(zip(map(tuple, votes.tolist()), q, strict=True))
    assert all(abs(r["posterior"] - expected[tuple(r["pattern"])]) < 1e-9 for r in rows) and len(rows) == len(expected)
    spans = pii.find_pii(docs).selectExpr("explode(spans) as s").select("s.*").collect()
    assert all(s["probability"] > 0.5 for s in spans) and len(spans) == sum(counted[v] for v, p in expected.items() if p > 0.9)
    assert sum(s["kind"] == "secret" for s in spans) == 13


def test_pii_positions_of_many_matches(spark):
    text = " é ".join(f"a{i}@b{i % 7}.org" for i in range(700))
    found = pii.find_pii(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]["spans"]
    assert [(s["start"], s["end"]) for s in found] == [(a, b) for a, _, _, b in brute.spans(text)] and len(found) == 700
