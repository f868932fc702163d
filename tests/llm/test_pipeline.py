"""The corpus pipeline against brute force, stage by stage, on awkward, small and empty tables."""

import collections

import corpus_pipeline
from quillmark.llm import packing
from quillmark.llm.queries import table, tokenizer_path
from tests.llm import brute
from tests.llm.test_contracts import data, odd, rows  # noqa: F401


def _key(k):
    return tuple(str(x) for x in k)


def test_stages(spark, data, tmp_path):  # noqa: F811
    docs = table(spark, data, "documents")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        given = [(r["doc_id"], r["text"]) for r in docs.collect()]
        stage(spark, docs, data).write.parquet(f"file://{tmp_path}/{k}")
        found = spark.read.parquet(f"file://{tmp_path}/{k}")
        if name == "best-fit packing":
            encode = packing.encoder(packing.ranks_path(tokenizer_path()))
            expected = [(d, sum(n for _, n in packing.cut(len(encode(t or "")) + 1, 1024))) for d, t in given]
            total = collections.Counter()
            for r in found.collect():
                total[r["doc_id"]] += r["length"]
            per_id = collections.Counter()
            for d, n in expected:
                per_id[d] += n
            assert total == per_id
            break
        assert found.columns == list(corpus_pipeline.COLUMNS)
        got = [(r["doc_id"], r["text"]) for r in found.collect()]
        if name == "language ID":
            labelled = any(r["lang"] is not None and not brute.held_out("" if r["doc_id"] is None else r["doc_id"]) for r in docs.collect())
            expected = [(d, t) for d, t in given if labelled and t and any(c.isalpha() for c in t)]
            assert all(r["lang"] for r in found.collect())
        elif name == "line dedup":
            kept = brute.op7([(-1 if d is None else d, t) for d, t in given])
            assert sorted([(d, brute.sha(t)) for d, t in got], key=_key) == sorted([(None if d == -1 else d, h) for d, _, _, h in kept], key=_key)
            expected = got
        elif name == "n-gram Jaccard join":
            component = {i: c for i, _, c in brute.op4([(i, t) for i, (_, t) in enumerate(given)])}
            groups = collections.defaultdict(list)
            for i, (d, t) in enumerate(given):
                groups[component[i]].append((d is None, d or 0, i))
            expected = [given[min(g)[2]] for g in groups.values()]
        else:
            bad = [r[-1] for r in brute.op1(given, rows(data, "benchmark", "item_id", "text"))]
            expected = [x for x, b in zip(given, bad, strict=True) if not b]
        assert sorted(got, key=_key) == sorted(expected, key=_key), name
        docs = found


def test_run(spark, data):  # noqa: F811
    out = corpus_pipeline.run(spark, data)
    assert {"doc_id", "piece", "sequence_id", "offset", "length"} <= set(out.columns)
    by = collections.defaultdict(list)
    for r in out.collect():
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 1024


def test_languages_are_a_parameter(spark, odd):  # noqa: F811
    docs = table(spark, odd, "documents")
    only = corpus_pipeline.language_id(spark, docs, odd, languages=("en",)).count()
    assert 0 < only < corpus_pipeline.language_id(spark, docs, odd).count()


def test_rows_that_share_an_id(spark):
    """Equal rows leave one; a text of its own stays though its namesake goes."""
    base = " ".join(f"word{i}" for i in range(60))
    rows = [(3, base), (7, base + " more"), (7, "quite another text with words of its own"), (5, base), (None, base), (None, "no id here but many words to say"), (9, ""), (9, "")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.ngram_jaccard(spark, docs, "").collect()), key=str)
    assert kept == sorted([rows[0], rows[2], rows[5], rows[6], rows[7]], key=str)
