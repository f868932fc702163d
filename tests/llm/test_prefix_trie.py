"""The prefix trie against tries of whole texts, also when fingerprints collide and conversations are long or spread over partitions."""

import hashlib
import random
import zlib
from math import fmod

import duckdb
import pytest

from quillmark.llm import prefix_trie as pt
from quillmark.llm.oracles import SQL
from quillmark.llm.queries import op11_prefix_trie
from tests.conftest import SMALL

SCHEMA = "conv_id long, turn long, role string, text string, depth string, conv string"


def brute(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", hashlib.sha256((text or "").encode()).digest(), text or ""))
    turns = {c: [(t[1], t[3]) for t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = turns.get(c - int(fmod(c, 5)), [])[:h] + own[h:]
    members, children = {}, {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[b] for b in below) if below else 1
        saved[node] = sum(saved[b] for b in below) + ((len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0)
    out = []
    for node, ms in members.items():
        ends = ",".join(str(c) for c in sorted(ms) if len(rebuilt[c]) == len(node))
        out.append((min(ms), len(node), min(members[node[:-1]]) if node else None, len(ms), len(children.get(node, [])), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r[c] for c in pt.NODES) for r in df.collect()), key=str)


def table(spark, rows, parts=5):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(parts)


def awkward():
    rng = random.Random(5)
    said = ["hi", "", None, "é", "a,b", "hello there"]
    rows = [(c, t, rng.choice(["user", "assistant", None, ""]), rng.choice(said)) for c in range(-12, 40) for t in range(rng.randrange(0, 14))]
    rows += [(c, t, "user", "same") for c in (50, 51, 52, 60, 61, 70) for t in range(12)]  # copies
    rows += [(7, None, "user", "no turn"), (7, None, "user", "no turn"), (7, 3, "user", "tie"), (7, 3, "user", "tie b"), (None, 1, "user", "no id")]
    rows += [(100, t, "user", f"t{t % 3}") for t in range(900)] + [(103, t, "user", f"t{t % 3}") for t in range(700)]  # long ones
    return rows


def test_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(op11_prefix_trie(spark, SMALL)) == brute(rows)


def test_awkward_rows(spark):
    rows = awkward()
    df = table(spark, rows)
    expected = brute(rows)
    assert got(pt.prefix_trie(df, chunk=64, ids_at_once=2)) == expected
    assert got(pt.prefix_trie(df, broadcast_rows=0)) == expected
    assert got(op11(spark, [])) == []
    assert got(op11(spark, [(None, 1, "a", "b")])) == []
    assert got(op11(spark, [(4, 0, "a", "b")])) == brute([(4, 0, "a", "b")])


def op11(spark, rows):
    return pt.prefix_trie(table(spark, rows, 2) if rows else spark.createDataFrame([], SCHEMA))


def test_collisions_are_found_and_repaired(spark, monkeypatch):
    """Fingerprints modulo 3 and 7 put different prefixes together; the third attempt gives the right nodes."""
    attempts = []
    plain = pt.Fingerprints
    monkeypatch.setattr(pt, "Fingerprints", lambda seed, modulus: attempts.append(modulus) or plain(seed, modulus))
    rows = awkward()[:300]
    assert got(pt.prefix_trie(table(spark, rows), moduli=(3, 7, 2**61 - 1))) == brute(rows)
    assert attempts == [3, 7, 2**61 - 1]


def test_keys_of_different_texts_are_found(spark, monkeypatch):
    """Keys that ignore the text for the first attempt."""
    plain = pt._keyed
    monkeypatch.setattr(pt, "_keyed", lambda df, seed: plain(df, seed) if seed else plain(df, seed).selectExpr("conv", "turn", "role", "text", "1L as k1", "2L as k2"))
    rows = awkward()[:200]
    assert got(pt.prefix_trie(table(spark, rows))) == brute(rows)


def test_oracle_holds_on_awkward_rows(spark, tmp_path):
    rows = awkward()[:400]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert sorted(con.execute(SQL["op11_prefix_trie"]).fetchall(), key=str) == brute(rows)


def test_a_conversation_is_spread_over_partitions(spark):
    """One conversation in several ranges: the products of earlier partitions are carried."""
    prints = pt.Fingerprints(0, 2**61 - 1)
    keys = [(i * 7 + 1, i * 11 + 2) for i in range(30)]
    parts = [[(1, k) for k in keys[:4]], [(1, k) for k in keys[4:9]], [(1, k) for k in keys[9:11]] + [(2, k) for k in keys[11:20]], [(2, k) for k in keys[20:30]]]
    segments = []
    for n, part in enumerate(parts):
        last, p = part[-1][0], prints.EMPTY
        own = [k for c, k in part if c == last]
        for k in own:
            p = prints.extend(p, k)
        segments.append({"part": n, "first": part[0][0], "last": last, "n": len(own), "p1": p[0], "p2": p[1]})
    carried = pt._carried(prints, segments)
    product = lambda ks: __import__("functools").reduce(prints.extend, ks, prints.EMPTY)
    assert carried == {1: (1, 4, product(keys[:4])), 2: (1, 9, product(keys[:9])), 3: (2, 9, product(keys[11:20]))}
    whole, head = product(keys), product(keys[:12])
    assert prints.after(whole, head, 18) == product(keys[12:]) and prints.combine(head, product(keys[12:]), 18) == whole
    assert prints.parent(whole, keys[-1]) == product(keys[:-1])


def test_long_heads_are_refused(spark):
    from pyspark.sql import functions as F

    with pytest.raises(Exception, match="longer than 3 turns"):
        pt.prefix_trie(table(spark, [(1, 0, "a", "b")]), head=lambda c: F.lit(4), max_head=3)
