"""Plain Python versions of the contracts, for small inputs."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def op1(docs, items):
    """rows (doc_id, n_words, n_hit, n_items, items_sha256, contaminated)"""
    words = lambda t: WORD.findall((t or "").translate(LOWER))
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 12)) if w else ():
            windows[tuple(w[k : k + 13])].add(str(i))
    sizes = {len(w) for w in windows}
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[x]
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def op3(pages):
    by = defaultdict(list)
    for i, _, h in pages:
        by[h or ""].append(i)
    out = []
    for i, _, h in pages:
        b = (h or "").encode()
        top = max(by[h or ""])
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if i == top else "revisit", None if i == top else top))
    return out


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def op4(docs):
    sets = [(d, shingles(t)) for d, t in docs]
    up = {d: d for d, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    has = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            has[x].append(k)
    near = {(i, j) for v in has.values() if len(v) < 400 for a, i in enumerate(v) for j in v[a + 1 :]}
    for i, j in near:
        (a, s), (b, t) = sets[i], sets[j]
        n = len(s & t)
        if 100 * n >= 80 * (len(s) + len(t) - n):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return [(d, len(s), root(d)) for d, s in sets]


def op5(vectors, k=5):
    fine = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in vectors if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    size = max((len(v) for _, v in fine), default=0)
    x = np.array([v + [0] * (size - len(v)) for _, v in fine], dtype=object).reshape(len(fine), size)
    ids = np.array([i for i, _ in fine])
    out = []
    for i, v in zip(ids, x, strict=True):
        if i % 50 == 0:
            s = x @ v
            for r, j in enumerate([j for j in sorted(range(len(ids)), key=lambda j: (-s[j], ids[j])) if ids[j] != i][:k]):
                out.append((int(i), r + 1, int(ids[j]), min(max(int(s[j]), -(2**63)), 2**63 - 1)))
    return out


def op7(docs):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    lines = [(d, (t or "").split("\n")) for d, t in docs]
    holders = defaultdict(set)
    for d, ls in lines:
        for x in ls:
            if len(key(x)) >= 40:
                holders[key(x)].add(d)
    out = []
    for d, ls in lines:
        kept = [x for x in ls if len(holders.get(key(x), ())) < 5 or max(holders[key(x)]) == d]
        out.append((d, len(ls), len(ls) - len(kept), sha("\n".join(kept))))
    return out


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(s):
    total = 0
    for i, d in enumerate(reversed(s)):
        x = int(d) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def spans(text):
    out = []
    for n, (kind, form) in enumerate(BASE.items()):
        for m in re.finditer(form, text or ""):
            s = m.group()
            digits = re.sub(r"[^0-9]", "", s)
            fine = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in s.split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if fine:
                out.append((m.start(), n, kind, m.end()))
    return sorted(out)


def op8(docs):
    out = []
    for d, t in docs:
        s = spans(t)
        out.append((d, *[sum(x[2] == k for x in s) for k in BASE], sha(",".join(f"{k}:{a}:{b}" for a, _, k, b in s))))
    return out


def op9(rows):
    """rows (conv_id, turn, role, text) -> (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256)"""
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t, r or "", x or ""))
    out = []
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        out.append((c, len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), sha(loss)))
    return out


def held_out(i):
    return zlib.crc32(str(i).encode()) % 3 == 1
