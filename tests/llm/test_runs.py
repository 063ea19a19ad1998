"""Periodic runs against brute force, and the query against the contract worked out word by word."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from claimstar.llm import runs

from .test_operators import ODD, documents, prose


def brute_force(words, least, exponent):
    found = []
    for q in range(1, len(words) // exponent + 1):
        same = [a == b for a, b in zip(words, words[q:])]
        for stretch in re.finditer("1+", "".join("01"[s] for s in same)):
            start, length = stretch.start(), stretch.end() - stretch.start() + q
            run = words[start : start + length]
            smaller = any(all(a == b for a, b in zip(run, run[p:])) for p in range(1, q))
            if length >= max(least, exponent * q) and not smaller:
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def repetitive(r, n):
    words = [r.choice([b"a", b"b", b"c"][: r.randint(1, 3)]) for _ in range(n)]
    if n and r.random() < 0.6:
        a, p = r.randrange(n), r.randint(1, 12)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


@pytest.mark.parametrize("least, exponent", [(6, 4), (2, 2), (1, 3), (9, 2)])
def test_runs_of_small_texts(least, exponent):
    r = random.Random(least)
    for _ in range(150):
        texts = [repetitive(r, r.randint(0, 60)) for _ in range(r.randint(0, 5))]
        want = [brute_force(t, least, exponent) for t in texts]
        assert runs.runs_of(texts, least, exponent) == want


def test_very_long_texts():
    n = 300_000
    assert runs.runs_of([[b"x"] * n], 6, 4) == [[(0, n, 1)]]
    assert runs.runs_of([[b"%d" % (i % 777) for i in range(n)]], 6, 4) == [[(0, n, 777)]]
    assert runs.runs_of([[b"%d" % i for i in range(n)]], 6, 4) == [[]]


def contract(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_force(words, 6, 4)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    milli = 1000 * best[1] // best[2] if found else None
    digests = [hashlib.sha256(t.encode()).hexdigest() for t in (lines, left)]
    return (doc_id, len(found), *best, milli, *digests)


def test_query_against_the_contract(spark):
    r = random.Random(5)
    lines = ["the same line, again and again\n" * 9, "x " * 30 + "y " * 7, "a\x1cb a\x1cb c " * 6]
    mixed = [" ".join(w.decode() for w in repetitive(r, r.randint(1, 80))) for _ in range(120)]
    texts = [*ODD, *lines, *prose(11, 150), *mixed]
    rows = [*enumerate(texts, -20), (None, lines[0]), (None, None), (3, lines[1]), (3, lines[1])]
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, t in rows if t)
    found = runs.digests(runs.find(runs.with_repeats(documents(spark, rows)))).collect()
    assert sorted(map(tuple, found), key=str) == sorted((contract(*r) for r in rows), key=str)
    empty = documents(spark, rows).limit(0)
    assert runs.digests(runs.find(runs.with_repeats(empty))).collect() == []


def test_runs_keep_their_places(spark):
    found = runs.find(documents(spark, [(1, "go a b  a b\na b a b a stop")]), least=4, exponent=2).first()
    assert [tuple(r) for r in found["runs"]] == [(1, 9, 2)]
    assert found["collapsed"] == "go a b stop"
