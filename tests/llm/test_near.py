"""Crowded keys of near-duplicate search: cells and forests against comparing all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest

from claimstar.llm import common, fingerprints, simhash

from .test_operators import documents, prose


def classes(nodes, linked):
    """node: the least node that it reaches, by comparing all pairs."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in combinations(nodes, 2):
        if linked(a, b):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {n: find(n) for n in nodes}


def test_forest_connects_what_is_linked():
    r = np.random.default_rng(2)
    at = r.integers(0, 400, 150)
    edges = common.forest(len(at), lambda i, rest: abs(at[rest] - at[i]) <= 3)
    found = classes(range(len(at)), lambda a, b: (a, b) in set(edges) or (b, a) in set(edges))
    assert found == classes(range(len(at)), lambda a, b: abs(int(at[a]) - int(at[b])) <= 3)
    assert len(edges) == len(at) - len(set(found.values()))
    assert common.forest(0, None) == common.forest(1, None) == []


def test_members_of_a_key_meet_in_cells(spark):
    rows = [(k, m) for k, n in ((1, 1), (2, 2), (3, 90)) for m in range(n)]
    dealt = common.cells(spark.createDataFrame(rows, "key long, m long"), "key", "m", 10).collect()
    held = {}
    for r in dealt:
        held.setdefault((r["cell_key"], r["low"], r["high"]), set()).add(r["m"])
    met = {(c[0], *sorted(p)) for c, members in held.items() for p in combinations(members, 2)}
    assert met == {(2, 0, 1), *((3, *p) for p in combinations(range(90), 2))}
    assert max(map(len, held.values())) < 60


@pytest.mark.parametrize("crowd", [0, 5, 64])
def test_simhash_classes_of_crowded_keys(spark, crowd):
    """A ball of near fingerprints, chains, and others: each crowd gives the classes of all pairs."""
    r = random.Random(6)
    center, other = r.getrandbits(64), r.getrandbits(64)
    prints = {center, 0, other}
    while len(prints) < 120:
        prints.add(center ^ sum(1 << b for b in r.sample(range(64), r.randint(1, 5))))
    for _ in range(40):
        other ^= sum(1 << b for b in r.sample(range(64), r.randint(2, 4)))
        prints.add(other)
    nodes = [p - (1 << 64) if p >> 63 else p for p in prints]
    wanted = classes(nodes, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    frame = spark.createDataFrame([(p,) for p in nodes], "print long")
    edges = simhash.links(frame, crowd=crowd)
    found = {p: p for p in nodes} | {x["a"]: x["b"] for x in simhash.components(edges).collect()}
    assert found == wanted


def edit(r, text, share):
    letters = list(text)
    for _ in range(max(1, int(len(text) * share))):
        i = r.randrange(len(letters) + 1)
        letters[i : i + r.randint(0, 1)] = r.choice("abc") * r.randint(0, 1)
    return "".join(letters)


def near(a, b):
    return fingerprints.likeness(fingerprints.parse(a), fingerprints.parse(b)) >= fingerprints.NEAR


@pytest.mark.parametrize("block", [4, common.CELL])
def test_links_of_short_fingerprints_are_complete(spark, block):
    r = random.Random(9)
    texts = {"", "a", *("".join(r.choices("ab", k=r.randint(1, 12))) for _ in range(150))}
    texts |= {edit(r, t, 0.1) for t in list(texts)}
    prints = {fingerprints.as_text(d) for d in fingerprints.embed(sorted(texts))}
    nodes = sorted(p for p in prints if len(p) <= 2 * fingerprints.SAMPLES)
    frame = spark.createDataFrame(list(enumerate(nodes)), "print long, fingerprint string")
    links = [(x["a"], x["b"]) for x in fingerprints.near_links(frame, block=block).collect()]
    assert all(near(nodes[a], nodes[b]) for a, b in links)
    found = classes(range(len(nodes)), lambda a, b: (a, b) in set(links) or (b, a) in set(links))
    assert found == classes(range(len(nodes)), lambda a, b: near(nodes[a], nodes[b]))


def test_classes_of_edited_texts(spark):
    """Nine of ten linked pairs of long texts at least, no other, and rows as they came."""
    r = random.Random(12)
    origin = [t for t in prose(51, 60) if len(t) > 60]
    texts = [*origin, *(edit(r, t, 0.01) for t in origin), origin[0], None, ""]
    docs = documents(spark, [*enumerate(texts), (None, origin[1]), (None, "nowhere else, no id")])
    plain = fingerprints.fingerprints(docs)
    rows = fingerprints.near_classes(plain).collect()
    key = lambda row: str(row[:7])
    assert sorted(map(key, rows)) == sorted(map(key, plain.collect()))
    prints = {row["fingerprint"] for row in rows}
    root = classes(sorted(prints), near)
    least = {}
    for row in rows:
        if row["doc_id"] is not None:
            group = root[row["fingerprint"]]
            least[group] = min(least.get(group, row["doc_id"]), row["doc_id"])
    right = [row["class_id"] == least.get(root[row["fingerprint"]]) for row in rows]
    assert np.mean(right) >= 0.9
    by_id = {row["doc_id"]: row for row in rows}
    assert by_id[len(texts) - 3]["class_id"] == 0
    assert by_id[len(texts) - 2]["class_id"] == by_id[len(texts) - 1]["class_id"] == len(texts) - 2
    assert [row["class_id"] for row in rows if row["n_chars"] == 19] == [None]


def test_likeness_of_many_is_that_of_each():
    prints = [fingerprints.as_text(d) for d in fingerprints.embed(["", "a", *prose(3, 20)])]
    width = max(map(len, prints))
    rows = np.array([np.append(fingerprints.parse(p), np.full(width - len(p), 16)) for p in prints])
    for i, p in enumerate(prints):
        wanted = [fingerprints.likeness(fingerprints.parse(p), fingerprints.parse(q)) for q in prints]
        assert fingerprints.likeness_to(rows[i], rows).tolist() == pytest.approx(wanted)
