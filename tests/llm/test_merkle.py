"""The Merkle manifest against trees folded level by level, at several fan-outs and band sizes."""

import hashlib
import random
import zlib

import pytest

from claimstar.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, lo int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    doc_id, text, lang, source, n_chars, *_ = row
    fields = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in fields))


def tree(digests, fanout):
    """The root, and per leaf the siblings (before, after) of each level."""
    paths = [[] for _ in digests]
    under = [[i] for i in range(len(digests))]
    while len(digests) > 1:
        for n, d in enumerate(digests):
            a = n - n % fanout
            for i in under[n]:
                paths[i].append(("".join(digests[a:n]), "".join(digests[n + 1 : a + fanout])))
        runs = range(0, len(digests), fanout)
        under = [sum(under[i : i + fanout], []) for i in runs]
        digests = [sha("".join(digests[i : i + fanout])) for i in runs]
    return digests[0], paths


def brute_force(rows, fanout):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    langs = sorted(trees, key=lambda v: (v is not None, (v or "").encode()))
    for rows_of in trees.values():
        rows_of.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    built = {lang: tree([leaf(r) for r in trees[lang]], fanout) for lang in langs}
    root, above = tree([built[lang][0] for lang in langs], fanout)
    out = []
    for lang, more in zip(langs, above):
        subroot, paths = built[lang]
        for row, path in zip(trees[lang], paths):
            path = path + more
            acc = leaf(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[4] is not None:
                acc = leaf((*row[:4], row[4] + 1))
            for before, after in path:
                acc = sha(before + acc + after)
            proof = sha("".join(b + a for b, a in path))
            out.append((row[0], leaf(row), subroot, root, proof, acc, acc == root))
    return sorted(out, key=str)


def rows_of(seed, n):
    r = random.Random(seed)
    langs = ["en", "en", "en", "de", "é", "", None, "-", "2:en"]
    texts = ["", None, "x", "línea\n" * 50, "long " * 9]
    rows = [
        (i, r.choice(texts), r.choice(langs), r.choice(["a", None]), r.choice([None, i, 5]), "clash", 1)
        for i in range(n)
    ]
    return rows + [rows[0]] * 3 + [(None, "t", "en", "s", 1, "clash", 1)] * 2 + [(1, "other", "en", "s", 1, "", 2)]


@pytest.mark.parametrize("fanout, levels", [(2, 10), (2, 2), (2, 1), (3, 1), (5, 2)])
def test_proofs(spark, fanout, levels):
    rows = rows_of(fanout, 150)
    docs = spark.createDataFrame(rows, SCHEMA)
    proven = merkle.proofs(merkle.document_leaves(docs), fanout=fanout, levels=levels)
    found = merkle.digests(proven).collect()
    assert sorted(map(tuple, found), key=str) == brute_force(rows, fanout)
    assert {r["verified"] for r in found} == {True, False}


def test_few_rows(spark):
    for n in (1, 2, 3, 5):
        rows = [(i, "t", "en", "s", 1, "", 0) for i in range(n)]
        found = merkle.digests(merkle.proofs(merkle.document_leaves(spark.createDataFrame(rows, SCHEMA))))
        assert sorted(map(tuple, found.collect()), key=str) == brute_force(rows, 2)
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.digests(merkle.proofs(merkle.document_leaves(empty))).collect() == []


def test_intervals_nest(spark):
    rows = rows_of(9, 60)
    leaves = merkle.document_leaves(spark.createDataFrame(rows, SCHEMA))
    leaves = leaves.withColumn("tree", merkle.field(leaves["lang"])).withColumnRenamed("leaf", "digest")
    built = merkle.bands(merkle.numbered(leaves, ["doc_id"]), 2, 2)
    nodes = merkle.manifest(built).collect()
    by = {}
    for node in nodes:
        by.setdefault((node["tree"], node["level"]), []).append((node["lo"], node["hi"]))
    for (name, level), held in by.items():
        held.sort()
        assert held[0][0] == 0 and all(a[1] == b[0] for a, b in zip(held, held[1:]))
        above = by.get((name, level + 1))
        if above is None:
            assert len(held) == 1
            continue
        assert all(sum(lo <= a and b <= hi for lo, hi in above) == 1 for a, b in held)
    assert sum(r["total"] for r in merkle.roots(built).collect()) == len(rows)


def test_a_missing_node_is_noticed():
    import numpy as np

    lo, hi = np.array([0, 4]), np.array([2, 6])
    assert merkle._contained(lo, hi, np.array([1, 5]), np.array([2, 6])).tolist() == [0, 1]
    with pytest.raises(ValueError):
        merkle._contained(lo, hi, np.array([1, 3]), np.array([2, 4]))
