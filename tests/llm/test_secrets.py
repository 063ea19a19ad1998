"""Candidates of the secret scan: names that are runs themselves, short values, unlabelled passwords."""

import pytest

from claimstar.llm import secrets

from .test_operators import documents

KEY = "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY01"
LINES = [
    (1, f"export AWS_SECRET_ACCESS_KEY={KEY}", KEY, 1.0),
    (2, f'stripe_production_api_key = "{KEY}"', KEY, 1.0),
    (3, 'password = "Tr0ub4dor&3xy"', "Tr0ub4dor&3xy", 1.0),
    (4, f"see https://user:{KEY}@host/x", KEY, None),
    (5, f"eyJhbGciOiJIUzI1NiIsInR5cCI6IkpXVCJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.{KEY} x", KEY, None),
    (6, "padded c2VjcmV0IHBhZGRlZCB2YWx1ZQ== here", "c2VjcmV0IHBhZGRlZCB2YWx1ZQ==", None),
    (7, "the password: see below", "see", 0.0),
]


@pytest.fixture(scope="module")
def found(spark):
    rows = secrets.candidates(documents(spark, [(i, t) for i, t, *_ in LINES]))
    return secrets.rule_labels(secrets.with_numbers(rows, [])).collect()


def test_candidates_and_labels(found):
    by = {(r["doc_id"], r["secret"]): r for r in found}
    for i, text, secret, label in LINES:
        row = by[(i, secret)]
        assert text[row["begin"] : row["begin"] + len(secret)] == secret
        assert row["label"] == label, text
        assert (row["credential_near"] == 1.0) == (i in (1, 2, 3, 7))


def test_text_around_is_the_original(found):
    texts = {i: t for i, t, *_ in LINES}
    for r in found:
        text, end = texts[r["doc_id"]], r["begin"] + len(r["secret"])
        assert r["before"] == text[: r["begin"]][-60:] and r["after"] == text[end : end + 40]


def mask_by_hand(text, spans):
    covered = [any(a <= i < b for a, b in spans) for i in range(len(text))]
    merged = []
    for a, b in sorted(spans):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        elif a < b:
            merged.append([a, b])
    starts = {a for a, _ in merged if a < len(text)}
    return "".join((secrets.MASK if i in starts else "") + ("" if covered[i] else c) for i, c in enumerate(text))


@pytest.mark.parametrize("chunk", [4096, 7])
def test_places_are_masked_and_nothing_else(spark, monkeypatch, chunk):
    monkeypatch.setattr(secrets, "CHUNK", chunk)
    texts = {
        1: ("key a1 in lambda1, é😀 a1\nend", [(4, 6)]),
        2: ("zzz9 abczzz9 zzz9", [(0, 4), (5, 12)]),
        3: ("overlapping secrets here", [(3, 9), (5, 15), (5, 6), (15, 17)]),
        4: ("nothing found", []),
        5: ("😀" * 40 + "tail", [(0, 3), (10, 30), (39, 44), (50, 60)]),
        6: ("", [(0, 4)]),
    }
    docs = documents(spark, [(i, t) for i, (t, _) in texts.items()] + [(1, texts[1][0]), (7, None)])
    rows = [(i, a, b) for i, (_, spans) in texts.items() for a, b in spans]
    findings = spark.createDataFrame([*rows, (None, 0, 3), (7, 0, 3)], "doc_id long, begin int, end int")
    found = sorted((r["doc_id"], r["text"]) for r in secrets.redacted(docs, findings, "doc_id").collect() if r["text"] is not None)
    wanted = [(i, mask_by_hand(t, spans)) for i, (t, spans) in texts.items()]
    assert found == sorted(wanted + [wanted[0]])
    assert secrets.redacted(docs, findings, "doc_id").where("doc_id = 7").first()["text"] is None


def test_a_value_elsewhere_in_the_text_stays(spark):
    text = f'token = "{KEY}"\nthe word {KEY}x is another and lambda1 too'
    docs = documents(spark, [(1, text)])
    one = secrets.candidates(docs).where(f"secret = '{KEY}'").selectExpr("row", "begin", "begin + length(secret) as end")
    assert secrets.redacted(docs, one).first()["text"] == text.replace(KEY + '"', secrets.MASK + '"')


def test_many_candidates_in_one_text(spark):
    keys = [f"{n:08x}{n * 7919 % 4294967296:08x}" for n in range(100_000)]
    docs = documents(spark, [(1, "some words, " + " ".join(keys))])
    found = {r["begin"]: r["secret"] for r in secrets.candidates(docs).select("begin", "secret").collect()}
    assert found == {12 + 17 * n: key for n, key in enumerate(keys)}
