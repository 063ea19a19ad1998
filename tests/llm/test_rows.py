"""Stages of the pipeline treat rows, not ids: rows without an id and different rows of one id."""

import corpus_pipeline
from claimstar.llm import decontamination, secrets, simhash

from .test_operators import documents, prose


def kept(frame):
    return sorted(((r["doc_id"], r["text"]) for r in frame.collect()), key=str)


def test_near_dedup_by_row(spark):
    a, b, c, d = [t for t in prose(41, 40) if len(t.split()) > 20][:4]
    rows = [(1, a), (1, b), (2, a), (3, c), (3, a), (None, c), (None, d), (None, d)]
    docs = documents(spark, rows)
    found = simhash.representatives(docs, simhash.near_duplicates(docs))
    assert kept(found) == sorted([(1, a), (1, b), (3, c), (None, d)], key=str)


def test_decontamination_by_row(spark):
    item, clean, other = [t for t in prose(42, 40) if len(t.split()) > 20][:3]
    docs = documents(spark, [(1, item), (1, clean), (None, item), (None, other), (2, None)])
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    found = decontamination.without_leaks(docs, decontamination.leaks(docs, bench))
    assert kept(found) == sorted([(1, clean), (None, other), (2, None)], key=str)


def test_masking_by_row(spark):
    key = "0f3a9c71e5b28d46" * 3
    docs = documents(spark, [(1, f'token = "{key}"'), (1, "well"), (None, f'token = "{key}"'), (None, "x")])
    masked = f'token = "{secrets.MASK}"'
    found = corpus_pipeline.mask_secrets(spark, docs, "")
    assert kept(found) == sorted([(1, masked), (1, "well"), (None, masked), (None, "x")], key=str)
