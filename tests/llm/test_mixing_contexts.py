"""Contexts of op8 are counted all bits at once; the counts are those of each bit by itself."""

import numpy as np
import pyarrow as pa

from claimstar.llm import mixing

TEXTS = ["the cat sat on the mat", None, "", "The end. " * 300, "word", "ä ö ü 12345 the cat"]
LEARN = [True, True, False, True, False, True]


def _batch(texts, learn):
    columns = [pa.array([0] * len(texts), pa.int64()), pa.array(range(len(texts)), pa.int64()), pa.array(learn)]
    names = ["part", "doc_id", "learn", "text"]
    return pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names)


def test_counts_are_those_of_each_bit(monkeypatch):
    zeros, ones = np.zeros(mixing.SLOTS, np.int64), np.zeros(mixing.SLOTS, np.int64)
    t = mixing.tokens(TEXTS)
    training = np.array(LEARN)[t.doc]
    one, two = (x[training] for x in mixing._before(t))
    for node, bit in mixing._bits(t.cls[training]):
        for slots in mixing._slots(one, two, node):
            np.add.at(ones, slots[bit == 1], 1)
            np.add.at(zeros, slots[bit == 0], 1)
    passes, bincount = [], np.bincount
    monkeypatch.setattr(mixing.np, "bincount", lambda *a, **k: passes.append(k.get("minlength")) or bincount(*a, **k))
    (found,) = mixing._count_contexts(iter([_batch(TEXTS, LEARN)]))
    used = np.flatnonzero(zeros + ones)
    _, key, z, o = (c.to_numpy() for c in found.columns)
    assert (key == used).all() and (z == zeros[used]).all() and (o == ones[used]).all()
    assert sum(n or 0 for n in passes) < 4 * mixing.SLOTS  # not two tables of all contexts a bit and predictor


def test_no_training_text_counts_nothing():
    assert list(mixing._count_contexts(iter([_batch(["held out"], [False])]))) == []


def test_long_words_of_a_class_keep_their_own_counts():
    """The length is capped in the class alone: each word has its key, none is dropped."""
    words = [f"w{'x' * n}ab" for n in range(1, 200)]
    t = mixing.tokens([" ".join(words)])
    assert t.sizes.tolist() == [200] and len(set(t.key.tolist())) == 200
    assert len(set(t.cls[:-1].tolist())) < 5
