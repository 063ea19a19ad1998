"""The piece encoder on very long texts: ids of the library, in a table that never fills."""

import random

import numpy as np

from claimstar.llm import bpe


def library(encoder, words, sep):
    """Ids of many words, encoded some at a time: cuts before a space between letters are exact."""
    ids = []
    for at in range(0, len(words), 100_000):
        part = sep.join(words[at : at + 100_000])
        ids += encoder.tokenizer.encode((sep if at else "") + part, add_special_tokens=False).ids
    return ids


def test_more_distinct_words_than_slots():
    encoder = bpe.Encoder(bpe.vocabulary())
    words = [f"{n:x}".translate(str.maketrans("0123456789", "ghijklmnop")) for n in range(3_000_000)]
    ids = next(encoder.encode_many([" ".join(words)]))
    assert ids[-1] == bpe.END and ids[:-1].tolist() == library(encoder, words, " ")
    assert encoder.known < encoder.SLOTS // 4 * 3


def test_long_odd_texts(monkeypatch):
    monkeypatch.setattr(bpe, "BATCH_BYTES", 64)
    encoder = bpe.Encoder(bpe.vocabulary(), cached=200)
    r = random.Random(2)
    some = ["\t", "a\x0bb", "<|endoftext|>", "\n", " ", "é", "word", "½", "so.", "x,y", "\r\n", "日本", "1", " "]
    texts = ["".join(r.choices(some, k=r.randint(0, 300))) for _ in range(300)]
    texts += ["".join(r.choices(some[3:], k=400)) for _ in range(100)]
    texts += [" ".join(r.choices(["and", "on", "é,", "b.c"], k=300)) + end for end in ("", " ", "\n", "\t")]
    texts += ["a" * 5000, "a,b" * 3000, "\n" * 999, "x\ny" * 700, "日" * 3000]
    for text, ids in zip(texts, encoder.encode_many(texts)):
        whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == [*whole, bpe.END]


def test_stretches_are_the_text():
    r = random.Random(3)
    for _ in range(300):
        raw = "".join(r.choices(["a", " ", "\n", ".", "é", "日"], k=r.randint(0, 90))).encode()
        parts = list(bpe.stretches(raw, 16))
        assert b"".join(parts) == raw
        first = np.cumsum([0, *map(len, parts[:-1])])
        assert set(first[1:]) <= set(bpe.cuts(np.frombuffer(raw, np.uint8), np.zeros(1, int)).tolist()) if raw else True
