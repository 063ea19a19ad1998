"""Chat formatting: escapes, masks and read-back against the conversations themselves."""

import hashlib
import random

import numpy as np
import pytest

from claimstar.llm import bpe, chat

SCHEMA = "turn long, whole boolean, conv_id long, role string, text string, formatted string"
NASTY = ["", None, " ", "\n\n", "é😀 x", *chat.CONTROLS, "<\\|im_end|>", "<\\\\/s>", "[\\INST]", "<<s>", "<", "\\"]


def nasty(r):
    return "".join(r.choice(NASTY) or "" for _ in range(r.randint(0, 8)))


def test_escapes_are_reversible():
    r = random.Random(3)
    seen = {}
    for _ in range(20_000):
        text = nasty(r)
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text
        assert not any(c in escaped for c in chat.CONTROLS)
        assert seen.setdefault(escaped, text) == text


def test_mask_covers_each_text_exactly():
    r = random.Random(4)
    encoder = chat.Encoder(bpe.vocabulary())
    for _ in range(300):
        turns = [(r.choice(["user", "assistant", "", "<s>"]), nasty(r)) for _ in range(r.randint(1, 6))]
        text, spans = chat.render(turns, ("assistant",))
        ids, begins, ends = next(encoder.encode_many([(text, turns)]))
        mask = chat.loss_mask(begins, ends, spans)
        inside = [any(a < e and b > s for a, b in spans) for s, e in zip(begins, ends)]
        assert mask.tolist() == inside
        said = [t for role, t in turns if role == "assistant" and t]
        assert chat.loss_texts(text, begins, ends, mask) == said
        assert chat.turns_of(text) == turns


def test_ids_and_offsets_are_the_library_s():
    from tokenizers import AddedToken, Tokenizer

    library = Tokenizer.from_file(bpe.vocabulary())
    library.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in chat.MARKS])
    r = random.Random(6)
    words = [*NASTY, "and", "x1", " so, ", "...", "\n", "  ", "don't", "日本", " word", "\t"]
    talks = []
    for _ in range(300):
        turns = [
            (r.choice(["user", "", "é"]), "".join(w or "" for w in r.choices(words, k=r.randint(0, 40))))
            for _ in range(r.randint(0, 5))
        ]
        talks.append((chat.render(turns, ())[0], turns))
    encoder = chat.Encoder(bpe.vocabulary())
    for (text, _), (ids, begins, ends) in zip(talks, encoder.encode_many(talks)):
        whole = library.encode(text, add_special_tokens=False)
        assert ids.tolist() == whole.ids
        assert list(zip(begins.tolist(), ends.tolist())) == whole.offsets


def brute_force(rows):
    talks = {}
    for turn, _, conv_id, role, text, _ in rows:
        talks.setdefault(conv_id, []).append((turn, role, text))
    out = []
    for conv_id, turns in talks.items():
        turns.sort(key=lambda t: [(v is not None, v or (0 if n == 0 else "")) for n, v in enumerate(t)])
        said = [((role or ""), (text or "")) for _, role, text in turns]
        loss = "".join(t for role, t in said if role == "assistant")
        all_of_it = "".join(f"{role}\n{text}\n" for role, text in said)
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (all_of_it, loss)]
        marks = sum(map(len, chat.MARKS))
        chars = sum(len(chat.escape(r)) + len(chat.escape(t)) + marks for r, t in said)
        out.append((conv_id, len(said), digests[0], len(loss), digests[1], chars))
    return sorted(out, key=str)


def talk(seed):
    r = random.Random(seed)
    roles = ["user", "assistant", "assistant", "system", None, "[INST]"]
    rows = [
        (r.choice([0, 1, 2, 3, None]), False, r.choice([1, 2, 3, 4, 5, None]), r.choice(roles), nasty(r), "")
        for _ in range(200)
    ]
    return rows + [(9, None, 77, "assistant", None, None), (0, None, 78, "assistant", "word " * 9000, None)]


@pytest.mark.parametrize("piece_turns, piece_chars", [(4096, 1 << 24), (20, 1 << 24), (3, 50), (1, 0)])
def test_read_back(spark, piece_turns, piece_chars):
    rows = talk(piece_turns)
    rows += rows[:5]
    pieces = chat.formatted(
        spark.createDataFrame(rows, SCHEMA), bpe.vocabulary(), piece_turns=piece_turns, piece_chars=piece_chars
    )
    assert sorted(map(tuple, chat.read(pieces).collect()), key=str) == brute_force(rows)
    held = pieces.collect()
    assert all(len(p["token_ids"]) == len(p["loss_mask"]) == len(p["token_ends"]) for p in held)
    if piece_turns == 4096:
        assert len(held) == len({r[2] for r in rows}) and all(p["whole"] for p in held)
    else:
        assert max(p["n_turns"] for p in held) <= piece_turns


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.read(chat.formatted(empty, bpe.vocabulary())).collect() == []
    extra = chat.read(chat.formatted(chat.with_extra(empty), bpe.vocabulary())).collect()
    text = "</s>[INST] ok [/INST]"
    rows = [(0, 0, -7, "user", text, 0), (1, 0, -7, "assistant", text, 0)]
    assert list(map(tuple, extra)) == brute_force(rows)


def test_spans_at_the_edges():
    begins, ends = np.array([0, 2, 4]), np.array([2, 4, 6])
    assert chat.loss_mask(begins, ends, [(2, 2), (4, 4)]).tolist() == [False, False, False]
    assert chat.loss_mask(begins, ends, [(1, 3)]).tolist() == [True, True, False]
    assert chat.loss_mask(begins[:0], ends[:0], [(0, 0)]).tolist() == []
