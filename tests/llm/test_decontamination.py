"""Recall of decontamination at the largest allowed distance, against the edit distance itself."""

import random

import pytest

from claimstar.llm import decontamination

from .test_pipeline import holds


def edited(words, edits, kind, r):
    """The words after that many edits of one kind."""
    places = sorted(r.sample(range(1, len(words)), edits), reverse=True)
    words = list(words)
    for i in places:
        if kind == "substituted":
            words[i] = "zzz"
        elif kind == "deleted":
            del words[i]
        elif kind == "inserted":
            words.insert(i, "zzz")
    return words[edits:] if kind == "beheaded" else words


@pytest.mark.parametrize("kind", ["substituted", "deleted", "inserted", "beheaded"])
@pytest.mark.parametrize("size", [5, 12, 25, 40, 55, 100])
def test_recall_at_the_largest_distance(kind, size):
    r = random.Random(size)
    items = [(i, " ".join(f"v{r.randrange(3000)}" for _ in range(size))) for i in range(60)]
    filler = [f"f{i}" for i in range(30)]
    texts = [
        " ".join([*filler, *edited(t.split(), size // 5, kind, r), *filler]) for _, t in items
    ]
    expected = {(i, i) for i, t in items if holds(texts[i], t)}
    assert len(expected) == len(items)
    searcher = decontamination.Searcher(items, 0.8, decontamination.REPETITIONS)
    found = {(d, i) for d, i, *_ in searcher.find([decontamination.words(t) for t in texts])}
    assert len(expected & found) >= 0.9 * len(expected)
    assert all(holds(texts[d], dict(items)[i]) for d, i in found)
