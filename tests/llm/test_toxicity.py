"""Toxicity of documents of any length: sentences without evidence do not add up."""

import pytest

from claimstar.llm import toxicity

from .test_operators import prose


@pytest.fixture(scope="module")
def model():
    texts = [t + (" you total nasty moron here." if i % 4 == 1 else "") for i, t in enumerate(prose(31, 600))]
    return toxicity.fit(texts, [int(i % 4 == 1) for i in range(len(texts))])


def test_clean_documents_of_any_length_stay(model):
    clean = " ".join(["The weather is fine today. Birds sing."] * 25_000)
    assert model.score(clean) == pytest.approx(model.score(None)) and model.score(clean) < 0.1
    assert model.spans(clean) == []
    assert model.score(clean + " You total nasty moron here. " + clean) > 0.9


def test_flagged_long_documents_have_a_span(model):
    text = "All is well. " * 20_000 + "You total nasty moron here. " + "All is well. " * 20_000
    (begin, end, p), = model.spans(text)
    assert text[begin:end].strip(". ") == "You total nasty moron here" and p >= toxicity.THRESHOLD
