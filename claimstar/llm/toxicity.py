"""Toxicity by multiple-instance learning: sentences combined by noisy-or, trained on documents.

A document is a bag of sentences. With z the sum of the weights of its words' features, a sentence
is clean with probability (1 - sigmoid(bias + z)) / (1 - sigmoid(bias)), at most 1: sentences without
evidence say nothing, however many there are. A document is toxic unless none of its sentences is and
one leak per document, for what no feature explains, does not apply: 1 - (1 - leak) * product(1 - p).
Gradients of the document label's likelihood reach the sentences through that product, so the model
learns which sentences offend without ever seeing a labelled sentence.

A word's features are the word and its prefixes and suffixes of a few lengths, lower case; those
that more toxic documents hold than chance allows enter the fit. It uses at most `SAMPLE_ROWS` labelled documents outside the held-out bucket (those of least id hash). Scoring reads every whole text.

Nulls: a null or empty text has no sentence and is scored by the leak. Documents without
labels, or an empty label table, are scored all the same (score 0 if nothing could be learnt). Rows
of equal doc_id are scored one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimstar.llm import common

SAMPLE_ROWS = 5000
MIN_DOCUMENTS = 4
EVIDENCE = 4.0  # standard deviations above the share that chance gives
AFFIXES = (4, 5)
THRESHOLD = 0.3
BIAS = -8.5
HELD_OUT = (4, 2)  # modulus and remainder of crc32(doc_id as text)
ROUNDS = 150
REMEMBERED = 100_000

_END = re.compile(r"[.?\n]+|(?<!!)!(?!!)")  # a run of exclamation marks is decoration
_TOKENS = re.compile(r"[^\W\d_]+|[.?\n]+|(?<!!)!(?!!)").findall
_ENDS = ".!?\n"


def features(word: str) -> list[tuple[str, int, str]]:
    """The word and its affixes, if longer than they: (kind, length, text)."""
    out = [("word", 0, word)]
    for n in AFFIXES:
        if len(word) > n:
            out += [("prefix", n, word[:n]), ("suffix", n, word[-n:])]
    return out


def _evidence(logits: np.ndarray, bias: float) -> np.ndarray:
    """-log(1 - p) of sentences: none where the weights add up to nothing or less."""
    return np.maximum(np.logaddexp(0.0, logits) - np.logaddexp(0.0, bias), 0.0)


class MilModel:
    """Weights by feature, the sentences' bias and the documents' leak (a logit); scores both."""

    def __init__(
        self, weights: dict[tuple[str, int, str], float], bias: float = BIAS, leak: float = -30.0
    ) -> None:
        self.weights, self.bias, self.leak = weights, bias, leak
        self._forget()

    def __getstate__(self):
        return self.weights, self.bias, self.leak

    def __setstate__(self, state) -> None:
        self.__init__(*state)

    def _forget(self) -> None:
        words = {f[2]: w for f, w in self.weights.items() if f[0] == "word"}
        affixes = [
            (n, *({f[2]: w for f, w in self.weights.items() if f[:2] == (kind, n)} for kind in ("prefix", "suffix")))
            for n in AFFIXES
        ]

        class Values(dict):
            """A word's summed weight; NaN marks the end of a sentence."""

            def __missing__(self, token: str) -> float:
                if token[0] in _ENDS:
                    value = float("nan")
                else:
                    value = words.get(token, 0.0)
                    for n, prefixes, suffixes in affixes:
                        if len(token) > n:
                            value += prefixes.get(token[:n], 0.0) + suffixes.get(token[-n:], 0.0)
                if len(self) < REMEMBERED:
                    self[token] = value
                return value

        self.values = Values()

    def logits(self, text: str | None) -> np.ndarray:
        """The sentences' logits, at least one."""
        tokens = _TOKENS((text or "").lower())
        value = np.fromiter(map(self.values.__getitem__, tokens), np.float64, len(tokens))
        sentence = np.isnan(value)
        value[sentence] = 0.0
        begins = np.append(0, np.flatnonzero(sentence))
        begins = begins[np.diff(begins, append=len(tokens)) > (begins > 0)]  # those with words
        if not len(begins):
            return np.array([self.bias])
        return self.bias + np.add.reduceat(value, begins)

    def score(self, text: str | None) -> float:
        """1 - (1 - leak) * product(1 - p) over the sentences."""
        return float(-np.expm1(-np.logaddexp(0.0, self.leak) - _evidence(self.logits(text), self.bias).sum()))

    def spans(self, text: str | None, threshold: float = THRESHOLD) -> list[tuple[int, int, float]]:
        """Where the sentences of at least that probability lie, in code points."""
        found, begin = [], 0
        text = text or ""
        for end in [*(m.start() for m in _END.finditer(text)), len(text)]:
            p = -np.expm1(-_evidence(self.logits(text[begin:end]), self.bias).max())
            if p >= threshold:
                found.append((begin, end, float(p)))
            begin = end
        return found


def _screened(texts: list[str | None], y: np.ndarray) -> set:
    """Features that more toxic documents hold than chance allows."""
    documents: dict[tuple, int] = {}
    toxic: dict[tuple, int] = {}
    known: dict[str, list] = {}
    for d, text in enumerate(texts):
        tokens = _TOKENS((text or "").lower())
        held: set = set()
        for token in set(tokens):
            if token[0] not in _ENDS:
                if token not in known:
                    known[token] = features(token)
                held.update(known[token])
        for f in held:
            documents[f] = documents.get(f, 0) + 1
            if y[d]:
                toxic[f] = toxic.get(f, 0) + 1
    rate = y.mean()
    kept = set()
    for f, k in toxic.items():
        n = documents[f]
        if n >= MIN_DOCUMENTS and k - n * rate > EVIDENCE * np.sqrt(n * rate * (1 - rate)):
            kept.add(f)
    return kept


def fit(texts: list[str | None], labels: list[int]) -> MilModel:
    """Adam on the noisy-or likelihood over the screened features, with a pull towards zero."""
    y = np.array(labels, np.float64)
    if not len(y) or y.min() == y.max():
        return MilModel({})
    kept = _screened(texts, y)
    number = {f: i for i, f in enumerate(sorted(kept))}
    rows, columns, owner = [], [], []  # sentences that hold a kept feature
    held_by: dict[str, list[int]] = {}
    for d, text in enumerate(texts):
        at = None
        for token in _TOKENS((text or "").lower()):
            if token[0] in _ENDS:
                at = None
                continue
            if token not in held_by:
                held_by[token] = [number[f] for f in features(token) if f in kept]
            if held_by[token]:
                if at is None:
                    at = len(owner)
                    owner.append(d)
                rows += [at] * len(held_by[token])
                columns += held_by[token]
    row, column, owned = (np.array(x, np.int64) for x in (rows, columns, owner))
    n = len(number)
    weight, leak = np.zeros(n), float(np.log(y.mean() / (1 - y.mean())))
    m, v, ml, vl = np.zeros(n), np.zeros(n), 0.0, 0.0
    for step in range(1, ROUNDS + 1):
        z = BIAS + np.bincount(row, weight[column], minlength=len(owned))
        none = np.logaddexp(0.0, leak) + np.bincount(owned, _evidence(z, BIAS), minlength=len(y))
        clean = np.exp(-none)
        pull = np.where(y > 0, -clean / np.maximum(1 - clean, 1e-9), 1.0) / len(y)
        slope = np.where(z >= BIAS, pull[owned] * np.exp(-np.logaddexp(0.0, -z)), 0.0)
        g = np.bincount(column, slope[row], minlength=n) + 1e-4 * np.sign(weight) + 1e-5 * weight
        gl = pull.sum() * np.exp(-np.logaddexp(0.0, -leak))
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        ml, vl = 0.9 * ml + 0.1 * gl, 0.99 * vl + 0.01 * gl * gl
        rate = 0.15 * (1 - step / (ROUNDS + 1)) + 0.005
        weight -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        leak -= rate * (ml / (1 - 0.9**step)) / (np.sqrt(vl / (1 - 0.99**step)) + 1e-8)
    strong = {f: float(weight[i]) for f, i in number.items() if abs(weight[i]) > 0.05}
    return MilModel(strong, BIAS, float(leak))


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> MilModel:
    """The model of a bounded sample of the labelled documents that are not held out."""
    sample = common.labelled_sample(common.texts(docs), labels, "toxic", *HELD_OUT, rows)
    found = sample.toPandas().sort_values("doc_id")  # at most `rows` documents
    return fit(found["text"].tolist(), found["label"].tolist())


def _scored(model: MilModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, spans = [], []
            for text in batch.column(1):
                value = text.as_py()
                scores.append(model.score(value))
                spans.append(model.spans(value) if scores[-1] >= THRESHOLD else [])
            rows = [[{"begin": a, "end": b, "score": p} for a, b, p in s] for s in spans]
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(rows, kind)],
                ["doc_id", "score", "spans"],
            )

    return run


def score(docs: DataFrame, model: MilModel) -> DataFrame:
    """doc_id, score, spans (offending sentences) of every document."""
    schema = "doc_id long, score double, spans array<struct<begin: long, end: long, score: double>>"
    return common.texts(docs).mapInArrow(_scored(model), schema)


def accepted(docs: DataFrame, model: MilModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of the frame whose text scores below the threshold, with their own columns."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for texts in frames:
            yield pd.Series([model.score(t) < threshold for t in texts])

    return docs.where(F.pandas_udf(run, "boolean")(F.col("text").cast("string")))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = learn(docs, common.table(spark, sf_dir, "labels"))
    modulus, remainder = HELD_OUT
    return score(docs, model).select(
        "doc_id",
        (common.bucket("doc_id", modulus) == remainder).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        F.size("spans").alias("n_spans"),
    )
