"""Quality by a generalised additive model with pairwise interactions, fitted by cyclic boosting.

Text statistics are cut into bins at quantiles of the training sample. Boosting visits the features
in turn; each visit fits a shallow tree (depth two) on one feature's bins to the logistic gradient
and adds a small step of it to the feature's lookup table. Pairs that explain most of what is left
are boosted the same way over two-dimensional tables. A score is the sigmoid of the intercept and
the tables' entries at the document's bins: a few vectorised gathers and additions.

The fit uses at most `SAMPLE_ROWS` labelled documents outside the held-out bucket (those of least id
hash); only their statistics leave the executors. Scoring reads every whole text.

Nulls: a null or empty text has zero statistics and is scored like any other. Without labels the
score is 1/2. Rows of equal doc_id are scored one by one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimstar.llm import common

SAMPLE_ROWS = 10_000
BINS = 24
PAIR_BINS = 8
PAIRS = 6
CYCLES = 120
PAIR_CYCLES = 60
RATE = 0.2
THRESHOLD = 0.3
HELD_OUT = (5, 0)  # modulus and remainder of crc32(doc_id as text)

STATISTICS = (
    "words", "word_length", "distinct", "commonest", "repeats", "letters", "capitals", "digits",
    "marks", "symbols", "bars", "line_words", "line_repeats", "ends", "long_words", "shortest_line",
)

_KINDS = np.zeros(256, np.int64)  # 1 lower, 2 upper, 3 digit, 4 blank, 5 stop or comma, 6 bar, 7 other
_KINDS[:] = 7
_KINDS[128:] = 1
_KINDS[97:123] = 1
_KINDS[65:91] = 2
_KINDS[48:58] = 3
_KINDS[[9, 10, 11, 12, 13, 32]] = 4
_KINDS[[44, 46]] = 5
_KINDS[124] = 6
_KINDS = _KINDS.astype(np.uint8)


def statistics(text: str | None) -> list[float]:
    """The document's numbers, in the order of STATISTICS."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    raw = np.frombuffer(text.encode(), np.uint8)
    kinds = np.bincount(_KINDS[raw], minlength=8)
    size = max(1, len(raw) - kinds[4])
    counts = Counter(words)
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    lines = [line for line in text.split("\n") if line]
    letters = kinds[1] + kinds[2]
    lengths = np.fromiter(map(len, words), np.int64, n)
    return [
        float(n),
        float(lengths.mean()),
        len(counts) / n,
        max(counts.values()) / n,
        repeats / n,
        letters / size,
        kinds[2] / max(1, letters),
        kinds[3] / size,
        kinds[5] / n,
        kinds[7] / n,
        kinds[6] / n,
        n / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)),
        sum(line[-1] in ".!?" for line in lines) / max(1, len(lines)),
        float((lengths > 15).mean()),
        float(min(map(len, lines), default=0)),
    ]


class GamModel:
    """Bin edges, one table per feature, one table per pair, and the intercept."""

    def __init__(self, edges, tables, coarse, pairs, pair_tables, intercept: float) -> None:
        self.edges, self.tables, self.intercept = edges, tables, intercept
        self.coarse, self.pairs, self.pair_tables = coarse, pairs, pair_tables

    def logits(self, x: np.ndarray) -> np.ndarray:
        """Bin additions for all rows at once."""
        out = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            out += table[np.searchsorted(edges, x[:, j], side="right")]
        bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.coarse)]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            out += table[bins[i], bins[j]]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -40, 40)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def _leaves(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """A tree over ordered bins: the best cut of each piece, `depth` times over; a value per bin."""
    if depth:
        left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        right_g, right_h = g.sum() - left_g, h.sum() - left_h
        gain = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1)
        gain[(left_h < 0.5) | (right_h < 0.5)] = -1
        if len(gain) and gain.max() > g.sum() ** 2 / (h.sum() + 1) + 1e-9:
            cut = int(gain.argmax()) + 1
            return np.concatenate([_leaves(g[:cut], h[:cut], depth - 1), _leaves(g[cut:], h[cut:], depth - 1)])
    return np.full(len(g), -g.sum() / (h.sum() + 1))


def _quarters(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cross of one cut on each axis of a pair's bins: its gain and a value per cell."""
    best, value = -1.0, np.zeros_like(g)
    G, H = (np.pad(np.cumsum(np.cumsum(a, 0), 1), ((1, 0), (1, 0))) for a in (g, h))
    for a in range(1, g.shape[0]):
        for b in range(1, g.shape[1]):
            parts = []
            for S in (G, H):
                nw = S[a, b]
                ne, sw = S[a, -1] - nw, S[-1, b] - nw
                parts.append(np.array([nw, ne, sw, S[-1, -1] - nw - ne - sw]))
            gain = float((parts[0] ** 2 / (parts[1] + 1)).sum())
            if gain > best:
                leaf = -parts[0] / (parts[1] + 1)
                value = np.empty_like(g)
                value[:a, :b], value[:a, b:], value[a:, :b], value[a:, b:] = leaf
                best = gain
    return best, value


def fit(x: np.ndarray, y: np.ndarray) -> GamModel:
    """Cyclic boosting of the features' tables, then of the pairs that explain most of the rest."""
    if not len(y) or y.min() == y.max():
        sure = 0.0 if not len(y) else (30.0 if y.max() else -30.0)
        return GamModel([], [], [], [], [], sure)
    n, width = x.shape
    edges = [_edges(x[:, j], BINS) for j in range(width)]
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    intercept = float(np.log(y.mean() / (1 - y.mean())))
    z = np.full(n, intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        return p - y, p * (1 - p)

    for _ in range(CYCLES):
        for j in range(width):
            g, h = slopes()
            size = len(tables[j])
            step = RATE * _leaves(
                np.bincount(bins[j], g, minlength=size), np.bincount(bins[j], h, minlength=size), 2
            )
            tables[j] += step
            z += step[bins[j]]
    coarse = [_edges(x[:, j], PAIR_BINS) for j in range(width)]
    cells = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(coarse)]

    def table(i: int, j: int, v: np.ndarray) -> np.ndarray:
        a, b = len(coarse[i]) + 1, len(coarse[j]) + 1
        return np.bincount(cells[i] * b + cells[j], v, minlength=a * b).reshape(a, b)

    g, h = slopes()
    ranked = sorted(
        combinations(range(width), 2),
        key=lambda p: -_quarters(table(*p, g), table(*p, h))[0],
    )
    pairs = ranked[:PAIRS]
    pair_tables = [np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1)) for i, j in pairs]
    for _ in range(PAIR_CYCLES):
        for k, (i, j) in enumerate(pairs):
            g, h = slopes()
            step = RATE * _quarters(table(i, j, g), table(i, j, h))[1]
            pair_tables[k] += step
            z += step[cells[i], cells[j]]
    return GamModel(edges, tables, coarse, pairs, pair_tables, intercept)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [statistics(t.as_py()) for t in batch.column("text")]
        numbers = pa.array(rows, pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), numbers], ["doc_id", "label", "x"]
        )


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> GamModel:
    """The model of a bounded sample of the labelled documents that are not held out."""
    sample = common.labelled_sample(common.texts(docs), labels, "quality", *HELD_OUT, rows)
    measured = sample.mapInArrow(_measured, "doc_id long, label int, x array<double>")
    found = measured.toPandas().sort_values("doc_id")  # at most `rows` rows of 16 numbers
    x = np.array(found["x"].tolist()).reshape(len(found), len(STATISTICS))
    return fit(x, found["label"].to_numpy(float))


def _scored(model: GamModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t.as_py()) for t in batch.column(1)]
            x = np.array(rows).reshape(len(rows), len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.scores(x)), pa.array(rows, pa.list_(pa.float64()))],
                ["doc_id", "score", "statistics"],
            )

    return run


def score(docs: DataFrame, model: GamModel) -> DataFrame:
    """doc_id, score and the statistics behind it, of every document."""
    schema = "doc_id long, score double, statistics array<double>"
    return common.texts(docs).mapInArrow(_scored(model), schema)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = learn(docs, common.table(spark, sf_dir, "labels"))
    modulus, remainder = HELD_OUT
    return score(docs, model).select(
        "doc_id",
        (common.bucket("doc_id", modulus) == remainder).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
