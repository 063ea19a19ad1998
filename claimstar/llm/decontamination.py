"""Benchmark decontamination by CGK embedding and bit-sampling LSH over item-sized windows.

Texts are sequences of words (lower case, cut at blanks and ASCII punctuation); the distance is the
edit distance over words, and a document holds an item if some passage of it is at most
`floor((1 - similarity) * n)` edits from the item's n words.

Items are handled in classes of similar length. In each class:

1. Exact pruning: such a passage begins at a word of the class's items and holds, in its shortest
   length, at least that length less the allowed edits of its longest item in words of its items.
   It also holds all but the allowed edits of an item's rare words, those in no other item.
   Cumulative counts find all begins that qualify; no passage is lost here.
2. CGK: item and window walk through their words by the same random bits (step j moves on if the bit
   of (j, word) is set), which turns few edits into few differing steps. Long items are cut into
   parts of about `PART` words, and the walks begin at the parts in turn: with the allowed edits in a
   whole item, some part has no more than its share, however the edits lie. The windows of a part are
   those within the allowed edits of its place after a begin that qualifies.
3. Bit sampling: each of `repetitions` walks has its own bits and `sampled` of its steps as the key.
   The repetitions follow from the target recall at the largest distance, for substituted, deleted
   and inserted words (`tests/llm` measures it).
4. Verification: exact edit distance of the item to the best passage at each begin that the window
   leaves possible.

The benchmark goes to the tasks in blocks of at most `block` items; more items make more passes.

Nulls: null or empty texts hold nothing, and items without words are found nowhere. Rows of equal
doc_id give a row each. Empty tables give an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimstar.llm import common

SIMILARITY = 0.8
REPETITIONS = 32
SAMPLED = 3
PART = 8
BLOCK = 2000
CLASS_RATIO = 1.08
BATCH_WORDS = 400_000

FOUND = "doc_id long, item_id long, start_word long, distance long, item_words long, row long"

_BLANK = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_BLANK).split()


class _Class:
    """Items of similar length: their words, walks and keys."""

    def __init__(self, items: list[tuple[int, np.ndarray]], similarity: float, rare) -> None:
        self.names = np.array([i for i, _ in items], np.int64)
        self.sizes = np.array([len(w) for _, w in items], np.int64)
        self.low, self.high = int(self.sizes.min()), int(self.sizes.max())
        self.edits = np.floor((1 - similarity) * self.sizes + 1e-9).astype(np.int64)
        self.words = np.full((len(items), self.high), -1, np.int64)
        for row, (_, w) in zip(self.words, items):
            row[: len(w)] = w
        self.needed = self.low - int(self.edits.max())
        self.mine = np.zeros(len(rare), bool)
        self.mine[self.words[self.words >= 0]] = True
        self.rare = rare & self.mine
        rares = np.array([int(rare[w].sum()) for _, w in items])
        self.rare_needed = int((rares - self.edits).min())
        self.reach = int((self.sizes + self.edits).max())
        parts = max(1 + bool(self.edits.any()), self.low // PART)
        self.offsets = [i * self.low // parts for i in range(parts)]
        self.steps = max(SAMPLED, int(1.8 * self.low / parts))


def _walk(words: np.ndarray, start: np.ndarray, end: np.ndarray, bits: np.ndarray, steps, among=None):
    """The rows whose walk goes on and the words they saw at the sampled steps; beyond the end, -1.

    With `among`, the words that any item saw at each sampled step, other rows stop there.
    """
    row = np.arange(len(start))
    at, end = start.astype(np.int32), end.astype(np.int32)
    last = np.int32(len(words) - 1)
    seen: list[np.ndarray] = []
    for step in range(steps[-1] + 1):
        inside = at < end
        word = np.where(inside, words[np.minimum(at, last)], np.int32(-1))
        if step in steps:
            seen.append(word)
            if among is not None:
                on = among[len(seen) - 1][word]
                row, at, end, word, inside = row[on], at[on], end[on], word[on], inside[on]
                seen = [s[on] for s in seen]
        at += bits[step, word & 1023] & inside
    return row, seen


def _mixed(seen: list[np.ndarray]) -> np.ndarray:
    """One exact key of the sampled words (numbers of at most 20 bits each, three of them)."""
    key = np.zeros(len(seen[0]), np.int64)
    for word in seen:
        key = key * 1_048_573 + word.astype(np.int64) + 1
    return key


def _distances(items: np.ndarray, sizes: np.ndarray, regions: np.ndarray) -> np.ndarray:
    """Edit distance of each item to the best prefix of its region (rows are aligned)."""
    n, width = regions.shape
    row = np.broadcast_to(np.arange(width + 1), (n, width + 1)).copy()
    best = np.full(n, np.iinfo(np.int64).max)
    best[sizes == 0] = 0
    steps = np.arange(width + 1)
    for i in range(items.shape[1]):
        cost = np.minimum(row[:, :-1] + (regions != items[:, i : i + 1]), row[:, 1:] + 1)
        new = np.concatenate([row[:, :1] + 1, cost], axis=1)
        row = np.minimum.accumulate(new - steps, axis=1) + steps
        done = sizes == i + 1
        best[done] = row[done].min(axis=1)
    return best


class Searcher:
    """All items of a block, ready to be looked for."""

    def __init__(self, items: list[tuple[int, str]], similarity: float, repetitions: int) -> None:
        tokens = [(i, words(t)) for i, t in items]
        tokens = [(i, w) for i, w in tokens if w]
        self.vocabulary: dict[bytes, int] = {}
        for _, w in tokens:
            for word in w:
                self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
        numbered = sorted(
            ((i, np.array([self.vocabulary[x] for x in w], np.int64)) for i, w in tokens),
            key=lambda x: (len(x[1]), x[0]),
        )
        uses = np.zeros(len(self.vocabulary) + 1, np.int64)
        for _, w in numbered:
            uses[np.unique(w)] += 1
        self.rare = uses == 1
        self.classes: list[_Class] = []
        held: list = []
        for item in numbered:
            if held and len(item[1]) > max(CLASS_RATIO * len(held[0][1]), len(held[0][1])):
                self.classes.append(_Class(held, similarity, self.rare))
                held = []
            held.append(item)
        if held:
            self.classes.append(_Class(held, similarity, self.rare))
        self.tables = [self._tables(c, repetitions, n) for n, c in enumerate(self.classes)]

    @staticmethod
    def _tables(c: _Class, repetitions: int, seed: int):
        random = np.random.default_rng([seed, 20260])
        flat, start = c.words.ravel(), np.arange(len(c.words)) * c.high
        tables = []
        for repetition in range(max(repetitions, 2 * len(c.offsets))):
            offset = c.offsets[repetition % len(c.offsets)]
            bits = random.integers(0, 2, (c.steps, 1024), np.int8).astype(bool)
            edge = np.linspace(c.steps // 6, c.steps, SAMPLED).astype(int)  # an early one stops most
            steps = [int(random.integers(a, b)) for a, b in zip([0, *edge], [max(1, edge[0]), *edge[1:]])]
            _, seen = _walk(flat, start + offset, start + c.sizes, bits, steps)
            among = np.zeros((SAMPLED, len(c.mine) + 1), bool)  # the last place is that of -1
            for places, word in zip(among, seen):
                places[word] = True
            key = _mixed(seen)
            order = np.argsort(key, kind="stable")
            tables.append((offset, bits, steps, among, key[order], order))
        return tables

    @staticmethod
    def _near(begins: np.ndarray, offset: int, edits: int, last: int) -> np.ndarray:
        """The places up to `last` that are at most `edits` from `offset` after a begin, each once."""
        low, high = begins + offset - edits, begins + offset + edits + 1
        low[1:] = np.maximum(low[1:], high[:-1])
        low, high = np.clip(low, 0, last + 1), np.clip(high, 0, last + 1)
        return Searcher._runs(low, high - low)

    @staticmethod
    def _runs(low: np.ndarray, n: np.ndarray) -> np.ndarray:
        """low, low + 1, ..., of each n numbers, one after another."""
        return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - low, n)

    def find(self, documents: list[list[bytes]]) -> Iterator[tuple[int, int, int, int, int]]:
        """(document, item id, first word, distance, words of the item), the best place of each."""
        sizes = np.fromiter(map(len, documents), np.int64, len(documents))
        get = self.vocabulary.get
        flat = np.concatenate(
            [np.fromiter(map(get, d, repeat(0)), np.int32, len(d)) for d in documents] or [[]]
        ).astype(np.int32)
        if not len(flat):
            return
        ends = np.cumsum(sizes)
        count = np.empty(len(flat) + 1, np.int32)
        for c, tables in zip(self.classes, self.tables):
            begins = self._begins(flat, ends, count, c, c.mine, c.low, max(c.needed, 1), None)
            begins = self._begins(flat, ends, count, c, c.rare, c.reach, c.rare_needed, begins)
            if len(begins):
                doc = np.searchsorted(ends, begins, side="right")
                yield from self._verified(c, tables, flat, begins, doc, ends, sizes)

    @staticmethod
    def _begins(flat, ends, count, c, counted, reach, needed, begins):
        """Begins that have `needed` of the counted words within reach and the document."""
        is_mine = c.mine[flat] if begins is None else None
        if needed <= 0 or (begins is not None and not len(begins)):
            return begins
        count[0] = 0
        np.cumsum(is_mine if is_mine is not None else counted[flat], dtype=np.int32, out=count[1:])
        if begins is None:  # documents' ends first cut off too little, then exactly
            far = np.minimum(np.arange(reach, len(flat) + reach), len(flat))
            begins = np.flatnonzero(is_mine & (count[far] - count[:-1] >= needed))
        limit = ends[np.searchsorted(ends, begins, side="right")]
        far = np.minimum(begins + reach, limit)
        return begins[count[far] - count[begins] >= needed]

    def _verified(self, c, tables, flat, begin, doc, ends, sizes):
        most = int(c.edits.max())
        windows = {}
        for offset in c.offsets:
            at = self._near(begin, offset, most, len(flat) - 1) if offset else begin
            limit = ends[np.searchsorted(ends, at, side="right")]
            windows[offset] = at, np.minimum(at + c.high - offset, limit)
        pairs = []
        for offset, bits, steps, among, key, order in tables:
            at, end = windows[offset]
            row, seen = _walk(flat, at, end, bits, steps, among)
            mine = _mixed(seen)
            low = np.searchsorted(key, mine)
            n = np.searchsorted(key, mine, side="right") - low
            item = order[self._runs(low, n)]
            window = np.repeat(row, n)
            if offset:  # all begins that the item's edits before the part allow
                place, far = at[window] - offset, c.edits[item]
                low = np.searchsorted(begin, place - far)
                n = np.searchsorted(begin, place + far, side="right") - low
                window, item = self._runs(low, n), np.repeat(item, n)
            pairs.append(np.unique(window * len(key) + item))
        pairs = np.unique(np.concatenate(pairs))
        width = c.high + int(c.edits.max())
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for at in range(0, len(pairs), 4096):
            window, item = np.divmod(pairs[at : at + 4096], len(c.names))
            reach = begin[window, None] + np.arange(width)
            inside = reach < ends[doc[window], None]
            region = np.where(inside, flat[np.minimum(reach, len(flat) - 1)], 0)
            distance = _distances(c.words[item], c.sizes[item], region)
            near = distance <= c.edits[item]
            for w, i, d in zip(window[near].tolist(), item[near].tolist(), distance[near].tolist()):
                name = (int(doc[w]), i)
                best[name] = min(best.get(name, (d, int(begin[w]))), (d, int(begin[w])))
        for (d, i), (distance, start) in best.items():
            first = int(ends[d] - sizes[d])
            yield d, int(c.names[i]), start - first, distance, int(c.sizes[i])


def _search(items: list[tuple[int, str]], similarity: float, repetitions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(items, similarity, repetitions)

        def found(names: list, documents: list) -> pa.RecordBatch:
            rows = [(names[d][0], *rest, names[d][1]) for d, *rest in searcher.find(documents)]
            columns = zip(*rows) if rows else [[]] * 6
            arrays = [pa.array(x, pa.int64()) for x in columns]
            return pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in FOUND.split(", ")])

        for batch in batches:
            names, documents, size = [], [], 0
            ids = zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())
            for name, text in zip(ids, batch.column(1)):
                documents.append(words(text.as_py()))
                names.append(name)
                size += len(documents[-1])
                if size > BATCH_WORDS:
                    yield found(names, documents)
                    names, documents, size = [], [], 0
            if documents:
                yield found(names, documents)

    return run


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = SIMILARITY,
    repetitions: int = REPETITIONS,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document and item that it holds, with the best place and its distance."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    items = items.where("item_id is not null and text is not null").distinct()
    passes = -(-items.count() // block) or 1
    plain = common.keyed(docs)
    found = None
    for one in range(passes):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == one).collect()
        mine = plain.mapInArrow(_search([tuple(r) for r in rows], similarity, repetitions), FOUND)
        found = mine if found is None else found.union(mine)
    return found


def without_leaks(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows whose text holds no item, with or without an id and whatever rows share it."""
    leaking = common.stored(found.select(F.col("row").alias("claimstar_row")).distinct(), "leaking")
    rows = docs.withColumn("claimstar_row", common.row_key())
    return rows.join(leaking, "claimstar_row", "left_anti").select(*docs.columns)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return leaks(docs, common.table(spark, sf_dir, "benchmark")).drop("row")
