"""Periodic runs in documents: stretches of consecutive words that repeat with a period.

Descending-LCP Kruskal. The suffixes of the words of a document are ranked by prefix doubling, which
gives the longest common prefix (LCP) of neighbours in suffix order. Edges between neighbours are
taken by decreasing LCP, and each unites the classes of its two suffixes, kept as ordered sets of
positions, the smaller one into the larger. The LCP of an edge is then the exact LCP of every pair
that it brings together. Two positions that become adjacent, at a distance within their LCP (over
`exponent` - 1), and that differ in the word before, are the start of a run and its second period:
the run ends where their LCP does. No other position of the class lies between them, so the distance
is the smallest period, and each run is seeded exactly once, by its first word.

Edges with an LCP too small for any wanted run are left out. A batch of documents shares one pass of
sorting; a document larger than a batch is one of its own, with about 8 log2(longest repeat) bytes a
word. Each row is worked on where it lies: nothing is shuffled.

Nulls: a null or empty text has no words and no run; a null doc_id stays null. Equal rows give equal
results. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimstar.llm import common

BATCH_WORDS = 200_000
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def ranked_suffixes(symbols: np.ndarray, stop: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... symbols; those of the last level differ.

    `stop` is where the text of each position ends; symbols of different texts must differ. Only
    suffixes that still share a rank are sorted again.
    """
    n = len(symbols)
    _, group, sizes = np.unique(symbols, return_inverse=True, return_counts=True)
    rank = (np.cumsum(sizes) - sizes)[group]
    levels = [rank]
    active = np.argsort(rank, kind="stable")
    active = active[sizes[group[active]] > 1]
    step = 1
    while len(active):
        follow = active + step
        inside = follow < stop[active]
        second = np.where(inside, rank[np.where(inside, follow, 0)], -1)
        key = rank[active] * (n + 1) + second + 1
        by = np.argsort(key, kind="stable")
        active, key = active[by], key[by]
        first = rank[active]
        at = np.arange(len(active))
        fresh = np.append(True, key[1:] != key[:-1])
        old = np.append(True, first[1:] != first[:-1])
        begin = np.maximum.accumulate(np.where(fresh, at, 0))
        rank = rank.copy()
        rank[active] = first + begin - np.maximum.accumulate(np.where(old, at, 0))
        levels.append(rank)
        number = np.cumsum(fresh) - 1
        active = active[np.bincount(number)[number] > 1]
        step *= 2
    return levels


def neighbours(
    levels: list[np.ndarray], stop: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in suffix order that share `least` symbols or more, by decreasing LCP."""
    order = np.argsort(levels[-1], kind="stable")
    a, b = order[:-1], order[1:]
    shared = max(least, 1).bit_length() - 1  # the level of the longest prefix within `least`
    if shared >= len(levels):
        return a[:0], b[:0], a[:0]
    some = levels[shared][a] == levels[shared][b]
    a, b = a[some], b[some]
    lcp = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + lcp, b + lcp
        inside = (x < stop[a]) & (y < stop[b])
        same = levels[k][np.where(inside, x, a)] == levels[k][np.where(inside, y, b)]
        lcp += (inside & same).astype(np.int64) << k
    by = np.argsort(-lcp, kind="stable")
    by = by[: int((lcp >= least).sum())]
    return a[by], b[by], lcp[by]


def _united(large: list[int], small: list[int]) -> Iterator[tuple[int, int]]:
    """Pairs, one of each set, that are adjacent once `small` has joined `large`, which it then has."""
    last = len(small) - 1
    for n, x in enumerate(small):
        at = bisect_left(large, x)
        if at and (n == 0 or small[n - 1] < large[at - 1]):
            yield large[at - 1], x
        if at < len(large) and (n == last or large[at] < small[n + 1]):
            yield x, large[at]
    if last == 0:
        large.insert(bisect_left(large, small[0]), small[0])
    else:
        large += small
        large.sort()  # two ordered stretches: a merge


def kruskal(
    symbols: np.ndarray, begin: np.ndarray, stop: np.ndarray, least: int, exponent: int
) -> list[tuple[int, int, int]]:
    """(start, length, period) of all maximal runs of max(least, exponent * period) symbols or more."""
    shortest = max(exponent - 1, least - least // exponent, 1)  # of LCPs of wanted runs
    edges = neighbours(ranked_suffixes(symbols, stop), stop, shortest)
    sets: dict[int, list[int]] = {}
    found = []
    for a, b, lcp in zip(*(e.tolist() for e in edges)):
        large, small = sets.get(a) or [a], sets.get(b) or [b]
        if len(large) < len(small):
            large, small = small, large
        for i, j in _united(large, small):
            period = j - i
            if (
                period * (exponent - 1) <= lcp
                and period + lcp >= least
                and (i == begin[i] or symbols[i - 1] != symbols[j - 1])
            ):
                found.append((i, period + lcp, period))
        for x in small:
            sets[x] = large
        sets[a] = sets[b] = large
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_of(
    texts: list[list[bytes]], least: int, exponent: int
) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, given as its words, by start and period."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    total = int(lengths.sum())
    if not total:
        return out
    number: dict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    words = np.fromiter((number[w] for t in texts for w in t), np.int64, total)
    text = np.repeat(np.arange(len(texts)), lengths)
    symbols = text * len(number) + words
    ends = np.cumsum(lengths)
    begin, stop = (ends - lengths)[text], ends[text]
    for start, length, period in kruskal(symbols, begin, stop, least, exponent):
        out[text[start]].append((start - int(begin[start]), length, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by spaces."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def _mapper(least: int, exponent: int):
    def result(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        runs = runs_of(texts, least, exponent)
        flat = np.array([r for one in runs for r in one], np.int64).reshape(-1, 3)
        fields = [pa.array(flat[:, k]) for k in range(3)]
        values = pa.StructArray.from_arrays(fields, fields=list(RUN))
        offsets = np.cumsum([0, *map(len, runs)]).astype(np.int32)
        left = [collapsed(w, r).decode() for w, r in zip(texts, runs)]
        columns = [pa.array(ids, pa.int64()), pa.ListArray.from_arrays(offsets, values), pa.array(left)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[list[bytes]] = []
        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (text.as_py() or "").encode().split()  # at ASCII white space only
                if held and held + len(words) > BATCH_WORDS:
                    yield result(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(doc_id)
                texts.append(words)
                held += len(words)
        if ids:
            yield result(ids, texts)

    return run


def find(docs: DataFrame, least: int = 6, exponent: int = 4) -> DataFrame:
    """doc_id, runs (start, length, period; by start, then period) and collapsed text, a row per row.

    A run is a longest stretch of words with smallest period q and a length of max(least,
    exponent * q) or more; `exponent` is 2 or more. The collapsed text lacks the words that a run
    holds after its first q words.
    """
    if exponent < 2:
        raise ValueError("a run repeats its period: exponent is 2 or more")
    return common.texts(docs).mapInArrow(_mapper(least, exponent), SCHEMA)


def with_repeats(docs: DataFrame) -> DataFrame:
    """The contract's input: a tenth of the documents, by crc32 of the id, repeat words to their end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    repeated = F.expr(
        "array_join(transform(sequence(0, n - 1), i ->"
        " get(words, cast(if(i >= a, a + (i - a) % p, i) as int))), ' ')"
    )
    plain = common.texts(docs)
    chosen = (
        plain.withColumn("g", F.when(h % 10 == 0, g))
        .withColumn("words", F.when(F.col("g").isNotNull(), words))
        .withColumn("n", F.size("words").cast("long"))
        .withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
        .withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    )
    text = F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text"))
    return chosen.select("doc_id", text.alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns of found runs."""
    greatest = F.expr(
        "aggregate(runs, get(runs, 0),"
        " (a, r) -> if(r.length * a.period > a.length * r.period, r, a))"
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))

    def digest(text: Column) -> Column:
        return F.sha2(text.cast("binary"), 256)

    return found.withColumn("best", greatest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        digest(listed).alias("runs_sha256"),
        digest(F.col("collapsed")).alias("collapsed_sha256"),
    )


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(find(with_repeats(common.table(spark, sf_dir, "documents"))))
