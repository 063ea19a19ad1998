"""Best-fit packing of documents into sequences, in bulk-synchronous rounds over sorted runs.

Tasks encode documents, cut long ones, and number the pieces of each length. Lengths and gaps are
whole numbers up to the capacity, so documents and gaps sorted by size are runs of equal values:
what the rounds exchange is one count per length, at most `capacity` numbers, whatever the input.
A round takes the run of the longest pieces left and sweeps the gaps upwards from its successor,
the smallest gap that fits. Pieces that want the same gap get it by their rank in the run; bins
whose gap changed move to the run of the new gap, and the next round follows. A round's result is
a few intervals of ranks, and every task places its own pieces by rank.

Nulls: a null text is an empty document (the end id alone). Rows of equal doc_id are documents of
their own. An empty table gives no sequence.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimstar.llm import bpe, common

CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, seq long"


def _cut(tokenizer: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder(tokenizer)
        part = TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        for batch in batches:
            rows: list[tuple] = []
            ids = batch.column(0).to_pylist()
            for doc_id, tokens in zip(ids, encoder.encode_many(batch.column(1).to_pylist())):
                first = len(tokens) % capacity or min(len(tokens), capacity)
                ends = range(first, len(tokens) + 1, capacity)
                for piece, end in enumerate(ends):
                    start = end - capacity if piece else 0
                    crc = bpe.ids_crc32(tokens[start:end])
                    size = end - start
                    rows.append((doc_id, piece, start, size, crc, part, seen[size]))
                    seen[size] += 1
            if rows:
                types = (pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64())
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                names = [c.split()[0] for c in PIECES.split(", ")]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def sweeps(lengths: dict[int, int], capacity: int) -> np.ndarray:
    """The rounds over the runs: rows (length, first rank, first bin, pieces per bin, offset).

    A row holds from its first rank to that of the next row of its length: piece number k of it goes
    to bin `first bin + k // per bin`, at `offset + (k % per bin) * length`.
    """
    plan: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: runs (first bin, bins)
    open_gaps = np.zeros(capacity + 1, bool)
    bins = 0

    def release(gap: int, first: int, n: int) -> None:
        if gap and n:
            gaps[gap].append((first, n))
            open_gaps[gap] = True

    for length in sorted(lengths, reverse=True):
        left, rank = lengths[length], 0
        while left:
            fits = np.flatnonzero(open_gaps[length:])
            if len(fits):
                gap = int(fits[0]) + length
                first, n = gaps[gap].pop()
                open_gaps[gap] = bool(gaps[gap])
            else:
                gap = capacity
                per = capacity // length
                first, n = bins, -(-left // per)
                bins += n
            per = gap // length
            took = min(left, per * n)
            plan.append((length, rank, first, per, capacity - gap))
            full, some = divmod(took, per)
            release(gap - per * length, first, full)
            if some:
                release(gap - some * length, first + full, 1)
            release(gap, first + full + bool(some), n - full - bool(some))
            left -= took
            rank += took
    return np.array(sorted(plan), np.int64).reshape(-1, 5)


def _place(plan: np.ndarray):
    key = (plan[:, 0] << 44) + plan[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            row = np.searchsorted(key, (length << 44) + rank, side="right") - 1
            _, first_rank, first_bin, per, offset = plan[row].T
            k = rank - first_rank
            columns = [batch.column(i) for i in range(5)]
            columns += [pa.array(first_bin + k // per), pa.array(offset + k % per * length)]
            names = [*batch.schema.names[:5], "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its sequence and the place in it."""
    cut = common.texts(docs).mapInArrow(_cut(tokenizer, capacity), PIECES)
    pieces = common.stored(cut, "pieces")
    runs = common.stored(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "runs")
    totals = runs.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most `capacity` rows
    plan = sweeps({r["length"]: r["n"] for r in totals}, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("n").over(before), F.lit(0))
    ranks = runs.select("part", "length", earlier.alias("earlier"))
    # By shuffle at every size: the rank counts grow with the number of tasks.
    ranked = pieces.join(ranks.hint("merge"), ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("earlier") + F.col("seq")).alias("rank")
    )
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(_place(plan), schema)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"), bpe.vocabulary())
