"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits. Three or fewer differing bits leave
either one segment intact and another with at most one error, or exactly one error in each. The
binary Golay code (23 bits, 12 of data) is perfect: every word lies within distance 3 of exactly one
codeword. Two words at distance 1 share a codeword if one of them is filed under its own codeword
and the other is looked up under all codewords within distance 4: its own and, at error weight 3,
five more. Hence the keys of a fingerprint:

* six of (one segment exact, the codeword of another),
* two of (codewords of both 23-bit segments, one half of the 18-bit segment exact), for the case of
  one error in each: the error spoils one half only.

Distinct fingerprints are joined on these keys and verified by counting differing bits. Keys that
more than `CROWD` fingerprints are filed under are not joined: their members are dealt to cells (common.cells) in which any
two of them meet, and each cell gives a spanning forest of its links instead of all of them, so the
components are the same. They come from alternating large-star and small-star steps over stored edges.

Nulls: a null text is an empty one and has fingerprint zero, linked like any other; a null doc_id
takes part and is never a component's id unless all its ids are null. Rows of equal doc_id are
documents of their own, known by the hash of id and text. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimstar.llm import common

SHINGLE = 3
MAX_BITS = 3
SEED = 42
CROWD = 64  # most fingerprints filed under a key that a join compares with all that ask for it
GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
_SPANS = ((41, 23), (18, 23), (0, 18))  # shift and bits of the segments


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority of the bits of all shingles' XXH64; bytes.split cuts at exactly the ASCII blanks."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.append(0, ends[:-1] + 1)
        last = len(words) - shingle + 1
        spans = zip(starts[:last].tolist(), ends[shingle - 1 :].tolist())
        hashes = [digest(joined[a:b], SEED) for a, b in spans]
    ones = np.zeros(64, np.int64)
    for low in range(0, len(hashes), 4096):
        block = np.array(hashes[low : low + 4096], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


class Golay:
    """Decoding tables of the perfect (23, 12) code."""

    def __init__(self) -> None:
        words = np.arange(1 << 12, dtype=np.int64) << 11
        self.high = self._remainder(words)  # of the 12 data bits; the low 11 bits are their own
        syndromes = np.arange(1 << 11)
        code = words | self.high[words >> 11]
        weight = np.bitwise_count(code)
        heavy = code[weight == 7]
        self.error = np.zeros(1 << 11, np.int64)
        one = 1 << np.arange(23, dtype=np.int64)
        two = (one[:, None] | one[None, :]).ravel()
        three = (two[:, None] | one[None, :]).ravel()
        for patterns in (three, two, one):  # the lightest pattern of a syndrome stays
            self.error[self.syndrome(patterns)] = patterns
        self.error[0] = 0
        # Codeword indices of the neighbours at distance 4, to be xored to the own index.
        self.near = np.zeros((1 << 11, 5), np.int64)
        self.many = np.bitwise_count(self.error) == 3
        for s in syndromes[self.many]:
            self.near[s] = heavy[(heavy & self.error[s]) == self.error[s]] >> 11

    @staticmethod
    def _remainder(words: np.ndarray) -> np.ndarray:
        rest = words.copy()
        for bit in range(22, 10, -1):
            rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - 11)), rest)
        return rest

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        return self.high[words >> 11] ^ (words & 0x7FF)

    def decode(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codeword index and syndrome of each word."""
        syndrome = self.syndrome(words)
        return (words ^ self.error[syndrome]) >> 11, syndrome


_GOLAY: list[Golay] = []


def _golay() -> Golay:
    if not _GOLAY:
        _GOLAY.append(Golay())
    return _GOLAY[0]


def keys(prints: np.ndarray, lookup: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of fingerprints: under their own codewords, or for lookup all near ones too."""
    golay = _golay()
    prints = prints.astype(np.uint64)
    segment = [
        ((prints >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in _SPANS
    ]
    every = np.arange(len(prints))

    def indices(i: int) -> tuple[np.ndarray, np.ndarray]:
        own, syndrome = golay.decode(segment[i])
        if not lookup:
            return every, own
        many = np.flatnonzero(golay.many[syndrome])
        others = own[many, None] ^ golay.near[syndrome[many]]
        return np.concatenate([every, np.repeat(many, 5)]), np.concatenate([own, others.ravel()])

    filed = [indices(i) for i in range(3)]
    rows, found = [], []
    for kind, (i, j) in enumerate([(0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1)]):
        row, index = filed[j]
        rows.append(row)
        found.append(kind << 60 | segment[i][row] << 12 | index)
    (row_a, a), (row_b, b) = filed[0], filed[1]
    order = np.argsort(row_b, kind="stable")
    row_b, b = row_b[order], b[order]
    first = np.searchsorted(row_b, every)
    n = np.searchsorted(row_b, every, side="right") - first
    times = n[row_a]
    both = np.repeat(row_a, times)
    step = np.arange(len(both)) - np.repeat(np.cumsum(times) - times, times)
    pair = np.repeat(a, times) << 12 | b[first[both] + step]
    for half in (0, 1):
        rows.append(both)
        found.append((6 + half) << 60 | (segment[2][both] >> 9 * half & 0x1FF) << 24 | pair)
    return np.concatenate(rows), np.concatenate(found)


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            signed = np.array(prints, np.uint64).view(np.int64)
            columns = [batch.column(0), pa.array(signed), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "print", "row"])

    return run


def _keyed(lookup: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy()
            for low in range(0, len(prints), 2000):
                block = prints[low : low + 2000]
                rows, found = keys(block.view(np.uint64), lookup)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), pa.array(block[rows])], ["key", "print"]
                )

    return run


def _forests(max_bits: int):
    def spanning(prints: np.ndarray) -> list[tuple[int, int]]:
        bits = prints.view(np.uint64)
        return common.forest(
            len(bits), lambda i, rest: np.bitwise_count(bits[rest] ^ bits[i]) <= max_bits
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in common.whole_cells(batches):
            prints = np.unique(cell.column("print").to_numpy())
            edges = np.array(spanning(prints), np.int64).reshape(-1, 2)
            pairs = np.sort(prints[edges], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 1]), pa.array(pairs[:, 0])], ["a", "b"])

    return run


def links(prints: DataFrame, max_bits: int = MAX_BITS, crowd: int = CROWD) -> DataFrame:
    """Pairs (a, b), b < a, of distinct fingerprints that differ in at most `max_bits` <= 3 bits.

    All pairs but those that meet in crowded keys only; for these, pairs that connect the same ones.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the keys are complete for up to three differing bits")
    filed = prints.mapInArrow(_keyed(False), "key long, print long")
    asked = prints.mapInArrow(_keyed(True), "key long, print long")
    crowded = filed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > crowd)
    crowded = common.stored(crowded.select("key"), "crowded-keys")
    a, b = asked.withColumnRenamed("print", "a"), filed.withColumnRenamed("print", "b")
    differ = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    sparse = a.join(crowded, "key", "left_anti").join(b, "key").where(F.col("b") < F.col("a"))
    sparse = sparse.where(differ <= max_bits).select("a", "b")
    members = common.stored(asked.join(crowded, "key", "left_semi"), "crowds")
    dense = common.cells(members, "key", "print").mapInArrow(_forests(max_bits), "a long, b long")
    return sparse.union(dense).distinct()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step over edges (a, b), b < a.

    Large: the larger neighbours of each node are linked to the least of node and neighbours.
    Small: the smaller neighbours and the node itself are linked to the least of them.
    """
    if large:
        around = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).toDF("u", "v")
    else:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = around.join(least, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.toDF("a", "b"))
    return out.where(F.col("b") < F.col("a")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b): every linked node a and the least node b that it reaches, for all a that are not it."""
    edges = common.stored(edges, "edges")
    before = None
    while True:
        edges = common.stored(_star(_star(edges, True), False), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges
        before = now


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """doc_id, print (signed), component_id of every document; row and that of its representative."""
    fields = "doc_id long, print long, row long"
    found = common.keyed(docs).mapInArrow(_fingerprints(shingle), fields)
    found = common.stored(found, "prints")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row"))
    prints = found.groupBy("print").agg(least.alias("first"))
    prints = common.stored(prints, "distinct-prints")
    spread = prints.select("print").repartition(common.partitions(docs.sparkSession))
    joined = components(links(spread, max_bits))
    root = prints.join(joined.toDF("print", "root"), "print", "left")
    root = root.select("print", "first", F.coalesce("root", "print").alias("root"))
    named = root.groupBy("root").agg(F.min("first").alias("least"))
    ids = (F.col("least.doc_id").alias("component_id"), F.col("least.row").alias("component_row"))
    named = common.stored(root.join(named, "root").select("print", *ids), "components")
    return found.join(named, "print").select("doc_id", "print", "component_id", "row", "component_row")


def representatives(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """One row of each component: that of its least id, whatever other rows share the id."""
    keep = groups.where(F.col("row") == F.col("component_row"))
    keep = common.stored(keep.groupBy("row").agg(F.count("*").alias("n")), "kept-rows")
    keep = keep.withColumnRenamed("row", "claimstar_row")
    ids, twice = keep.where("n = 1").select("claimstar_row"), keep.where("n > 1").select("claimstar_row")
    rows = docs.withColumn("claimstar_row", common.row_key())
    # By shuffle at every size: the kept rows grow with the corpus, and the plan shall not change.
    once = rows.join(ids.hint("merge"), "claimstar_row", "left_semi")
    repeated = rows.join(twice, "claimstar_row", "left_semi").dropDuplicates(["claimstar_row"])
    return once.select(*docs.columns).union(repeated.select(*docs.columns))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicates(common.table(spark, sf_dir, "documents"))
    text = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return groups.select("doc_id", text, "component_id")
