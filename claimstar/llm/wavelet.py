"""Token ids in wavelet-matrix shards: bit-planes with rank directories, written and read by Spark.

A shard file is Parquet with one row per block of about `BLOCK` ids. A block holds whole documents,
is one self-contained wavelet matrix, and carries its place in the corpus, so access, counting and
occurrence lookup need that row only. Spark's writer commits the files, so a lost executor costs a
task and no half-written shard is ever read.

Nulls: a null text is an empty one (its ids are the end id alone); a null doc_id comes first. Equal
doc_ids keep all their rows, ordered by a hash of the text. An empty table gives empty results.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimstar.llm import bpe, common

BLOCK = 1 << 18
SUPER = 512  # bits per entry of the rank directory
_MAGIC = b"WMX1"
_HEAD = struct.Struct("<4sIII")
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)

SHARD_SCHEMA = "part int, block int, before long, n_tokens long, docs binary, planes binary"


class WaveletMatrix:
    """Ids as bit-planes from the highest bit down; each plane is ordered by the bits above it."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ranks: list) -> None:
        self.n, self.planes, self.zeros, self.ranks = n, planes, zeros, ranks

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        width = max(1, int(ids.max(initial=0)).bit_length())
        level = ids.astype(np.uint16 if width <= 16 else np.uint32)
        planes, zeros, ranks = [], [], []
        for k in range(width - 1, -1, -1):
            bits = (level >> level.dtype.type(k)) & level.dtype.type(1)
            one = bits.astype(bool)
            planes.append(np.packbits(one))
            ranks.append(cls._directory(planes[-1]))
            low = level[~one]
            zeros.append(len(low))
            level = np.concatenate([low, level[one]])
        return cls(len(ids), planes, zeros, ranks)

    @staticmethod
    def _directory(plane: np.ndarray) -> np.ndarray:
        ones = _ONES[plane].astype(np.uint32)
        step = SUPER // 8
        sums = np.add.reduceat(ones, np.arange(0, len(ones), step)) if len(ones) else ones
        return np.concatenate([[0], np.cumsum(sums)]).astype(np.uint32)

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        block = i // SUPER
        at = block * (SUPER // 8)
        whole = self.planes[level][at : i // 8]
        ones = int(self.ranks[level][block]) + int(_ONES[whole].sum())
        if i % 8:
            ones += bin(int(self.planes[level][i // 8]) >> (8 - i % 8)).count("1")
        return ones

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i // 8]) >> (7 - i % 8) & 1

    def access(self, i: int) -> int:
        """The id at place i."""
        value = 0
        for level in range(len(self.planes)):
            bit = self._bit(level, i)
            ones = self._rank1(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, i: int) -> tuple[int, int]:
        """Where, on the last level, the token's occurrences among the first i ids lie."""
        low, width = 0, len(self.planes)
        if token >> width:
            return 0, 0
        for level in range(width):
            a, b = self._rank1(level, low), self._rank1(level, i)
            if token >> (width - 1 - level) & 1:
                low, i = self.zeros[level] + a, self.zeros[level] + b
            else:
                low, i = low - a, i - b
        return low, i

    def rank(self, token: int, i: int) -> int:
        """Occurrences of the token among the first i ids."""
        low, high = self._range(token, i)
        return high - low

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def occurrences(self, token: int) -> np.ndarray:
        """All places of the token, ascending: select on each plane, from the last one up."""
        low, high = self._range(token, self.n)
        places = np.arange(low, high)
        for level in range(len(self.planes) - 1, -1, -1):
            one = np.unpackbits(self.planes[level], count=self.n).astype(bool)
            order = np.concatenate([np.flatnonzero(~one), np.flatnonzero(one)])
            places = order[places]
        return np.sort(places)

    def decode(self) -> np.ndarray:
        """All ids: each level is merged back by its plane."""
        width = len(self.planes)
        value = np.zeros(self.n, np.uint16 if width <= 16 else np.uint32)
        for level in range(width - 1, -1, -1):
            one = np.unpackbits(self.planes[level], count=self.n).astype(bool)
            above = np.empty_like(value)
            above[~one] = value[: self.zeros[level]]
            above[one] = value[self.zeros[level] :] | value.dtype.type(1 << (width - 1 - level))
            value = above
        return value.astype(np.uint32)

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(_MAGIC, self.n, len(self.planes), SUPER)
        parts = [head, np.array(self.zeros, "<u4").tobytes()]
        for plane, ranks in zip(self.planes, self.ranks):
            parts += [ranks.astype("<u4").tobytes(), plane.tobytes()]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        magic, n, width, step = _HEAD.unpack_from(data)
        if magic != _MAGIC or step != SUPER:
            raise ValueError("not a wavelet matrix of this format")
        at = _HEAD.size
        zeros = np.frombuffer(data, "<u4", width, at).tolist()
        at += 4 * width
        size, entries = (n + 7) // 8, -(-((n + 7) // 8) // (SUPER // 8)) + 1
        planes, ranks = [], []
        for _ in range(width):
            ranks.append(np.frombuffer(data, "<u4", entries, at))
            at += 4 * entries
            planes.append(np.frombuffer(data, np.uint8, size, at))
            at += size
        return cls(n, planes, zeros, ranks)


def _pack_docs(doc_ids: list, sizes: list[int]) -> bytes:
    null = np.array([d is None for d in doc_ids], bool)
    ids = np.array([d or 0 for d in doc_ids], "<i8")
    size = np.array(sizes, "<u4")
    return struct.pack("<I", len(ids)) + ids.tobytes() + size.tobytes() + null.tobytes()


def _unpack_docs(data: bytes) -> tuple[list, np.ndarray]:
    (n,) = struct.unpack_from("<I", data)
    ids = np.frombuffer(data, "<i8", n, 4).tolist()
    sizes = np.frombuffer(data, "<u4", n, 4 + 8 * n).astype(np.int64)
    null = np.frombuffer(data, bool, n, 4 + 12 * n)
    return [None if no else i for i, no in zip(ids, null)], sizes


def _blocks(path: str, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder(path)
        part = TaskContext.get().partitionId()
        number = before = size = 0
        docs: list = []
        held: list[np.ndarray] = []

        def row() -> pa.RecordBatch:
            packed = _pack_docs(docs, [len(x) for x in held])
            planes = WaveletMatrix.build(np.concatenate(held)).to_bytes()
            columns = [[part], [number], [before], [size], [packed], [planes]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            names = ["part", "block", "before", "n_tokens", "docs", "planes"]
            return pa.RecordBatch.from_arrays([pa.array(*c) for c in zip(columns, types)], names)

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for doc_id, tokens in zip(ids, encoder.encode_many(batch.column(1).to_pylist())):
                if held and size + len(tokens) > block:
                    yield row()
                    number, before, size, docs, held = number + 1, before + size, 0, [], []
                docs.append(doc_id)
                held.append(tokens)
                size += len(tokens)
        if held:
            yield row()

    return run


def write(
    docs: DataFrame, folder: str, tokenizer: str, shards: int, block: int = BLOCK
) -> None:
    """Encode all documents in ascending doc_id order into `shards` shard files."""
    ordered = (
        common.texts(docs)
        .repartitionByRange(shards, "doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    ordered.mapInArrow(_blocks(tokenizer, block), SHARD_SCHEMA).write.parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SHARD_SCHEMA).parquet(folder)


def _starts(shards: DataFrame) -> dict[int, int]:
    """Ids before each shard; one row per shard file comes to the driver, as many as partitions."""
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    starts, at = {}, 0
    for row in totals:
        starts[row["part"]] = at
        at += row["n"]
    return starts


def documents(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the shard files alone."""
    starts = _starts(shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, before, docs, planes in zip(*(c.to_pylist() for c in batch.columns)):
                ids = WaveletMatrix.from_bytes(planes).decode().astype("<u4")
                names, sizes = _unpack_docs(docs)
                ends = np.cumsum(sizes)
                begins = ends - sizes
                crc = [bpe.ids_crc32(ids[a:b]) for a, b in zip(begins.tolist(), ends.tolist())]
                columns = [
                    pa.array(names, pa.int64()),
                    pa.array(begins + before + starts[part]),
                    pa.array(sizes),
                    pa.array(crc, pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return shards.select("part", "before", "docs", "planes").mapInArrow(run, schema)


def occurrences(shards: DataFrame, token: int) -> DataFrame:
    """Every place of a token, counted from the start of the corpus, by select on the planes."""
    starts = _starts(shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, before, planes in zip(*(c.to_pylist() for c in batch.columns)):
                places = WaveletMatrix.from_bytes(planes).occurrences(token)
                places = places.astype(np.int64) + before + starts[part]
                yield pa.RecordBatch.from_arrays([pa.array(places)], ["place"])

    return shards.select("part", "before", "planes").mapInArrow(run, "place long")


def op5_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{common.shared_dir(spark)}/wavelet-{uuid.uuid4().hex}"
    docs = common.table(spark, sf_dir, "documents")
    write(docs, folder, bpe.vocabulary(), common.partitions(spark))
    return documents(read(spark, folder))
