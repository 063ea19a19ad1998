"""Document fingerprints by randomised edit embedding (CGK).

All texts walk by the same random bits: at step j a text shows its current character and moves on if
bit (j, character) is set, so that few edits change few steps and edit distance becomes Hamming
distance. The fingerprint samples the walk: `SAMPLES` steps of each doubling [2^s, 2^(s+1)), shared
by all texts, each kept as one hex digit (a hash of step and character), '-' once the text has
ended. Trailing '-' are dropped, so equal texts have equal fingerprints whatever their length, and
texts of any length can be compared.

`likeness` weighs each doubling by the steps it stands for. `near_classes` bands the distinct
fingerprints: a band is `BAND_DIGITS` digits sampled from a doubling and the one before, the same for
all texts, and a fingerprint has `BANDS` of them for each of its last two full doublings, which hold
most of the weight. Fingerprints below `EXACT` digits also have their last doubling in three runs: near
ones differ in at most two digits there, so these miss none. Fingerprints that share a band are dealt
to cells (common.cells) in which any two of a band meet, and verified by their likeness; a cell gives a
spanning forest of its links, so every link within a band counts, and no group is written out as pairs.

Nulls: a null text is an empty one, with the empty fingerprint. A null doc_id comes first, equal
doc_ids are ordered by a hash of their texts; the last document's next is the least non-null id. A
single document follows itself. A class without an id has a null class_id. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimstar.llm import common, simhash

SAMPLES = 16
DOUBLINGS = 40
PERIOD = 4093
CHANCE = 0.125  # of equal digits between unrelated texts
CHUNK_CHARS = 12_000_000
BAND_DIGITS = 8
BANDS = 10  # for each of two doublings
NEAR = 0.8  # least likeness of near fingerprints
EXACT = 3 * SAMPLES
_RUNS = ((0, 5), (5, 10), (10, SAMPLES))
_DIGITS = np.frombuffer(b"0123456789abcdef-", np.uint8)
_ABSENT = 16

RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double"
)


@cache
def _walk_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Moves by (step, symbol), digits by (sample, symbol), sampled steps, and each one's doubling."""
    random = np.random.default_rng(61)
    moves = random.integers(0, 2, (PERIOD, 256), np.uint8)
    moves[:, 0] = 0  # the end of a text
    steps, doubling = list(range(SAMPLES)), [0] * SAMPLES
    for s in range(int(np.log2(SAMPLES)), DOUBLINGS):
        low = 1 << s
        width = low // SAMPLES  # one step of each sixteenth, so that steps differ and are in order
        steps += [low + i * width + int(random.integers(0, width)) for i in range(SAMPLES)]
        doubling += [s] * SAMPLES
    digits = random.integers(0, 16, (len(steps), 256), np.uint8)
    digits[:, 0] = _ABSENT
    return moves, digits, np.array(steps, np.int64), np.array(doubling)


def _symbols(text: str) -> np.ndarray:
    """A symbol of 1 to 255 for each code point."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    return (points * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(255) + np.uint64(1)


def embed(texts: list[str]) -> np.ndarray:
    """The sampled digits of each text (rows), 16 where the text has ended."""
    moves, digits, steps, _ = _walk_tables()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = np.zeros(int(sizes.sum()) + len(texts), np.uint8)
    starts = np.cumsum(sizes + 1) - sizes - 1
    for text, start in zip(texts, starts.tolist()):
        flat[start : start + len(text)] = _symbols(text)
    reached = int(np.searchsorted(steps, 3 * int(sizes.max(initial=0))))
    out = np.full((len(texts), reached), _ABSENT, np.uint8)
    row = np.flatnonzero(sizes)
    at = starts[row].copy()
    sample = 0
    for step in range(3 * int(sizes.max(initial=0))):
        if not len(row) or sample == reached:
            break
        symbol = flat[at]
        if step == steps[sample]:
            out[row, sample] = digits[sample][symbol]
            sample += 1
        at += moves[step % PERIOD][symbol]
        if step % 64 == 63:
            on = flat[at] != 0
            if not on.all():
                row, at = row[on], at[on]
    return out


def as_text(digits: np.ndarray) -> str:
    return _DIGITS[digits].tobytes().decode().rstrip("-")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal steps, each doubling weighed by its length, less what chance gives; 0 to 1."""
    width = max(len(a), len(b))
    a, b = (np.append(x, np.full(width - len(x), _ABSENT, np.uint8)) for x in (a, b))
    there = (a != _ABSENT) | (b != _ABSENT)
    if not there.any():
        return 1.0
    _, _, _, doubling = _walk_tables()
    weight = np.exp2(doubling[:width].astype(float)) * there
    equal = float((weight * (a == b)).sum() / weight.sum())
    return max(0.0, (equal - CHANCE) / (1 - CHANCE))


def parse(fingerprint: str) -> np.ndarray:
    """The digits of a fingerprint."""
    if not fingerprint:
        return np.empty(0, np.uint8)
    return np.array([_ABSENT if c == "-" else int(c, 16) for c in fingerprint], np.uint8)


def edited(text: str, following: str) -> str:
    """The text, its last quarter replaced by as many code points (or all) of the next one's start."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column, a text, as a Zstandard frame of its UTF-8 bytes."""
    compressor = zstandard.ZstdCompressor()
    for batch in batches:
        frames = [compressor.compress((t.as_py() or "").encode()) for t in batch.columns[-1]]
        columns = [*batch.columns[:-1], pa.array(frames, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    decompressor = zstandard.ZstdDecompressor()
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(3)]
        yield from zip(*columns, (decompressor.decompress(t.as_py()).decode() for t in batch.column(4)))


def _compared(rows: list[tuple]) -> pa.RecordBatch:
    """Rows (part, tail, doc_id, text) in order; each but the tails is followed by its next one."""
    pairs = [(a, b) for a, b in zip(rows, rows[1:]) if not a[1] and a[0] == b[0]]
    texts = [r[3] for r in rows]
    place = [i for i, (a, b) in enumerate(zip(rows, rows[1:])) if not a[1] and a[0] == b[0]]
    after = [edited(a[3], b[3]) for a, b in pairs]
    digits = embed(texts + after)
    own, changed = digits[: len(texts)], digits[len(texts) :]
    columns = [
        pa.array([a[2] for a, _ in pairs], pa.int64()),
        pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in after], pa.string()),
        pa.array([as_text(own[i]) for i in place], pa.string()),
        pa.array([as_text(d) for d in changed], pa.string()),
        pa.array([likeness(own[i], d) for i, d in zip(place, changed)], pa.float64()),
        pa.array([likeness(own[i], own[i + 1]) for i in place], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in RESULT.split(", ")])


def _fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for row in _rows(batches):
        held.append(row)
        size += len(row[3])
        if size > CHUNK_CHARS:
            yield _compared(held)
            held, size = [row], len(row[3])
    if len(held) > 1:
        yield _compared(held)


def with_next(docs: DataFrame) -> DataFrame:
    """(part, tail, doc_id, hash, text), sorted in each task; each part ends with the next one's first row.

    Texts are compressed before they move. Parts are ranges of doc_id between approximate quantiles, several to a task. Only the bounds and
    each part's least id pass the driver, as many as there are parts; texts are shuffled once.
    """
    spark = docs.sparkSession
    tasks = common.partitions(spark)
    plain = common.texts(docs)
    parts = 3 * tasks
    shares = [i / parts for i in range(1, parts)]
    bounds = sorted(set(plain.select("doc_id").approxQuantile("doc_id", shares, 0.25 / parts) or []))
    literal = F.array(*[F.lit(int(b)) for b in bounds]).cast("array<bigint>")
    part = F.size(F.filter(literal, lambda b: b <= F.col("doc_id"))).alias("part")
    ranged = plain.select(part, F.lit(False).alias("tail"), "doc_id", "text")
    least = ranged.groupBy("part").agg(F.min("doc_id").alias("first")).orderBy("part").collect()
    least = [r for r in least if r["first"] is not None]
    before = [(b["first"], a["part"]) for a, b in zip(least, least[1:] + least[:1])]
    if not before:  # no row, or none with an id
        before = [(None, 0)]
    firsts = spark.createDataFrame(before, "first long, part int")
    tails = plain.join(F.broadcast(firsts), F.col("doc_id").eqNullSafe(F.col("first")))
    tails = tails.select("part", F.lit(True).alias("tail"), "doc_id", "text")
    both = ranged.union(tails).select("part", "tail", "doc_id", F.xxhash64("text").alias("hash"), "text")
    packed = both.mapInArrow(_compressed, "part int, tail boolean, doc_id long, hash long, text binary")
    return packed.repartition(tasks, "part").sortWithinPartitions("part", "tail", "doc_id", "hash")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and the likeness to it and the next."""
    return with_next(docs).mapInArrow(_fingerprinted, RESULT)


@cache
def _bands() -> np.ndarray:
    """For each band of two doublings, the places of its digits from the start of the earlier one."""
    random = np.random.default_rng(67)
    return np.array(
        [np.sort(random.choice(2 * SAMPLES, BAND_DIGITS, replace=False)) for _ in range(BANDS)]
    )


def band_texts(fingerprint: str) -> list[str]:
    """The bands of a fingerprint: doubling, band or run, and digits."""
    size = len(fingerprint)
    full, found = size // SAMPLES, []
    for end in range(max(full - 1, 2), full + 1):
        window = fingerprint[(end - 2) * SAMPLES : end * SAMPLES]
        for k, places in enumerate(_bands().tolist()):
            found.append(f"{end}/{k}/" + "".join([window[i] for i in places]))
    if size < EXACT:
        # 33 digits or more are near fewer only with one digit beyond: both have the second doubling.
        doubling = 0 if size <= SAMPLES else 1
        last = fingerprint[doubling * SAMPLES : (doubling + 1) * SAMPLES].ljust(SAMPLES, "-")
        found += [f"{doubling}:{a}:{last[a:b]}" for a, b in _RUNS]
    return found


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints, bands = [], []
        for print_id, text in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
            found = band_texts(text)
            prints += [print_id] * len(found)
            bands += [xxhash.xxh64_intdigest(b) for b in found]
        columns = [pa.array(np.array(bands, np.uint64).view(np.int64)), pa.array(prints, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["band", "print"])


def likeness_to(own: np.ndarray, others: np.ndarray) -> np.ndarray:
    """`likeness` of one row of digits, 16 beyond its end, to each of the others."""
    _, _, _, doubling = _walk_tables()
    there = (others != _ABSENT) | (own != _ABSENT)
    weight = np.exp2(doubling[: len(own)].astype(float))
    whole = there @ weight
    equal = (there & (others == own)) @ weight
    share = np.divide(equal, whole, out=np.ones(len(others)), where=whole > 0)
    return np.maximum(0.0, (share - CHANCE) / (1 - CHANCE))


def _verified(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in common.whole_cells(batches):
            prints, first = np.unique(cell.column("print").to_numpy(), return_index=True)
            texts = cell.column("fingerprint").take(pa.array(first)).to_pylist()
            width = max(map(len, texts))
            digits = np.full((len(texts), width), _ABSENT, np.uint8)
            for row, text in zip(digits, texts):
                row[: len(text)] = parse(text)
            edges = common.forest(
                len(texts), lambda i, rest: likeness_to(digits[i], digits[rest]) >= least
            )
            pairs = np.sort(prints[np.array(edges, np.int64).reshape(-1, 2)], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 1]), pa.array(pairs[:, 0])], ["a", "b"])

    return run


def near_links(prints: DataFrame, least: float = NEAR, block: int = common.CELL) -> DataFrame:
    """(a, b), b < a, over distinct (print, fingerprint): verified links that connect all near ones of a band."""
    banded = prints.select("print", "fingerprint").mapInArrow(_banded, "band long, print long")
    dealt = common.stored(common.cells(banded, "band", "print", block), "bands")
    whole = dealt.join(prints.select("print", "fingerprint"), "print")
    order = ["cell_key", "low", "high"]
    sorted_cells = whole.repartition(common.partitions(prints.sparkSession), *order).sortWithinPartitions(*order)
    return sorted_cells.mapInArrow(_verified(least), "a long, b long").distinct()


def _packed(column: str) -> Column:
    """Hex digits as bytes, with a first digit that tells whether their number is even."""
    odd = F.length(column) % 2 == 1
    return F.unhex(F.concat(F.when(odd, "1").otherwise("00"), F.col(column)))


def _unpacked(column: str) -> Column:
    digits = F.lower(F.hex(column))
    skipped = F.when(digits.startswith("1"), 2).otherwise(3)
    return F.substring(digits, skipped, F.length(digits))


def near_classes(found: DataFrame, least: float = NEAR) -> DataFrame:
    """The rows of `fingerprints` and class_id, the least doc_id reached over near fingerprints.

    Digits are bytes while rows are stored and moved: half the size.
    """
    texts = ("edited_sha256", "fingerprint", "edited_fingerprint")
    rows = common.stored(found.withColumns({c: _packed(c) for c in texts}), "walks")
    distinct = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    # Numbers instead of hashes, so that no two fingerprints share one; stored once, so they stay.
    prints = common.stored(distinct.withColumn("print", F.monotonically_increasing_id()), "fingerprints")
    plain = prints.select("print", _unpacked("fingerprint").alias("fingerprint"))
    joined = simhash.components(near_links(plain, least)).toDF("print", "root")
    root = prints.join(joined, "print", "left").withColumn("root", F.coalesce("root", "print"))
    named = root.groupBy("root").agg(F.min("first").alias("class_id"))
    classes = common.stored(root.join(named, "root").select("fingerprint", "class_id"), "classes")
    classed = rows.join(classes, "fingerprint").withColumns({c: _unpacked(c) for c in texts})
    return classed.select(*found.columns, "class_id")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(fingerprints(common.table(spark, sf_dir, "documents")))
