"""Language-model scores by logistic context mixing over the bits of words.

A token (a word, or the end of a text) is coded in bits: eight bits of its class, a hash of its last
two letters and length, from the highest one down. For each bit, predictors that have counted what
followed in their context (none; the class before; the class two before; both, hashed) give a
logit. The logits are summed with weights of a gate, the bits already known and how much the
longest context has seen; the weights are learned online, bit by bit, over all training documents.
An adaptive last stage refines the mixed probability from what happened at like predictions. Within
its class a known word has its share of the class's training tokens; all unknown words of a class
share what one word of half a count has, as in the base score. Last, the document's own words so far
are mixed in with a weight that follows from how far the document repeats itself; it is learned over
all training documents as well. The score is a proper log10 probability over the known words and one
unknown word per class; times log2(10) it is the total of bits, given per byte as well.

The documents are stored once with the number of their part, a stretch of `PART_BYTES` of text, so
that no pass depends on how another one's scan was split. Then three passes: the first counts the
words of each part and the contexts, and merges the counts by shuffles; the second learns weights;
the third brings each part the counts of its own words and scores it. Parts do not grow with the
corpus, and tasks hold about `PARTS_PER_TASK` of them. Tables of contexts have a fixed number of
slots; words, whose number grows with the corpus, are never gathered in one place. Words are known by
a 64-bit hash.

Nulls: a null or empty text is its end alone. A null doc_id is neither held out nor learned from.
Rows of equal doc_id are texts of their own. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimstar.llm import common
from claimstar.llm.bpe import _BASE, _BASE_INVERSE, _powers

HELD_OUT = (5, 1)  # modulus and remainder of crc32(doc_id as text)
BATCH_BYTES = 4 << 20
PART_BYTES = 32 << 20
PARTS_PER_TASK = 4
MINI = 8192  # tokens per online step
RATE = 0.02
START = 256  # the class before the first token
GROUPS = 8
PREDICTORS = 4
_WIDTH = (256, 257 * 256, 257 * 256, 257 * GROUPS * 256)
_OFFSET = np.concatenate([[0], np.cumsum(_WIDTH)])
SLOTS = int(_OFFSET[-1])
GATES = 256 * 3
BUCKETS = 24
REPEATS = 256  # contexts of the document's own words
LOG10 = np.log(10)

COUNTS = "kind int, key long, zeros long, ones long"

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[str, np.ndarray] = {}


def _mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


@dataclass
class Tokens:
    """The tokens of several documents, one after the other."""

    key: np.ndarray  # 64-bit hash, signed
    cls: np.ndarray
    doc: np.ndarray  # which document
    first: np.ndarray  # its first token
    sizes: np.ndarray  # tokens per document
    n_bytes: np.ndarray


def tokens(texts: list[str | None]) -> Tokens:
    """Words cut at ASCII blanks, A-Z lower case, and one end per text."""
    raw = [(t or "").encode().lower() for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    text_end = np.cumsum(lengths + 1)
    if not _POWERS or len(_POWERS["up"]) <= len(data):
        _POWERS["up"] = _powers(_BASE, max(BATCH_BYTES + 1, len(data) + 1))
        _POWERS["down"] = _powers(_BASE_INVERSE, len(_POWERS["up"]))
    blank = _BLANK[data]
    before = np.append(True, blank[:-1])
    start = np.flatnonzero(~blank & before)
    end = np.flatnonzero(blank & ~before)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _POWERS["up"][: len(data)], out=sums[1:])
    key = _mix64((sums[end] - sums[start]) * _POWERS["down"][start])
    last, size = data[end - 1].astype(np.int64), end - start
    previous = np.where(size > 1, data[np.maximum(end - 2, 0)], 0).astype(np.int64)
    cls = (last * 31 + previous * 17 + np.minimum(size, 4) * 101) & 255
    word_doc = np.searchsorted(text_end, start, side="right")
    counts = np.bincount(word_doc, minlength=len(raw))
    sizes = counts + 1
    first = np.cumsum(sizes) - sizes
    n = int(sizes.sum())
    keys, classes = np.zeros(n, np.int64), np.zeros(n, np.int64)
    at = np.arange(len(start)) + word_doc
    keys[at], classes[at] = key.view(np.int64), cls
    ends = first + counts
    keys[ends], classes[ends] = 1, 0  # the end of a text
    doc = np.repeat(np.arange(len(raw)), sizes)
    return Tokens(keys, classes, doc, first, sizes, lengths)


def _before(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """The classes one and two before each token."""
    one = np.append(START, t.cls[:-1]) if len(t.cls) else t.cls
    two = np.append(START, one[:-1]) if len(t.cls) else t.cls
    one[t.first] = START
    two[t.first] = START
    second = t.first[t.sizes > 1] + 1
    two[second] = START
    return one, two


def _slots(one: np.ndarray, two: np.ndarray, node: np.ndarray) -> list[np.ndarray]:
    return [
        node,
        _OFFSET[1] + one * 256 + node,
        _OFFSET[2] + two * 256 + node,
        _OFFSET[3] + (one * GROUPS + two * 7 % GROUPS) * 256 + node,
    ]


def _bits(cls: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each bit from the highest down: the node (the bits before, after a one) and the bit."""
    for b in range(7, -1, -1):
        yield (1 << (7 - b)) | (cls >> (b + 1)), cls >> b & 1


def _repeats(t: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How often each token came before in its document, its place there, and the repeat context."""
    order = np.lexsort((t.key, t.doc))
    k, d = t.key[order], t.doc[order]
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
    run = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    seen = np.empty(len(order), np.int64)
    seen[order] = np.arange(len(order)) - run
    place = np.arange(len(order)) - t.first[t.doc]
    again = (seen > 0).astype(np.int64)
    total = np.cumsum(again) - again
    share = (total - total[t.first][t.doc]) / np.maximum(place, 1)
    last = np.append(0, again[:-1])
    last[t.first] = 0
    context = np.minimum(np.log2(place + 1).astype(np.int64), 7) * 32
    context += np.minimum((share * 16).astype(np.int64), 15) * 2 + last
    return seen, place, context


@dataclass
class Model:
    """What the tasks need to score: logits of contexts, weights, the last stage, repeat shares."""

    logit: np.ndarray
    level: np.ndarray  # how much a context has seen: 0, 1, 2
    weight: np.ndarray
    refined: np.ndarray
    repeat: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    n_tokens: int

    def gate(self, longest: np.ndarray, node: np.ndarray) -> np.ndarray:
        return node * 3 + self.level[longest - _OFFSET[3]]

    def class_logprob(self, t: Tokens) -> np.ndarray:
        """Natural log probability of each token's class."""
        one, two = _before(t)
        out = np.zeros(len(t.cls))
        for node, bit in _bits(t.cls):
            slots = _slots(one, two, node)
            gate = self.gate(slots[3], node)
            z = np.zeros(len(node))
            for i, s in enumerate(slots):
                z += self.weight[gate, i] * self.logit[s]
            p = 1 / (1 + np.exp(-z))
            p = 0.5 * p + 0.5 * self.refined[node, _bucket(z)]
            out += np.log(np.where(bit, p, 1 - p))
        return out

    def mixed(self, static: np.ndarray, t: Tokens) -> np.ndarray:
        """Natural log probability with the document's own words mixed in."""
        seen, place, context = _repeats(t)
        share = np.where(place > 0, self.repeat[context], 0.0)
        own = seen / np.maximum(place, 1)
        return np.log((1 - share) * np.exp(static) + share * own)


def _bucket(z: np.ndarray) -> np.ndarray:
    return np.clip(((z + 6) * (BUCKETS / 12)).astype(np.int64), 0, BUCKETS - 1)


ROWS = "part long, doc_id long, learn boolean, text string"


def _parted(part_bytes: int):
    """Documents (doc_id, learn, text) with their part: the task, and which stretch of its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        size = 0
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False)
            read = size + np.cumsum(lengths, dtype=np.int64)
            size = int(read[-1]) if len(read) else size
            part = pa.array((task << 32) + read // part_bytes, pa.int64())
            yield pa.RecordBatch.from_arrays([part, *batch.columns], [c.split()[0] for c in ROWS.split(", ")])

    return run


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, list[bool], Tokens]]:
    """Documents of `ROWS` in batches of some megabytes of text, each of one part, which comes first."""
    for batch in batches:
        parts, ids, learn = (batch.column(i).to_pylist() for i in range(3))
        low = size = 0
        texts: list = []
        for i, text in enumerate(batch.column(3)):
            texts.append(text.as_py())
            size += len(texts[-1] or "")
            if size > BATCH_BYTES // 2 or i + 1 == len(ids) or parts[i + 1] != parts[i]:
                yield parts[i], ids[low : i + 1], learn[low : i + 1], tokens(texts)
                low, size, texts = i + 1, 0, []


def _rows(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [n.split()[0] for n in names.split(", ")])


WORDS = "part long, key long, cls int, n long"


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words of each part with class and training count (0: held out only).

    A part that two tasks read, or one in two stretches, has rows of either.
    """
    keys, classes, counts = [], [], []
    held = 0

    def merged():
        k, at, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        c = np.concatenate(classes)[at]
        n = np.bincount(inverse, np.concatenate(counts), minlength=len(k)).astype(np.int64)
        return k, c, n

    def counted(part: int) -> Iterator[pa.RecordBatch]:
        k, c, n = merged()
        for low in range(0, len(k), 100_000):
            s = slice(low, low + 100_000)
            yield _rows(WORDS, np.full(len(k[s]), part, np.int64), k[s], c[s].astype(np.int32), n[s])

    before = None
    for part, _, learn, t in _batches(batches):
        if keys and part != before:
            yield from counted(before)
            keys, classes, counts, held = [], [], [], 0
        before = part
        training = np.array(learn, bool)[t.doc]
        k, at, inverse = np.unique(t.key, return_index=True, return_inverse=True)
        keys.append(k)
        classes.append(t.cls[at])
        counts.append(np.bincount(inverse, training, minlength=len(k)))
        held += len(k)
        if held > 3_000_000 and len(keys) > 8:
            k, c, n = merged()
            keys, classes, counts, held = [k], [c], [n], len(k) // 2
    if keys:
        yield from counted(before)


def _count_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Zeros and ones seen in each slot by the task's training documents."""
    zeros, ones = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
    for _, _, learn, t in _batches(batches):
        training = np.array(learn, bool)[t.doc]
        one, two = _before(t)
        one, two = one[training], two[training]
        # Each context has its zeros and ones next to each other, those of all bits in one count.
        bits = np.stack([node * 2 + bit for node, bit in _bits(t.cls[training])])
        for base, low, width in zip(_slots(one, two, 0), _OFFSET.tolist(), _WIDTH):
            counts = np.bincount((bits + (base - low) * 2).ravel(), minlength=2 * width)
            zeros[low : low + width] += counts[::2]
            ones[low : low + width] += counts[1::2]
    used = np.flatnonzero(zeros + ones)
    if len(used):
        yield _rows(COUNTS, np.zeros(len(used), np.int32), used, zeros[used], ones[used])


LEARNED = "kind int, key long, a double, b double"


def _learn(model: Model):
    """Online weights (kind 0: sum and documents), last-stage counts (1) and repeat shares (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.full((GATES, PREDICTORS), 1 / PREDICTORS)
        steps = np.zeros(GATES)
        hits, tries = np.zeros(256 * BUCKETS), np.zeros(256 * BUCKETS)
        taken, offered = np.zeros(REPEATS), np.zeros(REPEATS)
        for _, _, learn, t in _batches(batches):
            training = np.array(learn, bool)[t.doc]
            one, two = _before(t)
            static = np.zeros(len(t.cls))
            for low in range(0, len(t.cls), MINI):
                on = np.arange(low, min(low + MINI, len(t.cls)))
                on = on[training[on]]
                for node, bit in _bits(t.cls[on]):
                    slots = _slots(one[on], two[on], node)
                    gate = model.gate(slots[3], node)
                    x = [model.logit[s] for s in slots]
                    z = sum(weight[gate, i] * x[i] for i in range(PREDICTORS))
                    p = 1 / (1 + np.exp(-z))
                    static[on] += np.log(np.where(bit, p, 1 - p))
                    cell = node * BUCKETS + _bucket(z)
                    hits += np.bincount(cell, bit, minlength=len(hits))
                    tries += np.bincount(cell, minlength=len(tries))
                    n = np.bincount(gate, minlength=GATES)
                    scale = RATE / np.sqrt(np.maximum(n, 1))
                    for i in range(PREDICTORS):
                        weight[:, i] += scale * np.bincount(gate, (bit - p) * x[i], minlength=GATES)
                    steps += n
            # The document's own words against a share of the class by this batch's counts.
            _, inverse, count = np.unique(t.key, return_inverse=True, return_counts=True)
            in_class = np.bincount(t.cls, minlength=256)
            within = count[inverse] / in_class[t.cls]
            seen, place, context = _repeats(t)
            own = seen / np.maximum(place, 1)
            may = training & (place > 0)
            other = np.exp(static) * within
            took = 0.3 * own / (0.3 * own + 0.7 * other + 1e-12)
            taken += np.bincount(context[may], took[may], minlength=REPEATS)
            offered += np.bincount(context[may], minlength=REPEATS)
        keys = np.arange(GATES * PREDICTORS)
        used = np.repeat(steps, PREDICTORS)
        yield _rows(LEARNED, np.zeros(len(keys), np.int32), keys, weight.ravel() * used, used)
        keys = np.flatnonzero(tries)
        yield _rows(LEARNED, np.ones(len(keys), np.int32), keys, hits[keys], tries[keys])
        keys = np.arange(REPEATS)
        yield _rows(LEARNED, np.full(REPEATS, 2, np.int32), keys, taken, offered)

    return run


def _model(slots: list, vocabulary: list) -> Model:
    """From the merged counts: at most SLOTS rows, and 256 of words by class."""
    zeros, ones = np.zeros(SLOTS), np.zeros(SLOTS)
    for r in slots:
        zeros[r[0]], ones[r[0]] = r[1], r[2]
    seen = (zeros + ones)[_OFFSET[3] :]
    class_tokens = np.zeros(256)
    for cls in range(256):  # the last node of the first predictor counts whole classes
        node = 128 | cls >> 1
        class_tokens[cls] = (ones if cls & 1 else zeros)[node]
    class_words = np.zeros(256)
    for cls, n in vocabulary:
        class_words[cls] = n
    return Model(
        logit=np.log((ones + 0.4) / (zeros + 0.4)),
        level=(seen >= 4).astype(np.int64) + (seen >= 64),
        weight=np.full((GATES, PREDICTORS), 1 / PREDICTORS),
        refined=np.tile(1 / (1 + np.exp(6 - 12 * (np.arange(BUCKETS) + 0.5) / BUCKETS)), (256, 1)),
        repeat=np.full(REPEATS, 0.1),
        class_tokens=class_tokens,
        class_words=class_words,
        n_tokens=int(class_tokens.sum()),
    )


def _refine(model: Model, learned: list) -> None:
    for kind, key, a, b in learned:
        if kind == 0 and b > 0:
            model.weight[divmod(key, PREDICTORS)] = a / b
        elif kind == 1:
            node, bucket = divmod(key, BUCKETS)
            model.refined[node, bucket] = (a + 20 * model.refined[node, bucket]) / (b + 20)
        elif kind == 2:
            model.repeat[key] = (a + 1) / (b + 10)
    model.repeat = np.minimum(model.repeat, 0.95)


RESULT = (
    "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double,"
    " score double, bits_per_byte double"
)


def _score(model: Model):
    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        key = words.column("key").to_numpy()
        count = words.column("n").to_numpy()
        order = np.argsort(key)
        key, count = key[order], count[order]
        vocabulary = model.class_words.sum()
        whole = np.log(model.n_tokens + 0.5 * (vocabulary + 1))
        in_class = np.log(model.class_tokens + 0.5 * (model.class_words + 1))
        out = []
        wanted = docs.select([c.split()[0] for c in ROWS.split(", ")]).to_batches()
        for _, ids, _, t in _batches(iter(wanted)):
            at = np.searchsorted(key, t.key)
            if (at >= len(key)).any() or (key[at] != t.key).any():
                raise RuntimeError("the words of this part were counted elsewhere")
            c = count[at]
            n = len(ids)
            base = np.bincount(t.doc, np.log(c + 0.5) - whole, minlength=n) / LOG10
            static = model.class_logprob(t) + np.log(c + 0.5) - in_class[t.cls]
            score = np.bincount(t.doc, model.mixed(static, t), minlength=n) / LOG10
            known = np.bincount(t.doc, c > 0, minlength=n).astype(np.int64)
            bits = -score * np.log2(10) / np.maximum(t.n_bytes, 1)
            total = np.full(n, model.n_tokens)
            out.append(_rows(RESULT, pa.array(ids, pa.int64()), t.sizes, known, total, base, score, bits))
        kinds = {"long": pa.int64(), "double": pa.float64()}
        schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in RESULT.split(", ")])
        return pa.Table.from_batches(out, schema)

    return run


def scores(docs: DataFrame, modulus: int, remainder: int, part_bytes: int = PART_BYTES) -> DataFrame:
    """Scores of all documents by a model of those outside the held-out bucket."""
    learn = F.coalesce(common.bucket("doc_id", modulus) != remainder, F.lit(False)).alias("learn")
    plain = common.texts(docs).select("doc_id", learn, "text")
    rows = common.stored(plain.mapInArrow(_parted(part_bytes), ROWS), "parts")

    same = Window.partitionBy("key")
    total = (F.sum("n").over(same).alias("n"), F.count("*").over(same).alias("copies"))
    words = common.stored(rows.mapInArrow(_count_words, WORDS).select("part", "key", "cls", *total), "words")
    # All copies of a word have its class and their number, so these divide without a rest.
    vocabulary = words.where("n > 0").groupBy("cls", "copies").agg(F.count("*").alias("rows"))
    vocabulary = vocabulary.groupBy("cls").agg(F.expr("sum(rows div copies)").alias("n")).collect()
    slots = rows.mapInArrow(_count_contexts, COUNTS).groupBy("key")
    slots = slots.agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))
    model = _model(slots.collect(), vocabulary)
    learned = rows.mapInArrow(_learn(model), LEARNED).groupBy("kind", "key")
    _refine(model, learned.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect())

    parts = rows.select("part").distinct().count()
    tasks = max(common.partitions(docs.sparkSession), parts // PARTS_PER_TASK)
    texts = rows.repartition(tasks, "part").groupBy("part")
    own = words.select("part", "key", "n").repartition(tasks, "part").groupBy("part")
    return texts.cogroup(own).applyInArrow(_score(model), RESULT)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    modulus, remainder = HELD_OUT
    found = scores(common.table(spark, sf_dir, "documents"), modulus, remainder)
    held_out = (common.bucket("doc_id", modulus) == remainder).alias("held_out")
    columns = ("n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
    return found.select("doc_id", held_out, *columns)
