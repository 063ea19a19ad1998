"""Conversations as one string and its token ids, with a loss mask on the assistant's texts.

Offset-aligned masks. A conversation is rendered whole: every turn is `<|im_start|>` role
`<|im_sep|>` text `<|im_end|>`, and the spans of the texts are noted. The string is encoded once, with
the characters that each token covers; the tokens of a text are those between the places of its span
among the tokens' ends and begins, found by binary search. The three marks are tokens of their own,
so no token lies across the edge of a text, and the mask covers each text exactly. What lies between
marks is encoded by `bpe`; a byte-level token stands for a fixed number of bytes, which gives the
offsets of all tokens by sums. Ids and offsets are those that the library gives for the whole string.

Control strings inside roles and texts, these marks and those of other templates (`CONTROLS`), get
one more backslash after their first character, whatever number they have; taking one away gives the
text back. No text can so open or close a turn, and every string stays what it was.

Rows are shuffled once, by conversation, and rendered in order as they come, so a task holds one
conversation. One of more than `PIECE_TURNS` turns or `PIECE_CHARS` characters could fill a task: such
conversations are sorted by range instead, over many tasks, and come in pieces of whole turns,
numbered in order (part, piece); tokens are the same, as marks part them. Only `read` brings the
pieces of a conversation together again, for its digests, and holds one piece at a time.

Nulls: a null text or role is an empty one; rows with a null conv_id are one conversation. Rows of
one turn are ordered by role and text, nulls first, and all stay, repeated rows too; a null turn comes
first. An empty table gives an empty result. Columns beyond the four stay behind.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimstar.llm import bpe, common

BEGIN, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
MARKS = (BEGIN, SEP, END)
# What the marks of this and other templates look like.
CONTROLS = (*MARKS, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LOSS_ROLES = ("assistant",)
PIECE_TURNS = 4096
PIECE_CHARS = 1 << 24
BATCH_CHARS = 1 << 20  # encoded together
SMALL = 10_000  # long conversations whose ids are broadcast, as counted

FORMATTED = (
    "conv_id long, part int, piece int, n_turns int, formatted string, token_ids array<int>,"
    " token_begins array<int>, token_ends array<int>, loss_mask array<boolean>"
)
READ = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
    " formatted_chars long"
)

Turns = list[tuple[str, str]]

_TAILS = {c: "|".join(re.escape(x[1:]) for x in CONTROLS if x[0] == c) for c in "<["}
_ESCAPE = re.compile("|".join(rf"(?<={re.escape(c)})\\*(?={tails})" for c, tails in _TAILS.items()))
_ESCAPED = re.compile(
    "|".join(rf"(?<={re.escape(c)})\\+(?={tails})" for c, tails in _TAILS.items())
)
_TURN = re.compile(f"{re.escape(BEGIN)}(.*?){re.escape(SEP)}(.*?){re.escape(END)}", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][1:], text)


def render(turns: Turns, roles: tuple[str, ...]) -> tuple[str, list[tuple[int, int]]]:
    """The string of (role, text) turns, and the spans of the texts of the given roles."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{BEGIN}{escape(role)}{SEP}", escape(text)
        begin = at + len(head)
        at = begin + len(body) + len(END)
        parts += [head, body, END]
        if role in roles:
            spans.append((begin, begin + len(body)))
    return "".join(parts), spans


def loss_mask(begins: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens meet a span; tokens and spans ascend."""
    span = np.array(spans, np.int64).reshape(-1, 2)
    first = np.searchsorted(ends, span[:, 0], side="right")
    last = np.maximum(np.searchsorted(begins, span[:, 1], side="left"), first)
    change = np.zeros(len(begins) + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, last, -1)
    return np.cumsum(change[:-1]) > 0


class Encoder:
    """Ids and offsets of rendered strings; the marks are tokens after those of the vocabulary."""

    def __init__(self, path: str) -> None:
        self.pieces = bpe.encoder(path)
        vocabulary = self.pieces.tokenizer.get_vocab()
        self.marks = [len(vocabulary) + n for n in range(len(MARKS))]
        self.sizes = np.zeros(len(vocabulary) + len(MARKS), np.int64)  # bytes of each token
        for token, number in vocabulary.items():
            self.sizes[number] = len(token)  # a byte-level token has a letter per byte
        self.sizes[self.marks] = [len(mark) for mark in MARKS]

    def encode_many(self, talks: list[tuple[str, Turns]]) -> Iterator[tuple[np.ndarray, ...]]:
        """Ids, begins and ends of the tokens of rendered strings, given with their turns."""
        parts = (escape(x) for _, turns in talks for turn in turns for x in turn)
        ids = self.pieces.encode_many(parts)  # each with an end id, in whose place a mark goes
        begin, sep, end = self.marks
        for text, turns in talks:
            found = [np.empty(0, np.int64)]
            for _ in turns:
                role, said = next(ids).astype(np.int64), next(ids).astype(np.int64)
                role[-1], said[-1] = sep, end
                found += [np.array([begin]), role, said]
            tokens = np.concatenate(found)
            yield tokens.astype(np.int32), *self._places(text, tokens)

    def _places(self, text: str, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character and end of each token; a character of several tokens is in all of them."""
        raw = np.frombuffer(text.encode(), np.uint8)
        ends = np.cumsum(self.sizes[tokens])
        if len(raw) != (ends[-1] if len(ends) else 0):
            raise ValueError("the tokens do not cover the text")
        character = np.cumsum((raw & 0xC0) != 0x80) - 1  # of each byte
        begins = character[ends - self.sizes[tokens]]
        return begins.astype(np.int32), (character[ends - 1] + 1).astype(np.int32)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(arrays), kind))


def _renderer(path: str, roles: tuple[str, ...], piece_turns: int, piece_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_many = encoder(path).encode_many
        part = TaskContext.get().partitionId()
        held: list[tuple] = []  # conv_id, number of the piece, turns

        def rows() -> pa.RecordBatch:
            rendered = [render(turns, roles) for *_, turns in held]
            talks = [(text, turns) for (text, _), (*_, turns) in zip(rendered, held)]
            ids, begins, ends = zip(*encode_many(talks))
            masks = [loss_mask(a, b, spans) for a, b, (_, spans) in zip(begins, ends, rendered)]
            arrays = [
                pa.array([conv_id for conv_id, _, _ in held], pa.int64()),
                pa.array([part] * len(held), pa.int32()),
                pa.array([number for _, number, _ in held], pa.int32()),
                pa.array([len(turns) for *_, turns in held], pa.int32()),
                pa.array([text for text, _ in rendered], pa.string()),
                *(_lists(x, pa.int32()) for x in (ids, begins, ends)),
                _lists(masks, pa.bool_()),
            ]
            names = [f.split()[0] for f in FORMATTED.split(", ")]
            held.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        current: object = run  # no conversation yet
        number = size = chars = 0
        turns: Turns = []
        for batch in batches:
            for conv_id, role, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                role, text = role or "", text or ""
                fresh = conv_id != current or current is run
                full = len(turns) >= piece_turns or size > piece_chars
                if turns and (fresh or full):
                    held.append((current, number, turns))
                    chars += size
                    turns, size, number = [], 0, number + 1
                    if chars > BATCH_CHARS:
                        yield rows()
                        chars = 0
                if fresh:
                    current, number = conv_id, 0
                turns.append((role, text))
                size += len(role) + len(text)
        if turns:
            held.append((current, number, turns))
            yield rows()

    return run


def formatted(
    conversations: DataFrame,
    tokenizer: str,
    roles: tuple[str, ...] = LOSS_ROLES,
    piece_turns: int = PIECE_TURNS,
    piece_chars: int = PIECE_CHARS,
) -> DataFrame:
    """A row per conversation (per piece of a very long one): string, tokens, their places, loss mask.

    `whole` says that the row is all of its conversation.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
        F.col("turn").cast("long").alias("turn"),
    )
    n = common.partitions(conversations.sparkSession)
    order = ["turn", "role", "text"]
    render_all = _renderer(tokenizer, roles, piece_turns, piece_chars)

    def rendered(rows: DataFrame, whole: bool) -> DataFrame:
        return rows.mapInArrow(render_all, FORMATTED).withColumn("whole", F.lit(whole))

    def together(rows: DataFrame) -> DataFrame:
        return rows.repartition(n, "conv_id").sortWithinPartitions("conv_id", *order)

    chars = F.coalesce(F.length("role"), F.lit(0)) + F.coalesce(F.length("text"), F.lit(0))
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(chars).alias("chars"))
    long = sizes.where((F.col("n") > piece_turns) | (F.col("chars") > piece_chars))
    long = long.select(F.col("conv_id").alias("long_id"))
    many = long.count()
    if not many:
        return rendered(together(turns), True)
    if many <= SMALL:
        long = F.broadcast(long)
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    short = turns.join(long, same, "left_anti")
    spread = turns.join(long, same, "left_semi").repartitionByRange(n, "conv_id", *order)
    spread = spread.sortWithinPartitions("conv_id", *order)
    return rendered(together(short), True).union(rendered(spread, False))


def loss_texts(formatted: str, begins: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> list[str]:
    """The stretches of the string under the mask, unescaped."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    spans = zip(begins[edges[::2]].tolist(), ends[edges[1::2] - 1].tolist())
    return [unescape(formatted[a:b]) for a, b in spans]


def turns_of(formatted: str) -> Turns:
    """(role, text) of all turns; anything outside of turns is an error."""
    turns, at = [], 0
    for found in _TURN.finditer(formatted):
        if found.start() != at:
            raise ValueError("text outside of turns")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    if at != len(formatted):
        raise ValueError("text outside of turns")
    return turns


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current: object = _reader  # no conversation yet
    turns = loss = None
    n_turns = loss_chars = chars = 0

    def row() -> pa.RecordBatch:
        values = [current, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars]
        fields = [f.split() for f in READ.split(", ")]
        kinds = {"long": pa.int64(), "string": pa.string()}
        columns = [pa.array([v], kinds[kind]) for v, (_, kind) in zip(values, fields)]
        return pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])

    done: list[pa.RecordBatch] = []
    for batch in batches:
        ids, texts = (batch.column(k).to_pylist() for k in range(2))
        for at, (conv_id, text) in enumerate(zip(ids, texts)):
            begins, ends, mask = (batch.column(k)[at] for k in range(2, 5))
            if current is _reader or conv_id != current:
                if current is not _reader:
                    done.append(row())
                current, turns, loss = conv_id, hashlib.sha256(), hashlib.sha256()
                n_turns = loss_chars = chars = 0
            for role, said in turns_of(text):
                turns.update(f"{role}\n{said}\n".encode())
                n_turns += 1
            places = [x.values.to_numpy(zero_copy_only=False) for x in (begins, ends, mask)]
            for said in loss_texts(text, *places):
                loss.update(said.encode())
                loss_chars += len(said)
            chars += len(text)
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
            done = []
    if current is not _reader:
        yield row()


def read(pieces: DataFrame) -> DataFrame:
    """Per conversation what its formatted rows hold: turns and the text under the loss mask.

    Whole conversations are read where they lie. Pieces meet by conversation, and digests are taken
    in their order, one piece at a time.
    """
    columns = ["conv_id", "formatted", "token_begins", "token_ends", "loss_mask"]
    whole = pieces.where("whole").select(*columns)
    rest = pieces.where("not whole").repartition(common.partitions(pieces.sparkSession), "conv_id")
    rest = rest.sortWithinPartitions("conv_id", "part", "piece").select(*columns)
    return whole.mapInArrow(_reader, READ).union(rest.mapInArrow(_reader, READ))


# Fixed value: the rows that the contract adds.
EXTRA_TEXT = "</s>[INST] ok [/INST]"


def with_extra(conversations: DataFrame) -> DataFrame:
    """The contract's rows: the table and the conversation -7."""
    spark = conversations.sparkSession
    rows = [(-7, 0, "user", EXTRA_TEXT), (-7, 1, "assistant", EXTRA_TEXT)]
    extra = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return conversations.select(*extra.columns).union(extra)


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_extra(common.table(spark, sf_dir, "conversations"))
    return read(formatted(rows, bpe.vocabulary()))
