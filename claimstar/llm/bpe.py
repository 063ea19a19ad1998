"""Byte-level BPE ids of many texts: the tokenizers library encodes each distinct piece once.

Texts are cut at places that no pre-token of the vocabulary's pattern crosses: before white space,
after letters before a full stop or comma, and after a lone line feed. Pieces are looked up by a
64-bit polynomial hash (numpy, whole batches at once); the library encodes those not seen before.
Texts with white space other than space and line feed, or with the text of a special token, for
which the cuts are not proven, go to the library whole. Texts beyond `BATCH_BYTES` are worked off in
stretches of about that size, so neither the table of pieces nor the library's own memory grows with
the length of a text.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np

END = 0
BATCH_BYTES = 1 << 20

# Bytes that can begin white space other than space and line feed.
_SUSPECT = re.compile(rb"[\t\x0b-\r\x1c-\x1f\xc2\xe1-\xe3]").search
_ODD_SPACE = re.compile(r"[^\S \n]").search
_BETWEEN_WORDS = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])").search  # a pre-token begins here in any text

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _classes() -> np.ndarray:
    """Per byte: 1 space or line feed, 2 full stop or comma, 4 ASCII letter."""
    kind = np.zeros(256, np.uint8)
    kind[[32, 10]] = 1
    kind[[46, 44]] = 2
    kind[65:91] = kind[97:123] = 4
    return kind


_KIND = _classes()


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def cuts(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pieces begin in the bytes of several texts; `first` are the texts' first bytes."""
    n = len(data)
    kind = _KIND[data]
    space = kind == 1
    begin = np.zeros(n, bool)
    begin[1:] = space[1:] & ~space[:-1]
    letter = kind == 4
    wide = np.zeros(n, bool)  # the second byte of a Latin letter beyond ASCII
    wide[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    letter |= wide
    begin[1:] |= (kind[1:] == 2) & letter[:-1]
    lone = np.zeros(n, bool)  # a line feed between two bytes that are not white space
    lone[1:-1] = (data[1:-1] == 10) & ~space[:-2] & ~space[2:]
    lone[first] = False
    begin[1:] |= lone[:-1]
    begin[first] = True
    return np.flatnonzero(begin)


def stretches(raw: bytes, size: int) -> Iterator[bytes]:
    """The bytes of a text in stretches of whole pieces, of `size` bytes or one longer piece."""
    at, wide = 0, size
    while len(raw) - at > wide:
        cut = int(cuts(np.frombuffer(raw, np.uint8, wide, at), np.zeros(1, int))[-1])
        if cut:
            yield raw[at : at + cut]
            at, wide = at + cut, size
        else:
            wide *= 2
    yield raw[at:]


class Encoder:
    """Ids of texts. `cached` bounds the pieces remembered; beyond it the memory starts afresh."""

    SLOTS = 1 << 21

    def __init__(self, path: str, cached: int = 900_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cached = cached
        self._grow(BATCH_BYTES + 1)
        self._forget()

    def _grow(self, n: int) -> None:
        self.up, self.down = _powers(_BASE, n), _powers(_BASE_INVERSE, n)

    def _forget(self) -> None:
        self.keys = np.zeros(self.SLOTS, np.uint64)  # 0: empty
        self.values = np.zeros(self.SLOTS, np.int32)
        self.flat = np.empty(1 << 20, np.uint32)
        self.used = 0
        self.starts = np.empty(1 << 18, np.int64)
        self.sizes = np.empty(1 << 18, np.int64)
        self.known = 0

    def _room(self, name: str, needed: int) -> np.ndarray:
        held = getattr(self, name)
        while needed > len(held):
            held = np.concatenate([held, np.empty_like(held)])
            setattr(self, name, held)
        return held

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of pieces, -1 for unknown ones."""
        found = np.full(len(keys), -1, np.int64)
        rest = np.arange(len(keys))
        slot = (keys >> np.uint64(43)).astype(np.int64)
        while len(rest):
            there = self.keys[slot]
            same = there == keys[rest]
            found[rest[same]] = self.values[slot[same]]
            on = ~same & (there != 0)
            rest, slot = rest[on], (slot[on] + 1) & (self.SLOTS - 1)
        return found

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        """Distinct new pieces: their ids from the library, a slot for each."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for one in ids for i in one), np.uint32, int(sizes.sum()))
        to = self.known + len(pieces)
        self._room("flat", self.used + len(flat))[self.used : self.used + len(flat)] = flat
        self._room("sizes", to)[self.known : to] = sizes
        self._room("starts", to)[self.known : to] = self.used + np.cumsum(sizes) - sizes
        slots = self.keys
        for number, key in enumerate(keys.tolist(), self.known):
            at = key >> 43
            while slots[at]:
                at = (at + 1) & (self.SLOTS - 1)
            slots[at] = key
            self.values[at] = number
        self.used += len(flat)
        self.known = to

    def _plain(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that may be cut, each with the end id, and their sizes."""
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        joined = b"".join(raw)
        some = lengths > 0
        texts_at = np.cumsum(lengths) - lengths
        counts = np.zeros(len(raw), np.int64)
        if not joined:
            return np.full(len(raw), END, np.uint32), counts + 1
        if len(joined) >= len(self.up):
            self._grow(len(joined) + 1)
        data = np.frombuffer(joined, np.uint8)
        start = cuts(data, texts_at[some])
        end = np.append(start[1:], len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=sums[1:])
        keys = (sums[end] - sums[start]) * self.down[start]
        keys ^= keys >> np.uint64(29)
        keys *= np.uint64(0xBF58476D1CE4E5B9)
        keys ^= keys >> np.uint64(32)
        keys[keys == 0] = 1
        at = self._find(keys)
        new = np.flatnonzero(at < 0)
        if len(new):
            if self.known > self.cached:
                self._forget()
                new = np.arange(len(keys))
            fresh, where = np.unique(keys[new], return_index=True)
            where = new[where]
            pieces = [
                joined[a:b].decode() for a, b in zip(start[where].tolist(), end[where].tolist())
            ]
            self._learn(fresh, pieces)
            at[new] = self._find(keys[new])
        sizes = self.sizes[at]
        text_of = np.searchsorted(texts_at[some], start, side="right") - 1
        counts[some] = np.bincount(text_of, sizes, minlength=int(some.sum())).astype(np.int64)
        total = int(sizes.sum())
        shift = np.repeat(self.starts[at] - (np.cumsum(sizes) - sizes), sizes)
        shift += np.arange(total)
        out = np.full(total + len(raw), END, np.uint32)
        body = np.ones(len(out), bool)
        body[np.cumsum(counts + 1) - 1] = False
        out[body] = self.flat[shift]
        return out, counts + 1

    def _odd(self, raw: bytes, text: str) -> bool:
        special = any(t in text for t in self.added)
        return special or bool(_SUSPECT(raw) and _ODD_SPACE(text))

    def _by_library(self, text: str) -> np.ndarray:
        """Ids of a text and the end id, all from the library, about a batch at a time."""
        ids: list[np.ndarray] = []
        at = 0
        while at < len(text):
            space = _BETWEEN_WORDS(text, at + BATCH_BYTES)
            end = space.start() if space else len(text)
            found = self.tokenizer.encode(text[at:end], add_special_tokens=False).ids
            ids.append(np.array(found, np.uint32))
            at = end
        return np.concatenate([*ids, np.array([END], np.uint32)])

    def _long(self, raw: bytes) -> np.ndarray:
        """Ids of a text beyond a batch, and the end id."""
        parts = []
        for part in stretches(raw, BATCH_BYTES):
            if len(part) > 2 * BATCH_BYTES:  # hardly any place to cut it
                parts.append(self._by_library(part.decode())[:-1])
            else:
                parts.append(self._plain([part])[0][:-1])
        return np.concatenate([*parts, np.array([END], np.uint32)])

    def encode_many(self, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
        """Each text's ids and the end id, in the order given."""
        held: list[bytes] = []
        size = 0

        def flush() -> Iterator[np.ndarray]:
            ids, sizes = self._plain(held)
            yield from np.split(ids, np.cumsum(sizes)[:-1])

        for text in texts:
            raw = (text or "").encode()
            odd = self._odd(raw, text or "")
            if odd or len(raw) > BATCH_BYTES:
                if held:
                    yield from flush()
                    held, size = [], 0
                yield self._by_library(text) if odd else self._long(raw)
                continue
            if held and size + len(raw) > BATCH_BYTES:
                yield from flush()
                held, size = [], 0
            held.append(raw)
            size += len(raw)
        if held:
            yield from flush()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker, so that later tasks find its pieces."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def vocabulary() -> str:
    """Where the public vocabulary lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def ids_crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())
