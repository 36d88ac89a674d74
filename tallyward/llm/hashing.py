"""Hashes of words and word sequences, for whole Arrow batches at once.

A polynomial hash of the bytes, summed along the batch, gives every word's hash as the
difference of two running sums; no Python loop touches a word. All of it is arithmetic
modulo 2^64, alike on every machine.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text hashed at a time; a longer text is taken whole, alone.
BLOCK = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)


def give_back() -> None:
    """Hand freed memory back to the system, so that idle workers hold little; the C library may have no such call."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def byte_classes(**members: str) -> np.ndarray:
    """A table from byte to class number; bytes not named separate runs. ``high`` stands for all bytes from 0x80."""
    table = np.zeros(256, dtype=np.uint8)
    for number, chars in enumerate(members.values(), start=1):
        table[[ord(c) for c in chars if ord(c) < 128]] = number
        if "\x80" in chars:
            table[128:] = number
    return table


def blank_separated() -> np.ndarray:
    """Words are what stands between blanks: space and the control characters 9 to 13."""
    table = np.ones(256, dtype=np.uint8)
    table[[0x20, *range(0x09, 0x0E)]] = 0
    return table


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, one to one."""
    out = values ^ (values >> np.uint64(30))
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return out


@lru_cache(maxsize=2)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and of its inverse."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    out = []
    for base in (_BASE, inverse):
        steps = np.full(length, base, dtype=np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def blocks(texts: pa.Array, size_limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size_limit`` bytes each."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    first, held = 0, 0
    for row, size in enumerate(sizes):
        if held and held + size > size_limit:
            yield first, row
            first, held = row, 0
        held += int(size)
    if first < len(sizes):
        yield first, len(sizes)


class Runs:
    """Words of a block of texts: their hashes, the text each is from, and words per text."""

    def __init__(self, texts: pa.Array, classes: np.ndarray):
        texts = pc.ascii_lower(pc.fill_null(texts, "")).cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
        data = data[offsets[0] : offsets[-1]]
        self.n_texts = len(texts)
        self.bounds = offsets - offsets[0]
        kind = classes[data]
        change = np.ones(len(data) + 1, dtype=bool)
        change[1:-1] = kind[1:] != kind[:-1]
        change[self.bounds] = True
        edges = np.flatnonzero(change)
        starts, ends = edges[:-1], edges[1:]
        inside = kind[starts] > 0
        self.starts, self.ends = starts[inside], ends[inside]
        length = max(BLOCK, len(data)) + 1
        up, down = self._powers = _powers(1 << int(length - 1).bit_length())
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data + np.uint64(1)) * up[: len(data)], out=sums[1:])
        self.hashes = mix((sums[self.ends] - sums[self.starts]) * down[self.starts])
        self.first = np.searchsorted(self.starts, self.bounds)
        self.counts = np.diff(self.first)

    def text_of_words(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_texts), self.counts)

    def sequences(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent 64-bit hashes of each text's whole word sequence."""
        out, (up, down) = [], self._powers
        for salt in (1, 2):
            sums = np.zeros(len(self.hashes) + 1, dtype=np.uint64)
            np.cumsum(mix(self.hashes + np.uint64(salt)) * up[: len(self.hashes)], out=sums[1:])
            first, last = self.first[:-1], self.first[1:]
            out.append(mix((sums[last] - sums[first]) * down[first] + self.counts.astype(np.uint64)))
        return out[0], out[1]

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of each text's runs of ``width`` words, and where each text's begin.

        A text of fewer words has one, its whole sequence; a text without words none.
        """
        words, first, counts = self.hashes, self.first[:-1], self.counts
        amount = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
        begins = np.concatenate([[0], np.cumsum(amount)])
        where = np.arange(begins[-1]) + np.repeat(first - begins[:-1], amount)
        left = np.repeat(first + counts, amount) - where
        out = np.zeros(len(where), dtype=np.uint64)
        padded = np.concatenate([words, np.zeros(width, dtype=np.uint64)])
        for step in range(width):
            out *= _STEP
            out += np.where(left > step, mix(padded[where + step] + np.uint64(step + 1)), np.uint64(0))
        return mix(out), begins
