"""Numpy views of Arrow text columns, for operators that work on whole texts inside a task.

Texts are handled as one byte buffer with offsets; nulls count as empty texts. Batches are cut
into slices of a bounded number of bytes (a single longer text is a slice of its own), so a task
holds a few arrays of that size and never a whole partition.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20

#: Bytes that separate words: space and 0x09 to 0x0D.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, concatenated, and the n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]], off - off[0]


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A large_binary array over the buffer; no copy."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(np.ascontiguousarray(offsets, dtype=np.int64)),
                                  pa.py_buffer(np.ascontiguousarray(data))])


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds at most ``max_bytes`` of text, or one row."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(at, to - at)
            at = to


class Words:
    """Words of a slice: ``code`` (index into ``vocabulary``) and ``row`` of each, in order.

    ``gap`` tells of each byte value whether it separates words; white space by default.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = _SPACE):
        solid = ~gap[data]
        before = np.empty_like(solid)
        if len(solid):
            before[0] = False
            before[1:] = solid[:-1]
            before[offsets[:-1][offsets[:-1] < len(solid)]] = False     # a row starts a word anew
        start = np.flatnonzero(solid & ~before)
        after = np.empty_like(solid)
        if len(solid):
            after[-1] = False
            after[:-1] = solid[1:]
            ends = offsets[1:][offsets[1:] > 0] - 1
            after[ends] = False
        length = np.flatnonzero(solid & ~after) + 1 - start
        bounds = np.concatenate([[0], np.cumsum(length)])       # in the buffer without separators
        letters = solid
        self.rows = len(offsets) - 1
        self.per_row = np.diff(np.searchsorted(start, offsets))
        self.row = np.repeat(np.arange(self.rows), self.per_row)
        coded = binary_array(data[letters], bounds).dictionary_encode()
        self.code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.vocabulary = coded.dictionary
        self.solid = solid

    @property
    def first(self) -> np.ndarray:
        """Position of each row's first word, and the end."""
        return np.concatenate([[0], np.cumsum(self.per_row)])


def window_codes(code: np.ndarray, n: int) -> np.ndarray:
    """Exact codes of the n-word windows of a code sequence (no hashing); len(code) - n + 1 of them."""
    out = code
    size = int(code.max()) + 1 if len(code) else 1
    for k in range(1, n):
        out, found = pd.factorize(out[:len(code) - k] * size + code[k:])
        out = out.astype(np.int64)
    return out


def window_rows(first: np.ndarray, n: int) -> np.ndarray:
    """Positions (in the whole code sequence) at which an n-word window stays inside its row."""
    total = int(first[-1])
    inside = np.ones(total, dtype=bool)
    for k in range(1, n):
        at = first[1:] - k
        inside[at[(at >= first[:-1]) & (at >= 0)]] = False
    return np.flatnonzero(inside)


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of valid UTF-8, and the position of the first byte of each."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    point = data[lead].astype(np.uint32)
    wide = np.flatnonzero(point >= 0x80)
    if len(wide):
        at, first = lead[wide], point[wide]
        more = [data[np.minimum(at + k, len(data) - 1)].astype(np.uint32) & 0x3F for k in (1, 2, 3)]
        two = ((first & 0x1F) << 6) | more[0]
        three = ((first & 0x0F) << 12) | (more[0] << 6) | more[1]
        four = ((first & 0x07) << 18) | (more[0] << 12) | (more[1] << 6) | more[2]
        point[wide] = np.where(first < 0xE0, two, np.where(first < 0xF0, three, four))
    return np.minimum(point, sys.maxunicode), lead


#: Classes of characters.
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: White space by Unicode (White_Space property).
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def character_classes() -> np.ndarray:
    """Class of every code point: letters and numbers by general category."""

    def make() -> np.ndarray:
        kind = {"L": LETTER, "N": NUMBER}
        out = np.array([kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)], dtype=np.uint8)
        out[_WHITE] = SPACE
        return out

    return kept_in_worker("character classes", make)


def kept_in_worker(name: object, make: Callable):
    """``make()``, once per Python process: tasks that follow in the same worker find it again."""
    held = sys.__dict__.setdefault("_rentyield_llm", {})
    if name not in held:
        held[name] = make()
    return held[name]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix); a bijection."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hash_bytes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64-bit hash of each entry of a buffer; equal bytes give equal hashes."""
    import xxhash
    raw = data.tobytes()
    return np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])),
                       dtype=np.uint64, count=len(offsets) - 1)
