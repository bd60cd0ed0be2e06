"""Words of a batch of texts as numpy arrays: exact word numbers without a Python object per word."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLANKS = bytes([0x20, *range(0x09, 0x0E)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def byte_set(values: bytes) -> np.ndarray:
    """A table of 256 flags."""
    flags = np.zeros(256, dtype=bool)
    flags[list(values)] = True
    return flags


@dataclass
class Words:
    """All words of a batch, in order. Equal words have equal numbers, different words different ones."""

    data: np.ndarray  # the bytes of the texts one behind the other
    limits: np.ndarray  # where each text begins in ``data``, and the end
    start: np.ndarray  # of each word in ``data``
    stop: np.ndarray
    doc: np.ndarray  # the text that a word stands in
    number: np.ndarray
    names: pa.Array  # a word's bytes by its number

    @property
    def bounds(self) -> np.ndarray:
        """Where the words of each text begin, and the number of words."""
        return np.searchsorted(self.doc, np.arange(len(self.limits)))

    def joined(self, keep: np.ndarray) -> list[bytes]:
        """Per text the words marked in ``keep``, with one space between them."""
        size = np.where(keep, self.stop - self.start, 0)
        solid = np.repeat(self.start, size) + (np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size))
        places = np.arange(len(solid)) + np.repeat(np.cumsum(keep) - keep, size)
        out = np.full(len(solid) + int(keep.sum()), 0x20, dtype=np.uint8)
        out[places] = self.data[solid]
        ends = np.concatenate([[0], np.cumsum(size + keep)])[self.bounds].tolist()
        whole = out.tobytes()
        return [whole[a : max(a, b - 1)] for a, b in zip(ends[:-1], ends[1:])]


def byte_column(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column without NULL and the limits of its rows; nothing is copied."""
    wide = pa.types.is_large_binary(texts.type) or pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return np.empty(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    limits = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8)[limits[0] : limits[-1]], limits - limits[0]


def words(texts: pa.Array, blanks: bytes = BLANKS, lower: bool = False) -> Words:
    """The words of a binary column without NULL; a word ends at a byte of ``blanks`` or with its text."""
    data, limits = byte_column(texts)
    if lower:
        data = _LOWER[data]
    solid = ~byte_set(blanks)[data]
    fresh = np.zeros(len(data) + 1, dtype=bool)  # the first byte of a text
    fresh[limits] = True
    begin, end = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1] | fresh[1:-1]
    end[:-1] &= ~solid[1:] | fresh[1:-1]
    start, stop = np.flatnonzero(begin), np.flatnonzero(end) + 1
    offsets = np.concatenate([[0], np.cumsum(stop - start)])
    packed = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data[solid])])
    coded = packed.dictionary_encode()
    doc = np.searchsorted(limits, start, side="right") - 1
    return Words(data, limits, start, stop, doc, coded.indices.to_numpy().astype(np.int64), coded.dictionary)


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense numbers of the keys and how often each number occurs."""
    _, number, count = np.unique(keys, return_inverse=True, return_counts=True)
    return number.astype(np.int64), count
