"""Words, shingles and their 64-bit names, computed for whole Arrow batches with numpy.

Words are the maximal runs of bytes other than space and 0x09-0x0D.  Texts are cut into
groups of bounded size, so the working memory does not depend on the batch; one text is
never divided.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

GROUP_BYTES = 1 << 20
_LONG = 256  # bytes from which a word is named by a cryptographic hash

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (the finaliser of SplitMix64)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


# Masks that leave the first n bytes of a block of eight.
_FIRST_BYTES = np.frombuffer(b"".join(bytes([255] * n + [0] * (8 - n)) for n in range(9)), _U)


@dataclass
class Words:
    """Words of some texts: ``first[i]:first[i + 1]`` are the words of text ``i``."""

    data: np.ndarray  # bytes of all texts
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1

    def names(self) -> np.ndarray:
        """A 64-bit name of each word, the same for equal words everywhere.

        Blocks of eight bytes are scrambled into the state one after the other, so no pattern of letters makes two words
        alike; words of at most eight bytes and one length never share a name.
        """
        lengths = self.ends - self.starts
        blocks = np.lib.stride_tricks.sliding_window_view(np.append(self.data, np.zeros(8, np.uint8)), 8)
        out = mixed(lengths.astype(_U) * _U(0x9E3779B97F4A7C15))
        at, done = np.flatnonzero(lengths <= _LONG), 0
        while len(at):
            begin = self.starts[at] + done
            rest = self.ends[at] - begin
            block = np.ascontiguousarray(blocks[begin]).view(_U)[:, 0] & _FIRST_BYTES[np.minimum(rest, 8)]
            out[at] = mixed(out[at] ^ block)
            at, done = at[rest > 8], done + 8
        for i in np.flatnonzero(lengths > _LONG):
            word = self.data[self.starts[i] : self.ends[i]].tobytes()
            out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return out

    def texts(self, row: int) -> list[bytes]:
        raw = self.data.tobytes()
        a, b = int(self.first[row]), int(self.first[row + 1])
        return [raw[s:e] for s, e in zip(self.starts[a:b], self.ends[a:b])]


def plain(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each begins; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    wide = column.cast(pa.large_string())
    _, where, data = wide.buffers()
    offsets = np.frombuffer(where, np.int64)[wide.offset : wide.offset + len(wide) + 1]
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    found = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return found, offsets - offsets[0]


def groups(column: pa.Array, lower: bool = False) -> Iterator[tuple[int, int, Words]]:
    """Rows ``begin:end`` of a text column and their words, a bounded number of bytes at a time."""
    data, offsets = plain(column)
    begin, rows = 0, len(offsets) - 1
    while begin < rows:
        end = int(np.searchsorted(offsets, offsets[begin] + GROUP_BYTES, "right")) - 1
        end = min(rows, max(end, begin + 1))
        part = data[offsets[begin] : offsets[end]]
        part = _LOWER[part] if lower else part
        yield begin, end, split(part, offsets[begin : end + 1] - offsets[begin])
        begin = end


def split(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


_STEP = 0xA0761D6478BD642F | 1


def shingle_names(names: np.ndarray, width: int) -> np.ndarray:
    """Names of all runs of ``width`` words; position i is the run that starts at word i."""
    n = len(names) - width + 1
    if n <= 0:
        return np.zeros(0, _U)
    total, scale = np.zeros(n, _U), 1
    for k in range(width):
        total += names[k : k + n] * _U(scale)
        scale = scale * _STEP % (1 << 64)
    return mixed(total + _U(width * 0x632BE59BD9B4E019 % (1 << 64)))


def shingle_sets(words: Words, width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct names of its shingles.

    A text with fewer words than ``width`` has its whole word sequence as its only shingle;
    one without words has none.
    """
    names = words.names()
    every = shingle_names(names, width)
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= width:
            yield np.unique(every[a : b - width + 1])
        elif b > a:
            yield shingle_names(names[a:b], int(b - a))
        else:
            yield np.zeros(0, _U)


def lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from one array for each row."""
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat).cast(kind))
