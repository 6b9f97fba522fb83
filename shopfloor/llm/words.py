"""Words of whole texts as 64-bit numbers, for a batch of texts at a time.

A word is a run of bytes other than blanks and the five ASCII line and tab marks. Its number is a
polynomial over random values of its bytes, taken from one running sum over the batch; words of more
than ``LONG`` bytes are hashed on their own, so that memory does not follow them.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

PIECE = 1 << 17
LONG = 4096
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_VALUES = np.random.default_rng(31).integers(1, 2**63, size=256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(PIECE + LONG, _STEP))])


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on all bits of ``x``; no two values fall together."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


@dataclass
class Words:
    """The words of a batch in order: first byte and end of each, the row it is in, and its number."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    numbers: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def per_row(self) -> np.ndarray:
        return np.bincount(self.rows, minlength=len(self.offsets) - 1)


def bytes_and_offsets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column without nulls, one after the other, and where each row begins."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.zeros(len(starts), np.uint64)
    lengths = ends - starts
    for i in np.flatnonzero(lengths > LONG):
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes())
    short = np.flatnonzero(lengths <= LONG)
    last = ends[short]
    at = 0
    while at < len(short):
        first = starts[short[at]]
        upto = max(at + 1, int(np.searchsorted(last, first + PIECE, "right")))
        here = short[at:upto]
        sums = np.zeros(ends[here[-1]] - first + 1, np.uint64)
        values = _VALUES[data[first : ends[here[-1]]]]
        np.cumsum(values * _POWERS[: len(values)], out=sums[1:])
        begin, end = starts[here] - first, ends[here] - first
        out[here] = (sums[end] - sums[begin]) * _POWERS[PIECE - begin]
        at = upto
    return mixed(out + lengths.astype(np.uint64))


def words_of(column: pa.Array, lower: bool = False) -> Words:
    """All words of the texts of a column without nulls; with ``lower``, A-Z count as a-z."""
    data, offsets = bytes_and_offsets(column)
    if lower:
        data = np.frombuffer(data.tobytes().translate(_LOWER), np.uint8)
    inside = ~_BLANK[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before, after = np.ones(len(data), bool), np.ones(len(data), bool)
    before[1:], after[:-1] = ~inside[:-1], ~inside[1:]
    starts = np.flatnonzero(inside & (before | cut[:-1]))
    ends = np.flatnonzero(inside & (after | cut[1:])) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return Words(data, offsets, starts, ends, rows, _numbers(data, starts, ends))
