"""Vectorised hashing of words and windows inside a task.

Every hash is a polynomial over a sequence, taken from prefix sums modulo 2**64, so the hash of any
stretch costs a few operations however long it is. Two independent families give 128 bits where
equality has to stand for equality of the text.
"""

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BLOCK_BYTES = 1 << 20
POSITION_BITS = 28
_POSITION_MASK = U((1 << POSITION_BITS) - 1)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
NOT_ALNUM = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit (multiply and shift rounds)."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


@functools.cache
def _byte_values(family: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U) * U(_BASES[1 - family]) + U(family))


@functools.cache
def _powers(family: int, inverse: bool, size: int) -> np.ndarray:
    base = pow(_BASES[family], -1, 1 << 64) if inverse else _BASES[family]
    out = np.full(size, base, U)
    out[0] = 1
    return np.cumprod(out, dtype=U)


def powers(family: int, n: int, inverse: bool = False) -> np.ndarray:
    size = 1 << max(21, int(n).bit_length())
    return _powers(family, inverse, size)[:n]


class Sequence:
    """Prefix sums of one family over the elements of a sequence."""

    def __init__(self, values: np.ndarray, family: int):
        n = len(values)
        self.family = family
        self.sums = np.zeros(n + 1, U)
        np.cumsum(values * powers(family, n), out=self.sums[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = self.sums[end] - self.sums[start]
        return mix(raw * powers(self.family, len(self.sums), True)[start])

    def grams(self, k: int) -> np.ndarray:
        """Hashes of all stretches of k elements."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, U)
        raw = self.sums[k:] - self.sums[:n]
        return mix(raw * powers(self.family, n, True))


def lower_bytes(buf: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, nothing else."""
    return _LOWER[buf]


def bytes_sequence(buf: np.ndarray, family: int) -> Sequence:
    return Sequence(_byte_values(family)[buf], family)


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES):
    """(first row, last row + 1, bytes, offsets): runs of rows of about ``limit`` bytes."""
    column = pc.fill_null(column, "")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), len(column))
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def words(
    buf: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text number of the words between separators; none spans two texts."""
    inside = ~separators[buf]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = inside[begins]
    ends = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[ends] = inside[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(
    buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int, lower: bool = False
) -> np.ndarray:
    """Hash of every word. Works in pieces of a block, so a huge text needs no array of its size."""
    table = _byte_values(family)[_LOWER] if lower else _byte_values(family)
    at_start, at_end = np.zeros(len(starts), U), np.zeros(len(starts), U)
    inverse = np.zeros(len(starts), U)
    carry, shift, shift_inverse = U(0), U(1), U(1)
    step = U(pow(_BASES[family], BLOCK_BYTES, 1 << 64))
    step_inverse = U(pow(_BASES[family], -BLOCK_BYTES, 1 << 64))
    with np.errstate(over="ignore"):
        for lo in range(0, len(buf), BLOCK_BYTES):
            piece = buf[lo : lo + BLOCK_BYTES]
            n = len(piece)
            sums = np.zeros(n + 1, U)
            np.cumsum(table[piece] * powers(family, n), out=sums[1:])
            sums = sums * shift + carry
            a, b = np.searchsorted(starts, (lo, lo + n))
            at_start[a:b] = sums[starts[a:b] - lo]
            inverse[a:b] = powers(family, n, True)[starts[a:b] - lo] * shift_inverse
            a, b = np.searchsorted(ends, (lo, lo + n), side="right")
            at_end[a:b] = sums[ends[a:b] - lo]
            carry, shift, shift_inverse = sums[n], shift * step, shift_inverse * step_inverse
    return mix((at_end - at_start) * inverse)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    out, have = values, 1
    while have < width:
        move = min(have, width - have)
        out = np.minimum(out[:-move], out[move:]) if len(out) > move else out[:0]
        have += move
    return out


def minimizer_runs(grams: np.ndarray, width: int, valid: np.ndarray):
    """Runs (first start, last start, anchor) of windows that share their smallest gram.

    The anchor of a window depends only on what is inside it: ties go to the leftmost gram.
    ``valid`` tells for every start whether a window may begin there.
    """
    packed = (grams & ~_POSITION_MASK) | np.arange(len(grams), dtype=U)
    best = sliding_min(packed, width)
    at = np.flatnonzero(valid[: len(best)])
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none
    chosen = best[at]
    cut = np.flatnonzero((chosen[1:] != chosen[:-1]) | (np.diff(at) != 1)) + 1
    first = np.concatenate(([0], cut))
    last = np.concatenate((cut, [len(at)])) - 1
    return at[first], at[last], (chosen[first] & _POSITION_MASK).astype(np.int64)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def spread_ranges(lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [lo, lo + n), with the number of their range."""
    owner = np.repeat(np.arange(len(lo)), n)
    begin = np.cumsum(n) - n
    return lo[owner] + (np.arange(len(owner)) - begin[owner]), owner


def merge_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open ranges as maximal runs; ranges that touch become one."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate(([True], start[1:] > end[:-1]))
    return start[new], end[np.concatenate((new[1:], [True]))]
