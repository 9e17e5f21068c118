"""Words and shingles of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of bytes outside ``\\x20\\x09-\\x0D``. Texts are taken in slices of a
bounded number of bytes, so memory follows the slice (or one very long text), not
the batch. Equal words have equal hashes in every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1024 * 1024

_ODD = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values: the finishing steps of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2**64, as many as were needed so far.

    Functions travel to the workers with the values they use. These are made where they are needed and left
    out, as they would make every such function 32 MB larger once the driver has hashed a word.
    """

    def __init__(self):
        self.made = (np.ones(1, np.uint64), np.ones(1, np.uint64))

    def __reduce__(self):
        return type(self), ()


_powers = _Powers()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64, at least ``n`` of each."""
    if len(_powers.made[0]) < n:
        size = max(n, 2 * SLICE_BYTES)
        made = []
        for base in (_ODD, pow(_ODD, -1, 2**64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=np.uint64))
        if size > 4 * SLICE_BYTES:  # for one very long text only
            return made[0], made[1]
        _powers.made = (made[0], made[1])
    return _powers.made


@dataclass
class Slice:
    """Some texts of a batch: rows ``low`` to ``high``, their bytes and where each begins."""

    low: int
    high: int
    data: np.ndarray
    offsets: np.ndarray


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a column of texts (null as empty) into slices of about ``limit`` bytes."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), len(column))
        yield Slice(
            low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        )
        low = high


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums that give the hash of any stretch: see ``stretch_hash``."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(len(data) + 1)[0][: len(data)], out=sums[1:])
    return sums


def stretch_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the bytes from ``start`` to ``end``, the same wherever they stand."""
    return mix((sums[end] - sums[start]) * powers(len(sums))[1][start])


@dataclass
class Words:
    """Words of a slice. Text ``i`` has the words ``first[i]`` to ``first[i + 1]``."""

    hash: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray


def words(piece: Slice, lower: bool = True) -> Words:
    data = _LOWER[piece.data] if lower else piece.data
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none.astype(np.uint64), np.zeros(len(piece.offsets), np.int64), none, none)
    inside = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[piece.offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, piece.offsets)
    return Words(stretch_hash(prefix_hash(data), start, end), first, start, end)


def run_hash(parts: np.ndarray) -> np.uint64:
    """The hash of a run of word hashes, whatever its length."""
    total = np.uint64(len(parts))
    with np.errstate(over="ignore"):
        for part in parts:
            total = (total + part) * np.uint64(_ODD)
    return mix(np.array([total], np.uint64))[0]


def shingles(found: Words, size: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words in each text, in order, and where each text begins.

    A text with fewer words gives its whole sequence as one, or with
    ``short=False`` nothing; a text without words gives nothing.
    """
    count = np.diff(found.first)
    n = len(found.hash)
    made = np.maximum(count - size + 1, (count > 0) * short).astype(np.int64)
    first = np.zeros(len(made) + 1, np.int64)
    np.cumsum(made, out=first[1:])
    if not first[-1]:
        return np.zeros(0, np.uint64), first
    total = np.full(max(n - size + 1, 0), size, np.uint64)
    for j in range(size):
        total = (total + found.hash[j : j + len(total)]) * np.uint64(_ODD)
    total = mix(total)
    out = np.zeros(first[-1], np.uint64)
    owner = np.repeat(np.arange(len(made)), made)
    at = found.first[owner] + np.arange(len(out)) - first[owner]
    full = count[owner] >= size
    out[full] = total[at[full]]
    for text in np.flatnonzero((count > 0) & (count < size)) if short else ():
        out[first[text]] = run_hash(found.hash[found.first[text] : found.first[text + 1]])
    return out, first


def signed(values: np.ndarray) -> pa.Array:
    """Hashes as Spark's long."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))
