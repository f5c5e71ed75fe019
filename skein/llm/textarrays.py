"""Whole Arrow batches of texts as flat numpy arrays: words, lines, hashes.

Texts are cut into words and hashed without a Python loop over rows. A batch is
worked on in slices of a bounded number of bytes, so memory follows the slice
(or one text, if that is longer) and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

SLICE_BYTES = 1 << 19

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers can be inverted modulo 2**64
_INV = pow(_BASE, -1, 1 << 64)

#: [\x20\x09-\x0D]
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: What does not belong to a term: ASCII other than letters and digits.
NOT_TERM = np.zeros(256, bool)
NOT_TERM[:128] = True
for _r in (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"):
    NOT_TERM[np.frombuffer(_r, np.uint8)] = False


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit reaches every output bit."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))
_powers = [np.ones(1, _U), np.ones(1, _U)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        for k, b in enumerate((_BASE, _INV)):
            a = np.full(size, b, _U)
            a[0] = 1
            _powers[k] = np.cumprod(a, dtype=_U)
    return _powers[0], _powers[1]


class Texts:
    """``data``: the UTF-8 bytes of all texts; ``offsets``: where each begins."""

    def __init__(self, array: pa.Array):
        if isinstance(array, pa.ChunkedArray):
            array = array.combine_chunks()
        array = array.cast(pa.large_string())
        if array.null_count:
            array = array.fill_null("")
        self.n = len(array)
        if self.n == 0:
            self.offsets, self.data = np.zeros(1, np.int64), np.zeros(0, np.uint8)
            return
        _, offsets, data = array.buffers()
        o = np.frombuffer(offsets, np.int64)[array.offset : array.offset + self.n + 1]
        d = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.offsets, self.data = o - o[0], d[o[0] : o[-1]]

    def prefix_hash(self) -> np.ndarray:
        """``h[i]``: the rolling hash of the first i bytes; see :meth:`span_hash`."""
        if not hasattr(self, "_prefix"):
            n = len(self.data)
            up, _ = _power(n + 1)
            h = np.zeros(n + 1, _U)
            np.cumsum(_BYTE[self.data] * up[:n], dtype=_U, out=h[1:])
            self._prefix = h
        return self._prefix

    def span_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte spans; equal bytes give equal hashes everywhere."""
        h = self.prefix_hash()
        _, down = _power(len(self.data) + 1)
        return mix((h[ends] - h[starts]) * down[starts] + (ends - starts).astype(_U))

    def spans(self, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs without separator bytes: starts, ends, and bounds.

        ``bounds[d]:bounds[d + 1]`` are the runs of text d.
        """
        inside = ~separator[self.data]
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        cuts = self.offsets[:-1]
        before[cuts[cuts < len(inside)]] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        cuts = self.offsets[1:]
        after[cuts[cuts > 0] - 1] = False
        ends = np.flatnonzero(inside & ~after) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What splitting at \\n gives: starts, ends, and bounds as in :meth:`spans`."""
        breaks = np.flatnonzero(self.data == 10)
        starts = np.concatenate([self.offsets[:-1], breaks + 1])
        owner = np.concatenate([np.arange(self.n), np.searchsorted(self.offsets, breaks, "right") - 1])
        order = np.lexsort((starts, owner))
        starts, owner = starts[order], owner[order]
        ends = np.empty_like(starts)
        ends[:-1] = starts[1:] - 1
        last = np.flatnonzero(np.append(owner[1:] != owner[:-1], True)) if len(owner) else owner
        ends[last] = self.offsets[1:]
        return starts, ends, np.searchsorted(owner, np.arange(self.n + 1))

    def total(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The sum of a per-byte array over spans."""
        c = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=c[1:])
        return c[ends] - c[starts]

    def code_points(self) -> np.ndarray:
        """Per byte: whether it begins a character."""
        return (self.data & 0xC0) != 0x80


def owners(bounds: np.ndarray) -> np.ndarray:
    """The text of every span, from the bounds of the texts."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def grams(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n spans from each on, within a text; and where they begin."""
    if len(hashes) < n:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    size = len(hashes) - n + 1
    at = np.flatnonzero(owner[:size] == owner[n - 1 :])
    h = np.zeros(len(at), _U)
    for k in range(n):
        h = h * _U(_BASE) + hashes[at + k]
    return mix(h), at


def per_text(n: int, owner: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
    """Counts, or sums of integers, by text."""
    if values is None:
        return np.bincount(owner, minlength=n).astype(np.int64)
    c = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=c[1:])
    b = np.searchsorted(owner, np.arange(n + 1))
    return c[b[1:]] - c[b[:-1]]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES, rows: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of about ``limit`` bytes of text and at most ``rows`` rows, or one row."""
    n = batch.num_rows
    if n == 0:
        return
    array = batch.column(batch.schema.get_field_index(column))
    lengths = pa.compute.binary_length(array.cast(pa.large_string())).fill_null(0).to_numpy(zero_copy_only=False)
    total = np.cumsum(lengths, dtype=np.int64)
    at = 0
    while at < n:
        base = total[at - 1] if at else 0
        to = min(at + rows, max(at + 1, int(np.searchsorted(total, base + limit, "right"))))
        yield batch.slice(at, to - at)
        at = to
