"""Words of many texts at once, as numpy arrays.

A word is a maximal run of bytes other than ``0x20`` and ``0x09-0x0D`` in the UTF-8
text: the pattern ``[^\\x20\\x09-\\x0D]+``.  UTF-8 never uses these bytes inside a
longer character, so bytes and code points give the same words.

Every word has a 64-bit hash; a window of words has a hash built from halves, so a
window of twice the length costs one more step.  Equal sequences of equal length
always get equal hashes.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Texts are cut into pieces of about so many bytes, at document borders.
PIECE_BYTES = 2 << 20
#: Words are hashed in stretches of about so many bytes.
STRETCH_BYTES = 1 << 16

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def join_hashes(left: np.ndarray, right: np.ndarray, lane: int = 0) -> np.ndarray:
    """Hash of a sequence from those of its two parts."""
    factor = np.uint64(0xD6E8FEB86659FD93 + 2 * lane * 0x632BE59BD9B4E019 & (2**64 - 1) | 1)
    return mix(left * factor + right + np.uint64(lane + 1) * _STEP)


@dataclass
class Piece:
    """Some consecutive texts: their bytes, words and borders."""

    row: int  #: index of the first text in the column
    data: np.ndarray  #: bytes of all texts, one after the other
    text_at: np.ndarray  #: where each text starts in ``data``; one entry more than texts
    starts: np.ndarray  #: first byte of each word
    ends: np.ndarray  #: byte after each word
    first: np.ndarray  #: index of each text's first word; one entry more than texts

    @property
    def n_texts(self) -> int:
        return len(self.text_at) - 1

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_texts), self.n_words)

    def word_hashes(self, lower: bool = False) -> np.ndarray:
        """One hash for each word; ``lower`` folds A-Z only."""
        return run_hashes(lowered(self.data) if lower else self.data, self.starts, self.ends)

    def whole_windows(self, length: int) -> np.ndarray:
        """For each word, whether a window of ``length`` words starts there in its text."""
        at = np.arange(len(self.starts))
        return at + length <= np.repeat(self.first[1:], self.n_words)


def lowered(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each run of bytes ``data[start:end]``; runs are in order, apart and not empty.

    A run's sum of bytes by powers of an odd step is a difference of running sums over a
    stretch of text, divided by the power where the run starts: modulo 2**64 that is exact.
    """
    out = np.empty(len(starts), np.uint64)
    done = 0
    while done < len(starts):
        begin = int(starts[done])
        upto = max(done + 1, int(np.searchsorted(ends, begin + STRETCH_BYTES, "right")))
        own = slice(done, upto)
        stretch = data[begin:int(ends[upto - 1])]
        powers, inverse = _powers(len(stretch))
        sums = np.zeros(len(stretch) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[stretch] * powers[:len(stretch)], out=sums[1:])
        at = starts[own] - begin
        out[own] = (sums[ends[own] - begin] - sums[at]) * inverse[at]
        done = upto
    return mix(out + (ends - starts).astype(np.uint64) * _STEP)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the step and of its inverse, from the zeroth on; kept for stretches of usual length."""
    return _kept_powers() if n <= STRETCH_BYTES else _new_powers(n)


@functools.cache
def _kept_powers() -> tuple[np.ndarray, np.ndarray]:
    return _new_powers(STRETCH_BYTES)


def _new_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    both = []
    for factor in (_STEP, np.uint64(pow(int(_STEP), -1, 1 << 64))):
        powers = np.full(n, factor, np.uint64)
        powers[0] = 1
        both.append(np.cumprod(powers))
    return both[0], both[1]


def window_hashes(words: np.ndarray, length: int, lane: int = 0) -> np.ndarray:
    """Hash of the ``length`` words from each word on; the last ``length - 1`` have none.

    Windows that leave a text are hashed too; leave them out by ``whole_windows``.
    """
    if len(words) < length:
        return np.empty(0, np.uint64)
    part, size, done, covered = words, 1, None, 0
    while True:
        if length & size:
            # Lowest bit first: the parts of a window stand right to left of its end.
            at = length - covered - size
            own = part[at:at + len(words) - length + 1]
            done = own if done is None else join_hashes(own, done, lane)
            covered += size
        if covered == length:
            return done
        part = join_hashes(part[:len(part) - size], part[size:], lane)
        size *= 2


def pieces(column: pa.Array | pa.ChunkedArray, limit: int = PIECE_BYTES) -> Iterator[Piece]:
    """Cuts a string column into pieces of whole texts; null counts as empty."""
    row = 0
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        if len(chunk):
            chunk = chunk.cast(pa.large_string())
            _, offsets, data = chunk.buffers()
            at = np.frombuffer(offsets, np.int64)[chunk.offset:chunk.offset + len(chunk) + 1]
            if chunk.null_count:
                chunk = chunk.fill_null("")
                _, offsets, data = chunk.buffers()
                at = np.frombuffer(offsets, np.int64)[chunk.offset:chunk.offset + len(chunk) + 1]
            raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
            begin = 0
            while begin < len(chunk):
                end = max(begin + 1, int(np.searchsorted(at, at[begin] + limit, "right")) - 1)
                yield _piece(row + begin, raw[at[begin]:at[end]], at[begin:end + 1] - at[begin])
                begin = end
        row += len(chunk)


def _piece(row: int, data: np.ndarray, text_at: np.ndarray) -> Piece:
    ink = ~_BLANK[data]
    before = np.empty_like(ink)
    before[:1], before[1:] = False, ink[:-1]
    after = np.empty_like(ink)
    after[-1:], after[:-1] = False, ink[1:]
    before[text_at[:-1][text_at[:-1] < len(data)]] = False
    inner = text_at[1:-1]
    after[inner[inner > 0] - 1] = False
    starts = np.flatnonzero(ink & ~before)
    ends = np.flatnonzero(ink & ~after) + 1
    return Piece(row, data, text_at, starts, ends, np.searchsorted(starts, text_at))


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each start, the position of the smallest of ``width`` values from there on.

    Of equal values the leftmost one counts.  ``len(values) - width + 1`` entries.
    """
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    at, size = np.arange(len(values)), 1
    while size * 2 <= width:
        left, right = at[:len(at) - size], at[size:]
        at = np.where(values[right] < values[left], right, left)
        size *= 2
    left, right = at[:n], at[width - size:width - size + n]
    return np.where(values[right] < values[left], right, left)


def covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of ``n`` places lie in a run of ``length`` from one of ``starts`` on."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + length, n), -1)
    return np.cumsum(change[:n]) > 0
