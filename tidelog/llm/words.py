"""Words of whole texts as 64-bit hashes, computed over Arrow buffers with numpy.

A text is its UTF-8 bytes with A-Z lowered; a word is a maximal run of bytes that are not
separators. Hashes of different words are taken as different: with a billion distinct
words some two of them collide with a chance of about 0.03.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# space and the five ASCII controls from tab to carriage return
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
CHUNK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_ONE, _TWO = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(SPACES)] = False
_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUES[ord("A") : ord("Z") + 1] = _VALUES[ord("a") : ord("z") + 1]
_VALUES[list(SPACES)] = 0


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * _ONE
    h = h ^ (h >> np.uint64(27))
    h = h * _TWO
    return h ^ (h >> np.uint64(31))


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets of rows); null is an empty text."""
    text = text.fill_null("").cast(pa.large_utf8())
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + len(text) + 1]
    data = text.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def _powers(n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[:1] = 1
    out[1:] = _BASE
    return np.cumprod(out, dtype=np.uint64)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word; works through blocks of about CHUNK_BYTES."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK_BYTES, "right")))
        first, last = starts[at], ends[to - 1]
        begin = starts[at:to] - first
        value = _VALUES[data[first:last]]
        within = np.arange(last - first) - np.repeat(begin, np.diff(np.append(begin, last - first)))
        power = _powers(int(within.max()) + 1)
        out[at:to] = np.add.reduceat(value * power[within], begin)
        at = to
    return mix(out + (ends - starts).astype(np.uint64) * _BASE)


def word_hashes(text: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, hashes of their words, offsets of rows in them), piece by piece."""
    data, offsets = text_bytes(text)
    row = 0
    while row < len(text):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1)
        a, b = offsets[row], offsets[end]
        piece = data[a:b]
        inside = _IS_WORD[piece]
        # a row's edge ends a word as a space does
        cut = np.zeros(b - a + 1, bool)
        cut[offsets[row : end + 1] - a] = True
        before = np.append(False, inside[:-1]) if b > a else inside
        after = np.append(inside[1:], False) if b > a else inside
        starts = np.flatnonzero(inside & (~before | cut[:-1]))
        ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
        hashed = _hashes(piece, starts, ends) if len(starts) else np.zeros(0, np.uint64)
        yield row, end, hashed, np.searchsorted(starts, offsets[row : end + 1] - a)
        row = end


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words; a shorter text is one run."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    h = np.full(n, size, np.uint64)
    for i in range(size):
        h = mix(h * _BASE + words[i : i + n])
    return np.unique(h)
