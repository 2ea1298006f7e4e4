"""Words of whole texts as NumPy arrays, for use inside tasks.

A word is a maximal run of ASCII letters, digits and non-ASCII characters; A-Z are lower-cased.  UTF-8 bytes of
non-ASCII characters are all >= 0x80, so the rule can be applied to bytes without decoding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts that a task takes at once, bytes; a longer text is worked on in pieces of so many.
SLICE_BYTES = 1 << 19


def _fold_table() -> bytes:
    out = bytearray(b" " * 256)
    for b in range(256):
        low = b + 32 if 65 <= b <= 90 else b
        if 48 <= low <= 57 or 97 <= low <= 122 or low >= 128:
            out[b] = low
    return bytes(out)


#: Byte -> lower-cased word byte, or a blank.
FOLD = _fold_table()


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over the whole word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_table(n: int) -> np.ndarray:
    base = np.full(n, 0x9E3779B97F4A7C15, np.uint64)
    base[0] = 1
    return np.cumprod(base, dtype=np.uint64)


_POWERS = _power_table(256)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        _POWERS = _power_table(2 * n)
    return _POWERS


def carried(carry: tuple[str, ...], *own: str) -> tuple[str, ...]:
    """Columns to carry along, without those whose names the result takes for itself."""
    return tuple(c for c in dict.fromkeys(carry) if c.lower() not in {x.lower() for x in own})


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as bytes) in pieces of about ``limit`` bytes; a longer text is a piece of its own."""
    held: list[bytes] = []
    start = size = 0
    for i, v in enumerate(column):
        b = v.as_py()
        b = b"" if b is None else b if isinstance(b, bytes) else b.encode()
        if held and size + len(b) > limit:
            yield start, held
            start, held, size = i, [], 0
        held.append(b)
        size += len(b) + 1
    if held:
        yield start, held


def _whole_words(text: bytes, limit: int) -> Iterator[bytes]:
    """A folded text in pieces of about ``limit`` bytes, cut at blanks."""
    at = 0
    while len(text) - at > limit:
        cut = text.find(b" ", at + limit)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each text; long texts are read in pieces."""
    if sum(map(len, texts)) <= 2 * SLICE_BYTES:
        return _hashed([t.translate(FOLD) for t in texts])
    counts = np.zeros(len(texts), np.int64)
    hashes = [np.zeros(0, np.uint64)]
    for i, t in enumerate(texts):
        for piece in _whole_words(t.translate(FOLD), SLICE_BYTES):
            h, n = _hashed([piece])
            hashes.append(h)
            counts[i] += n[0]
    return np.concatenate(hashes), counts


def _hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    inside = data != 32
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum()), dtype=np.int64) - np.repeat(first, sizes)
    value = (data[inside].astype(np.uint64) + np.uint64(1)) * _powers(int(sizes.max()))[at]
    hashes = mix(np.add.reduceat(value, first) + sizes.astype(np.uint64))
    counts = np.searchsorted(starts, np.cumsum(lengths)) - np.searchsorted(starts, np.cumsum(lengths) - lengths)
    return hashes, counts


def shingles(words: np.ndarray, counts: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, and their number per text; a shorter text with words has one shingle."""
    n = np.where(counts == 0, 0, np.maximum(1, counts - width + 1))
    if len(counts) == 1 and len(words) >= width:
        out = np.full(int(n[0]), 0x5EED, np.uint64)
        for j in range(width):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[j : j + len(out)])
        return out, n
    doc = np.repeat(np.arange(len(counts)), n)
    begin = np.cumsum(counts) - counts
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + begin[doc]
    end = (begin + counts)[doc]
    out = np.full(len(at), 0x5EED, np.uint64)
    for j in range(width):
        here = at + j
        inside = here < end
        w = np.where(inside, words[np.minimum(here, max(len(words) - 1, 0))], 0) if len(words) else np.zeros(0, np.uint64)
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + w)
    return out, n
