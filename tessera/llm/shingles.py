"""Words and word shingles of an Arrow column of texts, as 64-bit hashes, without Python strings.

Words are runs of anything but space, tab, LF, VT, FF and CR, with A-Z in lower case.
All texts of a batch are cut in one pass over their UTF-8 bytes: blanks and capitals are
single bytes there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WIDTH = 5
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
P1, P2, P3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, one to one."""
    h = (h ^ (h >> np.uint64(31))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    return h ^ (h >> np.uint64(32))


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets) of a column of texts; null counts as empty."""
    column = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset)
    content = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return content[places[0] : places[-1]], places - places[0]


def cut_words(content: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, end byte, text number) of every word."""
    full = ~BLANK[content]
    size = len(content)
    edge = np.zeros(size + 1, bool)
    edge[offsets] = True
    before = np.ones(size, bool)
    before[1:] = ~full[:-1]
    after = np.ones(size, bool)
    after[:-1] = ~full[1:]
    starts = np.flatnonzero(full & (before | edge[:-1]))
    ends = np.flatnonzero(full & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def hash_words(content: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes in lower case."""
    low = LOWER[content]
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    at, left = starts[order], lengths[order]
    h = np.full(len(at), P1)
    # Longest first: the words with more than k bytes are a prefix.
    longer = len(at) - np.searchsorted(left[::-1], np.arange(int(left[0]) if len(left) else 0), "right")
    for k, n in enumerate(longer.tolist()):
        h[:n] = (h[:n] ^ low[at[:n] + k]) * P1 + P3
    found = np.empty_like(h)
    found[order] = mix(h)
    return found


def join_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of `width` word hashes."""
    n = len(words) - width + 1
    h = np.full(max(n, 0), np.uint64(width))
    for k in range(width):
        h = (h ^ words[k : k + n]) * P1 + P2 if n > 0 else h
    return mix(h)


def text_shingles(words: np.ndarray) -> np.ndarray:
    """Shingle hashes of one text in order: every five words, or the whole text if it has fewer."""
    return join_hashes(words, min(WIDTH, len(words))) if len(words) else np.zeros(0, np.uint64)


def batch_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes of all texts, bounds: text k has words bounds[k]:bounds[k + 1])."""
    content, offsets = bytes_of(texts)
    starts, ends, number = cut_words(content, offsets)
    return hash_words(content, starts, ends), np.searchsorted(number, np.arange(len(texts) + 1))
