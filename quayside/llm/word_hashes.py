"""Words and word shingles of whole columns of text as 64-bit hashes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from quayside.llm.numbers import mix, runs

SLICE_BYTES = 1 << 22
GRAM = 5
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
# Random odd numbers from a rule: one for each byte, one for each place of a shingle.
_OF_BYTE = mix(np.arange(256, dtype=np.uint64))[_LOWER]
_BASE = np.uint64(0xD1342543DE82EF95)
_PLACES = mix(np.arange(1000, 1000 + GRAM, dtype=np.uint64)) | np.uint64(1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins and ends; null counts as empty."""
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return (raw[edges[0] : edges[-1]], edges - edges[0]) if len(edges) else (raw[:0], np.zeros(1, np.int64))


def slices(edges: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of about `most` bytes together, a longer text by itself."""
    first, rows = 0, len(edges) - 1
    while first < rows:
        last = int(np.searchsorted(edges, edges[first] + most, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def word_hashes(raw: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, A-Z as a-z, and the number of words of each text."""
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(edges) - 1, np.int64)
    inside = ~_SPACE[raw]
    head = np.zeros(len(raw) + 1, bool)
    head[edges] = True
    start = inside & (head[:-1] | ~np.append(False, inside[:-1]))
    stop = inside & (head[1:] | ~np.append(inside[1:], False))
    starts, stops = np.flatnonzero(start), np.flatnonzero(stop) + 1
    lengths = stops - starts
    counts = np.diff(np.searchsorted(starts, edges))
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    place = runs(np.zeros(len(starts), np.int64), lengths)
    powers = np.cumprod(np.append(np.uint64(1), np.full(int(lengths.max()), _BASE)))
    terms = _OF_BYTE[raw[inside]] * powers[place]
    heads = np.cumsum(lengths) - lengths
    return mix(np.add.reduceat(terms, heads) + lengths.astype(np.uint64)), counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all five-word shingles, and how many each text has (shorter texts: one of all words)."""
    n = np.where(counts >= GRAM, counts - GRAM + 1, np.minimum(counts, 1))
    begins = np.cumsum(counts) - counts
    at = runs(begins, n)
    size = np.repeat(np.minimum(counts, GRAM), n)
    total = size.astype(np.uint64)
    last = max(len(words) - 1, 0)
    for k in range(GRAM):
        term = words[np.minimum(at + k, last)] * _PLACES[k] if len(words) else np.zeros(0, np.uint64)
        total = total + np.where(size > k, term, np.uint64(0))
    return mix(total), n
