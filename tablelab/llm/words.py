"""Words of Arrow text columns as 64-bit hashes, computed on whole byte arrays inside tasks.

Both word rules used here are rules on bytes of UTF-8: ASCII bytes either belong to words or separate
them, and every byte above 0x7F belongs to a word. Letters A-Z hash like a-z, so nothing is lower-cased
first. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE = 1 << 20  # bytes hashed at a time; longer single words take a slower way with the same rule


def _byte_class(separators) -> np.ndarray:
    out = np.ones(256, dtype=bool)
    out[list(separators)] = False
    return out


#: Words are runs of anything but ASCII blanks: [^\x20\x09-\x0D]+
BLANK_SEPARATED = _byte_class([0x20, *range(0x09, 0x0E)])
#: Words are runs of digits, letters and non-ASCII characters: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
ALPHANUMERIC = _byte_class([b for b in range(0x80) if not chr(b).isalnum()])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BASE = 0x9E3779B97F4A7C15 | 3
_INVERSE = pow(_BASE, -1, 1 << 64)
_CODES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
_CODES[ord("A") : ord("Z") + 1] = _CODES[ord("a") : ord("z") + 1]
_tables: list[np.ndarray] = []


def _power_tables() -> list[np.ndarray]:
    if not _tables:
        _tables.extend([_powers(_BASE, 2 * SLICE), _powers(_INVERSE, SLICE)])
    return _tables


@dataclass
class Words:
    """Words of a block of texts in order. ``first[d]:first[d+1]`` are those of text ``d``."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    data: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1, dtype=np.int32), self.counts)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its texts; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if len(texts) == 0 or texts.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def hash_words(texts: pa.Array, letters: np.ndarray) -> Words:
    """Find and hash the words of every text of a column."""
    data, offsets = bytes_of(texts)
    inside = letters[data]
    edge = np.empty(len(data), dtype=bool)
    real = offsets[:-1][np.diff(offsets) > 0]
    if len(data):
        edge[0], edge[1:] = True, ~inside[:-1]
        edge[real] = True
        start = np.flatnonzero(inside & edge)
        edge[-1], edge[:-1] = True, ~inside[1:]
        edge[real[1:] - 1] = True
        end = np.flatnonzero(inside & edge) + 1
    else:
        start = end = np.zeros(0, dtype=np.int64)
    hashes = np.empty(len(start), dtype=U64)
    power, inverse = _power_tables()
    cuts = np.searchsorted(start, np.arange(0, len(data) + SLICE, SLICE))
    for i, j in zip(cuts[:-1], cuts[1:]):
        if i == j:
            continue
        lo, hi = int(start[i]), int(end[j - 1])
        long_last = hi - lo > 2 * SLICE - 1 or hi - int(start[j - 1]) > SLICE
        if long_last:
            hashes[j - 1] = _long_word(data[int(start[j - 1]) : hi])
            j -= 1
            if i == j:
                continue
            hi = int(end[j - 1])
        sums = np.zeros(hi - lo + 1, dtype=U64)
        np.cumsum(_CODES[data[lo:hi]] * power[: hi - lo], out=sums[1:])
        hashes[i:j] = (sums[end[i:j] - lo] - sums[start[i:j] - lo]) * inverse[start[i:j] - lo]
    return Words(start, end, mix(hashes), np.searchsorted(start, offsets), data)


def _long_word(data: np.ndarray) -> np.uint64:
    """The same polynomial for a word longer than a slice, piece by piece."""
    power, _ = _power_tables()
    total, factor = 0, 1
    for at in range(0, len(data), SLICE):
        piece = data[at : at + SLICE]
        part = int((_CODES[piece] * power[: len(piece)]).sum(dtype=U64))
        total = (total + part * factor) & 0xFFFFFFFFFFFFFFFF
        factor = factor * pow(_BASE, len(piece), 1 << 64) & 0xFFFFFFFFFFFFFFFF
    return U64(total)


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside one text, and the index of their texts.

    A text of fewer words, but not none, gives its whole sequence as one window.
    """
    n, counts = len(words.hash), words.counts
    keys = mix(np.arange(1, size + 1, dtype=U64) * U64(0xD1342543DE82EF95)) | U64(1)
    out = np.zeros(max(n - size + 1, 0), dtype=U64)
    for k in range(size):
        out += words.hash[k : k + len(out)] * keys[k]
    doc = words.doc
    whole = doc[: len(out)] == doc[size - 1 : size - 1 + len(out)]
    hashes, owners = mix(out[whole]), doc[: len(out)][whole]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        extra = np.empty(len(short), dtype=U64)
        for i, d in enumerate(short):
            run = words.hash[words.first[d] : words.first[d + 1]]
            extra[i] = (run * keys[: len(run)]).sum(dtype=U64) + U64(len(run))
        hashes, owners = np.concatenate([hashes, mix(extra)]), np.concatenate([owners, short.astype(np.int32)])
    return hashes, owners


def blocks(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with at most about ``max_bytes`` of text, at least one row each."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = bytes_of(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + max_bytes, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to
