"""Words of many texts hashed at once with numpy, for the operators that compare or count word sequences.

A text's bytes are folded by a table of 256 entries; the hash of a word is a polynomial over its bytes modulo 2**64, taken as the
difference of two running sums, and mixed. Equal words have equal hashes; different words meet with probability about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[9:14] = 32
BLOCK = 1 << 20  # bytes of text that are worked on together


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@cache
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(length, _BASE), np.full(length, _INVERSE)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _power_tables(length: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(20, int(length).bit_length()))


def blocks(texts: list[bytes], most: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes together; a longer text is a range of its own."""
    start = size = 0
    for at, text in enumerate(texts):
        if size and size + len(text) > most:
            yield start, at
            start, size = at, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def read_in_blocks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The rows of a batch with the texts of a binary column, null as empty, in the ranges of ``blocks``; texts are copied as they
    are read, and never those of the whole batch."""
    start = size = 0
    some: list[bytes] = []
    for value in batch.column(column):
        text = value.as_buffer().to_pybytes() if value.is_valid else b""
        if size and size + len(text) > BLOCK:
            yield batch.slice(start, len(some)), some
            start, size, some = start + len(some), 0, []
        some.append(text)
        size += len(text) + 1
    if some:
        yield batch.slice(start, len(some)), some


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of the texts with A-Z in lower case, and where each text's words begin (one
    more entry than texts)."""
    data = _FOLD[np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)]
    word = np.empty(len(data) + 1, bool)
    word[0] = word[-1] = False
    word[1:] = data != 32
    edge = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edge[0::2], edge[1::2]
    lengths = np.fromiter((len(text) + 1 for text in texts), np.int64, len(texts))
    first = np.searchsorted(starts, np.concatenate([[1], 1 + np.cumsum(lengths)]))
    if not len(starts):
        return np.empty(0, np.uint64), first
    up, down = _power_tables(len(data))
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts]), first


def joined(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` neighbouring hashes."""
    if len(hashes) < width:
        return np.empty(0, np.uint64)
    out = np.zeros(len(hashes) - width + 1, np.uint64)
    for k in range(width):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += hashes[k : len(hashes) - width + 1 + k]
    return mix(out)


def shingles(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``width`` neighbouring words of each text, and where each text's begin. A text of fewer words, but one at
    least, has one shingle of all of them."""
    words, first = word_hashes(texts)
    counts = np.diff(first)
    every = joined(words, width)
    n = np.where(counts >= width, counts - width + 1, (counts > 0).astype(counts.dtype))
    bounds = np.concatenate([[0], np.cumsum(n)])
    out = np.empty(bounds[-1], np.uint64)
    owner = np.repeat(np.arange(len(texts)), n)
    at = first[owner] + np.arange(len(out)) - bounds[owner]
    whole = counts[owner] >= width
    out[whole] = every[at[whole]]
    for text in np.flatnonzero((counts > 0) & (counts < width)):
        out[bounds[text]] = joined(words[first[text] : first[text + 1]], counts[text])[0] ^ np.uint64(counts[text])
    return out, bounds


def digests(words: np.ndarray, first: np.ndarray) -> list[bytes | None]:
    """Sixteen bytes that stand for the word sequence of each text; None without words."""
    import hashlib

    return [hashlib.blake2b(words[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(first[:-1], first[1:], strict=True)]
