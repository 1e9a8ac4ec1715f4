"""Words and word-window hashes of Arrow text batches, vectorised with numpy.

A word is a run of characters other than space and U+0009..U+000D. Hashes
are 64-bit and depend on the content alone, so every task, run and machine
computes the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Odd multiplier of the window polynomial, and splitmix64's constants.
STEP = np.uint64(0x9E3779B97F4A7C15)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

#: Text bytes handled at once inside a task; bounds its temporary arrays.
CHUNK_BYTES = 4 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: a bijection of uint64 that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``limit`` text bytes (a longer text stands alone)."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(sizes.astype(np.int64)) // limit
    starts = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
    for a, b in zip(starts, np.r_[starts[1:], len(sizes)]):
        yield batch.slice(int(a), int(b - a))


def split_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(ids, vocabulary, offsets): word ids of all texts in a row, their strings, each text's bounds.

    Null and empty texts have no words. ``lower`` folds A-Z only.
    """
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    counts = np.diff(lists.offsets.to_numpy())
    words = lists.flatten()
    full = pc.greater(pc.binary_length(words), 0)
    if not pc.all(full).as_py() and len(words):
        keep = full.to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(counts)), counts)
        counts = np.bincount(owner[keep], minlength=len(counts))
        words = words.filter(full)
    coded = words.dictionary_encode()
    offsets = np.r_[0, np.cumsum(counts)].astype(np.int64)
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, offsets


def hash_strings(words: pa.Array, seed: int = 0) -> np.ndarray:
    """xxh3-64 of each string."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w, seed) for w in words.to_pylist()), np.uint64, len(words))


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, each text's bounds)."""
    ids, vocabulary, offsets = split_words(texts, lower)
    if not len(ids):
        return np.empty(0, np.uint64), offsets
    return hash_strings(vocabulary)[ids], offsets


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` consecutive values (also across text bounds)."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(length):
        out *= STEP
        out += hashes[j : j + n]
    return mix(out)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` consecutive values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        if len(values) <= step:
            return values[:0]
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values
