"""Words and word shingles of Arrow text batches, as 64-bit hashes in NumPy.

Words are runs of letters, marks and digits, lower-cased; everything else
separates them.  A text's shingles are its runs of ``n`` consecutive words; a
text of fewer words has one shingle, all of its words; one without words
has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

NOT_WORD = r"[^\p{L}\p{N}\p{M}]+"
CHUNK_BYTES = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def chunks(batches: Iterator[pa.RecordBatch], column: str, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about ``size`` bytes of text (at least a
    row), so that work space does not grow with the session's batch size."""
    for b in batches:
        lengths = np.asarray(pc.fill_null(pc.binary_length(b[column]), 0), dtype=np.int64)
        part = np.concatenate([[0], np.cumsum(lengths)[:-1]]) // size if len(lengths) else lengths
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), b.num_rows] if b.num_rows else [0, 0]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi > lo:
                yield b.slice(lo, hi - lo)
        pa.default_memory_pool().release_unused()


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words in order, and the offsets at which each text's words start
    (one more than there are texts)."""
    clean = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), NOT_WORD, " ")
    lists = pc.split_pattern(pc.utf8_trim(clean, " "), " ")
    flat, ends = lists.flatten(), np.asarray(pc.list_value_length(lists), dtype=np.int64)
    full = np.asarray(pc.greater(pc.binary_length(flat), 0))
    if not full.all():  # a text without words splits into one empty string
        ends = np.where(ends == 1, np.add.reduceat(full, np.concatenate([[0], np.cumsum(ends)[:-1]])), ends) \
            if len(ends) else ends
        flat = flat.filter(pa.array(full))
    return flat, np.concatenate([[0], np.cumsum(ends)]).astype(np.int64)


def hash_words(flat: pa.Array) -> np.ndarray:
    """A 64-bit hash per word; each distinct word of the batch is hashed once."""
    if not len(flat):
        return np.empty(0, np.uint64)
    coded = flat.dictionary_encode()
    table = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64,
                        len(coded.dictionary))
    return table[np.asarray(coded.indices)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in order, and their offsets per text."""
    sizes = np.diff(offsets)
    counts = np.where(sizes >= n, sizes - n + 1, (sizes > 0).astype(np.int64))
    out_offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    if not len(hashes):
        return np.empty(0, np.uint64), out_offsets
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    power, rolled = np.uint64(1), np.zeros(len(hashes), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            rolled += padded[k: k + len(hashes)] * power
            power = power * _STEP
        start = np.repeat(offsets[:-1], counts) + np.arange(out_offsets[-1]) - np.repeat(out_offsets[:-1], counts)
        out = rolled[start]
        for i in np.flatnonzero((sizes > 0) & (sizes < n)):  # texts of fewer words
            power, h = np.uint64(1), np.uint64(sizes[i])
            for w in hashes[offsets[i]: offsets[i + 1]]:
                h += w * power
                power = power * _STEP
            out[out_offsets[i]] = h
        return mix(out), out_offsets
