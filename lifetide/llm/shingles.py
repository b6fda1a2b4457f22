"""Word shingles of whole texts in numpy: hashed sets, bitmaps, rarest-first prefixes.

A text's set holds its distinct runs of ``SHINGLE`` words (A-Z lower-cased); a
text of fewer words has its whole sequence as one; no words, no set.  Shingles
are 64-bit hashes.
"""

from __future__ import annotations

import numpy as np

from lifetide.llm.common import mix, words_of

SHINGLE = 5
CELL_BITS = 18             # cells of the frequency sketch


def shingle_hashes(texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles (with repeats) of a batch, and the first of each text (n + 1)."""
    _, _, _, words, first = words_of(texts)
    n_words = np.diff(first)
    count = np.where(n_words >= SHINGLE, n_words - SHINGLE + 1, (n_words > 0).astype(np.int64))
    bound = np.concatenate([[0], np.cumsum(count)])
    owner = np.repeat(np.arange(len(n_words)), count)
    at = first[owner] + np.arange(bound[-1]) - bound[owner]
    length = np.minimum(SHINGLE, n_words[owner])
    padded = np.concatenate([words, np.zeros(SHINGLE, np.uint64)])
    h = length.astype(np.uint64)
    for k in range(SHINGLE):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + np.where(k < length, padded[at + k], np.uint64(0)))
    return h, bound


def cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64((1 << CELL_BITS) - 1)).astype(np.int64)


def needed(a, b, percent: int):
    """Fewest common shingles of sets of sizes a and b that are at least ``percent`` alike."""
    return -(-(percent * (a + b)) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    """Two sets that are alike share one of the first so many shingles of either, in any common order."""
    return n - -(-percent * n // 100) + 1


def rank(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """A common order of all shingles: rare cells first, then by hash."""
    return (levels[cells(hashes)].astype(np.uint64) << np.uint64(58)) | (hashes >> np.uint64(6))


def bitmap_bits(n: int) -> int:
    """Bits of the bitmap of a set of n shingles: a power of two, two to four times n."""
    return max(64, 1 << (2 * n - 1).bit_length())


def bitmap(hashes: np.ndarray, bits: int) -> np.ndarray:
    flags = np.zeros(bits, bool)
    flags[(hashes >> np.uint64(65 - bits.bit_length())).astype(np.int64)] = True
    return np.packbits(flags)


def fold(maps: np.ndarray) -> np.ndarray:
    """Bitmaps (rows of bytes) of half as many bits: a bit is set if either of two neighbours was."""
    flags = np.unpackbits(maps, axis=1)
    return np.packbits(flags[:, 0::2] | flags[:, 1::2], axis=1)


def overlap_bound(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Upper bound of the overlaps of sets a x b from bitmaps (rows of 64-bit words) and sizes:
    every bit that only one has stands for a shingle that only it has."""
    pa, pb = np.bitwise_count(a).sum(axis=1, dtype=np.int64), np.bitwise_count(b).sum(axis=1, dtype=np.int64)
    both = np.zeros((len(a), len(b)), np.int64)
    for w in range(a.shape[1]):
        both += np.bitwise_count(a[:, w, None] & b[None, :, w])
    return np.minimum((na - pa)[:, None] + both, (nb - pb)[None, :] + both)
