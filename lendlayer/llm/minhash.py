"""Shingle sets and circulant MinHash signatures of a batch of texts."""

from __future__ import annotations

import numpy as np

from lendlayer.llm.textkit import U64, Texts, mix, windows, word_hashes, words

#: Places of the two permutations. Two shingles of a text rarely share one, and a shared one
#: only shifts an estimate: links are confirmed on the full sets.
PLACES = 1 << 20
#: Shingles whose coordinates are computed at a time.
BLOCK = 4096

_kept: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def permutations(coordinates: int, seed: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """sigma (which breaks up structure) and pi laid out so that any ``coordinates`` shifts are one slice."""
    if (coordinates, seed) not in _kept:
        dice = np.random.Generator(np.random.PCG64(seed))
        sigma = dice.permutation(PLACES).astype(np.int64)
        pi = dice.permutation(PLACES).astype(np.uint32)
        _kept[coordinates, seed] = sigma, np.concatenate([pi, pi[:coordinates]])
    return _kept[coordinates, seed]


def shingle_sets(texts: Texts, k: int, distinct: bool = True) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text (A-Z lower-cased).

    A text of fewer than ``k`` words has its whole word sequence as one shingle; without
    words the set is empty.
    """
    found = words(texts)
    hashes = word_hashes(texts, found, lower=True)
    shingles, at = windows(hashes, found.row, k)
    cuts = np.searchsorted(found.row[at], np.arange(len(texts) + 1))
    counts = np.diff(found.bounds)
    out = []
    for i, n in enumerate(counts.tolist()):
        if n >= k:
            out.append(np.unique(shingles[cuts[i] : cuts[i + 1]]))
        elif n:
            total = U64(n)
            with np.errstate(over="ignore"):
                for h in hashes[found.bounds[i] : found.bounds[i + 1]]:
                    total = mix(np.array([total * U64(0x9E3779B97F4A7C15) + h], dtype=np.uint64))[0]
            out.append(np.array([total], dtype=np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """All coordinates of a non-empty set: the least value of pi, shifted once more for each."""
    sigma, pi = permutations(coordinates)
    slices = np.lib.stride_tricks.sliding_window_view(pi, coordinates)
    place = sigma[(shingles >> U64(44)).astype(np.int64) & (PLACES - 1)]
    least = None
    for i in range(0, len(place), BLOCK):
        part = slices[place[i : i + BLOCK]].min(axis=0)
        least = part if least is None else np.minimum(least, part)
    return least


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` coordinates (the band's number is part of it)."""
    bands = sig.reshape(-1, rows).astype(np.uint64)
    key = np.arange(1, len(bands) + 1, dtype=np.uint64)
    for j in range(rows):
        key = mix(key * U64(0x9E3779B97F4A7C15) + bands[:, j])
    return key


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart: two sums of independently scrambled shingles."""
    with np.errstate(over="ignore"):
        return int(mix(shingles + U64(7)).sum()), int(mix(shingles ^ U64(0xC2B2AE3D27D4EB4F)).sum())
