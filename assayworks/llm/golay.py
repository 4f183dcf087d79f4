"""The binary Golay code of length 23: every word is at most three bits from exactly one codeword."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

LENGTH, CHECKS = 23, 11
#: Fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Check bits of every message, and for every syndrome the message part of the least error that has it."""
    check = np.arange(1 << (LENGTH - CHECKS)) << CHECKS
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        check = np.where(check >> bit & 1, check ^ (GENERATOR << (bit - CHECKS)), check)
    errors = np.array([sum(1 << b for b in bits) for size in range(4) for bits in combinations(range(LENGTH), size)])
    leader = np.empty(1 << CHECKS, np.int64)
    leader[check[errors >> CHECKS] ^ (errors & ((1 << CHECKS) - 1))] = errors >> CHECKS
    return check, leader


def nearest(words: np.ndarray) -> np.ndarray:
    """The message, 12 bits, of the codeword nearest to each word of 23 bits."""
    check, leader = tables()
    high = words >> CHECKS
    return high ^ leader[check[high] ^ (words & ((1 << CHECKS) - 1))]


def nearby(words: np.ndarray, bits: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """The distinct messages nearest to each word or to a word one bit away, one or six of them, and the places of their words.

    Two words at most two bits apart share one of them, and the nearest message of a word is among those of all words
    one bit away. ``bits`` are the low bits that can differ.
    """
    near = np.stack([nearest(words), *(nearest(words ^ (1 << b)) for b in range(bits))], 1)
    near.sort(axis=1)
    fresh = np.ones(near.shape, bool)
    fresh[:, 1:] = near[:, 1:] != near[:, :-1]
    return near[fresh], np.nonzero(fresh)[0]
