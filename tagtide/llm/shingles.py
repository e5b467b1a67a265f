"""Words and word shingles of whole texts, as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

SIZE = 5
# Odd multipliers of a 64-bit mixing step.
STEP, MIX, LAST = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def shingles(text: str | None) -> np.ndarray:
    """The set of hashes of five words in a row, sorted; a shorter text is one shingle.

    ``bytes`` lower-cases A-Z alone and splits at the six ASCII blanks alone, as wanted.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) < SIZE:
        if not words:
            return np.zeros(0, dtype=np.uint64)
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    n = len(each) - SIZE + 1
    found = each[:n] * STEP
    for i in range(1, SIZE):
        found = (found ^ (found >> np.uint64(29))) * MIX + each[i : n + i]
    found ^= found >> np.uint64(32)
    found *= LAST
    found ^= found >> np.uint64(29)
    return np.unique(found)
