"""Words of a text and 64-bit hashes of words and word runs, for use inside tasks."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import xxhash

U = np.uint64


class _Hashes(dict):
    """Hash of each word seen so far; forgets all when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Hashes()


def words(text: str | None) -> list[bytes]:
    """Runs of anything but blank and U+0009 to U+000D, A-Z lower-cased: what bytes.split splits at."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, found), dtype=U, count=len(found))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


@lru_cache(maxsize=64)
def multipliers(n: int, seed: int) -> np.ndarray:
    out = np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=U) * U(2) + U(1)
    out.flags.writeable = False  # shared by all callers
    return out


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words, in order; of all words as one run if there are fewer; none without words."""
    n = len(hashes)
    if not n:
        return hashes
    size = min(n, k)
    factors = multipliers(k, 7)
    out = np.full(n - size + 1, U(size), dtype=U)
    for j in range(size):
        out += hashes[j : n - size + 1 + j] * factors[j]
    return mix(out)
