"""Words of a text and hashes of its shingles, vectorised over the bytes."""

from __future__ import annotations

import numpy as np

WORDS = 5  # in a shingle, unless said otherwise
_RNG = np.random.RandomState(20240229)
_BYTE = _RNG.randint(0, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # of the base and of its inverse


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that close ones become unrelated."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_STEP, pow(_STEP, -1, 1 << 64))):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(tokens: list[bytes], size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``tokens``."""
    if not tokens:
        return np.zeros(0, np.uint64)
    lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
    data = np.frombuffer(b"".join(tokens), dtype=np.uint8)
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    ends = np.cumsum(lengths)
    starts = ends - lengths
    word = _mixed((sums[ends] - sums[starts]) * down[starts] + lengths.astype(np.uint64))
    count = max(1, len(tokens) - size + 1)
    h = np.full(count, min(len(tokens), size), dtype=np.uint64)
    for k in range(min(size, len(tokens))):
        h = _mixed(h * np.uint64(_STEP) + word[k : k + count])
    return np.unique(h)


