"""Word and shingle hashes of one text, with NumPy, inside tasks."""

from __future__ import annotations

import functools

import numpy as np

U64 = np.uint64
_GENERATOR = np.random.Generator(np.random.PCG64(20_240_613))
_BYTE_VALUE = _GENERATOR.integers(1, 2**63, 256, dtype=U64) * U64(2) + U64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_VALUE[_BLANK] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LOWER_VALUE = _BYTE_VALUE[_LOWER]
_BASE = U64(0x9E3779B97F4A7C15)
_PLACES = _GENERATOR.integers(1, 2**63, 64, dtype=U64) * U64(2) + U64(1)


@functools.lru_cache(maxsize=1)
def _powers_up_to(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    inverse = U64(pow(int(_BASE), -1, 2**64))
    with np.errstate(over="ignore"):
        up, down = np.full(size, _BASE), np.full(size, inverse)
        up[0] = down[0] = 1
        return np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers_up_to(1 << max(16, int(size).bit_length()))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of UTF-8 bytes."""
    edges = np.empty(len(data) + 2, bool)
    edges[0] = edges[-1] = False
    np.logical_not(_BLANK[data], out=edges[1:-1])
    turns = np.flatnonzero(edges[1:] != edges[:-1])
    return turns[::2], turns[1::2]


def word_hashes(text: bytes | None, lower: bool = True) -> np.ndarray:
    """One 64-bit hash for each word, A-Z as a-z if lower."""
    if not text:
        return np.empty(0, U64)
    data = np.frombuffer(text, np.uint8)
    return hashes_at(data, word_bounds(data)[0], lower)


def hashes_at(data: np.ndarray, starts: np.ndarray, lower: bool = True) -> np.ndarray:
    """The hashes of the words that start there; a word's place does not matter."""
    if not len(starts):
        return np.empty(0, U64)
    up, down = powers(len(data))
    values = (_LOWER_VALUE if lower else _BYTE_VALUE)[data]
    values *= up[: len(data)]
    return mix(np.add.reduceat(values, starts) * down[starts])


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of `size` words in order; of the whole sequence if it
    is shorter; none without words."""
    n = len(words)
    if n == 0:
        return words
    runs = max(1, n - size + 1)
    total = np.full(runs, U64(min(n, size)))
    for k in range(min(n, size)):
        total += words[k : k + runs] * _PLACES[k]
    return mix(total)


def _mixed(x: int) -> int:
    """mix() of one number, as a signed one."""
    x &= 2**64 - 1
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB % 2**64
    x ^= x >> 31
    return x - 2**64 if x >> 63 else x


def sequence_key(words: np.ndarray) -> int:
    """A signed 64-bit hash of a whole sequence of words."""
    up, _ = powers(len(words))
    return _mixed(int(np.sum(words * up[: len(words)], dtype=U64)) + len(words))


def sequence_hash(words: np.ndarray) -> tuple[int, int]:
    """Two such hashes."""
    up, _ = powers(len(words))
    second = np.sum(mix(words ^ _PLACES[0]) * up[: len(words)], dtype=U64)
    return sequence_key(words), _mixed(int(second))


def minhashes(shingles: np.ndarray, xors: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The least of ((s ^ xor) * factor) over the shingles, for each hash function."""
    best = np.full(len(xors), U64(2**64 - 1))
    for at in range(0, len(shingles), 2048):
        block = (shingles[None, at : at + 2048] ^ xors[:, None]) * factors[:, None]
        np.minimum(best, block.min(axis=1), out=best)
    return best


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of `width` values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, U64(2**64 - 1))
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])
