"""Hashes of bytes, words and word sequences of a batch of texts, without a loop over them."""

from __future__ import annotations

import functools

import numpy as np

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on every bit (splitmix64)."""
    x = x + U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def salts(count: int, seed: int) -> np.ndarray:
    """Odd 64-bit numbers."""
    return mix(np.arange(count, dtype=U) + U(seed) * U(1_000_003)) | U(1)


@functools.lru_cache(maxsize=1)
def _lower_case() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] = table[97:123]
    return table


@functools.lru_cache(maxsize=1)
def byte_codes() -> np.ndarray:
    """A number for each byte, for the run hashes of :func:`prefix_sums`."""
    return salts(256, 17)


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as many as were asked for."""

    up = down = np.ones(1, U)

    @classmethod
    def get(cls, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < count:
            size = 1 << (count - 1).bit_length()
            inverse = U(pow(int(_BASE), -1, 1 << 64))
            steps = np.full(size, _BASE, U)
            steps[0] = 1
            cls.up = np.multiply.accumulate(steps)
            steps[1:] = inverse
            cls.down = np.multiply.accumulate(steps)
        return cls.up[:count], cls.down[:count]


def word_hash(data: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """Keyed hash of the bytes in each ``[begin, end)``.

    Every block of eight bytes goes through a bijective mix before the next one is added, so the
    repeats inside a word cannot cancel out as they do in a polynomial modulo 2**64.
    """
    blocks = np.ndarray(len(data), "<u8", np.append(data, np.zeros(8, np.uint8)), 0, (1,))
    size = (end - begin).astype(U)
    state = mix(size + salts(1, 17 + seed)[0])
    key = salts(1, 29 + seed)[0]
    live = np.flatnonzero(size > 0)
    at = begin[live]
    while len(live):
        block = blocks[at]
        left = end[live] - at
        short = left < 8
        block[short] &= (U(1) << (left[short].astype(U) * U(8))) - U(1)
        state[live] = mix(state[live] ^ mix(block + key))
        more = left > 8
        live, at = live[more], at[more] + 8
    return state


def prefix_sums(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For :func:`span_hash`: sums of value times power before each place, inverse powers."""
    up, down = _Powers.get(len(values) + 1)
    sums = np.zeros(len(values) + 1, U)
    np.cumsum(values * up[:-1], out=sums[1:])
    return sums, down


def span_hash(sums: np.ndarray, down: np.ndarray, begin: np.ndarray,
              end: np.ndarray) -> np.ndarray:
    """Hash of the values in ``[begin, end)``, wherever they lie in the batch."""
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(U))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts with one blank after each; where each starts; their sizes."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    return data, np.concatenate([[0], np.cumsum(sizes + 1)])[:-1].astype(np.int64), sizes


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end (exclusive) of every run of bytes that are not white space."""
    blank = _BLANK[data]
    edge = np.flatnonzero(np.diff(blank, prepend=True, append=True))
    return edge[::2], edge[1::2]


def words(texts: list[bytes], lower: bool = False, seed: int = 0):
    """Word hashes of all texts, begin and end of the words in the joined bytes, and the number
    of the first word of each text (with the total at the end)."""
    data, starts, _ = joined(texts)
    begin, end = word_bounds(data)
    first = np.searchsorted(begin, starts)
    hashes = word_hash(_lower_case()[data] if lower else data, begin, end, seed)
    return hashes, begin, end, np.append(first, len(begin))


def sequence_hash(hashes: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Hash of every run of ``length`` consecutive word hashes."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.zeros(0, U)
    factors = salts(length, 1000 + seed)
    total = hashes[:count] * factors[0]
    for k in range(1, length):
        total = total + hashes[k:k + count] * factors[k]
    return mix(total)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values."""
    low, span = values, 1
    while span < width and len(low):  # windows of ``span`` are known; two of them cover more
        step = min(span, width - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    return low[:max(0, len(values) - width + 1)]
