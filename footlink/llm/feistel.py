"""Keyed permutations of ``range(n)``: a balanced Feistel network over the
next even number of bits, with cycle walking back into the range."""

from __future__ import annotations

import hashlib

import numpy as np

from footlink.llm import text as T

ROUNDS = 8


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _round(value: int, i: int, bits: int, key: bytes, tweak: bytes) -> int:
    size = (bits + 7) // 8
    data = i.to_bytes(1, "big") + len(tweak).to_bytes(2, "big") + tweak + value.to_bytes(size, "big")
    out = b""
    while len(out) < size:
        out += hashlib.blake2b(data + len(out).to_bytes(4, "big"), key=key, digest_size=64).digest()
    return int.from_bytes(out[:size], "big") & ((1 << bits) - 1)


def _network(x: int, bits: int, key: bytes, tweak: bytes, inverse: bool) -> int:
    left, right = x >> bits, x & ((1 << bits) - 1)
    if inverse:
        for i in reversed(range(ROUNDS)):
            left, right = right ^ _round(left, i, bits, key, tweak), left
    else:
        for i in range(ROUNDS):
            left, right = right, left ^ _round(right, i, bits, key, tweak)
    return left << bits | right


def permute(x: int, n: int, key: bytes, tweak: bytes = b"", inverse: bool = False) -> int:
    """Image of x under the keyed permutation of range(n); any size of n."""
    bits = _half_bits(n)
    x = _network(x, bits, key, tweak, inverse)
    while x >= n:
        x = _network(x, bits, key, tweak, inverse)
    return x


def replace(x: int, n: int, key: bytes, tweak: bytes = b"", inverse: bool = False) -> int:
    """A keyed permutation of range(n) that moves every x (for n > 1): the
    step to the next element in the order that ``permute`` defines."""
    step = -1 if inverse else 1
    return permute((permute(x, n, key, tweak) + step) % n, n, key, tweak, inverse=True)


def permute_array(x: np.ndarray, n: int, seed: int) -> np.ndarray:
    """The same construction for arrays of row numbers (n up to 2 ** 62),
    with a mixing round function."""
    bits = _half_bits(n)
    half = np.uint64(bits)
    mask = np.uint64((1 << bits) - 1)
    keys = T.mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    out = x.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for k in keys:
            left, right = right, left ^ (T.mix(right + k) & mask)
        got = left << half | right
        out[todo] = got
        todo = todo[got >= np.uint64(n)]
    return out.astype(np.int64)
