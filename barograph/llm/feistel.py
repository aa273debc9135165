"""Keyed permutations of integers below any size, by a Feistel network and cycle walking."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from functools import lru_cache

ROUNDS = 10


class Permutation:
    """Permutes numbers below ``size`` under a key; each ``tag`` has its own permutation."""

    def __init__(self, key: bytes):
        if not key:
            raise ValueError("a key is needed")
        self.key = hashlib.blake2b(key, digest_size=32).digest()
        self.of = lru_cache(maxsize=65_536)(self._of)

    def _round(self, tag: str, number: int, half: int, bits: int) -> int:
        size = (bits + 7) // 8
        text = f"{tag}|{number}|{half:x}".encode()
        if size <= 64:
            return int.from_bytes(hashlib.blake2b(text, key=self.key, digest_size=size).digest())
        # As wide as the half, however wide that is, so that every bit of it changes.
        return int.from_bytes(hashlib.shake_256(self.key + text).digest(size))

    def _of(self, tag: str, value: int, size: int) -> int:
        """The image of ``value``: in the network's power of two, walked back below ``size``."""
        bits = max(1, ((size - 1).bit_length() + 1) // 2)
        mask = (1 << bits) - 1
        while True:
            left, right = value >> bits, value & mask
            for number in range(ROUNDS):
                left, right = right, left ^ self._round(tag, number, right, bits) & mask
            value = left << bits | right
            if value < size:
                return value

    def within(self, tag: str, value: int, size: int, valid: Callable[[int], bool]) -> int:
        """A permutation of the valid numbers alone: walks on to the next valid one."""
        while True:
            value = self.of(tag, value, size)
            if valid(value):
                return value

    def digits(self, tag: str, values: Sequence[int], radices: Sequence[int]) -> list[int]:
        """Permute a number in mixed radix, such as the letters and digits of a name."""
        size, value = 1, 0
        for digit, radix in zip(values, radices, strict=True):
            size, value = size * radix, value * radix + digit
        if size < 2:
            return list(values)
        value, out = self.of(tag, value, size), []
        for radix in reversed(radices):
            value, digit = divmod(value, radix)
            out.append(digit)
        return out[::-1]
