"""Sets of 64-bit keys in a fixed number of bits, made region by region in tasks.

A bitmap says of a key that it may be in the set, or that it is not. Its size does not grow with
the set, so it can be sent to all tasks whatever the corpus; a fuller one says "may be" more often.
"""

from __future__ import annotations

import numpy as np

from tillwarden.llm.text import U64, mix

BITMAP_BITS = 27


class Bitmap:
    """2**BITMAP_BITS bits: two per key, both in the slice of the key's region (its first bits)."""

    def __init__(self, region_bits: int, bits: np.ndarray):
        self.region_bits, self.bits = region_bits, bits

    @classmethod
    def empty(cls, region_bits: int) -> Bitmap:
        return cls(region_bits, np.zeros(1 << BITMAP_BITS - 3, np.uint8))

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        inside = BITMAP_BITS - self.region_bits
        first = keys >> U64(64 - BITMAP_BITS)
        other = (first >> U64(inside) << U64(inside)) | mix(keys) & U64((1 << inside) - 1)
        return first, other

    def slice(self, region: int, keys: np.ndarray) -> bytes:
        """The slice of ``region`` with these keys of it."""
        size = 1 << BITMAP_BITS - self.region_bits
        marks = np.zeros(size, bool)
        for place in self.places(keys):
            marks[place.astype(np.int64) - region * size] = True
        return np.packbits(marks, bitorder="little").tobytes()

    def put(self, region: int, content: bytes) -> None:
        size = 1 << BITMAP_BITS - self.region_bits - 3
        self.bits[region * size : (region + 1) * size] = np.frombuffer(content, np.uint8)

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for place in self.places(keys):
            found &= (self.bits[place >> U64(3)] >> (place & U64(7)).astype(np.uint8) & 1).astype(bool)
        return found


def region_of(keys: np.ndarray, region_bits: int) -> np.ndarray:
    return (keys >> U64(64 - region_bits)).astype(np.int64)
