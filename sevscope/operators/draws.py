"""The uniform numbers that Spark's samplers draw (``XORShiftRandom.nextDouble``), many at a time.

A stream is one seed's. Its state after n steps is linear in its bits, so lanes that start further on in the stream are
found by jumps and step side by side.
"""
from __future__ import annotations

import functools

import numpy as np

#: Lanes of a stream, and numbers of a lane in one batch.
LANES, ROWS = 64, 64
_LOW = 0xFFFFFFFF


def _murmur(words: list[int], seed: int) -> int:
    h = seed
    for k in words:
        k = k * 0xCC9E2D51 & _LOW
        k = (k << 15 | k >> 17) * 0x1B873593 & _LOW
        h ^= k
        h = (h << 13 | h >> 19) & _LOW
        h = h * 5 + 0xE6546B64 & _LOW
    h ^= 4 * len(words)
    h = (h ^ h >> 16) * 0x85EBCA6B & _LOW
    h = (h ^ h >> 13) * 0xC2B2AE35 & _LOW
    return h ^ h >> 16


def first_state(seed: int) -> int:
    """The state that ``XORShiftRandom`` starts from (``hashSeed``)."""
    data = (seed & (1 << 64) - 1).to_bytes(8, "big")
    words = [int.from_bytes(data[i:i + 4], "little") for i in (0, 4)]
    low = _murmur(words, 0x3C074A61)
    return _murmur(words, low) << 32 | low


def _step(state: np.ndarray) -> np.ndarray:
    state = state ^ (state << np.uint64(21))
    state ^= state >> np.uint64(35)
    state ^= state << np.uint64(4)
    return state


def _jump(image: np.ndarray, state: np.ndarray) -> np.ndarray:
    """``state`` after the steps that take bit i to ``image[i]``."""
    out = np.zeros_like(state)
    for bit in range(64):
        out ^= image[bit] * (state >> np.uint64(bit) & np.uint64(1))
    return out


@functools.cache
def _jumps() -> list[np.ndarray]:
    """Images of the bits after 1, 2, 4, ... LANES lanes of numbers (two steps a number)."""
    image = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for _ in range(2 * ROWS):
        image = _step(image)
    images = [image]
    while 1 << len(images) <= LANES:
        images.append(_jump(images[-1], images[-1]))
    return images


class Draws:
    """One stream for each of ``seeds``; ``take(n)`` has the next n numbers of each."""

    def __init__(self, seeds: list[int]):
        self.state = np.array([first_state(s) for s in seeds], dtype=np.uint64)
        self.left = np.empty((len(seeds), 0))

    def _batch(self) -> np.ndarray:
        *doubling, whole = _jumps()
        lanes = self.state[:, None]
        for image in doubling:
            lanes = np.concatenate([lanes, _jump(image, lanes)], axis=1)
        self.state = _jump(whole, self.state)
        out = np.empty((*lanes.shape, ROWS))
        for i in range(ROWS):
            high = _step(lanes)
            lanes = _step(high)
            out[:, :, i] = ((high & np.uint64((1 << 26) - 1)) << np.uint64(27)) + (lanes & np.uint64((1 << 27) - 1))
        return out.reshape(len(out), -1) * 2.0 ** -53

    def take(self, n: int) -> np.ndarray:
        batches = [self.left]
        while sum(b.shape[1] for b in batches) < n:
            batches.append(self._batch())
        every = np.concatenate(batches, axis=1) if len(batches) > 1 else batches[0]
        self.left = every[:, n:]
        return every[:, :n]
