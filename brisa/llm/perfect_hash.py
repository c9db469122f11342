"""Minimal perfect hash over 128-bit keys, built and probed on whole numpy arrays.

Level by level the remaining keys are hashed into a bit array of about twice their number. A key that is
alone at its bit stays at this level and the rest goes on. A key's index is the number of bits set before its own, over
all levels. That is about three bits a key. A key that was not indexed may get any index, so the caller keeps
a fingerprint (or the key itself) for each index and compares.
"""

from __future__ import annotations

import io

import numpy as np

GAMMA = 2.0
MAX_LEVELS = 48

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> U64(33))


def keys_of(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """High and low half of 16-byte digests."""
    pairs = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def fingerprint(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """32 bits that share nothing with the positions."""
    with np.errstate(over="ignore"):
        return (mix(hi + mix(lo + U64(0x5851F42D4C957F2D))) >> U64(32)).astype(np.uint32)


def _position(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        seed = U64(0x9E3779B97F4A7C15) * U64(2 * level + 1)
        return mix(hi ^ mix(lo + seed)) % U64(size)


class PerfectHash:
    """Index 0 .. n-1 of each of n distinct keys."""

    def __init__(self, words: list[np.ndarray], last: np.ndarray):
        self.words = words
        self.last = last  # keys that no level could place, as pairs in order: none in practice
        self.before = []
        total = 0
        for w in words:
            ones = np.bitwise_count(w).astype(np.int64)
            sums = np.cumsum(ones)
            self.before.append(total + sums - ones)
            total += int(sums[-1])
        self.placed = total

    @classmethod
    def build(cls, hi: np.ndarray, lo: np.ndarray) -> PerfectHash:
        words: list[np.ndarray] = []
        for level in range(MAX_LEVELS):
            if not len(hi):
                break
            size = 64 * max(1, int(np.ceil(GAMMA * len(hi) / 64)))
            at = _position(hi, lo, level, size).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            rest = ~alone[at]
            hi, lo = hi[rest], lo[rest]
        order = np.lexsort((lo, hi))
        return cls(words, np.stack([hi[order], lo[order]], axis=1).astype("<u8"))

    def lookup(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Index of each key; -1 for some keys that are not indexed."""
        out = np.full(len(hi), -1, dtype=np.int64)
        todo = np.arange(len(hi))
        for level, (w, before) in enumerate(zip(self.words, self.before, strict=True)):
            if not len(todo):
                return out
            at = _position(hi[todo], lo[todo], level, 64 * len(w))
            word, bit = (at >> U64(6)).astype(np.int64), at & U64(63)
            value = w[word]
            here = (value >> bit) & U64(1) == U64(1)
            below = np.bitwise_count(value & ((U64(1) << bit) - U64(1))).astype(np.int64)
            out[todo[here]] = (before[word] + below)[here]
            todo = todo[~here]
        for i in todo if len(self.last) else ():
            found = np.flatnonzero((self.last[:, 0] == hi[i]) & (self.last[:, 1] == lo[i]))
            if len(found):
                out[i] = self.placed + found[0]
        return out

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        sizes = np.array([len(w) for w in self.words] + [len(self.last)], dtype="<u4")
        out.write(len(sizes).to_bytes(4, "little"))
        out.write(sizes.tobytes())
        for w in self.words:
            out.write(w.tobytes())
        out.write(self.last.tobytes())
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        n = int.from_bytes(data[:4], "little")
        sizes = np.frombuffer(data, "<u4", n, 4)
        at, words = 4 + 4 * n, []
        for size in sizes[:-1]:
            words.append(np.frombuffer(data, "<u8", int(size), at))
            at += 8 * int(size)
        return cls(words, np.frombuffer(data, "<u8", 2 * int(sizes[-1]), at).reshape(-1, 2))
