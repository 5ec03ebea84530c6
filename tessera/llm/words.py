"""Words of many texts at once as 64-bit hashes, by numpy passes over their bytes.

A hash is the sum of a random 64-bit number per byte times a power of an odd base for its place, modulo
2**64, then mixed. Two different words agree by chance with a probability of about 2**-58; who needs
certainty compares the bytes, whose places are at hand.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

_GAP = 0x20
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
#: Texts are taken together until they have so many bytes; the passes then stay in the cache.
CHUNK_BYTES = 1 << 18
#: Bytes hashed in one pass; only a longer word makes it longer.
PASS_BYTES = CHUNK_BYTES + 65536


def byte_table(is_gap) -> bytes:
    """A translation of bytes: gaps become one space, A-Z lower case."""
    return bytes(_GAP if is_gap(b) else b + 32 if 65 <= b <= 90 else b for b in range(256))


#: Words [^\x20\x09-\x0D]+ and words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text.
WHITE_SPACE = byte_table(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)
ALPHANUMERIC = byte_table(lambda b: b < 0x80 and not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))


def _splitmix(n: int, seed: int) -> list[int]:
    out, x = [], seed
    for _ in range(n):
        x = (x + _BASE) & _MASK
        z = x
        z = ((z ^ z >> 30) * 0xBF58476D1CE4E5B9) & _MASK
        z = ((z ^ z >> 27) * 0x94D049BB133111EB) & _MASK
        out.append(z ^ z >> 31)
    return out


_NUMBERS = np.array(_splitmix(256, 7), np.uint64)
_NUMBERS[_GAP] = 0
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS.clear()
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(max(n, PASS_BYTES), base, np.uint64)
            p[0] = 1
            np.multiply.accumulate(p, out=p)
            _POWERS.append(p)
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


@dataclass
class Words:
    """offsets: of each text's first word, and the end. bytes, starts, ends: the translated text of all."""

    hashes: np.ndarray
    offsets: np.ndarray
    bytes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def spelled(self, first: int, last: int) -> list[bytes]:
        return self.bytes[self.starts[first] : self.ends[last]].tobytes().split()


def _scan(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    a = np.frombuffer(data, np.uint8)
    word = np.empty(len(a) + 2, bool)
    word[0] = word[-1] = False
    np.not_equal(a, _GAP, out=word[1:-1])
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), a, starts, ends
    if len(a) > PASS_BYTES:  # hashed piece by piece, cut between words
        cuts = np.unique(np.r_[0, np.searchsorted(starts, np.arange(CHUNK_BYTES, len(a), CHUNK_BYTES)), len(starts)])
        return np.concatenate([_hash(a[starts[i] : ends[j - 1]], starts[i:j] - starts[i]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]), a, starts, ends
    return _hash(a, starts), a, starts, ends


def _hash(a: np.ndarray, starts: np.ndarray) -> np.ndarray:
    up, down = _powers(len(a))
    v = _NUMBERS[a]
    v *= up[: len(a)]
    h = np.add.reduceat(v, starts)
    h *= down[starts]
    return mix(h)


def chunks(texts: list[bytes], table: bytes, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first, end, words) for runs of whole texts, in order; every text is in one run."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= chunk_bytes or i == len(texts) - 1:
            run = texts[first : i + 1]
            at = np.cumsum([0, *(len(x) + 1 for x in run)])
            h, a, starts, ends = _scan(b" ".join(run).translate(table) if len(run) > 1 else run[0].translate(table))
            yield first, i + 1, Words(h, np.r_[np.searchsorted(starts, at[:-1]), len(h)], a, starts, ends)
            first, size = i + 1, 0
