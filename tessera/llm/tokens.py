"""Token ids of texts by a public byte-level BPE vocabulary, exactly and fast.

Only a space before a character that isn't white space is sure to start a pre-token, so a text falls
into pieces whose ids don't depend on their neighbours. The pieces of many texts are told apart by
64-bit hashes of their bytes (see words.py), each distinct piece is encoded once per worker, and the ids
are gathered by numpy. Texts with other white space after a space are encoded whole.

The vocabulary has one name for a control id, SPECIAL. It is ordinary text unless a caller asks for special=True.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import tiktoken

from tessera.llm.common import give_back
from tessera.llm.words import _scan

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = 50_257
END = 50_256
SPECIAL = "<|endoftext|>"
#: Distinct pieces that a worker remembers.
REMEMBERED = 1_000_000
CHUNK_BYTES = 1 << 21


class Encoder:
    def __init__(self, ranks: str = RANKS):
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={SPECIAL: END})
        self.widths = np.zeros(VOCABULARY, np.int64)
        self.widths[list(table.values())] = list(map(len, table))
        self._forget()

    def _forget(self) -> None:
        """No pieces known. hashes: sorted; sizes: -1 for a piece that can't stand alone."""
        self.hashes, self.sizes, self.at, self.flat = np.empty(0, np.uint64), np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.uint16)

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        """The ids of a space and each piece, by one call over all pieces; hashes: sorted."""
        alone = [p[0] > 0x20 and (p[0] < 0x80 or not p.decode()[0].isspace()) or p[0] < 9 or 13 < p[0] < 0x1C for p in pieces]
        said = b"".join(b" " + p for p, ok in zip(pieces, alone, strict=True) if ok).decode()
        ids = np.array(self.bpe.encode_ordinary(said), np.uint16)
        sizes = np.full(len(pieces), -1, np.int32)
        ends = np.cumsum([len(p) + 1 for p, ok in zip(pieces, alone, strict=True) if ok])
        sizes[alone] = np.diff(np.searchsorted(np.cumsum(self.widths[ids]), ends, "left") + 1, prepend=0)
        at = (len(self.flat) + np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)).astype(np.int32)
        self.flat = np.concatenate([self.flat, ids])
        merged = np.concatenate([self.hashes, hashes])
        order = np.argsort(merged, kind="stable")
        self.hashes, self.sizes, self.at = merged[order], np.concatenate([self.sizes, sizes])[order], np.concatenate([self.at, at])[order]

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(0, len(self.hashes) - 1))
        return at, self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)

    def encode(self, texts: list[bytes], special: bool = False) -> Iterator[np.ndarray]:
        """The ids of each text, uint16, in order. special: SPECIAL in a text is the id END."""
        first, size = 0, 0
        for i, t in enumerate(texts):
            size += len(t)
            if size >= CHUNK_BYTES or i == len(texts) - 1:
                yield from self._chunk(texts[first : i + 1], special)
                first, size = i + 1, 0

    def _whole(self, text: bytes, special: bool = False) -> np.ndarray:
        return np.array(self.bpe.encode(text.decode(), allowed_special="all") if special else self.bpe.encode_ordinary(text.decode()), np.uint16)

    def _chunk(self, texts: list[bytes], special: bool) -> Iterator[np.ndarray]:
        # The first piece of a text has no space before it; it is encoded by itself.
        heads = [t.partition(b" ") for t in texts]
        named = [special and SPECIAL.encode() in t for t in texts]
        odd = [n or b"  " in t or t.endswith(b" ") for n, t in zip(named, texts, strict=True)]
        rest = [b"" if o else x[2] for x, o in zip(heads, odd, strict=True)]
        h, a, starts, ends = _scan(b" ".join(rest))
        order = np.argsort(h)
        new = np.ones(len(h), bool)
        new[1:] = h[order[1:]] != h[order[:-1]]
        which = np.empty(len(h), np.int64)
        which[order] = np.cumsum(new) - 1
        one = order[new]
        found = self._places(h[one])[1]
        if not found.all():
            if len(self.hashes) > REMEMBERED:
                self._forget()
                found[:] = False
            raw = a.tobytes()
            self._learn(h[one[~found]], [raw[s:e] for s, e in zip(starts[one[~found]].tolist(), ends[one[~found]].tolist(), strict=True)])
        place = self._places(h[one])[0]
        n, begin = self.sizes[place][which], self.at[place][which]
        bad = np.r_[0, np.cumsum(n < 0)]
        n = np.maximum(n, 0)
        to = np.cumsum(n) - n
        total = int(n.sum())
        ids = self.flat[np.arange(total) + np.repeat(begin - to, n)]
        to = np.r_[to, total]
        bounds = np.searchsorted(starts, np.cumsum([0, *(len(x) + 1 for x in rest)]))
        for k, t in enumerate(texts):
            p, q = bounds[k], bounds[k + 1]
            if odd[k] or bad[q] > bad[p] or p == q:
                yield self._whole(t, named[k])
            else:
                yield np.concatenate([self._whole(heads[k][0]), ids[to[p] : to[q]]])


_encoders: dict[str, Encoder] = {}


def encoder(ranks: str = RANKS) -> Encoder:
    """This worker's encoder."""
    if ranks not in _encoders:
        _encoders[ranks] = Encoder(ranks)
    return _encoders[ranks]


def drop_encoders() -> None:
    """Frees this worker's encoders, where no text is left to encode."""
    if _encoders:
        _encoders.clear()
        give_back()
