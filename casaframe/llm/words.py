"""Vectorised word hashing inside Python workers.

A group of texts is laid out as one byte buffer; words are found with a
256-entry byte class and hashed with a polynomial in the ring of 64-bit
integers, taken as a difference of prefix sums, so no Python code runs per
word.  Buffers are walked in blocks cut between words: memory stays in
proportion to ``BLOCK``, whatever the length of a text, but for the hashes
themselves (8 bytes a word).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 20
BASE = 0x9E3779B97F4A7C15
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

# Word bytes: all but the ASCII white space; letters, digits and any byte over 0x7F.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALNUM = np.zeros(256, dtype=bool)
for _lo, _hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    ALNUM[_lo:_hi + 1] = True
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[1])
    return x ^ (x >> np.uint64(31))


def pair(a: np.ndarray, b: np.ndarray, kind: int) -> np.ndarray:
    """Ordered combination of two hashes; ``kind`` separates feature families."""
    odd = np.uint64((2 * kind + 1) * BASE & (2**64 - 1) | 1)
    return mix(a * odd + (b ^ np.uint64(kind)))


class WordHasher:
    def __init__(self, word_bytes: np.ndarray):
        self.word = word_bytes
        self.pow = self.inv = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.pow) < n:
            for name, base in (("pow", BASE), ("inv", pow(BASE, -1, 2**64))):
                steps = np.full(n, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def _cuts(self, buf: np.ndarray) -> Iterator[tuple[int, int]]:
        at, n = 0, len(buf)
        while at < n:
            end = min(n, at + BLOCK)
            while end < n and self.word[buf[end]]:
                # back to the last gap of the block, or on to the next one
                gaps = np.flatnonzero(~self.word[buf[at:end]])
                if len(gaps):
                    end = at + int(gaps[-1]) + 1
                    break
                end = min(n, end + BLOCK)
            yield at, end
            at = end

    def hashes(self, buf: np.ndarray, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
        """(start, hash) of every word of the buffer, then a hash of each prefix length."""
        starts, out, heads = [], [], [[] for _ in prefixes]
        for lo, hi in self._cuts(buf):
            part = buf[lo:hi]
            self._powers(len(part) + 1)
            edge = np.diff(np.concatenate(([0], self.word[part].view(np.int8), [0])))
            s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            sums = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * self.pow[:len(part)], out=sums[1:])
            starts.append(s + lo)
            for k, head in zip(prefixes, heads):
                cut = np.minimum(e, s + k)
                head.append(mix((sums[cut] - sums[s]) * self.inv[s] + np.uint64(k << 40)))
            out.append(mix((sums[e] - sums[s]) * self.inv[s] + (e - s).astype(np.uint64)))
        if not out:
            empty = np.zeros(0, dtype=np.uint64)
            return empty.astype(np.int64), empty, *[empty for _ in prefixes]
        return np.concatenate(starts), *map(np.concatenate, [out, *heads])


def groups(texts: list[str | None], fold: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, byte buffer, start of each text) for runs of about BLOCK bytes.

    Every text is followed by a line end, so its bytes (even of an empty text)
    are the non-empty range up to the next start.
    """
    first, size, parts = 0, 0, []
    for i, text in enumerate([*texts, None]):
        last = i == len(texts)
        if parts and (last or size >= BLOCK):
            buf = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
            lens = np.fromiter((len(p) + 1 for p in parts), dtype=np.int64, count=len(parts))
            yield first, buf, np.concatenate(([0], np.cumsum(lens)[:-1]))
            first, size, parts = i, 0, []
        if not last:
            data = (text or "").encode("utf-8", "surrogatepass")
            parts.append(data.translate(LOWER) if fold else data)
            size += len(data) + 1
