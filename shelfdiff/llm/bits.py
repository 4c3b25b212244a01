"""Arrays of fingerprints inside tasks: Gray ranks, the hierarchical index, small union-find, word shingles."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import xxhash

FANOUT = 16
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Place of each 64-bit pattern in the Gray code, where neighbours differ in one bit."""
    out = values.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        out = out ^ (out >> np.uint64(shift))
    return out


def word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words of a text, about ``size`` bytes at a time."""
    start = 0
    while start < len(data):
        end = start + size
        if end < len(data):
            gap = _SPACE.search(data, end)
            end = gap.start() if gap else len(data)
        yield data[start:end].split()
        start = end


def shingle_hashes(text: str | None, width: int, size: int = 1 << 20) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of all runs of ``width`` words, in blocks; a shorter text is one run, none has no run.

    A-Z become small, words are joined by one blank.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    data = data.translate(_LOWER)
    digest, kept, any_run = xxhash.xxh64_intdigest, [], False
    for words in word_blocks(data, size):
        words = kept + words
        if len(words) >= width:
            any_run = True
            line = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = np.concatenate(([0], ends[:-1]))[:len(words) - width + 1].tolist()
            stops = (ends[width - 1:] - 1).tolist()
            yield np.array([digest(line[a:b], 42) for a, b in zip(starts, stops)], np.uint64)
        kept = words[-(width - 1):] if width > 1 else []
    if not any_run and kept:
        yield np.array([digest(b" ".join(kept), 42)], np.uint64)


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def set_hash(hashes: np.ndarray) -> int:
    """XXH64 (seed 42) of sorted different hashes, as a name of the set."""
    return xxhash.xxh64_intdigest(hashes.astype("<u8").tobytes(), 42)


def majority_bits(blocks: Iterator[np.ndarray]) -> int:
    """Bits that are set in over half of the hashes; no hash gives zero."""
    counts, n = np.zeros(64, np.int64), 0
    for hashes in blocks:
        for part in np.array_split(hashes, max(1, len(hashes) // 65536)):
            counts += np.unpackbits(part.astype(">u8").view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big") if n else 0


class Forest:
    """Union-find over 0..n-1 on whole arrays of links; labels are smallest members."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            la, lb = self.label[a], self.label[b]
            apart = la != lb
            if not apart.any():
                return
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            np.minimum.at(self.label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                further = self.label[self.label]
                if np.array_equal(further, self.label):
                    break
                self.label = further


def close_pairs(patterns: np.ndarray, radius: int, lead: int, chunk: int = 1 << 16
                ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j), i < j, of patterns with equal ``lead`` first bits and at most ``radius`` bits apart.

    ``patterns`` are 64-bit and sorted by Gray rank. Every 16 neighbours form a node that keeps the bits all of
    them share (mask and value), every 16 nodes a node above. A query goes down the levels with the difference
    gathered so far; at each node only bits that its parent did not share are compared, and a node whose gathered
    difference exceeds the radius, or that shares a differing leading bit, is left with everything below it.
    Queries and nodes are taken ``chunk`` at a time, so memory does not depend on the number of pairs.
    """
    n = len(patterns)
    if n < 2:
        return
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    top = ~(ones >> np.uint64(lead)) if 0 < lead < 64 else (ones if lead else np.uint64(0))
    masks, values = [np.full(n, ones)], [patterns.astype(np.uint64)]
    low, high = values[0], values[0]
    while len(low) > FANOUT:
        at = np.arange(0, len(low), FANOUT)
        low, high = np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at)
        masks.append(~(low ^ high))
        values.append(low & masks[-1])
    levels = len(masks)
    parent = [np.repeat(masks[k + 1], FANOUT)[:len(masks[k])] if k + 1 < levels else np.zeros(len(masks[k]), np.uint64)
              for k in range(levels)]
    fresh = [masks[k] & ~parent[k] for k in range(levels)]
    width = [FANOUT ** k for k in range(levels)]
    roots = np.arange(len(masks[-1]))
    for start in range(0, n, chunk):
        q = np.arange(start, min(n, start + chunk))
        todo = [(levels - 1, np.repeat(q, len(roots)), np.tile(roots, len(q)), np.zeros(len(q) * len(roots), np.uint8))]
        while todo:
            k, i, node, gathered = todo.pop()
            if len(i) > 4 * chunk:
                cut = len(i) // 2
                todo += [(k, i[:cut], node[:cut], gathered[:cut]), (k, i[cut:], node[cut:], gathered[cut:])]
                continue
            differ = (patterns[i] ^ values[k][node]) & fresh[k][node]
            gathered = gathered + np.bitwise_count(differ)
            keep = (gathered <= radius) & ((differ & top) == 0) & ((node + 1) * width[k] - 1 > i)
            i, node, gathered = i[keep], node[keep], gathered[keep]
            if not len(i):
                continue
            if k == 0:
                yield i, node
                continue
            below = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            inside = below < len(masks[k - 1])
            todo.append((k - 1, np.repeat(i, FANOUT)[inside], below[inside], np.repeat(gathered, FANOUT)[inside]))
