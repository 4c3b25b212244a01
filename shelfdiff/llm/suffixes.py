"""Byte strings of a text and the suffixes that can match: arrays inside tasks.

A window is a string of ``LENGTH`` bytes. Its anchor is the leftmost smallest hash among the runs of ``GRAM`` bytes in
it, so equal windows have equal anchors at the same place. Neighbouring windows with one anchor form a region. The
suffixes that can match are those in regions whose anchor occurs in two documents, about a third of all in a corpus
with copies; the rest is sieved out by the anchors alone, which are one in eighteen bytes.
"""

from __future__ import annotations

import numpy as np

#: Bytes of a match, bytes of an anchor, bytes a region can have (in words of eight).
LENGTH = 50
GRAM = 16
SPAN = LENGTH - GRAM + 1
WORDS = (SPAN - 1 + LENGTH + 7) // 8
WIDE = 8 * WORDS

_CHUNK = 1 << 17
_U = np.uint64
_ODD = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _ODD[1]
    return x ^ (x >> _U(29))


def _words_at(data: np.ndarray, n: int) -> np.ndarray:
    """The eight bytes from each of the first ``n`` places, as one number."""
    out = np.empty(n, _U)
    for o in range(min(8, n)):
        count = (n - o + 7) // 8
        out[o::8] = np.frombuffer(data.data, "<u8", count=count, offset=o)
    return out


def grams(data: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of the runs of ``GRAM`` bytes from each of the first ``n`` places; ``data`` is longer."""
    word = _words_at(data, n + 8)
    with np.errstate(over="ignore"):
        return _mix((word[:n] ^ (word[:n] >> _U(31))) * _ODD[0] + _mix(word[8:8 + n]) * _ODD[2])


def _token(hashes: np.ndarray) -> np.ndarray:
    """48-bit codes of anchors."""
    with np.errstate(over="ignore"):
        return _mix(hashes * _ODD[2]) >> _U(16)


def tokens_in(content: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """The tokens of regions, from their bytes and the places of their anchors."""
    flat = np.concatenate((content.reshape(-1), np.zeros(GRAM, np.uint8)))
    at = np.arange(len(content)) * content.shape[1] + offset
    gram = np.ascontiguousarray(flat[at[:, None] + np.arange(GRAM)]).view("<u8").astype(_U)
    with np.errstate(over="ignore"):
        return _token(_mix((gram[:, 0] ^ (gram[:, 0] >> _U(31))) * _ODD[0] + _mix(gram[:, 1]) * _ODD[2]))


class Block:
    """Documents of one block, end to end in the order of id and text."""

    def __init__(self, ids: np.ndarray, texts: list[bytes]):
        order = sorted(range(len(texts)), key=lambda i: (ids[i], texts[i]))
        self.order = order
        self.ids = np.asarray(ids, np.int64)[order]
        lengths = np.array([len(texts[i]) for i in order], np.int64)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.data = np.frombuffer(b"".join([texts[i] for i in order]) + bytes(WIDE + 64), np.uint8)
        self.size = int(self.ends[-1]) if len(lengths) else 0

    def regions(self) -> tuple[np.ndarray, ...]:
        """Document, first window, number of windows, place of the anchor and token of every region."""
        parts = [self._regions(c, min(self.size, c + _CHUNK)) for c in range(0, self.size, _CHUNK)]
        if not parts:
            return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, _U),)
        return tuple(np.concatenate(x) for x in zip(*parts))

    def _regions(self, start: int, end: int) -> tuple[np.ndarray, ...]:
        n = end - start
        hashes = grams(self.data[start:], n + SPAN)
        place_bits = _U(21)
        low = (_mix(hashes * _ODD[3]) >> place_bits << place_bits) | np.arange(n + SPAN, dtype=_U)
        least, width = low, 1
        while 2 * width <= SPAN:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[:n], least[SPAN - width:SPAN - width + n])
        anchor = (least & _U((1 << 21) - 1)).astype(np.int64)
        doc = np.searchsorted(self.ends, np.arange(start, end), side="right")
        doc = np.minimum(doc, len(self.ends) - 1)
        inside = self.ends[doc] - np.arange(start, end) >= LENGTH
        opens = inside.copy()
        opens[1:] &= (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | ~inside[:-1]
        first = np.flatnonzero(opens)
        run = np.cumsum(opens) - 1
        count = np.bincount(run[inside], minlength=len(first))
        at = anchor[first]
        return doc[first], first + start, count, at + start, _token(hashes[at])

    def bytes_of(self, first: np.ndarray, count: np.ndarray) -> np.ndarray:
        """(regions, WIDE) bytes, zero behind a region's end."""
        out = self.data[first[:, None] + np.arange(WIDE)]
        out[np.arange(WIDE) >= (count + LENGTH - 1)[:, None]] = 0
        return out


def multikey_sort(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by column after column, and the group (equal rows) of each place in that order.

    Quicksort on several keys with eight-byte characters: rows are sorted by the first character; where several
    agree they are sorted by the next one, and rows that stand alone are never looked at again.
    """
    n = len(columns[0])
    order = np.argsort(columns[0], kind="stable")
    values = columns[0][order]
    opens = np.ones(n, bool)
    opens[1:] = values[1:] != values[:-1]
    for column in columns[1:]:
        group = np.cumsum(opens)
        tied = ~opens
        tied[:-1] |= ~opens[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        rows, of = order[at], group[at]
        value = column[rows]
        again = np.lexsort((value, of))
        order[at] = rows[again]
        value, of = value[again], of[again]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
        opens[at] |= fresh
    return order, np.cumsum(opens) - 1


def words_of(content: np.ndarray) -> list[np.ndarray]:
    """Rows of bytes as columns of eight-byte characters."""
    wide = content if content.shape[1] % 8 == 0 else np.pad(content, ((0, 0), (0, -content.shape[1] % 8)))
    return list(np.ascontiguousarray(wide).view(">u8").astype(_U).T)


def distinct_regions(token, offset, count, content) -> tuple[np.ndarray, np.ndarray]:
    """One row index for each different region, in sorted order, and for each row its region's number."""
    order, group = multikey_sort([token, (offset * 256 + count).astype(_U), *words_of(content)])
    number = np.empty(len(order), np.int64)
    number[order] = group
    if not len(order):
        return order, number
    return order[np.r_[True, group[1:] != group[:-1]]], number


def least_documents(token, offset, count, content, doc, rows: int = 1 << 13) -> tuple[np.ndarray, ...]:
    """For each row the runs (row, from, to, least) of windows and the smallest document that has them.

    Equal regions are settled together. Where a token has one region only, its windows all have the smallest
    document of that region; otherwise the suffixes that start in its regions are sorted, and neighbours that agree
    in ``LENGTH`` bytes share their smallest document.
    """
    pick, number = distinct_regions(token, offset, count, content)
    least = np.full(len(pick), np.iinfo(np.int64).max)
    np.minimum.at(least, number, doc)
    token, offset, count, content = token[pick], offset[pick], count[pick], content[pick]
    opens = np.r_[True, token[1:] != token[:-1]] if len(token) else np.zeros(0, bool)
    alone = opens & np.r_[opens[1:], True] if len(token) else opens
    out = [(np.flatnonzero(alone), np.zeros(alone.sum(), np.int64), count[alone] - 1, least[alone])]
    mixed = np.flatnonzero(~alone)
    cuts = [0]
    while len(mixed) and cuts[-1] < len(mixed):  # whole tokens, about ``rows`` regions at a time
        stop = min(len(mixed), cuts[-1] + rows)
        while stop < len(mixed) and not opens[mixed[stop]]:
            stop += 1
        cuts.append(stop)
    for a, b in zip(cuts, cuts[1:]):
        part = mixed[a:b]
        row = np.repeat(part, count[part])
        step = np.arange(len(row)) - np.repeat(np.cumsum(count[part]) - count[part], count[part])
        found = _least_windows(token[row], offset[row] - step, content, row, step, least[row])
        same = np.r_[False, (row[1:] == row[:-1]) & (found[1:] == found[:-1])]
        head = np.flatnonzero(~same)
        tail = np.r_[head[1:], len(row)] - 1
        out.append((row[head], step[head], step[tail], found[head]))
    region, start, stop, low = (np.concatenate(x) for x in zip(*out))
    order = np.argsort(region, kind="stable")
    region, start, stop, low = region[order], start[order], stop[order], low[order]
    begin, end = np.searchsorted(region, number), np.searchsorted(region, number, side="right")
    rows_ = np.repeat(np.arange(len(number)), end - begin)
    at = np.arange(len(rows_)) - np.repeat(np.cumsum(end - begin) - (end - begin), end - begin) + np.repeat(begin, end - begin)
    return rows_, start[at], stop[at], low[at]


def _least_windows(token, offset, content, row, step, doc) -> np.ndarray:
    """The smallest document of every suffix start, by sorting suffixes on their first ``LENGTH`` bytes."""
    flat = content.reshape(-1)
    padded = np.concatenate((flat, np.zeros(64, np.uint8)))
    base = row * WIDE + step
    columns = [token * _U(64) + offset.astype(_U)]
    for k in range(0, LENGTH, 8):
        value = np.zeros(len(row), _U)
        for byte in range(k, min(k + 8, LENGTH)):
            value = (value << _U(8)) | padded[base + byte].astype(_U)
        columns.append(value)
    order, group = multikey_sort(columns)
    least = np.minimum.reduceat(doc[order], np.flatnonzero(np.r_[True, group[1:] != group[:-1]]))
    out = np.empty(len(row), np.int64)
    out[order] = least[group]
    return out


def windows_of(region: np.ndarray, count: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, ...]:
    """Region, step and 128-bit hash (two numbers) of every window of the regions."""
    row = np.repeat(np.arange(len(region)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    one, two = np.empty(len(row), _U), np.empty(len(row), _U)
    padded = np.concatenate((content.reshape(-1), np.zeros(64, np.uint8)))
    for a in range(0, len(row), _CHUNK):
        base = row[a:a + _CHUNK] * content.shape[1] + step[a:a + _CHUNK]
        h, g = np.full(len(base), _ODD[0]), np.full(len(base), _ODD[3])
        with np.errstate(over="ignore"):
            for k in range(0, LENGTH, 8):
                value = np.zeros(len(base), _U)
                for byte in range(k, min(k + 8, LENGTH)):
                    value = (value << _U(8)) | padded[base + byte].astype(_U)
                h, g = _mix((h ^ value) * _ODD[2]), _mix((g + value) * _ODD[0] ^ (g >> _U(29)))
        one[a:a + _CHUNK], two[a:a + _CHUNK] = h, g
    return region[row], step, one, two


def groups_of(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the windows by hash, where each different one begins in that order, and the number of each window's."""
    order, group = multikey_sort([one, two])
    number = np.empty(len(order), np.int64)
    number[order] = group
    return order, np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(order) else order, number
