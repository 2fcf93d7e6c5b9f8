"""Two-stage suffix sorting of a byte buffer in numpy, and the repeats that it shows."""

from __future__ import annotations

import numpy as np

WIDTH = 50
#: Bytes up to which suffixes are told apart; more than WIDTH is not needed to find repeats of WIDTH bytes.
DEPTH = 56
#: Stands between segments; it occurs in no UTF-8 text.
SEPARATOR = 0xFF


def words(data: np.ndarray) -> np.ndarray:
    """For each position (and DEPTH beyond the end) the next eight bytes as one big-endian number."""
    w = np.concatenate([data, np.zeros(DEPTH + 8, np.uint8)]).astype(np.uint64)
    for k in (1, 2, 4):
        w = (w[:-k] << np.uint64(8 * k)) | w[k:]
    return w


def suffix_order(data: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in the order of their first DEPTH bytes.

    Only suffixes that are smaller than their successor are sorted directly. Every other suffix is a byte in front of a
    smaller suffix, so scanning the buckets of first bytes upwards meets its successor first and puts it at the next
    free place of the front part of its own bucket.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    changes = np.nonzero(data[:-1] != data[1:])[0]
    nearest = np.searchsorted(changes, np.arange(n))  # the next change at or after each position
    larger = np.ones(n, bool)  # the end of the buffer is smaller than anything
    inner = nearest < len(changes)
    at = changes[nearest[inner]]
    larger[inner] = data[at] > data[at + 1]

    direct = sorted_directly(np.nonzero(~larger)[0], w)
    front, back = np.bincount(data[larger], minlength=256), np.bincount(data[~larger], minlength=256)
    first = np.append(0, np.cumsum(front + back)[:-1])
    order, free, taken = np.empty(n, np.int64), first.copy(), 0
    for c in np.nonzero(back)[0]:
        order[first[c] + front[c] : first[c] + front[c] + back[c]] = direct[taken : taken + back[c]]
        taken += back[c]
    order[free[data[-1]]] = n - 1
    free[data[-1]] += 1
    for c in np.nonzero(front + back)[0]:
        low = first[c]
        while low < free[c]:  # runs of one byte grow backwards within the bucket
            before = order[low : free[c]] - 1
            low = free[c]
            before = before[before >= 0]
            before = before[data[before] == c]
            order[low : low + len(before)] = before
            free[c] = low + len(before)
        before = order[first[c] : first[c] + front[c] + back[c]] - 1
        before = before[before >= 0]
        before = before[data[before] > c]
        heads = data[before]
        before = before[np.argsort(heads, kind="stable")]
        at = 0
        for head, count in zip(*np.unique(heads, return_counts=True), strict=True):
            order[free[head] : free[head] + count] = before[at : at + count]
            free[head] += count
            at += count
    return order


def sorted_directly(starts: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Starts by their DEPTH bytes: all by sixteen bytes, then those that still tie by the others within their group."""
    starts = starts[np.lexsort((w[starts + 8], w[starts]))]
    same = (w[starts[1:]] == w[starts[:-1]]) & (w[starts[1:] + 8] == w[starts[:-1] + 8])
    tied = np.nonzero(np.append(same, False) | np.append(False, same))[0]
    group = np.cumsum(np.append(True, ~same))[tied] if len(starts) else tied
    again = starts[tied]
    starts[tied] = again[np.lexsort([*[w[again + k] for k in range(DEPTH - 8, 8, -8)], group])]
    return starts


def common_prefixes(order: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Bytes, WIDTH at most, that each suffix shares with the one before it in the order; 0 for the first."""
    shared = np.zeros(len(order), np.int64)
    going = np.arange(1, len(order))
    for k in range(0, DEPTH, 8):
        differ = w[order[going] + k] ^ w[order[going - 1] + k]
        shared[going] += 8
        ended = differ != 0
        shared[going[ended]] -= 1 + sum((differ[ended] >= np.uint64(1 << (8 * b))).astype(np.int64) for b in range(1, 8))
        going = going[~ended]
    return np.minimum(shared, WIDTH)


def repeats(data: np.ndarray, ends: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For segments of `data` (each followed by a separator at `ends`) of the documents `docs`: a mask of the starts of
    WIDTH-byte strings that a smaller document also has, a mask of all starts that fit their segment, and the words."""
    w = words(data)
    order = suffix_order(data, w)
    sizes = np.diff(np.append(-1, ends))
    fits = np.repeat(ends, sizes) - np.arange(len(data)) >= WIDTH
    owner = np.repeat(docs, sizes)
    starts = np.nonzero(common_prefixes(order, w) < WIDTH)[0]
    sizes = np.diff(np.append(starts, len(order)))
    smallest = np.repeat(np.minimum.reduceat(owner[order], starts), sizes)
    found = np.zeros(len(data), bool)
    found[order] = owner[order] > smallest
    return found & fits, fits, w


def spans(starts: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the strings of `width` bytes that begin at the ascending `starts`."""
    if not len(starts):
        return starts, starts
    cut = np.nonzero(np.diff(starts) > width)[0]
    return starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)] + width
