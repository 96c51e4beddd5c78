"""Suffix arrays of many texts side by side, by induced sorting.

The texts of a batch have one length and are worked off in step: column j of
every array belongs to text j, and each step of a scan moves all texts by one
place. So the sequential scans of induced sorting run as vector operations.
"""

from __future__ import annotations

import numpy as np


def _places(text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First place, and the one past the last, of each letter's bucket, per text."""
    n, texts = text.shape
    flat = text.astype(np.int64) * texts + np.arange(texts)
    ends = np.bincount(flat.ravel(), minlength=size * texts).reshape(size, texts).cumsum(axis=0)
    starts = np.zeros_like(ends)
    starts[1:] = ends[:-1]
    return starts, ends


def _induce(text: np.ndarray, small: np.ndarray, starts: np.ndarray, ends: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Sort all suffixes from an order of the leftmost-smaller ones (-1 pads its ends).

    A place is kept as its index in an array (n + 1, texts) whose row 0 stands
    before all places. The letters of that row belong to no bucket, and slots
    not filled yet point to place 0, so a step needs no other test than whether
    the place before has a bucket of the class that the scan fills.
    """
    n, texts = text.shape
    columns = np.arange(texts)
    buckets = np.full((n + 1, texts), -1)
    buckets[1:] = text.astype(np.int64) * texts + columns
    slots = np.tile(columns + texts, n)
    rows = slots.reshape(n, texts)

    free = (ends * texts + columns).ravel()
    flat = buckets.ravel()
    seeds = np.where(order < 0, columns, (order + 1) * texts + columns)
    for seed in seeds[::-1]:
        bucket = flat[seed]
        (has,) = (bucket >= 0).nonzero()
        bucket = bucket[has]
        slot = free[bucket] - texts
        free[bucket] = slot
        slots[slot] = seed[has]

    marks = np.concatenate([np.zeros((1, texts), bool), small])
    larger = np.where(marks, -1, buckets).ravel()
    free = (starts * texts + columns).ravel()
    for i in range(n):
        before = rows[i] - texts
        bucket = larger[before]
        (has,) = (bucket >= 0).nonzero()
        bucket = bucket[has]
        slot = free[bucket]
        free[bucket] = slot + texts
        slots[slot] = before[has]
    smaller = np.where(marks, buckets, -1).ravel()
    free = (ends * texts + columns).ravel()
    for i in range(n - 1, -1, -1):
        before = rows[i] - texts
        bucket = smaller[before]
        (has,) = (bucket >= 0).nonzero()
        bucket = bucket[has]
        slot = free[bucket] - texts
        free[bucket] = slot
        slots[slot] = before[has]
    return rows // texts - 1


def suffix_arrays(text: np.ndarray, size: int) -> np.ndarray:
    """Suffix arrays (n, texts) of the columns of ``text`` (n, texts).

    Letters are 0 to size - 1; each column ends with its only 0. Suffixes are
    classed as smaller or larger than the next one; the substrings from one
    leftmost-smaller place to the next are sorted by inducing, named, and the
    text of names is sorted in turn; its order induces that of all suffixes.
    """
    n, texts = text.shape
    if n == 1:
        return np.zeros((1, texts), np.int64)
    small = np.ones((n, texts), bool)
    rises, stays = text[:-1] < text[1:], text[:-1] == text[1:]
    for i in range(n - 2, -1, -1):
        small[i] = rises[i] | (stays[i] & small[i + 1])
    leftmost = small.copy()
    leftmost[0] = False
    leftmost[1:] &= ~small[:-1]
    starts, ends = _places(text, size)

    # Leftmost-smaller places in text order, column by column.
    column, place = np.nonzero(leftmost.T)
    counts = np.bincount(column, minlength=texts)
    most = int(counts.max())
    row = np.arange(len(place)) - np.repeat(np.cumsum(counts) - counts, counts)
    in_text = np.full((most, texts), -1, np.int64)
    in_text[row, column] = place
    by_substring = _induce(text, small, starts, ends, in_text)

    # Name the substrings in their order; equal neighbours share a name.
    length = np.zeros((n, texts), np.int64)
    length[place[:-1], column[:-1]] = np.where(column[1:] == column[:-1], place[1:] - place[:-1] + 1, 1)
    length[place[-1], column[-1]] = 1
    turned = by_substring.T
    is_leftmost = leftmost.T[np.arange(texts)[:, None], turned]
    owner, _ = np.nonzero(is_leftmost)
    ordered = turned[is_leftmost]
    size_of = length[ordered, owner]
    same = np.concatenate([[False], (owner[1:] == owner[:-1]) & (size_of[1:] == size_of[:-1])])
    open_pairs, step = np.flatnonzero(same), 0
    while len(open_pairs):
        here, there = ordered[open_pairs] + step, ordered[open_pairs - 1] + step
        differ = text[here, owner[open_pairs]] != text[there, owner[open_pairs]]
        same[open_pairs[differ]] = False
        step += 1
        open_pairs = open_pairs[~differ & (size_of[open_pairs] > step)]
    new = (~same).astype(np.int64)
    first = np.cumsum(counts) - counts
    names = np.cumsum(new)
    names -= np.repeat(names[first], counts)
    kinds = np.zeros(texts, np.int64)
    np.maximum.at(kinds, owner, names + 1)

    if (kinds == counts).all():
        sorted_leftmost = np.full((most, texts), -1, np.int64)
        sorted_leftmost[row, owner] = ordered
    else:
        # Shorter texts of names get a front of a letter above all of theirs.
        named = np.empty((n, texts), np.int64)
        named[ordered, owner] = names
        shorter = np.broadcast_to(kinds, (most, texts)).copy()
        lead = most - counts
        shorter[row + lead[column], column] = named[place, column]
        ranks = suffix_arrays(shorter, int(kinds.max()) + 1) - lead
        real = np.arange(most)[:, None] < counts
        chosen = in_text[np.where(real, ranks, 0), np.arange(texts)]
        sorted_leftmost = np.where(real, chosen, -1)
    return _induce(text, small, starts, ends, sorted_leftmost)


# Letters of the texts worked off in step: enough of them to make a step worth its
# calls, and few enough to stay near the processor.
_IN_STEP = 1 << 20


def byte_suffix_arrays(data: np.ndarray) -> np.ndarray:
    """Suffix arrays (n, texts) of byte texts (texts, n), without the empty suffix."""
    step = max(64, _IN_STEP // data.shape[1])
    parts = [_byte_suffix_arrays(data[at : at + step]) for at in range(0, len(data), step)]
    return np.concatenate(parts, axis=1)


def _byte_suffix_arrays(data: np.ndarray) -> np.ndarray:
    texts, n = data.shape
    letters = np.zeros((n + 1, texts), np.int32)
    letters[:n] = data.T.astype(np.int32) + 1
    return suffix_arrays(letters, 257)[1:]


def permuted_common_prefixes(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Per place of the texts (texts, n): bytes shared with the suffix sorted before it.

    In text order, counted in whole words of eight bytes and from ``length`` on
    as ``length``. Beyond a text's end bytes count as 0.
    """
    texts, n = data.shape
    wide = np.zeros((texts, n + length + 16), np.uint8)
    wide[:, :n] = data
    words = np.zeros(wide.shape, np.uint64)
    for i in range(8):
        words[:, : wide.shape[1] - i] |= wide[:, i:].astype(np.uint64) << np.uint64(8 * i)
    flat, across = words.ravel(), wide.shape[1]
    found = np.zeros((texts, n), np.int64)
    turned = order.T
    base = np.arange(texts)[:, None] * across
    here = (turned[:, 1:] + base).ravel()
    there = (turned[:, :-1] + base).ravel()
    place = (turned[:, 1:] + np.arange(texts)[:, None] * n).ravel()
    out = found.ravel()
    for step in range(0, length, 8):
        same = flat[here + step] ^ flat[there + step]
        if length - step < 8:
            same &= np.uint64((1 << 8 * (length - step)) - 1)
        go_on = same == 0
        here, there, place = here[go_on], there[go_on], place[go_on]
        out[place] = min(step + 8, length)
    return found
