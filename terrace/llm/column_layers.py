"""Column-wise construction of the suffix order of many strings at once.

The strings of a collection stand one above the other, aligned in columns.  A round takes the next column from
the right and inserts one symbol in front of every string's suffix.  As in every column-wise construction of a
collection's Burrows-Wheeler transform, the new suffixes are ordered by their symbol and, among equal symbols,
by the order that their tails already have: a stable sort.  The common prefix of two neighbours that
share the new symbol is one more than the smallest common prefix between their tails; otherwise it is 0.

Here equal substrings begin in the same column (the strings are aligned at an anchor that both contain), so a
suffix is only ever compared with suffixes of its own round: one layer of the transform is held, and
the work is linear in the symbols.  The collection is read in sequence from a written table, sorted by collection;
collections of a batch stand in one matrix, and a symbol never sorts across their borders.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

OUTSIDE = 256


def repeated_starts(bodies: list[bytes], lead: np.ndarray, group: np.ndarray, weight: np.ndarray, length: int) -> np.ndarray:
    """Boolean matrix: whether the ``length`` bytes of string i from its byte j on also begin, in the same column,
    another string of its group, or a further copy of the string itself (weight above 1).

    ``group`` ascends; ``lead`` is how many bytes stand before the anchor of each string.
    """
    m = len(bodies)
    size = np.fromiter(map(len, bodies), dtype=np.int64, count=m)
    first = int(lead.max()) - lead.astype(np.int64)
    width = int((first + size).max())
    out = np.zeros((m, max(int(size.max()) - length + 1, 1)), dtype=bool)
    sheet = np.full((width, m), OUTSIDE, dtype=np.int16)  # a column is one contiguous row
    flat = np.frombuffer(b"".join(bodies), dtype=np.uint8)
    owner = np.repeat(np.arange(m), size)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size) + first[owner]
    sheet[place, owner] = flat
    order = np.arange(m)
    prefix = np.zeros(m, dtype=np.int64)  # common prefix with the neighbour before
    border = group.astype(np.int64) * (OUTSIDE + 1)
    alone = weight < 2
    last = first + size - length  # the last column in which a whole substring of the string begins
    for column in range(width - 1, -1, -1):
        symbol = sheet[column][order]
        key = border[order] + symbol
        turn = np.argsort(key, kind="stable")
        key = key[turn]
        tied = np.flatnonzero((key[1:] == key[:-1]) & (symbol[turn[1:]] != OUTSIDE))
        fresh = np.zeros(m, dtype=np.int64)
        if len(tied):
            pair = np.empty(2 * len(tied), dtype=np.int64)
            pair[0::2] = turn[tied] + 1
            pair[1::2] = turn[tied + 1] + 1
            fresh[tied + 1] = 1 + np.minimum.reduceat(np.append(prefix, 0), pair)[0::2]
        order, prefix = order[turn], fresh
        long = prefix >= length
        hit = long | np.append(long[1:], False) | ~alone[order]
        who = order[hit]
        who = who[(first[who] <= column) & (column <= last[who])]
        out[who, column - first[who]] = True
    return out


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last index of every run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return [(int(a), int(b) - 1) for a, b in zip(edge[0::2], edge[1::2])]


def batches(rows: Iterator, most: int) -> Iterator[list]:
    """Rows (group first, sorted by it) in lists of about ``most`` rows that never part a group."""
    held: list = []
    for row in rows:
        if len(held) >= most and row[0] != held[-1][0]:
            yield held
            held = []
        held.append(row)
    if held:
        yield held
