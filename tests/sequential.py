"""Literal one-row-at-a-time versions of the ordered operators, for comparison."""

from __future__ import annotations

import math


def first_fit(sizes, boxes):
    """``boxes``: (box_id, capacity or None) from smallest to largest."""
    room = [math.inf if c is None else c for _, c in boxes]
    out = []
    for n in sizes:
        hit = next((i for i, r in enumerate(room) if n <= r), None)
        if hit is not None:
            room[hit] -= n
        out.append(None if hit is None else boxes[hit][0])
    return out


def largest_first(sizes, n):
    """Split of each row: the one with most space, of equal ones that loaded last, at first by number."""
    space, loaded, out = [0] * n, [-s for s in range(n)], [None] * len(sizes)
    for step, row in enumerate(sorted(range(len(sizes)), key=lambda i: -sizes[i]), 1):
        split = max(range(n), key=lambda s: (space[s], loaded[s]))
        space[split] -= sizes[row]
        loaded[split] = step
        out[row] = split
    return out


def next_fit(sizes, n, total=None):
    limit = math.ceil((sum(sizes) if total is None else total) / n)
    split, current, out = 0, 0, []
    for i, size in enumerate(sizes):
        if current + size > limit and i > 0:
            split, current = split + 1, 0
        current += size
        out.append(split)
    return out


def deal(records, maps, ratio):
    """Chunks in batches of 16, the last batch with what remains below 32; rows go round each batch in turn."""
    entries = math.ceil(records / (ratio * maps))
    chunks, widths, out, first = math.ceil(records / entries), [], [], 0
    while chunks >= 32:
        widths.append(16)
        chunks -= 16
    for width in [*widths, chunks]:
        rows = min(width * entries, records - len(out))
        out += [first + i % width for i in range(rows)]
        first += width
    return out
