"""Addresses of ternary trees in van Emde Boas order.

A tree is cut at half its height: its top comes first, then the trees below it from
left to right, each laid out in the same way. Whatever the size of a memory page, the
way from a leaf to the root crosses few of them.
"""

from __future__ import annotations

from functools import cache

import numpy as np

ARITY = 3


def size(levels: int) -> int:
    """Nodes of a complete tree of so many levels."""
    return (ARITY**levels - 1) // (ARITY - 1)


@cache
def addresses(levels: int, depth: int) -> np.ndarray:
    """Where the nodes of one depth (the root's is 0) lie, from left to right."""
    index = np.arange(ARITY**depth)
    found = np.zeros(len(index), np.int64)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            index = index % ARITY**depth
        else:
            levels, depth = levels - top, depth - top
            inner = ARITY**depth
            found += size(top) + index // inner * size(levels)
            index = index % inner
    return found
