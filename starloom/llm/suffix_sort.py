"""Deep-shallow sorting of suffixes, for many groups at once in numpy.

Shallow: multikey quicksort on eight bytes at a time, up to a small depth; a round sorts the
groups of still equal suffixes by their next eight bytes. Deep: a group that is still together has
a long common prefix, so its suffixes go into a blind trie. A trie keeps, for each branch off the
path of the group's first suffix, only the depth and the byte there; one comparison with that
suffix finds a suffix's branch. Suffixes of one branch form a group one level down. Tries of all
groups grow level by level together.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 16
ROWS = 1 << 14


def _eight(buffer: np.ndarray, at: np.ndarray, keep: int) -> np.ndarray:
    """The eight bytes from each place as a big-endian number; bytes beyond ``keep`` count as zero."""
    view = np.ndarray(shape=(len(buffer) - 7,), dtype=">u8", buffer=buffer, strides=(1,))
    out = view[at].astype(np.uint64)
    return out if keep >= 8 else out & np.uint64(((1 << 8 * keep) - 1) << 8 * (8 - keep))


def _first_difference(buffer: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    out = np.empty(len(a), np.int64)
    span = np.arange(depth)
    for s in range(0, len(a), ROWS):
        differs = buffer[a[s:s + ROWS, None] + span] != buffer[b[s:s + ROWS, None] + span]
        out[s:s + ROWS] = np.where(differs.any(1), differs.argmax(1), depth)
    return out


def deep_shallow(buffer: np.ndarray, starts: np.ndarray, depth: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): the suffixes' order by their first ``depth`` bytes, and where in it each set of equal ones begins.

    Every suffix must have ``depth`` bytes in ``buffer``.
    """
    n = len(starts)
    order = np.arange(n)
    first = np.zeros(n, bool)  # flags in sorted order: differs from the one before
    if not n:
        return order, np.flatnonzero(first)
    first[0] = True
    padded = np.concatenate([buffer, np.zeros(8, np.uint8)])
    active = np.arange(n)  # places in the order that belong to groups of two or more
    for at in range(0, min(shallow, depth), 8):
        if not len(active):
            break
        group = np.cumsum(first)[active]
        key = _eight(padded, starts[order[active]] + at, depth - at)
        by = np.lexsort((key, group)) if at else np.argsort(key, kind="stable")
        order[active] = order[active][by]
        key, group = key[by], group[by]
        first[active[1:]] |= (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        active = _together(first)
    while len(active):
        group = np.cumsum(first)[active]
        head = active[np.concatenate([[True], group[1:] != group[:-1]])]
        label = np.cumsum(np.concatenate([[0], group[1:] != group[:-1]]))
        own, lead = starts[order[active]], starts[order[head]][label]
        depth_of = _first_difference(padded, own, lead, depth)
        same = depth_of == depth
        where = np.minimum(depth_of, depth - 1)
        byte, other = padded[own + where].astype(np.int64), padded[lead + where].astype(np.int64)
        # before the leader: shallow branches first; after it: deep ones first; at one depth by the byte
        branch = np.where(same, (depth + 1) << 8, np.where(byte < other, depth_of << 8, (2 * depth + 3 - depth_of) << 8) + byte)
        by = np.lexsort((branch, label))
        order[active] = order[active][by]
        branch, label, same = branch[by], label[by], same[by]
        first[active[1:]] |= (branch[1:] != branch[:-1]) | (label[1:] != label[:-1])
        settled = np.zeros(n, bool)
        settled[active[same]] = True
        together = _together(first)
        active = together[~settled[together] & np.isin(together, active)]
    return order, np.flatnonzero(first)


def _together(first: np.ndarray) -> np.ndarray:
    """Places whose set of equals has two or more members."""
    size = np.diff(np.append(np.flatnonzero(first), len(first)))
    return np.flatnonzero(np.repeat(size > 1, size))
