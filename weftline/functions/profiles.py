"""Profiles: blocks of aligned rows, and the alignment of two of them."""

from __future__ import annotations

import numpy as np

from .codons import Costs

#: Costs of a gap of n columns: OPEN + n * EXTEND, at the ends END_OPEN + n * EXTEND.
OPEN, END_OPEN, EXTEND = 10.0, 5.0, 1.0
SAME, UNLIKE = 5.0, -4.0
_UP, _LEFT, _MORE_UP, _MORE_LEFT = 1, 2, 4, 8


def alphabet(seqs: list[str], protein: bool) -> tuple[str, np.ndarray]:
    """The letters of some strings and the scores of each two of them."""
    letters = "".join(sorted(set("".join(seqs).upper()) - {"-"}))
    if not protein:
        return letters, np.where(np.eye(len(letters), dtype=bool), SAME, UNLIKE)
    table, at = Costs().scores(), [26 if c == "*" else ord(c) - 65 if "A" <= c <= "Z" else 23 for c in letters]
    return letters, table[np.ix_(at, at)].astype(float)


def encoded(seq: str, letters: str) -> np.ndarray:
    """A row of places in ``letters``; one beyond them is a gap."""
    places = {c: k for k, c in enumerate(letters)}
    return np.array([[places.get(c, len(letters)) for c in seq.upper()]], dtype=np.int16).reshape(1, -1)


def _shares(block: np.ndarray, letters: int) -> np.ndarray:
    return np.stack([(block == k).mean(axis=0) for k in range(letters)], axis=1) if block.shape[1] else np.zeros((0, letters))


def merged(a: np.ndarray, b: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Two blocks as one, by the best global alignment of their columns with affine gaps. Gaps within a block stay."""
    gap, n, m = len(scores), a.shape[1], b.shape[1]
    sub = _shares(a, gap) @ scores @ _shares(b, gap).T
    steps = EXTEND * np.arange(m + 1)
    opened = np.where((np.arange(m + 1) == 0) | (np.arange(m + 1) == m), END_OPEN, OPEN)
    h, f, come = -steps - END_OPEN * (steps > 0), np.full(m + 1, -np.inf), np.zeros((n + 1, m + 1), dtype=np.uint8)
    come[0, 1:] = _LEFT | _MORE_LEFT
    for i in range(1, n + 1):
        more = f > h - opened
        f = np.where(more, f, h - opened) - EXTEND
        cell, how = f.copy(), np.where(more, _UP | _MORE_UP, _UP).astype(np.uint8)
        diagonal = h[:-1] + sub[i - 1]
        on = diagonal >= cell[1:]
        cell[1:] = np.where(on, diagonal, cell[1:])
        how[1:][on] &= ~np.uint8(_UP)
        first = END_OPEN if i == n else OPEN
        e = np.full(m + 1, -np.inf)
        e[1:] = np.maximum.accumulate(cell + steps)[:-1] - steps[1:] - first
        further = np.zeros(m + 1, dtype=bool)
        further[2:] = e[1:-1] > cell[1:-1] - first
        left = e > cell
        h = np.where(left, e, cell)
        how[left] = (how[left] & ~np.uint8(_UP)) | _LEFT
        how[further] |= _MORE_LEFT
        come[i] = how
    rows, columns, i, j, state = [], [], n, m, 0
    while i or j:
        state = state or (come[i, j] & (_UP | _LEFT) if i else _LEFT)
        if j == 0 or state == _UP:
            rows.append(i - 1), columns.append(-1)
            state = _UP if come[i, j] & _MORE_UP else 0
            i -= 1
        elif state == _LEFT:
            rows.append(-1), columns.append(j - 1)
            state = _LEFT if come[i, j] & _MORE_LEFT else 0
            j -= 1
        else:
            rows.append(i - 1), columns.append(j - 1)
            i, j = i - 1, j - 1
    rows, columns = np.array(rows[::-1], dtype=int), np.array(columns[::-1], dtype=int)
    wide = lambda block, at: np.where(at >= 0, np.concatenate([block, np.full((len(block), 1), gap, dtype=block.dtype)], axis=1)[:, at], gap)
    return np.concatenate([wide(a, rows), wide(b, columns)]) if len(rows) else np.zeros((len(a) + len(b), 0), dtype=a.dtype)


def guide_tree(places: np.ndarray) -> list[tuple[int, int]]:
    """Merges of the rows of ``places`` (coordinates) by mean distance: pairs of nodes, the k-th merge makes node n + k."""
    n = len(places)
    distance = np.sqrt(np.maximum(((places[:, None, :] - places[None, :, :]) ** 2).sum(axis=2), 0)) if n <= 512 else _distances(places)
    np.fill_diagonal(distance, np.inf)
    node, size, out = list(range(n)), np.ones(n), []
    for k in range(n - 1):
        a, b = divmod(int(distance.argmin()), n)
        a, b = min(a, b), max(a, b)
        out.append((node[a], node[b]))
        mean = (distance[a] * size[a] + distance[b] * size[b]) / (size[a] + size[b])
        distance[a], distance[:, a] = mean, mean
        distance[b], distance[:, b], distance[a, a] = np.inf, np.inf, np.inf
        size[a] += size[b]
        node[a] = n + k
    return out


def _distances(places: np.ndarray) -> np.ndarray:
    square = (places**2).sum(axis=1)
    return np.sqrt(np.maximum(square[:, None] + square[None, :] - 2 * places @ places.T, 0))


def progressive(seqs: list[str], places: np.ndarray, protein: bool) -> list[str]:
    """Strings aligned along the guide tree of their ``places``, profile against profile; equal strings are aligned once."""
    first: dict[str, int] = {}
    for k, s in enumerate(seqs):
        first.setdefault(s, k)
    kept = list(first.values())
    letters, scores = alphabet([seqs[k] for k in kept], protein)
    blocks = [(encoded(seqs[k], letters), [k]) for k in kept]
    for a, b in guide_tree(places[kept]):
        (x, xs), (y, ys) = blocks[a], blocks[b]
        blocks[a] = blocks[b] = None
        blocks.append((merged(x, y, scores), xs + ys))
    if not blocks:
        return []
    block, members = blocks[-1]
    lookup = np.array([*letters, "-"])
    done = {seqs[k]: "".join(lookup[row]) for k, row in zip(members, block, strict=True)}
    return [done[s] for s in seqs]
