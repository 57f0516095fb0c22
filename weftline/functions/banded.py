"""Gapped extension in a band, many pairs at a time."""

from __future__ import annotations

import numpy as np

#: A value packs score, matches and columns, so that the best of two has the higher score, then more matches.
_COUNT = 21
_SCORE = 2 * _COUNT
_NONE = -(1 << 60)
#: Cells of a row over all pairs of a batch.
CELLS = 1 << 17


def pack(score: int, matches: int = 0, columns: int = 0) -> int:
    return (score << _SCORE) + (matches << _COUNT) + columns


def unpack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores, matches and columns."""
    return values >> _SCORE, (values >> _COUNT) & ((1 << _COUNT) - 1), values & ((1 << _COUNT) - 1)


def letters(seq: str, other: int) -> np.ndarray:
    """Bases as bytes; ``other`` stands for all other letters, so that these match nothing where two sides take two values."""
    raw = np.frombuffer(seq.upper().encode("latin-1", "replace"), dtype=np.uint8)
    return np.where(np.isin(raw, np.frombuffer(b"ACGT", dtype=np.uint8)), raw, np.uint8(other))


def extend(queries: list[np.ndarray], targets: list[np.ndarray], half: int, match: int, mismatch: int, gap_open: int, gap_extend: int, x_drop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best alignment from the starts of each pair, not leaving the band of ``half`` diagonals on either side: packed values, and how many
    letters of query and target it takes. A gap of n costs ``gap_open + n * gap_extend``; what falls ``x_drop`` below the best of its
    pair is given up. Letters are bytes from 1 (:func:`letters`). A row of all pairs is a few operations on arrays."""
    many, width = len(queries), 2 * half + 1
    nq, nt = (np.array([len(s) for s in side], dtype=np.int64) for side in (queries, targets))
    rows = int(np.minimum(nq, nt + half).max(initial=0))
    q, t = np.full((many, rows), 255, dtype=np.uint8), np.zeros((many, rows + width), dtype=np.uint8)
    for p in range(many):
        a, b = queries[p][:rows], targets[p][: rows + half + 1]
        q[p, : len(a)], t[p, half : half + len(b)] = a, b
    same, unlike, opened, gap = pack(match, 1, 1), pack(mismatch, 0, 1), pack(-gap_open), pack(-gap_extend, 0, 1)
    steps, drop = gap * np.arange(width, dtype=np.int64), pack(x_drop)
    offsets = np.arange(-half, half + 1)
    h = np.full((many, width), _NONE, dtype=np.int64)
    h[:, half] = 0
    h[:, half + 1 :] = opened + gap * np.arange(1, half + 1)
    h[(offsets[None, :] > nt[:, None]) | (h < -drop)] = _NONE
    f = np.full_like(h, _NONE)
    best, ends, at = np.zeros(many, dtype=np.int64), np.zeros(many, dtype=np.int64), np.zeros(many, dtype=np.int64)
    live = np.arange(many)
    for i in range(rows):
        if i % 16 == 0:
            on = (h > _NONE // 2).any(axis=1) & (nq[live] > i)
            if not on.all():
                live, h, f, q, t = live[on], h[on], f[on], q[on], t[on]
            if not len(live):
                break
        there = t[:, i : i + width]
        step = np.where(q[:, i, None] == there, same, unlike)
        step[there == 0] = _NONE
        step[nq[live] <= i] = _NONE
        f[:, :-1] = np.maximum(h[:, 1:] + (opened + gap), f[:, 1:] + gap)
        f[:, -1] = _NONE
        f[nq[live] <= i] = _NONE
        m = np.maximum(np.maximum(h + step, f), _NONE)
        e = np.maximum.accumulate(m - steps, axis=1)[:, :-1] + steps[1:] + opened
        h = m
        h[:, 1:] = np.maximum(h[:, 1:], e)
        h[(offsets[None, :] > nt[live, None] - i - 1) | (offsets < -i - 1)[None, :]] = _NONE
        top = h.argmax(axis=1)
        value = h[np.arange(len(live)), top]
        better = value > best[live]
        won = live[better]
        best[won], ends[won], at[won] = value[better], i + 1, top[better] - half
        low = (best[live] - drop)[:, None]
        h[h < low] = _NONE
        f[f < low] = _NONE
    return best, ends, ends + at


def through_anchors(pairs: list[tuple[np.ndarray, np.ndarray, int, int, int]], match: int, mismatch: int, gap_open: int, gap_extend: int, x_drop: int) -> list[tuple[int, int, int, int, int, int, int]]:
    """Best alignments through the anchors of (query, target, place in the query, place in the target, half a band):
    score, matches, columns and both ranges (from 0, ends exclusive). Pairs of like bands are extended together."""
    out: list = [None] * len(pairs)
    classes: dict[int, list[int]] = {}
    for k, p in enumerate(pairs):
        classes.setdefault(-(-p[4] // 16) * 16, []).append(k)
    for half, members in classes.items():
        members.sort(key=lambda k: len(pairs[k][0]))
        size = max(1, CELLS // (2 * half + 1))
        for some in (members[a : a + size] for a in range(0, len(members), size)):
            how = (half, match, mismatch, gap_open, gap_extend, x_drop)
            right = extend([pairs[k][0][pairs[k][2] :] for k in some], [pairs[k][1][pairs[k][3] :] for k in some], *how)
            left = extend([pairs[k][0][: pairs[k][2]][::-1] for k in some], [pairs[k][1][: pairs[k][3]][::-1] for k in some], *how)
            score, matches, columns = unpack(right[0] + left[0])
            for n, k in enumerate(some):
                a, b = pairs[k][2], pairs[k][3]
                out[k] = (int(score[n]), int(matches[n]), int(columns[n]), a - int(left[1][n]), a + int(right[1][n]), b - int(left[2][n]), b + int(right[2][n]))
    return out
