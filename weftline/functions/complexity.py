"""Where strings are of low complexity: sliding windows over many strings at a time."""

from __future__ import annotations

import numpy as np

#: Letters that are worked on at a time.
_BLOCK = 1 << 16


def _covered(windows: np.ndarray, width: int, n: int) -> np.ndarray:
    """Letters that a marked window (by its start) covers."""
    ends = np.zeros(n + 1, dtype=np.int64)
    starts = np.flatnonzero(windows)
    np.add.at(ends, starts, 1)
    np.add.at(ends, np.minimum(starts + width, n), -1)
    return np.cumsum(ends[:-1]) > 0


def _window_sums(codes: np.ndarray, width: int, value) -> np.ndarray:
    """For each window of ``width`` codes the sum of ``value(count)`` over the codes in it."""
    out = np.zeros(len(codes) - width + 1)
    for code in np.unique(codes):
        counts = np.concatenate([[0], np.cumsum(codes == code)])
        out += value[counts[width:] - counts[:-width]]
    return out


def _blocks(strings: list[str]):
    """Strings in blocks: their numbers, their letters one after the other, and which string each letter is of."""
    some, size = [], 0
    for k, s in enumerate(strings):
        some.append(k)
        size += len(s)
        if size >= _BLOCK or k + 1 == len(strings):
            yield some, np.array(list("".join(strings[i].upper() if strings[i].isascii() else strings[i] for i in some))), np.repeat(np.arange(len(some)), [len(strings[i]) for i in some])
            some, size = [], 0


def _lowered(strings: list[str], marks) -> list[str]:
    out = [""] * len(strings)
    for some, letters, owner in _blocks(strings):
        low = marks(letters, owner) if len(letters) else np.zeros(0, dtype=bool)
        at = 0
        for i in some:
            n = len(strings[i])
            out[i] = "".join(c.lower() if m else c for c, m in zip(strings[i], low[at : at + n], strict=True)) if low[at : at + n].any() else strings[i]
            at += n
    return out


def low_entropy(strings: list[str], window: int = 12, trigger: float = 2.2, extend: float = 2.5) -> list[str]:
    """Proteins with segments of low entropy in lower case: runs of windows of ``extend`` bits at most of which one has
    ``trigger`` bits at most. Strings shorter than a window stay as they are."""
    share = np.arange(window + 1) / window
    bits = np.concatenate([[0.0], -share[1:] * np.log2(share[1:])])

    def marks(letters: np.ndarray, owner: np.ndarray) -> np.ndarray:
        n = len(letters)
        if n < window:
            return np.zeros(n, dtype=bool)
        entropy = _window_sums(np.unique(letters, return_inverse=True)[1], window, bits)
        whole = owner[: n - window + 1] == owner[window - 1 :]
        near = whole & (entropy <= extend + 1e-12)
        new = near & ~np.concatenate([[False], near[:-1] & (owner[1 : n - window + 1] == owner[: n - window])])
        run = np.cumsum(new)
        hit = np.zeros(run[-1] + 1, dtype=bool)
        hit[run[near & (entropy <= trigger + 1e-12)]] = True
        return _covered(near & hit[run], window, n)

    return _lowered(strings, marks)


def repeated_triplets(strings: list[str], window: int = 32, most: float = 2.0) -> list[str]:
    """Nucleotides with windows in lower case whose triplets repeat: the sum of c(c-1)/2 over triplets is more than ``most`` for each
    triplet but one. Of strings shorter than a window the whole is one; under three letters they stay as they are."""
    out = list(strings)
    for width in sorted({min(window, len(s)) for s in strings if len(s) >= 3}):
        at = [k for k, s in enumerate(strings) if len(s) >= 3 and min(window, len(s)) == width]
        triplets = width - 2
        pairs = np.arange(triplets + 1) * (np.arange(triplets + 1) - 1) / 2

        def marks(letters: np.ndarray, owner: np.ndarray, width=width, triplets=triplets, pairs=pairs) -> np.ndarray:
            n = len(letters)
            codes = np.unique(letters, return_inverse=True)[1].astype(np.int64)
            base = codes.max() + 1
            score = _window_sums((codes[:-2] * base + codes[1:-1]) * base + codes[2:], triplets, pairs)
            return _covered((owner[: n - width + 1] == owner[width - 1 :]) & (score > most * max(1, triplets - 1)), width, n)

        for k, s in zip(at, _lowered([strings[k] for k in at], marks), strict=True):
            out[k] = s
    return out
