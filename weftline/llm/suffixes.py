"""Suffix-array dedup of byte strings, with suffix arrays by linear grouping."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import BYTE_UNIT, BYTES, grams, mix, strike_out
from .common import table

#: A phrase ends where a run of this many bytes has a hash with so many zero bits: 64 bytes on average.
CUT, CUT_BITS = 8, 6


def suffix_array(text: list[int]) -> list[int]:
    """Suffix array of integers that end with a smallest one of its own, by linear grouping.

    Phase one sorts the suffixes into groups by their Lyndon prefixes. Groups are processed from the highest down;
    each member points to its previous smaller suffix, the nearest on the left in a lower group (a forest of links
    over all that is processed finds it). Suffixes of one group with more pointers go above those with fewer, each
    set as a new group right after its old one. Phase two runs over the result itself: the left neighbour of each
    suffix, then along previous-smaller pointers, takes the next free place of its group, until one has been placed.
    """
    n = len(text)
    sa = sorted(range(n), key=text.__getitem__)
    place, group, size = [0] * n, [0] * n, [0] * (n + 1)
    start = 0
    for at, i in enumerate(sa):
        if at and text[i] != text[sa[at - 1]]:
            start = at
        place[i], group[i] = at, start
        size[start] += 1
    left = list(range(n))  # nearest suffix on the left, itself included, that is not processed
    previous = [-1] * n
    end = n
    while end:
        begin = group[sa[end - 1]]
        members = sa[begin:end]
        for i in members:
            left[i] = i - 1
        pointers: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and left[j] != j:
                j = left[j]
            k = i
            while k > j and left[k] != j:
                left[k], k = j, left[k]
            previous[i] = j
            if j >= 0:
                pointers[j] = pointers.get(j, 0) + 1
        if pointers:
            by: dict[tuple[int, int], list[int]] = {}
            for j, times in pointers.items():
                by.setdefault((times, group[j]), []).append(j)
            for (_, old), moved in sorted(by.items(), reverse=True) if len(by) > 1 else by.items():
                if size[old] == len(moved):
                    continue
                top = old + size[old]
                for j in moved:
                    top -= 1
                    a, other = place[j], sa[top]
                    sa[a], sa[top] = other, j
                    place[other], place[j] = a, top
                size[old] -= len(moved)
                size[top] = len(moved)
                for j in moved:
                    group[j] = top
        end = begin
    out, free = [-1] * n, list(range(n))  # free: next place of the group that starts there
    placed = [False] * n
    out[0] = n - 1
    placed[n - 1] = True
    for at in range(n):
        j = out[at] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = True
            j = previous[j]
    return out


def common_prefixes(text: list[int], sa: list[int]) -> list[int]:
    """Symbols that the suffix at each place of the array shares with the one before it."""
    n = len(text)
    rank = [0] * n
    for at, i in enumerate(sa):
        rank[i] = at
    out, h = [0] * n, 0
    for i in range(n):
        if rank[i]:
            j = sa[rank[i] - 1]
            while i + h < n and j + h < n and text[i + h] == text[j + h]:
                h += 1
            out[rank[i]] = h
            h = h - 1 if h else 0
        else:
            h = 0
    return out


def phrases(flat: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Phrase starts of some byte strings laid end to end, and a symbol for each: equal phrases have equal symbols.

    Phrases are cut by their own content, so equal strings are cut alike. The last start of each string begins no
    whole phrase; its symbol is the separator 1."""
    if len(flat) < CUT:
        return np.zeros(0, dtype=np.int64), []
    h = grams(BYTES[flat], CUT)
    cuts = np.flatnonzero((h >> np.uint64(64 - CUT_BITS)) == 0)
    cuts = cuts[owner[cuts] == owner[cuts + CUT - 1]]
    if not len(cuts):
        return cuts, []
    raw = flat.tobytes()
    joined = np.r_[owner[cuts[1:]] == owner[cuts[:-1]], False]
    ends = np.r_[cuts[1:] + CUT, 0].tolist()
    rank: dict[bytes, int] = {}
    return cuts, [2 + rank.setdefault(raw[a:b], len(rank)) if same else 1 for a, b, same in zip(cuts.tolist(), ends, joined.tolist())]


class Runs:
    """Runs of phrases that are equal, read off the suffix array of the sequence of phrases and its common prefixes."""

    def __init__(self, symbols: list[int]):
        sa = suffix_array(symbols + [0])
        self.shared = np.array(common_prefixes(symbols + [0], sa), dtype=np.int64)
        self.place = np.empty(len(sa), dtype=np.int64)
        self.place[np.array(sa)] = np.arange(len(sa))

    def of(self, start: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For the runs of ``n`` phrases from some starts on: a number that equal runs have in common, and whether there
        is another one. Suffixes that share n phrases lie side by side in the array."""
        split = self.shared < n
        number = np.cumsum(split)
        alone = split & np.r_[split[1:], True]
        at = self.place[start]
        return number[at], ~alone[at]


def _edges(flat: np.ndarray) -> Callable:
    """Hashes of the runs of bytes between two places, from sums over the bytes times odd powers."""
    powers = np.full(len(flat) + 1, 0x9E3779B97F4A7C15, dtype=np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    sums = np.zeros(len(flat) + 1, dtype=np.uint64)
    np.cumsum(BYTES[flat] * powers[:-1], dtype=np.uint64, out=sums[1:])
    last = np.uint64(len(flat))
    return lambda a, b: (sums[b] - sums[a]) * powers[(last - a.astype(np.uint64)).astype(np.int64)]


def _confirmed(raw: bytes, at: np.ndarray, key: np.ndarray, window: int) -> np.ndarray:
    """Which of the windows at ``at`` are equal to another one, byte by byte. ``key`` brings them together.

    Each window is compared with the first of its key; windows one after the other at the same distance from theirs
    are compared in one stretch. Should one differ, a key's windows are told apart by their bytes."""
    order = np.argsort(key, kind="stable")
    first = np.r_[True, key[order[1:]] != key[order[:-1]]] if len(order) else np.zeros(0, dtype=bool)
    leader = np.empty(len(at), dtype=np.int64)
    leader[order] = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    sizes = np.bincount(leader, minlength=len(at))
    repeated = sizes[leader] > 1
    follows = np.flatnonzero(repeated & (leader != np.arange(len(at))))
    if not len(follows):
        return repeated
    distance = at[follows] - at[leader[follows]]
    new = np.flatnonzero(np.r_[True, (np.diff(at[follows]) != 1) | (np.diff(distance) != 0)]) if len(follows) else follows
    ends = np.r_[new[1:], len(follows)]
    starts, stops, gaps = at[follows[new]].tolist(), (at[follows[ends - 1]] + window).tolist(), distance[new].tolist()
    if all(raw[a:b] == raw[a - d : b - d] for a, b, d in zip(starts, stops, gaps)):
        return repeated
    seen: dict[bytes, int] = {}
    whole = [raw[a : a + window] for a in at.tolist()]
    for w in whole:
        seen[w] = seen.get(w, 0) + 1
    return np.array([seen[w] > 1 for w in whole], dtype=bool)


def by_suffix_arrays(raw: list[bytes], window: int, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last start of the windows of each fragment that another fragment has too; -1 for none.

    A window is a tail of a phrase, whole phrases, and a head of one. The suffix array says which windows have
    their whole phrases, all together, somewhere else, and numbers equal runs of them; windows of one number with
    tails and heads alike are brought together and compared byte by byte. A window without a whole phrase is a tail alone.
    """
    joined = b"".join(raw)
    flat = np.frombuffer(joined, dtype=np.uint8)
    lengths = np.array([len(r) for r in raw], dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(raw)), lengths)
    first = np.full(len(raw), -1, dtype=np.int64)
    last = first.copy()
    n = len(flat) - window + 1
    at = np.flatnonzero(owner[:n] == owner[window - 1 :]) if n > 0 else np.zeros(0, dtype=np.int64)
    cuts, symbols = phrases(flat, owner)
    low = np.searchsorted(cuts, at)
    whole = np.maximum(np.searchsorted(cuts, at + window - CUT, side="right") - low - 1, 0)
    run = np.zeros(len(at), dtype=np.int64)
    maybe = whole == 0
    if whole.any():
        runs = Runs(symbols)
        for k in np.unique(whole[whole > 0]).tolist():
            some = np.flatnonzero(whole == k)
            run[some], maybe[some] = runs.of(low[some], k)
    at, low, whole, run = at[maybe], low[maybe], whole[maybe], run[maybe]
    if len(at):
        between = _edges(flat)
        some = whole > 0
        bounds = np.r_[cuts, 0]
        head = np.where(some, bounds[np.minimum(low, len(cuts))], at + window)
        foot = np.where(some, bounds[np.minimum(low + whole, len(cuts))], at + window)
        with np.errstate(over="ignore"):
            key = mix(between(at, head) + mix(between(foot, at + window) + run.astype(np.uint64)) + (whole * 4096 + head - at).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        at = at[_confirmed(joined, at, key, window)]
    offset = at - starts[owner[at]]
    last[owner[at]] = offset
    first[owner[at][::-1]] = offset[::-1]
    return first, last


def keep_bytes(raw: bytes, spans: list[tuple[int, int]]) -> tuple[int, bytes]:
    at, kept = 0, []
    for a, b in spans:
        kept.append(raw[at:a])
        at = b
    return len(raw), b"".join([*kept, raw[at:]])


def dedup(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with ``spans`` (in UTF-8 bytes), ``n_symbols`` (bytes) and ``kept``: the bytes outside the spans.

    A span is covered by strings of 400 bytes that start anywhere else too, the same text included; matches never
    cross texts. Null is an empty text. What is kept need not be valid UTF-8 by itself, hence binary."""
    return strike_out(docs, BYTE_UNIT, by_suffix_arrays, keep_bytes, text, **options)


def op1_suffixes(spark, sf_dir: str) -> DataFrame:
    out = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return out.select("doc_id", F.col("n_symbols").alias("n_bytes"), removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
