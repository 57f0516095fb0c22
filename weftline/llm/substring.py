"""Substring dedup: windows of words by level-wise doubling."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import WORD_UNIT, strike_out
from .common import table


def doubling(raw: list[bytes], window: int, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last start of the windows of each fragment that another fragment has too; -1 for none.

    Words are windows of length one. A window that is repeated at one length, and whose end is too, is extended
    to twice that length (at last to ``window``); the others are out. Ranks stand for windows, so nothing rests on
    a hash. It ends with the whole window or when no candidate is left.
    """
    split = [r.split() for r in raw]
    rank_of: dict[bytes, int] = {}
    rank = np.array([rank_of.setdefault(w, len(rank_of)) for s in split for w in s], dtype=np.int64)
    lengths = np.array([len(s) for s in split], dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    room = np.repeat(starts + lengths, lengths) - np.arange(len(rank))
    first = np.full(len(raw), -1, dtype=np.int64)
    last = first.copy()
    alive, length = np.arange(len(rank)), 1
    while len(alive):
        _, which, times = np.unique(rank[alive], return_inverse=True, return_counts=True)
        again = times[which] > 1
        rank[:] = -1
        alive, which = alive[again], which[again]
        if length == window:
            break
        rank[alive] = which
        longer = min(2 * length, window)
        alive = alive[room[alive] >= longer]
        tail = rank[alive + longer - length]
        alive, tail = alive[tail >= 0], tail[tail >= 0]
        rank[alive] = rank[alive] * (len(times) + 1) + tail
        length = longer
    owner = np.repeat(np.arange(len(raw)), lengths)[alive]
    offset = alive - starts[owner]
    last[owner] = offset
    first[owner[::-1]] = offset[::-1]
    return first, last


def keep_words(raw: bytes, spans: list[tuple[int, int]]) -> tuple[int, bytes]:
    words, at, kept = raw.split(), 0, []
    for a, b in spans:
        kept += words[at:a]
        at = b
    return len(words), b" ".join(kept + words[at:])


def dedup(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with ``spans`` (in words), ``n_symbols`` (words) and ``kept``: the words outside the spans, joined
    by one space. A span is covered by windows of 35 words that start anywhere else too, the same text included.
    Null and empty texts have no words, equal texts lose all windows that they have, an empty table gives no rows, and
    texts of any length are cut into fragments first."""
    return strike_out(docs, WORD_UNIT, doubling, keep_words, text, **options)


def op5_substring(spark, sf_dir: str) -> DataFrame:
    out = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return out.select("doc_id", F.col("n_symbols").alias("n_words"), removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"), F.size("spans").cast("long").alias("n_spans"))
