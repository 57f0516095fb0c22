"""Fragments around anchors: the shared frame for finding windows of a fixed length that occur more than once.

A window's anchor is the leftmost of its k-grams with the smallest hash, so equal windows have equal anchors at
equal places. Only windows whose anchor occurs more than once can repeat. All windows of one anchor lie in one
fragment of the text; fragments meet by the hash of their anchor, and the engine of the operator (suffix arrays,
level-wise doubling) finds the repeated windows among the distinct fragments of a group. Groups of more distinct
fragments than a task should hold are anchored anew on k-grams of twice the length, down to whole windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored, fresh, quoted

#: Symbols to a block of the sliding minimum, bytes of text to a slice, distinct fragments that a group may hold.
BLOCK = 1 << 20
SLICE = 4 << 20
MOST = 20_000
#: Fragments whose digests a task remembers.
REMEMBERED = 300_000
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A hash for each byte.
BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def grams(symbols: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k symbols: a polynomial modulo 2**64, put together from doubled lengths, then mixed."""
    if len(symbols) < k:
        return np.zeros(0, dtype=np.uint64)
    doubled, length, out, done = symbols, 1, None, 0
    while True:
        if k & length:
            if out is None:
                out = doubled
            else:
                m = len(symbols) - done - length + 1
                out = out[:m] * np.uint64(pow(_BASE, length, 1 << 64)) + doubled[done : done + m]
            done += length
        if done == k:
            return mix(out[: len(symbols) - k + 1])
        m = len(doubled) - length
        doubled = doubled[:m] * np.uint64(pow(_BASE, length, 1 << 64)) + doubled[length : length + m]
        length *= 2


def leftmost_minima(h: np.ndarray, w: int) -> np.ndarray:
    """For each run of w hashes the place of the smallest, the leftmost of equal ones. Works by blocks."""
    n = len(h) - w + 1
    out = np.empty(max(n, 0), dtype=np.int64)
    for a in range(0, n, BLOCK):
        b = min(a + BLOCK, n)
        low = (h[a : b + w - 1] & np.uint64(_MASK ^ ((1 << 22) - 1))) | np.arange(b - a + w - 1, dtype=np.uint64)
        size = 1
        while 2 * size <= w:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        m = b - a
        low = np.minimum(low[:m], low[w - size : w - size + m])
        out[a:b] = (low & np.uint64((1 << 22) - 1)).astype(np.int64) + a
    return out


def anchored(symbols: np.ndarray, lengths: np.ndarray, window: int, k: int) -> tuple[np.ndarray, ...]:
    """Anchors of all windows of some sequences laid end to end.

    Returns the sequence, the k-gram's hash, and the first and the last start (in the sequence) of the windows
    that have the anchor."""
    none = np.zeros(0, dtype=np.int64)
    if len(symbols) < window:
        return none, none.astype(np.uint64), none, none
    starts = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(lengths)), lengths)
    h = grams(symbols, k)
    at = leftmost_minima(h, window - k + 1)
    n = len(symbols) - window + 1
    valid = np.flatnonzero(owner[:n] == owner[window - 1 :])
    if not len(valid):
        return none, none.astype(np.uint64), none, none
    place = at[valid]
    first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (owner[valid[1:]] != owner[valid[:-1]])])
    last = np.r_[first[1:], len(valid)] - 1
    whose = owner[valid[first]]
    return whose, h[place[first]], valid[first] - starts[whose], valid[last] - starts[whose]


@dataclass(frozen=True)
class Unit:
    """What a text is a sequence of. ``load`` takes texts as bytes and gives (symbol hashes, lengths, piece), where
    ``piece(i, a, b)`` are the bytes of symbols a to b of text i; a piece loads as those symbols."""

    window: int
    k: int
    load: Callable


def _load_bytes(raw: list[bytes]):
    flat = np.frombuffer(b"".join(raw), dtype=np.uint8)
    return BYTES[flat], np.array([len(r) for r in raw], dtype=np.int64), lambda i, a, b: raw[i][a:b]


def _load_words(raw: list[bytes]):
    from xxhash import xxh64_intdigest

    split = [r.split() for r in raw]
    rank: dict[bytes, int] = {}
    flat = np.array([rank.setdefault(w, len(rank)) for s in split for w in s], dtype=np.int64)
    hashes = np.array([xxh64_intdigest(w) for w in rank], dtype=np.uint64)
    return hashes[flat] if len(flat) else hashes, np.array([len(s) for s in split], dtype=np.int64), lambda i, a, b: b" ".join(split[i][a:b])


BYTE_UNIT = Unit(400, 64, _load_bytes)
WORD_UNIT = Unit(35, 9, _load_words)


def slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, n in enumerate(sizes):
        total += n
        if total >= SLICE:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def _raw(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _marks(docs: DataFrame, unit: Unit) -> DataFrame:
    """Anchors of all texts: ``tid, sym, lo, hi``."""

    def run(batches):
        for batch in batches:
            tids, raw = batch.column(0), _raw(batch.column(1))
            for a, b in slices([len(r) for r in raw]):
                symbols, lengths, _ = unit.load(raw[a:b])
                whose, sym, lo, hi = anchored(symbols, lengths, unit.window, unit.k)
                yield pa.RecordBatch.from_arrays([tids.take(pa.array(whose + a)), pa.array(sym.view(np.int64)), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], names=["tid", "sym", "lo", "hi"])

    return docs.select("tid", "text").mapInArrow(run, "tid binary, sym long, lo int, hi int")


_FRAGMENT = "tid binary, sym long, fid binary, lo int, n int, frag binary"


def _fragments(rows: Iterator[tuple], piece: Callable, window: int, sent: set[bytes]):
    """Arrow batches of fragments; ``rows`` are (text, tid, sym, lo, hi, shift).

    The bytes of a fragment that the task has ``sent`` before are null: copies of a text lie in one task."""
    out: list[list] = [[], [], [], [], [], []]
    size = 0
    for i, tid, sym, lo, hi, shift in rows:
        frag = piece(i, lo, hi + window)
        fid = hashlib.md5(frag).digest()
        if fid in sent:
            frag = None
        else:
            if len(sent) >= REMEMBERED:
                sent.clear()
            sent.add(fid)
        for column, x in zip(out, (tid, sym, fid, lo + shift, hi - lo + 1, frag)):
            column.append(x)
        size += 64 + len(frag or b"")
        if size >= SLICE:
            yield _fragment_batch(out)
            out, size = [[], [], [], [], [], []], 0
    if out[0]:
        yield _fragment_batch(out)


def _fragment_batch(out: list[list]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["tid", "sym", "fid", "lo", "n", "frag"])


def _cut(texts: DataFrame, unit: Unit) -> DataFrame:
    """Fragments of texts at their marks (``tid, text, marks``)."""

    def run(batches):
        sent: set[bytes] = set()
        for batch in batches:
            tids, raw, marks = batch.column(0).to_pylist(), _raw(batch.column(1)), batch.column(2)
            counts = np.diff(marks.offsets.to_numpy())
            flat = marks.flatten()
            sym, lo, hi = (flat.field(k).to_pylist() for k in range(3))
            ends = np.cumsum(counts).tolist()
            for a, b in slices([len(r) for r in raw]):
                _, _, piece = unit.load(raw[a:b])
                rows = ((i - a, tids[i], sym[j], lo[j], hi[j], 0) for i in range(a, b) for j in range(ends[i] - int(counts[i]), ends[i]))
                yield from _fragments(rows, piece, unit.window, sent)

    return texts.select("tid", "text", "marks").mapInArrow(run, _FRAGMENT)


def _cut_again(frags: DataFrame, unit: Unit, k: int) -> DataFrame:
    """Fragments of fragments, on anchors of k symbols."""

    def run(batches):
        sent: set[bytes] = set()
        for batch in batches:
            tids, los, raw = batch.column(0).to_pylist(), batch.column(3).to_pylist(), _raw(batch.column(5))
            for a, b in slices([len(r) for r in raw]):
                symbols, lengths, piece = unit.load(raw[a:b])
                whose, sym, lo, hi = anchored(symbols, lengths, unit.window, k)
                rows = ((i, tids[a + i], s, x, y, los[a + i]) for i, s, x, y in zip(whose.tolist(), sym.view(np.int64).tolist(), lo.tolist(), hi.tolist()))
                yield from _fragments(rows, piece, unit.window, sent)

    return frags.mapInArrow(run, _FRAGMENT)


def _grouped(frags: DataFrame, unit: Unit, engine: Callable) -> DataFrame:
    """``sym, fid, a, b`` for the distinct fragments in which the engine finds repeated windows: symbols a to b.

    ``engine(raw, window, counts)`` gets whole groups; all windows of a fragment hold its anchor, so the repeated
    ones cover one stretch."""

    def flush(syms, fids, frags, counts):
        first, last = engine(frags, unit.window, np.array(counts))
        hit = np.flatnonzero(last >= 0)
        return pa.RecordBatch.from_arrays(
            [pa.array([syms[i] for i in hit], pa.int64()), pa.array([fids[i] for i in hit], pa.binary()), pa.array(first[hit].astype(np.int32)), pa.array((last[hit] + unit.window).astype(np.int32))],
            names=["sym", "fid", "a", "b"],
        )

    def run(batches):
        syms, fids, held, counts, size, group = [], [], [], [], 0, 0
        for batch in batches:
            for sym, fid, n, frag in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if syms and sym != syms[-1]:
                    if len(syms) - group == 1:  # alone in its group: nothing to compare it with
                        for x in (syms, fids, held, counts):
                            x.pop()
                    if size >= SLICE:
                        yield flush(syms, fids, held, counts)
                        syms, fids, held, counts, size = [], [], [], [], 0
                    group = len(syms)
                if len(syms) > group and fid == fids[-1]:
                    continue
                syms.append(sym), fids.append(fid), held.append(frag), counts.append(n)
                size += len(frag)
        if syms:
            yield flush(syms, fids, held, counts)

    ready = frags.where("frag IS NOT NULL").select("sym", "fid", "n", "frag").repartition("sym").sortWithinPartitions("sym", "fid")
    return ready.mapInArrow(run, "sym long, fid binary, a int, b int")


def _twice(rows: DataFrame) -> DataFrame:
    return rows.groupBy("sym").count().where("count > 1").select("sym")


def repeated(docs: DataFrame, unit: Unit, engine: Callable, most: int = MOST) -> DataFrame:
    """``tid, spans``: stretches (start, end) covered by windows that occur more than once, sorted, for each text
    that has any. ``docs`` holds ``tid`` (equal for equal texts alone) and ``text``.

    Equal fragments are counted by a partial aggregate and need no engine. What is collected for a text is
    bounded by that text.
    """
    held: list[Stored] = []

    def stored(df: DataFrame) -> DataFrame:
        held.append(Stored(df))
        return held[-1].df

    marks = stored(_marks(docs, unit))
    # stored, so that both sides of a join are plain exchanges and a frequent anchor's rows can be split
    twice = stored(_twice(marks))
    kept = marks.join(twice, "sym", "left_semi").groupBy("tid").agg(F.collect_set(F.struct("sym", "lo", "hi")).alias("marks"))
    frags = stored(_cut(docs.join(kept, "tid"), unit))
    k, found = unit.k, None
    while True:
        counts = stored(frags.groupBy("sym", "fid").agg(F.count("*").alias("times")))
        sizes = counts.groupBy("sym").agg(F.count("*").alias("size"))
        hot = stored(sizes.where(F.col("size") > most).select("sym"))
        more = k < unit.window and not hot.isEmpty()
        cool = frags.join(hot, "sym", "left_anti") if more else frags
        stretches = stored(_grouped(cool, unit, engine))
        same = counts.where("times > 1").select("sym", "fid", F.lit(True).alias("same"))
        verdicts = stored(same.join(stretches, ["sym", "fid"], "full_outer"))
        placed = (
            cool.drop("frag")
            .join(verdicts, ["sym", "fid"])
            .select("tid", F.when(F.col("same"), F.col("lo")).otherwise(F.col("lo") + F.col("a")).alias("start"), F.when(F.col("same"), F.col("lo") + F.col("n") - 1 + unit.window).otherwise(F.col("lo") + F.col("b")).alias("end"))
        )
        found = placed if found is None else found.unionByName(placed)
        if not more:
            out = Stored(found.groupBy("tid").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))).df
            for table in held:
                table.drop()
            return out
        k = min(2 * k, unit.window)
        bytes_ = frags.where("frag IS NOT NULL").join(hot, "sym", "left_semi").select("sym", "fid", "frag").dropDuplicates(["sym", "fid"])
        again = stored(_cut_again(frags.drop("frag").join(bytes_, ["sym", "fid"]).select("tid", "sym", "fid", "lo", "n", "frag"), unit, k))
        twice = stored(_twice(again))
        frags = stored(again.join(twice, "sym", "left_semi").select("tid", "sym", "fid", "lo", "n", "frag"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted stretches with those that overlap or touch made one."""
    out: list[list[int]] = []
    for a, b in spans:
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def strike_out(docs: DataFrame, unit: Unit, engine: Callable, keep: Callable, text: str = "text", most: int = MOST) -> DataFrame:
    """``docs`` with ``spans`` (array of start and end, maximal and in order), ``n_symbols`` and ``kept`` (binary).

    ``keep(raw, spans)`` gives the number of symbols and the bytes that stay. Texts are joined by a digest of
    themselves, so null and repeated keys do no harm; a null text is an empty one. Columns with the new names are
    replaced."""
    new = ["spans", "n_symbols", "kept"]
    kept = docs.drop(*new)
    names = kept.columns
    tid, found_ = (f"{fresh(names, '_wl')}_{x}" for x in ("tid", "spans"))
    named = kept.select(F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias(tid), *quoted(names))
    spans = repeated(named.select(F.col(tid).alias("tid"), F.coalesce(F.col(text), F.lit("")).alias("text")), unit, engine, most)
    joined = named.join(spans.select(F.col("tid").alias(tid), F.col("spans").alias(found_)), tid, "left").select(*quoted(names), found_)
    place = names.index(text)

    def run(batches):
        for batch in batches:
            raw, found = _raw(batch.column(place)), batch.column(len(names)).to_pylist()
            for a, b in slices([len(r) for r in raw]):
                own = [merged([(s["start"], s["end"]) for s in f or ()]) for f in found[a:b]]
                done = [keep(r, s) for r, s in zip(raw[a:b], own)]
                listed = pa.array([[{"start": x, "end": y} for x, y in s] for s in own], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], listed, pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.binary())], names=[*names, *new])

    from pyspark.sql import types as T

    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType(kept.schema.fields + [T.StructField("spans", span), T.StructField("n_symbols", T.LongType()), T.StructField("kept", T.BinaryType())])
    return joined.mapInArrow(run, schema)
