"""SimHash near-duplicates by a grid range-join of segment bit counts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .anchors import mix
from .common import Stored, connected_components, fresh, give_back, quoted, table

#: Fixed values of the contract: words of a shingle, seed of XXH64, differing bits that link.
SHINGLE = 3
SEED = 42
RADIUS = 2
#: Segments of the embedding (two bits each; a count takes two bits of a cell's number) and the groups that these form.
SEGMENTS = 32
GROUPS = 5
_BLOCK = 1 << 17
#: Near copies in the pipeline: words of a shingle, and the Jaccard similarity of two shingle sets, a ratio of integers.
NEAR_SHINGLE, NEAR = 5, (4, 5)
#: Words of a wide fingerprint whose bits are compared, and the bits of these that may differ: 19 of 128 do on average at the
#: similarity 0.8, 64 in unlike texts.
COMPARED, NEAR_RADIUS = 2, 36
#: Chances that two texts have a segment's count in common: at the similarity 0.8 (a bit differs with probability 0.151) and
#: unlike ones; and the chance that no grid has a pair at the similarity 0.8 in one cell.
ALIKE, UNLIKE, MISSED = 0.732, 0.375, 1e-4
#: Segments of a cell in a grid of wide fingerprints: so many at least, and more where two of CELL rows would share one.
LEAST_SEGMENTS, CELL = 5, 1 << 14
#: Rows of a cell that are compared at once; a larger cell is dealt in parts. Pairs in a block of the comparison.
CELL_PART, _PAIRS = 1 << 15, 1 << 17
#: Texts of a bucket, and bytes of their shingles, that are compared at once; a larger bucket is dealt in parts.
PART, PART_BYTES = 512, 16 << 20
#: Shingles whose columns are multiplied at once.
_WIDE = 4096


def _majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For consecutive runs of hashes (none empty), the bits set in over half of each run."""
    n, starts = len(sizes), np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(n), sizes)
    counts = np.zeros((n, 64), dtype=np.int64)
    for a in range(0, len(hashes), _BLOCK):
        b = min(a + _BLOCK, len(hashes))
        first, last = owner[a], owner[b - 1]
        bits = np.unpackbits(hashes[a:b].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        cuts = np.maximum(starts[first : last + 1], a) - a
        counts[first : last + 1] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int32)
    return np.packbits(2 * counts > sizes[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().split() if text else []


def _shingles(words: list[bytes], shingle: int) -> np.ndarray:
    """Hashes of the runs of ``shingle`` words; a shorter text (not an empty one) is one run."""
    from xxhash import xxh64_intdigest as xxh64

    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())
    return np.array([xxh64(line[a:b], SEED) for a, b in spans], dtype=np.uint64)


def fingerprints(texts: list[str | None], shingle: int = SHINGLE) -> np.ndarray:
    """64-bit fingerprints of texts; zero for a text without a word, null included."""
    out, parts, sizes, at = np.zeros(len(texts), dtype=np.uint64), [], [], []
    for i, text in enumerate(texts):
        words = _words(text)
        if not words:
            continue
        parts.append(_shingles(words, shingle))
        sizes.append(len(parts[-1]))
        at.append(i)
    if parts:
        out[at] = _majority(np.concatenate(parts), np.array(sizes))
    return out


def with_fingerprints(docs: DataFrame, text: str = "text", to: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each text, a long with its 64 bits; zero for a text without words, null included.
    A column with that name is replaced."""
    kept = docs.drop(to)
    schema = T.StructType(kept.schema.fields + [T.StructField(to, T.LongType())])

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fingerprints(texts).view(np.int64))], names=[*batch.schema.names, to])
        give_back()

    return kept.mapInArrow(run, schema)


def _cell(fp: Column) -> Column:
    """Number of the grid cell: the bit counts of the segments, side by side."""
    low = F.lit(0x5555555555555555).cast("long")
    one, two = fp.bitwiseAND(low), F.shiftrightunsigned(fp, 1).bitwiseAND(low)
    return F.shiftleft(one.bitwiseAND(two), 1).bitwiseOR(one.bitwiseXOR(two))


def _masks(radius: int = RADIUS, groups: int = GROUPS) -> list[int]:
    """For each choice of all but ``radius`` groups of segments the bits of a cell's number that they take."""
    from itertools import combinations

    cuts = [2 * (g * SEGMENTS // groups) for g in range(groups + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return [signed(sum(c)) for c in combinations(parts, max(1, groups - radius))]


def links(fps: DataFrame, fp: str = "fp", radius: int = RADIUS) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints (one row each in ``fps``) with ``radius`` differing bits at most.

    Two fingerprints with d differing bits have segment counts at Manhattan distance d at most, so at most d segments
    differ in their counts, and some choice of all but d groups of segments has the same counts throughout. The range
    join over the grid is an equi-join on each choice, and bits are compared there. Of two random fingerprints about one
    pair in ten million meets. The fingerprints are distinct, so copies of one text make no row more, however many
    there are.
    """
    groups = max(GROUPS, radius + 1)
    choices = F.array(*[F.struct(F.lit(k).alias("k"), _cell(F.col(fp)).bitwiseAND(F.lit(m)).alias("v")) for k, m in enumerate(_masks(radius, groups))])
    spread = fps.select(fp, F.explode(choices).alias("c")).select(fp, "c.k", "c.v")
    one, two = spread.select(F.col(fp).alias("a"), "k", "v"), spread.select(F.col(fp).alias("b"), "k", "v")
    return one.join(two, ["k", "v"]).where("a < b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).select("a", "b").distinct()


def near_duplicates(marked: DataFrame, key: str = "doc_id", fp: str = "fingerprint") -> DataFrame:
    """Component of each distinct fingerprint: ``_fp, _root, component_id`` (the smallest key in the component).

    ``marked`` is read more than once and should be stored. Equal fingerprints are one node, found by a partial
    aggregate. Null keys are passed over unless a component has no other; a table without rows gives none."""
    nodes = Stored(marked.groupBy(F.col(fp).alias("fp")).agg(F.min(key).alias("least")))
    edges = Stored(links(nodes.df))
    roots = connected_components(edges.df)
    placed = nodes.df.join(roots, nodes.df.fp == roots.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return placed.join(smallest, "root").select(F.col("fp").alias("_fp"), F.col("root").alias("_root"), "component_id")


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = Stored(with_fingerprints(docs).select("doc_id", "fingerprint")).df
    placed = marked.join(near_duplicates(marked), F.col("fingerprint") == F.col("_fp"))
    return placed.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def grids(rows: int) -> tuple[int, int]:
    """Segments of a cell and words of the wide fingerprints for a table of so many rows.

    A word's 32 segments make ``32 // segments`` grids, none with a segment of another. With more segments unlike texts
    share fewer cells and so do near copies, hence more grids: 42 up to two million rows, 80 at fifteen million."""
    segments = LEAST_SEGMENTS
    while segments < SEGMENTS // 2 and rows * UNLIKE**segments > CELL:
        segments += 1
    wanted = np.log(MISSED) / np.log1p(-(ALIKE**segments))
    return segments, max(COMPARED, int(np.ceil(wanted / (SEGMENTS // segments))))


def wide_fingerprints(sets: list[np.ndarray], words: int) -> np.ndarray:
    """SimHash of some sets of hashes (none empty), 64 bits for each of ``words`` ways to mix them: one row a set."""
    ways = np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    out = np.zeros((len(sets), words), dtype=np.uint64)
    for i, hashes in enumerate(sets):
        counts = np.zeros(64 * words, dtype=np.int64)
        for a in range(0, len(hashes), 255):  # as many ones as a byte can count
            mixed = mix(hashes[a : a + 255, None] + ways)
            counts += np.unpackbits(mixed.astype("<u8").view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
        out[i] = np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")
    return out


def with_wide_fingerprints(docs: DataFrame, text: str, node: str, fps: str, shingles: str, words: int, shingle: int = NEAR_SHINGLE) -> DataFrame:
    """``docs`` without the text but with a hash of its words, the wide fingerprint of its distinct shingles (none for a text
    without a word) and the sorted distinct hashes of its shingles, four bytes each."""
    from xxhash import xxh64_intdigest as xxh64

    kept = docs.drop(text)
    added = [T.StructField(node, T.LongType()), T.StructField(fps, T.ArrayType(T.LongType())), T.StructField(shingles, T.BinaryType())]
    schema = T.StructType(kept.schema.fields + added)

    def run(batches):
        for batch in batches:
            nodes, found, sets = [], [], []
            for value in batch.column(batch.schema.get_field_index(text)).to_pylist():
                at = _words(value)
                nodes.append(xxh64(b" ".join(at), SEED))
                hashes = np.unique(_shingles(at, shingle)) if at else np.zeros(0, dtype=np.uint64)
                found.append(wide_fingerprints([hashes], words)[0].view(np.int64).tolist() if at else [])
                sets.append(np.unique((hashes >> np.uint64(32)).astype(np.uint32)).tobytes())
            rest = batch.drop_columns([text])
            new = [pa.array(np.array(nodes, dtype=np.uint64).view(np.int64)), pa.array(found, pa.list_(pa.int64())), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays([*rest.columns, *new], names=[*rest.schema.names, node, fps, shingles])
        give_back()

    return docs.mapInArrow(run, schema)


def _differing(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """Bits that differ between fingerprints, given as an array for each word."""
    out = np.bitwise_count(one[0] ^ two[0])
    for x, y in zip(one[1:], two[1:]):
        out += np.bitwise_count(x ^ y)
    return out


def grouped(fps: list[np.ndarray], radius: int = NEAR_RADIUS) -> np.ndarray:
    """For each of some fingerprints (an array for each word, three at most) the first one that it reaches over pairs with
    ``radius`` differing bits.

    The range of the grid comes first: the Manhattan distance of all segments' counts, which differing bits are never
    below. A count is written as that many ones, so the distance is a number of differing bits as well."""
    low, n = np.uint64(0x5555555555555555), len(fps[0])
    halves = [(f & low, (f >> np.uint64(1)) & low) for f in fps]
    counts = [x | y | ((x & y) << np.uint64(1)) for x, y in halves]
    root, step = np.arange(n), max(1, _PAIRS // max(n, 1))
    for a in range(0, n, step):
        at = np.flatnonzero(_differing([c[a : a + step, None] for c in counts], [c[None, a:] for c in counts]) <= radius)
        i, j = np.divmod(at, n - a)
        i, j = i[j > i] + a, j[j > i] + a
        within = _differing([f[i] for f in fps], [f[j] for f in fps]) <= radius
        i, j = i[within], j[within]
        while len(i):
            ends = root[i], root[j]
            apart = ends[0] != ends[1]
            i, j = i[apart], j[apart]
            np.minimum.at(root, np.maximum(*ends)[apart], np.minimum(*ends)[apart])
            while (root[root] != root).any():
                root = root[root]
    return root


def _candidates(rows: DataFrame, radius: int) -> DataFrame:
    """``f1, f2`` of the rows of each part of a cell (``grid, cell, low, high``, rows in a run, sorted by ``f1, f2``) that
    have a near row there, and the ``f1`` of the first one that they reach as ``root``."""
    names = ["grid", "cell", "low", "high", "root", "f1", "f2"]
    types = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def settled(group):
        one, two = (x.view(np.uint64) for x in group[4:])
        first = np.flatnonzero(np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
        root = grouped([one[first], two[first]], radius)
        times = np.bincount(root, weights=np.diff(np.r_[first, len(one)]), minlength=len(first))
        some = times[root] > 1
        kept = [x[first[some]] for x in group]
        return [*kept[:4], group[4][first[root[some]]], *kept[4:]]

    def batch_of(parts):
        columns = [np.concatenate(x) for x in zip(*parts)] if parts else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], names=names)

    def run(batches):
        held = None
        for batch in batches:
            now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            n = len(now[0])
            if not n:
                continue
            cuts = np.flatnonzero(np.any([x[1:] != x[:-1] for x in now[:4]], axis=0)) + 1
            cuts = [0, *cuts.tolist(), n]
            yield batch_of([settled([x[a:b] for x in now]) for a, b in zip(cuts[:-2], cuts[1:-1])])
            held = [x[cuts[-2] :] for x in now]
        if held is not None:
            yield batch_of([settled(held)])
        give_back()

    schema = "grid int, cell long, low int, high int, root long, f1 long, f2 long"
    return rows.select("grid", "cell", "low", "high", "f1", "f2").mapInArrow(run, schema)


def _cells(fps: Column, segments: int) -> Column:
    """Cells of a wide fingerprint, one in each grid: the counts of its segments there, side by side."""
    mask = F.lit((1 << 2 * segments) - 1)
    of_word = lambda fp: F.array(*[F.shiftrightunsigned(_cell(fp), 2 * segments * g).bitwiseAND(mask) for g in range(SEGMENTS // segments)])
    return F.flatten(F.transform(fps, of_word))


def buckets_of(nodes: DataFrame, segments: int, radius: int = NEAR_RADIUS) -> DataFrame:
    """``bucket, node, bytes``: the candidates, by a range join over grids of segments' bit counts.

    ``nodes`` (stored) has ``node, fps, bytes``. Rows of one cell of a grid meet; a bucket is what hangs together there by
    the Manhattan distance of all counts, then by bits. A cell too large for one task is dealt in parts, every two of
    them to a task. Equal fingerprints are compared once."""
    spread = nodes.select(F.col("fps")[0].alias("f1"), F.col("fps")[1].alias("f2"), F.posexplode(_cells(F.col("fps"), segments)).alias("grid", "cell"))
    parts = F.ceil(F.col("count") / CELL_PART).cast("int")
    large = Stored(spread.groupBy("grid", "cell").count().where(F.col("count") > CELL_PART).select("grid", "cell", parts.alias("parts")))
    # at most a row for each CELL_PART rows, so it may be broadcast
    entries = spread.join(F.broadcast(large.df), ["grid", "cell"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("f1", "f2"), F.col("parts")).cast("int")
    dealt = entries.select("*", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    order = ["grid", "cell", "low", "high"]
    dealt = dealt.select("grid", "cell", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "f1", "f2")
    found = _candidates(dealt.repartition(*order).sortWithinPartitions(*order, "f1", "f2"), radius)
    named = found.select(F.xxhash64(*order, "root").alias("bucket"), "f1", "f2")
    known = nodes.select(F.col("fps")[0].alias("f1"), F.col("fps")[1].alias("f2"), "node", "bytes")
    return named.join(known.hint("merge"), ["f1", "f2"]).select("bucket", "node", "bytes")


def joined(sets: list[np.ndarray], similarity: tuple[int, int]) -> np.ndarray:
    """For each of some sets (sorted, distinct) the first one that it reaches over pairs with the Jaccard similarity, a
    ratio of integers, at least. Sizes of all intersections come from products of the columns that two sets share."""
    up, down = similarity
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    if n == 2:
        small, large = sizes.min(), sizes.max()
        both = len(np.intersect1d(*sets, assume_unique=True)) if up * large <= down * small else 0
        return np.array([0, 0 if down * both >= up * (sizes.sum() - both) else 1])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.r_[True, flat[1:] != flat[:-1]]
    column = np.cumsum(new) - 1
    shared = np.bincount(column) > 1
    keep = shared[column]
    column, owner = (np.cumsum(shared) - 1)[column[keep]], owner[keep]
    both = np.zeros((n, n), dtype=np.float32)
    for a in range(0, int(shared.sum()), _WIDE):
        here = slice(*np.searchsorted(column, (a, a + _WIDE)))
        held = np.zeros((n, _WIDE), dtype=np.float32)
        held[owner[here], column[here] - a] = 1
        both += held @ held.T
    both = both.astype(np.int64)
    linked = down * both >= up * (sizes[:, None] + sizes[None, :] - both)
    root = np.arange(n)
    while True:
        low = np.where(linked, root[None, :], n).min(axis=1, initial=n)
        low = np.minimum(low, root)
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _linked(rows: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """``a, b``: links enough to join what each part (``bucket, low, high``, rows in a run, by ``node``) has linked."""

    def run(batches):
        key, nodes, sets, out = None, [], [], ([], [])

        def flush():
            if len(nodes) > 1:
                for i, r in enumerate(joined(sets, similarity).tolist()):
                    if r != i:
                        out[0].append(nodes[i])
                        out[1].append(nodes[r])

        for batch in batches:
            for *now, node, raw in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if now != key:
                    flush()
                    key, nodes, sets = now, [], []
                nodes.append(node)
                sets.append(np.frombuffer(raw, dtype=np.uint32))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["a", "b"])
            out = ([], [])
        flush()
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["a", "b"])
        give_back()

    return rows.select("bucket", "low", "high", "node", "shingles").mapInArrow(run, "a long, b long")


def near_copies(marked: DataFrame, segments: int, similarity: tuple[int, int] = NEAR) -> DataFrame:
    """``node, component`` for the texts that have a near copy: components over all pairs with the similarity.

    ``marked`` (stored) has ``node, fps, shingles``. At the similarity 0.8 fingerprints of 64 bits differ in ten bits on
    average and in more than sixteen at times; a single grid of that radius would compare nearly all with all. So a
    fingerprint has more words, each of which makes some grids of fewer segments, and candidates share a cell in one of
    them. At the similarity 0.8 a pair is missed with a probability of 1e-4 or so (0.007 for sets of five shingles and
    four of them). Buckets that hold the same texts are one; a bucket's texts are compared by their sets
    of shingles, and what comes out are links that join what is linked, not the pairs. A bucket too large for one
    task is dealt in parts, every two of them to a task. Equal texts are one node throughout.
    """
    nodes = Stored(marked.where(F.size("fps") > 0).groupBy("node").agg(F.first("fps").alias("fps"), F.max(F.octet_length("shingles")).alias("bytes")))
    stored = Stored(buckets_of(nodes.df, segments))
    places, mark = stored.df, F.xxhash64("node")
    whole = places.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"), F.bit_xor(mark).alias("x"), F.bit_xor(F.xxhash64(mark, F.lit(1))).alias("y")).where("n > 1")
    parts = F.greatest(F.ceil(F.max("n") / PART), F.ceil(F.max("bytes") / PART_BYTES)).cast("int")
    buckets = Stored(whole.groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket"), parts.alias("parts")).select("bucket", "parts"))
    own = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("node"), F.col("parts"))).otherwise(F.lit(0)).cast("int")
    entries = places.join(buckets.df, "bucket").select("bucket", "node", "parts", own.alias("own"))
    dealt = entries.select("bucket", "node", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    dealt = Stored(dealt.select("bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node"))
    # merge joins whatever the size: what is looked up grows with the texts
    sets = marked.select("node", "shingles").join(dealt.df.select("node").distinct().hint("merge"), "node", "left_semi").dropDuplicates(["node"])
    order = ["bucket", "low", "high"]
    rows = dealt.df.join(sets, "node").repartition(*order).sortWithinPartitions(*order, "node")
    edges = Stored(_linked(rows, similarity))
    for done in (nodes, stored, buckets, dealt):
        done.drop()
    return connected_components(edges.df)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the one with the smallest id, then the smallest hash of its row.

    Two hashes of all columns stand for a row, so texts are not stored beside their fingerprints. What is joined with the documents
    are the rows that go and those that are there twice, the lesser part; of rows that are equal throughout one is
    left. Texts without words are copies of each other; a null id comes last. Columns may have any names.
    """
    columns, prefix = quoted(docs.columns), fresh(docs.columns, "_sh")
    row, state = [f"{prefix}_a", f"{prefix}_b"], f"{prefix}_state"
    named = docs.withColumns({row[0]: F.xxhash64(*columns), row[1]: F.xxhash64(F.lit(1), *columns)})
    segments, words = grids(docs.count())
    marks = Stored(with_wide_fingerprints(named.select("doc_id", "text", *row), "text", "node", "fps", "shingles", words))
    roots = Stored(near_copies(marks.df.select("node", "fps", "shingles"), segments))
    per_row = marks.df.groupBy(*row).agg(F.count("*").alias("times"), F.first("doc_id").alias("doc_id"), F.first("node").alias("node"))
    placed = Stored(per_row.join(roots.df, "node", "left").select(*row, "times", "doc_id", F.coalesce("component", "node").alias("root")))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", *row)
    chosen = placed.df.groupBy("root").agg(F.min_by(F.struct(*row), order).alias("c"))
    judged = placed.df.join(chosen, "root").select(*row, F.when(F.col("c") != F.struct(*row), 0).when(F.col("times") > 1, 2).alias(state))
    states = Stored(judged.where(F.col(state).isNotNull())).df
    for done in (marks, roots, placed):
        done.drop()
    known = named.join(states.hint("merge"), row, "left")
    once = known.where(F.col(state).isNull()).select(*columns)
    return once.unionByName(known.where(F.col(state) == 2).dropDuplicates(row).select(*columns))
