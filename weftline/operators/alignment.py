"""Multiple alignments in cells and blocks: consensus, gap columns, windows, indels, flanks; and pairwise alignment."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions import codons, profiles
from weftline.functions.seq import BASES, LETTERS, bit_planes, chars, compared, count_letters, coverage, degap, kmer_counts, p_distance, thread_back, translate


def cells(rows: DataFrame, seq: str = "seq", *keys: str) -> DataFrame:
    """One row to a character: the keys, ``pos`` (from 0) and ``base``."""
    keys = keys or tuple(c for c in rows.columns if c != seq)
    return rows.select(*keys, F.posexplode(chars(seq)).alias("pos", "base"))


def rebuild(cell_rows: DataFrame, *keys: str, seq: str = "seq") -> DataFrame:
    """Strings out of cells in the order of their places; the longest row bounds what is collected."""
    listed = F.array_sort(F.collect_list(F.struct("pos", "base")))
    return cell_rows.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda x: x["base"]), "").alias(seq))


def consensus(rows: DataFrame, key: str = "locus", seq: str = "seq") -> DataFrame:
    """Majority base of each column among A, C, G and T: ``key, seq``. Ties go to A, T, C, G in this order; a
    column without a base is ?."""
    counts = cells(rows.select(key, seq), seq, key).groupBy(key, "pos").agg(*[F.count_if(F.upper("base") == b).alias(b) for b in "ATCG"])
    most = F.greatest(*"ATCG")
    pick = F.when(most == 0, "?")
    for b in "ATCG":
        pick = pick.when(F.col(b) == most, b)
    return rebuild(counts.select(key, "pos", pick.alias("base")), key)


def consensus_any(rows: DataFrame, key: str = "locus", seq: str = "seq") -> DataFrame:
    """Majority symbol of each column among all but gaps, the smallest on ties; a column of gaps is a gap."""
    counts = cells(rows.select(key, seq), seq, key).groupBy(key, "pos", "base").count()
    rank = F.struct((F.col("base") == "-"), -F.col("count"), F.col("base"))
    return rebuild(counts.groupBy(key, "pos").agg(F.min_by("base", rank).alias("base")), key)


def gap_columns(rows: DataFrame, key: str = "locus", seq: str = "seq", unit: int = 1, share: float = 0.5) -> DataFrame:
    """For each unit of columns whether any column is beyond the gap share and whether all are gaps: ``key, unit, any_gappy, all_gaps``."""
    per = cells(rows.select(key, seq), seq, key).groupBy(key, "pos").agg((F.count_if(F.col("base") == "-").cast("double") / F.count("*")).alias("gaps"))
    return per.groupBy(key, F.floor(F.col("pos") / unit).alias("unit")).agg(F.bool_or(F.col("gaps") > share).alias("any_gappy"), F.bool_and(F.col("gaps") == 1).alias("all_gaps"))


def _keep_units(rows: DataFrame, units: DataFrame, key: str, unit: int, seq: str) -> DataFrame:
    """Each row with only the columns of the units; an equi-join of one array to a key, no cells."""
    kept = units.groupBy(key).agg(F.array_sort(F.collect_list("unit")).alias("_u"))
    cut = F.array_join(F.transform("_u", lambda u: F.substring(F.col(seq), (u * unit + 1).cast("int"), F.lit(unit))), "")
    return rows.join(kept, key, "left").withColumn(seq, F.when(F.col("_u").isNull(), F.lit("")).otherwise(cut)).drop("_u")


def trim_gappy_units(rows: DataFrame, key: str = "locus", seq: str = "seq", unit: int = 3, share: float = 0.5) -> DataFrame:
    """Alignments without units in which a column has too many gaps."""
    return _keep_units(rows, gap_columns(rows, key, seq, unit, share).where("NOT any_gappy"), key, unit, seq)


def drop_gap_columns(rows: DataFrame, key: str = "locus", seq: str = "seq", unit: int = 1) -> DataFrame:
    """Alignments without units that hold nothing but gaps."""
    return _keep_units(rows, gap_columns(rows, key, seq, unit).where("NOT all_gaps"), key, unit, seq)


def windows(length, size: int, step: int) -> Column:
    """Sliding windows (start from 0, length) over columns. The last takes up a rest that is shorter than a step more;
    an alignment shorter than a window is one window."""
    n = length if isinstance(length, Column) else F.col(length)
    last = F.when(n < size + step, F.lit(0)).otherwise((F.floor((n - size) / step) * step).cast("int"))
    starts = F.sequence(F.lit(0), last.cast("int"), F.lit(step))
    return F.when(n > 0, F.transform(starts, lambda s: F.struct(s.cast("int").alias("st"), F.when(s == last, n - s).otherwise(F.lit(size)).cast("int").alias("len"))))


def window_distances(rows: DataFrame, other: DataFrame, key: str = "locus", size: int = 50, step: int = 25, seq: str = "seq") -> DataFrame:
    """p-distance of each window of each row to the one row of its key in ``other`` (``key, other``): ``key, taxon, st, len, pdis``."""
    w = rows.select(key, "taxon", seq, F.explode(windows(F.length(seq), size, step)).alias("w")).join(other, key)
    cut = lambda s: F.substring(F.col(s), F.col("w.st") + 1, F.col("w.len"))
    return w.select(key, "taxon", "w.st", "w.len", p_distance(cut(seq), cut("other"), F.floor(F.col("w.len") / 2)).alias("pdis"))


def drop_distant_rows(rows: DataFrame, reference: DataFrame, key: str = "locus", pdis: float = 0.3, most: int = 0, size: int = 50, step: int = 25) -> DataFrame:
    """Rows with ``most`` windows at most that are farther from the reference than ``pdis``."""
    far = window_distances(rows, reference, key, size, step).where(F.col("pdis") > pdis).groupBy(key, "taxon").count().where(F.col("count") > most)
    return rows.join(far, [key, "taxon"], "left_anti")


def trim_from_distant_window(rows: DataFrame, reference: DataFrame, key: str = "locus", pdis: float = 0.4, size: int = 20, step: int = 10) -> DataFrame:
    """Rows with gaps from their first distant window on."""
    first = window_distances(rows, reference, key, size, step).where(F.col("pdis") > pdis).groupBy(key, "taxon").agg(F.min("st").alias("_cut"))
    cut = F.rpad(F.substring(F.col("seq"), F.lit(1), F.col("_cut")), F.length("seq"), F.lit("-"))
    return rows.join(first, [key, "taxon"], "left").withColumn("seq", F.when(F.col("_cut").isNull(), F.col("seq")).otherwise(cut)).drop("_cut")


def islands(rows: DataFrame, keys: list[str], order: str, flag: Column) -> DataFrame:
    """Runs of consecutive rows for which ``flag`` holds: ``keys, island, n, start, end``. The order counts by one
    within a key after ranking, so gaps in it don't break a run."""
    w = Window.partitionBy(*keys).orderBy(order)
    ranked = rows.withColumn("_f", F.coalesce(flag, F.lit(False))).withColumn("_rn", F.row_number().over(w))
    marked = ranked.where("_f").withColumn("_g", F.col("_rn") - F.row_number().over(w))
    return marked.groupBy(*keys, F.col("_g").alias("island")).agg(F.count("*").alias("n"), F.min(order).alias("start"), F.max(order).alias("end"))


def long_indels(rows: DataFrame, reference: DataFrame, key: str = "locus") -> DataFrame:
    """The longest inner run of insertions or deletions of each row against the reference row: ``key, taxon, longest``.

    Columns that are gaps in both are left out; deletions at either end don't count."""
    pair = rows.join(reference, key)
    both = F.filter(F.zip_with(chars("seq"), chars("other"), lambda x, y: F.concat(F.when(x == "-", "g").otherwise("b"), F.when(y == "-", "g").otherwise("b"))), lambda s: s != "gg")
    # d: deletion in the row, i: insertion, m: both hold a base
    states = F.array_join(F.transform(both, lambda s: F.when(s == "gb", "d").when(s == "bg", "i").otherwise("m")), "")
    inner = F.regexp_replace(states, "^d+|d+$", "")
    longest = F.array_max(F.transform(F.regexp_extract_all(inner, F.lit("d+|i+"), F.lit(0)), lambda r: F.length(r)))
    return pair.select(key, "taxon", F.coalesce(longest, F.lit(0)).alias("longest"))


def drop_long_indels(rows: DataFrame, reference: DataFrame, key: str = "locus", most: int = 10) -> DataFrame:
    return rows.join(long_indels(rows, reference, key).where(F.col("longest") > most), [key, "taxon"], "left_anti")


def dense_start(rows: DataFrame, key: str = "locus", run: int = 5, share: float = 0.5, least: int = 1) -> DataFrame:
    """First column of the first run of columns in which enough rows have a base: ``key, start``. Rows are not to
    hold references."""
    n = F.count_if(F.col("base") != "-")
    per = cells(rows.select(key, "seq"), "seq", key).groupBy(key, "pos").agg(((n >= least) & (n.cast("double") / F.count("*") >= share)).alias("dense"))
    found = islands(per, [key], "pos", F.col("dense")).where(F.col("n") >= run)
    return found.groupBy(key).agg(F.min("start").alias("start"))


def cut_sparse_flank(rows: DataFrame, key: str = "locus", **options) -> DataFrame:
    """Flank blocks up to where the first dense run starts from the far end on; blank where there is none."""
    return rows.join(dense_start(rows, key, **options), key, "left").withColumn("seq", F.when(F.col("start").isNull(), F.lit("")).otherwise(F.expr("substring(seq, start + 1)"))).drop("start")


def blank_private_runs(rows: DataFrame, key: str = "locus", most: int = 10, least_rows: int = 5) -> DataFrame:
    """Rows that alone have bases over more than ``most`` columns in a row are blanked, in keys with enough rows."""
    all_cells = cells(rows.select(key, "taxon", "seq"), "seq", key, "taxon")
    alone = all_cells.where("base <> '-'").groupBy(key, "pos").agg(F.count("*").alias("n"), F.min("taxon").alias("taxon")).where("n = 1")
    w = Window.partitionBy(key, "taxon").orderBy("pos")
    runs = alone.withColumn("_g", F.col("pos") - F.row_number().over(w)).groupBy(key, "taxon", "_g").agg(F.count("*").alias("run")).where(F.col("run") > most).select(key, "taxon").distinct()
    enough = rows.groupBy(key).count().where(F.col("count") >= least_rows).select(key)
    bad = runs.join(enough, key, "left_semi").withColumn("_bad", F.lit(True))
    return rows.join(bad, [key, "taxon"], "left").withColumn("seq", F.when(F.col("_bad"), F.repeat(F.lit("-"), F.length("seq"))).otherwise(F.col("seq"))).drop("_bad")


def drop_poor_rows(rows: DataFrame, least: float = 0.8, is_ref: str = "is_ref") -> DataFrame:
    """Rows that cover enough columns; references stay."""
    return rows.where(F.col(is_ref) | (coverage("seq") >= least))


def drop_references(rows: DataFrame, drop: bool = True, is_ref: str = "is_ref") -> DataFrame:
    return rows.where(~F.col(is_ref)) if drop else rows


def sound_alignments(rows: DataFrame, key: str = "locus", least: int = 100, codon: bool = True, least_rows: int = 2) -> DataFrame:
    """Rows of alignments of one length, long enough, a multiple of three if coding, with a reference and enough rows."""
    n = F.length("seq")
    ok = (F.min(n) == F.max(n)) & (F.min(n) >= least) & (F.count("*") >= least_rows) & F.bool_or("is_ref")
    if codon:
        ok = ok & (F.min(n) % 3 == 0)
    return rows.join(rows.groupBy(key).agg(ok.alias("_ok")).where("_ok"), key, "left_semi")


def poor_blocks(rows: DataFrame, least_bases: int = 10, least_cover: float = 0.65, least_share: float = 0.65, least_rows: int = 1, key: str = "locus") -> DataFrame:
    """Flank rows with too few bases or too little cover are blanked, and blocks with too few rows left are dropped."""
    bases = F.length("seq") - count_letters("seq", "-")
    good = (bases >= least_bases) & (F.coalesce(coverage("seq"), F.lit(0.0)) >= least_cover)
    out = rows.withColumn("seq", F.when(good, F.col("seq")).otherwise(F.repeat(F.lit("-"), F.length("seq"))))
    left = F.count_if(F.col("seq").rlike("[^-]"))
    keep = out.groupBy(key).agg(((left >= least_rows) & (left.cast("double") / F.count("*") >= least_share)).alias("_ok")).where("_ok")
    return out.join(keep, key, "left_semi")


def pairwise(rows: DataFrame, key: str = "locus", letters: str = BASES) -> DataFrame:
    """Distance of each pair of rows of a key, one row to a pair: ``key, a, b, d`` (share of the places with ``letters`` in both that
    differ; null without any). A row is turned to bits once, a pair takes a few steps for each 64 places."""
    planes = rows.select(key, "taxon", bit_planes("seq", letters).alias("_p"))
    one, two = (planes.select(key, F.col("taxon").alias(n), F.col("_p").alias(f"_{n}")) for n in ("a", "b"))
    found = one.join(two, key).where("a < b").select(key, "a", "b", compared(F.col("_a"), F.col("_b"), letters).alias("_c"))
    return found.select(key, "a", "b", F.when(F.col("_c.n") > 0, F.col("_c.diff").cast("double") / F.col("_c.n")).alias("d"))


#: Rows of a block; every two blocks of a key are compared by a task.
BLOCK_ROWS = 256


def pair_sums(rows: DataFrame, keys: list[str], letters: str = BASES, digits: int | None = None, beyond: float | None = None, by_row: bool = False, block: int = BLOCK_ROWS) -> DataFrame:
    """Sums over the pairs of rows of each key, without a row to a pair: ``keys, a, b, n, total``.

    ``n`` pairs that have comparable places, and the sum of their distances (each rounded to ``digits``, if given; halves up): for each two
    blocks of a key's rows, with null ``a`` and ``b``; ``by_row`` for each row ``a`` of a block instead. Pairs
    ``beyond`` a distance come as rows of their own (``a, b, 1, distance``). Two blocks are compared by products of their letters'
    indicators, so a key of many rows is many tasks. Pairs of one name are left out, as are null names and sequences. Without
    ``by_row`` and ``beyond`` equal rows of a key are compared once, and their pairs counted.
    """
    named = rows.where(F.col("taxon").isNotNull() & F.col("seq").isNotNull()).select(*keys, F.col("taxon").cast("string").alias("taxon"), "seq")
    if not by_row and beyond is None:
        repeated = named.groupBy(*keys, "taxon").agg(F.count("*").alias("_w")).where("_w > 1").drop("_w").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate([*keys, "taxon"])])
        met = functools.reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate([*keys, "taxon"])])
        alike = _weighed_sums(named.join(repeated, met, "left_semi"), [*keys, "taxon"], letters, digits, block)
        found = _weighed_sums(named, keys, letters, digits, block).unionByName(alike.select(*keys, (-F.col("n")).alias("n"), (-F.col("total")).alias("total")))
        nothing = F.lit(None).cast("string")
        return found.select(*keys, nothing.alias("a"), nothing.alias("b"), "n", "total")
    dealt = _dealt(named, keys, block, "taxon", "seq")
    schema = T.StructType([*[rows.schema[k] for k in keys], T.StructField("a", T.StringType()), T.StructField("b", T.StringType()), T.StructField("n", T.LongType()), T.StructField("total", T.DoubleType())])

    def run(group: pa.Table) -> pa.Table:
        low, high = group.column("_low")[0].as_py(), group.column("_high")[0].as_py()
        own, names = group.column("_own").to_numpy(), np.array(group.column("taxon").to_pylist(), dtype=object)
        first = np.flatnonzero(own == low)
        second = np.flatnonzero(own == high)
        n, d = _block_distances(group.column("seq").to_pylist(), first, second, letters, digits)
        x, y = names[first][:, None], names[second][None, :]
        on = (n > 0) & (x != y) & ((x < y) if low == high else True)
        out = []
        if by_row:
            for side, axis in ((first, 1), (second, 0)):
                counts, sums = on.sum(axis=axis), np.where(on, d, 0).sum(axis=axis)
                out += [(names[i], None, int(c), float(t)) for i, c, t in zip(side, counts, sums, strict=True) if c]
        else:
            out.append((None, None, int(on.sum()), float(d[on].sum())))
        if beyond is not None:
            out += [(*sorted((names[first[i]], names[second[j]])), 1, float(d[i, j])) for i, j in zip(*np.nonzero(on & (d > beyond)), strict=True)]
        columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.string(), pa.int64(), pa.float64()), strict=True)] if out else [pa.array([], t) for t in (pa.string(), pa.string(), pa.int64(), pa.float64())]
        shared = [group.column(k).combine_chunks().take(pa.array(np.zeros(len(out), dtype=np.int64))) for k in keys]
        return pa.Table.from_arrays([*shared, *columns], names=[*keys, "a", "b", "n", "total"])

    return dealt.groupBy(*keys, "_low", "_high").applyInArrow(run, schema)


def _dealt(rows: DataFrame, keys: list[str], block: int, *columns: str) -> DataFrame:
    """Each row at every two blocks of its key that its own block belongs to: ``keys, _low, _high, _own`` and the columns."""
    many = rows.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias("_many"))
    same = functools.reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    dealt = rows.join(many.select("_many", *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]), same).withColumn("_own", F.pmod(F.xxhash64(*columns), F.col("_many")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_many") - 1)))
    dealt = dealt.select(*keys, F.least("_own", "_other").alias("_low"), F.greatest("_own", "_other").alias("_high"), "_own", *columns)
    # little data and much work: partitions are not merged by their size
    return dealt.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, "_low", "_high")


def _block_distances(seqs: list[str], first: np.ndarray, second: np.ndarray, letters: str, digits: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Comparable places of each row of ``first`` and each of ``second``, and their distances (0 without such places)."""
    raw = [np.frombuffer(s.encode("latin-1", "replace"), dtype=np.uint8) for s in seqs]
    codes = np.zeros((len(raw), max(map(len, raw))), dtype=np.uint8)
    for row, r in zip(codes, raw, strict=True):
        row[: len(r)] = r
    valid = np.isin(codes, np.frombuffer(letters.encode(), dtype=np.uint8))
    n = valid[first].astype(np.float32) @ valid[second].T.astype(np.float32)
    equal = np.zeros_like(n)
    for letter in np.unique(codes[valid]):
        equal += (codes[first] == letter).astype(np.float32) @ (codes[second] == letter).T.astype(np.float32)
    n, equal = n.astype(np.int64), equal.astype(np.int64)
    diff, safe = n - equal, np.maximum(n, 1)
    return n, diff / safe if digits is None else (2 * 10**digits * diff + safe) // (2 * safe) / 10**digits


def _weighed_sums(rows: DataFrame, keys: list[str], letters: str, digits: int | None, block: int) -> DataFrame:
    """``keys, n, total`` over all pairs of rows of a key, whatever their names, for each two blocks of its distinct sequences."""
    weighed = rows.groupBy(*keys, "seq").agg(F.count("*").alias("_w"))
    schema = T.StructType([*[rows.schema[k] for k in keys], T.StructField("n", T.LongType()), T.StructField("total", T.DoubleType())])

    def run(group: pa.Table) -> pa.Table:
        low, high = group.column("_low")[0].as_py(), group.column("_high")[0].as_py()
        own, w = group.column("_own").to_numpy(), group.column("_w").to_numpy()
        first, second = np.flatnonzero(own == low), np.flatnonzero(own == high)
        n, d = _block_distances(group.column("seq").to_pylist(), first, second, letters, digits)
        pairs = np.outer(w[first], w[second])
        if low == high:  # each two once; equal rows are 0 apart
            pairs = np.triu(pairs, 1) + np.diag(w[first] * (w[first] - 1) // 2)
        pairs = np.where(n > 0, pairs, 0)
        shared = [group.column(k).combine_chunks().take(pa.array([0], pa.int64())) for k in keys]
        return pa.Table.from_arrays([*shared, pa.array([int(pairs.sum())], pa.int64()), pa.array([float((pairs * d).sum())], pa.float64())], names=[*keys, "n", "total"])

    return _dealt(weighed, keys, block, "seq", "_w").groupBy(*keys, "_low", "_high").applyInArrow(run, schema)


def mean_distance(rows: DataFrame, key: str = "locus", letters: str = BASES, digits: int | None = None) -> DataFrame:
    """Mean over the pairs of each key's rows: ``key, mean_distance``, null without a pair that can be compared. Keys of one row
    have none."""
    sums = pair_sums(rows, [key], letters, digits).groupBy(key).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    pairs = rows.groupBy(key).agg(F.count_distinct("taxon").alias("_t")).where("_t > 1").select(key)
    return sums.join(pairs, key, "left_semi").select(key, F.when(F.col("n") > 0, F.col("total") / F.col("n")).alias("mean_distance"))


def drop_deviant(rows: DataFrame, most: float = 0.4, key: str = "locus") -> DataFrame:
    """Rows without those that are far from others: of each distant pair, by falling distance, the row with the larger
    mean distance goes (the later name on ties) unless one of the two is gone already.

    The rule depends on its order, so a key's distant pairs are handled by one task; means are sums from blocks of rows, and
    of the other pairs nothing is kept."""
    sums = pair_sums(rows, [key], LETTERS, 3, most, by_row=True)
    means = sums.where("b IS NULL").groupBy(key, "a").agg((F.sum("total") / F.sum("n")).alias("mean"))
    far = sums.where("b IS NOT NULL").select(key, "a", "b", F.col("total").alias("d"))
    far = far.join(means.withColumnRenamed("mean", "ma"), [key, "a"]).join(means.select(key, F.col("a").alias("b"), F.col("mean").alias("mb")), [key, "b"])

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        gone: set[str] = set()
        ordered = group.sort_values(["d", "a", "b"], ascending=[False, True, True])
        for a, b, x, y in zip(ordered["a"], ordered["b"], ordered["ma"], ordered["mb"], strict=True):
            if a not in gone and b not in gone:
                gone.add(max((x, a), (y, b))[1])
        return pd.DataFrame([(group[key].iloc[0], t) for t in sorted(gone)], columns=[key, "taxon"], dtype=object)

    kind = rows.schema[key].dataType
    gone = far.groupBy(key).applyInPandas(choose, T.StructType([T.StructField(key, kind), T.StructField("taxon", T.StringType())]))
    return rows.join(gone, [key, "taxon"], "left_anti")


def flank_blocks(flanked: DataFrame, coding: DataFrame, most_deviation: int = 3, key: str = "locus") -> DataFrame:
    """Left, coding and right block of each row of flanked alignments, cut at the first reference's coding part.

    ``flanked`` and ``coding`` hold ``key, taxon, seq, is_ref``. Where a row's own coding part lies elsewhere than
    the reference's, its blocks are padded with gaps to the common lengths; a flank shorter than the reference's by more
    than ``most_deviation`` columns leaves its row out."""
    from weftline.functions.seq import locate_ungapped

    rows = flanked.join(coding.select(key, "taxon", F.col("seq").alias("_nf")), [key, "taxon"])
    rows = rows.withColumn("_at", locate_ungapped("seq", "_nf")).where("_at IS NOT NULL")
    ref = rows.where("is_ref").groupBy(key).agg(F.min_by("_at", "taxon").alias("_ref"))
    rows = rows.join(ref, key).where((F.col("_at.left") >= F.col("_ref.left") - most_deviation) & (F.col("_at.right") >= F.col("_ref.right") - most_deviation))
    left, right = F.expr("substring(seq, 1, _at.left)"), F.expr("substring(seq, _at.left + _at.coding + 1)")
    out = rows.select(key, "taxon", "is_ref", left.alias("left"), F.col("_nf").alias("coding"), right.alias("right"))
    widest = out.groupBy(key).agg(F.max(F.length("left")).alias("_l"), F.max(F.length("coding")).alias("_c"), F.max(F.length("right")).alias("_r"))
    pad = lambda f, c, n: F.when(F.col(n) > 0, f(F.col(c), F.col(n), F.lit("-"))).otherwise(F.lit(""))
    return out.join(widest, key).select(key, "taxon", "is_ref", pad(F.lpad, "left", "_l").alias("left"), pad(F.rpad, "coding", "_c").alias("coding"), pad(F.rpad, "right", "_r").alias("right"))


def flank_sides(flanked: DataFrame, coding: DataFrame, key: str = "locus") -> DataFrame:
    """What each side of the join of flanked and coding rows lacks: ``key, both, only_flanked, only_coding`` (taxa). A key
    with nothing in ``both`` is in one of the tables alone."""
    one = flanked.select(key, "taxon").distinct().withColumn("_f", F.lit(True))
    two = coding.select(key, "taxon").distinct().withColumn("_c", F.lit(True))
    sides = one.join(two, [key, "taxon"], "full_outer")
    f, c = F.col("_f").isNotNull(), F.col("_c").isNotNull()
    return sides.groupBy(key).agg(F.count_if(f & c).alias("both"), F.count_if(f & ~c).alias("only_flanked"), F.count_if(c & ~f).alias("only_coding"))


def reversed_block(rows: DataFrame, seq: str = "seq") -> DataFrame:
    """A left flank turned round, so that rules for right flanks serve it too; applied twice it is the identity."""
    return rows.withColumn(seq, F.reverse(seq))


def needs_realignment(rows: DataFrame, key: str = "locus", least: float = 0.8) -> DataFrame:
    """Keys with a row of which less than ``least`` are bases."""
    return rows.groupBy(key).agg((F.min(F.coalesce(coverage("seq"), F.lit(0.0))) < least).alias("gapful"))


# pairwise and multiple alignment: dynamic programming over arrays, a key at a time


def _global(a: str, b: str, match: float = 2, mismatch: float = -1, gap: float = -3) -> tuple[str, str]:
    """Global alignment of two strings; of equal ways the diagonal one, then a gap in the second."""
    n, m = len(a), len(b)
    x, y = np.frombuffer(a.encode("utf-32-le"), dtype="<u4"), np.frombuffer(b.encode("utf-32-le"), dtype="<u4")
    score = np.zeros((n + 1, m + 1))
    score[0] = gap * np.arange(m + 1)
    steps = gap * np.arange(m + 1)
    for i in range(1, n + 1):
        best = np.empty(m + 1)
        best[0] = gap * i
        best[1:] = np.maximum(score[i - 1, :-1] + np.where(x[i - 1] == y, match, mismatch), score[i - 1, 1:] + gap)
        score[i] = np.maximum.accumulate(best - steps) + steps  # gaps along the row
    out, i, j = [], n, m
    while i or j:
        if i and j and score[i, j] == score[i - 1, j - 1] + (match if x[i - 1] == y[j - 1] else mismatch):
            i, j = i - 1, j - 1
            out.append((a[i], b[j]))
        elif i and score[i, j] == score[i - 1, j] + gap:
            i -= 1
            out.append((a[i], "-"))
        else:
            j -= 1
            out.append(("-", b[j]))
    return "".join(p for p, _ in reversed(out)), "".join(q for _, q in reversed(out))


def star_alignment(seqs: list[str]) -> list[str]:
    """The plain way that :func:`align` is measured against: strings aligned to the longest of them (the first on ties), gaps once made staying made."""
    if not seqs:
        return []
    centre = max(range(len(seqs)), key=lambda i: (len(seqs[i]), -i))
    rows, base = {centre: seqs[centre]}, seqs[centre]
    for i, s in enumerate(seqs):
        if i == centre:
            continue
        c, r = _global(base.replace("-", ""), s)
        merged: list[str] = []
        new: list[str] = []
        old = {k: [] for k in rows}
        p = q = 0
        while p < len(base) or q < len(c):
            if p < len(base) and base[p] == "-" and not (q < len(c) and c[q] == "-"):
                merged.append("-"), new.append("-")
                for k in old:
                    old[k].append(rows[k][p])
                p += 1
            elif q < len(c) and c[q] == "-" and not (p < len(base) and base[p] == "-"):
                merged.append("-"), new.append(r[q])
                for k in old:
                    old[k].append("-")
                q += 1
            else:
                merged.append(base[p]), new.append(r[q])
                for k in old:
                    old[k].append(rows[k][p])
                p, q = p + 1, q + 1
        base = "".join(merged)
        rows = {k: "".join(v) for k, v in old.items()} | {i: "".join(new)}
    return [rows[i] for i in range(len(seqs))]


def _pivot_places(rows: DataFrame, key: str, seq: str, k: int, pivots: int) -> DataFrame:
    """Distances of each row (``_n`` within its key) to some rows of the key, by shared k-mers: ``key, _n, at`` (pivot and distance).

    Pivots are drawn by a hash, so the join grows with the rows, not with their pairs. Nothing is broadcast: what Spark
    estimates from the size of a file is far below what its k-mers take."""
    drawn = Window.partitionBy(key).orderBy(F.xxhash64(seq), "_n")
    chosen = rows.withColumn("_d", F.row_number().over(drawn)).where(F.col("_d") <= pivots).select(key, seq, "_d", F.length(seq).alias("_m"))
    mine = kmer_counts(rows, seq, k, key, "_n")
    theirs = kmer_counts(chosen, seq, k, key, "_d").withColumnRenamed("times", "_times")
    shared = mine.join(theirs.hint("merge"), [key, "kmer"]).groupBy(key, "_n", "_d").agg(F.sum(F.least("times", "_times")).alias("shared"))
    both = shared.join(rows.select(key, "_n", F.length(seq).alias("_l")).hint("merge"), [key, "_n"]).join(chosen.drop(seq).hint("merge"), [key, "_d"])
    apart = 1 - F.col("shared") / F.greatest(F.lit(1), F.least("_l", "_m") - k + 1)
    return both.groupBy(key, "_n").agg(F.collect_list(F.struct(F.col("_d").alias("d"), apart.alias("x"))).alias("_at"))


def align(rows: DataFrame, key: str = "locus", seq: str = "seq", order: str = "taxon", protein: bool = False, k: int | None = None, pivots: int = 32) -> DataFrame:
    """Unaligned rows as multiple alignments, progressively: k-mer distances to ``pivots`` rows of each key by a join, a
    guide tree by mean distance, and profiles aligned along it with affine gaps. Letters come out in upper case.

    Distances of a key's rows are spread over tasks; its merges are made by one task. Rows of a null key form a key; null
    sequences are empty and all gaps."""
    k = k or (3 if protein else 6)
    bare = rows.withColumn(seq, F.upper(degap(F.coalesce(seq, F.lit("")))))
    numbered = bare.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order, seq)))
    places = _pivot_places(numbered.select(key, "_n", seq), key, seq, k, pivots)
    joined = numbered.join(places.withColumnRenamed(key, "_key").withColumnRenamed("_n", "_m").hint("merge"), F.col(key).eqNullSafe(F.col("_key")) & (F.col("_n") == F.col("_m")), "left").drop("_key", "_m")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_n", kind="stable").astype({seq: object})
        at = np.ones((len(group), pivots))
        for row, found in zip(at, group["_at"], strict=True):
            for f in found if found is not None else ():
                row[f["d"] - 1] = f["x"]
        return group.assign(**{seq: pd.Series(profiles.progressive(group[seq].tolist(), at, protein), index=group.index, dtype=object)}).drop(columns=["_n", "_at"])

    # little data and much work: partitions are not merged by their size
    spread = joined.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
    return spread.groupBy(key).applyInPandas(run, bare.schema)


def align_codons(rows: DataFrame, key: str = "locus") -> DataFrame:
    """Coding rows aligned as proteins and threaded back; rows whose length is no multiple of three are left out."""
    bare = rows.withColumn("seq", degap("seq")).where("length(seq) % 3 = 0 AND length(seq) > 0")
    aligned = align(bare.withColumns({"_dna": F.col("seq"), "seq": translate("seq")}), key, protein=True)
    return aligned.withColumn("seq", thread_back("seq", "_dna")).drop("_dna")


def extend_diagonals(found: DataFrame, drop: int, match: int, mismatch: int) -> DataFrame:
    """Ungapped extension of seeds on diagonals, with the columns of a hit."""
    schema = "query string, target string, strand string, qlo long, qhi long, tlo long, thi long, bits double, id double"

    def best_reach(same: np.ndarray) -> int:
        total = np.cumsum(np.where(same, match, mismatch))
        if not len(total):
            return 0
        peak = np.maximum.accumulate(np.maximum(total, 0))
        stop = np.flatnonzero(total < peak - drop)
        total = total[: stop[0]] if len(stop) else total
        return int(np.argmax(total)) + 1 if len(total) and total.max() > 0 else 0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples():
                d, lo, hi = int(r.diagonal), int(r.lo) - 1, int(r.hi)
                q, t = np.frombuffer(r.qseq.encode(), dtype=np.uint8), np.frombuffer(r.tseq.encode(), dtype=np.uint8)
                end = min(len(q), len(t) - d)
                start = max(0, -d)
                same = q[start:end] == t[start + d : end + d]
                hi += best_reach(same[hi - start :])
                lo -= best_reach(same[: lo - start][::-1])
                inside = same[lo - start : hi - start]
                n, ok = len(inside), int(inside.sum())
                qlo, qhi = (lo + 1, hi) if r.strand == "+" else (len(q) - hi + 1, len(q) - lo)
                out.append((r.query, r.target, r.strand, qlo, qhi, lo + d + 1, hi + d, float(ok * match + (n - ok) * mismatch), 100.0 * ok / n))
            yield pd.DataFrame(out, columns=["query", "target", "strand", "qlo", "qhi", "tlo", "thi", "bits", "id"])

    return found.mapInPandas(run, schema)


def protein_alignment(dna: str, protein: str, gap: float = -4) -> tuple[int, int, int, int, int, float] | None:
    """Best local alignment of a protein with the three forward frames of a sequence: frame, the protein's start and
    end, the sequence's start and end in bases, and the score (match 5, mismatch -2); None without one."""
    from weftline.functions.seq import CODONS

    best = None
    for frame in range(3):
        aa = "".join(CODONS.get(dna[i : i + 3], "X") for i in range(frame, len(dna) - 2, 3))
        if not aa or not protein:
            continue
        x, y = np.frombuffer(protein.encode(), dtype=np.uint8), np.frombuffer(aa.encode(), dtype=np.uint8)
        score = np.zeros((len(x) + 1, len(y) + 1))
        steps = gap * np.arange(len(y) + 1)
        for i in range(1, len(x) + 1):
            row = np.zeros(len(y) + 1)
            row[1:] = np.maximum(0, np.maximum(score[i - 1, :-1] + np.where(x[i - 1] == y, 5, -2), score[i - 1, 1:] + gap))
            score[i] = np.maximum.accumulate(row - steps) + steps
        i, j = np.unravel_index(np.argmax(score), score.shape)
        top = float(score[i, j])
        if top <= 0 or (best and top <= best[5]):
            continue
        ei, ej = int(i), int(j)
        while i and j and score[i, j] > 0:
            if score[i, j] == score[i - 1, j - 1] + (5 if x[i - 1] == y[j - 1] else -2):
                i, j = i - 1, j - 1
            elif score[i, j] == score[i - 1, j] + gap:
                i -= 1
            else:
                j -= 1
        best = (frame, int(i), ei, frame + 3 * int(j), frame + 3 * ej, top)
    return best


def align_proteins(rows: DataFrame, costs: codons.Costs = codons.Costs()) -> DataFrame:
    """Contigs against the protein of their locus (``locus, contig, seq, protein``), on the better strand (``+`` on ties).

    The best local alignment has affine gaps of whole codons and may shift the frame. ``stq, edq`` are residues, ``sts, eds`` bases of the strand that is
    aligned (from 0, ends exclusive); ``sim`` is the percentage of columns that score above zero, ``shifts`` counts shifts of the frame. Contigs
    without a residue in common, and null or empty sequences, give no row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            turned = [s[::-1].translate(str.maketrans("ATCGatcg", "TAGCtagc")) for s in batch["seq"]]
            both = codons.best_local_batched([*batch["protein"], *batch["protein"]], [*batch["seq"], *turned], costs)
            one, two = both[: len(batch)], both[len(batch) :]
            plus = one[:, 0] >= two[:, 0]
            found = np.where(plus[:, None], one, two)
            out = batch[["locus", "contig"]].assign(**{c: found[:, k] for k, c in ((1, "stq"), (2, "edq"), (3, "sts"), (4, "eds"))})
            out = out.assign(strand=np.where(plus, "+", "-"), score=found[:, 0].astype(float), sim=100 * found[:, 5] / np.maximum(found[:, 6], 1), shifts=found[:, 7])
            yield out[found[:, 0] > 0]

    there = rows.select("locus", "contig", "seq", "protein").where((F.length("seq") > 0) & (F.length("protein") > 0))
    # little data and much work: a small file is one partition otherwise
    there = there.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return there.mapInPandas(run, "locus string, contig string, stq long, edq long, sts long, eds long, strand string, score double, sim double, shifts long").withColumn("sim", F.round("sim", 2))
