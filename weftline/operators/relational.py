"""Deduplication, best matches, set membership and unions on tables of any kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.seq import canonical, masked_share


def dedup(rows: DataFrame, key: Column, order: list, reduce: str = "first") -> DataFrame:
    """The first row of each key in the given order; nulls come last in every part of it.

    An aggregate with partial maxima, so copies are dropped before the shuffle and a key with many rows does not
    meet whole in one task."""
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    return rows.groupBy(key.alias("_key")).agg(F.min_by(whole, nulls_last(order)).alias("_r")).select("_r.*")


def nulls_last(order: list) -> Column:
    """An order of several columns as one value, with nulls above all else."""
    parts = [F.col(c) if isinstance(c, str) else c for c in order]
    return F.struct(*[x for k, c in enumerate(parts) for x in (c.isNull().alias(f"n{k}"), c.alias(f"v{k}"))])


def dedup_either_strand(rows: DataFrame, seq: str, order: list, strand=canonical) -> DataFrame:
    """The first of rows whose sequences are equal on either strand."""
    return dedup(rows, strand(F.col(seq)), order)


def dedup_pairs(pairs: DataFrame) -> DataFrame:
    """Read pairs without duplicates: joined mates, either strand, the smallest pair id stays; per sample."""
    joined = pairs.withColumn("_joined", canonical(F.concat("seq1", "seq2")))
    return dedup(joined, F.struct("sample", "_joined"), ["pair_id"]).drop("_joined")


def counts_before_after(before: DataFrame, after: DataFrame, key: str, size: Column) -> DataFrame:
    """Rows and summed sizes of each key in two tables; zero where a key is in one alone."""
    one = before.groupBy(key).agg(F.count("*").alias("n_before"), F.sum(size).alias("size_before"))
    two = after.groupBy(key).agg(F.count("*").alias("n_after"), F.sum(size).alias("size_after"))
    zero = F.lit(0).cast("long")
    return one.join(two, key, "full_outer").select(key, *[F.coalesce(c, zero).alias(c) for c in ("n_before", "size_before", "n_after", "size_after")])


def best_per_key(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The best row of each key by a total order. ``order`` holds columns to minimise; use a negative to maximise. A
    null score never beats another; a key that has no other keeps a row of these."""
    return dedup(rows, F.struct(*keys), order)


def best_and_second(rows: DataFrame, keys: list[str], score: str, least_gap: float, ties: list) -> DataFrame:
    """Best and second score of each key, and whether the best is alone or ahead by ``least_gap``.

    Rows without a score count in ``n`` alone; a key without any score has no best and none that is unique. Two ranks
    need no more than the two largest rows of a key, which partial aggregates keep."""
    pair = F.struct((-F.col(score)).alias("s"), *ties)
    first = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min(F.when(F.col(score).isNotNull(), pair)).alias("_best"))
    rest = rows.where(F.col(score).isNotNull()).join(first, keys).where(pair > F.col("_best")).groupBy(*keys).agg(F.max(score).alias("second"))
    out = first.join(rest, keys, "left").select(*keys, "n", (-F.col("_best.s")).alias("best"), F.col("second"))
    ahead = F.coalesce(F.col("best") - F.col("second") >= least_gap, F.lit(True))
    return out.withColumn("unique_best", F.col("best").isNotNull() & ahead)


def keep_members(rows: DataFrame, members: DataFrame, key: str) -> DataFrame:
    return rows.join(members.select(key).distinct(), key, "left_semi")


def drop_members(rows: DataFrame, members: DataFrame, key: str) -> DataFrame:
    return rows.join(members.select(key).distinct(), key, "left_anti")


def pick_taxa(rows: DataFrame, selected: DataFrame | None = None, deselected: DataFrame | None = None, essential: DataFrame | None = None, min_seq: int = 2, drop_duplicates: bool = False, group: str = "locus", member: str = "taxon", order: str = "ord") -> DataFrame:
    """Rows of selected (or all but deselected) members, in groups that hold all essential ones and enough rows.

    Duplicates are dropped before rows are counted, and essential members count once."""
    if selected is not None and deselected is not None:
        raise ValueError("either selected or deselected")
    if selected is not None:
        rows = keep_members(rows, selected, member)
    if deselected is not None:
        rows = drop_members(rows, deselected, member)
    if drop_duplicates:
        rows = dedup(rows, F.struct(group, member), [order])
    if essential is not None:
        rows = rows.join(divide(rows, essential, group, member), group, "left_semi")
    return at_least(rows, group, min_seq)


def divide(rows: DataFrame, members: DataFrame, group: str, member: str) -> DataFrame:
    """Groups that hold every one of ``members``: relational division by counting distinct ones. Null members don't
    count; where there are no members at all, every group holds them."""
    wanted = members.select(member).where(F.col(member).isNotNull()).distinct().withColumn("_wanted", F.lit(True))
    marked = rows.select(group, member).join(wanted, member, "left")
    held = marked.groupBy(group).agg(F.count_distinct(F.when(F.col("_wanted"), F.col(member))).alias("_n"))
    return held.where(F.col("_n") == wanted.agg(F.count("*")).scalar()).select(group)


def at_least(rows: DataFrame, group: str, n: int) -> DataFrame:
    """Rows of groups with ``n`` rows or more."""
    return rows.join(rows.groupBy(group).count().where(F.col("count") >= n), group, "left_semi")


def duplicates(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys with more than one row and how many they have."""
    return rows.groupBy(*keys).count().where("count > 1")


def merge_tables(parts: list[DataFrame], group: str = "locus", min_seq: int = 2, essential_sources: list[int] | None = None, essential: DataFrame | None = None, member: str = "taxon") -> DataFrame:
    """Tables one after the other with the number of their source (``source_ord``); groups filtered as asked for."""
    out = None
    for k, part in enumerate(parts):
        part = part.withColumn("source_ord", F.lit(k))
        out = part if out is None else out.unionByName(part)
    if essential_sources:
        wanted = out.sparkSession.createDataFrame([(k,) for k in essential_sources], "source_ord int")
        out = out.join(divide(out, wanted, group, "source_ord"), group, "left_semi")
    if essential is not None:
        out = out.join(divide(out, essential, group, member), group, "left_semi")
    return at_least(out, group, min_seq)


def missing_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of either table that the other lacks: ``key, side`` (the table that has it)."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("right")))


def assign_reads(hits: DataFrame, max_evalue: float | None = None) -> DataFrame:
    """The target with the most bits of each read (the smallest name on ties): ``sample, read_id, target, bits, ...``."""
    if max_evalue is not None and "evalue" in hits.columns:
        hits = hits.where(F.col("evalue") <= max_evalue)
    keys = [k for k in ("sample", "read_id") if k in hits.columns]
    return best_per_key(hits, keys, [-F.col("bits"), "target"])


def assign_pairs(best: DataFrame, pairs: DataFrame) -> DataFrame:
    """Both mates of a pair at every target that either of them hit."""
    keys = [k for k in ("sample",) if k in best.columns and k in pairs.columns]
    hit = best.select(*keys, F.regexp_replace("read_id", "/[12]$", "").alias("pair_id"), "target").distinct()
    return pairs.join(hit, [*keys, "pair_id"])


def unmasked_pairs(reads: DataFrame, hits: DataFrame | None = None, most: float = 1.0, pair: str = "pair_id") -> DataFrame:
    """Pairs whose mates all have a masked share of ``most`` at most, in the hit region or, without a hit, in the whole read."""
    rows = reads if hits is None else reads.join(hits.select("read_id", "qlo", "qhi"), "read_id", "left")
    share = masked_share("seq") if hits is None else masked_share("seq", "qlo", "qhi")
    return rows.groupBy(pair).agg(F.bool_and(share <= most).alias("ok")).where("ok").select(pair)


def one_per_group(rows: DataFrame, keys: list[str], seed: str, *identity: str) -> DataFrame:
    """One row of each group by the smallest hash of a seed and the row's identity: a draw that repeats."""
    return dedup(rows, F.struct(*keys), [F.md5(F.concat_ws("|", F.lit(seed), *[F.col(c).cast("string") for c in identity])), *identity])


def interval_join(left: DataFrame, right: DataFrame, on: list[str], a: tuple[str, str], b: tuple[str, str], bin_size: int | None = None, how: str = "inner") -> DataFrame:
    """Rows whose closed intervals overlap and whose keys are equal.

    An equi-join with a residual condition. Where a key holds many intervals, ``bin_size`` deals them to bins: both
    sides go to each bin they touch, and a pair counts in the first bin that both touch."""
    (p1, p2), (q1, q2) = a, b
    overlap = (F.col(f"_l.{p1}") <= F.col(f"_r.{q2}")) & (F.col(f"_l.{p2}") >= F.col(f"_r.{q1}"))
    if bin_size is None:
        keys = [F.col(f"_l.{k}") == F.col(f"_r.{k}") for k in on]
        cond = overlap
        for k in keys:
            cond = cond & k
        rest = [F.col(f"_r.{c}") for c in right.columns if c not in on]
        return left.alias("_l").join(right.alias("_r"), cond, how).select("_l.*", *rest)
    if how != "inner":
        raise ValueError("bins serve inner joins")
    bins = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / bin_size), F.floor(F.col(hi) / bin_size)))
    one, two = left.withColumn("_bin", bins(p1, p2)).alias("_l"), right.withColumn("_bin", bins(q1, q2)).alias("_r")
    cond = overlap & (F.col("_l._bin") == F.col("_r._bin"))
    for k in on:
        cond = cond & (F.col(f"_l.{k}") == F.col(f"_r.{k}"))
    first = F.col("_l._bin") == F.greatest(F.floor(F.col(f"_l.{p1}") / bin_size), F.floor(F.col(f"_r.{q1}") / bin_size))
    rest = [F.col(f"_r.{c}") for c in right.columns if c not in on]
    return one.join(two, cond).where(first).select(*[F.col(f"_l.{c}") for c in left.columns], *rest)


def reciprocal_best(forward: DataFrame, backward: DataFrame, order_forward: list, order_backward: list) -> DataFrame:
    """Pairs that are each other's best: ``a, b``. ``forward`` and ``backward`` hold ``a, b`` and what they are ordered by."""
    there = best_per_key(forward, ["a"], order_forward).select("a", "b")
    back = best_per_key(backward, ["b"], order_backward).select("a", "b")
    return there.join(back, ["a", "b"])


def _nearest(rows: DataFrame, others: DataFrame, on: list[str], own: str, other: str) -> DataFrame:
    """The row of ``others`` whose value ``v`` is nearest to each row's, the smallest ``other`` on ties: ``own, other``."""
    kinds = others.groupBy(*on, "v").agg(F.min(other).alias("_o"))
    both = rows.select(*on, "v", F.col(own).alias("_own"), F.lit(None).cast(kinds.schema["_o"].dataType).alias("_o"), F.lit(True).alias("_mine")).unionByName(kinds.select(*on, "v", F.lit(None).cast(rows.schema[own].dataType).alias("_own"), "_o", F.lit(False).alias("_mine")))
    met = F.when(~F.col("_mine") & F.col("v").isNotNull(), F.struct("v", "_o"))
    side = lambda order: F.last(met, ignorenulls=True).over(Window.partitionBy(*on).orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    found = both.select("_own", "_mine", "v", side(F.col("v").asc()).alias("_below"), side(F.col("v").desc()).alias("_above"), F.min("_o").over(Window.partitionBy(*on)).alias("_any")).where("_mine")
    apart = lambda c: F.when(F.col("v").isNotNull() & F.col(c).isNotNull(), F.struct(F.abs(F.col("v") - F.col(f"{c}.v")).alias("d"), F.col(f"{c}._o").alias("o")))
    best = F.coalesce(F.least(apart("_below"), apart("_above")), F.when(F.col("_any").isNotNull(), F.struct(F.lit(None).cast("double").alias("d"), F.col("_any").alias("o"))))
    return found.where(best.isNotNull()).groupBy(F.col("_own").alias(own)).agg(F.min_by(best, F.struct(best["d"].isNull(), best)).alias("_b")).select(own, F.col("_b.o").alias(other))


def reciprocal_nearest(left: DataFrame, right: DataFrame, on: list[str], a: str, b: str) -> DataFrame:
    """Pairs of rows of equal keys that are each other's nearest by their values ``v``: ``a, b``. Of equally near ones the smallest is nearest;
    rows without a value are near to none, and nearest to the smallest where there is no other.

    The nearest value lies next to a row's own in their order, on either side, so pairs are not made: rows of a key are sorted and walked over."""
    one, two = (t.where(" AND ".join(f"`{k}` IS NOT NULL" for k in on)).withColumn("v", F.col("v").cast("double")).withColumn("v", F.when(~F.isnan("v"), F.col("v"))) for t in (left, right))
    return _nearest(one, two, on, a, b).join(_nearest(two, one, on, b, a), [a, b])


def group_share(rows: DataFrame, group: str, member: str) -> DataFrame:
    """Distinct members of each group and the percentage of all members: ``group, n, pct``."""
    total = rows.agg(F.count_distinct(member)).scalar()
    per = rows.groupBy(group).agg(F.count_distinct(member).alias("n"))
    return per.withColumn("pct", F.round(F.col("n").cast("double") * 100 / total, 2))


def failed_counts(rows: DataFrame) -> DataFrame:
    """Rows of each category and sample."""
    return rows.groupBy("category", "sample").agg(F.count("*").alias("n"))
