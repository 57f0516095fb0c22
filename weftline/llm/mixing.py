"""Mixing sources to target weights, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Stored, fresh, quoted, table, word_count

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: Share of all sizes that the mix takes, as a ratio of integers, and the most that a source is repeated.
SHARE = (3, 2)
MOST = 2
SEED = 20
#: A table of sources with so many rows at most is broadcast.
MOST_BROADCAST = 10_000


def numbered(rows: DataFrame, order: Column, to: str) -> DataFrame:
    """``rows`` (a stored table, say) with their place in an order, from 0, without bringing them to one task.

    Ranges are sorted each by itself; what is added up over tasks is one count a range."""
    placed = rows.repartitionByRange(order).sortWithinPartitions(order).select(*rows.columns, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row"))
    placed = Stored(placed).df
    sizes = placed.groupBy("_part").agg(F.count("*").alias("n"), F.min("_row").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = sizes.select("_part", (before - F.col("first")).alias("_shift"))
    return placed.join(F.broadcast(shifts), "_part").select(*rows.columns, (F.col("_row") + F.col("_shift")).alias(to))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, most: int = MOST) -> DataFrame:
    """Target of each source: ``source, source_size, target``.

    ``sizes`` has ``source`` and ``size``. Sources take the weights in the order of their code points, null
    last. What is shared is ``share`` of all sizes; a target stops at ``most`` times its source's size and the
    excess is shared again by weight until none is above. A round is an aggregate of two numbers over the sources,
    so they never meet in one task, and all sums are integers in units of one ``share[1]``-th, so nothing is
    rounded before the last division. A source of size zero has target zero; an empty table gives no rows.
    """
    whole, part = share
    per = Stored(sizes.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("source_size"))).df
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.pmod(F.col("_k"), F.lit(len(weights))) + 1).cast("int"))
    per = numbered(per, F.col("source").asc_nulls_last(), "_k").select("source", "source_size", weight.alias("_w"), (F.col("source_size") * most * part).alias("_cap"))
    total = per.agg(F.coalesce(F.sum("source_size"), F.lit(0)) * whole, F.coalesce(F.sum("_w"), F.lit(0))).first()
    left, open_ = int(total[0]), int(total[1])
    full = F.lit(False)
    while open_:
        # within a round the shares of those still open only grow, so one that is full stays full
        full = F.col("_cap").cast("decimal(38,0)") * F.lit(open_) <= F.lit(left).cast("decimal(38,0)") * F.col("_w")
        held = per.where(full).agg(F.coalesce(F.sum("_cap"), F.lit(0)), F.coalesce(F.sum("_w"), F.lit(0))).first()
        now = int(total[0]) - int(held[0]), int(total[1]) - int(held[1])
        if now == (left, open_):
            break
        left, open_ = now
    shared = (F.lit(left) * F.col("_w")).cast("double") / F.lit(max(1, open_ * part))
    return per.select("source", "source_size", F.when(full, F.col("_cap").cast("double") / part).otherwise(shared).alias("target"))


def copies(rate: Column, *seed: Column) -> Column:
    """floor(rate) copies and one more with the fraction as its probability, drawn from a hash of ``seed``."""
    draw = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(SEED)), *seed)), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
    return (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", prefix: str = "_mix") -> DataFrame:
    """``docs`` with ``_mix_size``, ``_mix_source_size``, ``_mix_target`` and ``_mix_copies`` beside their columns.

    The sizes are aggregated before they are shuffled. The table of sources is broadcast if it has few rows, so
    the texts aren't shuffled and a source that holds a third of all rows meets in no single task; a longer one is
    joined as the optimiser sees fit. The draw hashes key, source and text, so reruns agree whatever the partitions
    are, and rows of one key draw apart unless they are copies of each other. A null text has size 0, a null key,
    source or text draws as the empty string, a null source is a source of its own. Columns of ``docs`` with the new
    names are replaced; another ``prefix`` keeps them.
    """
    size, total, target, number, held = (f"{prefix}_{x}" for x in ("size", "source_size", "target", "copies", "source"))
    docs = docs.drop(size, total, target, number, held)
    sized = docs.withColumn(size, word_count(F.col(text)))
    slim = docs.select(F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    targets = Stored(source_targets(slim).select(F.col("source").alias(held), F.col("source_size").alias(total), F.col("target").alias(target))).df
    if targets.count() <= MOST_BROADCAST:
        targets = F.broadcast(targets)
    rate = F.when(F.col(total) > 0, F.col(target) / F.col(total)).otherwise(F.lit(0.0))
    seed = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (key, source)] + [F.md5(F.coalesce(F.col(text), F.lit("")))]
    return sized.join(targets, F.col(source).eqNullSafe(F.col(held)), "left").withColumn(number, copies(rate, *seed)).drop(held)


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select(
        "doc_id",
        F.col("_mix_size").alias("size"),
        F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"),
        (F.col("_mix_size") * F.col("_mix_copies")).alias("taken"),
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; columns of any name, null and repeated keys and null texts as in ``mix``."""
    prefix = fresh(docs.columns, "_mix")
    mixed = mix(docs, prefix=prefix).where(f"{prefix}_copies > 0")
    return mixed.withColumn(f"{prefix}_copy", F.explode(F.sequence(F.lit(1), F.col(f"{prefix}_copies").cast("int")))).select(*quoted(docs.columns))


def mix_sql(docs: str) -> str:
    """The common table expressions of the mix over the relation ``docs``, ending in ``mixed``."""
    words = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"
    weights = ", ".join(map(str, WEIGHTS))
    return f"""
mix_sized AS (SELECT *, CAST({words} AS BIGINT) AS mix_size FROM {docs}),
mix_per AS (SELECT source AS s, CAST(sum(mix_size) AS BIGINT) AS ss FROM mix_sized GROUP BY source),
mix_w AS (SELECT s, ss, CAST({MOST * SHARE[1]} * ss AS BIGINT) AS cap,
  CAST([{weights}][1 + (row_number() OVER (ORDER BY s NULLS LAST) - 1) % {len(WEIGHTS)}] AS BIGINT) AS w FROM mix_per),
mix_line AS (SELECT *,
  (sum(ss) OVER ()) * {SHARE[0]} - coalesce(sum(cap) OVER o, 0) AS l,
  (sum(w) OVER ()) - coalesce(sum(w) OVER o, 0) AS ws,
  row_number() OVER (ORDER BY CAST(cap AS DOUBLE) / w, s NULLS LAST) AS k FROM mix_w
  WINDOW o AS (ORDER BY CAST(cap AS DOUBLE) / w, s NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
mix_open AS (SELECT arg_min(l, k) AS ol, arg_min(ws, k) AS ow FROM mix_line WHERE cap * ws > l * w),
mix_target AS (SELECT s, ss, CASE WHEN cap * ws <= l * w THEN CAST(cap AS DOUBLE) / {SHARE[1]} ELSE CAST(ol * w AS DOUBLE) / CAST(ow * {SHARE[1]} AS DOUBLE) END AS target FROM mix_line, mix_open),
mix_rate AS (SELECT d.*, t.ss, t.target, CASE WHEN t.ss > 0 THEN t.target / t.ss ELSE 0.0 END AS rate,
  CAST(CAST('0x' || substr(md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(source, '') || '|' || md5(coalesce(text, ''))), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS draw
  FROM mix_sized d JOIN mix_target t ON d.source IS NOT DISTINCT FROM t.s),
mixed AS (SELECT *, CAST(floor(rate) AS BIGINT) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END AS mix_copies FROM mix_rate)"""


ORACLE = f"""WITH {mix_sql('documents')}
SELECT doc_id, mix_size AS size, ss AS source_size, target, CAST(mix_size * mix_copies AS BIGINT) AS taken FROM mixed"""
