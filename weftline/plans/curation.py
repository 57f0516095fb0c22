"""Curation of alignments: row and column filters in their order, which is part of the result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators import alignment as al


def _reference(rows: DataFrame, least_refs: int = 5) -> DataFrame:
    """The row that others are held against: the references' consensus if there are enough, else the first reference."""
    refs = rows.where("is_ref")
    n = refs.groupBy("locus").agg(F.count("*").alias("n"), F.min_by("seq", "taxon").alias("first"))
    voted = al.consensus_any(refs).withColumnRenamed("seq", "voted")
    return n.join(voted, "locus").select("locus", F.when(F.col("n") >= least_refs, F.col("voted")).otherwise(F.col("first")).alias("other"))


def filter_alignments(rows: DataFrame, coding: bool = True, length: int = 100, seq_num: int = 2, indel: int = 10, pdis: float | None = None, distant: int = 0, cover: float = 0.8, window: int = 50, step: int = 25, remove_ref: bool = False, trim_gap: bool = False, trim_unit: int | None = None, gap_share: float = 0.5) -> DataFrame:
    """Alignments (``locus, taxon, seq, is_ref``) through all filters; a threshold of zero is a threshold."""
    pdis = (0.3 if coding else 0.4) if pdis is None else pdis
    unit = (3 if coding else 1) if trim_unit is None else trim_unit
    rows = al.sound_alignments(rows, least=length, codon=coding, least_rows=seq_num)
    rows = al.drop_long_indels(rows, _reference(rows), most=indel)
    rows = al.drop_gap_columns(rows, unit=3 if coding else 1)
    rows = al.drop_distant_rows(rows, _reference(rows), pdis=pdis, most=distant, size=window, step=step)
    rows = al.drop_gap_columns(rows, unit=3 if coding else 1)
    rows = al.drop_poor_rows(rows, cover)
    rows = al.drop_references(rows, remove_ref)
    rows = al.drop_gap_columns(rows, unit=3 if coding else 1)
    if trim_gap:
        rows = al.trim_gappy_units(rows, unit=unit, share=gap_share)
    return rows.join(rows.groupBy("locus").count().where(F.col("count") >= seq_num), "locus", "left_semi")


def filter_flanks(blocks: DataFrame, run: int = 5, share: float = 0.5, unique: int = 10, pdis: float = 0.4, window: int = 20, step: int = 10, bases: int = 10, cover: float = 0.65, seq_pct: float = 0.65, seq_num: int = 1) -> DataFrame:
    """Left and right flanks (``locus, taxon, left, coding, right``, without references) through the flank filters; the left
    one is turned round, so one set of rules serves both: ``locus, taxon, side, seq``."""
    sides = blocks.select("locus", "taxon", F.explode(F.create_map(F.lit("left"), F.reverse("left"), F.lit("right"), F.reverse("right"))).alias("side", "seq"))
    rows = sides.withColumn("seq", F.when(F.col("side") == "right", F.reverse("seq")).otherwise(F.col("seq"))).withColumn("ls", F.concat_ws("\t", "locus", "side")).where(F.length("seq") > 0)
    # the far end lies last: cut sparse columns from there
    rows = al.reversed_block(al.cut_sparse_flank(al.reversed_block(rows.select("ls", "taxon", "seq")), "ls", run=run, share=share)).where(F.length("seq") > 0)
    rows = al.blank_private_runs(rows, "ls", unique)
    rows = al.drop_gap_columns(rows, "ls")
    rows = al.drop_deviant(rows, pdis, "ls")
    voted = al.consensus_any(rows, "ls").withColumnRenamed("seq", "other")
    rows = al.trim_from_distant_window(rows, voted, "ls", pdis, window, step)
    rows = al.poor_blocks(rows, bases, cover, seq_pct, seq_num, "ls")
    rows = rows.withColumns({"locus": F.split_part("ls", F.lit("\t"), F.lit(1)), "side": F.split_part("ls", F.lit("\t"), F.lit(2))})
    return rows.select("locus", "taxon", "side", F.when(F.col("side") == "left", F.reverse("seq")).otherwise(F.col("seq")).alias("seq"))
