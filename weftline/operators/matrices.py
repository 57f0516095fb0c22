"""Supermatrices and SNP matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.seq import count_letters, genotype

from .relational import one_per_group


def locus_blocks(rows: DataFrame, least: int = 1) -> DataFrame:
    """Place of each locus in the concatenation, by the order of the names: ``locus, len, start, end`` (from 1).

    Loci with too few taxa are left out. The running sum has one row to a locus."""
    per = rows.groupBy("locus").agg(F.max(F.length("seq")).alias("len"), F.count_distinct("taxon").alias("n")).where(F.col("n") >= least)
    end = F.sum("len").over(Window.orderBy("locus").rowsBetween(Window.unboundedPreceding, 0))
    return per.select("locus", "len", (end - F.col("len") + 1).alias("start"), end.alias("end"))


def filled(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """A row for each taxon and locus; gaps where a taxon lacks a locus: ``taxon, locus, seq, present``.

    The pairs are the product of the distinct taxa with the loci, which is the size of the result."""
    pairs = rows.join(blocks.select("locus"), "locus", "left_semi").select("taxon").distinct().crossJoin(blocks.select("locus", "len"))
    own = rows.select("taxon", "locus", F.col("seq").alias("_s"))
    out = pairs.join(own, ["taxon", "locus"], "left")
    return out.select("taxon", "locus", F.coalesce("_s", F.repeat(F.lit("-"), F.col("len").cast("int"))).alias("seq"), F.col("_s").isNotNull().alias("present"))


def supermatrix(rows: DataFrame, least: int = 1, first_name: tuple[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Concatenated loci of each taxon (``taxon, seq``) and the blocks. ``first_name`` renames a taxon before all else."""
    if first_name:
        rows = rows.withColumn("taxon", F.when(F.col("taxon") == first_name[0], first_name[1]).otherwise(F.col("taxon")))
    blocks = locus_blocks(rows, least)
    return _concatenate(filled(rows, blocks)), blocks


def _concatenate(rows: DataFrame) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("locus", "seq")))
    return rows.groupBy("taxon").agg(F.array_join(F.transform(ordered, lambda x: x["seq"]), "").alias("seq"))


def gap_report(rows: DataFrame, least: int = 1) -> DataFrame:
    """Loci that each taxon has and the percentage of gaps in its row of the supermatrix; only kept loci count."""
    parts = filled(rows, locus_blocks(rows, least))
    per = parts.groupBy("taxon").agg(F.count_if("present").alias("loci"), F.sum(F.length("seq")).alias("n"), F.sum(count_letters("seq", "-")).alias("g"))
    return per.select("taxon", "loci", F.round(F.col("g").cast("double") * 100 / F.col("n"), 2).alias("gap_pct"))


def sound_variants(variants: DataFrame, quality: float = 0, called_pct: float = 80) -> DataFrame:
    """Biallelic single-base variants that passed, with quality and enough called genotypes."""
    calls = F.map_values("gt")
    good = F.filter(calls, lambda g: g.rlike(r"^[01.].[01.]$"))
    called = F.size(F.filter(calls, lambda g: ~(F.substring(g, 1, 1) == ".") | ~(F.substring(g, 3, 1) == ".")))
    ok = (F.col("filter") == "PASS") & (F.col("qual") >= quality) & (F.length("ref") == 1) & (F.length("alt") == 1) & (F.size(good) == F.size(calls))
    return variants.where(ok & (called.cast("double") * 100 / F.size(calls) >= called_pct))


def site_filter(variants: DataFrame) -> DataFrame:
    """Variants within the usual hard limits of their site fields; a field that is absent doesn't filter."""
    v = lambda k: F.try_element_at("info", F.lit(k)).try_cast("double")
    parts = [(v("QD") < 2.0), (v("FS") > 60.0), (v("MQ") < 40.0), (v("HaplotypeScore") > 13.0), (v("MQRankSum") < -12.5), (v("ReadPosRankSum") < -8.0)]
    bad = F.lit(False)
    for p in parts:
        bad = bad | F.coalesce(p, F.lit(False))
    return variants.where(~bad)


def select_samples(variants: DataFrame, names: list[str]) -> DataFrame:
    """Genotypes of some samples, two at least."""
    if len(names) < 2:
        raise ValueError("two samples at least")
    return variants.withColumn("gt", F.map_filter("gt", lambda k, _: k.isin(names)))


def polymorphic(variants: DataFrame) -> DataFrame:
    """Variants with more than one allele among the called ones."""
    alleles = F.array_distinct(F.flatten(F.transform(F.map_values("gt"), lambda g: F.array(F.substring(g, 1, 1), F.substring(g, 3, 1)))))
    return variants.where(F.size(F.filter(alleles, lambda a: a != ".")) > 1)


def one_snp_per_locus(variants: DataFrame, seed: str = "1") -> DataFrame:
    """One polymorphic variant of each locus, drawn by a hash."""
    return one_per_group(polymorphic(variants), ["chrom"], seed, "chrom", "pos")


def missing_calls(variants: DataFrame) -> DataFrame:
    """Missing calls of each sample and the loci it has calls of, present or not: ``taxon, missing, loci``. Counts alone: no sample's calls meet."""
    rows = variants.select(F.explode("gt").alias("taxon", "call"))
    return rows.groupBy("taxon").agg(F.count_if(F.col("call").rlike(r"^\..\.$")).alias("missing"), F.count("*").alias("loci"))


def snp_matrix(variants: DataFrame) -> DataFrame:
    """Alleles and sums of each sample over the loci in order: ``taxon, a1, a2, sums, missing``."""
    rows = variants.select("chrom", "pos", F.explode("gt").alias("taxon", "call")).withColumn("g", genotype("call"))
    listed = F.array_sort(F.collect_list(F.struct("chrom", "pos", "g")))
    per = rows.groupBy("taxon").agg(listed.alias("l"), F.count_if(F.col("call").rlike(r"^\..\.$")).alias("missing"))
    take = lambda f: F.transform("l", lambda x: x["g"][f])
    return per.select("taxon", take("a1").alias("a1"), take("a2").alias("a2"), take("sum").alias("sums"), "missing")
