"""Statistics of loci, flanks, samples, mapped reads and trimming."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.seq import LETTERS, count_letters

from .alignment import mean_distance, pair_sums


def locus_statistics(rows: DataFrame, key: str = "locus", seq: str = "seq") -> DataFrame:
    """Rows, aligned length, GC and missing percentages of each locus, over all its characters."""
    sums = rows.groupBy(key).agg(
        F.count("*").alias("rows"),
        F.max(F.length(seq)).alias("length"),
        F.sum(F.length(seq)).alias("chars"),
        F.sum(count_letters(seq, "ACGT")).alias("bases"),
        F.sum(count_letters(seq, "GC")).alias("gc_bases"),
        F.sum(count_letters(seq, "-?N")).alias("missing"),
    )
    share = lambda a, b: F.when(F.col(b) > 0, F.round(F.col(a).cast("double") * 100 / F.col(b), 2))
    return sums.select(key, "rows", "length", share("gc_bases", "bases").alias("gc_pct"), share("missing", "chars").alias("missing_pct"))


def coding_summary(rows: DataFrame) -> DataFrame:
    """Locus statistics with the mean p-distance of its pairs."""
    mean = mean_distance(rows).select("locus", F.round("mean_distance", 3).alias("mean_pdis"))
    return locus_statistics(rows).join(mean, "locus", "left")


def flanking_summary(blocks: DataFrame, least: int = 20) -> DataFrame:
    """Length of each flank and the mean distance of its pairs, which short flanks lack: ``locus, side, length, mean_pdis``."""
    sides = blocks.select("locus", "taxon", F.explode(F.create_map(F.lit("left"), F.col("left"), F.lit("right"), F.col("right"))).alias("side", "seq"))
    length = sides.groupBy("locus", "side").agg(F.max(F.length("seq")).alias("length"))
    sums = pair_sums(sides.where(F.length("seq") >= least), ["locus", "side"], LETTERS, 3)
    mean = sums.groupBy("locus", "side").agg(F.round(F.sum("total") / F.nullif(F.sum("n"), F.lit(0)), 3).alias("mean_pdis"))
    return length.join(mean, ["locus", "side"], "left")


def sample_summary(coding: DataFrame, blocks: DataFrame) -> DataFrame:
    """Loci, GC percentage and mean flank length of each sample."""
    own = coding.groupBy("taxon").agg(F.count_distinct("locus").alias("loci"), F.sum(count_letters("seq", "GC")).alias("g"), F.sum(count_letters("seq", "ACGT")).alias("n"))
    flank = blocks.groupBy("taxon").agg(F.avg((F.length(F.replace("left", F.lit("-"), F.lit(""))) + F.length(F.replace("right", F.lit("-"), F.lit("")))).cast("double")).alias("f"))
    return own.join(flank, "taxon", "left").select("taxon", "loci", F.when(F.col("n") > 0, F.round(F.col("g").cast("double") * 100 / F.col("n"), 2)).alias("gc_pct"), F.round("f", 2).alias("mean_flank"))


def map_statistics(depth: DataFrame, flags: DataFrame) -> DataFrame:
    """Total, mapped, duplicate and uniquely mapped reads of each sample, the percentage of all reads that are uniquely
    mapped (on target) and the average depth. Samples without a covered place are left out."""
    per = depth.groupBy("sample").agg(F.avg("depth").alias("d"))
    out = flags.join(per, "sample").withColumn("unique", F.col("mapped") - F.col("duplicates"))
    share = F.when(F.col("total") > 0, F.round(F.col("unique").cast("double") * 100 / F.col("total"), 2))
    return out.select("sample", "total", "mapped", "duplicates", "unique", share.alias("on_target_pct"), F.round("d", 2).alias("average_depth"))


def trim_counts(raw: DataFrame, trimmed: DataFrame) -> DataFrame:
    """Reads and bases of each sample before and after trimming."""
    per = lambda d, p: d.groupBy("sample").agg(F.sum("reads").alias(f"{p}_reads"), F.sum("bases").alias(f"{p}_bases"))
    return per(raw, "raw").join(per(trimmed, "trimmed"), "sample", "full_outer")


#: The public adaptors of the platform, forward and reverse.
ADAPTORS = ("AGATCGGAAGAGCACACGTCTGAACTCCAGTCAC", "AGATCGGAAGAGCGTCGTGTAGGGAAAGAGTGT")


def trim_reads(reads: DataFrame, adaptors: tuple[str, str] = ADAPTORS, quality: int = 20, least_overlap: int = 3, error: float = 0.1, least_length: int = 20) -> DataFrame:
    """Reads without low-quality ends and 3' adaptors; too short ones are dropped.

    The quality cut is where the running sum of (quality - threshold) from the end is lowest; then the first place
    where the adaptor matches to the end of the read with a share of mismatches at most. Rules of our own."""

    def cut(seq: str, qual: str, adaptor: np.ndarray) -> int:
        q = np.frombuffer(qual.encode(), dtype=np.uint8).astype(np.int64) - 33 - quality
        tail = np.cumsum(q[::-1])
        end = len(seq) - (int(np.argmin(tail)) + 1) if len(tail) and tail.min() < 0 else len(seq)
        places = max(0, end - least_overlap + 1)
        if not places:
            return end
        # all places of the adaptor at once: zeros beyond the read's end never count
        s = np.zeros(end + len(adaptor), dtype=np.uint8)
        s[:end] = np.frombuffer(seq[:end].encode(), dtype=np.uint8)
        at = np.lib.stride_tricks.sliding_window_view(s, len(adaptor))[:places]
        wrong = ((at != adaptor) & (at != 0)).sum(axis=1)
        fits = np.flatnonzero(wrong <= (np.minimum(len(adaptor), end - np.arange(places)) * error).astype(np.int64))
        return int(fits[0]) if len(fits) else end

    coded = [np.frombuffer(a.encode(), dtype=np.uint8) for a in adaptors]

    @F.pandas_udf("int")
    def ends(seq: pd.Series, qual: pd.Series, mate: pd.Series) -> pd.Series:
        return pd.Series([cut(s, q, coded[int(m) - 1]) for s, q, m in zip(seq, qual, mate)], dtype="int32")

    found = reads.withColumn("_end", ends("seq", "qual", "mate"))
    out = found.withColumns({"seq": F.substring(F.col("seq"), F.lit(1), F.col("_end")), "qual": F.substring(F.col("qual"), F.lit(1), F.col("_end"))}).drop("_end")
    return out.where(F.length("seq") >= least_length)
