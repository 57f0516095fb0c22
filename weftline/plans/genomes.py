"""Orthologs of reference loci in other genomes, by a search there and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.seq import reverse_complement, translate
from weftline.operators import orthologs


def extract_orthologs(loci: DataFrame, query_genome: DataFrame, subjects: DataFrame, word: int = 11, least_bits: float = 60, gap: float = 40, least_length: int = 100, most_stops: int = 0) -> DataFrame:
    """Coding sequences of orthologs: ``locus, sample, frame, dna, aa``.

    ``loci`` holds ``locus, nt, aa``, the genomes ``name, seq`` and ``sample, name, seq``. The one hit of a locus in a
    genome, or one that is far ahead of the next, is searched for in the loci's own genome and kept if it comes back to where
    the locus lies. Its frame is the one whose protein shares most 3-mers with the reference's."""
    named = loci.select(F.col("locus").alias("name"), F.col("nt").alias("seq"))
    there = subjects.select(F.concat_ws("\t", "sample", "name").alias("name"), "seq")
    hits = orthologs.seed_search(named, there, word).where(F.col("bits") >= least_bits).withColumn("sample", F.split_part("target", F.lit("\t"), F.lit(1)))
    best = orthologs.second_best(hits.withColumns({"locus": F.col("query"), "query": F.concat_ws("\t", "query", "sample")}), gap)
    part = F.expr("substring(seq, tlo, thi - tlo + 1)")
    found = best.join(there.withColumnRenamed("name", "target"), "target").select("locus", "sample", F.when(F.col("strand") == "-", reverse_complement(part)).otherwise(part).alias("seq"))
    queries = named.select(F.concat(F.col("name"), F.lit("\t")).alias("name"), "seq").unionByName(found.select(F.concat_ws("\t", "locus", "sample").alias("name"), "seq"))
    back = orthologs.seed_search(queries, query_genome, word).where(F.col("bits") >= least_bits).join(queries.select(F.col("name").alias("query"), F.length("seq").alias("ql")), "query")
    back = back.withColumns({"locus": F.split_part("query", F.lit("\t"), F.lit(1)), "sample": F.split_part("query", F.lit("\t"), F.lit(2))})
    own = orthologs.qualified_references(back.where("sample = ''").select(F.col("locus").alias("query"), "target", "tlo", "thi", "qlo", "qhi", "ql", "id"))
    status = orthologs.ortholog_status(back.where("sample <> ''"), own, found, gap).where("status = 'ortholog'")
    kept = found.join(status, ["locus", "sample"], "left_semi").withColumn("name", F.concat_ws("\t", "locus", "sample"))
    reference = kept.select("name", "locus").join(loci.select("locus", F.col("aa").alias("protein")), "locus")
    framed = kept.join(orthologs.frame_by_kmers(kept.select("name", "seq"), reference).select("name", "frame"), "name")
    dna = F.expr("substring(seq, frame + 1, ((length(seq) - frame) div 3) * 3)")
    out = orthologs.filter_orthologs(framed.withColumn("seq", dna), most_stops, least_length)
    return out.select("locus", "sample", "frame", F.col("seq").alias("dna"), translate("seq").alias("aa"))
