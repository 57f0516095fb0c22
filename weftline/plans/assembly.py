"""From read pairs to classified assemblies, as a plan of stages over one set of tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions.seq import translate
from weftline.operators import alignment, contigs, orthologs, relational, search
from weftline.sources.readers import single_reads

from .stages import Plan


def plan(store: str, word: int = 11, gap: float = 40, similarity: float = 60, coverage: float = 80, assign_e: float = 1e-4, classify_e: float = 1e-6, most_places: int | None = 10_000, most_reads: int = 20_000, seconds: float = 60) -> Plan:
    """Stages ``dedup, assign, assemble, filter, merge, classify`` over the tables ``pairs, loci`` (``locus, nt, aa``) and
    ``genome`` (``name, seq``). ``merge`` holds the best contig of each sample and locus, ``classify`` its status. Reads are assigned
    by hits of an e-value of ``assign_e`` at most, contigs classified by those of ``classify_e``; words that the genome
    holds more than ``most_places`` times are taken for repeats and start no hit there. Loci of more than ``most_reads`` reads, and those that
    one task has not assembled in ``seconds``, are assembled by joins."""

    def dedup(spark, t):
        return relational.dedup_pairs(t["pairs"])

    def assign(spark, t):
        reads = single_reads(t["dedup"]).select(F.concat_ws("\t", "sample", "read_id").alias("name"), "seq")
        hits = search.gapped_search(t["loci"].select(F.col("locus").alias("name"), F.col("nt").alias("seq")), reads, word, most_e=assign_e)
        hits = hits.select(F.split_part("target", F.lit("\t"), F.lit(1)).alias("sample"), F.split_part("target", F.lit("\t"), F.lit(2)).alias("read_id"), F.col("query").alias("target"), "bits", "strand")
        best = relational.assign_reads(hits)
        return relational.assign_pairs(best, t["dedup"]).withColumnRenamed("target", "locus")

    def assemble(spark, t):
        both = t["assign"].select("sample", "locus", F.explode(F.array("seq1", F.reverse(F.translate("seq2", "ATCG", "TAGC")))).alias("seq"))
        return contigs.assemble_all(both, most_reads, seconds).drop("how")

    def filter_(spark, t):
        rows = t["assemble"].join(t["loci"].select("locus", F.col("aa").alias("protein")), "locus")
        aligned = alignment.align_proteins(rows.withColumn("contig", F.concat_ws("\t", "sample", "contig")))
        aligned = aligned.select(F.split_part("contig", F.lit("\t"), F.lit(1)).alias("sample"), "locus", F.split_part("contig", F.lit("\t"), F.lit(2)).alias("contig"), "stq", "edq", "sts", "eds", "strand", "score", "sim")
        return contigs.best_alignments(aligned.join(t["assemble"], ["sample", "locus", "contig"]), similarity)

    def merge(spark, t):
        rows = t["filter"].join(t["loci"].select("locus", F.length("aa").alias("query_len")), "locus").withColumn("coding", F.expr("substring(seq, sts + 1, eds - sts)"))
        best = contigs.best_contigs(rows, similarity, coverage)
        return best.select("sample", "locus", "contig", F.col("coding").alias("nf"), F.col("seq").alias("f"), translate("coding").alias("p"))

    def classify(spark, t):
        queries = t["loci"].select(F.concat(F.col("locus"), F.lit("|")).alias("name"), F.col("nt").alias("seq")).unionByName(t["merge"].select(F.concat_ws("|", "locus", "sample").alias("name"), F.col("nf").alias("seq")))
        hits = search.gapped_search(queries, t["genome"], word, most_e=classify_e, most_places=most_places).join(queries.select(F.col("name").alias("query"), F.length("seq").alias("ql")), "query")
        hits = hits.withColumns({"locus": F.split_part("query", F.lit("|"), F.lit(1)), "sample": F.split_part("query", F.lit("|"), F.lit(2))})
        own = hits.where("sample = ''").select(F.col("locus").alias("query"), "target", "tlo", "thi", "qlo", "qhi", "ql", "id")
        status = orthologs.ortholog_status(hits.where("sample <> ''"), orthologs.qualified_references(own), t["merge"], gap)
        return t["merge"].join(status, ["locus", "sample"])

    out = Plan(store)
    for name, stage in (("dedup", dedup), ("assign", assign), ("assemble", assemble), ("filter", filter_), ("merge", merge), ("classify", classify)):
        out.add(name, stage)
    return out
