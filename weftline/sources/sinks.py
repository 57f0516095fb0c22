"""Writers of sequence files, matrices and reports. Missing values are null in the engine and coded only here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_fasta(rows: DataFrame, path: str, seq: str = "seq", key: str = "locus", first: str | None = "is_ref", order: tuple[str, ...] = ("taxon",)) -> None:
    """FASTA in a folder for each key, references first and then in the given order."""
    text = F.concat(F.lit(">"), F.col("taxon"), F.lit("\n"), F.col(seq)).alias("value")
    lead = [F.col(first).desc_nulls_last().alias("_lead")] if first and first in rows.columns else []
    out = rows.where(F.col(seq).isNotNull()).repartition(key).sortWithinPartitions(key, *[F.col(first).desc_nulls_last()] * bool(lead), *order)
    out.select(key, text).write.mode("overwrite").partitionBy(key).text(path)


def write_assemblies(rows: DataFrame, path: str) -> None:
    """Coding part, with flanks, and protein (``nf, f, p``) as three parallel tables."""
    for part in ("nf", "f", "p"):
        write_fasta(rows, f"{path}/{part}", part)


def write_by_status(rows: DataFrame, path: str, status: str = "status", seq: str = "nf") -> None:
    """Rows of each status (ortholog, paralog, nohit, ...) in a table of their own, in one pass."""
    text = F.concat(F.lit(">"), F.col("taxon"), F.lit("\n"), F.col(seq)).alias("value")
    rows.repartition("locus").sortWithinPartitions("locus", "taxon").select(status, "locus", text).write.mode("overwrite").partitionBy(status, "locus").text(path)


def write_report(rows: DataFrame, path: str, missing: str = "NA", order: tuple[str, ...] = ()) -> None:
    """A tab-delimited report with a header in one file; reports are small by their nature."""
    (rows.orderBy(*order) if order else rows).coalesce(1).write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", missing).csv(path)


def write_enriched(shares: DataFrame, total: int, path: str) -> None:
    """Loci of each sample and their percentage (``sample, n, pct``) under a line with the number of all loci."""
    head = shares.sparkSession.createDataFrame([(0, "", f"total\t{total}\n"), (1, "", "sample\tn\tpct")], "part int, key string, line string")
    line = F.concat_ws("\t", F.col("sample"), F.col("n").cast("string"), F.format_string("%.2f", F.col("pct").cast("double")))
    _lines(head.unionByName(shares.select(F.lit(2).alias("part"), F.col("sample").alias("key"), line.alias("line"))), path, F.col("line"), ["part", "key"])


def write_reads(rows: DataFrame, path: str, most_bytes: int = 400_000_000) -> None:
    """FASTQ by sample, locus (where there is one) and mate, in files of about ``most_bytes``.

    The bytes of each folder are summed first; its reads are dealt to as many files by a hash of their ids, so that
    mates lie in files of one number and a folder with most of the reads meets in no one task."""
    keys = [k for k in ("sample", "locus", "mate") if k in rows.columns]
    text = F.concat(F.lit("@"), F.col("read_id"), F.lit("\n"), F.col("seq"), F.lit("\n+\n"), F.col("qual")).alias("value")
    whole = [k for k in keys if k != "mate"]
    sizes = rows.groupBy(*keys).agg(F.sum(F.octet_length(text) + 1).alias("_b")).groupBy(*whole).agg(F.ceil(F.max("_b") / most_bytes).alias("_files"))
    dealt = rows.join(sizes, whole).withColumn("_file", F.pmod(F.xxhash64("read_id"), F.col("_files")).cast("int"))
    placed = dealt.repartition(*keys, "_file").sortWithinPartitions(*keys, "_file", "read_id")
    # a partition may hold several files' reads of one folder: no more than one file's bytes go to a part file
    placed.select(*keys, F.col("_file").alias("file"), text).write.mode("overwrite").partitionBy(*keys, "file").text(path)


def two_sections(failed: DataFrame) -> DataFrame:
    """Failed rows of each sample in long form: ``category, sample, count``."""
    return failed.groupBy("category", "sample").agg(F.count("*").alias("count"))


def _lines(rows: DataFrame, path: str, value: Column, order: list) -> None:
    rows.orderBy(*order).select(value.alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_supermatrix(matrix: DataFrame, path: str) -> None:
    """``taxon, seq`` of a supermatrix as FASTA and PHYLIP."""
    size = matrix.agg(F.count("*").alias("n"), F.max(F.length("seq")).alias("len")).first()
    _lines(matrix, f"{path}/fasta", F.concat(F.lit(">"), "taxon", F.lit("\n"), "seq"), ["taxon"])
    head = matrix.sparkSession.createDataFrame([("", f"{size.n or 0} {size.len or 0}")], "taxon string, line string")
    _lines(head.unionByName(matrix.select("taxon", F.concat("taxon", F.lit(" "), "seq").alias("line"))), f"{path}/phylip", F.col("line"), ["taxon"])


def write_nexus(matrix: DataFrame, blocks: DataFrame, path: str) -> None:
    """A supermatrix as NEXUS with a character set for each locus (``locus, start, end``), a file that one task writes."""
    size = matrix.agg(F.count("*").alias("n"), F.max(F.length("seq")).alias("len")).first()
    lines = matrix.sparkSession.createDataFrame(
        [(0, "", "#NEXUS\nBEGIN DATA;"), (0, "a", f"DIMENSIONS NTAX={size.n or 0} NCHAR={size.len or 0};\nFORMAT DATATYPE=DNA MISSING=? GAP=-;\nMATRIX"), (2, "", ";\nEND;\nBEGIN SETS;"), (4, "", "END;")], "part int, key string, line string"
    )
    rows = matrix.select(F.lit(1).alias("part"), F.col("taxon").alias("key"), F.concat("taxon", F.lit(" "), "seq").alias("line"))
    sets = blocks.select(F.lit(3).alias("part"), F.lpad(F.col("start").cast("string"), 20, "0").alias("key"), F.format_string("CHARSET %s=%s-%s;", "locus", F.col("start").cast("string"), F.col("end").cast("string")).alias("line"))
    _lines(lines.unionByName(rows).unionByName(sets), path, F.col("line"), ["part", "key"])


#: The lines with which the NEXUS format opens a block of characters and one of data.
_NEXUS_TWO_ROWS = ("#NEXUS", "Begin characters;", "Dimensions ntax={n} nchar={loci};", 'Format symbols="012" missing=?;', "Matrix")
_NEXUS_SUMS = ("#NEXUS", "Begin data;", "Dimensions ntax={n} nchar={loci};", 'Format datatype=integerdata symbols="012" gap=-;', "Matrix")


def write_snps(matrix: DataFrame, path: str) -> None:
    """SNP matrices out of ``taxon, a1, a2, sums`` (arrays over loci in order) in four codings, each a whole file that one task
    writes: programs that read them want one file.

    NEXUS with two rows to a sample (missing: ?), one-row NEXUS of genotype sums (missing: -), STRUCTURE with two rows
    to a sample (missing: -9) and a table of sums for R (missing: -)."""
    size = matrix.agg(F.count("*").alias("n"), F.max(F.size("sums")).alias("loci")).first()
    n, loci = size.n or 0, max(0, size.loci or 0)
    joined = lambda a, gap, sep="": F.array_join(F.transform(F.col(a), lambda x: F.when(x.isin(".", "-"), F.lit(gap)).otherwise(x)), sep)

    def rows(*lines: Column) -> DataFrame:
        listed = F.posexplode(F.array(*lines)).alias("row", "line")
        return matrix.select(F.lit(1).alias("part"), "taxon", listed)

    def put(name: str, body: DataFrame, head: str = "", foot: str = "") -> None:
        ends = [(k, "", 0, t) for k, t in ((0, head), (2, foot)) if t]
        whole = matrix.sparkSession.createDataFrame(ends, "part int, taxon string, row int, line string").unionByName(body)
        _lines(whole, f"{path}/{name}", F.col("line"), ["part", "taxon", "row"])

    two = [F.concat("taxon", F.lit(f"_{k}\t"), joined(f"a{k}", "?")) for k in (1, 2)]
    put("nexus", rows(*two), "\n".join(_NEXUS_TWO_ROWS).format(n=2 * n, loci=loci), ";\nEnd;")
    one = F.concat("taxon", F.lit("\t"), joined("sums", "-"))
    put("sums", rows(one), "\n".join(_NEXUS_SUMS).format(n=n, loci=loci), "\t;\nEnd;")
    put("structure", rows(*[F.concat("taxon", F.lit("\t"), joined(f"a{k}", "-9", "\t")) for k in (1, 2)]))
    put("table", rows(F.concat("taxon", F.lit("\t"), joined("sums", "-", "\t"))))


def write_paup_commands(trees: DataFrame, path: str, kind: str = "clock", bootstrap: int = 1000) -> None:
    """Command blocks for an external likelihood program: the tree with and without a clock, or a topology test."""
    if kind == "clock":
        body = F.concat(F.lit("lscores 1/ clock=no;\nlscores 1/ clock=yes;"))
    else:
        body = F.lit(f"lscores all/ {'shtest' if kind == 'SH' else 'autest'}=rell bootreps={bootstrap};")
    text = F.concat(F.lit("#NEXUS\nbegin trees;\ntree t = "), "newick", F.lit("\nend;\nbegin paup;\n"), body, F.lit("\nend;"))
    trees.select("locus", text.alias("value")).write.mode("overwrite").partitionBy("locus").text(path)
