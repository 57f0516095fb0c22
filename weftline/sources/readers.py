"""Readers of sequence, alignment, variant and report files. Each gives a DataFrame; nothing is read on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions.seq import count_letters, header_fields, is_nucleotide

from . import fastq

FASTA_SUFFIX = "(?i)\\.(fa|fas|fasta)"


def _file() -> Column:
    return F.col("_metadata.file_name")


def _named(rows: DataFrame, key: str) -> Column:
    """The key that a file's folder names (``key=...``, as the sinks write it), else the file's name up to a dot."""
    return F.col(key).cast("string") if key in rows.columns else F.regexp_extract(_file(), r"^([^.]+)", 1)


def _order() -> Column:
    """Place of a record in its file: the split's start, then the row's number in the split."""
    return F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


def _bare(s: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(s, r"^\s+|\s+$", "")


def locus_of(name: Column) -> Column:
    """A file's name before its FASTA suffix."""
    return F.regexp_extract(name, r"(?i)^(.*?)\.fa[^.]*$", 1)


def fasta(spark: SparkSession, path: str, strict: bool = True, split_names: bool = False) -> DataFrame:
    """Records of FASTA files: ``file, locus, ord, name, header, seq``.

    Wrapped lines are joined and CR line ends are dropped. Strict: names end at white space, letters are raised,
    the first record of a name in a file wins, and rows that are empty or hold anything but letters, ?, *, - and .
    are left out (``fasta_problems`` lists them). Permissive: case, duplicates and letters stay as they are.
    Hidden files are passed over; the locus is the file's name before its suffix, or that of a folder ``locus=...``. Records split at a line that starts with >, so files are splittable.
    """
    raw = spark.read.option("lineSep", "\n>").text(path)
    locus = F.col("locus").cast("string") if "locus" in raw.columns else locus_of(_file())
    raw = raw.select(_file().alias("file"), locus.alias("locus"), _order().alias("ord"), F.regexp_replace("value", "\r\n?", "\n").alias("value"))
    raw = raw.where(F.length(F.trim("value")) > 0)
    body = F.regexp_replace("value", "^>", "")
    header = F.trim(F.substring_index(body, "\n", 1))
    seq = F.when(F.instr(body, "\n") > 0, F.regexp_replace(F.expr("substring(value, instr(value, '\n') + 1)"), r"\s", "")).otherwise(F.lit(""))
    rows = raw.select("file", "locus", "ord", header.alias("header"), seq.alias("seq")).withColumn("name", F.regexp_extract("header", r"^(\S+)", 1))
    rows = rows.select("file", "locus", "ord", "name", "header", "seq")
    if not strict:
        return rows
    rows = rows.withColumn("seq", F.upper("seq")).where(_sound())
    best = F.min_by(F.struct("header", "seq"), F.col("ord")).alias("r")
    # files in folders of different loci may have one name
    return rows.groupBy("file", "locus", "name").agg(best, F.min("ord").alias("ord")).select("file", "locus", "ord", "name", "r.header", "r.seq")


def _sound() -> Column:
    return F.col("seq").rlike(r"^[A-Z?*.\-]+$") & (F.length("name") > 0)


def fasta_problems(spark: SparkSession, path: str) -> DataFrame:
    """What the strict reader leaves out: ``file, name, problem`` (empty, alphabet or duplicate)."""
    rows = fasta(spark, path, strict=False).withColumn("seq", F.upper("seq"))
    sort = F.when(F.length("seq") == 0, "empty").when(~_sound(), "alphabet")
    bad = rows.select("file", "name", sort.alias("problem")).where("problem IS NOT NULL")
    twice = rows.where(_sound()).groupBy("file", "locus", "name").count().where("count > 1").select("file", "name", F.lit("duplicate").alias("problem"))
    return bad.unionByName(twice)


def alignment_lengths(rows: DataFrame, key: str = "locus") -> DataFrame:
    """Common length of each alignment; null (not aligned) where rows differ."""
    n = F.length("seq")
    return rows.groupBy(key).agg(F.when(F.min(n) == F.max(n), F.min(n)).alias("length"), F.count("*").alias("rows"))


def _fastq(spark: SparkSession, path: str) -> DataFrame:
    """Records of FASTQ files, four lines each, gzipped or not: ``file, ord, read_id, seq, qual``.

    A line's number in its file is its number in its split and the lines of the splits before, so large plain
    files are read by many tasks; the counts are one row to a split. A gzipped file is one split by its nature."""
    raw = spark.read.text(path)
    folders = [F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in ("sample", "mate") if k in raw.columns]
    name = F.concat_ws("/", *folders, _file())  # of a file among those of its folders
    lines = raw.select(name.alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), F.regexp_replace("value", "\r$", "").alias("value"))
    splits = lines.groupBy("file", "block").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("file", "block", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    numbered = lines.join(splits, ["file", "block"]).withColumn("line", F.col("row") + F.col("shift"))
    at = lambda k: F.max(F.when(F.col("line") % 4 == k, F.col("value")))
    records = numbered.groupBy("file", F.floor(F.col("line") / 4).alias("ord")).agg(at(0).alias("id"), at(1).alias("seq"), at(3).alias("qual"), F.count("*").alias("n")).where("n = 4")
    return records.select("file", "ord", F.regexp_extract("id", r"^@?(\S+)", 1).alias("read_id"), "seq", "qual")


_MATE = r"^(.*)_R([12])\.(?:fq|fastq)(?:\.gz)?$"


def reads(spark: SparkSession, path: str, part_bytes: int | None = None) -> DataFrame:
    """Reads of ``{sample}_R1.fq`` and ``_R2.fq`` files, gzipped too, or of folders ``sample=.../mate=...`` as the sink
    writes them: ``sample, mate, ord, read_id, seq, qual``. ``ord`` is a read's place in its file.

    With ``part_bytes`` files are read by ranges of bytes that begin at a record (``sources.fastq``): no line is shuffled, and
    the path is a file or folder of a store that pyarrow can open. Without, lines are numbered and put together, from any path or
    pattern that Spark can read."""
    rows = _fastq(spark, path) if part_bytes is None else fastq.numbered(fastq.fastq(spark, path, part_bytes))
    folders = r"^sample=([^/]*)/mate=([12])/"
    at = lambda i: F.when(F.col("file").rlike(folders), F.regexp_extract("file", folders, i)).otherwise(F.regexp_extract("file", _MATE, i))
    return rows.select(at(1).alias("sample"), at(2).try_cast("int").alias("mate"), "ord", F.regexp_replace("read_id", "/[12]$", "").alias("read_id"), "seq", "qual").where("mate IS NOT NULL")


def read_pairs(rows: DataFrame, by: str = "ord") -> DataFrame:
    """Mates joined by their place in the two files, or by ``read_id`` where a sample's reads are in several files:
    ``sample, pair_id, seq1, qual1, seq2, qual2``.

    Rows whose sequence and quality differ in length stop the query."""
    checked = rows.withColumn("seq", F.when(F.assert_true(F.length("seq") == F.length("qual"), F.concat(F.lit("sequence and quality differ in length: "), "read_id")).isNull(), F.col("seq")))
    one, two = (checked.where(F.col("mate") == m).select("sample", F.col(by).alias("_by"), F.col("read_id").alias(f"id{m}"), F.col("seq").alias(f"seq{m}"), F.col("qual").alias(f"qual{m}")) for m in (1, 2))
    return one.join(two, ["sample", "_by"]).select("sample", F.col("id1").alias("pair_id"), "seq1", "qual1", "seq2", "qual2")


def single_reads(pairs: DataFrame) -> DataFrame:
    """Pairs as reads with /1 and /2: ``sample, read_id, mate, seq, qual``."""
    mates = F.array(*[F.struct(F.lit(m).alias("mate"), F.col(f"seq{m}").alias("seq"), F.col(f"qual{m}").alias("qual")) for m in (1, 2)])
    return pairs.select("sample", "pair_id", F.explode(mates).alias("m")).select("sample", F.concat("pair_id", F.lit("/"), F.col("m.mate").cast("string")).alias("read_id"), "m.mate", "m.seq", "m.qual")


def read_counts(rows: DataFrame) -> DataFrame:
    """Reads and bases of each sample."""
    return rows.groupBy("sample").agg(F.count("*").alias("reads"), F.sum(F.length("seq")).alias("bases"))


def incomplete_samples(rows: DataFrame) -> DataFrame:
    """Samples that lack one of their two mates' files."""
    return rows.groupBy("sample").agg(F.count_distinct("mate").alias("mates")).where("mates <> 2")


def unpaired_folders(spark: SparkSession, path: str) -> DataFrame:
    """Sample folders whose number of gzipped files isn't even: ``folder, files``. Files are listed, not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*gz").load(path)
    return found.groupBy(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder")).agg(F.count("*").alias("files")).where("files % 2 = 1")


def word_list(spark: SparkSession, path: str, name: str = "sample") -> DataFrame:
    """One word to a line; a line of several stops the query. Blank lines are passed over."""
    lines = spark.read.text(path).select(_bare(F.col("value")).alias("w")).where("w <> ''")
    return lines.select(F.when(F.assert_true(~F.col("w").rlike(r"\s"), F.concat(F.lit("more than one word: "), "w")).isNull(), F.col("w")).alias(name))


def markers(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """The first column of a marker table, ``a:chrom:start:end|gene``: ``locus_pos, chrom, start, end, gene``."""
    rows = spark.read.option("sep", "\t").option("header", header).csv(path)
    first = F.col(f"`{rows.columns[0]}`")
    out = rows.select(F.split_part(first, F.lit("|"), F.lit(1)).alias("locus_pos"), F.split_part(first, F.lit("|"), F.lit(2)).alias("gene"))
    parts = F.split("locus_pos", ":")
    return out.select("locus_pos", F.try_element_at(parts, F.lit(2)).alias("chrom"), F.try_element_at(parts, F.lit(3)).try_cast("long").alias("start"), F.try_element_at(parts, F.lit(4)).try_cast("long").alias("end"), "gene")


def proteome(spark: SparkSession, path: str, genes: DataFrame | None = None) -> DataFrame:
    """Proteins with the gene that their header names, of wanted genes only if these are given: ``gene, prot_id, aa``."""
    rows = fasta(spark, path, strict=False).select(F.regexp_extract("header", r"gene:([^\s.]+)", 1).alias("gene"), F.col("name").alias("prot_id"), F.upper("seq").alias("aa")).where("gene <> ''")
    return rows if genes is None else rows.join(genes.select("gene").distinct(), "gene", "left_semi")


def baits(rows: DataFrame) -> DataFrame:
    """Rows with the position that ends their dotted header, ``...chrom.start.end``, turned to run upwards."""
    f = header_fields("name", r"\.", ["chrom", "start", "end"], last=True)
    out = rows.withColumn("_f", f)
    a, b = F.col("_f.start").try_cast("long"), F.col("_f.end").try_cast("long")
    return out.withColumns({"chrom": F.col("_f.chrom"), "start": F.least(a, b), "end": F.greatest(a, b), "strand": F.when(a > b, "-").otherwise("+")}).drop("_f")


def alignment_report(spark: SparkSession, path: str) -> DataFrame:
    """``sugar:`` lines with the ``pt:`` scores that follow each: coordinates, score and an array of (score, q, t)."""
    lines = spark.read.text(path, wholetext=True).select(_file().alias("file"), F.split("value", r"(?m)^(?=sugar:)").alias("hits"))
    rows = lines.select("file", F.posexplode("hits").alias("ord", "hit")).where("hit LIKE 'sugar:%'")
    f = F.split(_bare(F.regexp_extract("hit", r"^sugar:\s*([^\n]*)", 1)), r"\s+")
    at = lambda i: F.try_element_at(f, F.lit(i))
    pts = F.transform(F.filter(F.split("hit", "\n"), lambda line: line.startswith("pt:")), lambda line: F.split(_bare(F.replace(line, F.lit("pt:"), F.lit(""))), r"\s+"))
    pt = F.transform(pts, lambda p: F.struct(F.try_element_at(p, F.lit(1)).try_cast("double").alias("score"), F.try_element_at(p, F.lit(2)).try_cast("int").alias("q"), F.try_element_at(p, F.lit(3)).try_cast("int").alias("t")))
    return rows.select("file", "ord", at(1).alias("query"), at(2).try_cast("long").alias("stq"), at(3).try_cast("long").alias("edq"), at(4).alias("qstrand"), at(5).alias("contig"), at(6).try_cast("long").alias("sts"), at(7).try_cast("long").alias("eds"), at(8).alias("strand"), at(9).try_cast("double").alias("score"), at(10).try_cast("double").alias("sim"), pt.alias("pt"))


def asqg_edges(spark: SparkSession, path: str) -> DataFrame:
    """Edges of string-graph files: ``file, src, dst, olp`` (overlap in bases) and the reversed flag."""
    rows = spark.read.text(path).select(_file().alias("file"), "value").where(F.col("value").startswith("ED"))
    f = F.split(_bare(F.expr("substring(value, 3)")), r"\s+")
    at = lambda i: F.try_element_at(f, F.lit(i))
    return rows.select("file", at(1).alias("src"), at(2).alias("dst"), (at(4).try_cast("int") - at(3).try_cast("int") + 1).alias("olp"), (at(9) == "1").alias("reversed"))


HITS = {
    "assign": "target string, query string, qlo long, qhi long, bits double",
    "research": "query string, target string, bits double, tlo long, thi long, qlo long, qhi long, ql long, id double",
    "ortholog": "query string, target string, bits double, trow string, qstrand string, id double",
}


def hits(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Tab-delimited search hits of one of three layouts; intervals are turned to run upwards."""
    rows = spark.read.option("sep", "\t").schema(HITS[kind]).csv(path)
    for a, b in (("qlo", "qhi"), ("tlo", "thi")):
        if a in rows.columns:
            rows = rows.withColumns({a: F.least(a, b), b: F.greatest(a, b)})
    return rows


def vcf(spark: SparkSession, path: str) -> DataFrame:
    """Variants with a map from sample to genotype: ``chrom, pos, id, ref, alt, qual, filter, info, gt``.

    The sample names are the columns from the tenth on of the #CHROM line, which is the one row that is collected."""
    text = spark.read.text(path)
    head = text.where(F.col("value").startswith("#CHROM")).first()
    if head is None:
        raise ValueError("no #CHROM line")
    samples = head.value.rstrip("\r").split("\t")[9:]
    f = F.split(F.regexp_replace("value", "\r$", ""), "\t")
    rows = text.where(~F.col("value").startswith("#") & (F.length("value") > 0)).select(f.alias("f"))
    at = lambda i: F.try_element_at(F.col("f"), F.lit(i))
    # as many calls as samples whatever the line holds: a short one has nulls
    calls = F.transform(F.array(*[F.lit(10 + k) for k in range(max(1, len(samples)))]), lambda k: F.split_part(F.try_element_at("f", k), F.lit(":"), F.lit(1)))
    info = F.str_to_map(at(8), F.lit(";"), F.lit("="))
    gt = F.map_from_arrays(F.array(*map(F.lit, samples)), calls) if samples else F.create_map().cast("map<string,string>")
    return rows.select(at(1).alias("chrom"), at(2).cast("long").alias("pos"), at(3).alias("id"), at(4).alias("ref"), at(5).alias("alt"), at(6).try_cast("double").alias("qual"), at(7).alias("filter"), info.alias("info"), gt.alias("gt"))


def depth_table(spark: SparkSession, path: str) -> DataFrame:
    """Depth text files, ``{sample}.depth``: ``sample, chrom, pos, depth``."""
    rows = spark.read.option("sep", "\t").schema("chrom string, pos long, depth long").csv(path)
    return rows.select(_named(rows, "sample").alias("sample"), "chrom", "pos", "depth")


def flagstat(spark: SparkSession, path: str) -> DataFrame:
    """Flag statistics text files: ``sample, total, duplicates, mapped``, reads that passed the quality check and those
    that failed it taken together."""
    raw = spark.read.text(path, wholetext=True)
    rows = raw.select(_named(raw, "sample").alias("sample"), "value")
    n = lambda p: sum(F.regexp_extract("value", rf"(?m)^(\d+) \+ (\d+) {p}", i).try_cast("long") for i in (1, 2))
    return rows.select("sample", n("in total").alias("total"), n("duplicates").alias("duplicates"), n("mapped").alias("mapped"))


def trimming_report(spark: SparkSession, path: str) -> DataFrame:
    """Reads and bases from trimming reports: the third word of the ``Processed reads:`` line and of the line after it."""
    rows = spark.read.text(path, wholetext=True).select(_file().alias("file"), F.regexp_extract("value", r"(?m)^\s*Processed reads:[^\n]*\n[^\n]*", 0).alias("two"))
    word = lambda i: F.regexp_replace(F.try_element_at(F.split(_bare(F.try_element_at(F.split("two", "\n"), F.lit(i))), r"\s+"), F.lit(3)), ",", "").try_cast("long")
    return rows.select("file", word(1).alias("reads"), word(2).alias("bases"))


def newick(spark: SparkSession, path: str) -> DataFrame:
    """The first line of each tree file: ``file, locus, newick``."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(_file().alias("file"), _named(raw, "locus").alias("locus"), F.trim(F.substring_index(F.regexp_replace("value", "\r", ""), "\n", 1)).alias("newick"))


def constraint_groups(spark: SparkSession, path: str) -> DataFrame:
    """One group of names to a line: ``group_id, taxon``. A group of one name stops the query."""
    rows = spark.read.text(path).select(_order().alias("ord"), F.split(_bare(F.col("value")), r"\s+").alias("w")).where("size(w) > 0 AND w[0] <> ''")
    checked = rows.select(F.to_json("ord").alias("ord"), F.when(F.assert_true(F.size("w") > 1, "a group needs two names").isNull(), F.col("w")).alias("w"))
    return checked.select(F.dense_rank().over(Window.orderBy("ord")).alias("group_id"), F.explode("w").alias("taxon"))


def likelihoods(spark: SparkSession, path: str) -> DataFrame:
    """Imported likelihoods: ``locus, n_taxa, ln_free, ln_clock``."""
    return spark.read.option("sep", "\t").option("header", True).schema("locus string, n_taxa int, ln_free double, ln_clock double").csv(path)


def check_loci(nt: DataFrame, aa: DataFrame) -> DataFrame:
    """Loci that lack their nucleotide or their amino-acid row: ``locus, missing``."""
    both = nt.select("locus", F.lit(1).alias("n")).join(aa.select("locus", F.lit(1).alias("a")), "locus", "full_outer")
    return both.where("n IS NULL OR a IS NULL").select("locus", F.when(F.col("n").isNull(), "nt").otherwise("aa").alias("missing"))


def alphabet(rows: DataFrame) -> DataFrame:
    """Each file's alphabet by its first sequence: ``file, nucleotide``."""
    return rows.groupBy("file").agg(F.min_by("seq", "ord").alias("s")).select("file", is_nucleotide("s").alias("nucleotide"))


def check_database_files(names: DataFrame) -> DataFrame:
    """Whether the files (column ``file``) are all FASTA or all index files: one row with counts and a verdict."""
    fa = F.col("file").rlike(FASTA_SUFFIX)
    udb = F.col("file").rlike(r"(?i)\.udb$")
    return names.agg(F.count_if(fa).alias("fasta"), F.count_if(udb).alias("index"), F.count("*").alias("files")).withColumn("sound", ((F.col("fasta") == F.col("files")) | (F.col("index") == F.col("files"))) & (F.col("files") > 0))


def ambiguous_share(seq) -> Column:
    """Percentage of characters that are neither bases nor gaps."""
    s = F.col(seq) if isinstance(seq, str) else seq
    return F.when(F.length(s) > 0, (F.length(s) - count_letters(s, "ACGT-")).cast("double") * 100 / F.length(s))
