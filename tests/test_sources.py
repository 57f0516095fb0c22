import gzip

import pytest
from pyspark.sql import functions as F

from weftline.sources import readers, sinks


def put(folder, name, text):
    (folder / name).write_bytes(gzip.compress(text.encode()) if name.endswith(".gz") else text.encode())
    return str(folder)


def test_strict_and_permissive_fasta(spark, tmp_path):
    path = put(tmp_path, "loc1.fas", ">a desc > more\r\nac\r\ngt\r\n>b\nAC-\n>a\nTTTT\n>c\n\n>d\nAC!T\n>e x\nAC?*")
    put(tmp_path, ".hidden.fas", ">z\nAAA")
    rows = {r["name"]: r for r in readers.fasta(spark, path).collect()}
    assert {k: r.seq for k, r in rows.items()} == {"a": "ACGT", "b": "AC-", "e": "AC?*"}
    assert rows["a"].header == "a desc > more" and rows["a"].locus == "loc1"
    loose = readers.fasta(spark, path, strict=False).orderBy("ord").collect()
    assert [(r["name"], r.seq) for r in loose] == [("a", "acgt"), ("b", "AC-"), ("a", "TTTT"), ("c", ""), ("d", "AC!T"), ("e", "AC?*")]
    assert {(r["name"], r.problem) for r in readers.fasta_problems(spark, path).collect()} == {("c", "empty"), ("d", "alphabet"), ("a", "duplicate")}
    assert readers.alignment_lengths(readers.fasta(spark, path)).first().length is None
    assert readers.alphabet(readers.fasta(spark, path)).first().nucleotide


def test_fastq_pairs(spark, tmp_path):
    put(tmp_path, "s1_R1.fq.gz", "@p1/1\nACGT\n+\nIIII\n@p2/1\nAC\n+\nII\n")
    put(tmp_path, "s1_R2.fq.gz", "@p1/2\nTTT\n+\nIII\n@p2/2\nGG\n+\nII\n")
    put(tmp_path, "s2_R1.fq", "@q/1\nA\n+\nI\n")
    rows = readers.reads(spark, str(tmp_path))
    pairs = readers.read_pairs(rows)
    assert sorted((r.sample, r.pair_id, r.seq1, r.seq2) for r in pairs.collect()) == [("s1", "p1", "ACGT", "TTT"), ("s1", "p2", "AC", "GG")]
    assert sorted(r.read_id for r in readers.single_reads(pairs).collect()) == ["p1/1", "p1/2", "p2/1", "p2/2"]
    assert {(r.sample, r.reads, r.bases) for r in readers.read_counts(rows).collect()} == {("s1", 4, 11), ("s2", 1, 1)}
    assert [r.sample for r in readers.incomplete_samples(rows).collect()] == ["s2"]
    put(tmp_path, "s2_R2.fq", "@q/2\nAA\n+\nI\n")
    with pytest.raises(Exception, match="differ in length"):
        readers.read_pairs(readers.reads(spark, str(tmp_path))).collect()


def test_lists_markers_proteome_groups(spark, tmp_path):
    a, b, c, d = (tmp_path / x for x in "abcd")
    for x in (a, b, c, d):
        x.mkdir()
    assert [r.sample for r in readers.word_list(spark, put(a, "l", "x\n\ny\r\n")).orderBy("sample").collect()] == ["x", "y"]
    put(a, "l", "x y\n")
    with pytest.raises(Exception, match="more than one word"):
        readers.word_list(spark, str(a)).collect()
    m = readers.markers(spark, put(b, "m", "pos\tz\nO:LG1:5:9|g1\t1\n"), header=True).first()
    assert (m.chrom, m.start, m.end, m.gene) == ("LG1", 5, 9, "g1")
    p = put(c, "p.fa", ">p1 pep gene:g1.2 x\nMK\nL\n>p2 gene:g9\nM\n")
    wanted = spark.createDataFrame([("g1",)], "gene string")
    assert [(r.gene, r.prot_id, r.aa) for r in readers.proteome(spark, p, wanted).collect()] == [("g1", "p1", "MKL")]
    groups = readers.constraint_groups(spark, put(d, "g", "a b c\nd e\n")).collect()
    assert sorted((r.group_id, r.taxon) for r in groups) == [(1, "a"), (1, "b"), (1, "c"), (2, "d"), (2, "e")]


def test_hits_edges_reports(spark, tmp_path):
    a, b, c, d, e, f = (tmp_path / x for x in "abcdef")
    for x in (a, b, c, d, e, f):
        x.mkdir()
    h = readers.hits(spark, put(a, "h", "q\tt\t50\t9\t3\t1\t4\t7\t99.5\n"), "research").first()
    assert (h.tlo, h.thi, h.id) == (3, 9, 99.5)
    g = readers.asqg_edges(spark, put(b, "g", "HT\tx\nVT\tc1\tACGT\nED\tc-1 c-10 2 5 6 0 3 8 0 0\n")).first()
    assert (g.src, g.dst, g.olp) == ("c-1", "c-10", 4)
    s = readers.alignment_report(spark, put(c, "s", "x\nsugar: l1 0 5 . c1 0 15 + 40 88.5\npt: 4 1 3\npt: -2 1 3\nsugar: l1 1 2 . c2 9 3 - 7 60\n")).orderBy("ord").collect()
    assert [(r.contig, r.score, r.sim, len(r.pt)) for r in s] == [("c1", 40.0, 88.5, 2), ("c2", 7.0, 60.0, 0)]
    assert readers.trimming_report(spark, put(d, "t", "a\nProcessed reads: 1,234\nProcessed bases: 99 bp\n")).first()[1:] == (1234, 99)
    put(e, "s1.txt", "98 + 2 in total (x)\n5 + 0 duplicates\n89 + 1 mapped (90%)\n")
    assert readers.flagstat(spark, str(e)).first() == ("s1", 100, 5, 90)
    put(f, "s1.depth", "LG1\t1\t5\nLG1\t2\t7\n")
    assert readers.depth_table(spark, str(f)).agg(F.sum("depth")).first()[0] == 12


def test_vcf_and_trees(spark, tmp_path):
    a, b = tmp_path / "v", tmp_path / "t"
    a.mkdir(), b.mkdir()
    put(a, "x.vcf", "##h\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\nL1\t5\t.\tA\tC\t30\tPASS\tQD=3.5;FS=1\tGT:DP\t0/1:3\t./.:0\n")
    r = readers.vcf(spark, str(a)).first()
    assert (r.chrom, r.pos, r.gt, r.info["QD"]) == ("L1", 5, {"s1": "0/1", "s2": "./."}, "3.5")
    put(b, "loc.tre", "(a:1,b:2);\nmore")
    assert readers.newick(spark, str(b)).first()[1:] == ("loc", "(a:1,b:2);")


def test_checks(spark):
    nt, aa = (spark.createDataFrame([(x,) for x in s], "locus string") for s in ("ab", "bc"))
    assert {tuple(r) for r in readers.check_loci(nt, aa).collect()} == {("a", "aa"), ("c", "nt")}
    files = lambda *n: readers.check_database_files(spark.createDataFrame([(x,) for x in n], "file string")).first().sound
    assert files("a.fa", "b.FASTA") and files("a.udb") and not files("a.fa", "b.udb")
    row = readers.baits(spark.createDataFrame([("Sp.LG1.9.5",)], "name string")).first()
    assert (row.chrom, row.start, row.end, row.strand) == ("LG1", 5, 9, "-")


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("l1", "b", "AC", False), ("l1", "ref", "GG", True), ("l2", "a", "T", False)], "locus string, taxon string, seq string, is_ref boolean")
    sinks.write_fasta(rows, str(tmp_path / "f"))
    back = readers.fasta(spark, str(tmp_path / "f"), strict=False)
    assert sorted(r["name"] for r in back.collect()) == ["a", "b", "ref"]
    lines = [r.value for r in spark.read.text(str(tmp_path / "f/locus=l1")).collect()]
    assert lines == [">ref", "GG", ">b", "AC"]
    matrix = spark.createDataFrame([("a", "AC--"), ("b", "ACGT")], "taxon string, seq string")
    sinks.write_supermatrix(matrix, str(tmp_path / "m"))
    assert [r.value for r in spark.read.text(str(tmp_path / "m/phylip")).collect()] == ["2 4", "a AC--", "b ACGT"]
    sinks.write_nexus(matrix, spark.createDataFrame([("l1", 1, 2), ("l2", 3, 4)], "locus string, start int, end int"), str(tmp_path / "n"))
    text = [r.value for r in spark.read.text(str(tmp_path / "n")).collect()]
    assert "CHARSET l1=1-2;" in text and text[-1] == "END;"
    snps = spark.createDataFrame([("a", ["0", "."], ["1", "."], ["1", "-"])], "taxon string, a1 array<string>, a2 array<string>, sums array<string>")
    sinks.write_snps(snps, str(tmp_path / "s"))
    assert [r.value for r in spark.read.text(str(tmp_path / "s/structure")).collect()] == ["a\t0\t-9", "a\t1\t-9"]
    whole = lambda x: [r.value.strip() for r in spark.read.text(str(tmp_path / "s" / x)).collect()]
    assert whole("nexus") == ["#NEXUS", "Begin characters;", "Dimensions ntax=2 nchar=2;", 'Format symbols="012" missing=?;', "Matrix", "a_1\t0?", "a_2\t1?", ";", "End;"]
    assert whole("sums") == ["#NEXUS", "Begin data;", "Dimensions ntax=1 nchar=2;", 'Format datatype=integerdata symbols="012" gap=-;', "Matrix", "a\t1-", ";", "End;"]
    assert whole("table") == ["a\t1\t-"]
    sinks.write_enriched(spark.createDataFrame([("s2", 3, 30.0), ("s1", 1, 10.0)], "sample string, n long, pct double"), 10, str(tmp_path / "e"))
    assert [r.value for r in spark.read.text(str(tmp_path / "e")).collect()] == ["total\t10", "", "sample\tn\tpct", "s1\t1\t10.00", "s2\t3\t30.00"]
    sinks.write_report(spark.createDataFrame([("a", None)], "x string, y int"), str(tmp_path / "r"))
    assert [r.value for r in spark.read.text(str(tmp_path / "r")).collect()] == ["x\ty", "a\tNA"]


def test_reads_in_files_of_bounded_bytes(spark, tmp_path):
    rows = spark.range(600).select((F.col("id") % 3).cast("string").alias("sample"), (F.col("id") % 2 + 1).cast("int").alias("mate"), F.concat(F.lit("r"), F.floor(F.col("id") / 2).cast("string")).alias("read_id"), F.lit("ACGT" * 10).alias("seq"), F.lit("IIII" * 10).alias("qual"))
    sinks.write_reads(rows, str(tmp_path / "r"), most_bytes=3000)
    sizes = [p.stat().st_size for p in (tmp_path / "r").rglob("part-*")]
    assert max(sizes) < 1.5 * 3000 and len(sizes) >= 3 * 2 * 3
    back = readers.reads(spark, str(tmp_path / "r"))
    key = ["sample", "mate", "read_id", "seq", "qual"]
    assert sorted(map(tuple, back.select(key).collect())) == sorted(map(tuple, rows.select(key).collect()))
    assert readers.read_pairs(back, by="read_id").count() == readers.read_pairs(back, by="read_id").distinct().count()
    for s, n in (("a", 2), ("b", 3)):
        (tmp_path / "g" / s).mkdir(parents=True)
        for k in range(n):
            (tmp_path / "g" / s / f"{k}.fq.gz").write_bytes(b"x")
    assert [tuple(r) for r in readers.unpaired_folders(spark, str(tmp_path / "g")).collect()] == [("b", 3)]
