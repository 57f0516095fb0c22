import random

import pytest
from pyspark.sql import functions as F

from weftline.operators import alignment as al
from weftline.operators import contigs, matrices, orthologs, relational, stats, trees


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


# relational


def test_pairs_are_deduplicated_on_either_strand(spark):
    pairs = frame(spark, "sample string, pair_id string, seq1 string, qual1 string, seq2 string, qual2 string", ("s", "b", "AAC", "III", "GT", "II"), ("s", "a", "AC", "II", "GTT", "III"), ("s", "c", "AAA", "III", "CC", "II"), ("t", "d", "AAC", "III", "GT", "II"))
    assert got(relational.dedup_pairs(pairs), "sample", "pair_id") == [("s", "a"), ("s", "c"), ("t", "d")]


def test_dedup_does_not_depend_on_partitions(spark):
    rng = random.Random(1)
    rows = spark.createDataFrame([(i, "".join(rng.choices("ACGT", k=3))) for i in range(300)], "id long, s string")
    one, two = (got(relational.dedup_either_strand(rows.repartition(n), "s", ["id"])) for n in (1, 7))
    assert one == two and got(relational.dedup_either_strand(relational.dedup_either_strand(rows, "s", ["id"]), "s", ["id"])) == one


def test_reads_go_to_their_best_target_and_pairs_together(spark):
    hits = frame(spark, "read_id string, target string, bits double, qlo long, qhi long", ("p/1", "l2", 9.0, 1, 4), ("p/1", "l1", 9.0, 1, 4), ("p/2", "l3", 5.0, 1, 4), ("p/2", "l1", 4.0, 1, 4))
    best = relational.assign_reads(hits)
    assert got(best, "read_id", "target") == [("p/1", "l1"), ("p/2", "l3")]
    pairs = frame(spark, "pair_id string, seq1 string", ("p", "A"), ("q", "C"))
    assert got(relational.assign_pairs(best, pairs), "pair_id", "target") == [("p", "l1"), ("p", "l3")]
    reads = frame(spark, "pair_id string, read_id string, seq string", ("p", "p/1", "ACgt"), ("p", "p/2", "aCGT"), ("q", "q/1", "acgt"))
    assert got(relational.unmasked_pairs(reads, None, 0.5)) == [("p",)]
    assert got(relational.unmasked_pairs(reads, frame(spark, "read_id string, qlo long, qhi long", ("q/1", 1, 2)), 0.5)) == [("p",)]


def test_second_best_gap(spark):
    rows = frame(spark, "k string, score double, t string", ("a", 9.0, "x"), ("a", 5.0, "y"), ("b", 9.0, "x"), ("b", 6.0, "y"), ("c", 1.0, "x"))
    assert got(relational.best_and_second(rows, ["k"], "score", 4, ["t"]), "k", "best", "second", "unique_best") == [("a", 9.0, 5.0, True), ("b", 9.0, 6.0, False), ("c", 1.0, None, True)]
    hits = frame(spark, "query string, target string, bits double, id double", ("q", "a", 9.0, 99.0), ("q", "b", 5.0, 59.0), ("r", "a", 9.0, 98.0), ("r", "b", 5.0, 59.0))
    assert got(orthologs.second_best(hits), "query", "target") == [("q", "a")]


def test_taxa_and_division(spark):
    rows = frame(spark, "locus string, taxon string, ord int", ("l1", "a", 1), ("l1", "a", 2), ("l1", "b", 3), ("l2", "a", 1), ("l2", "a", 2), ("l3", "c", 1))
    need = frame(spark, "taxon string", ("a",), ("b",))
    assert got(relational.divide(rows, need, "locus", "taxon")) == [("l1",)]
    assert len(got(relational.divide(rows, need.limit(0), "locus", "taxon"))) == rows.select("locus").distinct().count()
    assert got(relational.pick_taxa(rows, drop_duplicates=True), "locus", "taxon", "ord") == [("l1", "a", 1), ("l1", "b", 3)]
    assert got(relational.pick_taxa(rows, essential=need, min_seq=3), "locus") == [("l1",)] * 3
    with pytest.raises(ValueError):
        relational.pick_taxa(rows, need, need)
    merged = relational.merge_tables([rows, rows.where("locus = 'l3'")], min_seq=2, essential_sources=[0, 1])
    assert got(merged, "locus", "source_ord") == [("l3", 0), ("l3", 1)]


def test_interval_joins_match_a_nested_loop(spark):
    rng = random.Random(3)
    a = [(i, rng.choice("xy"), (s := rng.randrange(200)), s + rng.randrange(40)) for i in range(80)]
    b = [(i, rng.choice("xy"), (s := rng.randrange(200)), s + rng.randrange(40)) for i in range(80)]
    want = sorted((i, j) for i, k, p1, p2 in a for j, m, q1, q2 in b if k == m and p1 <= q2 and p2 >= q1)
    left, right = frame(spark, "i long, k string, p1 long, p2 long", *a), frame(spark, "j long, k string, q1 long, q2 long", *b)
    for bins in (None, 7, 1000):
        assert got(relational.interval_join(left, right, ["k"], ("p1", "p2"), ("q1", "q2"), bins), "i", "j") == sorted(want, key=repr)


# search and decisions


def test_status_of_assemblies(spark):
    hits = frame(
        spark, "locus string, sample string, target string, tlo long, thi long, bits double, id double",
        ("l1", "on", "g", 20, 30, 9.0, 99.0), ("l1", "off", "g", 21, 30, 9.0, 99.0), ("l1", "far", "g", 5, 15, 9.0, 99.0), ("l1", "far", "g", 50, 60, 5.0, 59.0),
        ("l1", "near", "g", 5, 15, 9.0, 98.0), ("l1", "near", "g", 50, 60, 5.0, 59.0), ("l2", "on", "g", 1, 5, 9.0, 99.0),
    )
    refs = frame(spark, "locus string, target string, tlo long, thi long", ("l1", "g", 10, 20))
    rows = frame(spark, "locus string, sample string", ("l1", "on"), ("l1", "off"), ("l1", "far"), ("l1", "near"), ("l1", "none"), ("l2", "on"))
    assert got(orthologs.ortholog_status(hits, refs, rows)) == [("l1", "far", "ortholog"), ("l1", "near", "paralog"), ("l1", "none", "nohit"), ("l1", "off", "paralog"), ("l1", "on", "ortholog"), ("l2", "on", "unqualified_reference")]
    raw = frame(spark, "query string, target string, tlo long, thi long, qlo long, qhi long, ql long, id double", ("l1", "g", 1, 9, 1, 9, 9, 98.0), ("l2", "g", 1, 9, 2, 9, 9, 99.0), ("l3", "g", 1, 9, 1, 9, 9, 97.9))
    assert got(orthologs.qualified_references(raw), "locus") == [("l1",)]
    assert got(orthologs.check_queries(frame(spark, "locus string", ("l1",), ("l2",)), raw)) == [("l2",)]


def test_search_finds_both_strands(spark):
    rng = random.Random(2)
    genome = "".join(rng.choices("ACGT", k=600))
    turned = genome[300:400][::-1].translate(str.maketrans("ACGT", "TGCA"))
    q = frame(spark, "name string, seq string", ("f", genome[100:160]), ("r", turned), ("n", "".join(rng.choices("ACGT", k=50))))
    hits = got(orthologs.seed_search(q, frame(spark, "name string, seq string", ("g", genome))), "query", "strand", "qlo", "qhi", "tlo", "thi", "id")
    assert hits == [("f", "+", 1, 60, 101, 160, 100.0), ("r", "-", 1, 100, 301, 400, 100.0)]
    masked = orthologs.mask_low_complexity(frame(spark, "name string, seq string", ("x", genome[:100] + "A" * 60 + genome[:9]))).first().seq
    assert "a" * 60 in masked and masked[:60] == genome[:60]


def test_frames(spark):
    rows = frame(spark, "name string, seq string", ("one", "ATGAAATAGATAAGTGATAAATAGA"), ("none", "TAATTAATTAATTAATTAATTAATTAAT"), ("many", "ATGGCTGCTGCTGCTGCT"))
    how = dict(got(orthologs.decide_frames(rows, most_stops=0), "name", "how"))
    assert how["none"] == "uncorrected" and how["many"] == "fewest"
    match = frame(spark, "name string, frame int", ("many", 1))
    chosen = orthologs.decide_frames(rows, match, 0).where("name = 'many'").first()
    assert (chosen.frame, chosen.how, chosen.stops) == (1, "protein", 0)
    ref = frame(spark, "name string, protein string", ("many", "MAAAAA"))
    assert got(orthologs.frame_by_kmers(rows, ref), "name", "frame") == [("many", 0)]
    assert got(orthologs.protein_matches(frame(spark, "name string, frame int, id double, coverage double, strand string", ("a", 1, 80.0, 90.0, "+"), ("b", 0, 79.9, 90.0, "+"), ("c", 0, 99.0, 99.0, "-")))) == [("a", 1)]


# alignments


def msa(spark, *rows):
    return frame(spark, "locus string, taxon string, seq string, is_ref boolean", *[("l", *r) if len(r) == 3 else ("l", *r, False) for r in rows])


def test_consensus_and_columns(spark):
    rows = msa(spark, ("a", "AC-T"), ("b", "TC-N"), ("c", "GA--"))
    assert al.consensus(rows).first().seq == "AC?T"
    assert al.consensus_any(rows).first().seq == "AC-N"
    assert got(al.drop_gap_columns(rows), "seq") == [("ACT",), ("GA-",), ("TCN",)]
    assert got(al.trim_gappy_units(rows, unit=1), "seq") == [("ACT",), ("GA-",), ("TCN",)]
    assert got(al.trim_gappy_units(rows, unit=2), "seq") == [("AC",), ("GA",), ("TC",)]


@pytest.mark.parametrize("n,want", [(40, [(0, 40)]), (50, [(0, 50)]), (74, [(0, 74)]), (75, [(0, 50), (25, 50)]), (99, [(0, 50), (25, 74)]), (100, [(0, 50), (25, 50), (50, 50)]), (130, [(0, 50), (25, 50), (50, 50), (75, 55)])])
def test_windows(spark, n, want):
    assert [tuple(w) for w in spark.range(1).select(al.windows(F.lit(n), 50, 25).alias("w")).first().w] == want


def test_indels_and_distances(spark):
    ref = frame(spark, "locus string, other string", ("l", "ACGTACGTACGTACGTACGTACGT"))
    rows = msa(spark, ("end", "-" * 12 + "ACGTACGTACGT"), ("in11", "AC" + "-" * 11 + "CGTACGTACGT"), ("in10", "AC" + "-" * 10 + "ACGTACGTACGT"), ("far", "A" * 24))
    assert dict(got(al.long_indels(rows, ref), "taxon", "longest")) == {"end": 0, "in11": 11, "in10": 10, "far": 0}
    assert [t for (t,) in got(al.drop_long_indels(rows, ref), "taxon")] == ["end", "far", "in10"]
    assert "far" not in [t for (t,) in got(al.drop_distant_rows(rows, ref, size=12, step=6), "taxon")]
    assert dict(got(al.trim_from_distant_window(msa(spark, ("x", "ACGTACGTACGT" + "T" * 12)), ref, size=6, step=6), "taxon", "seq"))["x"].startswith("ACGTACGTACGT-")


def test_flank_rules(spark):
    rows = msa(spark, ("a", "AC--GTAC"), ("b", "A---GTAC"), ("c", "----GTAC"))
    assert al.dense_start(rows, run=4, share=0.6).first().start == 4
    assert got(al.cut_sparse_flank(rows, run=4, share=0.6), "seq") == [("GTAC",)] * 3
    assert got(al.cut_sparse_flank(rows, run=9), "seq") == [("",)] * 3
    alone = msa(spark, ("a", "ACGTACGTACGTA"), *((x, "-" * 12 + "A") for x in "bcde"))
    assert dict(got(al.blank_private_runs(alone), "taxon", "seq"))["a"] == "-" * 13
    assert dict(got(al.blank_private_runs(alone, most=12), "taxon", "seq"))["a"] != "-" * 13
    block = msa(spark, ("a", "ACGTACGTAC"), ("b", "ACGTACGT--"), ("c", "ACGTACGTAC"))
    assert dict(got(al.poor_blocks(block), "taxon", "seq"))["b"] == "-" * 10
    assert al.poor_blocks(block, least_share=0.7).count() == 0
    assert got(al.drop_deviant(msa(spark, ("a", "ACGTACGT"), ("b", "ACGTACGA"), ("x", "TTTTTTTT"))), "taxon") == [("a",), ("b",)]
    assert got(al.reversed_block(al.reversed_block(block)), "seq") == got(block, "seq")


def test_flank_blocks(spark):
    flanked = msa(spark, ("r", "TT-ACGTGG", True), ("x", "TTAACGTGG", False), ("y", "--AACGT--", False), ("z", "TTTTTTTTT", False))
    coding = msa(spark, ("r", "ACGT", True), ("x", "ACGT", False), ("y", "ACGT", False), ("z", "ACGT", False))
    out = {r.taxon: (r.left, r.coding, r.right) for r in al.flank_blocks(flanked, coding).collect()}
    assert out["r"] == ("TT-", "ACGT", "GG") and out["x"] == ("TTA", "ACGT", "GG") and "z" not in out
    assert al.needs_realignment(flanked).first().gapful


def test_multiple_alignment(spark):
    rng = random.Random(6)
    base = [rng.choice("ACGT") for _ in range(60)]
    seqs = []
    for _ in range(5):
        s = base[:]
        cut = rng.randrange(40)
        seqs.append("".join(s[:cut] + s[cut + 3 :]))
    aligned = al.star_alignment(seqs)
    assert len({len(a) for a in aligned}) == 1 and [a.replace("-", "") for a in aligned] == seqs
    rows = msa(spark, ("a", "ATGAAACCC"), ("b", "ATGCCC"), ("c", "ATGCC"))
    assert got(al.align_codons(rows), "taxon", "seq") == [("a", "ATGAAACCC"), ("b", "ATG---CCC")]


def test_preconditions(spark):
    rows = frame(spark, "locus string, taxon string, seq string, is_ref boolean", ("ok", "r", "A" * 102, True), ("ok", "a", "C" * 102, False), ("short", "r", "A" * 99, True), ("short", "a", "A" * 99, False), ("noref", "a", "A" * 102, False), ("noref", "b", "A" * 102, False), ("uneven", "r", "A" * 102, True), ("uneven", "b", "A" * 105, False), ("three", "r", "A" * 103, True), ("three", "a", "A" * 103, False))
    assert {r.locus for r in al.sound_alignments(rows).collect()} == {"ok"}
    assert {r.locus for r in al.sound_alignments(rows, codon=False).collect()} == {"ok", "three"}


# contigs


def test_alignments_and_edges(spark):
    aln = frame(spark, "sample string, locus string, contig string, ord int, sim double, score double, stq long", ("s", "l", "c", 1, 59.99, 90.0, 1), ("s", "l", "c", 2, 60.0, 40.0, 2), ("s", "l", "c", 3, 70.0, 40.0, 3))
    assert got(contigs.best_alignments(aln), "ord") == [(3,)]
    edges = frame(spark, "src string, dst string", ("c-1", "c-10"), ("c-1", "c-2"), ("c-2", "c-3"))
    assert got(contigs.surviving_edges(edges, frame(spark, "contig string", ("c-1",), ("c-10",)))) == [("c-1", "c-10")]
    busy = frame(spark, "src string, dst string", *[("c-1", f"x{i}") for i in range(6)], ("c-10", "y"))
    assert got(contigs.drop_busy_nodes(busy)) == [("c-10", "y")]
    assert dict((r.node, (r.is_start, r.is_end)) for r in contigs.node_degrees(edges).collect())["c-3"] == (False, True)


def graph(spark, *edges):
    return frame(spark, "sample string, locus string, src string, dst string", *[("s", "l", *e) for e in edges])


def test_reduction_and_paths(spark):
    weigh = lambda *n: frame(spark, "sample string, locus string, contig string, score double", *[("s", "l", c, s) for c, s in n])
    bubble = graph(spark, ("a", "b"), ("a", "c"), ("b", "d"), ("c", "d")).withColumn("score", F.lit(0.0))
    assert got(contigs.reduce_graph(bubble, weigh(("a", 1.0), ("b", 5.0), ("c", 2.0), ("d", 1.0))), "src", "dst") == [("a", "b"), ("b", "d")]
    tip = graph(spark, ("a", "b"), ("a", "t"), ("b", "c")).withColumn("score", F.lit(0.0))
    assert got(contigs.reduce_graph(tip, weigh(("a", 1.0), ("b", 5.0), ("c", 2.0), ("t", 1.0))), "src", "dst") == [("a", "b"), ("b", "c")]
    back = graph(spark, ("a", "c"), ("t", "c"), ("c", "d")).withColumn("score", F.lit(0.0))
    assert got(contigs.reduce_graph(back, weigh(("a", 5.0), ("t", 1.0), ("c", 1.0), ("d", 1.0))), "src", "dst") == [("a", "c"), ("c", "d")]
    loop = graph(spark, ("a", "b"), ("b", "c"), ("c", "b"), ("c", "d"))
    assert got(contigs.all_paths(loop), "path") == [(["a", "b", "c", "d"],)]
    assert len(got(contigs.all_paths(graph(spark, ("a", "b"), ("a", "c"), ("b", "d"), ("c", "d")), most=1), "path")) == 1


def test_paths_become_sequences(spark):
    paths = contigs.all_paths(graph(spark, ("a", "b"), ("b", "c")))
    seqs = frame(spark, "sample string, locus string, contig string, seq string, score double", ("s", "l", "a", "AAACC", 3.0), ("s", "l", "b", "CGGTT", 2.0), ("s", "l", "c", "TTT", 1.0))
    edges = frame(spark, "sample string, locus string, src string, dst string, olp int, a_score double, b_score double", ("s", "l", "a", "b", 2, 1.0, 1.0), ("s", "l", "b", "c", 2, 1.0, 2.0))
    assert contigs.merge_paths(paths, seqs, edges).first().seq == "AAACCGTTT"
    assert contigs.path_scores(paths, seqs, edges).first().score == 4.0


def test_overlaps(spark):
    pairs = frame(spark, "a_seq string, b_seq string", ("TTTTACGTACGTAC", "ACGTACGTACGG"), ("AAAA", "CCCC"))
    assert got(contigs.suffix_prefix(pairs, most=12, least=4), "olp", "mismatches") == [(10, 0)]
    pt = F.array(*[F.struct(F.lit(float(s)).alias("score"), F.lit(q).alias("q"), F.lit(1).alias("t")) for s, q in ((4, 1), (-3, 0), (2, 1), (9, 1))])
    row = spark.range(1).select(contigs.overlap_scores(pt, F.lit(2)).alias("a"), contigs.overlap_scores(pt, F.lit(1), True).alias("b"), contigs.overlap_scores(pt, F.lit(9)).alias("c")).first()
    assert tuple(row) == (3.0, 9.0, 12.0)
    edges = frame(spark, "a_len int, a_first int, b_first int, olp int", (30, 0, 0, 12), (30, 0, 1, 12), (30, 0, 2, 13))
    assert got(contigs.same_phase(edges), "b_first") == [(0,)]
    cols = "sample string, locus string, contig string, seq string, stq long, edq long, sts long, eds long, query_len int"
    same, other = "ACGTTGCAACGGTC", "ACGTTGCAATTTTTTTTT"
    two = frame(spark, cols, ("s", "l", "c1", "A" * 20 + same, 0, 10, 0, 30, 30), ("s", "l", "c2", same + "T" * 20, 8, 18, 4, 34, 30), ("s", "l", "c3", "G" * 40, 12, 22, 4, 34, 30), ("s", "l", "in", "A" * 15, 2, 7, 0, 15, 30))
    assert got(contigs.inferred_overlaps(two), "src", "dst", "olp", "shared") == [("c1", "c2", 14, 6)]
    known = frame(spark, "sample string, locus string, src string, dst string", ("s", "l", "c2", "c1"))
    assert got(contigs.inferred_overlaps(two, known)) == []
    # two shared 9-mers are not enough for ends of 18 bases, nor do tails of over 50 bases pass
    few = frame(spark, cols, ("s", "l", "c1", "A" * 24 + "CC" + other[:9] + "GGGGGGG", 0, 10, 0, 30, 30), ("s", "l", "c2", other + "T" * 20, 8, 18, 6, 36, 30))
    assert got(contigs.inferred_overlaps(few)) == []
    # a contig that is aligned to an end reaches beyond it by its unaligned end
    spots = contigs.placed(frame(spark, cols, ("s", "l", "x", "A" * 50, 0, 10, 7, 37, 10), ("s", "l", "y", "A" * 50, 3, 8, 7, 22, 10)))
    assert got(spots, "contig", "lo", "hi") == [("x", -7, 42), ("y", 9, 23)]


def test_best_contigs_and_assembly(spark):
    cols = "sample string, locus string, contig string, seq string, coding string, strand string, score double, sim double, stq long, edq long, query_len int"
    base = ("s", "l", "c", "ATGAAA", "ATGAAA", "+", 5.0, 60.0, 0, 8, 10)
    vary = lambda **k: tuple(k.get(n, v) for n, v in zip([c.split()[0] for c in cols.split(", ")], base))
    rows = frame(spark, cols, base, vary(contig="rev", strand="-", score=9.0), vary(contig="short", edq=7, score=9.0), vary(contig="stop", coding="TAAATG", score=9.0), vary(contig="n", coding="ATGANA", score=9.0), vary(contig="long", seq="ATGAAAT"))
    assert got(contigs.best_contigs(rows), "contig") == [("long",)]
    rng = random.Random(4)
    truth = "".join(rng.choices("ACGT", k=300))
    reads = frame(spark, "sample string, locus string, seq string", *[("s", "l", truth[i : i + 80]) for i in range(0, 221, 20)])
    assert got(contigs.assemble(reads), "seq") == [(truth,)]
    found = al.align_proteins(frame(spark, "locus string, contig string, seq string, protein string", ("l", "c", "CC" + "ATGGCTAAAGGT" + "C", "MAKG"))).first()
    assert (found.strand, found.sts, found.eds, found.stq, found.edq, found.sim) == ("+", 2, 14, 0, 4, 100.0)


# statistics, matrices, trees


def test_statistics(spark):
    rows = msa(spark, ("a", "ACGT"), ("b", "AC-N"))
    assert got(stats.coding_summary(rows)) == [("l", 2, 4, 50.0, 25.0, 0.0)]
    blocks = frame(spark, "locus string, taxon string, left string, right string", ("l", "a", "A" * 20, "ACG"), ("l", "b", "A" * 19 + "C", "ACG"))
    assert got(stats.flanking_summary(blocks)) == [("l", "left", 20, 0.05), ("l", "right", 3, None)]
    assert got(stats.sample_summary(rows, blocks))[0][:2] == ("a", 1)
    depth = frame(spark, "sample string, chrom string, pos long, depth long", ("s", "c", 1, 4), ("s", "c", 2, 6))
    flags = frame(spark, "sample string, total long, duplicates long, mapped long", ("s", 200, 20, 150))
    assert got(stats.map_statistics(depth, flags)) == [("s", 200, 150, 20, 130, 65.0, 5.0)]
    reads = frame(spark, "sample string, mate int, seq string, qual string", ("s", 1, "ACGTACGTACGTACGTACGTACGT" + stats.ADAPTORS[0][:10], "I" * 34), ("s", 2, "ACGTACGTACGTACGTACGTAC", "I" * 21 + "#"), ("s", 1, "ACG", "III"))
    assert got(stats.trim_reads(reads), "seq") == [("ACGTACGTACGTACGTACGTA",), ("ACGTACGTACGTACGTACGTACGT",)]


def test_matrices(spark):
    rows = frame(spark, "locus string, taxon string, seq string", ("l2", "a", "GG"), ("l1", "a", "ACG"), ("l1", "b", "A-G"), ("l3", "c", "T"))
    matrix, blocks = matrices.supermatrix(rows, 1, ("c", "z"))
    assert got(matrix) == [("a", "ACGGG-"), ("b", "A-G---"), ("z", "-----T")]
    assert got(blocks) == [("l1", 3, 1, 3), ("l2", 2, 4, 5), ("l3", 1, 6, 6)]
    assert got(matrices.gap_report(rows, 2)) == [("a", 1, 0.0), ("b", 1, 33.33)]
    gt = lambda *g: dict(zip(("s1", "s2", "s3", "s4", "s5"), g))
    schema = "chrom string, pos long, ref string, alt string, qual double, filter string, info map<string,string>, gt map<string,string>"
    v = frame(
        spark, schema, ("L1", 1, "A", "C", 9.0, "PASS", {"QD": "3"}, gt("0/0", "0|1", "1/1", "./.", "./1")), ("L1", 2, "A", "C", 9.0, "LowQ", {}, gt(*["0/1"] * 5)), ("L1", 3, "AT", "C", 9.0, "PASS", {}, gt(*["0/1"] * 5)),
        ("L2", 4, "A", "C", 9.0, "PASS", {"QD": "1"}, gt(*["0/0"] * 5)), ("L1", 5, "A", "C", 9.0, "PASS", {}, gt("0/2", *["0/1"] * 4)), ("L3", 6, "A", "C", 9.0, "PASS", {}, gt("./.", "./.", "0/1", "0/1", "0/1")),
    )
    sound = matrices.sound_variants(v)
    assert got(sound, "pos") == [(1,), (4,)]
    assert got(matrices.polymorphic(sound), "pos") == [(1,)]
    assert got(matrices.site_filter(v), "pos") == [(1,), (2,), (3,), (5,), (6,)]
    assert len(matrices.select_samples(v, ["s1", "s2"]).first()["gt"]) == 2
    m = {r.taxon: (r.a1, r.a2, r.sums, r.missing) for r in matrices.snp_matrix(matrices.one_snp_per_locus(sound)).collect()}
    assert m["s2"] == (["0"], ["1"], ["1"], 0) and m["s5"] == (["."], ["1"], ["-"], 0) and m["s4"][3] == 1


def distances(text):
    nodes = {n[0]: n for n in trees.parse_newick(text)}
    up = lambda i: [i] + (up(nodes[i][1]) if nodes[i][1] is not None else [])
    leaves = {n[2]: i for i, n in nodes.items() if n[2] and i not in {m[1] for m in nodes.values()}}
    out = {}
    for a in leaves:
        for b in leaves:
            x, y = up(leaves[a]), up(leaves[b])
            out[a, b] = sum(nodes[i][3] or 0 for i in set(x) ^ set(y))
    return out


def test_trees(spark):
    rng = random.Random(3)

    def grow(names):
        if len(names) == 1:
            return f"{names[0]}:{rng.random():.4f}"
        k = rng.randrange(1, len(names))
        return f"({grow(names[:k])},{grow(names[k:])}):{rng.random() * 1e-3:.2e}"

    for _ in range(40):
        names = [f"t{i}" for i in range(9)]
        text = grow(names) + ";"
        keep = set(rng.sample(names, 5))
        small = trees.restrict_tree(text, keep)
        want = distances(text)
        for (a, b), d in distances(small).items():
            assert d == pytest.approx(want[a, b], abs=1e-9)
        assert "e" not in small.replace("t", "")
    assert trees.restrict_tree("(a:1,b:2);", {"a"}) is None
    assert trees.restrict_tree("((a:1,ab:2):1,(b:1,c:3):2);", {"a", "b", "c"}) in ("(b:1,c:3,a:4);", "(a:4,b:1,c:3);")
    rows = got(trees.tree_rows(frame(spark, "locus string, newick string", ("l", "(a:1,b:2e-1);"))), "name", "branch_length")
    assert rows == [("a", 1.0), ("b", 0.2), (None, None)]
    taxa = frame(spark, "locus string, taxon string", ("l", "a"), ("l", "b"), ("l", "z"), ("m", "a"), ("m", "z"))
    groups = frame(spark, "group_id int, taxon string", (1, "a"), (1, "b"), (2, "c"), (2, "d"))
    assert got(trees.constraint_trees(groups, taxa)) == [("l", "((a,b),z);")]
    assert trees.restrict_trees(frame(spark, "locus string, newick string", ("l", "((a:1,q:1):1,(b:1,z:3):2);")), taxa).first().n_taxa == 3
    assert got(trees.rename_taxa(taxa), "locus", "short")[0] == ("l", "taxon1")


def test_likelihoods(spark):
    assert trees.chi2_upper(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert trees.chi2_upper(18.307038053275146, 10) == pytest.approx(0.05, abs=1e-9)
    assert trees.chi2_upper(0, 3) == 1.0
    rows = frame(spark, "locus string, n_taxa int, ln_free double, ln_clock double", ("keep", 3, -10.0, -11.9), ("gone", 3, -10.0, -12.0), ("few", 2, -1.0, -1.0))
    assert got(trees.clocklike(rows), "locus") == [("keep",)]
    tests = frame(spark, "locus string, p double, constrained_best boolean", ("a", 0.06, False), ("b", 0.05, False), ("c", None, True))
    assert got(trees.monophyletic(tests), "locus") == [("a",), ("c",)]


def test_null_scores_never_win(spark):
    rows = frame(spark, "k string, bits double, target string", ("a", None, "x"), ("a", 50.0, "y"), ("a", 50.0, None), ("b", None, "z"), ("c", 7.0, "u"), ("c", 3.0, "v"))
    assert got(relational.best_per_key(rows, ["k"], [-F.col("bits"), "target"]), "k", "target") == [("a", "y"), ("b", "z"), ("c", "u")]
    out = relational.best_and_second(rows, ["k"], "bits", 1, ["target"])
    assert sorted(map(tuple, out.select("k", "n", "best", "second", "unique_best").collect()), key=str) == [("a", 3, 50.0, 50.0, False), ("b", 1, None, None, False), ("c", 2, 7.0, 3.0, True)]


def test_sides_that_lack_rows(spark):
    a = frame(spark, "locus string, taxon string", ("l", "x"), ("l", "y"), ("m", "x"))
    b = frame(spark, "locus string, taxon string", ("l", "x"), ("l", "z"), ("n", "x"))
    assert got(al.flank_sides(a, b)) == [("l", 1, 1, 1), ("m", 0, 1, 0), ("n", 0, 0, 1)]
    one, two = (frame(spark, "locus string, newick string", *((x, f"({x});") for x in s)) for s in ("ab", "ba"))
    assert got(trees.paired_trees(one, two), "locus", "constrained") == [("a", "(a);"), ("b", "(b);")]
    with pytest.raises(Exception, match="no tree"):
        trees.paired_trees(one, two.limit(1)).collect()


def test_a_ladder_of_a_hundred_thousand_taxa(spark):
    n = 100_000
    text = "(" * n + "t0" + "".join(f":1,t{i}:{i + 1})" for i in range(1, n + 1)) + ";"
    cut = trees.restrict_tree(text, {f"t{i}" for i in range(0, n + 1, 2)})
    nodes = trees.parse_newick(cut)
    far = []
    for _, parent, _, length in nodes:
        far.append(0 if parent is None else far[parent] + (length or 0))
    place = {name: k for k, (_, _, name, _) in enumerate(nodes) if name}
    assert len(place) == n // 2 + 1
    for i in (2, 4, 50_000, n - 2):
        k = place[f"t{i}"]
        assert far[place["t0"]] - far[nodes[k][1]] + nodes[k][3] == 2 * i + 1
    assert trees.parse_newick(trees.write_newick(nodes)) == nodes
    rows = spark.createDataFrame([("l", text), ("none", None), ("one", "a;")], "locus string, newick string")
    got = trees.tree_rows(rows).groupBy("locus").agg(F.count("*").alias("n"), F.max("from_root").alias("far")).collect()
    assert sorted(map(tuple, got)) == [("l", 2 * n + 1, float(n + 1)), ("one", 1, 0.0)]
