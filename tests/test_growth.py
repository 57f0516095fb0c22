import os
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from weftline.operators import alignment, contigs, relational, strings
from weftline.plans import driver_queries, file_queries, operator_queries, scratch  # noqa: F401
from weftline.sources import fastq
from weftline.streaming import streams

SMALL = "/root/testdata/sf0.001"


def plan_of(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["frame_by_kmers", "diverged_alignment", "diverged_codons", "gapped_search", "seed_search"])
def test_kmers_are_not_broadcast(spark, name):
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").removesuffix("b")) >= 10 << 20
    assert "Broadcast" not in plan_of(driver_queries.QUERIES[name](spark, SMALL))


@pytest.mark.parametrize("name", ["diverged_alignment", "diverged_codons"])
def test_families_are_aligned_once(spark, name):
    assert plan_of(driver_queries.QUERIES[name](spark, SMALL)).count("FlatMapGroupsInPandas") == 1


def test_a_kmer_solid_by_chance_spoils_no_right_base(spark):
    """Another sequence shares the wrong read's letters up to a place, and those after it but one."""
    rng = random.Random(4)
    right, at = "".join(rng.choices("ACGT", k=96)), 38
    turned = str.maketrans("ACGT", "CGTA")
    wrong = right[:at] + right[at].translate(turned) + right[at + 1 :]
    other = "".join(rng.choices("ACGT", k=30)) + wrong[35:56] + right[56].translate(turned) + right[57:60] + right[60].translate(turned) + "".join(rng.choices("ACGT", k=40))
    rows = [("s", f"r{i}", right) for i in range(5)] + [("s", f"o{i}", other) for i in range(5)] + [("s", "w", wrong)]
    got = {r.read_id: (r.seq, r.n_corrected) for r in strings.correct_reads(spark.createDataFrame(rows, "sample string, read_id string, seq string")).collect()}
    assert got == {**{f"r{i}": (right, 0) for i in range(5)}, **{f"o{i}": (other, 0) for i in range(5)}, "w": (right, 1)}


def test_chance_seeds_between_suppliers(spark, tmp_path):
    """Of these suppliers two share 22 letters by chance, and one has letters that its other strand has too."""
    import duckdb

    spark.createDataFrame([(19065,), (4550,), (52748,)], "s_suppkey long").coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    got = driver_queries.QUERIES["seed_search"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW supplier AS SELECT * FROM '{tmp_path}/supplier.parquet/*.parquet'")
    want = con.execute(driver_queries.ORACLES["seed_search"])
    assert got.columns == [c[0] for c in want.description]
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_equal_rows_are_compared_once(spark):
    """Rows of one name are no pair, whatever they hold; 700 rows of four kinds meet in one block."""
    seqs = ["ACGT-A", "ACGA-A", "TCGA", "------"]
    rows = [("l", f"t{i % 650}", seqs[i % 3 if i % 50 else 3]) for i in range(700)]
    sums = alignment.pair_sums(spark.createDataFrame(rows, "locus string, taxon string, seq string"), ["locus"]).cache()
    assert sums.where("n > 0").count() == 1
    want_n, want = 0, 0.0
    for i, (_, a, s) in enumerate(rows):
        for _, b, t in rows[:i]:
            ok = [(x, y) for x, y in zip(s, t) if x in "ACGT" and y in "ACGT"]
            if a != b and ok:
                want_n, want = want_n + 1, want + sum(x != y for x, y in ok) / len(ok)
    got = sums.groupBy("locus").sum("n", "total").first()
    assert got["sum(n)"] == want_n and got["sum(total)"] == pytest.approx(want, rel=1e-12)


def test_reciprocal_nearest_makes_no_pairs(spark):
    """The same as by all pairs, with ties, equal values and rows without one."""
    rng = random.Random(6)
    side = lambda n: [(rng.choice([1, 1, 2, None, 3]), k, rng.choice([None, *(x / 4 for x in range(40))])) for k in range(n)]
    rows = [side(60), side(80)]
    rows[0].append((7, 90, None)), rows[1].extend([(7, 91, 1.0), (7, 90, None)])
    one, two = (spark.createDataFrame(r, f"k int, {n} long, v double") for r, n in zip(rows, "ab"))
    pairs = one.join(two.withColumnRenamed("v", "w"), "k").select("a", "b", F.abs(F.col("v") - F.col("w")).alias("d"))
    want = relational.reciprocal_best(pairs, pairs, ["d", "b"], ["d", "a"])
    got = relational.reciprocal_nearest(one, two, ["k"], "a", "b")
    assert sorted(map(tuple, got.select("a", "b").collect())) == sorted(map(tuple, want.collect())) != []
    plan = plan_of(driver_queries.QUERIES["reciprocal_best"](spark, SMALL))
    assert plan.count("Join") == 1, plan


def test_equal_strings_overlap_once(spark):
    """Forty rows of two strings: what is tried is four pairs of strings, not 1,600 of rows."""
    rows = spark.createDataFrame([(1, k, ("abcdef", "defabc")[k % 2]) for k in range(40)] + [(2, 50, "abcdef"), (2, 51, None)], "g int, i long, a_seq string")
    got = contigs.suffix_prefix_of_groups(rows, rows.select("g", F.col("i").alias("j"), F.col("a_seq").alias("b_seq")), ["g"], most=6, least=3, error=0.0)
    want = [(1, i, j, 6 if i % 2 == j % 2 else 3, 0) for i in range(40) for j in range(40)] + [(2, 50, 50, 6, 0)]
    assert sorted(map(tuple, got.select("g", "i", "j", "olp", "mismatches").collect())) == want
    plan = plan_of(driver_queries.QUERIES["suffix_prefix_overlap"](spark, SMALL))
    assert plan.count("Join") == 3, plan


def test_many_ranges_share_tasks(spark, tmp_path):
    """3,000 ranges of bytes of a file are some 64 tasks, and hold each read once."""
    (tmp_path / "a_R1.fq").write_text("".join(f"@r{i}\nACGT\n+\nIIII\n" for i in range(4000)))
    found = fastq.fastq(spark, str(tmp_path), 20)
    assert 60 <= found.rdd.getNumPartitions() <= 130
    assert sorted(r.ord for r in fastq.numbered(found).collect()) == list(range(4000))


def test_calls_are_counted_not_collected(spark):
    assert "collect_list" not in plan_of(driver_queries.QUERIES["snp_missing"](spark, SMALL))


def test_state_of_reads_needs_no_frame_for_each_sequence():
    class Seen:
        value = None
        exists = lambda self: self.value is not None

        def update(self, value):
            self.value = value

    first = streams._FirstSeen()
    first.seen = Seen()
    rows = [Row(sample="s", id=i, seq="ACG") for i in ("3", "12", "2")]
    assert list(first.handleInputRows(("s",), iter(rows), None)) == [rows[1]] and first.seen.value == ("12",)
    late = iter([Row(sample="s", id="0", seq="ACG")])
    assert list(first.handleInputRows(("s",), late, None)) == [] == list(late)


def test_a_round_s_table_goes_when_the_next_is_written(spark):
    old = scratch.stored(spark.range(5))
    path = old.inputFiles()[0].removeprefix("file:")
    new = scratch.replaced(old, old.where("id > 1"))
    assert new.count() == 3 and not os.path.exists(os.path.dirname(path.replace("///", "/")))
