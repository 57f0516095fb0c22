import pytest
from pyspark.sql import functions as F

from weftline.functions import seq


def value(spark, column, **row):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in row.items()] or ["id"]).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "column,row,want",
    [
        (lambda: seq.reverse_complement("s"), {"s": "AACGTN-"}, "-NACGTT"),
        (lambda: seq.canonical("s"), {"s": "TTT"}, "AAA"),
        (lambda: seq.translate("s"), {"s": "ATGTAA---NNNAC"}, "M*-X"),
        (lambda: seq.translate("s", 1), {"s": "AATGTAA"}, "M*"),
        (lambda: seq.translate("s"), {"s": "AT"}, ""),
        (lambda: seq.strip_trailing_stops("s"), {"s": "M*K**"}, "M*K"),
        (lambda: seq.strip_trailing_stops("s"), {"s": "*"}, "*"),
        (lambda: seq.count_stops("s"), {"s": "M*K**"}, 3),
        (lambda: seq.codon_position(F.lit(5), F.lit(3)), {}, 1),
        (lambda: seq.hamming("a", "b"), {"a": "ACGT", "b": "AGG"}, 2),
        (lambda: seq.comparable_mismatches("a", "b"), {"a": "A-?T*", "b": "CC?A*"}, 2),
        (lambda: seq.p_distance("a", "b"), {"a": "AC-T", "b": "AGGT"}, 0.333),
        (lambda: seq.p_distance("a", "b", 4), {"a": "AC-T", "b": "AGGT"}, None),
        (lambda: seq.nucleotide_distance("a", "b"), {"a": "ACNN", "b": "AGNN"}, 0.5),
        (lambda: seq.gc("a"), {"a": "ACG-"}, 2 / 3),
        (lambda: seq.coverage("a"), {"a": "AC-"}, 0.667),
        (lambda: seq.columns_to_base("a", 1), {"a": "-A-C"}, 4),
        (lambda: seq.columns_to_base("a", 5), {"a": "-A-C"}, None),
        (lambda: seq.leading_gaps("a"), {"a": "--A-"}, 2),
        (lambda: seq.trailing_gaps("a"), {"a": "----"}, 4),
        (lambda: seq.masked_share("a", F.lit(2), F.lit(3)), {"a": "AcGT"}, 0.5),
        (lambda: seq.masked_share("a", F.lit(None), F.lit(None)), {"a": "AcGT"}, 0.25),
        (lambda: seq.thread_back("a", "b"), {"a": "M-K", "b": "ATG-AAA"}, "ATG---AAA"),
        (lambda: seq.percent(F.lit(1), F.lit(3)), {}, 33.33),
        (lambda: seq.is_nucleotide("a"), {"a": "acNN"}, True),
        (lambda: seq.is_nucleotide("a"), {"a": "acMKL"}, False),
    ],
)
def test_scalar(spark, column, row, want):
    got = value(spark, column(), **row)
    assert got == pytest.approx(want) if isinstance(want, float) else got == want


def test_structs(spark):
    assert tuple(value(spark, seq.split_pair("s", F.lit(2)), s="ACGTT")) == ("AC", "GTT")
    assert tuple(value(spark, seq.locate_ungapped("f", "c"), f="-AC-GTT-A", c="CG")) == (2, 3, 4)
    assert value(spark, seq.locate_ungapped("f", "c"), f="ACGT", c="TTT") is None
    assert tuple(value(spark, seq.genotype("g"), g="0|1")) == ("0", "1", "1")
    assert tuple(value(spark, seq.genotype("g"), g="./1")) == (".", "1", "-")
    assert tuple(value(spark, seq.header_fields("h", r"\.", ["chrom", "start", "end"], last=True), h="a.b.LG1.5.9")) == ("LG1", "5", "9")


def test_reverse_complement_is_its_own_inverse(spark):
    rows = spark.createDataFrame([("ACGTNNA",), ("",), ("T",)], "s string")
    assert rows.where(seq.reverse_complement(seq.reverse_complement("s")) != F.col("s")).count() == 0


def test_ambiguity_is_resolved_alike_in_a_read(spark):
    got = value(spark, seq.resolve_ambiguity("s", F.lit("read1")), s="RRAYNxRn")
    assert len(got) == 8 and set(got) <= set("ACGT") and got[0] == got[1] == got[6] and got[0] in "AG"


def test_kmers_number_repeats(spark):
    rows = seq.kmers(spark.createDataFrame([("x", "AAAA"), ("y", "A")], "id string, s string"), "s", 2, "id").collect()
    assert sorted((r.id, r.kmer, r.occ) for r in rows) == [("x", "AA", 1), ("x", "AA", 2), ("x", "AA", 3)]


def test_sizes_and_durations():
    assert seq.parse_size("1G") == 1 << 30 and seq.parse_size("200") == 200 << 20
    assert (seq.duration(59), seq.duration(61), seq.duration(3661)) == ("59s", "1m 1s", "1h 1m 1s")


def test_sizes_of_a_column(spark):
    texts = ["1G", "200", "0.5K", "3tb", " 7m ", "x", "", None, "-1G", ".5M"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(seq.size_bytes("t")).collect()]
    assert got == [1 << 30, 200 << 20, 512, 3 << 40, 7 << 20, None, None, None, None, 1 << 19]
