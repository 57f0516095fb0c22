"""Distances of pairs by bits and by blocks of rows, against plain loops."""

import random
from itertools import combinations

from pyspark.sql import functions as F

from weftline.functions import seq
from weftline.operators import alignment


def rows_of(rng, n, length, letters="ACGTN-acX"):
    base = [rng.choice("ACGT") for _ in range(length)]
    return [(f"t{i:03d}", "".join(rng.choice(letters) if rng.random() < rng.choice([0.1, 0.6]) else c for c in base)) for i in range(n)]


def plain(a, b, letters):
    both = [(x, y) for x, y in zip(a, b) if x in letters and y in letters]
    return sum(x != y for x, y in both) / len(both) if both else None


def half_up(x):
    from decimal import ROUND_HALF_UP, Decimal

    return float(Decimal(repr(x)).quantize(Decimal("0.001"), ROUND_HALF_UP))


def test_bits_of_strings_of_any_length(spark):
    rng = random.Random(1)
    data = [("", "A"), ("A" * 64, "A" * 63 + "C"), ("A" * 65, "C" * 65), ("é😀A", "éxA"), ("a-N", "a-N")] + [("".join(rng.choices("ACGTN-?*qZ", k=n)), "".join(rng.choices("ACGTN-?*qZ", k=rng.choice([n, n + 3])))) for n in (1, 63, 64, 127, 128, 300)]
    frame = spark.createDataFrame(data, "a string, b string").select("a", "b", seq.p_distance("a", "b").alias("p"), seq.nucleotide_distance("a", "b").alias("n"), seq.comparable_mismatches("a", "b").alias("m"))
    for r in frame.collect():
        p = plain(r.a, r.b, seq.LETTERS)
        assert (r.p, r.n) == (None if p is None else half_up(p), plain(r.a, r.b, "ACGT"))
        assert r.m == sum(x != y for x, y in zip(r.a, r.b) if x in seq.LETTERS + "?*" and y in seq.LETTERS + "?*")


def test_sums_over_blocks(spark):
    rng = random.Random(2)
    data = [(k, t, s) for k, n in (("a", 60), ("b", 7), ("c", 1)) for t, s in rows_of(rng, n, 90)]
    data += [("b", None, "ACGT"), ("b", "null", None), ("b", "t001", "ACGT" * 10), (None, "x", "ACGT"), (None, "y", "ACGA"), ("gaps", "x", "--"), ("gaps", "y", "AC")]
    frame = spark.createDataFrame(data, "locus string, taxon string, seq string")
    want = {}
    for k in ("a", "b", None, "gaps"):
        rows = [(t, s) for q, t, s in data if q == k and t is not None and s is not None]
        ds = [plain(s, u, "ACGT") for (t, s), (v, u) in combinations(rows, 2) if t != v]
        ds = [d for d in ds if d is not None]
        want[k] = sum(ds) / len(ds) if ds else None
    for block in (5, 256):
        sums = alignment.pair_sums(frame, ["locus"], block=block).groupBy("locus").agg((F.sum("total") / F.nullif(F.sum("n"), F.lit(0))).alias("m"))
        got = {r.locus: r.m for r in sums.collect()}
        for k, m in want.items():
            assert (got[k] is None) == (m is None) and (m is None or abs(got[k] - m) < 1e-12)
    pairs = {(r.a, r.b): r.d for r in alignment.pairwise(frame.where("locus = 'a'")).collect()}
    assert len(pairs) == 60 * 59 // 2
    by = {t: s for k, t, s in data if k == "a"}
    assert all(pairs[a, b] == plain(by[a], by[b], "ACGT") for a, b in combinations(sorted(by), 2))


def test_deviant_rows_over_blocks(spark, monkeypatch):
    rng = random.Random(3)
    data = [("l", t, s) for t, s in rows_of(rng, 40, 60)] + [("m", t, s) for t, s in rows_of(rng, 12, 60)]
    frame = spark.createDataFrame(data, "locus string, taxon string, seq string")
    want = []
    for locus in "lm":
        by = {t: s for q, t, s in data if q == locus}
        d = {(a, b): half_up(x) for a, b in combinations(sorted(by), 2) if (x := plain(by[a], by[b], seq.LETTERS)) is not None}
        mean = {t: (lambda v: sum(v) / len(v))([x for p, x in d.items() if t in p]) for t in by}
        gone = set()
        for (a, b), _ in sorted(((p, x) for p, x in d.items() if x > 0.4), key=lambda e: (-e[1], e[0])):
            if a not in gone and b not in gone:
                gone.add(max((round(mean[a], 9), a), (round(mean[b], 9), b))[1])
        want += [(locus, t) for t in by if t not in gone]
    assert 10 < len(want) < 52
    sums = alignment.pair_sums
    for block in (7, 256):
        monkeypatch.setattr(alignment, "pair_sums", lambda *a, block=block, **k: sums(*a, **{**k, "block": block}))
        assert sorted((r.locus, r.taxon) for r in alignment.drop_deviant(frame).collect()) == sorted(want)
