"""Gapped search against full local alignments, and e-values against random sequences."""

import random

import numpy as np
import pytest

from weftline.functions import banded
from weftline.operators import search

S = search.NUCLEOTIDES
TURN = str.maketrans("ACGT", "TGCA")


def local_score(q, t):
    """Score of the best local alignment with affine gaps, all cells, a row at a time."""
    a, b = banded.letters(q, 1), banded.letters(t, 2)
    steps = S.gap_extend * np.arange(len(b) + 1)
    h, f, best = np.zeros(len(b) + 1), np.full(len(b) + 1, -1e9), 0
    for c in a:
        f = np.maximum(h - S.gap_open, f) - S.gap_extend
        m = np.maximum(f, 0)
        m[1:] = np.maximum(m[1:], h[:-1] + np.where(b == c, S.match, S.mismatch))
        m[1:] = np.maximum(m[1:], np.maximum.accumulate(m + steps)[:-1] - steps[1:] - S.gap_open)
        h = m
        best = max(best, int(h.max()))
    return best


def drawn(rng, n):
    return "".join(rng.choices("ACGT", k=n))


def mutated(rng, s, sites=0.04, gaps=3, most=9):
    s = [rng.choice("ACGT") if rng.random() < sites else c for c in s]
    for _ in range(gaps):
        at, n = rng.randrange(20, len(s) - 20), rng.randrange(1, most)
        s[at : at + n] = [] if rng.random() < 0.5 else [*s[at : at + n], *drawn(rng, n)]
    return "".join(s)


def test_extension_is_the_best_alignment_from_the_start():
    rng = random.Random(1)

    def plain(q, t):
        low = -(10**9)
        h, best = [[low] * (len(t) + 1) for _ in range(len(q) + 1)], 0
        e, f = [row[:] for row in h], [row[:] for row in h]
        h[0][0] = 0
        for i in range(len(q) + 1):
            for j in range(len(t) + 1):
                if j:
                    e[i][j] = max(h[i][j - 1] - S.gap_open, e[i][j - 1]) - S.gap_extend
                if i:
                    f[i][j] = max(h[i - 1][j] - S.gap_open, f[i - 1][j]) - S.gap_extend
                if i and j:
                    h[i][j] = h[i - 1][j - 1] + (S.match if q[i - 1] == t[j - 1] else S.mismatch)
                h[i][j] = max(h[i][j], e[i][j], f[i][j])
                best = max(best, h[i][j])
        return best

    pairs = []
    for _ in range(40):
        q = drawn(rng, rng.randrange(0, 60))
        pairs.append((q, mutated(rng, q, 0.1) if len(q) > 45 else drawn(rng, rng.randrange(0, 40))))
    got = banded.extend([banded.letters(q, 1) for q, _ in pairs], [banded.letters(t, 2) for _, t in pairs], 80, S.match, S.mismatch, S.gap_open, S.gap_extend, 10_000)
    assert banded.unpack(got[0])[0].tolist() == [plain(*p) for p in pairs]


@pytest.fixture(scope="module")
def found(spark):
    rng = random.Random(5)
    genome = {f"chr{k}": drawn(rng, 3000 + 40 * k) for k in range(6)}
    queries = {}
    for k in range(24):
        name = f"chr{k % 6}"
        at = rng.randrange(0, len(genome[name]) - 400)
        s = mutated(rng, genome[name][at : at + 300 + k])
        queries[f"q{k}"] = (s[::-1].translate(TURN) if k % 3 == 0 else s, name, at)
    q = spark.createDataFrame([(n, s, "x") for n, (s, *_) in queries.items()] + [("none", None, "x"), ("empty", "", "x"), ("short", "ACG", "x")], "name string, seq string, target string")
    t = spark.createDataFrame([*genome.items(), ("e", ""), ("n", None)], "name string, seq string")
    return genome, queries, search.gapped_search(q, t, most_e=1e-6, piece=512).collect()


def test_planted_gaps_are_found_and_scored_as_by_full_alignment(found):
    genome, queries, hits = found
    assert {h["query"] for h in hits} == set(queries)
    for name, (s, target, at) in queries.items():
        best = max((h for h in hits if h["query"] == name), key=lambda h: h.score)
        turned = s[::-1].translate(TURN)
        assert best.target == target and best.strand == ("-" if int(name[1:]) % 3 == 0 else "+") and at - 20 <= best.tlo <= at + 40
        part = genome[target][max(0, at - 30) : at + 450]
        assert best.score == max(local_score(s, part), local_score(turned, part))


def test_coordinates_score_and_identity_agree(found):
    genome, queries, hits = found
    for h in hits:
        s = queries[h["query"]][0]
        q, t = s[h.qlo - 1 : h.qhi], genome[h.target][h.tlo - 1 : h.thi]
        q = q if h.strand == "+" else q[::-1].translate(TURN)
        assert local_score(q, t) == h.score  # what the ranges hold scores as said
        pairs = h.columns - h.gaps
        matches = round(h.id * h.columns / 100)
        assert len(q) + len(t) == 2 * pairs + h.gaps and matches <= pairs
        assert h.score <= S.match * matches + S.mismatch * (pairs - matches) - S.gap_extend * h.gaps


def test_two_islands_give_two_hits(spark):
    rng = random.Random(9)
    a, b, x, y = (drawn(rng, n) for n in (120, 100, 200, 200))
    q, t = spark.createDataFrame([("q", a + x + b)], "name string, seq string"), spark.createDataFrame([("t", a + y + b)], "name string, seq string")
    hits = sorted((h.qlo, h.qhi) for h in search.gapped_search(q, t, most_e=1e-6).collect())
    assert len(hits) == 2 and abs(hits[0][1] - 120) < 12 and abs(hits[1][0] - 321) < 12


def test_random_hits_are_as_many_as_their_e_values_say(spark):
    rng = random.Random(11)
    q = spark.createDataFrame([(f"q{k}", drawn(rng, 400)) for k in range(200)], "name string, seq string")
    t = spark.createDataFrame([(f"t{k}", drawn(rng, 2000)) for k in range(60)], "name string, seq string")
    hits = [h.evalue for h in search.gapped_search(q, t, k=7, least=1, most_e=0.5, both_strands=False).collect()]
    for e in (0.5, 0.1, 0.02):
        expected, seen = 200 * e, sum(h <= e for h in hits)
        assert expected / 3 - 4 <= seen <= 2 * expected + 4, (e, seen, expected)
    assert not [h for h in hits if h < 1e-5]


def test_repeats_and_thresholds(spark):
    rng = random.Random(13)
    unit = drawn(rng, 60)
    q = spark.createDataFrame([("q", unit)], "name string, seq string")
    t = spark.createDataFrame([("t", "".join(unit + drawn(rng, 30) for _ in range(20))), ("low", unit.lower())], "name string, seq string")
    assert len(search.gapped_search(q, t, most_e=1e-6).where("target = 't'").collect()) == 20
    assert search.gapped_search(q, t, most_places=19).collect() == []
    assert search.gapped_search(q, t).where("target = 'low'").count() == 0
    assert search.gapped_search(q, t, most_e=1e-30).collect() == []
    assert np.isfinite([h.evalue for h in search.gapped_search(q, t, most_e=1e9).collect()]).all()
