"""Proteins against nucleotides: the batched programme against a plain one, and planted gaps and shifts."""

import random

import numpy as np

from weftline.functions import codons
from weftline.functions.seq import CODONS
from weftline.operators import alignment

C = codons.Costs()
LOW = -(10**9)


def plain(protein, dna):
    """Score of the best alignment and the cell that it ends in, all cells."""
    table = C.scores()
    aa = codons.codon_residues(dna)
    p = codons.residues(protein)
    nd = len(dna)
    h = [[0] * (nd + 1)]
    f = [LOW] * (nd + 1)
    best = 0
    for i in range(1, len(p) + 1):
        f = [max(h[-1][j] - C.gap_open, f[j]) - C.gap_extend for j in range(nd + 1)]
        row = []
        for j in range(nd + 1):
            ways = [0, f[j]]
            if j >= 3:
                ways.append(h[-1][j - 3] + int(table[p[i - 1], aa[j]]))
            ways += [h[-1][j - b] - C.shift for b in (1, 2) if j >= b]
            row.append(max(ways))
        row = [max([row[j], *[row[j - b] - C.shift for b in (1, 2) if j >= b]]) for j in range(nd + 1)]
        e = [LOW] * (nd + 1)
        for j in range(3, nd + 1):
            e[j] = max(row[j - 3] - C.gap_open, e[j - 3]) - C.gap_extend
        h.append([max(a, b) for a, b in zip(row, e)])
        best = max(best, *h[-1])
    return best


def coding(rng, protein):
    by = {}
    for codon, a in CODONS.items():
        by.setdefault(a, []).append(codon)
    return "".join(rng.choice(by[a]) for a in protein)


def drawn(rng, n):
    return "".join(rng.choices("ACDEFGHIKLMNPQRSTVWY", k=n))


def test_batch_against_plain_programme():
    rng = random.Random(3)
    pairs = []
    for _ in range(60):
        protein = drawn(rng, rng.randrange(1, 25))
        dna = coding(rng, protein)
        for _ in range(rng.randrange(3)):
            at, n = rng.randrange(len(dna)), rng.randrange(1, 5)
            dna = dna[:at] + ("".join(rng.choices("ACGTN", k=n)) + dna[at:] if rng.random() < 0.5 else dna[at + n :])
        pairs.append((protein.replace("A", rng.choice("AX*")), "".join(rng.choices("ACGT", k=rng.randrange(4))) + dna))
    pairs += [("M", "A"), ("MK", ""), ("", "ATG"), ("MKMK", "TTTTTTTT")]
    got = codons.best_local_batched([p for p, _ in pairs], [d for _, d in pairs])
    assert got[:, 0].tolist() == [plain(*x) for x in pairs]
    for (p, d), (score, i0, i1, j0, j1, positive, columns, shifts) in zip(pairs, got.tolist(), strict=True):
        assert 0 <= i0 <= i1 <= len(p) and 0 <= j0 <= j1 <= len(d) and positive <= columns
        assert score == 0 or plain(p[i0:i1], d[j0:j1]) == score
        assert score == 0 or shifts or (j1 - j0) % 3 == 0


def test_planted_gaps_and_shifts_are_placed():
    rng = random.Random(8)
    for _ in range(30):
        protein = drawn(rng, 60)
        dna = coding(rng, protein)
        more = dna[:90] + coding(rng, drawn(rng, 4)) + dna[90:]
        less = dna[:81] + dna[93:]
        pushed, pulled = dna[:90] + "G" + dna[90:], dna[:90] + dna[91:]
        got = codons.best_local_batched([protein] * 4, ["CC" + x + "C" for x in (more, less, pushed, pulled)])
        assert np.all(got[:, 1] == 0) and np.all(got[:, 2] == 60) and np.all(got[:, 3] == 2)
        assert got[:, 4].tolist() == [2 + len(x) for x in (more, less, pushed, pulled)]
        assert got[:, 0].tolist()[:3] == [300 - 8 - 4 * 2, 280 - 8 - 4 * 2, 300 - 14] and got[3, 0] >= 295 - 14
        assert got[:, 7].tolist() == [0, 0, 1, 1] and got[:, 6].tolist()[:3] == [64, 60, 60]


def test_strands_nulls_and_own_table(spark):
    rng = random.Random(4)
    protein = drawn(rng, 40)
    dna = coding(rng, protein)
    turned = dna[::-1].translate(str.maketrans("ACGT", "TGCA"))
    rows = spark.createDataFrame([("a", "c", "A" + dna, protein), ("b", "c", turned, protein), ("n", "c", None, protein), ("e", "c", dna, ""), ("s", "c", "AC", protein)], "locus string, contig string, seq string, protein string")
    got = {r.locus: r for r in alignment.align_proteins(rows).collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"].strand, got["a"].sts, got["a"].eds, got["a"].sim, got["a"].score) == ("+", 1, 121, 100.0, 200.0)
    assert (got["b"].strand, got["b"].sts, got["b"].eds) == ("-", 0, 120)
    own = codons.Costs(table=(("K", "R", 4),))
    assert codons.best_local(["KKKK"], ["CGTCGTCGTCGT"], own)[0, 0] == 16
