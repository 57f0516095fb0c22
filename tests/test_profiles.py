"""Progressive alignment against the star and the true alignment of families that have evolved along a tree."""

import random

import numpy as np

from weftline.functions import profiles
from weftline.operators import alignment


def family(rng, taxa, length, sites, indels):
    """Rows with a true alignment: a column is a place of the ancestor or of an insertion."""
    serial = [0]

    def fresh(n):
        serial[0] += n
        return [((serial[0] - n + k), rng.choice("ACGT")) for k in range(n)]

    def evolve(s):
        s = [(k, rng.choice("ACGT") if rng.random() < sites else c) for k, c in s]
        for _ in range(indels):
            at, n = rng.randrange(len(s)), rng.randrange(1, 7)
            s = s[:at] + fresh(n) + s[at:] if rng.random() < 0.5 else s[:at] + s[at + n :]
        return s

    nodes = [fresh(length)]
    while len(nodes) < taxa:
        s = nodes.pop(0)
        nodes += [evolve(s), evolve(s)]
    return nodes


def pairs(columns):
    """Residue pairs that an alignment sets against each other; a residue is (row, number within the row)."""
    out = set()
    for column in columns:
        out |= {(a, b) for k, a in enumerate(column) for b in column[k + 1 :]}
    return out


def aligned_pairs(rows):
    seen = [0] * len(rows)
    columns = []
    for column in zip(*rows, strict=True):
        here = []
        for k, c in enumerate(column):
            if c != "-":
                here.append((k, seen[k]))
                seen[k] += 1
        columns.append(here)
    return pairs(columns)


def true_pairs(nodes):
    by = {}
    for row, s in enumerate(nodes):
        for n, (k, _) in enumerate(s):
            by.setdefault(k, []).append((row, n))
    return pairs(by.values())


def sum_of_pairs(rows):
    total = 0
    for a in range(len(rows)):
        for b in range(a):
            open_ = None
            for x, y in zip(rows[a], rows[b], strict=True):
                if x == "-" and y == "-":
                    continue
                if x != "-" and y != "-":
                    total += 5 if x == y else -4
                    open_ = None
                else:
                    side = x == "-"
                    total -= 1 if open_ == side else 11
                    open_ = side
    return total


def test_diverged_families_are_aligned_better_than_by_the_star(spark):
    rng = random.Random(2)
    families = {f"l{k}": family(rng, 16, 150, 0.09, 2) for k in range(5)}
    rows = [(name, f"t{i:02d}", "".join(c for _, c in s)) for name, nodes in families.items() for i, s in enumerate(nodes)]
    got = {}
    for r in alignment.align(spark.createDataFrame(rows, "locus string, taxon string, seq string")).collect():
        got.setdefault(r.locus, {})[r.taxon] = r.seq
    sums, shares = [], []
    for name, nodes in families.items():
        tree = [got[name][f"t{i:02d}"] for i in range(len(nodes))]
        plain = ["".join(c for _, c in s) for s in nodes]
        assert [t.replace("-", "") for t in tree] == plain
        star = alignment.star_alignment(plain)
        sums.append((sum_of_pairs(tree), sum_of_pairs(star)))
        true = true_pairs(nodes)
        shares.append([len(aligned_pairs(x) & true) / len(true) for x in (tree, star)])
    assert all(a > b for a, b in sums), sums
    assert np.mean(shares, axis=0)[0] > 0.65 and np.all(np.array(shares)[:, 0] > np.array(shares)[:, 1]), shares


def test_two_blocks_score_as_the_best_alignment_of_their_columns():
    rng = random.Random(6)

    def plain(a, b, scores):
        gap = len(scores)
        sub = lambda x, y: sum(scores[p][q] for p in x for q in y if p < gap and q < gap) / (len(x) * len(y))
        n, m, low = a.shape[1], b.shape[1], -1e9
        h = np.full((n + 1, m + 1), low)
        e, f = h.copy(), h.copy()
        h[0, 0] = 0
        for i in range(n + 1):
            for j in range(m + 1):
                if j:
                    e[i, j] = max(h[i, j - 1] - (profiles.END_OPEN if i in (0, n) else profiles.OPEN), e[i, j - 1]) - profiles.EXTEND
                if i:
                    f[i, j] = max(h[i - 1, j] - (profiles.END_OPEN if j in (0, m) else profiles.OPEN), f[i - 1, j]) - profiles.EXTEND
                if i and j:
                    h[i, j] = h[i - 1, j - 1] + sub(a[:, i - 1], b[:, j - 1])
                h[i, j] = max(h[i, j], e[i, j], f[i, j])
        return h[n, m]

    def value(block, rows, scores):
        gap, x, y = len(scores), block[:rows], block[rows:]
        n, m = (x != gap).any(axis=0).sum(), (y != gap).any(axis=0).sum()
        total, i, j, before = 0.0, 0, 0, None
        for k in range(block.shape[1]):
            up, down = (x[:, k] != gap).any(), (y[:, k] != gap).any()
            if up and down:
                total += sum(scores[p][q] for p in x[:, k] for q in y[:, k] if p < gap and q < gap) / (len(x) * len(y))
                before = None
            else:
                at_end = (j in (0, m)) if up else (i in (0, n))
                total -= profiles.EXTEND + (0 if before == up else profiles.END_OPEN if at_end else profiles.OPEN)
                before = up
            i, j = i + up, j + down
        return total

    for _ in range(25):
        a, b = (np.array([[rng.randrange(4) for _ in range(n)] for _ in range(rng.randrange(1, 4))], dtype=np.int16) for n in (rng.randrange(1, 14), rng.randrange(1, 14)))
        scores = np.where(np.eye(4, dtype=bool), 5.0, -4.0)
        block = profiles.merged(a, b, scores)
        assert abs(value(block, len(a), scores) - plain(a, b, scores)) < 1e-9


def test_awkward_rows(spark):
    rows = [("a", "x", "ACGTACGTAC"), ("a", "y", None), ("a", "z", "ACGTACGTAC"), (None, "x", "ACG"), (None, "y", "A-G"), ("one", "x", "acg"), ("e", "x", ""), ("e", "y", "-")]
    got = {(r.locus, r.taxon): r.seq for r in alignment.align(spark.createDataFrame(rows, "locus string, taxon string, seq string")).collect()}
    assert got == {("a", "x"): "ACGTACGTAC", ("a", "y"): "-" * 10, ("a", "z"): "ACGTACGTAC", (None, "x"): "ACG", (None, "y"): "A-G", ("one", "x"): "ACG", ("e", "x"): "", ("e", "y"): ""}
    protein = alignment.align(spark.createDataFrame([("p", "x", "MKVLAAGICW"), ("p", "y", "MKVAAGICW"), ("p", "z", "MRVLAAGLCW")], "locus string, taxon string, seq string"), protein=True)
    assert sorted(r.seq for r in protein.collect()) == ["MKV-AAGICW", "MKVLAAGICW", "MRVLAAGLCW"]
