import random
from itertools import combinations

import numpy as np
import xxhash

from pyspark.sql import functions as F

from weftline.llm import simhash


def brute_fingerprint(text):
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = [w for w in raw.replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\x0b", b" ").replace(b"\x0c", b" ").replace(b"\r", b" ").split(b" ") if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


TEXTS = [None, "", " \n", "One", "one two", "ONE Two thrée É", "a b c d e f " * 9, "é\x1cx \xa0 y z w", "w " * 70000]


def test_fingerprints_match_brute_force(monkeypatch):
    rng = random.Random(4)
    texts = TEXTS + [" ".join(rng.choice("abcdef") for _ in range(rng.randrange(40))) for _ in range(60)]
    want = [brute_fingerprint(t) for t in texts]
    assert simhash.fingerprints(texts).tolist() == want
    monkeypatch.setattr(simhash, "_BLOCK", 17)
    assert simhash.fingerprints(texts[:8] + texts[9:]).tolist() == want[:8] + want[9:]


def graph(fps):
    """Smallest index that each fingerprint reaches over links of two bits."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(fps)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= 2:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(fps))]


def test_components_match_brute_force(spark):
    rng = random.Random(9)
    fps = [0, (1 << 64) - 1]
    for _ in range(25):
        x = rng.getrandbits(64)
        for _ in range(12):
            fps.append(x)
            x ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64)) * rng.randrange(2)
    fps += fps[:40]
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    marked = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fingerprint long")
    got = marked.join(simhash.near_duplicates(marked), F.col("fingerprint") == F.col("_fp")).collect()
    want = graph(fps)
    assert len(got) == len(fps)
    assert all(r.component_id == want[r.doc_id] for r in got)


def test_stage_keeps_one_of_each(spark):
    base = " ".join(f"w{i}" for i in range(400))
    data = [(5, base, "a"), (3, base, "b"), (3, base, "b"), (None, None, None), (None, None, None), (7, "x y z", "c"), (8, "q", "c"), (8, "other words here now", "d")]
    docs = spark.createDataFrame(data, "doc_id long, text string, fp string")
    got = simhash.stage(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted((r.doc_id for r in got.collect()), key=str) == [3, 7, 8, 8, None]
    assert simhash.stage(spark, docs.limit(0), "").collect() == []


def five_word_components(texts):
    """Smallest index that each text reaches over pairs of five-word shingle sets with a Jaccard similarity of 0.8."""
    words = [t.lower().split() for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in words]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(texts))]


def test_stage_removes_edited_copies(spark):
    rng = random.Random(3)
    texts = []
    for _ in range(12):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(60, 300))]
        texts.append(" ".join(words))
        for edits in (1, 1, 2, 4, 8):
            for _ in range(edits):
                words[rng.randrange(len(words))] = f"x{rng.randrange(3000)}"
            texts.append(" ".join(words))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id for r in simhash.stage(spark, docs, "").collect()} == set(five_word_components(texts))


def test_sets_are_joined_as_by_brute_force():
    rng = random.Random(8)
    for n in (2, 3, 40):
        base = [rng.randrange(400) for _ in range(60)]
        sets = []
        for _ in range(n):
            some = [x if rng.random() > 0.08 else rng.randrange(400, 9000) for x in base]
            sets.append(np.unique(np.array(some, dtype=np.uint32)))
        root = list(range(n))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for i, j in combinations(range(n), 2):
            a, b = set(sets[i].tolist()), set(sets[j].tolist())
            if 5 * len(a & b) >= 4 * len(a | b):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        assert simhash.joined(sets, (4, 5)).tolist() == [find(i) for i in range(n)]


def test_large_buckets_are_dealt_in_parts(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PART", 4)
    rng = random.Random(11)
    texts = []
    for _ in range(4):
        words = [f"w{rng.randrange(3000)}" for _ in range(150)]
        for _ in range(30):
            copy = list(words)
            for _ in range(rng.randrange(1, 6)):
                copy[rng.randrange(150)] = f"x{rng.randrange(3000)}"
            texts.append(" ".join(copy))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id for r in simhash.stage(spark, docs, "").collect()} == set(five_word_components(texts))


def test_wide_fingerprints_are_majorities_of_bits():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (1, 2, 9, 254, 255, 256, 1300)]
    got = simhash.wide_fingerprints(sets, 3)
    for s, row in zip(sets, got.tolist()):
        for w, word in enumerate(row):
            step = (w + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
            mixed = [int(x) for x in simhash.mix(s + np.uint64(step))]
            assert word == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in mixed) > len(s))


def test_fingerprints_are_grouped_as_by_brute_force(monkeypatch):
    rng = random.Random(6)
    fps = [rng.getrandbits(128) for _ in range(20)]
    for _ in range(90):
        x = rng.choice(fps)
        for b in rng.sample(range(128), rng.choice([3, 9, 10, 11, 12])):
            x ^= 1 << b
        fps.append(x)
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(fps)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= 10:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    want = [find(i) for i in range(len(fps))]
    assert len(set(want)) < len(fps) - 30
    words = [np.array([f >> s & (1 << 64) - 1 for f in fps], dtype=np.uint64) for s in (0, 64)]
    for pairs in (1, 700, 1 << 17):
        monkeypatch.setattr(simhash, "_PAIRS", pairs)
        assert simhash.grouped(words, 10).tolist() == want


def test_candidates_of_the_stage_share_a_cell_of_bit_counts(spark, monkeypatch):
    """Rows of a bucket hang together by bits, and those near each other in one cell of counts share a bucket."""
    rng = random.Random(7)
    fps = []
    for _ in range(12):
        base = [rng.getrandbits(64) for _ in range(7)]
        for _ in range(5):
            fps.append([x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for x in base])
    fps.append(list(fps[0]))  # equal fingerprints, another text
    signed = [np.array(f, dtype=np.uint64).view(np.int64).tolist() for f in fps]
    nodes = spark.createDataFrame([(i, f, 100) for i, f in enumerate(signed)], "node long, fps array<long>, bytes int")

    def cells(f):
        counts = [(x >> 2 * s & 1) + (x >> 2 * s + 1 & 1) for x in f for s in range(30)]
        return {(g, tuple(counts[5 * g : 5 * g + 5])) for g in range(42)}

    distance = lambda f, g: sum(bin(x ^ y).count("1") for x, y in zip(f[:2], g[:2]))
    want = {(i, j) for i, j in combinations(range(len(fps)), 2) if distance(fps[i], fps[j]) <= 36 and cells(fps[i]) & cells(fps[j])}
    for part in (simhash.CELL_PART, 2):
        monkeypatch.setattr(simhash, "CELL_PART", part)
        buckets = {}
        for r in simhash.buckets_of(nodes, 5).collect():
            buckets.setdefault(r.bucket, []).append(r.node)
        got = {p for b in buckets.values() for p in combinations(sorted(set(b)), 2)}
        assert want <= got and all(i % 60 // 5 == j % 60 // 5 for i, j in got)


def test_the_stage_finds_pairs_at_the_threshold(spark):
    """Pairs of texts whose five-word shingles have the similarity 0.8 to 0.82; fingerprints of 64 bits differ in ten."""
    rng = random.Random(13)
    rows = []
    for i in range(300):
        words = [f"w{rng.randrange(100000)}" for _ in range(139)]  # 135 shingles, of which three edits apart take 15
        edited = list(words)
        for at in (20, 60, 100):
            edited[at] = "x"
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(edited))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.doc_id for r in simhash.stage(spark, docs, "").orderBy("doc_id").collect()] == list(range(0, 600, 2))
