"""Masks of low complexity against plain loops over windows."""

import math
import random
from collections import Counter

from weftline.functions import complexity
from weftline.operators import orthologs


def lower(s, spans):
    low = {i for a, b in spans for i in range(a, b)}
    return "".join(c.lower() if i in low else c for i, c in enumerate(s))


def plain_entropy(s, w=12, trigger=2.2, extend=2.5):
    bits = [-sum(n / w * math.log2(n / w) for n in Counter(s[i : i + w].upper()).values()) for i in range(len(s) - w + 1)]
    spans, i = [], 0
    while i < len(bits):
        j = i
        while j < len(bits) and bits[j] <= extend + 1e-12:
            j += 1
        if any(b <= trigger + 1e-12 for b in bits[i:j]):
            spans.append((i, j - 1 + w))
        i = max(j, i + 1)
    return lower(s, spans)


def plain_triplets(s, window, most):
    if len(s) < 3:
        return s
    w = min(window, len(s))
    spans = []
    for i in range(len(s) - w + 1):
        score = sum(n * (n - 1) // 2 for n in Counter(s[i : i + w].upper()[k : k + 3] for k in range(w - 2)).values())
        if score > most * max(1, w - 3):
            spans.append((i, i + w))
    return lower(s, spans)


def strings(rng, letters, n):
    out = ["", "A", "AAA", "A" * 11, "A" * 12, "A" * 40]
    for _ in range(n):
        s = "".join(rng.choices(letters, k=rng.randrange(0, 90)))
        at = rng.randrange(len(s) + 1)
        out.append(s[:at] + rng.choice(["A", "Q", "AC", "QN", "ACG"]) * rng.randrange(12) + s[at:])
    return out


def test_masks(monkeypatch):
    rng = random.Random(1)
    for block in (50, 1 << 16):
        monkeypatch.setattr(complexity, "_BLOCK", block)
        some = strings(rng, "ACDEFGHIKLMNPQRSTVWYé", 150)
        assert complexity.low_entropy(some) == [plain_entropy(s) for s in some]
        some = strings(rng, "ACGTNacgt", 150)
        for window, most in ((32, 2.0), (20, 0.5)):
            assert complexity.repeated_triplets(some, window, most) == [plain_triplets(s, window, most) for s in some]


def test_columns(spark):
    rows = spark.createDataFrame([(1, "MKVLAAGICW" + "Q" * 20 + "MKVLAAGICW"), (2, None), (3, "")], "n int, seq string")
    got = {r.n: r.seq for r in orthologs.mask_proteins(rows).collect()}
    assert got[2] is None and got[3] == "" and got[1].count("q") == 20 and got[1].startswith("MKV") and got[1].endswith("ICW")
