import hashlib
import random
from collections import Counter
from dataclasses import replace

import pytest

from weftline.llm import anchors, substring, suffixes

UNITS = {"bytes": (anchors.BYTE_UNIT, suffixes.by_suffix_arrays, suffixes.keep_bytes), "words": (anchors.WORD_UNIT, substring.doubling, substring.keep_words)}


def brute(texts, kind, window):
    """Kept bytes, symbols, removed and spans of each text, by counting all windows."""
    split = [(t or "").encode() if kind == "bytes" else (t or "").encode().split() for t in texts]
    seen = Counter(s[i : i + window] if kind == "bytes" else tuple(s[i : i + window]) for s in split for i in range(len(s) - window + 1))
    out = []
    for s in split:
        gone = [False] * len(s)
        for i in range(len(s) - window + 1):
            if seen[s[i : i + window] if kind == "bytes" else tuple(s[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = [x for x, g in zip(s, gone) if not g]
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(s), sum(gone), spans, bytes(kept) if kind == "bytes" else b" ".join(kept)))
    return out


def corpus(seed, n, words):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    passages = [" ".join(rng.choices(vocabulary, k=rng.randrange(20, 90))) for _ in range(6)]
    texts = [None, "", " ", "é😀 " * 300, "é😀 " * 300, "a" * 900, "x\x1c y\xa0z"]
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            p = rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choices(vocabulary, k=rng.randrange(5, 120)))
            parts.append(p[rng.randrange(30) :] if rng.random() < 0.3 else p)
        texts.append(rng.choice(["  ", "\n", " "]).join(parts))
    return texts + texts[9:14]


def run(spark, texts, kind, window, k, most=anchors.MOST, partitions=3):
    unit, engine, keep = UNITS[kind]
    unit = replace(unit, window=window, k=k)
    docs = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "doc_id long, text string, spans string").repartition(partitions)
    got = {r.doc_id: r for r in anchors.strike_out(docs, unit, engine, keep, most=most).collect()}
    return [(r.n_symbols, sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in (got[i] for i in range(len(texts)))]


@pytest.mark.parametrize("kind,window,k", [("words", 35, 9), ("bytes", 400, 64), ("bytes", 60, 12), ("words", 7, 2)])
def test_equal_to_brute_force(spark, kind, window, k):
    texts = corpus(window, 60, 500 if window > 30 else 12)
    assert run(spark, texts, kind, window, k) == brute(texts, kind, window)


@pytest.mark.parametrize("kind,window,k", [("words", 35, 9), ("bytes", 120, 12)])
def test_large_groups_are_anchored_anew(spark, kind, window, k):
    rng = random.Random(2)
    line = " ".join(f"line{i}" for i in range(20 if kind == "words" else 8))
    tail = " ".join(f"tail{i}" for i in range(40))
    texts = corpus(3, 20, 300)
    texts += [" ".join(str(rng.random()) for _ in range(9)) + " " + line + " " + (tail if i % 4 == 0 else " ".join(str(rng.random()) for _ in range(30))) for i in range(60)]
    assert run(spark, texts, kind, window, k, most=5) == brute(texts, kind, window)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substring.dedup(docs).collect() == []
    assert suffixes.dedup(docs).collect() == []


def test_suffix_arrays_match_sorting():
    rng = random.Random(1)
    for _ in range(1500):
        text = [rng.randrange(1, rng.choice([2, 3, 9])) for _ in range(rng.randrange(40))] + [0]
        sa = suffixes.suffix_array(text)
        assert sa == sorted(range(len(text)), key=lambda i: text[i:])
        for at, n in enumerate(suffixes.common_prefixes(text, sa)):
            if at:
                a, b = text[sa[at - 1] :], text[sa[at] :]
                assert a[:n] == b[:n] and a[n : n + 1] != b[n : n + 1]


def test_anchors_are_the_leftmost_minima(monkeypatch):
    import numpy as np

    monkeypatch.setattr(anchors, "BLOCK", 50)
    rng = np.random.default_rng(1)
    h = anchors.mix(rng.integers(0, 9, 400, dtype=np.uint64))
    for w in (1, 2, 7, 64):
        assert anchors.leftmost_minima(h, w).tolist() == [i + int(np.argmin(h[i : i + w])) for i in range(len(h) - w + 1)]


def test_op_digests(spark, tmp_path):
    texts = corpus(8, 30, 300)
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for op, kind, window in ((suffixes.op1_suffixes, "bytes", 400), (substring.op5_substring, "words", 35)):
        want = brute(texts, kind, window)
        for r in op(spark, str(tmp_path)).collect():
            size = r.n_bytes if kind == "bytes" else r.n_words
            assert (size, r.n_removed, r.n_spans, r.kept_sha256) == (*want[r.doc_id][:3], hashlib.sha256(want[r.doc_id][3]).hexdigest())
