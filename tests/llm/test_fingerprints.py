"""Fingerprints against plain ones made with the XXH64 library."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from weftline.llm import fingerprints


def kept(text):
    words = [xxhash.xxh64_intdigest(w.encode(), 42) for w in re.split(r"[\x20\x09-\x0D]+", text) if w]

    def chained(hashes):
        value = 42
        for h in hashes:
            value = xxhash.xxh64_intdigest(h.to_bytes(8, "little"), value)
        return value

    runs = [words[i : i + 5] for i in range(len(words) - 4)] or ([words] if words else [])
    return sorted({s for s in map(chained, runs) if s < 1 << 61})


def printed(text):
    return "".join(f"{s:016x}" for s in kept(text)) or "=" + hashlib.md5(text.encode()).hexdigest()


def near(a, b):
    x, y = set(kept(a)), set(kept(b))
    return len(x & y) / min(len(x), len(y)) if x and y else float(printed(a) == printed(b))


def plain(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5(r[1].encode()).hexdigest()))
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        yield (i, len(t), hashlib.sha256(edited.encode()).hexdigest(), printed(t), printed(edited), near(t, edited), near(t, after))


def texts(n=150, seed=8):
    rng = random.Random(seed)
    words = ["".join(rng.choices(["th", "er", "Ä", "on", "😀", "re"], k=rng.randrange(1, 5))) for _ in range(400)]
    out = [rng.choice([" ", "\n", " \t "]).join(rng.choices(words, k=rng.choice([1, 3, 6, 40, 200]))) for _ in range(n)]
    return [*out, None, "", " \n", out[3], out[3] + " x", "word " * 5000]


def documents():
    some = texts()
    rows = [(7 * i - 50, t) for i, t in enumerate(some)]
    return rows, [*rows, (None, "no id"), (None, "nor here"), (-50, "another of one id"), *[rows[9]] * 5, (1 << 62, "far"), (-(1 << 63), "farthest")]


def write(spark, path, rows, extra="note string, guest int"):
    spark.createDataFrame([(i, t, "x", 1) for i, t in rows], f"doc_id long, text string, {extra}").repartition(4).write.parquet(f"{path}/documents.parquet")
    return str(path)


def same(got, want):
    assert sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize("repeated", [False, True])
def test_query_against_plain_version(spark, tmp_path, repeated, monkeypatch):
    rows = documents()[repeated]
    folder = write(spark, tmp_path, rows, "bucket string, kept int")
    same([tuple(r) for r in fingerprints.op13_fingerprints(spark, folder).collect()], plain(rows))
    bounded = fingerprints.with_next
    monkeypatch.setattr(fingerprints, "with_next", lambda docs: bounded(docs, bucket=7))  # many buckets
    same([tuple(r) for r in fingerprints.op13_fingerprints(spark, folder).collect()], plain(rows))


@pytest.mark.parametrize("rows", [[], [(5, "only one document here and no other")], [(1, ""), (2, None)]])
def test_tables_of_few_rows(spark, tmp_path, rows):
    same([tuple(r) for r in fingerprints.op13_fingerprints(spark, write(spark, tmp_path, rows)).collect()], plain(rows))


def test_many_equal_rows(spark, tmp_path):
    rows = [(4, "a b c d e f g h i j k l")] * 300 + [(3, "the others"), (5, "first")]
    same([tuple(r) for r in fingerprints.op13_fingerprints(spark, write(spark, tmp_path, rows)).collect()], plain(rows))


def test_containment_of_unequal_texts_and_merging(spark):
    rng = random.Random(2)
    long_ = [f"w{rng.randrange(10**6)}" for _ in range(40_000)]
    part = long_[9_000:13_000] + [f"v{k}" for k in range(4_000)]
    frame = spark.createDataFrame([(" ".join(long_), " ".join(part), " ".join(long_[:20_000]), " ".join(long_[20_000:]))], "a string, b string, c string, d string")
    frame = frame.select(*[fingerprints.word_hashes(F.col(c)).alias(c) for c in frame.columns])
    frame = frame.select(*[fingerprints.sketch(c).alias(c) for c in frame.columns])
    share, a, both = frame.select(fingerprints.contained(F.col("a"), F.col("b")), "a", fingerprints.merged(F.col("c"), F.col("d"))).first()
    assert abs(share - 0.5) < 0.06
    assert set(both) <= set(a) and len(a) - len(both) <= 4 and abs(len(a) / 40_000 - 1 / 8) < 0.01
