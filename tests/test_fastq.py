"""FASTQ by ranges of bytes: every cut gives the same records, and no line is shuffled."""

import gzip
import io
import random

import pytest

from weftline.sources import fastq, readers


def text(n, seed, end="\n"):
    rng = random.Random(seed)
    out, rows = [], []
    for i in range(n):
        k = rng.randrange(1, 40)
        seq, qual = "".join(rng.choices("ACGTN", k=k)), "".join(rng.choices("@+I#", k=k))
        out += [f"@r{i} more/1", seq, "+" + rng.choice(["", f"r{i}"]), qual]
        rows.append((f"r{i}", seq, qual))
    return end.join(out) + end, rows


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_every_cut_gives_the_same_records(end, monkeypatch):
    body, rows = text(40, 1, end)
    raw = body.encode()
    want = [(f"@{i} more/1".encode(), s.encode(), q.encode()) for i, s, q in rows]
    monkeypatch.setattr(fastq, "_READ", 50)  # lines lie across reads from the file
    for size in [1, 2, 3, 7, 50, 333, len(raw) - 1, len(raw), len(raw) + 9]:
        cuts = range(0, len(raw), size)
        got = [r for a in cuts for r in fastq.records(io.BytesIO(raw), a, min(len(raw), a + size), False)]
        assert got == want, size
    assert list(fastq.records(io.BytesIO(raw.rstrip()), 0, len(raw), False)) == want  # no line's end at the end
    assert list(fastq.records(io.BytesIO(raw + b"@cut\nAC\n"), 0, len(raw) + 8, False)) == want
    packed = gzip.compress(raw[:300]) + gzip.compress(raw[300:])
    assert list(fastq.records(io.BytesIO(packed), 0, None, True)) == want
    with pytest.raises(ValueError):
        list(fastq.records(io.BytesIO(b">r\nAC\n+\nII\n"), 0, 11, False))


def test_files_folders_and_plan(spark, tmp_path):
    plain, rows = text(300, 2)
    other, more = text(50, 3)
    (tmp_path / "a_R1.fq").write_text(plain)
    with gzip.open(tmp_path / "a_R2.fastq.gz", "wt") as f:
        f.write(other)
    (tmp_path / "b_R1.fq").write_text("")
    (tmp_path / "notes.md").write_text("no reads")
    (tmp_path / "_SUCCESS.fq").write_text("")
    found = fastq.fastq(spark, str(tmp_path), 500)
    assert found.rdd.getNumPartitions() > 15
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    for path, size in ((str(tmp_path), 500), (f"file://{tmp_path}", 1 << 20)):
        got = sorted((r.file, r.ord, r.read_id, r.seq, r.qual) for r in fastq.numbered(fastq.fastq(spark, path, size)).collect())
        assert got == sorted([("a_R1.fq", k, *r) for k, r in enumerate(rows)] + [("a_R2.fastq.gz", k, *r) for k, r in enumerate(more)])
    plan = fastq.numbered(found)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in plan
    both = [sorted(map(tuple, readers.reads(spark, str(tmp_path / "a_R*"), None).collect())), sorted(map(tuple, readers.reads(spark, str(tmp_path), 700).collect()))]
    assert both[0] == both[1]
    assert fastq.fastq(spark, str(tmp_path / "a_R1.fq")).count() == 300
    (tmp_path / "none").mkdir()
    assert fastq.fastq(spark, str(tmp_path / "none")).count() == 0
