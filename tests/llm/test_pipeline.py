"""The pipeline against a plain version in Python over a small table."""

import hashlib
import random
import re

import pytest

import corpus_pipeline
from weftline.llm import bpe, mixing

ASSIGN = re.compile(r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def documents():
    rng = random.Random(12)
    vocabulary = ["".join(rng.choices(["th", "er", "in", "on", "an", "re", "ed", "at"], k=rng.randrange(1, 5))) for _ in range(500)]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    rows = [[i, text(rng.randrange(40, 200)), "en", f"s{i % 4}", 0] for i in range(150)]
    rows += [[200 + i, rows[i][1], "en", "s0", 0] for i in range(0, 40, 2)]  # exact copies
    rows += [[300 + i, rows[i][1] + " and", "en", "s1", 0] for i in range(3)]
    rows += [[400 + i, "too short", "en", "s0", 0] for i in range(5)]
    rows += [[450 + i, "one two three four five six seven eight nine " * 9, "en", "s2", 0] for i in range(3)]
    rows += [[500, text(50) + " password=hunter2hunter2 " + text(20), "en", "s3", 0], [501, None, None, None, None], [502, "", "en", None, 0]]
    rows.append(rows[7])
    return [tuple(r) for r in rows]


def plain(rows, kept_by_quality):
    """Rows and copies of the plain version: documents that quality keeps, one of each component of near copies (five-word
    shingles, a similarity of 0.8 or more, as the job has it for stages), redacted, mixed."""
    rows = [r for r in rows if r[0] in kept_by_quality]
    words = [r[1].lower().split() for r in rows]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in words]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    best = {}
    for i, r in enumerate(rows):
        best[find(i)] = min(best.get(find(i), r[0]), r[0])
    left = {r[0]: r for r in rows if r[0] in best.values()}
    out = {}
    for k, r in left.items():
        out[k] = (ASSIGN.sub(lambda m: "[SECRET]" if len(m[1]) >= 6 else m[0], r[1]), r[3])
    sizes = {}
    for t, s in out.values():
        sizes[s] = sizes.get(s, 0) + len(t.split())
    names = sorted(sizes)
    weight, target, open_, total = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}, {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        share = {s: total * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] >= 2 * sizes[s]}
        for s in full or open_:
            target[s] = 2.0 * sizes[s] if full else share[s]
        total -= sum(target[s] for s in full)
        open_ -= full or open_
    copies = {}
    for k, (t, s) in out.items():
        rate = target[s] / sizes[s]
        draw = int(hashlib.md5(f"{mixing.SEED}|{k}|{s}|{hashlib.md5(t.encode()).hexdigest()}".encode()).hexdigest()[:13], 16) / 2**52
        copies[k] = int(rate) + (draw < rate - int(rate))
    return {k: (t, copies[k]) for k, (t, _) in out.items() if copies[k]}


def test_equal_to_the_plain_version(spark, tmp_path):
    rows = documents()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    kept = {r.doc_id for r in corpus_pipeline.STAGES[0][1](spark, spark.read.parquet(str(tmp_path / "documents.parquet")), "").collect()}
    assert {r[0] for r in rows if r[0] < 400 and r[0] is not None} - kept == set()
    assert not kept & ({400, 401, 402, 403, 404, 450, 451, 452, 501, 502})
    want = plain(rows, kept)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    vocab = bpe.vocabulary(bpe.default_path())
    seen = {}
    for r in got:
        text = want[r.doc_id][0]
        assert r.text == text
        assert bytes(r.ids) == vocab.encode([text])[0] and r.n_tokens == len(r.ids) // 4
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {k: n for k, (_, n) in want.items()}


#: Names that the stages use for columns of their own.
INNER = "_mix_size _mix_source _mix_source_size _mix_target _mix_copies _mix_copy _q_by _qby _q_group _q_class _qn_words _q_kept _s_base _s_more _s_edges _s_spans _secret_spans _sh_a _sh_b node bands shingles fingerprint component spans kept n_symbols _wl_tid _wl_spans".split()


@pytest.mark.parametrize("k", range(5))
def test_stages_keep_columns_of_any_name(spark, k):
    name, stage = corpus_pipeline.STAGES[k]
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, text if i % 3 else f"{text} {i} password=hunter2hunter2", "en", f"s{i % 2}", i, *[f"{c}{i}" for c in INNER]) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in INNER))
    out = stage(spark, docs, "")
    assert out.columns[: len(docs.columns)] == docs.columns
    found = out.collect()
    assert found
    for r in found:
        assert [r[c] for c in INNER] == [f"{c}{r.doc_id}" for c in INNER]
        if name != "secret_scan":
            assert r.text == rows[r.doc_id][1]


@pytest.mark.parametrize("k", range(5))
def test_stages_take_empty_tables_and_extra_columns(spark, k):
    name, stage = corpus_pipeline.STAGES[k]
    schema = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, ids string, spans string, kept string, _q_by string"
    docs = spark.createDataFrame([], schema)
    assert stage(spark, docs, "").count() == 0
    rows = [(1, "w x y z " * 30, None, None, None, "f", "i", "s", "k", "q"), (None, None, None, None, None, None, None, None, None, None)]
    out = stage(spark, spark.createDataFrame(rows, schema), "")
    assert out.count() >= 0
    if k + 1 < len(corpus_pipeline.STAGES):
        assert out.columns == docs.columns


def test_stages_take_very_long_texts(spark):
    rng_ = random.Random(3)
    long = " ".join(f"w{rng_.randrange(100000)}" for _ in range(650_000))  # over the slice of 4 MB
    words = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, long, "en", "a", 1), (2, long, "en", "a", 1), (3, "xY1" * 100_000, "en", "b", 1), (4, words, "en", "b", 1)], "doc_id long, text string, lang string, source string, n_chars long").repartition(2)
    counts = [stage(spark, docs, "").select("doc_id").collect() for _, stage in corpus_pipeline.STAGES]
    kept = [sorted({r.doc_id for r in c}) for c in counts]
    assert 3 not in kept[0] and {1, 2} <= set(kept[0])  # one word alone fails the base rules
    assert kept[1] == [1, 3, 4] and kept[2] == kept[4] == [1, 2, 3, 4] and set(kept[3]) <= {1, 2, 3, 4}


def test_tables_on_the_way_are_dropped(spark, tmp_path):
    """After a run one stored table is left: the input of the last stage."""
    from weftline.llm.common import written

    rows = [(i, f"the words of document number {i} are " + " ".join(f"w{(i * 7 + k) % 90}" for k in range(60)), "en", f"s{i % 3}", 0) for i in range(120)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    before = written()
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert len(written() - before) == 1 and out.count() > 0
