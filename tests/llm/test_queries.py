"""The queries over a small table of awkward rows, against plain versions of their contract's columns."""

import hashlib
import math
import random
import re

import pytest
import tokenizers
import xxhash

from test_hnsw import brute as brute_links
from test_quality import brute as brute_counts
from test_secrets import brute as brute_secrets
from test_simhash import graph

from weftline.llm import bpe, hnsw, mixing, quality, secrets, simhash, tokencounts


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def texts():
    rng = random.Random(21)
    vocabulary = ["".join(rng.choices(["th", "er", "in", "on", "an", "re", "ed", "at", "Ä", "é"], k=rng.randrange(1, 5))) for _ in range(300)]
    some = [" ".join(rng.choices(vocabulary, k=rng.randrange(3, 120))) for _ in range(60)]
    some += [None, "", " \t\n", "漢字 😀 <|endoftext|> x", "password = hunter2hunter2 AKIA" + "ABCD" * 5 + " " + "0f" * 14, some[3], some[3] + " x", "a\x1cb c\xa0d", "one two three four five six seven eight nine " * 9]
    return some


def documents():
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 5}" if i % 7 else None, 0) for i, t in enumerate(texts())]
    return rows + [(None, "a text without an id", "en", "s1", 0), rows[5], rows[5]]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(documents(), "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(path / "documents.parquet"))
    return str(path)


def same(got, want):
    assert sorted(map(str, got)) == sorted(map(str, want))


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def test_bpe(spark, folder):
    library = tokenizers.Tokenizer.from_file(bpe.default_path())
    library.no_padding(), library.no_truncation()
    want = []
    for i, t, *_ in documents():
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(b"".join(x.to_bytes(4, "little") for x in ids)), sha(library.decode(ids, skip_special_tokens=False).encode())))
    same([(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op2_bpe(spark, folder).collect()], want)


def test_token_counts(spark, folder):
    pieces = tokencounts.zipf_scores(tokencounts.default_path())
    longest = max(map(len, pieces))

    def count(word):
        raw = tokencounts.SPACE + word.encode()
        best = [(0, 0)] + [None] * len(raw)
        for end in range(1, len(raw) + 1):
            ways = [(best[a][0] + pieces[raw[a:end]], best[a][1] - 1) for a in range(max(0, end - longest), end) if raw[a:end] in pieces]
            best[end] = max(ways)
        return -best[-1][1]

    want = [(i, len(words_of(t)), sum(map(count, words_of(t)))) for i, t, *_ in documents()]
    same([tuple(r) for r in tokencounts.op3_token_counts(spark, folder).collect()], want)


def test_simhash(spark, folder):
    def fingerprint(t):
        words = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), seed=42) for i in range(max(1, len(words) - 2))] if words else []
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0

    rows = documents()
    fps = [fingerprint(t) for _, t, *_ in rows]
    root = graph(fps)
    least = {}
    for r, (i, *_) in zip(root, rows):
        least[r] = min([x for x in (least.get(r), i) if x is not None], default=None)
    want = [(i, f"{f:016x}", least[r]) for (i, *_), f, r in zip(rows, fps, root)]
    same([(r.doc_id, r.fingerprint, r.component_id) for r in simhash.op6_simhash(spark, folder).collect()], want)


def quartile(values, q):
    """The percentile between the two nearest values."""
    values = sorted(values)
    at = (len(values) - 1) * q
    low = math.floor(at)
    return values[low] + (at - low) * (values[min(low + 1, len(values) - 1)] - values[low])


def test_quality(spark, folder):
    rows, measures = documents(), ("chars_per_token", "byte_share", "token_entropy")
    found = quality.measure([t for _, t, *_ in rows], quality.default_path())
    script = lambda t: "Latin" if re.search("[A-Za-zÄé]", t or "") else "Han" if t and "漢" in t else "other"
    plain, groups = [], {}
    for k, (i, t, lang, *_) in enumerate(rows):
        n, chars, symbols, lines, repeats = brute_counts(t)
        failed = n < 20 or 100 * repeats > 30 * n
        key = (lang or script(t), int(math.log2(max(1, found["n_tokens"][k]))))
        plain.append((i, n, chars, symbols, lines, repeats, failed, key, k))
        if not failed:
            groups.setdefault(key, []).append(k)
    bands = {}
    for key, ks in groups.items():
        bands[key] = {m: [quartile([float(f"{found[m][k]:.3f}") for k in ks], q) for q in (0.25, 0.75)] for m in measures}
    width = {}
    for key, ks in groups.items():
        peers = [g for g in groups if g[1] == key[1]]
        for m in measures:
            own = lambda g: bands[g][m][1] - bands[g][m][0]
            pooled = sum(own(g) * len(groups[g]) for g in peers) / sum(len(groups[g]) for g in peers)
            n = len(ks)
            width[key, m] = (n * own(key) + quality.PRIOR * pooled) / (n + quality.PRIOR) * (1 + quality.UNSURE / math.sqrt(n))
    want = []
    for i, n, chars, symbols, lines, repeats, failed, key, k in plain:
        kept = not failed
        if kept and key in bands:
            c, b, e = (found[m][k] for m in measures)
            root = math.sqrt(max(1, found["n_tokens"][k]))
            q, w, slack = bands[key], lambda m: width[key, m], quality.SLACK / root  # noqa: B023
            bad = c < q[measures[0]][0] - quality.LOW * w(measures[0]) - slack or c > q[measures[0]][1] + quality.HIGH * w(measures[0]) + slack
            bad = bad or b > q[measures[1]][1] + quality.BYTES * w(measures[1]) + slack
            kept = not (bad or e < q[measures[2]][0] - quality.ENTROPY * w(measures[2]) - quality.ENTROPY_SLACK / root)
        want.append((i, n, chars, symbols, lines, repeats, failed, kept))
    same([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in quality.op7_quality(spark, folder).collect()], want)


def test_secrets(spark, folder):
    want = []
    for i, t, *_ in documents():
        spans = brute_secrets(t or "")
        listed = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        want.append((i, *[sum(k == n for _, k, _ in spans) for n in range(3)], sha(listed.encode())))
    got = secrets.op9_secrets(spark, folder).collect()
    same([(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got], want)
    for r in got:
        assert sum(s.startswith("random") for s in r.spans.split(",")) == r.n_random


def test_mixing(spark, folder):
    from test_mixing import fill

    rows, sizes = documents(), {}
    for _, t, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(words_of(t))
    targets, want = fill(sizes), []
    for i, t, _, s, _ in rows:
        rate, size = targets[s] / sizes[s] if sizes[s] else 0.0, len(words_of(t))
        seed = f"{mixing.SEED}|{'' if i is None else i}|{s or ''}|{hashlib.md5((t or '').encode()).hexdigest()}"
        draw = int(hashlib.md5(seed.encode()).hexdigest()[:13], 16) / 2**52
        want.append((i, size, sizes[s], round(targets[s], 6), size * (int(rate) + (draw < rate - int(rate)))))
    got = mixing.op10_mixing(spark, folder).collect()
    same([(r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in got], want)
    assert abs(sum({s: targets[s] for s in sizes}.values()) - 1.5 * sum(sizes.values())) < 1e-6


def test_embeddings(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], i % 3) for i in range(80)]
    rows += [(200 + i, [x + rng.gauss(0, 0.1) for x in rows[i][1]], 0) for i in range(30)] + [(300, None, 1), (301, [0.0] * 8, 1), (302, rows[0][1], None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = hnsw.op4_embeddings(spark, str(tmp_path)).collect()
    want = brute_links([(i, v) for i, v, _ in rows])
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
