import random

from weftline.llm import tokencounts as tc


def brute(word, pieces):
    """Tokens of the best segmentation, by looking at all of them."""
    best = [(0, 0)] + [None] * len(word)
    for end in range(1, len(word) + 1):
        ways = [(best[i][0] + pieces[word[i:end]], best[i][1] - 1) for i in range(end) if best[i] is not None and word[i:end] in pieces]
        best[end] = max(ways) if ways else None
    return -best[-1][1]


def test_equal_to_brute_force_on_a_small_vocabulary():
    rng = random.Random(1)
    pieces = {bytes([b]): -90 for b in range(256)}
    for _ in range(60):
        pieces[bytes(rng.choices(b"abc", k=rng.randrange(1, 6)))] = -rng.randrange(1, 60)
    model = tc.Unigram(pieces)
    words = sorted({bytes(rng.choices(b"abcd", k=rng.randrange(1, 14))) for _ in range(800)}, key=lambda w: rng.random())
    want = [brute(w, pieces) for w in words]
    assert model.counts(words) == want
    assert [model.count_alone(w) for w in words] == want
    assert [model._count_long(w) for w in words] == want
    assert model.counts([]) == []


TEXTS = [None, "", " \n\t", "the cat  sat", "Ünïcode 漢字 😀\x1c x\xa0y ▁▁", "a" * 400 + " b", "same same same"]


def test_equal_to_brute_force_on_the_vocabulary(spark):
    pieces = tc.zipf_scores(tc.default_path())
    rng = random.Random(2)
    texts = TEXTS + [" ".join("".join(rng.choices("etaoinshrdlué-.", k=rng.randrange(1, 12))) for _ in range(40)) for _ in range(20)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(3, TEXTS[3], "x")], "doc_id long, text string, n_tokens string")
    rows = tc.count_tokens(docs).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        words = (r.text or "").encode().split()
        assert (r.n_words, r.n_tokens) == (len(words), sum(brute(tc.SPACE + w, pieces) for w in words))
    assert tc.count_tokens(docs.limit(0)).collect() == []


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(tc, "CACHE", 5)
    model = tc.Unigram(tc.zipf_scores(tc.default_path()))
    a, b = model.of_texts([b"one two three"]), model.of_texts([b"four five six seven one"])
    assert a[0] == [3] and b[0] == [5] and len(model.known) <= 5
