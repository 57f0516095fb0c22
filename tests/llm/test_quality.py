import math
from collections import Counter

from weftline.llm import quality

SPACES = " \t\n\x0b\x0c\r"


def words_of(text):
    for c in SPACES[1:]:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(text):
    text = text or ""
    words = words_of(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words_of(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


TEXTS = [
    None,
    "",
    " \t\r\n",
    "é 漢字 😀\x1c x\xa0y",
    "a b c d e f g h " * 3,
    "same line\nsame line\n same line\n\n\nsame line",
    "#*$ %&| <> ## x" + " w" * 30,
    " ".join(f"w{i % 97}" for i in range(5000)),
    " ".join(f"word{i}" for i in range(40)),
]


def test_counts_match_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_words string")
    for r in quality.measured(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text), r.doc_id


def test_measures_match_the_vocabulary(spark):
    vocab = quality.pieces(quality.default_path())
    got = quality.measure(TEXTS, quality.default_path())
    for i, text in enumerate(TEXTS):
        tokens = [t for w in words_of(text or "") for t in vocab.model.encode(w)]
        counts, n = Counter(tokens), max(1, len(tokens))
        assert got["n_tokens"][i] == len(tokens)
        assert math.isclose(got["byte_share"][i], sum(vocab.is_byte[t] for t in tokens) / n)
        assert math.isclose(got["token_entropy"][i], -sum(c / n * math.log2(c / n) for c in counts.values()), abs_tol=1e-9)


def test_junk_goes_and_prose_stays(spark):
    import random

    rng = random.Random(1)
    vocabulary = ["".join(rng.choices(["th", "er", "in", "on", "an", "re", "ed", "at"], k=rng.randrange(1, 5))) for _ in range(400)]
    prose = [" ".join(rng.choices(vocabulary, k=rng.randrange(60, 300))) for _ in range(300)]
    junk = [" ".join(rng.choice(["#$%#", "||<>", "$$&&", w]) for w in p.split()) for p in prose[:20]]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(prose + junk)], "doc_id long, text string, lang string, source string, n_chars long")
    out = quality.stage(spark, docs, "")
    assert out.columns == docs.columns
    kept = {r.doc_id for r in out.collect()}
    assert len(kept & set(range(300))) >= 297
    assert not kept & set(range(300, 320))


def test_empty_and_hopeless_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert quality.stage(spark, docs, "").collect() == []
    docs = spark.createDataFrame([(1, None, None), (2, "a", "en")], "doc_id long, text string, lang string")
    assert quality.stage(spark, docs, "").collect() == []


def test_a_small_language_has_bands_of_its_own(spark):
    import random

    rng = random.Random(5)

    def texts(parts, n):
        vocabulary = ["".join(rng.choices(parts, k=rng.randrange(1, 5))) for _ in range(400)]
        return [" ".join(rng.choices(vocabulary, k=rng.randrange(150, 300))) for _ in range(n)]

    large, small = texts(["th", "er", "in", "on", "an", "re", "ed", "at"], 260), texts(["漢字", "文章", "日本", "東京"], 60)
    junk = [" ".join(rng.choice(["#$%#", "||<>", "$$&&", w]) for w in p.split()) for p in large[:10]]
    rows = [(i, t, "en") for i, t in enumerate(large)] + [(1000 + i, t, "xx") for i, t in enumerate(texts(["th", "er", "in", "on", "an", "re"], 60))]
    rows += [(2000 + i, t, "ja") for i, t in enumerate(small)] + [(3000 + i, t, "xx") for i, t in enumerate(junk)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in quality.stage(spark, docs, "").select("doc_id").collect()}
    assert len(kept & set(range(2000, 2060))) >= 58
    assert len(kept & set(range(1000, 1060))) >= 58
    assert not kept & set(range(3000, 3010))


def test_word_lists_of_low_entropy_go(spark):
    import random

    rng = random.Random(6)
    vocabulary = ["".join(rng.choices(["th", "er", "in", "on", "an", "re", "ed", "at"], k=rng.randrange(1, 5))) for _ in range(400)]
    prose = [" ".join(rng.choices(vocabulary, k=rng.randrange(60, 300))) for _ in range(300)]
    lists = [" ".join(rng.choices(vocabulary[:12], k=250)) for _ in range(10)]
    docs = spark.createDataFrame([(i, t, "fr") for i, t in enumerate(prose + lists)], "doc_id long, text string, lang string")
    kept = {r.doc_id for r in quality.stage(spark, docs, "").select("doc_id").collect()}
    assert len(kept & set(range(300))) >= 297
    assert not kept & set(range(300, 310))


def test_script_of_most_letters(spark):
    cases = [("漢字文章東京 A", "Han"), ("See https://a.b Καλημέρα κόσμε, καλημέρα σε όλους", "Greek"), ("漢字 これはひらがなです", "Hiragana"), ("한국어 문장 USB", "Hangul")]
    cases += [("abc αβγ", "Latin"), ("plain prose α", "Latin"), ("12 34 !?", "other"), ("", "other"), (None, "other")]
    docs = spark.createDataFrame([(t, None, w) for t, w in cases] + [("漢字", "en", "en")], "text string, lang string, want string")
    assert all(r.got == r.want for r in docs.select("want", quality.group_of().alias("got")).collect())
