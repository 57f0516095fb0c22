import hashlib
import random
import re
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from weftline.llm import langid

WORDS = {
    "en": "the of and to in is that it was for on are with as his they at be this from have or by one had not".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden".split(),
    "fr": "le la les des et en un une du que est pour qui dans sur au pas par plus ce avec il sont ses".split(),
}


LONG = (" ".join(WORDS["fr"]) + " ") * 2000


def corpus(n, seed):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choices(WORDS[lang], k=60)), lang, "s") for i, lang in ((i, rng.choice(list(WORDS))) for i in range(n))]


def test_held_out_accuracy(spark):
    schema = "doc_id long, text string, lang string, lang_pred string"
    learned = langid.learn(spark.createDataFrame(corpus(300, 1), schema), per_lang=60)
    got = langid.predict(spark.createDataFrame(corpus(200, 2), schema), learned).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 195
    assert all(0 <= r.lang_score <= 1 for r in got)


def test_edges(spark):
    schema = "doc_id long, text string, lang string"
    assert langid.learn(spark.createDataFrame([], schema)) == {}
    learned = langid.learn(spark.createDataFrame([*[(i, t, g) for i, t, g, _ in corpus(90, 1)], (1, None, "en"), (None, "", "de"), (2, "x", None)], schema))
    assert set(learned) == set(WORDS)
    rows = langid.predict(spark.createDataFrame([(1, None, None), (2, "", "en"), (3, "123 !?", "en"), (4, "² 5", "de"), (5, LONG, "fr"), (5, LONG, "fr")], schema), learned).collect()
    assert [r.lang_pred for r in rows] == ["und"] * 4 + ["fr", "fr"]
    assert [r.lang_rejected for r in rows[:4]] == [True] * 4
    assert langid.classify("text", ()) == ("und", 0.0)


def test_sample_is_bounded_in_rows_and_takes_whole_texts(spark):
    docs = spark.createDataFrame([(i, f"word {'abcdefghij'[i % 10]} " * 400, "en") for i in range(500)] + [(900, "long " * 20000, "en")], "doc_id long, text string, lang string")
    held = langid.learn(docs, per_lang=5)["en"].split(b"\n")[:-1]
    assert len(held) == 5 and all(len(x.split()) == 800 for x in held)


def test_repeated_rows_count_once(spark):
    """A hundred thousand copies of a row beside few other documents: the language stays, the copies are one document of the sample."""
    others = spark.createDataFrame([(i, " ".join(t.split()), g) for i, t, g, _ in corpus(300, 6)], "doc_id long, text string, lang string")
    for k in range(3):
        copies = spark.range(100_000).select(F.lit(10_000 + k).cast("long").alias("doc_id"), F.lit(f"the copied text {'abc'[k]}").alias("text"), F.lit("en").alias("lang"))
        held = langid.learn(others.unionByName(copies))
        assert set(held) == set(WORDS)
        lines = held["en"].split(b"\n")[:-1]
        assert 60 < len(lines) <= 200 and sum(x.startswith(b"the copied") for x in lines) <= 1


def test_sample_is_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_BYTES", 90_000)
    docs = spark.createDataFrame([(i, f"word{i} " * 1000, "en" if i % 2 else "de") for i in range(100)], "doc_id long, text string, lang string")
    held = langid.learn(docs)
    assert set(held) == {"de", "en"} and all(4 <= len(raw.split(b"\n")) - 1 <= 6 for raw in held.values())


def test_too_many_languages_are_an_error(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"), F.col("id").cast("string").alias("lang"))
    with pytest.raises(ValueError):
        langid.learn(docs)


def plain(text, dictionaries):
    """The language by sizes of blocks of letters, compressed one by one with a fresh compressor."""
    letters = re.sub(r"[\W\d_]+", " ", (text or "").lower()).strip().encode()
    if not letters:
        return "und", 0.0
    sizes = []
    for lang, raw in dictionaries.items():
        held = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=langid.LEVEL)
        size = 0
        for a in range(0, len(letters), 512):
            size += len(zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False).compress(letters[a : a + 512]))
        sizes.append((size, lang))
    sizes.sort()
    return sizes[0][1], min(1.0, max(0.0, 1 - sizes[0][0] / sizes[1][0]))


def test_query_equals_the_plain_version(spark, tmp_path):
    rows = [(i, t, lang if i % 7 else None, "s", 0) for i, t, lang, _ in corpus(150, 4)]
    rows += [(900, None, "en", "s", 0), (901, "", "de", "s", 0), (902, "12 34", None, "s", 0), (None, "der die das und", "de", "s", 0), (3, rows[3][1], "fr", "s", 0), (903, "mit " * 1_100_000, None, "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    fold = lambda i: i is not None and zlib.crc32(str(i).encode()) % 3 == 1
    taught = [r for r in rows if r[0] is not None and not fold(r[0]) and r[2] and r[1] and len(r[1]) <= langid.LONGEST]
    draw = lambda r: int(hashlib.md5(f"{r[0]}|{hashlib.md5(r[1].encode()).hexdigest()}".encode()).hexdigest()[:13], 16)
    dictionaries = {}
    for lang in sorted({r[2] for r in taught}):
        some = sorted((draw(r), r[1]) for r in taught if r[2] == lang)[: langid.SAMPLE_DOCS]
        dictionaries[lang] = b"".join(langid.letters(t) + b"\n" for _, t in some[::-1])
    got = sorted(((r.doc_id, r.held_out, r.lang_pred, r.score) for r in langid.op8_langid(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted(((r[0], fold(r[0]), *plain(r[1], dictionaries)) for r in rows), key=str)
