"""Language identification by compression with a raw-content dictionary per language."""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Stored, table

#: Bound of the sample that dictionaries are made of: whole texts of so many documents of each language, none of which is
#: longer than this in bytes; bytes of all languages together, and of one, as the compressor's window is no longer; and how
#: many languages there may be.
SAMPLE_DOCS = 200
LONGEST = 1 << 16
SAMPLE_BYTES = 64 << 20
DICTIONARY_BYTES = 2 << 20
MOST_LANGS = 256
LEVEL = 3
#: Texts are coded in blocks, so the dictionary counts as much at their end as at their start.
BLOCK = 512
#: The best code has to be smaller than the second by this share, else the prediction is marked as rejected.
MARGIN = 0.01
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


def letters(text: str) -> bytes:
    """The runs of letters in lower case with a space between: what is coded."""
    return " ".join(_LETTERS.findall(text.lower())).encode("utf-8", "replace")


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_lang: int = SAMPLE_DOCS, longest: int = LONGEST) -> dict[str, bytes]:
    """A dictionary of raw content for each non-null language.

    The sample is bounded in rows and bytes: ``per_lang`` distinct documents of each language, those with the smallest hash of
    their key and text among the ones of ``longest`` bytes at most, as far as they fit in an even share of ``SAMPLE_BYTES``
    and in ``DICTIONARY_BYTES``. Sampled texts are taken whole. Hashes and lengths alone are looked at first: a language's distinct
    hashes are counted by a sketch and a share of them is drawn that holds more than enough, so no language is ranked in one task and
    repeated rows count once. Then the chosen texts come to the driver. Null and empty texts are passed over; a language that has only
    longer ones is not learned; more than ``MOST_LANGS`` languages are an error.
    """
    draw = F.conv(F.substring(F.md5(F.concat_ws("|", F.col(key).cast("string"), F.md5(F.col(text)))), 1, 13), 16, 10).cast("long")
    known = docs.where(F.col(lang).isNotNull() & (F.length(text) > 0) & (F.octet_length(text) <= longest)).select(F.col(lang).alias("lang"), draw.alias("draw"), F.col(text).alias("text"))
    slim = Stored(known.select("lang", "draw", F.octet_length("text").alias("bytes")))
    rows = slim.df.groupBy("lang").agg(F.approx_count_distinct("draw", 0.02).alias("n")).limit(MOST_LANGS + 1).collect()
    if len(rows) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    if not rows:
        return {}
    # of n hashes drawn with the probability p, fewer than per_lang are left once in a great many runs; a quarter more for the sketch's error
    share = {r.lang: min(1.0, 1.25 * (per_lang + 6 * per_lang**0.5 + 10) / max(1, r.n)) for r in rows}
    below = lambda most: F.col("draw") < F.element_at(F.create_map(*[F.lit(x) for pair in most.items() for x in pair]), F.col("lang"))
    by: dict[str, list[tuple[int, int]]] = {}
    for r in slim.df.where(below({g: int(p * (1 << 52)) for g, p in share.items()})).distinct().collect():
        by.setdefault(r.lang, []).append((r.draw, r.bytes))
    slim.drop()
    most, chosen = min(DICTIONARY_BYTES, SAMPLE_BYTES // len(rows)), {}
    for g, drawn in by.items():
        drawn.sort()
        room = [k for k in range(1, min(per_lang, len(drawn)) + 1) if sum(b for _, b in drawn[:k]) <= most]
        chosen[g] = drawn[max(room, default=1) - 1][0] + 1
    texts: dict[str, list[tuple[int, str]]] = {}
    for r in known.where(below(chosen)).dropDuplicates(["lang", "draw"]).collect():
        texts.setdefault(r.lang, []).append((r.draw, r.text))
    # the first of the draw come last, as the end of a dictionary is found first
    return {g: b"".join(letters(t) + b"\n" for _, t in sorted(v)[::-1]) for g, v in sorted(texts.items())}


@lru_cache(maxsize=2)
def _compressors(content: tuple[tuple[str, bytes], ...], level: int):
    import zstandard

    made = []
    for lang, raw in content:
        held = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=level)
        made.append((lang, zstandard.ZstdCompressor(level=level, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False)))
    return made


def classify(text: str | None, content: tuple[tuple[str, bytes], ...], level: int = LEVEL) -> tuple[str, float]:
    """The language with the smallest code and by what share it beats the second; ties go to the smaller name."""
    if not content or not text or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0
    raw = letters(text)
    blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
    sizes = sorted((sum(len(c.compress(b)) for b in blocks), lang) for lang, c in _compressors(content, level))
    if len(sizes) == 1:
        return sizes[0][1], 1.0
    return sizes[0][1], min(1.0, max(0.0, 1 - sizes[0][0] / sizes[1][0]))


def predict(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", margin: float = MARGIN) -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score`` (0 to 1) and ``lang_rejected`` (the margin is too narrow).

    Only the text is looked at, all of it. A text that is null or has no letter is ``und`` with score 0 and is
    rejected, as is every text if no language was learned. The dictionaries' size is bounded by the sample.
    """
    names = ["lang_pred", "lang_score", "lang_rejected"]
    kept = docs.drop(*names)
    schema = T.StructType(kept.schema.fields + [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType()), T.StructField(names[2], T.BooleanType())])
    content = tuple(sorted(dictionaries.items()))

    def run(batches):
        for batch in batches:
            found = [classify(t, content) for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            extra = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[1] < margin for f in found], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, *names])

    return kept.mapInArrow(run, schema)


def op8_langid(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3))
    dictionaries = learn(docs.where(fold != 1).select("doc_id", "text", "lang"))
    held = docs.select("doc_id", "text", F.coalesce(fold == 1, F.lit(False)).alias("held_out"))
    return predict(held, dictionaries).select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))
