"""Quality rules: repetition and length, and the fertility of a public tokenizer with bands per language or script."""

from __future__ import annotations

from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import REMEMBERED_BYTES, Stored, fresh, give_back, quoted, table

#: Fixed values of the contract.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
SPACES = b" \t\n\x0b\x0c\r"
CHUNK = 4 << 20
CACHE = 200_000
#: Fences of the bands in widths from the quartiles: few characters per token, many, byte fallback, low entropy; their
#: slack for short texts per root token, and that of the entropy.
LOW, HIGH, BYTES, ENTROPY, SLACK, ENTROPY_SLACK = 3.0, 6.0, 3.0, 2.0, 0.5, 2.0
#: The pooled interquartile range counts as so many rows of each group; a group's fences lie further out by this over
#: the root of its rows, as far as few rows leave its quartiles uncertain.
PRIOR, UNSURE = 8, 2.0
#: A table of bands with so many rows at most is broadcast; a larger one is joined as the optimiser sees fit.
MOST_BROADCAST = 10_000

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")
_MEASURES = ("chars_per_token", "byte_share", "token_entropy")
_SCRIPTS = ("Latin", "Cyrillic", "Greek", "Arabic", "Hebrew", "Devanagari", "Thai", "Han", "Hiragana", "Katakana", "Hangul")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """Tokens of words in a SentencePiece vocabulary, with a bounded memory of words."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])
        self.known: dict[bytes, bytes] = {}
        self.held = 0

    def tokens(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word's tokens, packed as 32-bit integers."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > CACHE or self.held + sum(map(len, new)) > REMEMBERED_BYTES:
            self.known.clear()
            self.held, new = 0, words
        coded = self.model.encode([w.decode("utf-8", "replace") for w in new], num_threads=1)
        self.known.update(zip(new, [array("i", t).tobytes() for t in coded]))
        self.held += sum(map(len, new))
        return [self.known[w] for w in words]


@lru_cache(maxsize=1)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _sums(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=n)


def repeated_words(words: np.ndarray, owner: np.ndarray, n: int, window: int = WINDOW) -> np.ndarray:
    """Words of each text in windows that its text holds twice or more, the first included. ``words`` are ranks."""
    if len(words) < window:
        return np.zeros(n, dtype=np.int64)
    with np.errstate(over="ignore"):
        h = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        total = h[: len(h) - window + 1].copy()
        for k in range(1, window):
            total = total * np.uint64(0xD6E8FEB86659FD93) + h[k : len(h) - window + 1 + k]
        total = (total ^ (total >> np.uint64(31))) + owner[: len(total)].astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    at = np.flatnonzero(owner[: len(total)] == owner[window - 1 :])
    ordered = np.sort(total[at])
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if len(twice):
        slot = np.minimum(np.searchsorted(twice, total[at]), len(twice) - 1)
        at = at[twice[slot] == total[at]]
        exact = np.column_stack([owner[at], *(words[at + k] for k in range(window))])
        _, which, counts = np.unique(exact, axis=0, return_inverse=True, return_counts=True)
        at = at[counts[which.ravel()] > 1]
    else:
        at = at[:0]
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + window, -1)
    return _sums(np.cumsum(cover)[:-1] > 0, owner, n).astype(np.int64)


def measure(texts: list[str | None], path: str) -> dict[str, np.ndarray]:
    """All counts and measures of some texts."""
    n = len(texts)
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    split = [r.split() for r in raw]
    out = {"n_words": np.array([len(s) for s in split], dtype=np.int64)}
    out["word_chars"] = np.array([len(t or "") - (len(r) - len(r.translate(None, SPACES))) for t, r in zip(texts, raw)], dtype=np.int64)
    out["n_symbols"] = np.array([len(r) - len(r.translate(None, SYMBOLS)) for r in raw], dtype=np.int64)
    lines = [[x for x in r.split(b"\n") if x.strip()] for r in raw]
    out["n_dup_lines"] = np.array([len(x) - len(set(x)) for x in lines], dtype=np.int64)
    rank: dict[bytes, int] = {}
    flat = np.array([rank.setdefault(w, len(rank)) for s in split for w in s], dtype=np.int64)
    owner = np.repeat(np.arange(n), out["n_words"])
    out["n_repeat_words"] = repeated_words(flat, owner, n)
    vocab = pieces(path)
    tokens = vocab.tokens(list(rank))
    length = np.array([len(t) for t in tokens], dtype=np.int64) // 4
    pool = np.frombuffer(b"".join(tokens), dtype=np.int32)
    start = np.cumsum(length) - length
    width = max(1, len(rank))
    pairs, times = np.unique(owner * width + flat, return_counts=True)
    doc, word = pairs // width, pairs % width
    many = length[word]
    place = np.repeat(start[word] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    token, weight, whose = pool[place], np.repeat(times, many), np.repeat(doc, many)
    total = _sums(weight, whose, n)
    size = len(vocab.is_byte)
    keys, inverse = np.unique(whose * size + token, return_inverse=True)
    counts = np.bincount(inverse, weights=weight, minlength=len(keys))
    share = counts / np.maximum(total[keys // size], 1)
    out["n_tokens"] = total.astype(np.int64)
    out["chars_per_token"] = out["word_chars"] / np.maximum(total, 1)
    out["byte_share"] = _sums(counts * vocab.is_byte[keys % size], keys // size, n) / np.maximum(total, 1)
    out["token_entropy"] = _sums(-share * np.log2(share), keys // size, n) + 0.0
    return out


def measured(docs: DataFrame, text: str = "text", path: str | None = None, prefix: str = "") -> DataFrame:
    """``docs`` with the counts and measures beside their columns, names with ``prefix``. Null: as empty."""
    path = path or default_path()
    names = [prefix + c for c in (*_COUNTS, *_MEASURES)]
    kept = docs.drop(*names)
    kinds = [T.LongType()] * len(_COUNTS) + [T.DoubleType()] * len(_MEASURES)
    schema = T.StructType(kept.schema.fields + [T.StructField(c, k) for c, k in zip(names, kinds)])

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            start = total = 0
            for i, t in enumerate(texts):
                total += len(t or "")
                if total >= CHUNK or i + 1 == len(texts):
                    found = measure(texts[start : i + 1], path)
                    part = batch.slice(start, i + 1 - start)
                    yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(found[c]) for c in (*_COUNTS, *_MEASURES))], names=[*part.schema.names, *names])
                    start, total = i + 1, 0
        give_back()

    return kept.mapInArrow(run, schema)


def group_of(text: str = "text", lang: str | None = "lang") -> Column:
    """The language if the row names one, else the script of most of the text's letters (ties: the order of
    ``_SCRIPTS``); ``other`` for a text without letters of these."""
    found = lambda name: F.coalesce(F.length(F.regexp_replace(text, rf"\P{{Is{name}}}+", "")), F.lit(0))
    most = F.array_max(F.array(*[F.struct(found(name).alias("n"), F.lit(-k).alias("k"), F.lit(name).alias("name")) for k, name in enumerate(_SCRIPTS)]))
    script = F.when(most["n"] > 0, most["name"]).otherwise("other")
    return F.coalesce(F.col(lang), script) if lang else script


def base_failed(prefix: str = "") -> Column:
    words, repeats = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (words < 20) | (100 * repeats > 30 * words)


def _length_class(prefix: str) -> Column:
    return F.floor(F.log2(F.greatest(F.col(prefix + "n_tokens"), F.lit(1)).cast("double"))).cast("int")


def bands(rows: DataFrame, group: str, prefix: str = "") -> DataFrame:
    """Quartiles of each measure and the width that its fences go by: one row per language or script
    and class of lengths (doublings of the tokens, as entropy grows with them).

    Taken over all rows that pass the base rules, exactly on values of three digits: counts of these are what is
    merged, so reruns agree and the state is bounded by the measures' ranges. Each group has its own quartiles,
    however small it is; its width shrinks smoothly towards the mean of the groups' own
    interquartile ranges in its class. Without rows that pass there are no bands."""
    key, size, n = (f"{prefix}_{x}" for x in ("group", "class", "n"))
    q, p, w = ({m: f"{prefix}_{m}_{x}" for m in _MEASURES} for x in "qpw")
    quartiles = [F.percentile(F.round(prefix + m, 3), [0.25, 0.5, 0.75]).alias(q[m]) for m in _MEASURES]
    found = Stored(rows.where(~base_failed(prefix)).groupBy(F.col(group).alias(key), _length_class(prefix).alias(size)).agg(*quartiles, F.count("*").alias(n))).df
    own = lambda m: F.element_at(q[m], 3) - F.element_at(q[m], 1)
    pooled = found.groupBy(size).agg(*[(F.sum(own(m) * F.col(n)) / F.sum(n)).alias(p[m]) for m in _MEASURES])
    few = 1 + UNSURE / F.sqrt(F.col(n).cast("double"))
    width = {w[m]: (F.col(n) * own(m) + PRIOR * F.col(p[m])) / (F.col(n) + PRIOR) * few for m in _MEASURES}
    return found.join(pooled, size).withColumns(width).drop(*p.values())


def judged(rows: DataFrame, group: str, edges: DataFrame, prefix: str = "") -> DataFrame:
    """``rows`` with ``_base_failed`` and ``_kept`` after the prefix.

    Each fence rejects by itself: few or many characters per token, much byte fallback, or low entropy of the tokens,
    all among texts of like length. Fences widen for short texts. Where no row of a group and length has passed the base
    rules, these alone decide. A null text counts as an empty one and fails them; rows that are equal fare alike.
    """
    key, size = f"{prefix}_group", f"{prefix}_class"
    own = edges.drop(f"{prefix}_n")
    if edges.count() <= MOST_BROADCAST:
        own = F.broadcast(own)
    joined = rows.join(own, (rows[group] == own[key]) & (_length_class(prefix) == own[size]), "left")
    at = lambda m, i: F.element_at(F.col(f"{prefix}_{m}_q"), i + 1)
    range_ = lambda m: F.col(f"{prefix}_{m}_w")
    root = F.sqrt(F.greatest(F.col(prefix + "n_tokens"), F.lit(1)).cast("double"))
    slack = SLACK / root
    cpt, byte, entropy = (F.col(prefix + m) for m in _MEASURES)
    rejected = cpt < at("chars_per_token", 0) - LOW * range_("chars_per_token") - slack
    rejected |= cpt > at("chars_per_token", 2) + HIGH * range_("chars_per_token") + slack
    rejected |= byte > at("byte_share", 2) + BYTES * range_("byte_share") + slack
    rejected |= entropy < at("token_entropy", 0) - ENTROPY * range_("token_entropy") - ENTROPY_SLACK / root
    fails = base_failed(prefix)
    out = joined.withColumns({f"{prefix}_base_failed": fails, f"{prefix}_kept": ~fails & ~F.coalesce(rejected, F.lit(False))})
    return out.drop(key, size, *[f"{prefix}_{m}_{x}" for m in _MEASURES for x in "qw"])


def op7_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", group_of().alias("_by"))
    rows = Stored(measured(docs).drop("text")).df
    return judged(rows, "_by", Stored(bands(rows, "_by")).df).select("doc_id", *_COUNTS[:-1], F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"), *_MEASURES)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, all their columns as they were, whatever these are called.

    Texts are measured once: they are stored with their measures, the bands come from the measures, and what is kept
    is read back. A null or empty text goes; of rows that are equal all stay or all go; an empty table gives none."""
    prefix = fresh(docs.columns, "_q")
    by = f"{prefix}by"
    rows = Stored(measured(docs.withColumn(by, group_of()), prefix=prefix)).df
    edges = Stored(bands(rows, by, prefix)).df
    return judged(rows, by, edges, prefix).where(F.col(f"{prefix}_kept")).select(*quoted(docs.columns))
