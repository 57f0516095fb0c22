"""BPE encoding and decoding by batched numpy merge rounds."""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import REMEMBERED_BYTES, give_back, table

#: Distinct words that a worker remembers, and bytes of text that one round of merges takes.
CACHE = 400_000
CHUNK = 4 << 20
#: Words of more symbols than this are merged one by one with a heap: rounds over them would be quadratic.
LONG = 256


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 itself, the rest from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class WordBPE:
    """A byte-level BPE vocabulary with word ends, as its tokenizer file describes it."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, end = spec["model"], spec["model"]["end_of_word_suffix"]
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: s for s, i in [*vocab.items(), *self.special.items()]}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        letters = _byte_letters()
        self.inner = np.array([vocab[c] for c in letters], dtype=np.int64)
        self.last = np.array([vocab[c + end] for c in letters], dtype=np.int64)
        self.size = len(self.names)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self.words = regex.compile(split.replace(r"\s", r"\p{White_Space}"), regex.V0)
        self.breaks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.assigned: set[str] = set(map(chr, range(128)))
        self.path = path
        self.spaces = regex.compile(r"\p{White_Space}+")
        self.known: dict[str, bytes] = {}
        self.held = 0

    def rank_of(self, keys: np.ndarray) -> np.ndarray:
        """Rank of each pair; one past the last for a pair that isn't merged."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], len(self.keys))

    def merge(self, words: list[str]) -> list[bytes]:
        """Packed ids of each pre-token. A round merges the lowest-ranked pair of every word that has one left.

        Ranks are looked up once and then only where a merge has changed a pair."""
        raw = [w.encode() for w in words]
        short = np.array([i for i, w in enumerate(raw) if len(w) <= LONG], dtype=np.int64)
        flat = np.frombuffer(b"".join([w for w in raw if len(w) <= LONG]), dtype=np.uint8)
        lengths = np.array([len(w) for w in raw if len(w) <= LONG], dtype=np.int64)
        sym, owner = self.inner[flat], np.repeat(short, lengths)
        ends = np.cumsum(lengths) - 1
        sym[ends] = self.last[flat[ends]]
        none = len(self.keys)
        rank = np.full(len(sym), none, dtype=np.int64)
        pairs = np.flatnonzero(owner[:-1] == owner[1:])
        rank[pairs] = self.rank_of(sym[pairs] * self.size + sym[pairs + 1])
        owners, syms = [], []
        while len(sym):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(sym)])
            least = np.minimum.reduceat(rank, starts)
            spread = np.repeat(least, sizes)
            done = spread == none
            owners.append(owner[done])
            syms.append(sym[done])
            hit = (rank == spread) & ~done
            first = hit & ~np.r_[False, hit[:-1]]
            place = np.arange(len(sym))
            hit &= (place - np.maximum.accumulate(np.where(first, place, 0))) % 2 == 0  # of overlapping pairs the left one
            at = np.flatnonzero(hit)
            sym[at] = self.made[rank[at]]
            keep = ~done
            keep[at + 1] = False
            moved = np.cumsum(keep) - 1
            at = moved[at]
            sym, owner, rank = sym[keep], owner[keep], rank[keep]
            stale = np.concatenate([at, at[at > 0] - 1])
            rank[stale] = none
            stale = stale[stale + 1 < len(sym)]
            stale = stale[owner[stale] == owner[stale + 1]]
            rank[stale] = self.rank_of(sym[stale] * self.size + sym[stale + 1])
        for i, w in enumerate(raw):
            if len(w) > LONG:
                syms.append(self._by_heap(w))
                owners.append(np.full(len(syms[-1]), i, dtype=np.int64))
        if not syms:
            return [b""] * len(raw)
        owner = np.concatenate(owners)
        packed = np.concatenate(syms)[np.argsort(owner, kind="stable")].astype("<u4").tobytes()
        cuts = np.concatenate(([0], 4 * np.cumsum(np.bincount(owner, minlength=len(raw))))).tolist()
        return [packed[a:b] for a, b in zip(cuts, cuts[1:])]

    def _by_heap(self, word: bytes) -> np.ndarray:
        """The same for one long word, in n log n."""
        codes = np.frombuffer(word, dtype=np.uint8)
        sym = self.inner[codes].tolist()
        sym[-1] = int(self.last[codes[-1]])
        after, before = [*range(1, len(sym)), -1], [-1, *range(len(sym) - 1)]
        first = self.rank_of(np.array(sym[:-1]) * self.size + np.array(sym[1:])).tolist()
        none = len(self.keys)
        heap = [(r, i, sym[i], sym[i + 1]) for i, r in enumerate(first) if r < none]
        heapq.heapify(heap)

        def push(i: int) -> None:
            j = after[i]
            if j >= 0 and (r := int(self.rank_of(np.array([sym[i] * self.size + sym[j]]))[0])) < none:
                heapq.heappush(heap, (r, i, sym[i], sym[j]))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j < 0 or sym[j] != b:
                continue
            sym[i], sym[j], after[i] = int(self.made[r]), -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            if before[i] >= 0:
                push(before[i])
            push(i)
        return np.array([s for s in sym if s >= 0], dtype=np.int64)

    def normal(self, text: str) -> str:
        """NFC and lower case letter by letter (so a capital sigma never becomes a final one)."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def _chunks(self, text: str) -> list[str]:
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # Python's own split takes these for white space
            return [x for x in self.spaces.split(text) if x]
        return text.split()

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _has_newer(self, text: str) -> bool:
        """Whether a text has code points that this Python's Unicode tables don't know yet: the library's own rules
        split those texts. Characters once looked up are remembered."""
        fresh = set(text) - self.assigned
        newer = {c for c in fresh if unicodedata.category(c) == "Cn"}
        self.assigned |= fresh - newer
        return bool(newer)

    def _split_by_library(self, text: str) -> list[str]:
        """Pre-tokens of a text by the library's normalizer and pattern, whose Unicode tables are newer."""
        byte = {c: b for b, c in enumerate(_byte_letters())}
        parts = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(byte[c] for c in s).decode("utf-8", "replace") for s, _ in parts]

    def _learn(self, chunks: set[str]) -> None:
        tokens = [self.words.findall(c) for c in chunks]
        distinct = list(dict.fromkeys(chain.from_iterable(tokens)))
        ids = dict(zip(distinct, self.merge(distinct)))
        for c, t in zip(chunks, tokens):
            self.known[c] = ids[t[0]] if len(t) == 1 else b"".join([ids[w] for w in t])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers. Null and empty texts have none."""
        parts = []
        for text in texts:
            own: list = []
            for k, piece in enumerate(self.breaks.split(text) if text and "<|" in text else [text or ""]):
                if k % 2:
                    own.append(self.special[piece].to_bytes(4, "little"))
                elif not piece.isascii() and self._has_newer(piece):
                    own.append(b"".join(self.merge(self._split_by_library(piece))))
                else:
                    own.append(self._chunks(self.normal(piece)))
            parts.append(own)
        lists = [p for own in parts for p in own if not isinstance(p, bytes)]
        fresh = set(chain.from_iterable(lists)) - self.known.keys()
        if len(self.known) + len(fresh) > CACHE or self.held + sum(map(len, fresh)) > REMEMBERED_BYTES:
            self.known.clear()
            self.held, fresh = 0, set(chain.from_iterable(lists))
        if fresh:
            self._learn(fresh)
            self.held += sum(map(len, fresh))
        known = self.known.__getitem__
        return [b"".join(p if isinstance(p, bytes) else b"".join(map(known, p)) for p in own) for own in parts]

    def decode(self, ids: bytes) -> str:
        """The tokens' own strings with a space between, as a tokenizer without a decoder gives them."""
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBPE:
    return WordBPE(path)


def _slices(texts: list[str | None]):
    """Runs of texts of about CHUNK characters."""
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t or "")
        if total >= CHUNK:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode(docs: DataFrame, text: str = "text", path: str | None = None, ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with the ids of each text (binary: little-endian unsigned 32-bit) and, if named, the decoded text.

    Equal to the tokenizers library for the vocabulary at ``path``, special tokens in the text included. Null
    and empty texts have no ids and decode to the empty string. One pass without a shuffle; a worker keeps a
    bounded cache of words. A column that has the name of a new one is replaced.
    """
    path = path or default_path()
    names = [ids] + ([decoded] if decoded else [])
    kept = docs.drop(*names)
    schema = T.StructType(kept.schema.fields + [T.StructField(ids, T.BinaryType())] + ([T.StructField(decoded, T.StringType())] if decoded else []))

    def run(batches):
        bpe = vocabulary(path)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            for a, b in _slices(texts):
                packed = bpe.encode(texts[a:b])
                part = batch.slice(a, b - a)
                columns = [*part.columns, pa.array(packed, pa.binary())]
                if decoded:
                    columns.append(pa.array(map(bpe.decode, packed), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, *names])
        give_back()

    return kept.mapInArrow(run, schema)


def decode(frame: DataFrame, ids: str = "ids", decoded: str = "decoded", path: str | None = None) -> DataFrame:
    """``frame`` with the text that its packed ids decode to; null ids decode to the empty string."""
    path = path or default_path()
    kept = frame.drop(decoded)
    schema = T.StructType(kept.schema.fields + [T.StructField(decoded, T.StringType())])

    def run(batches):
        bpe = vocabulary(path)
        for batch in batches:
            texts = [bpe.decode(x or b"") for x in batch.column(batch.schema.get_field_index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, decoded])

    return kept.mapInArrow(run, schema)


def op2_bpe(spark, sf_dir: str) -> DataFrame:
    coded = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), decoded="decoded")
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"),
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``ids`` and ``n_tokens``, the number of these; columns with those names are replaced. Null and
    empty texts have no ids; equal texts have the same; texts of any length are taken whole."""
    coded = encode(docs, ids="ids")
    return coded.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))
