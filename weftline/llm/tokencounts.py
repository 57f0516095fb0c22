"""Token counts under a unigram vocabulary, by dynamic programming over a trie of the distinct words."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .anchors import slices
from .common import REMEMBERED_BYTES, table

#: Words that a worker remembers; bytes of a word above which it is scored by itself and not in the trie.
CACHE = 400_000
LONG = 96
#: What stands for the space before a word (fixed by the vocabulary).
SPACE = "▁".encode()
#: Units of a natural logarithm in the integer scores, and the penalty of a byte that no piece covers.
UNITS = 10_000
FALLBACK = 10
_COUNT = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_NEVER = -(1 << 62)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def zipf_scores(path: str) -> dict[bytes, int]:
    """Pieces of a public vocabulary with integer scores: minus the logarithm of the rank that the vocabulary gives them.

    Single bytes that are no piece cost FALLBACK more than the rarest piece, each."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, rank = {}, 0
    for i in range(model.get_piece_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
            rank += 1
            pieces[model.id_to_piece(i).encode()] = -round(float(np.log(rank + 1)) * UNITS)
    worst = -round((float(np.log(rank + 1)) + FALLBACK) * UNITS)
    for b in range(256):
        pieces.setdefault(bytes([b]), worst)
    return pieces


class Unigram:
    """Best segmentations: the highest sum of scores, of equal ones the one with the fewest tokens.

    A piece's value is its score times 2**20 less one, so sums compare in that order and hold the count."""

    def __init__(self, pieces: dict[bytes, int]):
        self.value = {p: s * _COUNT - 1 for p, s in pieces.items()}
        self.longest = max(map(len, pieces))
        self.known: dict[bytes, int] = {}
        self.held = 0
        self.tables = {}
        by: dict[int, list[bytes]] = {}
        for p in pieces:
            by.setdefault(len(p), []).append(p)
        for n, group in sorted(by.items()):
            rows = np.frombuffer(b"".join(group), dtype=np.uint8).reshape(-1, n)
            keys = self._hash(rows)
            order = np.argsort(keys)
            if (np.diff(keys[order].astype(object)) == 0).any():
                raise ValueError("two pieces of one hash")
            self.tables[n] = (keys[order], np.array([self.value[p] for p in group], dtype=np.int64)[order], self._sieve(keys), rows[order])

    @staticmethod
    def _hash(rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), dtype=np.uint64)
        for column in rows.T:
            out = out * _BASE + column.astype(np.uint64) + np.uint64(1)
        return out

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys ^ (keys >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(46)

    def _sieve(self, keys: np.ndarray) -> np.ndarray:
        """A bit for each hash slot that a piece of this length takes: most strings are no piece and end here."""
        sieve = np.zeros(1 << 18, dtype=bool)
        sieve[self._slot(keys)] = True
        return sieve

    def _values(self, n: int, keys: np.ndarray, spelled: Callable) -> tuple[np.ndarray, np.ndarray]:
        """Places of the keys that are pieces of length n, and their values. ``spelled(at)`` are the bytes at places: what
        the hash finds counts if its bytes are the piece's."""
        pieces, values, sieve, rows = self.tables[n]
        at = np.flatnonzero(sieve[self._slot(keys)])
        slot = np.minimum(np.searchsorted(pieces, keys[at]), len(pieces) - 1)
        ok = pieces[slot] == keys[at]
        at, slot = at[ok], slot[ok]
        same = (spelled(at) == rows[slot]).all(axis=1)
        return at[same], values[slot[same]]

    def counts(self, words: list[bytes]) -> list[int]:
        """Tokens of each word (distinct, with its leading mark). Words in order are the trie's leaves in order: a node
        is a prefix that the word before doesn't share, and its best value is worked out once, level by level."""
        order = sorted(range(len(words)), key=words.__getitem__)
        sorted_words = [words[i] for i in order]
        n, lengths = len(words), np.array([len(w) for w in sorted_words], dtype=np.int64)
        if not n:
            return []
        depth = int(lengths.max())
        flat = np.frombuffer(b"".join(w.ljust(depth, b"\0") for w in sorted_words), dtype=np.uint8).reshape(n, depth)
        live = np.arange(depth)[None, :] < lengths[:, None]
        shared = np.zeros(n, dtype=np.int64)
        if n > 1:
            same = (flat[1:] == flat[:-1]) & live[1:] & live[:-1]
            shared[1:] = np.logical_and.accumulate(same, axis=1).sum(axis=1)
        powers = [np.uint64(pow(int(_BASE), k, 1 << 64)) for k in range(self.longest + 1)]
        hashes, best = [np.zeros(n, dtype=np.uint64)], [np.zeros(n, dtype=np.int64)]
        out = np.zeros(n, dtype=np.int64)
        rows = np.arange(n)
        for d in range(1, depth + 1):
            hashes.append(hashes[-1] * _BASE + flat[:, d - 1].astype(np.uint64) + np.uint64(1))
            nodes = np.flatnonzero((shared < d) & (lengths >= d))
            value = np.full(n, _NEVER, dtype=np.int64)
            own = np.full(len(nodes), _NEVER, dtype=np.int64)
            for length in self.tables:
                if length > d:
                    break
                keys = hashes[d][nodes] - hashes[d - length][nodes] * powers[length]
                at, worth = self._values(length, keys, lambda x: flat[nodes[x], d - length : d])
                own[at] = np.maximum(own[at], best[d - length][nodes[at]] + worth)
            value[nodes] = own
            # a word that shares the prefix takes the value of the word that brought it
            value = value[np.maximum.accumulate(np.where(shared < d, rows, 0))]
            best.append(value)
            ends = lengths == d
            out[ends] = -value[ends] % _COUNT
            if d > self.longest:
                best[d - self.longest - 1] = hashes[d - self.longest - 1] = None
        result = [0] * n
        for i, c in zip(order, out.tolist()):
            result[i] = c
        return result

    def count_alone(self, word: bytes) -> int:
        """The same for one word, by a plain forward pass: for words too long for the trie."""
        best = [0] + [_NEVER] * len(word)
        for end in range(1, len(word) + 1):
            for n in range(1, min(end, self.longest) + 1):
                worth = self.value.get(word[end - n : end])
                if worth is not None and best[end - n] + worth > best[end]:
                    best[end] = best[end - n] + worth
        return -best[-1] % _COUNT if len(word) < _COUNT else self._count_long(word)

    def _count_long(self, word: bytes) -> int:
        best, tokens = [0] + [None] * len(word), [0] * (len(word) + 1)
        for end in range(1, len(word) + 1):
            for n in range(1, min(end, self.longest) + 1):
                worth = self.value.get(word[end - n : end])
                if worth is not None:
                    score, t = best[end - n] + (worth + 1) // _COUNT, tokens[end - n] + 1
                    if best[end] is None or (score, -t) > (best[end], -tokens[end]):
                        best[end], tokens[end] = score, t
        return tokens[-1]

    def of_texts(self, raw: list[bytes]) -> tuple[list[int], list[int]]:
        """Words and tokens of each text (UTF-8)."""
        split = [r.split() for r in raw]
        fresh = set(chain.from_iterable(split)) - self.known.keys()
        if len(self.known) + len(fresh) > CACHE or self.held + sum(map(len, fresh)) > REMEMBERED_BYTES:
            self.known.clear()
            self.held, fresh = 0, set(chain.from_iterable(split))
        self.held += sum(map(len, fresh))
        short = [w for w in fresh if len(w) <= LONG]
        self.known.update(zip(short, self.counts([SPACE + w for w in short])))
        self.known.update((w, self.count_alone(SPACE + w)) for w in fresh if len(w) > LONG)
        known = self.known.__getitem__
        return [len(s) for s in split], [sum(map(known, s)) for s in split]


@lru_cache(maxsize=1)
def unigram(path: str) -> Unigram:
    return Unigram(zipf_scores(path))


def count_tokens(docs: DataFrame, text: str = "text", path: str | None = None, words: str = "n_words", tokens: str = "n_tokens") -> DataFrame:
    """``docs`` with the words and the tokens of each text; null and empty texts have none.

    Words end at ASCII white space and are segmented one by one with the vocabulary's mark before them. One pass
    without a shuffle; a worker remembers a bounded number of words. Columns with the new names are replaced."""
    path = path or default_path()
    kept = docs.drop(words, tokens)
    schema = T.StructType(kept.schema.fields + [T.StructField(words, T.LongType()), T.StructField(tokens, T.LongType())])

    def run(batches):
        model = unigram(path)
        for batch in batches:
            raw = [x or b"" for x in batch.column(batch.schema.get_field_index(text)).cast(pa.binary()).to_pylist()]
            for a, b in slices([len(r) for r in raw]):
                n, t = model.of_texts(raw[a:b])
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n, pa.int64()), pa.array(t, pa.int64())], names=[*part.schema.names, words, tokens])

    return kept.mapInArrow(run, schema)


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_words", "n_tokens")
