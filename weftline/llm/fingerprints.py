"""Fingerprints of documents: every shingle hash below a fixed threshold. DataFrame functions alone."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import _SEPARATORS, Stored, quoted, table

#: Words of a shingle, and the bits that bound a retained hash: one in 2 ** (64 - BITS) is retained.
WORDS = 5
BITS = 61
#: Documents of a bucket on average, and the most buckets; their first keys are known to every task.
BUCKET = 512
MOST_BUCKETS = 1 << 14


def word_hashes(text: Column) -> Column:
    """XXH64 (seed 42) of each word of a text, in order; null and blank texts have none."""
    flat = F.trim(F.translate(F.coalesce(text, F.lit("")), _SEPARATORS, " " * len(_SEPARATORS)))
    return F.when(flat == "", F.array().cast("array<bigint>")).otherwise(F.transform(F.split(flat, " +"), lambda w: F.xxhash64(w)))


def sketch(hashes: str, words: int = WORDS, bits: int = BITS) -> Column:
    """Ascending shingle hashes below 2 ** ``bits`` of a column of word hashes; ``words`` words a shingle, a shorter text is one
    shingle. Sketches are mergeable (:func:`merged`), and one of a text holds that of each passage, but for shingles across its ends.

    The column must be one that is stored or selected before, as each shingle refers to it."""
    h, most = F.col(hashes), (1 << bits) - 1
    shingle = F.transform(h, lambda x, i: F.when(i + words <= F.size(h), F.xxhash64(x, *[F.get(h, i + k) for k in range(1, words)])))
    every = F.when(F.size(h) >= words, shingle).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
    return F.array_sort(F.array_distinct(F.filter(every, lambda x: (x >= 0) & (x <= most))))


def merged(a: Column, b: Column) -> Column:
    """Sketch of two texts one after the other, but for the shingles across their border."""
    return F.array_sort(F.array_union(a, b))


def printed(kept: Column, text: Column) -> Column:
    """A sketch in hexadecimal, 16 digits a hash; a text of whose shingles none is retained has an equals sign and its MD5."""
    return F.when(F.size(kept) > 0, F.array_join(F.transform(kept, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")).otherwise(F.concat(F.lit("="), F.md5(F.coalesce(text, F.lit("")))))


def contained(a: Column, b: Column) -> Column:
    """Estimated share of the smaller text's shingles that the larger one has; null where a sketch is empty."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.least(F.size(a), F.size(b)))


def _starts(keys: DataFrame, many: int) -> list[tuple]:
    """The first key of each of ``many`` ranges or fewer, ascending."""
    first = keys.repartitionByRange(many, "nul", "inv", "dig").groupBy(F.spark_partition_id()).agg(F.min(F.struct("nul", "inv", "dig")).alias("first"))
    return sorted(tuple(r["first"]) for r in first.collect())


def _named(key: tuple) -> dict:
    return dict(zip(("nul", "inv", "dig"), key, strict=True))


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", bucket: int = BUCKET) -> DataFrame:
    """``key, text, hashes, kept, next_text, next_kept, times``: each text with its sketch and those of the next document by descending key,
    after the last the first.

    Texts are shuffled once, to buckets of neighbours; the document that a bucket begins with is sent to the one before it
    as well. Null keys come last, those of one key are ordered by the MD5 of their text. Equal rows are one with
    ``times``, as all but the last of them have an equal one next. A null text is empty; an empty table gives no rows.
    """
    k, t = quoted([key, text])
    rows = docs.select(k.cast("long").alias("key"), F.coalesce(t, F.lit("")).alias("text"))
    rows = rows.select("*", F.isnull("key").alias("nul"), F.coalesce(F.bitwise_not("key"), F.lit(0)).alias("inv"), F.md5("text").alias("dig"))
    keys = Stored(rows.groupBy("nul", "inv", "dig").agg(F.count("*").alias("times")))
    n, most = keys.df.agg(F.count("*"), F.max("times")).first()
    rows = rows.withColumn("times", F.lit(1).cast("long")) if (most or 1) == 1 else rows.groupBy("nul", "inv", "dig", "key").agg(F.first("text").alias("text"), F.count("*").alias("times"))
    starts = _starts(keys.df, max(1, min(MOST_BUCKETS, -(-n // bucket)))) or [(False, 0, "")]
    keys.drop()
    wide = max(1, int(len(starts) ** 0.5))
    steps = [starts[k : k + wide] for k in range(0, len(starts), wide)]
    kind = "struct<nul: boolean, inv: bigint, dig: string>"
    coarse, fine = (F.from_json(F.lit(json.dumps(x)), t) for x, t in (([_named(s[0]) for s in steps], f"array<{kind}>"), ([[_named(k) for k in s] for s in steps], f"array<array<{kind}>>")))  # folded to literals
    rows = rows.withColumn("own", F.struct("nul", "inv", "dig")).withColumn("step", F.size(F.filter(coarse, lambda b: b <= F.col("own"))) - 1)
    near = F.get(fine, F.col("step"))
    rows = rows.withColumn("at", F.size(F.filter(near, lambda b: b <= F.col("own"))) - 1)
    here = (F.col("step") * wide + F.col("at")).cast("int")
    before = F.pmod(here - 1, F.lit(len(starts)))
    place = F.when(F.get(near, F.col("at")) == F.col("own"), F.array(F.struct(here.alias("bucket"), F.lit(False).alias("guest")), F.struct(before.alias("bucket"), F.lit(True).alias("guest")))).otherwise(
        F.array(F.struct(here.alias("bucket"), F.lit(False).alias("guest")))
    )
    dealt = rows.select("key", "text", "own", "times", F.inline(place)).repartition("bucket")
    told = dealt.withColumn("hashes", word_hashes(F.col("text"))).withColumn("kept", sketch("hashes")).drop("hashes")
    order = Window.partitionBy("bucket").orderBy("guest", "own")
    after = told.select("key", "text", "kept", "times", "guest", F.lead("text").over(order).alias("next_text"), F.lead("kept").over(order).alias("next_kept")).where("NOT guest").drop("guest")
    if (most or 1) == 1:
        return after
    last = F.struct("next_text", "next_kept", F.lit(1).cast("long").alias("times"))
    same = F.struct(F.col("text").alias("next_text"), F.col("kept").alias("next_kept"), (F.col("times") - 1).alias("times"))
    return after.select("key", "text", "kept", F.inline(F.when(F.col("times") > 1, F.array(last, same)).otherwise(F.array(last))))


def op13_fingerprints(spark, sf_dir: str) -> DataFrame:
    """``near_*`` is the share of the smaller text's retained hashes that the larger one has; where one of two has none, 1 for equal
    fingerprints (equal texts), else 0. Repeated rows are each other's next; null ids come last. Texts are whole, however long: a row is
    worked on by itself. An empty table gives no rows."""
    rows = with_next(table(spark, sf_dir, "documents"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next_text", F.lit(1), half)))
    rows = rows.withColumn("hashes", word_hashes(F.col("edited"))).withColumn("edited_kept", sketch("hashes")).drop("hashes")

    def near(other: str, text: str) -> Column:
        return F.coalesce(contained(F.col("kept"), F.col(other)), (printed(F.col("kept"), F.col("text")) == printed(F.col(other), F.col(text))).cast("double"))

    found = rows.select(
        F.col("key").alias("doc_id"),
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        printed(F.col("kept"), F.col("text")).alias("fingerprint"),
        printed(F.col("edited_kept"), F.col("edited")).alias("edited_fingerprint"),
        near("edited_kept", "edited").alias("near_edited"),
        near("next_kept", "next_text").alias("near_next"),
        "times",
    )
    return found.withColumn("times", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).drop("times")
