"""Gapped search of nucleotide rows in nucleotide rows: seeds, chains, extension in a band, e-values."""

from __future__ import annotations

import dataclasses
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions import banded
from weftline.functions.seq import kmer_places, reverse_complement

#: Letters of a piece of a target. Extensions get the pieces that they reach, not the target.
PIECE = 1 << 15


@dataclasses.dataclass(frozen=True)
class Scoring:
    """Scores of letters and gaps (a gap of n costs ``gap_open + n * gap_extend``), and the constants of the distribution of
    the best score among unrelated sequences under them."""

    match: int
    mismatch: int
    gap_open: int
    gap_extend: int
    lam: float
    k: float
    h: float


#: Published constants of gapped nucleotide scores.
NUCLEOTIDES = Scoring(match=2, mismatch=-3, gap_open=5, gap_extend=2, lam=0.625, k=0.41, h=0.78)


def bit_score(score: Column, scoring: Scoring = NUCLEOTIDES) -> Column:
    return (score * scoring.lam - math.log(scoring.k)) / math.log(2)


def e_value(score: Column, query_length: Column, total: int, sequences: int, scoring: Scoring = NUCLEOTIDES) -> Column:
    """Hits of this score or more that unrelated letters would give: both lengths are less what an alignment at an end
    can't use, the fixed point of l = ln(K (m - l) (n - N l)) / H."""
    m, n = query_length.cast("double"), float(total)
    left = lambda l: F.greatest(m - l, F.lit(1.0)) * F.greatest(F.lit(n) - l * sequences, F.lit(float(max(1, sequences))))  # noqa: E731, E741
    adjusted = F.aggregate(F.sequence(F.lit(1), F.lit(12)), F.lit(0.0), lambda l, _: F.greatest(F.lit(0.0), F.log(left(l) * scoring.k) / scoring.h))  # noqa: E741
    return left(adjusted) * F.pow(F.lit(2.0), -bit_score(score, scoring))


def segments(queries: DataFrame, targets: DataFrame, k: int, step: int = 1, most_places: int | None = None) -> DataFrame:
    """Runs of shared k-mers on one diagonal: ``query, strand, target, qlo`` (from 0), ``size, diagonal, seeds, cluster``.

    K-mers meet by an equi-join. Seeds whose k-mers touch are one run, so a run is an exact match. Lower-case letters
    of targets seed nothing; nor do k-mers that targets hold more than ``most_places`` times."""
    q = kmer_places(queries, "seq", k, "name", "strand").select(F.col("name").alias("query"), "strand", "kmer", (F.col("pos") - 1).alias("q"))
    t = kmer_places(targets, "seq", k, "name").where((F.col("pos") - 1) % step == 0).where(F.col("kmer").rlike("^[ACGT]+$")).select(F.col("name").alias("target"), "kmer", (F.col("pos") - 1).alias("t"))
    if most_places is not None:
        t = t.join(t.groupBy("kmer").count().where(F.col("count") > most_places).select("kmer"), "kmer", "left_anti")
    pair = ["query", "strand", "target"]
    seeds = q.join(t.hint("merge"), "kmer").select(*pair, "q", (F.col("t") - F.col("q")).alias("diagonal")).repartition(*pair)
    line = Window.partitionBy(*pair, "diagonal").orderBy("q")
    new = F.coalesce((F.col("q") - F.lag("q").over(line) > k).cast("int"), F.lit(1))
    return seeds.withColumn("run", new).withColumn("run", F.sum("run").over(line)).groupBy(*pair, "diagonal", "run").agg(F.min("q").alias("qlo"), (F.max("q") - F.min("q") + k).alias("size"), F.count("*").alias("seeds")).drop("run")


def _best_chains(qlo, size, diagonal, seeds, scoring: Scoring, reach: int, most_shift: int, least: int):
    """Chains of runs by a sparse dynamic programme, best first; each run is in one chain at most. Runs are in the order of ``qlo``."""
    n = len(qlo)
    qhi, shift = qlo + size, qlo + diagonal
    thi = shift + size
    value, back, longest = (scoring.match * size).astype(np.float64), np.full(n, -1), int(size.max())
    for j in range(1, n):
        i = int(np.searchsorted(qlo, qlo[j] - reach - longest))
        gain = np.minimum(size[j], np.minimum(qhi[j] - qhi[i:j], thi[j] - thi[i:j]))
        off = np.abs(diagonal[j] - diagonal[i:j])
        total = np.where((gain > 0) & (off <= most_shift) & (qlo[j] - qhi[i:j] <= reach), value[i:j] + scoring.match * gain - np.where(off > 0, scoring.gap_open + scoring.gap_extend * off, 0), -np.inf)
        if len(total) and total.max() > value[j]:
            back[j] = i + int(total.argmax())
            value[j] = total.max()
    used = np.zeros(n, dtype=bool)
    for j in np.argsort(-value, kind="stable"):
        chain = []
        while j >= 0 and not used[j]:
            used[j] = True
            chain.append(int(j))
            j = back[j]
        if chain and seeds[chain].sum() >= least:
            yield chain[::-1]


_CHAIN = "query string, strand string, target string, lowest long, highest long, anchors array<struct<q: bigint, diagonal: bigint, size: bigint>>"


def chained(runs: DataFrame, scoring: Scoring = NUCLEOTIDES, reach: int = 500, most_shift: int = 64, least: int = 2) -> DataFrame:
    """Chains of the runs of a query and a target: their outermost diagonals and their runs as ``anchors``.

    Runs whose diagonals are near each other form a cluster, which no chain leaves; a task walks over its sorted rows and
    holds one cluster."""
    pair = ["query", "strand", "target"]
    order = Window.partitionBy(*pair).orderBy("diagonal", "qlo")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > most_shift).cast("long"), F.lit(0))
    rows = runs.withColumn("cluster", apart).withColumn("cluster", F.sum("cluster").over(order)).sortWithinPartitions(*pair, "cluster", "qlo", "diagonal")
    names = [*pair, "cluster"]

    def finish(key, group):
        qlo, size, diagonal, seeds = (np.array(c, dtype=np.int64) for c in zip(*group, strict=True))
        for chain in _best_chains(qlo, size, diagonal, seeds, scoring, reach, most_shift, least):
            yield (*key[:3], int(diagonal[chain].min()), int(diagonal[chain].max()), [{"q": int(qlo[c]), "diagonal": int(diagonal[c]), "size": int(size[c])} for c in chain])

    def run(batches):
        key, group, out = None, [], []
        kind = pa.schema([("query", pa.string()), ("strand", pa.string()), ("target", pa.string()), ("lowest", pa.int64()), ("highest", pa.int64()), ("anchors", pa.list_(pa.struct([("q", pa.int64()), ("diagonal", pa.int64()), ("size", pa.int64())])))])
        batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kind, strict=True)], schema=kind)
        for batch in batches:
            for now, row in zip(zip(*(batch.column(c).to_pylist() for c in names), strict=True), zip(*(batch.column(c).to_pylist() for c in ("qlo", "size", "diagonal", "seeds")), strict=True), strict=True):
                if now != key and group:
                    out.extend(finish(key, group))
                    group = []
                key = now
                group.append(row)
            if len(out) > 4096:
                yield batch_of(out)
                out = []
        if group:
            out.extend(finish(key, group))
        if out:
            yield batch_of(out)

    return rows.select(*names, "qlo", "size", "diagonal", "seeds").mapInArrow(run, _CHAIN)


def _reached(chains: DataFrame, targets: DataFrame, lengths: DataFrame, band: int, piece: int) -> DataFrame:
    """``chains`` with the part of the target that an extension can reach (``tseq``, from ``tfrom``), put together from pieces, so that
    a long target is never sent whole and does not meet all its hits in one task."""
    cut = targets.where(F.length("seq") > 0).select(F.col("name").alias("target"), F.posexplode(F.expr(f"transform(sequence(0, length(seq) - 1, {piece}), at -> substring(seq, at + 1, {piece}))")).alias("piece", "part"))
    ends = chains.join(lengths.hint("merge"), "query").withColumns({"tfrom": F.greatest(F.lit(0), F.col("lowest") - band), "tto": F.col("qlen") + F.col("highest") + band})
    first, last = (F.floor(F.col("tfrom") / piece)).cast("int"), F.floor((F.col("tto") - 1) / piece).cast("int")
    wanted = ends.withColumn("piece", F.explode(F.sequence(first, F.greatest(first, last))))
    start = F.col("piece").cast("long") * piece
    met = wanted.join(cut.hint("merge"), ["target", "piece"]).withColumn("part", F.substring("part", F.greatest(F.lit(0), F.col("tfrom") - start).cast("int") + 1, F.least(F.lit(piece), F.col("tto") - start).cast("int") - F.greatest(F.lit(0), F.col("tfrom") - start).cast("int")))
    parts = F.array_sort(F.collect_list(F.struct("piece", "part")))
    return met.groupBy("query", "strand", "target", "lowest", "highest", "anchors", "qlen", "tfrom").agg(F.array_join(F.transform(parts, lambda p: p["part"]), "").alias("tseq"))


_HIT = "query string, target string, strand string, qlo long, qhi long, tlo long, thi long, score long, matches long, columns long, qlen long"


def _extended(rows: DataFrame, scoring: Scoring, band: int, x_drop: int) -> DataFrame:
    """Hits through the anchors of each chain: from the longest one first, then from those that no hit so far covers."""
    costs = (scoring.match, scoring.mismatch, scoring.gap_open, scoring.gap_extend, x_drop)

    def run(batches):
        for batch in batches:
            data = {c: batch.column(c).to_pylist() for c in batch.schema.names}
            queries, targets = ([banded.letters(s, other) for s in data[c]] for c, other in (("qseq", 1), ("tseq", 2)))
            open_ = [sorted(a, key=lambda x: (-x["size"], x["q"])) for a in data["anchors"]]
            found: list[tuple] = []
            while any(open_):
                pairs, who = [], []
                for k, anchors in enumerate(open_):
                    if anchors:
                        a = anchors.pop(0)
                        q = a["q"] + a["size"] // 2
                        spread = max(data["highest"][k] - a["diagonal"], a["diagonal"] - data["lowest"][k])
                        pairs.append((queries[k], targets[k], q, q + a["diagonal"] - data["tfrom"][k], band + spread))
                        who.append(k)
                for k, (score, matches, columns, qlo, qhi, tlo, thi) in zip(who, banded.through_anchors(pairs, *costs), strict=True):
                    shift, n, plus = data["tfrom"][k], data["qlen"][k], data["strand"][k] == "+"
                    open_[k] = [a for a in open_[k] if not (qlo <= a["q"] and a["q"] + a["size"] <= qhi and tlo + shift <= a["q"] + a["diagonal"] and a["q"] + a["diagonal"] + a["size"] <= thi + shift)]
                    found.append((data["query"][k], data["target"][k], data["strand"][k], qlo + 1 if plus else n - qhi + 1, qhi if plus else n - qlo, tlo + shift + 1, thi + shift, score, matches, columns, n))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i < 3 else pa.int64()) for i, c in enumerate(zip(*found, strict=True))], names=[x.split()[0] for x in _HIT.split(", ")])

    # little data and much work: partitions are not merged by their size, and a hot target's hits are spread
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(run, _HIT)


def gapped_search(
    queries: DataFrame, targets: DataFrame, k: int = 11, least: int = 2, band: int = 16, x_drop: int = 100, most_e: float = 10.0,
    both_strands: bool = True, step: int = 1, most_places: int | None = None, reach: int = 500, most_shift: int = 64, scoring: Scoring = NUCLEOTIDES, piece: int = PIECE,
) -> DataFrame:
    """Local alignments with gaps of ``queries`` in ``targets`` (``name, seq``; names are distinct) with an e-value of ``most_e`` at most.

    Runs of shared ``k``-mers on near diagonals (``most_shift`` apart, ``reach`` letters of the query between them) are chained; chains of
    ``least`` seeds are extended from their anchors with affine gaps within ``band`` diagonals beyond those of the chain, until the score falls ``x_drop``
    below its best. Hits have ``query, target, strand, qlo, qhi, tlo, thi`` (from 1, on the query's forward strand), ``score, bits, evalue, id``
    (percent of columns), ``columns`` and ``gaps``; equal hits are one. Letters other than A, C, G, T match nothing; null and empty
    sequences have no hits. E-values refer to all targets' letters.
    """
    queries = queries.where(F.col("name").isNotNull() & F.col("seq").isNotNull()).select(F.col("name").cast("string").alias("name"), F.upper("seq").alias("seq"))
    targets = targets.where(F.col("name").isNotNull() & F.col("seq").isNotNull()).select(F.col("name").cast("string").alias("name"), "seq")
    size = targets.agg(F.coalesce(F.sum(F.length("seq")), F.lit(0)), F.count("*")).first()
    strands = queries.select("name", F.lit("+").alias("strand"), "seq")
    if both_strands:
        strands = strands.unionByName(queries.select("name", F.lit("-").alias("strand"), reverse_complement("seq").alias("seq")))
    lengths = queries.select(F.col("name").alias("query"), F.length("seq").cast("long").alias("qlen"))
    chains = chained(segments(strands, targets, k, step, most_places), scoring, reach, most_shift, least)
    rows = _reached(chains, targets, lengths, band, piece).join(strands.select(F.col("name").alias("query"), "strand", F.col("seq").alias("qseq")).hint("merge"), ["query", "strand"])
    hits = _extended(rows, scoring, band, x_drop).distinct()
    hits = hits.withColumns({"bits": bit_score(F.col("score"), scoring), "evalue": e_value(F.col("score"), F.col("qlen"), size[0], size[1], scoring), "id": F.col("matches") * 100.0 / F.col("columns")})
    spans = F.col("qhi") - F.col("qlo") + F.col("thi") - F.col("tlo") + 2
    return hits.where(F.col("evalue") <= most_e).select("query", "target", "strand", "qlo", "qhi", "tlo", "thi", "score", "bits", "evalue", "id", "columns", (F.col("columns") * 2 - spans).alias("gaps"))
