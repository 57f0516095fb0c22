"""Search, ortholog and paralog decisions, and reading frames."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions import complexity
from weftline.functions.seq import count_stops, kmer_counts, kmer_places, reverse_complement, strip_trailing_stops, translate

from .relational import best_per_key, interval_join


def qualified_references(hits: DataFrame, coverage: float = 100, identity: float = 98) -> DataFrame:
    """Hits of references that cover their query and are close enough: ``locus, target, tlo, thi``."""
    share = (F.col("qhi") - F.col("qlo") + 1).cast("double") * 100 / F.col("ql")
    return hits.where((F.round(share, 2) >= coverage) & (F.col("id") >= identity)).select(F.col("query").alias("locus"), "target", "tlo", "thi")


def ortholog_status(hits: DataFrame, references: DataFrame, assembled: DataFrame, gap: float = 40) -> DataFrame:
    """Status of each assembled row (``locus, sample``).

    ``hits`` holds ``locus, sample, target, tlo, thi, bits, id``. A hit is on the ortholog if it overlaps any
    qualified reference hit of its locus on the same target. A row is an ortholog if all hits are on it, or if its
    best hit there is ahead of the best elsewhere by ``gap`` in identity; a paralog otherwise. Without a hit it is
    ``nohit``; where the locus has no qualified reference, ``unqualified_reference``."""
    keyed = hits.withColumn("_h", F.xxhash64("locus", "sample", "target", "tlo", "thi", "bits", "id"))
    refs = references.select("locus", "target", F.col("tlo").alias("_rlo"), F.col("thi").alias("_rhi"))
    on = interval_join(keyed, refs, ["locus", "target"], ("tlo", "thi"), ("_rlo", "_rhi")).select("locus", "sample", "_h").distinct().withColumn("_on", F.lit(True))
    marked = keyed.join(on, ["locus", "sample", "_h"], "left").withColumn("_on", F.coalesce("_on", F.lit(False)))
    best = lambda c: F.max_by("id", F.when(c, F.struct("bits", "id")))
    per = marked.groupBy("locus", "sample").agg(best(F.col("_on")).alias("_o"), best(~F.col("_on")).alias("_p"), F.count_if(F.col("_on")).alias("_no"), F.count_if(~F.col("_on")).alias("_np"))
    known = references.select("locus").distinct().withColumn("_known", F.lit(True))
    out = assembled.select("locus", "sample").distinct().join(per, ["locus", "sample"], "left").join(known, "locus", "left")
    status = (
        F.when(F.col("_known").isNull(), "unqualified_reference")
        .when(F.col("_no").isNull(), "nohit")
        .when((F.col("_no") > 0) & ((F.col("_np") == 0) | (F.col("_o") - F.col("_p") >= gap)), "ortholog")
        .otherwise("paralog")
    )
    return out.select("locus", "sample", status.alias("status"))


def check_queries(queries: DataFrame, hits: DataFrame, coverage: float = 100, identity: float = 98) -> DataFrame:
    """Loci without a qualified hit."""
    return queries.select("locus").distinct().join(qualified_references(hits, coverage, identity), "locus", "left_anti")


def seed_search(queries: DataFrame, targets: DataFrame, k: int = 11, least: int = 2, drop: int = 20, match: int = 2, mismatch: int = -3, both_strands: bool = True, step: int = 1, most_places: int | None = None) -> DataFrame:
    """Similar regions of nucleotide or protein rows by shared k-mers on one diagonal and ungapped extension.

    ``queries`` and ``targets`` hold ``name, seq``. Seeds of a diagonal meet by an equi-join on the k-mer and are
    aggregated; only then are sequences joined, and the span between the outer seeds is extended in both directions
    while the score does not fall ``drop`` below its best. With ``most_places``, k-mers that the targets hold more often
    than that are taken for repeats and seed nothing, as a mask would have it. Hits have ``query, target, strand, qlo, qhi, tlo, thi,
    bits, id`` with coordinates from 1 on the query's forward strand; bits are this engine's own."""
    from .alignment import extend_diagonals

    strands = queries.select("name", F.lit("+").alias("strand"), "seq")
    if both_strands:
        strands = strands.unionByName(queries.select("name", F.lit("-").alias("strand"), reverse_complement("seq").alias("seq")))
    q = kmer_places(strands.withColumn("seq", F.upper("seq")), "seq", k, "name", "strand").select(F.col("name").alias("query"), "strand", "kmer", F.col("pos").alias("qpos"))
    t = kmer_places(targets, "seq", k, "name").where((F.col("pos") - 1) % step == 0).where(~F.col("kmer").rlike("[a-z]")).select(F.col("name").alias("target"), "kmer", F.col("pos").alias("tpos"))
    if most_places is not None:
        t = t.join(t.groupBy("kmer").count().where(F.col("count") > most_places), "kmer", "left_anti")
    seeds = q.join(t.hint("merge"), "kmer").groupBy("query", "strand", "target", (F.col("tpos") - F.col("qpos")).alias("diagonal")).agg(F.count("*").alias("seeds"), F.min("qpos").alias("lo"), (F.max("qpos") + k - 1).alias("hi"))
    found = seeds.where(F.col("seeds") >= least)
    found = found.join(strands.select(F.col("name").alias("query"), "strand", F.upper("seq").alias("qseq")).hint("merge"), ["query", "strand"]).join(targets.select(F.col("name").alias("target"), F.upper("seq").alias("tseq")).hint("merge"), "target")
    return extend_diagonals(found, drop, match, mismatch)


def _masked(rows: DataFrame, seq: str, rule) -> DataFrame:
    @F.pandas_udf("string")
    def lowered(column: pd.Series) -> pd.Series:
        there = column.notna()
        return column.where(~there, pd.Series(rule(column[there].tolist()), index=column.index[there], dtype=object))

    return rows.withColumn(seq, lowered(seq))


def mask_low_complexity(rows: DataFrame, seq: str = "seq", window: int = 32, most: float = 2.0) -> DataFrame:
    """Low-complexity regions of nucleotides in lower case: windows in which triplets repeat too much (a score of our own)."""
    return _masked(rows, seq, lambda strings: complexity.repeated_triplets(strings, window, most))


def mask_proteins(rows: DataFrame, seq: str = "seq", window: int = 12, trigger: float = 2.2, extend: float = 2.5) -> DataFrame:
    """Low-complexity segments of proteins in lower case: windows of low entropy (``trigger`` bits) and those beside them that are nearly
    as low (``extend``)."""
    return _masked(rows, seq, lambda strings: complexity.low_entropy(strings, window, trigger, extend))


def best_frames(rows: DataFrame, seq: str = "seq") -> DataFrame:
    """Stops in each reading frame: ``name, frame, protein, stops`` without those at the end."""
    frames = rows.withColumn("frame", F.explode(F.array(*map(F.lit, range(3)))))
    protein = F.when(F.col("frame") == 0, translate(seq, 0)).when(F.col("frame") == 1, translate(seq, 1)).otherwise(translate(seq, 2))
    return frames.select("name", seq, "frame", strip_trailing_stops(protein).alias("protein")).withColumn("stops", count_stops("protein"))


def decide_frames(rows: DataFrame, matches: DataFrame | None = None, most_stops: int = 1) -> DataFrame:
    """The reading frame of each bait: ``name, frame, stops, how``.

    The one frame with ``most_stops`` at most is taken (``unique``). Of several, the one that matches the gene's
    protein (``matches``: ``name, frame``; ``protein``), else the one with the fewest stops, the lowest on ties
    (``fewest``). Without any the bait is ``uncorrected``."""
    frames = best_frames(rows)
    sound = frames.where(F.col("stops") <= most_stops)
    per = sound.groupBy("name").agg(F.count("*").alias("n"), F.min(F.struct("stops", "frame")).alias("b"))
    out = rows.select("name").join(per, "name", "left")
    if matches is not None:
        out = out.join(matches.join(sound.select("name", "frame"), ["name", "frame"], "left_semi").groupBy("name").agg(F.min("frame").alias("m")), "name", "left")
    else:
        out = out.withColumn("m", F.lit(None).cast("int"))
    how = F.when(F.col("n").isNull(), "uncorrected").when(F.col("n") == 1, "unique").when(F.col("m").isNotNull(), "protein").otherwise("fewest")
    frame = F.when(how == "protein", F.col("m")).otherwise(F.col("b.frame"))
    out = out.select("name", frame.alias("frame"), how.alias("how"))
    return out.join(frames.select("name", "frame", "stops"), ["name", "frame"], "left")


def protein_matches(hits: DataFrame, identity: float = 80, coverage: float = 90) -> DataFrame:
    """Frames whose hit on their gene's protein is close, long and on the forward strand: ``name, frame``."""
    return hits.where((F.col("id") >= identity) & (F.col("coverage") >= coverage) & (F.col("strand") == "+")).select("name", "frame").distinct()


def frame_by_kmers(rows: DataFrame, reference: DataFrame, k: int = 3) -> DataFrame:
    """The frame whose protein shares most k-mers (with multiplicity) with the reference's; none without any."""
    own = kmer_counts(best_frames(rows), "protein", k, "name", "frame")
    ref = kmer_counts(reference.select("name", "protein"), "protein", k, "name").withColumnRenamed("times", "_times")
    # a file's size says little of its k-mers': no broadcast
    shared = own.join(ref.hint("merge"), ["name", "kmer"]).groupBy("name", "frame").agg(F.sum(F.least("times", "_times")).alias("shared"))
    return best_per_key(shared, ["name"], [-F.col("shared"), "frame"])


def kmer_overlap(left: DataFrame, right: DataFrame, k: int, seq: str = "seq", a: str = "a", b: str = "b") -> DataFrame:
    """Size of the intersection of k-mer multisets: ``a, b, shared``, the sum of the lesser counts. The left table is
    the smaller one: its k-mers sift those of the right before these are counted."""
    one = kmer_counts(left, seq, k, a).withColumnRenamed("times", "_times")
    two = kmer_counts(right, seq, k, b, among=one)
    return one.join(two, "kmer").groupBy(a, b).agg(F.sum(F.least("times", "_times")).alias("shared"))


def filter_orthologs(rows: DataFrame, most_stops: int = 0, least_length: int = 100) -> DataFrame:
    """Coding sequences without inner stops and long enough."""
    return rows.where((count_stops(strip_trailing_stops(translate("seq"))) <= most_stops) & (F.length("seq") >= least_length))


def second_best(rows: DataFrame, gap: float = 40) -> DataFrame:
    """Each query's best hit where it is its only one or ahead of the second by ``gap`` in identity."""
    w = Window.partitionBy("query").orderBy(F.col("bits").desc(), "target")
    ranked = rows.withColumn("_k", F.row_number().over(w)).withColumn("_next", F.lead("id").over(w))
    return ranked.where((F.col("_k") == 1) & (F.col("_next").isNull() | (F.col("id") - F.col("_next") >= gap))).drop("_k", "_next")
