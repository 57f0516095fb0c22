"""Reading frames of baits, with the proteins of their genes where several frames are open."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.seq import CODONS, translate
from weftline.operators import orthologs
from weftline.operators.alignment import protein_alignment
from weftline.sources.readers import baits


def _frame_hits(rows: DataFrame) -> DataFrame:
    """Each frame of a bait against the protein of its gene: ``name, frame, id, coverage, strand``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples():
                for frame in range(3):
                    own = "".join(CODONS.get(r.seq[i : i + 3], "X") for i in range(frame, len(r.seq) - 2, 3))
                    found = protein_alignment(r.seq[frame : frame + 3 * len(own)], r.aa) if own else None
                    if found and found[0] == 0:
                        _, stq, edq, sts, eds, _ = found
                        part = own[sts // 3 : eds // 3]
                        same = sum(a == b for a, b in zip(part, r.aa[stq:edq]))
                        out.append((r.name, frame, 100.0 * same / max(1, len(part)), 100.0 * len(part) / len(own), "+"))
            yield pd.DataFrame(out, columns=["name", "frame", "id", "coverage", "strand"])

    return rows.select("name", "seq", "aa").mapInPandas(run, "name string, frame int, id double, coverage double, strand string")


def predict_frames(rows: DataFrame, markers: DataFrame, proteome: DataFrame, most_stops: int = 1, identity: float = 80, coverage: float = 90) -> tuple[DataFrame, DataFrame]:
    """Baits (``name, seq``) in frame: ``name, frame, how, dna, aa``, and the baits that no frame fits (``name``).

    Genes come from the markers at the bait's position; a bait without one goes by its stops alone. The DNA starts at the
    frame and holds whole codons."""
    placed = baits(rows.select("name", "seq"))
    genes = placed.join(markers.select("chrom", F.least("start", "end").alias("start"), F.greatest("start", "end").alias("end"), "gene"), ["chrom", "start", "end"]).join(proteome.select("gene", "aa"), "gene")
    matches = orthologs.protein_matches(_frame_hits(genes), identity, coverage)
    decided = orthologs.decide_frames(rows, matches, most_stops).join(rows.select("name", "seq"), "name")
    ok = decided.where("how <> 'uncorrected'")
    dna = F.expr("substring(seq, frame + 1, ((length(seq) - frame) div 3) * 3)")
    fitted = ok.withColumn("dna", dna).select("name", "frame", "how", "dna", translate("dna").alias("aa"))
    return fitted, decided.where("how = 'uncorrected'").select("name")
