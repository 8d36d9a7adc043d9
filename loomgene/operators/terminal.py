"""Codons and introns after their CDS and exons have moved: spans from prefix sums, and a join by position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgene.operators.traversal import CODONS, EXONS
from loomgene.shared import cut


def positional(rows: DataFrame, spans: DataFrame, by: str, rank: str = "nth") -> DataFrame:
    """rows with the span of equal rank in their key as n_start and n_end, and n_rows and n_spans of the key; null spans where there are fewer.

    rows and spans: by, nth (1, 2, ... in each key); spans: start, end. Keys without spans have n_spans 0.
    """
    count = lambda df, name: df.groupBy(by).agg(F.count("*").alias(name))
    named = spans.select(by, rank, F.col("start").alias("n_start"), F.col("end").alias("n_end"))
    out = rows.join(named, [by, rank], "left").join(count(rows, "n_rows"), by).join(count(spans, "n_spans"), by, "left")
    return out.withColumn("n_spans", F.coalesce("n_spans", F.lit(0)))


def _ranked(rows: DataFrame, by: str) -> DataFrame:
    """nth in reading order: by place, backwards on the minus strand."""
    sign = F.when(F.col("strand") == "-", -1).otherwise(1)
    return rows.withColumn("nth", F.row_number().over(W.partitionBy(by).orderBy(F.col("start") * sign, F.col("end") * sign, F.col("row_no") * sign)))


def terminal_spans(cds: DataFrame, by: str, five_prime: bool, length: int = 3) -> DataFrame:
    """by, nth, start, end: the first (or last) `length` bases of the parts of a key, over as many parts as that takes, the outermost first.

    cds: by, strand, start, end. A key of fewer bases has no spans.
    """
    minus = F.col("strand") == "-"
    low = ~minus if five_prime else minus  # bases are taken from the low end of the parts
    sign = F.when(low, 1).otherwise(-1)
    w = W.partitionBy(by).orderBy(F.col("start") * sign, F.col("end") * sign)
    size = F.col("end") - F.col("start") + 1
    before = F.coalesce(F.sum(size).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = cds.select(by, "start", "end", low.alias("low"), F.least(size, F.lit(length) - before).alias("take"), F.row_number().over(w).alias("nth"), F.sum(size).over(W.partitionBy(by)).alias("total"))
    first = F.when(F.col("low"), F.col("start")).otherwise(F.col("end") - F.col("take") + 1)
    return rows.where((F.col("take") > 0) & (F.col("total") >= length)).select(by, "nth", first.alias("start"), (first + F.col("take") - 1).alias("end"))


def intron_spans(exons: DataFrame, by: str) -> DataFrame:
    """by, nth, start, end: what lies between neighbouring parts of a key, in reading order; parts that touch or overlap leave nothing. exons: by, strand, start, end."""
    place = W.partitionBy(by).orderBy("start", "end")
    gap = exons.select(by, "strand", (F.col("end") + 1).alias("start"), (F.lead("start").over(place) - 1).alias("end"), F.row_number().over(place).alias("row_no")).where("start <= end")
    return _ranked(gap, by).select(by, "nth", "start", "end")


def rebuilt(features: DataFrame, transcripts: DataFrame | None = None) -> DataFrame:
    """features whose start and stop codons and introns follow the CDS and exons of their transcript (of those in transcripts, if given: id).

    The nth row of a kind, in reading order, gets the nth span. Rows beyond the spans go; so do all codons of a kind if there are fewer
    of them than a split codon has spans, or if the CDS is shorter than a codon: what is left would say something wrong. Introns may be
    fewer than the spans. Codons get phase 0. A row of several transcripts follows the least id. Transcripts without CDS are left alone.
    """
    kids = features.where(F.col("type").isin("CDS", *EXONS, *CODONS, "intron")).select("row_no", "type", "strand", "start", "end", F.explode("parents").alias("id"))
    if transcripts is not None:
        kids = kids.join(transcripts.select("id").distinct(), "id", "left_semi")
    kids = cut(kids.join(kids.where("type = 'CDS'").select("id").distinct(), "id", "left_semi"), "kids")
    of = lambda *types: kids.where(F.col("type").isin(*types))
    own = of(*CODONS, "intron").groupBy("row_no").agg(F.min("id").alias("id"))
    out = None
    for kind in (*CODONS, "intron"):
        rows = _ranked(of(kind).join(own, ["row_no", "id"], "left_semi"), "id")
        spans = intron_spans(of(*EXONS), "id") if kind == "intron" else terminal_spans(of("CDS"), "id", kind == "start_codon")
        found = positional(rows, spans, "id").select("row_no", "n_start", "n_end", (F.col("n_start").isNotNull() & (F.lit(kind == "intron") | (F.col("n_rows") >= F.col("n_spans")))).alias("kept"))
        out = found if out is None else out.unionByName(found)
    rows = features.join(out, "row_no", "left").where("coalesce(kept, true)")
    codon = F.col("kept").isNotNull() & F.col("type").isin(*CODONS)
    return rows.withColumns({"start": F.coalesce("n_start", "start"), "end": F.coalesce("n_end", "end"), "phase": F.when(codon, "0").otherwise(F.col("phase"))}).select(features.columns)
