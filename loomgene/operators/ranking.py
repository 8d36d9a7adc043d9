"""Choices of one row among several: isoforms, colliding genes, assignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgene.shared import numbered


def best(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in this order; give the order a last column without ties."""
    return df.withColumn("__rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("__rank = 1").drop("__rank")


def isoforms(parts: DataFrame) -> DataFrame:
    """The transcript that stands for each gene.

    parts: gene, transcript, kind (CDS, UTR, transcript or other), start, end, one row a part. The longest CDS wins, then the
    longest UTR, then the least (start, end, transcript) of the rows of the kind transcript, else of all parts. Gives gene, transcript, cds_length, utr_length, candidates, changed.
    """
    length, place = F.abs(F.col("end") - F.col("start")) + 1, F.struct("start", "end")
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, length).otherwise(0)).cast("bigint")
    models = parts.groupBy("gene", "transcript").agg(of("CDS").alias("cds_length"), of("UTR").alias("utr_length"), F.coalesce(F.min(F.when(F.col("kind") == "transcript", place)), F.min(place)).alias("at"))
    models = models.withColumn("candidates", F.count("*").over(W.partitionBy("gene")))
    won = best(models, ["gene"], [F.desc("cds_length"), F.desc("utr_length"), F.asc_nulls_last("at.start"), F.asc_nulls_last("at.end"), F.asc("transcript")])
    return won.select("gene", "transcript", "cds_length", "utr_length", "candidates", (F.col("candidates") > 1).alias("changed"))


#: What makes one of several genes at the same coordinates the better one, in order; each is better when larger.
CRITERIA = (
    ("valid_structure", "valid"),
    ("fewer_internal_stops", "-stops"),
    ("more_complete", "completeness"),
    ("fewer_ambiguous_residues", "-ambiguous"),
    ("longer_cds", "length"),
    ("fewer_introns", "-introns"),
    ("input_order", "-row_no"),
)


def duplicates(genes: DataFrame, key: list[str], criteria=CRITERIA) -> DataFrame:
    """Pairs of a kept and a removed gene that share `key`.

    genes: gene, row_no, the key and the columns that the criteria name ('-' before one: smaller is better); a boolean
    counts as 0 or 1. Groups are numbered as first seen. The reason is the first criterion in which the two differ.
    """
    values = [(-1 if c.startswith("-") else 1) * F.col(c.lstrip("-")).cast("double") for _, c in criteria]
    w = W.partitionBy(*key)
    rows = genes.withColumn("n", F.count("*").over(w)).where("n > 1").withColumn("first_row", F.min("row_no").over(w))
    ranked = rows.withColumn("score", F.array(*values)).withColumn("rank", F.row_number().over(w.orderBy(*(F.desc(v) for v in values))))
    kept = ranked.where("rank = 1").select(*key, "first_row", F.col("gene").alias("kept"), F.col("score").alias("kept_score"))
    groups = numbered(kept.select("first_row").distinct(), ["first_row"], "group_no")
    reason = None
    for i, (name, _) in enumerate(criteria):
        differs = ~F.col("kept_score")[i].eqNullSafe(F.col("score")[i])
        reason = F.when(differs, name) if reason is None else reason.when(differs, name)
    pairs = ranked.where("rank > 1").join(kept.drop("first_row"), key).join(groups, "first_row")
    return pairs.select(F.format_string("coordinate_duplicate_%06d", "group_no").alias("group_id"), *key, "kept", F.col("gene").alias("removed"), reason.alias("reason"))
