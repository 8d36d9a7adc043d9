"""Counts of what moved between groups from stage to stage, and roll-ups of states."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgene.shared import cut, refuse

def links(members: DataFrame, stages: list[str], totals: DataFrame | None = None) -> DataFrame:
    """stage, source, target and count between neighbouring stages. members: stage, group, id.

    An id in no group of a stage belongs to its group 'unchanged' if it is in any stage; ids never seen add to
    unchanged -> unchanged when totals (one row, total) is given.
    """
    at = F.create_map(*(x for i, s in enumerate(stages) for x in (F.lit(s), F.lit(i))))
    ids = members.select("id").distinct()
    wide = ids
    for s in stages:
        own = members.where(F.col("stage") == s).groupBy("id").agg(F.min("group").alias(s))
        wide = wide.join(own, "id", "left").na.fill("unchanged", [s])
    steps = F.explode(F.array(*(F.struct(F.lit(a).alias("stage"), F.col(a).alias("source"), F.col(b).alias("target")) for a, b in zip(stages, stages[1:]))))
    out = wide.select(steps.alias("s")).groupBy("s.stage", "s.source", "s.target").agg(F.count("*").alias("count"))
    if totals is not None:
        rest = totals.crossJoin(ids.agg(F.count("*").alias("seen"))).select(F.explode(F.array(*map(F.lit, stages[:-1]))).alias("stage"), F.lit("unchanged").alias("source"), F.lit("unchanged").alias("target"), (F.col("total") - F.col("seen")).alias("count"))  # two single rows
        out = out.unionByName(rest).groupBy("stage", "source", "target").agg(F.sum("count").alias("count"))
    return out.select("stage", at[F.col("stage")].alias("position"), "source", "target", "count")


def rollup_status(rows: DataFrame, key: str, status: str, order: dict[str, int], default: int) -> DataFrame:
    """One status a key: the first in this order."""
    rank = None
    for k, v in order.items():
        rank = F.when(F.col(status) == k, v) if rank is None else rank.when(F.col(status) == k, v)
    ranked = rows.withColumn("__rank", rank.otherwise(default))
    return ranked.groupBy(key).agg(F.min(F.struct("__rank", status)).alias("s")).select(key, F.col(f"s.{status}").alias(status))


def event_counts(events: DataFrame, by: str, kind: str) -> DataFrame:
    """Counts by group and kind, and over all groups (group null)."""
    return events.rollup(kind, by).agg(F.count("*").alias("count")).where(F.col(kind).isNotNull())


def deltas(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """processed - input of each column, rounded to four places. rows: key, label (input or processed), the columns."""
    a, b = rows.where("label = 'input'").alias("a"), rows.where("label = 'processed'").alias("b")
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}")).select(F.col(f"a.{key}").alias(key), *(F.round(F.col(f"b.{c}") - F.col(f"a.{c}"), 4).alias(f"{c}_delta") for c in columns))


# The sets of genes that the stages report, in their order, with the names of their events; counts of a run with their units.
GENE_SETS = ("duplicate_removed_genes", "transcript_changed_genes", "inframe_updated_genes", "padding_updated_genes", "genes_with_stops", "converted_to_misc_genes")
METRICS = {
    "initial_genes": "genes",
    "duplicate_removed_genes": "genes",
    "genes_after_dedup": "genes",
    "transcript_changed_genes": "genes",
    "transcript_unchanged_genes": "genes",
    "removed_mrnas": "transcripts",
    "genes_after_single_mrna": "genes",
    "inframe_updated_genes": "genes",
    "inframe_unchanged_genes": "genes",
    "genes_after_inframe": "genes",
    "padding_updated_genes": "genes",
    "genes_with_stops": "genes",
    "padding_unchanged_genes": "genes",
    "genes_after_padding": "genes",
    "converted_to_misc_genes": "genes",
    "final_cds_genes": "genes",
    "total_cds_input": "features",
    "total_cds_output": "features",
    "misc_feature_output": "features",
}
EVENTS = {
    "duplicate_removed_genes": "Coordinate duplicates removed",
    "transcript_changed_genes": "Genes changed by mRNA selection",
    "removed_mrnas": "Removed mRNAs",
    "inframe_updated_genes": "Genes changed by frame correction",
    "padding_updated_genes": "CDS boundary-adjusted genes",
    "genes_with_stops": "Genes with stops",
    "converted_to_misc_genes": "Genes converted to misc_feature",
}


def bitmaps(genes: DataFrame, members: DataFrame, sets: tuple[str, ...] = GENE_SETS) -> DataFrame:
    """id, bits (bit i: in set i) and mrnas of each gene, from one shuffle of genes (id, mrnas) and members (set, id).

    A set that isn't listed is an error, and so is a member that is no gene; the latter names ten of them.
    """
    bit = F.lit(None).cast("bigint")
    for i, s in enumerate(sets):
        bit = F.when(F.col("set") == s, F.lit(1 << i).cast("bigint")).otherwise(bit)
    known = F.when(bit.isNull(), F.raise_error(F.concat(F.lit("unknown set of genes: "), F.coalesce("set", F.lit("null")))).cast("bigint")).otherwise(bit)
    rows = genes.select("id", F.lit(0).cast("bigint").alias("bit"), F.coalesce(F.col("mrnas").cast("bigint"), F.lit(0)).alias("mrnas"), F.lit(True).alias("gene"))
    rows = rows.unionByName(members.select("id", known.alias("bit"), F.lit(0).cast("bigint").alias("mrnas"), F.lit(False).alias("gene")))
    out = cut(rows.groupBy("id").agg(F.bit_or("bit").alias("bits"), F.max("mrnas").alias("mrnas"), F.bool_or("gene").alias("gene")), "bitmaps")
    refuse(out.where("not gene").select(F.col("id").cast("string").alias("name")), "members of a set of genes that are no genes of the input")
    return out.drop("gene")


def patterns(maps: DataFrame, sets: tuple[str, ...] = GENE_SETS) -> DataFrame:
    """pattern (the sets' names, joined by a comma; empty: none), sets (their number) and genes: how many genes are in just these sets."""
    held = F.array_compact(F.array(*(F.when(F.col("bits").bitwiseAND(1 << i) != 0, s) for i, s in enumerate(sets))))
    return maps.groupBy("bits").agg(F.count("*").alias("genes")).select(F.array_join(held, ",").alias("pattern"), F.size(held).cast("bigint").alias("sets"), "genes")


def metrics(maps: DataFrame, features: DataFrame) -> DataFrame:
    """One row with the 19 counts of a run. maps: bitmaps(); features: one row a block with its key before and after the conversion of CDS (null: not there).

    A gene that was removed as a duplicate takes no part in later sets, and no count may be below 0: either is an error. Empty tables count 0.
    """
    removed = F.col("bits").bitwiseAND(1) != 0
    refuse(maps.where(removed & (F.col("bits") != 1)).select(F.col("id").cast("string").alias("name")), "genes removed as duplicates that a later stage reports")
    of = {s: F.count_if(F.col("bits").bitwiseAND(1 << i) != 0).alias(s) for i, s in enumerate(GENE_SETS)}
    surplus = F.coalesce(F.sum(F.when(~removed, F.greatest(F.col("mrnas") - 1, F.lit(0).cast("bigint")))), F.lit(0).cast("bigint"))
    counts = maps.agg(F.count("*").alias("initial_genes"), *of.values(), surplus.alias("removed_mrnas"))
    kinds = features.agg(F.count_if(F.col("before") == "CDS").alias("total_cds_input"), F.count_if(F.col("after") == "CDS").alias("total_cds_output"), F.count_if(F.col("after") == "misc_feature").alias("misc_feature_output"))
    c = F.col
    kept = c("initial_genes") - c("duplicate_removed_genes")  # no stage after the first one drops genes
    derived = {
        "genes_after_dedup": kept, "genes_after_single_mrna": kept, "genes_after_inframe": kept, "genes_after_padding": kept,
        "transcript_unchanged_genes": kept - c("transcript_changed_genes"), "inframe_unchanged_genes": kept - c("inframe_updated_genes"),
        "padding_unchanged_genes": kept - c("padding_updated_genes") - c("genes_with_stops"), "final_cds_genes": kept - c("converted_to_misc_genes"),
    }
    row = counts.crossJoin(kinds).withColumns(derived)  # two single rows
    checked = lambda m: F.when(c(m) < 0, F.raise_error(F.lit(f"{m} is below 0")).cast("bigint")).otherwise(c(m)).alias(m)
    return row.select(*(checked(m) for m in METRICS))


def summary(row: DataFrame) -> DataFrame:
    """nth, metric, value and unit of the counts of metrics(), in their order."""
    entries = F.array(*(F.struct(F.lit(i).alias("nth"), F.lit(m).alias("metric"), F.col(m).alias("value"), F.lit(u).alias("unit")) for i, (m, u) in enumerate(METRICS.items(), 1)))
    return row.select(F.explode(entries).alias("e")).select("e.*")


def event_table(row: DataFrame) -> DataFrame:
    """nth, event, label, count and unit of what changed genes on the way."""
    entries = F.array(*(F.struct(F.lit(i).alias("nth"), F.lit(m).alias("event"), F.lit(t).alias("label"), F.col(m).alias("count"), F.lit(METRICS[m]).alias("unit")) for i, (m, t) in enumerate(EVENTS.items(), 1)))
    return row.select(F.explode(entries).alias("e")).select("e.*")
