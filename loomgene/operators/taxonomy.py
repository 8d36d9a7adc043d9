"""The target's place in a taxonomy: resolution by id, name or dataset, lineages, and checks of datasets against it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgene.operators import ranking
from loomgene.operators.evidence import lookup
from loomgene.shared import cut, refuse

# Ranks that a target's name prefers, and the order of ranks that a dataset's name prefers.
SPECIES_LIKE = ("SPECIES", "SUBSPECIES", "STRAIN", "VARIETAS", "FORMA")
DATASET_RANKS = {"DOMAIN": 0, "KINGDOM": 1, "PHYLUM": 2, "CLASS": 3, "ORDER": 4, "CLADE": 5, "FAMILY": 6, "GENUS": 7, "SPECIES": 8}
OTHER_RANK = 20


def dataset_name(dataset: Column) -> Column:
    """The taxon that a dataset of single-copy genes is named for: `a/b/fungi_odb10.2` -> fungi; underscores become spaces."""
    base = F.regexp_extract(F.regexp_replace(dataset, "/+$", ""), "([^/]*)$", 1)
    return F.trim(F.replace(F.regexp_replace(base, r"(?i)_odb\d+.*$", ""), F.lit("_"), F.lit(" ")))


def lifts(records: DataFrame) -> DataFrame:
    """tax_id, power and ancestor: the ancestor 2^power steps up, for all powers that have one. records: tax_id, parent.

    Each power is the one before it joined to itself, so the rounds grow as the log of the depth. A record that is its own parent is a
    root; a parent that isn't a record is an ancestor without further ones. Where a cycle is met it is an error.
    """
    at = cut(records.where("parent is not null and parent <> tax_id").select("tax_id", F.lit(0).alias("power"), F.col("parent").alias("ancestor")).dropDuplicates(["tax_id"]), "lifts")
    out, most = at, at.count().bit_length()
    for power in range(1, most + 2):
        step = at.select(F.col("tax_id").alias("ancestor"), F.col("ancestor").alias("next"))
        at = cut(at.join(step, "ancestor").select("tax_id", F.lit(power).alias("power"), F.col("next").alias("ancestor")), "lifts")
        if at.isEmpty():
            return out
        out = out.unionByName(at)
    refuse(at.select(F.col("tax_id").cast("string").alias("name")), "records of the taxonomy on a cycle, or below one")
    return out


def lineages(ids: DataFrame, table: DataFrame) -> DataFrame:
    """tax_id, ancestor and up (steps; 0: itself) for each of the ids (tax_id). table: lifts(), one join a power.

    Every number of steps is a sum of different powers of two, so each ancestor is met just once.
    """
    out = cut(ids.select("tax_id", F.col("tax_id").alias("ancestor"), F.lit(0).cast("bigint").alias("up")).where("tax_id is not null").distinct(), "lineages")
    top = table.agg(F.max("power")).first()[0]
    for power in range(0 if top is None else top + 1):
        jump = table.where(F.col("power") == power).select(F.col("tax_id").alias("ancestor"), F.col("ancestor").alias("next"))
        higher = out.join(jump, "ancestor").select("tax_id", F.col("next").alias("ancestor"), (F.col("up") + (1 << power)).alias("up"))
        out = cut(out.unionByName(higher), "lineages")
    return out


def rank_ids(lines: DataFrame, records: DataFrame) -> DataFrame:
    """tax_id and ranks: map of rank (lower case) to the nearest ancestor of it, as evidence.taxonomy_relation takes it."""
    ranked = lines.join(records.where("coalesce(rank, '') <> ''").select(F.col("tax_id").alias("ancestor"), F.lower("rank").alias("rank")), "ancestor")
    nearest = ranked.groupBy("tax_id", "rank").agg(F.min_by("ancestor", "up").alias("ancestor"))
    return nearest.groupBy("tax_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("rank", "ancestor")))).alias("ranks"))  # as many as there are ranks


def _by_name(queries: DataFrame, records: DataFrame, order: list[Column]) -> DataFrame:
    """query and tax_id: of the records of that name, in any case, the first in this order. queries: query."""
    known = records.select(F.lower("name").alias("__name"), F.col("tax_id").alias("found"), "rank")
    asked = queries.select("query").where("query <> ''").distinct().withColumn("__name", F.lower("query"))
    return ranking.best(asked.join(known, "__name"), ["query"], order).select("query", F.col("found").alias("tax_id"))


def datasets(evidence: DataFrame, records: DataFrame) -> DataFrame:
    """evidence (sample, nth, dataset, strategy), each dataset and strategy of a sample once, by the least nth, with query, lineage_tax_id and lineage_name (null: unknown)."""
    rows = ranking.best(evidence.where("trim(coalesce(dataset, '')) <> ''").withColumn("dataset", F.trim("dataset")), ["sample", "dataset", "strategy"], [F.asc("nth")])
    rows = rows.select("sample", "nth", "dataset", "strategy", dataset_name(F.col("dataset")).alias("query"))
    found = _by_name(rows, records, [lookup(DATASET_RANKS, F.upper("rank"), OTHER_RANK), F.asc("found")])
    named = records.select(F.col("tax_id").alias("lineage_tax_id"), F.col("name").alias("lineage_name")).dropDuplicates(["lineage_tax_id"])
    return rows.join(found.withColumnRenamed("tax_id", "lineage_tax_id"), "query", "left").join(named, "lineage_tax_id", "left")


def targets(samples: DataFrame, known: DataFrame, records: DataFrame, strict: bool = False) -> DataFrame:
    """sample, source, status, tax_id, name and rank of each sample (sample, taxon_id, scientific_name).

    source: configured_taxon_id if an id above 0 is given (a name isn't asked then), else scientific_name; where that gives no record
    and the sample has datasets, busco_lineage_fallback, by its first dataset. status: resolved or unresolved; with `strict`
    unresolved samples are an error that names ten. known: datasets(). Null ids and names count as not given.
    """
    given = F.coalesce(F.col("taxon_id") > 0, F.lit(False))
    rows = samples.select("sample", given.alias("given"), F.col("taxon_id").cast("bigint").alias("taxon_id"), F.trim(F.coalesce("scientific_name", F.lit(""))).alias("query"))
    own = records.select(F.col("tax_id").cast("bigint").alias("taxon_id"), F.col("tax_id").alias("by_id")).dropDuplicates(["taxon_id"])
    species = F.when(F.upper("rank").isin(*SPECIES_LIKE), 0).otherwise(1)
    named = _by_name(rows.where("not given"), records, [species, F.asc("found")]).withColumnRenamed("tax_id", "by_name")
    first = ranking.best(known, ["sample"], [F.asc("nth"), F.asc("dataset"), F.asc("strategy")]).select("sample", F.col("lineage_tax_id").alias("by_dataset"), F.lit(True).alias("has_dataset"))
    rows = rows.join(own, "taxon_id", "left").join(named, "query", "left").join(first, "sample", "left")
    direct = F.when(F.col("given"), F.col("by_id")).otherwise(F.col("by_name"))
    falls = direct.isNull() & F.coalesce("has_dataset", F.lit(False))
    source = F.when(falls, "busco_lineage_fallback").when(F.col("given"), "configured_taxon_id").otherwise("scientific_name")
    rows = rows.select("sample", source.alias("source"), F.when(falls, F.col("by_dataset")).otherwise(direct).alias("tax_id"))
    out = rows.join(records.select("tax_id", "name", "rank").dropDuplicates(["tax_id"]), "tax_id", "left")
    out = out.select("sample", "source", F.when(F.col("tax_id").isNull(), "unresolved").otherwise("resolved").alias("status"), "tax_id", "name", "rank")
    if strict:
        out = cut(out, "targets")
        refuse(out.where("tax_id is null").select(F.col("sample").cast("string").alias("name")), "no target taxonomy could be resolved for samples")
    return out


def crosschecks(resolved: DataFrame, known: DataFrame, lines: DataFrame, strict: bool = False) -> DataFrame:
    """known with concordance and shared_tax_id, the lowest ancestor that the target and the dataset's taxon have in common.

    concordance: consistent if the dataset's taxon is the target or one of its ancestors, else mismatch; unresolved where either is
    unknown. With `strict` a mismatch is an error that names ten samples. resolved: targets(); lines: lineages() of the taxa of both.
    """
    rows = known.join(resolved.select("sample", F.col("tax_id").alias("target")), "sample", "left")
    pairs = rows.where("target is not null and lineage_tax_id is not null").select("target", "lineage_tax_id").distinct()
    up = lambda k: lines.select(F.col("tax_id").alias(k), "ancestor", F.col("up").alias(f"{k}_up"))
    # pairs of taxa, not of samples, meet their ancestors
    common = pairs.join(up("target"), "target").join(up("lineage_tax_id"), ["lineage_tax_id", "ancestor"])
    shared = common.groupBy("target", "lineage_tax_id").agg(F.min_by("ancestor", "target_up").alias("shared_tax_id"))
    state = F.when(F.col("target").isNull() | F.col("lineage_tax_id").isNull(), "unresolved").when(F.col("shared_tax_id") == F.col("lineage_tax_id"), "consistent").otherwise("mismatch")
    out = rows.join(shared, ["target", "lineage_tax_id"], "left").withColumn("concordance", state)
    out = out.select("sample", "nth", "dataset", "strategy", "query", "lineage_tax_id", "lineage_name", "concordance", "shared_tax_id")
    if strict:
        out = cut(out, "crosschecks")
        refuse(out.where("concordance = 'mismatch'").select(F.col("sample").cast("string").alias("name")), "target taxonomies in conflict with a dataset's lineage")
    return out


def resolve(samples: DataFrame, evidence: DataFrame, records: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """targets() with ranks (rank_ids()), and crosschecks(). records: tax_id, parent, name, rank."""
    known = cut(datasets(evidence, records), "datasets")
    resolved = cut(targets(samples, known, records, strict), "targets")
    taxa = resolved.select("tax_id").unionByName(known.select(F.col("lineage_tax_id").alias("tax_id")))
    lines = lineages(taxa, cut(lifts(records), "lifts"))
    return resolved.join(rank_ids(lines, records), "tax_id", "left"), crosschecks(resolved, known, lines, strict)
