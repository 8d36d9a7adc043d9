"""The whole way from a genome and its feature table to a submission."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgene.functions import sequence as S
from loomgene.operators import flow, models, render, review, stages, traversal
from loomgene.shared import cut, numbered
from loomgene.sources import fasta, gff3, tables


@dataclass(frozen=True)
class Options:
    locus_prefix: str = "LOCUS"
    locus_digits: int = 6
    code: int = 1
    gap_target: int | None = 100
    gap_least: int = 80
    gap_most: int = 120
    gap_feature_least: int = 50
    fix_frame: bool = True
    fix_padding: bool = True
    replace_products: list[str] = field(default_factory=list)
    replace_with: str = "hypothetical protein"
    gap_policy: str = "misc_feature"
    least_intron: int = 10
    infer_boundaries: bool = True
    mrna: bool = True
    omit_redundant_mrna: bool = False
    retain_utrs: bool = False
    protein_ids: DataFrame | None = None
    header: render.Header | None = None
    source: list[tuple[str, str]] = field(default_factory=lambda: render.source("unknown"))


def _set(name: str, genes: DataFrame) -> DataFrame:
    """Members of a set of genes, which go by the rows of the table that are theirs, as padding renames loci."""
    return genes.select(F.lit(name).alias("set"), "id")


def _moved(before: DataFrame, after: DataFrame) -> DataFrame:
    """transcript_id of transcripts with CDS rows that moved, changed their phase or went. Both tables hold the ids of `before`."""
    rows = lambda df: df.where("type = 'CDS'").select("row_no", "start", "end", "phase", F.explode("parents").alias("transcript_id"))
    return rows(before).exceptAll(rows(after)).select("transcript_id").distinct()


def _genes_of(features: DataFrame, transcripts: DataFrame) -> DataFrame:
    """id (row_no of the gene) and transcript_id of the genes of these transcripts."""
    of = features.where(F.col("type").isin(*models.TRANSCRIPTS)).select(F.col("id").alias("transcript_id"), F.explode("parents").alias("gene")).join(transcripts, "transcript_id", "left_semi")
    return of.join(features.where("type = 'gene'").select(F.col("id").alias("gene"), F.col("row_no").alias("id")), "gene").select("id", "transcript_id").distinct()


def run(sequences: DataFrame, features: DataFrame, options: Options = Options()) -> dict[str, DataFrame]:
    """sequences, features, annotation, body lines, review, the count of each stage that may drop rows, the events of the rendering, and of the run its 19 counts (metrics), what
    changed genes (changes) and how many genes are in just which sets (patterns), as DataFrames; stages cut their lineage.

    features come in the order of row_no, which puts parents before children. CDS that hold stops whatever the padding become misc_feature.
    """
    o, counts = options, []

    def stage(name: str, df: DataFrame) -> DataFrame:
        df = cut(df, name)
        counts.append(df.agg(F.count_if(F.col("type") == "gene").alias("genes"), F.count_if(F.col("type").isin(*models.TRANSCRIPTS)).alias("transcripts"), F.count("*").alias("rows")).select(F.lit(len(counts)).alias("step"), F.lit(name).alias("stage"), "*"))
        return df

    features = stage("input", features)
    sequences = cut(sequences.withColumn("sequence", S.trim_terminal_n(F.upper("sequence"))).where(F.length("sequence") > 0), "trimmed")
    features = stage("trim_bounds", stages.trim_to_bounds(features, sequences))
    if o.gap_target is not None:
        limits = (o.gap_target, o.gap_least, o.gap_most)
        edits = sequences.select(F.col("id").alias("seqid"), F.explode(S.gap_edits(F.col("sequence"), *limits)).alias("e")).select("seqid", "e.*")
        features = stage("normalise_gaps", stages.shift_gaps(features, edits))
        sequences = cut(sequences.withColumn("sequence", S.normalise_gaps(F.col("sequence"), *limits)), "normalised")
    links = features.where(F.col("type").isin(*models.TRANSCRIPTS)).select(F.explode("parents").alias("id")).groupBy("id").agg(F.count("*").alias("mrnas"))
    genes = cut(features.where("type = 'gene'").select("id", F.col("row_no").alias("gene")).join(links, "id", "left").select(F.col("gene").alias("id"), "mrnas"), "genes")
    features = stage("drop_duplicates", stages.drop_coordinate_duplicates(features, sequences, o.code))
    kept = features.where("type = 'gene'").select(F.col("row_no").alias("id"))
    sets = _set("duplicate_removed_genes", genes.join(kept, "id", "left_anti"))
    sets = sets.unionByName(_set("transcript_changed_genes", genes.where("mrnas > 1").join(kept, "id", "left_semi")))
    features = stage("one_isoform", stages.one_isoform(features))
    features = cut(stages.padded_loci(features, o.locus_prefix, o.locus_digits), "padded_loci")
    if o.fix_frame:
        before, features = features, stage("into_frame", stages.into_frame(features))
        sets = sets.unionByName(_set("inframe_updated_genes", _genes_of(before, _moved(before, features))))
    held = None
    if o.fix_padding:
        before = features
        features, stops = stages.padded_and_stops(features, sequences, o.code)
        features = stage("padding", features)
        sets = sets.unionByName(_set("padding_updated_genes", _genes_of(before, _moved(before, features))))
        held = cut(_genes_of(before, stops), "genes_with_stops")
        sets = sets.unionByName(_set("genes_with_stops", held))
    order = ["seqid", "start", "depth", "visit", "row_no"]
    placed = numbered(stages.hierarchical_order(features), order, "place")
    features = cut(placed.withColumn("row_no", F.col("place").cast("bigint")).select(features.columns), "ordered")
    annotation = stages.replaced_products(stages.annotation_table(features, o.locus_prefix), o.replace_products, o.replace_with)
    gaps = sequences.select(F.col("id").alias("seqid"), S.n_runs(F.col("sequence")).alias("gaps"))
    runs = cut(sequences.select(F.col("id").alias("seqid"), F.explode(S.n_runs(F.col("sequence"))).alias("g")).select("seqid", F.col("g.start").alias("r_start"), F.col("g.end").alias("r_end")), "runs")
    others, named = traversal.blocks(features, sequences, runs, annotation.drop("row_no"), o.locus_prefix + "_", o.code, o.gap_policy, o.retain_utrs)
    coding = traversal.coding(named, sequences, runs, annotation.drop("row_no"), table=o.code, infer=o.infer_boundaries, gap_policy=o.gap_policy, least_intron=o.least_intron, protein_ids=o.protein_ids)
    made = cut(others.unionByName(coding), "made_blocks")
    events = traversal.event_counts(made, named)
    gaps = render.gap_blocks(sequences.select(F.col("id").alias("seqid"), S.n_runs(F.col("sequence")).alias("gaps")), o.gap_feature_least)
    blocks = (made if o.mrna else made.where("feature <> 'mRNA'")).drop("row_no", "events", "locus")
    blocks = blocks.unionByName(gaps.withColumn("visit", F.lit(None).cast(blocks.schema["visit"].dataType)))
    # written, so that the numbers of blocks are the same wherever they are read
    blocks = cut(review.with_locus(blocks).withColumn("block_no", F.monotonically_increasing_id()), "blocks")
    if o.fix_padding:
        loci = annotation.join(stops.withColumnRenamed("transcript_id", "ID"), "ID", "left_semi").select(F.col("Locus_tag").alias("locus"))
        blocks = cut(review.stops_to_misc(blocks, loci), "converted")
        tags = annotation.select(F.col("ID").alias("transcript_id"), F.col("Locus_tag").alias("locus"))
        converted = held.join(tags, "transcript_id").join(blocks.where("changed"), "locus", "left_semi")
        sets = sets.unionByName(_set("converted_to_misc_genes", converted))
    else:
        blocks = blocks.withColumn("changed", F.lit(False))
    kinds = blocks.select(F.when(F.col("changed"), "CDS").otherwise(F.col("feature")).alias("before"), F.col("feature").alias("after"))
    maps = flow.bitmaps(genes, sets)
    moved = cut(flow.metrics(maps, kinds), "metrics")
    blocks = blocks.drop("changed")
    if o.omit_redundant_mrna:
        blocks = blocks.join(review.redundant_mrna(blocks), ["entry", "block_no"], "left_anti")
    blocks = cut(blocks, "final_blocks")
    body = render.body(sequences, blocks.drop("locus", "block_no"), o.source)
    totals = counts[0]
    for c in counts[1:]:
        totals = totals.unionByName(c)
    return {"sequences": sequences, "features": features, "annotation": annotation, "body": body, "review": review.block_warnings(blocks), "counts": totals, "events": events, "metrics": flow.summary(moved), "changes": flow.event_table(moved), "patterns": flow.patterns(maps)}


def package(spark: SparkSession, genome: str, table: str, out: str, options: Options = Options()) -> None:
    """Reads the two files, repairs semicolons, and writes sequences, features, annotation lines (the header first), review and counts below `out`."""
    lines = cut(stages.repair_semicolons(gff3.lines(spark, table)), "repaired")
    made = run(fasta.read(spark, genome), gff3.features(lines), options)
    fasta.write(made["sequences"], f"{out}/sequences", submission=True)
    gff3.write(made["features"], f"{out}/features", lines)
    body = made["body"].select(F.lit(1).alias("part"), F.col("seq_no").alias("at"), "block", "line_in_block", "value")
    if options.header is not None:
        head = render.header(spark, options.header)
        body = body.unionByName(head.select(F.lit(0).alias("part"), F.col("line_no").alias("at"), F.lit(0).alias("block"), F.lit(0).alias("line_in_block"), "value"))
    body.orderBy("part", "at", "block", "line_in_block").select("value").write.text(f"{out}/annotation")
    tables.write_tsv(made["review"].orderBy("entry", "warning", "locus_tag", "location", "detail"), f"{out}/review")
    made["counts"].orderBy("step").write.json(f"{out}/counts")
    made["events"].orderBy("entry", "event").write.json(f"{out}/events")
    for name in ("metrics", "changes"):
        tables.write_tsv(made[name].orderBy("nth").drop("nth"), f"{out}/{name}")
