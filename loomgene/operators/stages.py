"""Stages that clean a feature table. Each takes and gives feature rows (schemas.FEATURES)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgene.functions import attributes as A
from loomgene.operators import graph, intervals, models, ranking, terminal, traversal
from loomgene.shared import cut, refuse

UTRS = ("UTR", "five_prime_UTR", "three_prime_UTR", "5UTR", "3UTR")


def repair_semicolons(lines: DataFrame) -> DataFrame:
    """Lines of a feature table with repaired attributes, and the flags trailing and glued."""
    f = F.split("line", "\t", -1)
    fixed = A.repair(F.get(f, F.lit(8)))
    new = F.concat_ws("\t", F.slice(f, 1, 8), F.coalesce(fixed["text"], F.raise_error(F.concat(F.lit("attributes begin without a key: "), F.col("line"))).cast("string")))
    whole = (F.col("section") == "record") & (F.size(f) == 9)
    return lines.select("line_no", "section", F.when(whole, new).otherwise(F.col("line")).alias("line"), (whole & fixed["trailing"]).alias("trailing"), (whole & fixed["glued"]).alias("glued"))


def trim_to_bounds(features: DataFrame, sequences: DataFrame) -> DataFrame:
    """Features cut to their sequence; an unknown sequence is an error."""
    lengths = sequences.select(F.col("id").alias("seqid"), F.length("sequence").cast("bigint").alias("length"))
    rows = features.join(lengths, "seqid", "left")
    known = F.coalesce("length", F.raise_error(F.concat(F.lit("feature on an unknown sequence: "), F.col("seqid"))).cast("bigint"))
    rows = rows.withColumns({"start": F.greatest(F.col("start"), F.lit(1)), "end": F.least(F.col("end"), known)})
    return rows.where("start <= end").select(features.columns)


def without_subtrees(features: DataFrame, seeds: DataFrame) -> DataFrame:
    """Features without the seeds (id) and what loses all its parents by that; of other rows the lost parents are struck out."""
    edges = features.where("id is not null").select(F.col("id").alias("child"), F.explode("parents").alias("parent"))
    gone = cut(graph.removed(edges, seeds), "gone")
    lost = features.select("row_no", F.explode("parents").alias("id")).join(gone, "id", "left_semi").groupBy("row_no").agg(F.collect_set("id").alias("lost"))
    return _without_links(features.join(gone, "id", "left_anti"), lost)


def isoform_parts(features: DataFrame) -> DataFrame:
    """gene, transcript, kind, start, end: all transcripts of genes and their coding and untranslated parts."""
    rows = features.where(F.col("type").isin(*models.TRANSCRIPTS) & F.col("id").isNotNull()).select(F.col("id").alias("transcript"), F.explode("parents").alias("gene"), F.lit("transcript").alias("kind"), "start", "end")
    kind = F.when(F.col("type") == "CDS", "CDS").when(F.col("type").isin("five_prime_UTR", "three_prime_UTR"), "UTR")
    parts = features.select(F.explode("parents").alias("transcript"), kind.alias("kind"), "start", "end").where("kind is not null")
    return rows.unionByName(rows.select("gene", "transcript").distinct().join(parts, "transcript"))


def one_isoform(features: DataFrame) -> DataFrame:
    """Features with one transcript a gene. A transcript stays if any of its genes chose it, with those genes alone as its parents."""
    parts = isoform_parts(features)
    chosen = cut(ranking.isoforms(parts).select("gene", "transcript"), "chosen")
    seeds = parts.select("transcript").distinct().join(chosen, "transcript", "left_anti").select(F.col("transcript").alias("id"))
    links = features.where(F.col("type").isin(*models.TRANSCRIPTS)).select("row_no", F.col("id").alias("transcript"), F.explode("parents").alias("gene"))
    others = links.join(chosen, ["gene", "transcript"], "left_anti").join(chosen.select("transcript"), "transcript", "left_semi")
    return without_subtrees(_without_links(features, others.groupBy("row_no").agg(F.collect_set("gene").alias("lost"))), seeds)


def _without_links(features: DataFrame, lost: DataFrame) -> DataFrame:
    """Features whose listed parents (row_no, lost) are struck out; rows that lose all of them go."""
    rows = features.join(lost, "row_no", "left")
    ids = F.coalesce("lost", F.array().cast("array<string>"))
    left, touched = F.array_except("parents", ids), F.col("lost").isNotNull()
    rows = rows.where((F.size("parents") == 0) | (F.size(left) > 0))
    text = F.when(touched, A.without_parents(F.col("attributes_text"), ids)).otherwise(F.col("attributes_text"))
    return rows.withColumns({"attributes_text": text, "parents": F.when(touched, left).otherwise(F.col("parents"))}).select(features.columns)


def coordinate_duplicates(features: DataFrame, sequences: DataFrame, code: int = 1) -> DataFrame:
    """Pairs of genes with equal coordinates, by the best transcript of each; see ranking.duplicates."""
    genes = features.where("type = 'gene' and id is not null").select(F.col("id").alias("gene"), "row_no", "seqid", "start", "end", "strand")
    of = features.where(F.col("type").isin(*models.TRANSCRIPTS)).select(F.col("id").alias("transcript_id"), F.explode("parents").alias("gene"))
    lengths = sequences.select("id", F.length("sequence").cast("bigint").alias("length"))
    found = models.candidates(models.spliced(models.cds_models(features), sequences), lengths, code)
    order = [F.desc("valid"), F.asc("stops"), F.desc("completeness"), F.asc("ambiguous"), F.desc("length"), F.asc("introns"), F.asc("transcript_id")]
    best = ranking.best(of.join(found, "transcript_id"), ["gene"], order)
    scored = genes.join(best.drop("transcript_id"), "gene", "left")
    none = {"valid": False, "stops": 1 << 40, "completeness": 0, "ambiguous": 1 << 40, "length": 0, "introns": 1 << 40}
    return ranking.duplicates(scored.na.fill(none), ["seqid", "start", "end", "strand"])


def drop_coordinate_duplicates(features: DataFrame, sequences: DataFrame, code: int = 1) -> DataFrame:
    return without_subtrees(features, coordinate_duplicates(features, sequences, code).select(F.col("removed").alias("id")))


def with_cds(features: DataFrame, changed: DataFrame) -> DataFrame:
    """Features with the CDS rows of models rewritten; exons that reach farther than the CDS do stay, those equal to a CDS follow it; transcripts and genes shrink to their parts.

    changed: transcript_id and cds as models have them.
    """
    new = changed.select("transcript_id", F.explode("cds").alias("c")).select("transcript_id", F.col("c.row_no").alias("row_no"), F.col("c.start").alias("n_start"), F.col("c.end").alias("n_end"), F.col("c.phase").alias("n_phase"))
    of = features.where(F.col("type").isin("CDS", "exon")).select("row_no", "type", "start", "end", F.explode("parents").alias("transcript_id")).join(changed.select("transcript_id"), "transcript_id", "left_semi")
    cds = of.where("type = 'CDS'").join(new, ["row_no", "transcript_id"], "left")
    exon = of.where("type = 'exon'").alias("x").join(cds.alias("c"), ["transcript_id", "start", "end"]).select("x.row_no", "transcript_id", "c.n_start", "c.n_end", F.lit(None).cast("string").alias("n_phase"))
    moved = cds.select("row_no", "transcript_id", "n_start", "n_end", "n_phase").unionByName(exon)
    moved = moved.groupBy("row_no").agg(F.min("n_start").alias("n_start"), F.max("n_end").alias("n_end"), F.max("n_phase").alias("n_phase"))
    rows = features.join(moved.withColumn("moved", F.lit(True)), "row_no", "left").where("moved is null or n_start is not null")
    rows = rows.withColumns({"start": F.coalesce("n_start", "start"), "end": F.coalesce("n_end", "end"), "phase": F.coalesce("n_phase", "phase")})
    return terminal.rebuilt(synchronise(rows.select(features.columns)), changed.select(F.col("transcript_id").alias("id")))


def _bounds(features: DataFrame, parts: DataFrame) -> DataFrame:
    extent = parts.groupBy("id").agg(*(f(F.when(F.col("type") == "exon", F.col(c))).alias(f"x_{c}") for f, c in ((F.min, "start"), (F.max, "end"))), F.min("start").alias("p_start"), F.max("end").alias("p_end"))
    rows = features.join(extent, "id", "left")
    return rows.withColumns({"start": F.coalesce("x_start", "p_start", "start"), "end": F.coalesce("x_end", "p_end", "end")}).select(features.columns)


def synchronise(features: DataFrame) -> DataFrame:
    """Transcripts get the extent of their exons, else of CDS and UTR; genes that of their transcripts; other parts but codons and introns are cut to their transcript."""
    kinds = ["CDS", "exon", *UTRS]
    own = ["gene", "CDS", "exon", "pseudogenic_exon", "intron", *models.TRANSCRIPTS, *traversal.CODONS]
    parts = features.where(F.col("type").isin(*kinds)).select(F.explode("parents").alias("id"), "type", "start", "end")
    out = _bounds(features, parts)
    transcripts = out.where(F.col("type").isin(*models.TRANSCRIPTS))
    out = _bounds(out, transcripts.select(F.explode("parents").alias("id"), F.lit("transcript").alias("type"), "start", "end"))
    bound = transcripts.groupBy("id").agg(F.min("start").alias("t_start"), F.max("end").alias("t_end"))
    limit = out.where(~F.col("type").isin(*own)).select("row_no", F.explode("parents").alias("id")).join(bound, "id").groupBy("row_no").agg(F.min("t_start").alias("t_start"), F.max("t_end").alias("t_end"))
    cut_rows = out.join(limit, "row_no", "left").withColumns({"start": F.greatest("start", F.coalesce("t_start", "start")), "end": F.least("end", F.coalesce("t_end", "end"))})
    return cut_rows.where("start <= end").select(features.columns)


def into_frame(features: DataFrame) -> DataFrame:
    changed = models.in_frame(models.cds_models(features)).where("changed")
    return with_cds(features, cut(changed.select("transcript_id", "cds"), "frame"))


def padded_and_stops(features: DataFrame, sequences: DataFrame, code: int = 1) -> tuple[DataFrame, DataFrame]:
    """Padded features, and the transcripts (transcript_id) that hold stops whatever the padding and so stayed as they were."""
    found = models.spliced(models.cds_models(features), sequences)
    done = cut(models.apply_padding(found, models.padding_decisions(found, code)).where("status <> 'unchanged'").select("transcript_id", "cds", "status"), "padding")
    return with_cds(features, done.where("status = 'padded'").select("transcript_id", "cds")), done.where("status = 'stops'").select("transcript_id").distinct()


def padded(features: DataFrame, sequences: DataFrame, code: int = 1) -> DataFrame:
    return padded_and_stops(features, sequences, code)[0]


def padded_loci(features: DataFrame, prefix: str, width: int, label: str = "") -> DataFrame:
    """Features whose identifiers PREFIX_<n> (with a label also LABEL<n>) have numbers of at least `width` digits.

    With a label, two ids that become one are an error, which names up to ten.
    """
    if label:
        ids = features.where("id is not null").select("id", A.pad_number(F.col("id"), prefix, width, label).alias("padded"))
        refuse(ids.groupBy("padded").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a <> b").select(F.concat_ws(" ", "padded", F.lit("from"), "a", F.lit("and"), "b").alias("name")), "padding makes one id of two")
    rows = features.withColumn("attributes_text", A.pad_loci(F.col("attributes_text"), prefix, width, label))
    text = F.col("attributes_text")
    return rows.withColumns({"attributes": A.parse(text), "id": A.percent_decode(A.raw_value(text, "ID")), "parents": A.parents(text)}).select(features.columns)


def replaced_products(annotation: DataFrame, patterns: list[str], replacement: str) -> DataFrame:
    """Descriptions without returns, hard spaces, blanks around and 'Belongs to the ' before; those that a pattern fits whole (any case) become the replacement."""
    if not any(patterns):
        return annotation
    clean = F.regexp_replace(F.translate("Description", "\r\u00a0", ""), r"^\s+|\s+$", "")
    clean = F.regexp_replace(clean, "^Belongs to the ", "")
    hit = clean.rlike(rf"(?i)\A(?:{'|'.join(p for p in patterns if p)})\n?\z")
    return annotation.withColumn("Description", F.when(hit, F.lit(replacement)).otherwise(clean))


def shift_gaps(features: DataFrame, edits: DataFrame) -> DataFrame:
    """Features on sequences whose runs of N were rewritten. edits: seqid, start0, old_len, new_len."""
    both = features.select("row_no", "seqid", F.explode(F.create_map(F.lit("start"), F.col("start"), F.lit("end"), F.col("end"))).alias("kind", "position"))
    moved = intervals.shift(both, edits, "seqid").groupBy("row_no").agg(*(F.max(F.when(F.col("kind") == k, F.col("shifted"))).alias(f"new_{k}") for k in ("start", "end")))
    bad = F.raise_error(F.concat(F.lit("a feature lies in a run that vanished, row "), F.col("row_no").cast("string"))).cast("bigint")
    rows = features.join(moved, "row_no").withColumns({"start": F.when(F.col("new_start") > F.col("new_end"), bad).otherwise(F.col("new_start")), "end": F.col("new_end")})
    return rows.select(features.columns)


def containment_issues(features: DataFrame) -> DataFrame:
    """row_no and issue: outside_parent, codon_not_three_bases, utr_overlaps_cds."""
    child = features.select("row_no", "seqid", "type", "start", "end", F.explode("parents").alias("id"))
    parent = features.where("id is not null").select("id", "seqid", F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    known = child.join(parent.select("id", "seqid").distinct(), ["id", "seqid"], "left_semi")
    outside = intervals.outside(known, parent, ["id", "seqid"]).select("row_no", F.lit("outside_parent").alias("issue"))
    codon = features.where(F.col("type").isin("start_codon", "stop_codon")).groupBy("parents", "type").agg(F.sum(F.col("end") - F.col("start") + 1).alias("bases"), F.min("row_no").alias("row_no")).where("bases <> 3").select("row_no", F.lit("codon_not_three_bases").alias("issue"))
    cds = child.where("type = 'CDS'").select("id", "seqid", F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    utr = child.where(F.col("type").isin(*UTRS)).join(cds, ["id", "seqid"]).where("start <= r_end and r_start <= end").select("row_no", F.lit("utr_overlaps_cds").alias("issue"))
    return outside.unionByName(codon).unionByName(utr).distinct()


def hierarchical_order(features: DataFrame) -> DataFrame:
    """Adds depth and visit, which order the rows that begin at one base of a sequence: rows of one depth follow their parents' order.

    Parents are those that begin at the same base; the order is that of a queue which begins with the rows without such parents, in the
    order of row_no, and takes in a row's children when it is served. A row of several parents follows the last of them in row_no.
    """
    rows = features.select("row_no", "seqid", "start", "id", "parents")
    parent = rows.where("id is not null").select("seqid", "start", F.col("id").alias("parent"), F.col("row_no").alias("p_row"))
    up = rows.select("row_no", "seqid", "start", F.explode("parents").alias("parent")).join(parent, ["seqid", "start", "parent"]).where("row_no <> p_row").groupBy("row_no").agg(F.max("p_row").alias("up"))
    placed = graph.tours(rows.select(F.col("row_no").alias("id"), F.col("row_no").alias("key")).join(up.withColumnRenamed("row_no", "id"), "id", "left"))
    # of rows of one depth, trees by their roots and then depth-first numbers give the order of a queue
    known = features.join(placed.select(F.col("id").alias("row_no"), "depth", F.struct("root", "nth").alias("visit")), "row_no", "left")
    last = F.struct(F.col("row_no").alias("root"), F.lit(0).cast("bigint").alias("nth"))  # rows on a cycle come last
    return known.withColumns({"depth": F.coalesce("depth", F.lit(1 << 40)), "visit": F.coalesce("visit", last)}).select(*features.columns, "depth", "visit")


def annotation_table(features: DataFrame, prefix: str = "", default: str = "hypothetical protein") -> DataFrame:
    """ID, Description, Locus_tag of each transcript: its product, else the first product of its CDS, else the default."""
    rows = features.where(F.col("type").isin(*models.TRANSCRIPTS))
    cds = features.where("type = 'CDS'").select("row_no", A.first_of(F.col("attributes"), "product").alias("p"), F.explode("parents").alias("id")).where("p is not null").groupBy("id").agg(F.min_by("p", "row_no").alias("cds_product"))
    gene = F.coalesce(A.first_of(F.col("attributes"), "locus_tag"), F.get("parents", F.lit(0)), F.col("id"))
    tag = F.when(F.lit(prefix == "") | (gene == prefix) | gene.startswith(prefix + "_"), gene).otherwise(F.concat(F.lit(prefix + "_"), gene))
    return rows.join(cds, "id", "left").select(F.col("id").alias("ID"), F.coalesce(A.first_of(F.col("attributes"), "product"), "cds_product", F.lit(default)).alias("Description"), tag.alias("Locus_tag"), "row_no")
