"""Review and update of submission rows, and checks of inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgene.operators import organelles

SHORT_CDS = 93
# Features that count beside an mRNA of a locus, and qualifiers of CDS that keep their mRNA.
LOCUS_FEATURES = ("mRNA", "CDS", "tRNA", "rRNA", "tmRNA", "ncRNA", "misc_RNA", "misc_feature")
EXCEPTIONS = ("exception", "pseudo", "pseudogene", "trans_splicing")
_PART = r"<?\d+(?:\.\.>?\d+)?"
#: Locations that are read: parts on one sequence, joined, each or all of them on the other strand.
_READABLE = rf"^(?:complement\()?(?:join\()?(?:complement\({_PART}\)|{_PART})(?:,(?:complement\({_PART}\)|{_PART}))*\)*$"


def blocks(rows: DataFrame) -> DataFrame:
    """One row a block: entry, block_no, feature, location, qualifiers (array<struct<key, value>> in order), locus."""
    pair = F.struct("line_no", F.col("qualifier").alias("key"), "value")
    out = rows.where("block_no is not null").groupBy("entry", "block_no").agg(F.first("feature", True).alias("feature"), F.first("location", True).alias("location"), F.array_sort(F.collect_list(pair)).alias("qualifiers"))
    return with_locus(out)


def with_locus(found: DataFrame) -> DataFrame:
    """Blocks with their first locus_tag as locus."""
    return found.withColumn("locus", F.try_element_at(F.filter("qualifiers", lambda q: q["key"] == "locus_tag"), F.lit(1))["value"])


def segments(found: DataFrame) -> DataFrame:
    """A row for each part of a readable location, with its strand; fuzzy: an end of it is open."""
    spans = F.regexp_extract_all("location", F.lit(rf"((?:complement\()?{_PART})"), F.lit(1))
    rows = found.where(F.col("location").rlike(_READABLE)).select("*", F.explode(spans).alias("s"))
    minus = F.startswith(F.col("location"), F.lit("complement(")) | F.col("s").contains("complement(")
    plain = F.regexp_replace("s", r"complement\(|[<>]", "")
    return rows.withColumns({"strand": F.when(minus, "-").otherwise("+"), "start": F.substring_index(plain, "..", 1).cast("bigint"), "end": F.substring_index(plain, "..", -1).cast("bigint"), "fuzzy": F.col("s").rlike("[<>]")}).drop("s")


def _value(key: str):
    return F.try_element_at(F.filter("qualifiers", lambda q: q["key"] == key), F.lit(1))["value"]


def warnings(rows: DataFrame) -> DataFrame:
    """block_warnings() of submission rows, and entries of a WGS submission without a genome coverage (COMMON, if it is all of them)."""
    found = blocks(rows)
    has = lambda feature, key: F.max((F.col("feature") == feature) & F.exists("qualifiers", lambda q: (q["key"] == key) & (q["value"] != "")))
    wgs = F.max((F.col("feature") == "DATATYPE") & F.exists("qualifiers", lambda q: (q["key"] == "type") & (q["value"] == "WGS")))
    entries = found.groupBy("entry").agg(has("ST_COMMENT", "Genome Coverage").alias("covered"), wgs.alias("wgs"))
    common = entries.where("entry = 'COMMON'").agg(F.coalesce(F.bool_or("wgs"), F.lit(False)).alias("is_wgs"), F.coalesce(F.bool_or("covered"), F.lit(False)).alias("all_covered"))
    own = entries.where("entry <> 'COMMON'").crossJoin(F.broadcast(common)).where("is_wgs")  # one row
    missing = own.where("not all_covered and not covered")
    counts = own.agg(F.count("*").alias("entries"), F.count_if(~F.col("all_covered") & ~F.col("covered")).alias("missing"))
    rows = missing.crossJoin(F.broadcast(counts)).select(F.when(F.col("entries") == F.col("missing"), "COMMON").otherwise(F.col("entry")).alias("entry")).distinct()  # one row
    empty = F.lit("")
    return block_warnings(found).unionByName(rows.select(F.lit("missing_genome_coverage").alias("warning"), "entry", F.lit("ST_COMMENT").alias("feature"), empty.alias("locus_tag"), empty.alias("location"), F.lit("Set Genome Coverage to a depth such as 130x or to Unknown").alias("detail")))


def block_warnings(found: DataFrame) -> DataFrame:
    """warning, entry, feature, locus_tag, location and detail of blocks (entry, block_no, feature, location, qualifiers, locus).

    Of tRNA: a gene symbol that names another amino acid than the product. Of CDS: locations and codon starts that can't be
    read, fewer than SHORT_CDS coding bases, parts of one base, parts that several loci of an entry share; pseudogenes have none of the latter.
    """
    locus = F.coalesce("locus", F.lit(""))
    row = lambda df, kind, place, detail, who=locus: df.select(F.lit(kind).alias("warning"), "entry", "feature", who.alias("locus_tag"), place.alias("location"), detail.alias("detail"))
    named = organelles.trna_amino_acids(_value("gene"), _value("product"))
    trna = found.where("feature = 'tRNA'").withColumn("aa", named).where("aa.gene <> aa.product")
    out = row(trna, "trna_gene_product_mismatch", F.col("location"), F.concat(_value("gene"), F.lit(" indicates tRNA-"), F.col("aa.gene"), F.lit("; product="), _value("product")))
    cds = found.where("feature = 'CDS'").withColumns({"codon_start": F.coalesce(F.nullif(_value("codon_start"), F.lit("")), F.lit("1")), "pseudo": F.exists("qualifiers", lambda q: q["key"].isin("pseudo", "pseudogene"))})
    seg = segments(cds).where("not pseudo")
    readable = F.col("location").rlike(_READABLE)
    out = out.unionByName(row(cds.where(~readable), "unreviewed_cds_location", F.col("location"), F.lit("Review the CDS location with the DDBJ validators")))
    known = F.col("codon_start").isin("1", "2", "3")
    out = out.unionByName(row(cds.where(readable & ~F.col("pseudo") & ~known), "unreviewed_codon_start", F.col("location"), F.concat(F.lit("Unexpected codon_start="), F.col("codon_start"))))
    seg = seg.where(known)
    bases = seg.groupBy("entry", "block_no").agg(F.sum(F.col("end") - F.col("start") + 1).alias("bases"), F.bool_or("fuzzy").alias("open"), *(F.first(c, True).alias(c) for c in ("feature", "location", "locus", "codon_start")))
    coding = F.col("bases") - F.col("codon_start").cast("bigint") + 1
    partial = F.when((F.col("codon_start") != "1") | F.col("open"), " (partial CDS)").otherwise("")
    short = bases.where(coding < SHORT_CDS)
    out = out.unionByName(row(short, "short_cds", F.col("location"), F.concat(coding.cast("string"), F.lit(f" coding bp; review against the {SHORT_CDS} bp threshold"), partial)))
    span = F.when(F.col("start") == F.col("end"), F.col("end").cast("string")).otherwise(F.concat_ws("..", "start", "end"))
    label = F.when(F.col("strand") == "-", F.concat(F.lit("complement("), span, F.lit(")"))).otherwise(span)
    out = out.unionByName(row(seg.where("start = end"), "single_base_cds_segment", label, F.concat(F.lit("CDS "), F.col("location"))))
    shared = seg.where("locus <> '' and not fuzzy").groupBy("entry", "feature", "strand", "start", "end").agg(F.collect_set("locus").alias("loci")).where("size(loci) > 1")
    return out.unionByName(row(shared, "shared_cds_segment", label, F.lit("Exact same-strand segment at distinct loci"), F.array_join(F.array_sort("loci"), ",")))


def stops_to_misc(found: DataFrame, loci: DataFrame) -> DataFrame:
    """Blocks of CDS at the given loci (locus) become misc_feature: product turns into a note, transl_table and codon_start go."""
    listed = found.join(loci.select("locus", F.lit(True).alias("listed")).distinct(), "locus", "left").withColumn("hit", F.coalesce("listed", F.lit(False)) & (F.col("feature") == "CDS"))
    kept = F.filter("qualifiers", lambda q: ~q["key"].isin("transl_table", "codon_start"))
    noted = F.transform(kept, lambda q: q.withField("key", F.when(q["key"] == "product", "note").otherwise(q["key"])))
    return listed.withColumns({"qualifiers": F.when(F.col("hit"), noted).otherwise(F.col("qualifiers")), "feature": F.when(F.col("hit"), "misc_feature").otherwise(F.col("feature"))}).select(*found.columns, F.col("hit").alias("changed"))


def redundant_mrna(found: DataFrame) -> DataFrame:
    """mRNA blocks that their CDS says all of: entry, block_no.

    The locus has no other block of LOCUS_FEATURES; the CDS has none of the EXCEPTIONS and each qualifier of the mRNA; both cover
    the same parts, and the mRNA has no open end (those of the CDS don't matter).
    """
    listed = found.where(F.col("feature").isin(*LOCUS_FEATURES) & (F.col("locus") != "") & F.col("location").isNotNull())
    pairs = F.transform("qualifiers", lambda q: F.struct(q["key"].alias("key"), q["value"].alias("value")))
    rows = listed.withColumns({"n": F.count("*").over(W.partitionBy("entry", "locus")), "pairs": pairs}).where("n = 2")
    rna = rows.where((F.col("feature") == "mRNA") & F.col("location").rlike(_READABLE) & ~F.col("location").rlike("[<>]")).select("entry", "locus", "block_no", "location", "pairs")
    cds = rows.where((F.col("feature") == "CDS") & F.col("location").rlike(_READABLE) & ~F.exists("qualifiers", lambda q: q["key"].isin(*EXCEPTIONS)))
    cds = cds.select("entry", "locus", F.regexp_replace("location", "[<>]", "").alias("cds_location"), F.col("pairs").alias("cds_pairs"))
    return rna.join(cds, ["entry", "locus"]).where((F.col("location") == F.col("cds_location")) & (F.size(F.array_except("pairs", "cds_pairs")) == 0)).select("entry", "block_no")


def renamed_entries(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rows with the accessions of the mapping (entry, accession); an entry without one is an error."""
    out = rows.join(mapping.select("entry", "accession"), "entry", "left")
    missing = F.raise_error(F.concat(F.lit("no accession for entry "), F.col("entry"))).cast("string")
    return out.withColumn("entry", F.when(F.col("entry").isin("COMMON", ""), F.col("entry")).otherwise(F.coalesce("accession", missing))).drop("accession")


def multiset_difference(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Rows whose numbers differ: the columns, expected and found."""
    cols = expected.columns
    a, b = expected.groupBy(*cols).agg(F.count("*").alias("expected")), found.groupBy(*cols).agg(F.count("*").alias("found"))
    return a.join(b, cols, "full_outer").na.fill(0, ["expected", "found"]).where("expected <> found")


def input_checks(sequences: DataFrame, features: DataFrame) -> DataFrame:
    """check, failures: what must be 0 before a run."""
    one = lambda df, name: df.agg(F.count("*").alias("failures")).select(F.lit(name).alias("check"), "failures")
    out = one(sequences.groupBy("id").count().where("count > 1"), "repeated_sequence_id")
    for df, name in (
        (sequences.where(F.length("sequence") == 0), "empty_sequence"),
        (sequences.where(~F.upper("sequence").rlike("^[ACGTRYSWKMBDHVN]*$")), "letters_outside_dna"),
        (features.where("start > end or start < 1"), "inverted_coordinates"),
        (features.join(sequences.select(F.col("id").alias("seqid")), "seqid", "left_anti"), "unknown_sequence"),
        (features.select(F.explode("parents").alias("id")).join(features.select("id"), "id", "left_anti"), "unknown_parent"),
    ):
        out = out.unionByName(one(df, name))
    return out
