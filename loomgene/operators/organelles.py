"""Checks and roll-ups of organelle genes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgene.operators.intervals import as_of, overlaps
from loomgene.shared import cut, numbered, refuse

# The one-letter codes of amino acids and their names in RNA products.
AMINO_ACIDS = {"A": "Ala", "R": "Arg", "N": "Asn", "D": "Asp", "C": "Cys", "Q": "Gln", "E": "Glu", "G": "Gly", "H": "His", "I": "Ile", "L": "Leu", "K": "Lys", "M": "Met", "F": "Phe", "P": "Pro", "S": "Ser", "T": "Thr", "W": "Trp", "Y": "Tyr", "V": "Val"}


def trna_amino_acids(gene: Column, product: Column) -> Column:
    """struct<gene, product>: the amino acid that a gene symbol (trnM-CAU) and a product (tRNA-Met) name; null where neither form fits."""
    letter = F.upper(F.regexp_extract(gene, r"(?i)^trn([A-Z])(?:[^A-Za-z].*)?$", 1))
    named = F.initcap(F.regexp_extract(product, r"(?i)^tRNA-([A-Za-z]{3})\b", 1))
    table = F.create_map(*(F.lit(x) for pair in AMINO_ACIDS.items() for x in pair))
    return F.struct(F.try_element_at(table, letter).alias("gene"), F.when(named.isin(*AMINO_ACIDS.values()), named).alias("product"))


def genome_coverage(text: Column) -> Column:
    """`<number>x` of a positive number with x, Unknown where the text says so, empty of no text; anything else is an error."""
    plain = F.trim(text)
    number = F.regexp_extract(plain, r"^([0-9]+(?:\.[0-9]+)?)[xX]$", 1)
    wrong = F.raise_error(F.concat(F.lit("genome coverage is neither a positive number with x nor Unknown: "), text)).cast("string")
    known = F.when(number.try_cast("double") > 0, F.concat(number, F.lit("x"))).otherwise(wrong)
    return F.when(F.coalesce(text, F.lit("")) == "", "").when(F.lower(plain) == "unknown", "Unknown").otherwise(known)


def phase_breaks(cds: DataFrame) -> DataFrame:
    """CDS parts (id, order_no, length, phase) whose phase isn't what the bases before them leave: (-length so far) mod 3 after the first."""
    w = W.partitionBy("id").orderBy("order_no")
    before = F.coalesce(F.sum("length").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    first = F.first("phase").over(w)
    expected = F.pmod(first - before, F.lit(3))
    return cds.withColumn("expected", expected).where("phase <> expected")


def assessment(genes: DataFrame) -> DataFrame:
    """genes and shares by record and category; a share is null if any gene of it was not evaluated.

    genes: record, category, state (complete, partial, missing or not_evaluated).
    """
    of = lambda s: F.count_if(F.col("state") == s)
    out = genes.groupBy("record", "category").agg(F.count("*").alias("genes"), *(of(s).alias(s) for s in ("complete", "partial", "missing", "not_evaluated")))
    share = lambda c: F.when(F.col("not_evaluated") == 0, F.round(100 * c / F.col("genes"), 4))
    return out.withColumn("complete_percent", share(F.col("complete"))).withColumn("detected_percent", share(F.col("complete") + F.col("partial")))


def overlapping_parts(parts: DataFrame) -> DataFrame:
    """Keys whose parts (id, start, end) overlap, as trans-spliced features must not."""
    w = W.partitionBy("id").orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1)
    return parts.withColumn("before", F.max("end").over(w)).where("start <= before").select("id").distinct()


# Features that belong to a gene, the qualifiers that they take from it, and what a gene without any of them says.
GENE_PARTS = ("CDS", "mRNA", "tRNA", "rRNA", "ncRNA", "misc_RNA")
INHERITED = ("gene", "gene_synonym", "locus_tag", "pseudo", "pseudogene", "note")
LONELY = "gene annotation without a CDS or RNA feature"


def _values(pairs: Column, key: str | Column) -> Column:
    return F.transform(F.filter(pairs, lambda q: q["key"] == key), lambda q: q["value"])


def gene_parents(features: DataFrame, bin_size: int = 1 << 12) -> DataFrame:
    """record, feature_no and gene_no: the gene of each CDS and RNA that has one.

    features: record, feature_no, type, qualifiers (array<struct<key, value>>, in order) and parts (array<struct<start, end, strand>>).
    A part with the locus_tag of a gene belongs to that gene. One whose tag (the first) no gene has, or without one, belongs to the gene
    of its name (any, if it has none) whose parts hold each of its parts on their strand, unless that gene has another tag. Two such genes are an
    error, as are two genes of the tag and a gene of the tag with another name; each names ten features. Only genes with just
    one locus_tag are found by it. Parts meet those genes in bins of positions, so a long record spreads over tasks.
    """
    tags, names = _values(F.col("qualifiers"), "locus_tag"), _values(F.col("qualifiers"), "gene")
    first = lambda c: F.nullif(F.get(c, F.lit(0)), F.lit(""))
    rows = features.where(F.col("type").isin("gene", *GENE_PARTS)).select("record", "feature_no", "type", "parts", tags.alias("tags"), names.alias("names"), first(tags).alias("tag"), first(names).alias("name"))
    genes = rows.where("type = 'gene'").select("record", F.col("feature_no").alias("gene_no"), F.col("parts").alias("g_parts"), F.col("tags").alias("g_tags"), F.col("names").alias("g_names"))
    kids = rows.where("type <> 'gene'").select("record", "feature_no", "tag", "name", "parts")
    at = F.concat_ws("/", F.col("record").cast("string"), F.col("feature_no").cast("string"))

    by_tag = genes.where("size(g_tags) = 1").select("record", F.get("g_tags", F.lit(0)).alias("tag"), "gene_no", "g_names")
    linked = cut(kids.where("tag is not null").join(by_tag, ["record", "tag"]).select("record", "feature_no", "gene_no", "name", "g_names"), "linked")
    twice = lambda df: df.groupBy("record", "feature_no").agg(F.count("*").alias("n")).where("n > 1").select(at.alias("name"))
    refuse(twice(linked), "organelle features of a locus_tag that several genes have")
    other = F.col("name").isNotNull() & (F.size("g_names") > 0) & (F.col("g_names") != F.array("name"))
    refuse(linked.where(other).select(at.alias("name")), "organelle features named otherwise than the gene of their locus_tag")

    place = lambda df, keep, parts, a, z: df.select("record", *keep, F.posexplode(parts).alias("part", "p")).select("record", *keep, "part", F.col("p.strand").alias("strand"), F.col("p.start").alias(a), F.col("p.end").alias(z))
    alone = cut(kids.join(linked, ["record", "feature_no"], "left_anti"), "alone")
    inner = place(alone, ["feature_no"], "parts", "start", "end")
    outer = place(genes, ["gene_no"], "g_parts", "r_start", "r_end").withColumnRenamed("part", "r_part")
    held = overlaps(inner, outer, ["record", "strand"], bin_size).where("r_start <= start and end <= r_end")
    held = held.groupBy("record", "feature_no", "gene_no").agg(F.count_distinct("part").alias("held"))
    pairs = held.join(alone, ["record", "feature_no"]).join(genes.drop("g_parts"), ["record", "gene_no"])
    named = F.col("name").isNull() | F.coalesce(F.get("g_names", F.lit(0)) == F.col("name"), F.lit(False))
    tagged = F.col("tag").isNull() | (F.size("g_tags") == 0) | (F.col("g_tags") == F.array("tag"))
    found = cut(pairs.where((F.col("held") == F.size("parts")) & named & tagged).select("record", "feature_no", "gene_no"), "placed")
    refuse(twice(found), "organelle features that several genes hold")
    return linked.select("record", "feature_no", "gene_no").unionByName(found)


def inherited(own: Column, gene: Column) -> Column:
    """Qualifiers of a feature with those of its gene: of the INHERITED keys each value that it hasn't, behind its own values of the key."""
    more = lambda k: F.array_distinct(F.array_except(_values(gene, k), _values(own, k)))
    keys = F.array_distinct(F.concat(F.transform(own, lambda q: q["key"]), F.filter(F.array(*map(F.lit, INHERITED)), lambda k: F.size(_values(gene, k)) > 0)))
    pair = lambda k: lambda v: F.struct(k.alias("key"), v.alias("value"))
    new = lambda k: F.when(k.isin(*INHERITED), more(k)).otherwise(F.array().cast("array<string>"))
    return F.flatten(F.transform(keys, lambda k: F.transform(F.concat(_values(own, k), new(k)), pair(k))))


def with_genes(features: DataFrame, parents: DataFrame) -> DataFrame:
    """features with gene_no, the qualifiers that their genes give them, and fate. parents: gene_parents().

    Genes with a CDS or RNA are represented by it and keep their qualifiers; the others become misc_feature with a note. Sources are `source`,
    all else is kept. A translation goes, unless an exception explains it.
    """
    genes = features.where("type = 'gene'").select("record", F.col("feature_no").alias("gene_no"), F.col("qualifiers").alias("g_qualifiers"))
    rows = features.join(parents, ["record", "feature_no"], "left").join(genes, ["record", "gene_no"], "left")
    shown = parents.select("record", F.col("gene_no").alias("feature_no"), F.lit(True).alias("shown")).distinct()
    rows = rows.join(shown, ["record", "feature_no"], "left")
    is_gene, kind = F.col("type") == "gene", features.schema["qualifiers"].dataType
    fate = F.when(is_gene & F.col("shown"), "represented").when(F.col("type") == "source", "source").when(is_gene, "misc_feature").otherwise("kept")
    note = F.array(F.struct(F.lit("note").alias("key"), F.lit(LONELY).alias("value")))
    q, none = F.coalesce("qualifiers", F.array().cast(kind)), F.array().cast(kind)
    noted = F.concat(F.filter(q, lambda p: p["key"] != "note"), F.filter(q, lambda p: p["key"] == "note"), note)
    at = F.transform(q, lambda p: p["key"])
    # the note stands with the other notes, where the feature has some
    placed = F.when(F.array_contains(at, "note"), F.flatten(F.transform(F.array_distinct(at), lambda k: F.concat(F.filter(q, lambda p: p["key"] == k), F.when(k == "note", note).otherwise(none))))).otherwise(noted)
    full = F.when(F.col("gene_no").isNotNull(), inherited(q, F.col("g_qualifiers"))).otherwise(q)
    left = F.filter(full, lambda p: (p["key"] != "translation") | F.array_contains(at, "exception"))
    out = F.when(fate == "misc_feature", placed).when(fate == "kept", left).otherwise(q)
    return rows.select(*(c for c in features.columns if c != "qualifiers"), "gene_no", out.cast(kind).alias("qualifiers"), fate.alias("fate"))


def assigned_tags(wanted: DataFrame, reserved: DataFrame, prefix: str, bin_size: int = 1 << 12) -> DataFrame:
    """item, identity and locus_tag: new tags, `<prefix>_<item>` and six digits or more, for each identity.

    wanted: item, item_no (the items' order), identity and place (the order within an item); reserved: locus_tag, the tags in use. The
    numbers of an item begin after as many as the items before it have got, and each identity gets the next one that isn't in use: an
    as-of join with how many free numbers lie below each number in use, so nothing walks from number to number.
    """
    ids = wanted.groupBy("item", "item_no", "identity").agg(F.min("place").alias("place"))
    ids = numbered(ids, ["item_no", "item", "place", "identity"], "overall")
    starts = cut(ids.groupBy("item").agg((F.min("overall") - 1).cast("bigint").alias("before")), "starts")
    nth = ids.join(starts, "item").select("item", "identity", "before", (F.col("overall") - F.col("before")).cast("bigint").alias("free"))
    # a tag in use is that of an item and a number in as many ways as it ends in digits
    rest = F.when(F.col("locus_tag").startswith(prefix + "_"), F.substr("locus_tag", F.lit(len(prefix) + 2)))
    digits = F.length(F.regexp_extract(rest, "([0-9]+)$", 1))
    ways = reserved.select("locus_tag").distinct().select(rest.alias("rest"), digits.alias("digits")).where("digits >= 6").select("rest", F.explode(F.sequence(F.lit(6), F.least("digits", F.lit(18)))).alias("n"))
    text = F.right("rest", F.col("n"))
    ways = ways.where((F.col("n") == 6) | ~text.startswith("0")).select(F.left("rest", F.length("rest") - F.col("n")).alias("item"), text.cast("bigint").alias("number"))
    used = cut(ways.join(starts, "item").where("number > before").select("item", (F.col("number") - F.col("before")).alias("r")).distinct(), "used")
    ranked = cut(numbered(used, ["item", "r"], "i"), "ranked")
    least = ranked.groupBy("item").agg((F.min("i") - 1).alias("less"))
    steps = ranked.join(least, "item").select("item", "r", (F.col("i") - F.col("less")).cast("bigint").alias("skipped")).select("item", (F.col("r") - F.col("skipped")).alias("free"), "skipped")
    found = as_of(nth, steps, ["item"], "free", ["skipped"], bin_size)
    number = F.col("before") + F.col("free") + F.coalesce("skipped", F.lit(0).cast("bigint"))
    padded = F.when(number < 1_000_000, F.lpad(number.cast("string"), 6, "0")).otherwise(number.cast("string"))
    return found.select("item", "identity", F.concat(F.lit(prefix + "_"), "item", padded).alias("locus_tag"))


def tagged(rows: DataFrame, prefix: str) -> DataFrame:
    """rows with a locus_tag on each CDS, RNA and gene: its own ones, else a new one behind its qualifiers, the same for all of a gene.

    rows: with_genes() with item and item_no, and id (null: none). The identity of a feature is its id, else the name and place of its gene, else
    its own ones, on its record. A tag of two identities is an error that names up to ten.
    """
    genes = rows.where("type = 'gene'").select("item", "record", F.col("feature_no").alias("gene_no"), F.col("parts").alias("g_parts"), F.get(_values(F.col("qualifiers"), "gene"), F.lit(0)).alias("g_name"))
    needs = F.col("fate").isin("kept", "misc_feature") & F.col("type").isin("gene", *GENE_PARTS)
    of_gene = F.col("gene_no").isNotNull()
    name = F.when(of_gene, F.col("g_name")).otherwise(F.get(_values(F.col("qualifiers"), "gene"), F.lit(0)))
    where = F.to_json(F.when(of_gene, F.col("g_parts")).otherwise(F.col("parts")))
    identity = F.to_json(F.struct("record", F.coalesce("id", F.concat_ws("/", name, where)).alias("of")))
    known = cut(rows.join(genes, ["item", "record", "gene_no"], "left").withColumn("identity", F.when(needs, identity)).select(*rows.columns, "identity"), "identities")
    tags = _values(F.col("qualifiers"), "locus_tag")
    wanted = known.where(F.col("identity").isNotNull() & (F.size(tags) == 0)).select("item", "item_no", "identity", F.struct("record", "feature_no").alias("place"))
    new = cut(assigned_tags(wanted, known.select(F.explode(tags).alias("locus_tag")), prefix), "tags")
    out = known.join(new, ["item", "identity"], "left")
    pair = F.array(F.struct(F.lit("locus_tag").alias("key"), F.col("locus_tag").alias("value")))
    kind = rows.schema["qualifiers"].dataType
    out = out.withColumn("qualifiers", F.when(F.col("identity").isNotNull() & (F.size(tags) == 0), F.concat("qualifiers", pair)).otherwise(F.col("qualifiers")).cast(kind))
    out = cut(out, "tagged")
    owners = out.where("identity is not null").select(F.concat_ws("/", F.col("item").cast("string"), "identity").alias("owner"), F.explode(tags).alias("name")).groupBy("name").agg(F.min("owner").alias("a"), F.max("owner").alias("b"))
    refuse(owners.where("a <> b").select("name"), "locus_tags of several organelle genes")
    return out.select(rows.columns)
