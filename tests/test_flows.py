"""Sets of genes and their 19 counts; targets in a taxonomy."""
import pytest
from pyspark.sql import functions as F

from loomgene.operators import flow, taxonomy

FEATURES = "before string, after string"


def sets(spark, genes, members):
    return flow.bitmaps(spark.createDataFrame(genes, "id string, mrnas int"), spark.createDataFrame(members, "set string, id string"))


def test_counts_of_a_run(spark):
    genes = [("a", 1), ("b", 3), ("c", 2), ("d", 1), ("e", None)]
    members = [("duplicate_removed_genes", "c"), ("transcript_changed_genes", "b"), ("inframe_updated_genes", "a"), ("inframe_updated_genes", "a"), ("padding_updated_genes", "a"), ("genes_with_stops", "d"), ("converted_to_misc_genes", "d")]
    maps = sets(spark, genes, members)
    row = flow.metrics(maps, spark.createDataFrame([("CDS", "CDS"), ("CDS", "misc_feature"), ("mRNA", "mRNA"), (None, "misc_feature")], FEATURES))
    got = {r.metric: r.value for r in flow.summary(row).collect()}
    assert list(got.values()) == [5, 1, 4, 1, 3, 2, 4, 1, 3, 4, 1, 1, 2, 4, 1, 3, 2, 1, 2]
    assert list(got) == list(flow.METRICS)
    assert [(r.event, r["count"], r.unit) for r in flow.event_table(row).orderBy("nth").collect()] == [(e, got[e], flow.METRICS[e]) for e in flow.EVENTS]
    assert {(r.pattern, r.genes) for r in flow.patterns(maps).collect()} == {("duplicate_removed_genes", 1), ("transcript_changed_genes", 1), ("inframe_updated_genes,padding_updated_genes", 1), ("genes_with_stops,converted_to_misc_genes", 1), ("", 1)}


def test_counts_that_cannot_be(spark):
    none = spark.createDataFrame([], FEATURES)
    with pytest.raises(ValueError, match=r"no genes of the input \(1\): x"):
        sets(spark, [("a", 1)], [("genes_with_stops", "x")])
    with pytest.raises(ValueError, match=r"later stage reports \(1\): a"):
        flow.metrics(sets(spark, [("a", 1)], [("genes_with_stops", "a"), ("duplicate_removed_genes", "a")]), none)
    with pytest.raises(Exception, match="padding_unchanged_genes is below 0"):
        flow.metrics(sets(spark, [("a", 1)], [("genes_with_stops", "a"), ("padding_updated_genes", "a")]), none).collect()
    with pytest.raises(Exception, match="unknown set of genes: other"):
        sets(spark, [("a", 1)], [("other", "a")])
    assert set(flow.metrics(sets(spark, [], []), none).first()) == {0}


RECORDS = [(1, None, "root", ""), (2759, 1, "Eukaryota", "DOMAIN"), (4751, 2759, "Fungi", "KINGDOM"), (4890, 4751, "Ascomycota", "PHYLUM"), (10, 4890, "Yeast one", "SPECIES"), (11, 4890, "yeast ONE", "GENUS"), (9, 4890, "Yeast one", "STRAIN"), (33208, 2759, "Metazoa", "KINGDOM"), (7, 33208, "fungi", "GENUS"), (12, 99, "Lost", "SPECIES")]


def resolved(spark, samples, evidence, strict=False):
    made = taxonomy.resolve(spark.createDataFrame(samples, "sample string, taxon_id bigint, scientific_name string"), spark.createDataFrame(evidence, "sample string, nth int, dataset string, strategy string"), spark.createDataFrame(RECORDS, "tax_id bigint, parent bigint, name string, rank string"), strict)
    return made


def test_datasets_names(spark):
    names = ["fungi_odb10", "/x/y/fungi_odb12.1/", "saccharomycetes_ODB10.extra", "a_b", "", "eukaryota_odb"]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").orderBy("i")
    assert [r.q for r in rows.select(taxonomy.dataset_name(F.col("n")).alias("q")).collect()] == ["fungi", "fungi", "saccharomycetes", "a b", "", "eukaryota odb"]


def test_targets(spark):
    samples = [("id", 10, "Metazoa"), ("name", 0, " yeast one "), ("unknown id", 555, "Yeast one"), ("unknown id, no dataset", 555, "Yeast one"), ("nothing", None, None), ("lost", 12, None)]
    evidence = [("id", 1, "fungi_odb10", "auto"), ("id", 2, "metazoa_odb10", "auto"), ("id", 3, "fungi_odb10", "auto"), ("name", 1, "nobody_odb10", None), ("unknown id", 2, "metazoa_odb10", "auto"), ("unknown id", 1, "FUNGI_odb10", "auto"), ("nothing", 1, " ", "auto"), ("lost", 1, "fungi_odb10", "auto")]
    target, checks = resolved(spark, samples, evidence)
    got = {r.sample: (r.source, r.status, r.tax_id, r.ranks) for r in target.collect()}
    fungi = {"domain": 2759, "kingdom": 4751, "phylum": 4890}
    assert got == {
        "id": ("configured_taxon_id", "resolved", 10, {**fungi, "species": 10}),
        "name": ("scientific_name", "resolved", 9, {**fungi, "strain": 9}),
        "unknown id": ("busco_lineage_fallback", "resolved", 4751, {"domain": 2759, "kingdom": 4751}),
        "unknown id, no dataset": ("configured_taxon_id", "unresolved", None, None),
        "nothing": ("scientific_name", "unresolved", None, None),
        "lost": ("configured_taxon_id", "resolved", 12, {"species": 12}),
    }
    assert {(r.sample, r.nth, r.query, r.lineage_tax_id, r.concordance, r.shared_tax_id) for r in checks.collect()} == {
        ("id", 1, "fungi", 4751, "consistent", 4751), ("id", 2, "metazoa", 33208, "mismatch", 2759), ("name", 1, "nobody", None, "unresolved", None),
        ("unknown id", 1, "FUNGI", 4751, "consistent", 4751), ("unknown id", 2, "metazoa", 33208, "mismatch", 2759), ("lost", 1, "fungi", 4751, "mismatch", None)}


def test_strict_targets(spark):
    with pytest.raises(ValueError, match=r"no target taxonomy could be resolved for samples \(1\): a"):
        resolved(spark, [("a", 555, None), ("b", 10, None)], [], strict=True)
    with pytest.raises(ValueError, match=r"in conflict with a dataset's lineage \(1\): b"):
        resolved(spark, [("b", 10, None)], [("b", 1, "metazoa_odb10", "auto")], strict=True)
    target, checks = resolved(spark, [], [], strict=True)
    assert target.isEmpty() and checks.isEmpty()


def test_lifting_tables(spark):
    chain = spark.createDataFrame([(i, i - 1) for i in range(1, 40)] + [(0, 0)], "tax_id bigint, parent bigint")
    table = taxonomy.lifts(chain)
    assert {(r.power, r.ancestor) for r in table.where("tax_id = 39").collect()} == {(p, 39 - (1 << p)) for p in range(6)}
    lines = taxonomy.lineages(spark.createDataFrame([(39,), (0,), (None,)], "tax_id bigint"), table)
    assert sorted((r.tax_id, r.ancestor, r.up) for r in lines.collect()) == [(0, 0, 0)] + [(39, 39 - u, u) for u in range(39, -1, -1)]
    with pytest.raises(ValueError, match="cycle"):
        taxonomy.lifts(spark.createDataFrame([(1, 2), (2, 1), (3, 4)], "tax_id bigint, parent bigint"))
