"""Genes of organelle features, what they inherit, and new locus tags."""
import pytest
from pyspark.sql import functions as F

from loomgene.operators import organelles

SCHEMA = "item string, item_no int, record string, feature_no int, type string, id string, qualifiers array<struct<key:string,value:string>>, parts array<struct<start:bigint,end:bigint,strand:string>>"


def feature(no, kind, parts, strand="+", record="m1", item="mito", item_no=1, id=None, **qualifiers):
    pairs = [(k, v) for k, vs in qualifiers.items() for v in ([vs] if isinstance(vs, str) else vs)]
    return (item, item_no, record, no, kind, id, pairs, [(a, b, strand) for a, b in parts])


def table(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def parents(spark, *rows):
    return {(r.feature_no, r.gene_no) for r in organelles.gene_parents(table(spark, *rows), bin_size=16).collect()}


def test_parents(spark):
    rows = [
        feature(0, "source", [(1, 500)]),
        feature(1, "gene", [(1, 100)], gene="cox1", locus_tag="AB_1"),
        feature(2, "CDS", [(400, 450)], locus_tag="AB_1"),  # by the tag, wherever it lies
        feature(3, "CDS", [(5, 20), (40, 100)], gene="cox1"),  # by name and place
        feature(4, "tRNA", [(5, 20)]),  # by place alone
        feature(5, "tRNA", [(5, 20)], "-"),  # on the other strand
        feature(6, "CDS", [(5, 120)], gene="cox1"),  # not within
        feature(7, "CDS", [(5, 20)], gene="cox2"),  # another name
        feature(8, "CDS", [(5, 20)], locus_tag="AB_9"),  # a tag of no gene, while the gene has one
        feature(9, "gene", [(200, 220), (240, 260)], "-", gene="nad1"),
        feature(10, "CDS", [(245, 260), (201, 220)], "-", gene="nad1", locus_tag="AB_7"),  # each part in a part; the gene has no tag
        feature(11, "CDS", [(210, 250)], "-", gene="nad1"),  # across the gap of the gene
        feature(12, "repeat_region", [(5, 20)]),
    ]
    assert parents(spark, *rows) == {(2, 1), (3, 1), (4, 1), (10, 9)}
    assert parents(spark) == set()


def test_parents_that_are_not_clear(spark):
    a, b = feature(1, "gene", [(1, 100)], locus_tag="T"), feature(2, "gene", [(1, 50)], locus_tag="T")
    with pytest.raises(ValueError, match=r"that several genes have \(1\): m1/3"):
        parents(spark, a, b, feature(3, "CDS", [(1, 9)], locus_tag="T"))
    with pytest.raises(ValueError, match=r"several genes hold \(1\): m1/3"):
        parents(spark, a, b, feature(3, "CDS", [(1, 9)]))
    with pytest.raises(ValueError, match=r"named otherwise than the gene of their locus_tag \(1\): m1/3"):
        parents(spark, feature(1, "gene", [(1, 100)], locus_tag="T", gene="x"), feature(3, "CDS", [(1, 9)], locus_tag="T", gene="y"))


def test_inheritance(spark):
    rows = table(
        spark,
        feature(1, "gene", [(1, 100)], gene="cox1", note=["a", "b", "b"], pseudo="", other="no"),
        feature(2, "CDS", [(1, 99)], product="p", note=["a", "a"], translation="MK"),
        feature(3, "gene", [(200, 300)], gene="lone", note="own", product="x"),
        feature(4, "CDS", [(400, 420)], exception="RNA editing", translation="MK"),
        feature(5, "gene", [(500, 520)]),
        feature(6, "source", [(1, 600)], translation="kept"),
    )
    got = {r.feature_no: (r.fate, r.gene_no, [(q.key, q.value) for q in r.qualifiers]) for r in organelles.with_genes(rows, organelles.gene_parents(rows)).collect()}
    note = ("note", "gene annotation without a CDS or RNA feature")
    assert got == {
        1: ("represented", None, [("gene", "cox1"), ("note", "a"), ("note", "b"), ("note", "b"), ("pseudo", ""), ("other", "no")]),
        2: ("kept", 1, [("product", "p"), ("note", "a"), ("note", "a"), ("note", "b"), ("gene", "cox1"), ("pseudo", "")]),
        3: ("misc_feature", None, [("gene", "lone"), ("note", "own"), note, ("product", "x")]),
        4: ("kept", None, [("exception", "RNA editing"), ("translation", "MK")]),
        5: ("misc_feature", None, [note]),
        6: ("source", None, [("translation", "kept")]),
    }


def walked(wanted, reserved, prefix):
    """What a walk from tag to tag gives."""
    used, tags = set(reserved), {}
    for item, identity in wanted:
        if (item, identity) not in tags:
            n = len(tags) + 1
            while f"{prefix}_{item}{n:06d}" in used:
                n += 1
            tags[item, identity] = f"{prefix}_{item}{n:06d}"
            used.add(tags[item, identity])
    return tags


def test_new_tags(spark):
    wanted = [("mito", f"g{i % 7:02d}") for i in range(10)] + [("p1", f"g{i:02d}") for i in range(30)] + [("p", f"g{i:02d}") for i in range(3)]
    reserved = [f"AB_mito{n:06d}" for n in (2, 3, 5, 900)] + [f"AB_p1{n:06d}" for n in (1, 8, 10, 11, 30, 1000000)] + ["AB_p1000038", "AB_p000040", "AB_p00041", "CD_p000038", "AB_mito0000001", "x"]
    order = {"mito": 1, "p1": 2, "p": 3}
    w = spark.createDataFrame([(i, order[i], d, n) for n, (i, d) in enumerate(wanted)], "item string, item_no int, identity string, place int")
    r = spark.createDataFrame([(t,) for t in reserved], "locus_tag string")
    for bins in (4, 1 << 12):
        assert {(x.item, x.identity): x.locus_tag for x in organelles.assigned_tags(w, r, "AB", bins).collect()} == walked(wanted, reserved, "AB")


def test_tags_of_genes(spark):
    rows = table(
        spark,
        feature(1, "gene", [(1, 100)], gene="cox1"),
        feature(2, "mRNA", [(1, 100)], gene="cox1"),
        feature(3, "CDS", [(1, 99)], gene="cox1"),
        feature(4, "tRNA", [(200, 270)], locus_tag="AB_mito000001"),
        feature(5, "gene", [(300, 310)]),
        feature(6, "repeat_region", [(1, 10)]),
        feature(1, "CDS", [(1, 9)], record="p1", item="plastid", item_no=2, id="c1"),
    )
    done = organelles.tagged(organelles.with_genes(rows, organelles.gene_parents(rows)).select(*rows.columns, "gene_no", "fate"), "AB")
    tags = done.select("item", "feature_no", F.array_join(organelles._values(F.col("qualifiers"), "locus_tag"), ",").alias("t"))
    assert {(r.item, r.feature_no, r.t) for r in tags.collect()} == {("mito", 1, ""), ("mito", 2, "AB_mito000002"), ("mito", 3, "AB_mito000002"), ("mito", 4, "AB_mito000001"), ("mito", 5, "AB_mito000003"), ("mito", 6, ""), ("plastid", 1, "AB_plastid000003")}
    clash = table(spark, feature(1, "CDS", [(1, 9)], locus_tag="T"), feature(2, "CDS", [(20, 30)], locus_tag="T"))
    with pytest.raises(ValueError, match=r"locus_tags of several organelle genes \(1\): T"):
        organelles.tagged(organelles.with_genes(clash, organelles.gene_parents(clash)), "AB")
