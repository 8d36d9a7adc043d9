"""Operators on small tables with results worked out by hand or by brute force."""
import itertools
import random

import pytest
from pyspark.sql import functions as F

from loomgene.functions import sequence as S
from loomgene.operators import audit, evidence, flow, graph, intervals, models, ranking, render, review, stages
from loomgene.plans import package
from loomgene.sources import fasta, gff3, tables


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_isoforms_break_ties_in_order(spark):
    parts = [("g1", "a", "CDS", 1, 9), ("g1", "b", "CDS", 1, 9), ("g1", "b", "UTR", 10, 12), ("g2", "c", "CDS", 5, 7), ("g2", "d", "CDS", 4, 6), ("g3", "e", None, None, None)]
    got = rows(ranking.isoforms(spark.createDataFrame(parts, "gene string, transcript string, kind string, start bigint, end bigint")), "gene")
    assert got == [("g1", "b", 9, 3, 2, True), ("g2", "d", 3, 0, 2, True), ("g3", "e", 0, 0, 1, False)]


def test_removal_needs_all_parents(spark):
    edges = [("t1", "g1"), ("t2", "g1"), ("t2", "g2"), ("e1", "t1"), ("e2", "t1"), ("e2", "t2"), ("x", "y"), ("y", "x")]
    gone = graph.removed(spark.createDataFrame(edges, "child string, parent string"), spark.createDataFrame([("g1",)], "id string"))
    assert rows(gone, "id") == [("e1",), ("g1",), ("t1",)]


def test_components_against_brute_force(spark):
    rng = random.Random(1)
    n = 120
    links = [(rng.randrange(n), rng.randrange(n)) for _ in range(80)] + [(i, i + 1) for i in range(90, 119)]
    root = list(range(n))
    for _ in range(n):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = graph.components(spark.range(n), spark.createDataFrame(links, "a bigint, b bigint"))
    assert rows(got, "id") == list(enumerate(root))
    none = graph.components(spark.range(2), spark.createDataFrame([], "a bigint, b bigint"))
    assert rows(none, "id") == [(0, 0), (1, 1)]


def test_families_of_fixed_size(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (7, 8)], "a bigint, b bigint")
    got = graph.families(spark.range(1, 10), links, "FAM")
    plan = got._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "collect_set" not in plan
    by = {r.id: (r.family_id, r.members) for r in got.collect()}
    assert [by[i][1] for i in range(1, 10)] == [3, 3, 3, 1, 1, 1, 2, 2, 1] and by[1] == by[2] == by[3] and len({v[0] for v in by.values()}) == 6
    # the name depends on nothing but the members
    other = {r.id: r.family_id for r in graph.families(spark.createDataFrame([(3,), (2,), (1,), (5,)], "id bigint").repartition(3), spark.createDataFrame([(3, 1), (1, 2)], "a bigint, b bigint"), "FAM").collect()}
    assert other == {i: by[i][0] for i in (1, 2, 3, 5)} and all(v.startswith("FAM_") and len(v) == 16 for v in other.values())


def test_ancestors(spark):
    chain = [(i, i + 1) for i in range(20)] + [(30, 31)]
    assert rows(graph.top_ancestors(spark.createDataFrame(chain, "child bigint, parent bigint")), "child") == [(i, 20) for i in range(20)] + [(30, 31)]


def test_interval_operators_against_brute_force(spark):
    rng = random.Random(2)
    def some(n):
        out = []
        for i in range(n):
            a = rng.randint(1, 200)
            out.append((rng.choice("ab"), i, a, a + rng.randint(0, 30)))
        return out
    left, right = some(60), some(60)
    l = spark.createDataFrame(left, "k string, i int, start bigint, end bigint")
    r = spark.createDataFrame(right, "k string, j int, r_start bigint, r_end bigint")
    want = sorted((x[1], y[1]) for x, y in itertools.product(left, right) if x[0] == y[0] and x[2] <= y[3] and y[2] <= x[3])
    assert rows(intervals.overlaps(l, r, ["k"], 16).select("i", "j"), "i", "j") == want
    want = sorted(x[1] for x in left if not any(x[0] == y[0] and y[2] <= x[2] and x[3] <= y[3] for y in right))
    for size in (1 << 16, 7):
        assert [x[0] for x in rows(intervals.outside(l, r, ["k"], size).select("i"), "i")] == want
    covered = {(k, p) for k, _, a, z in left for p in range(a, z + 1)}
    merged = rows(intervals.merge(l, ["k"]).select("k", "start", "end"), "k", "start")
    assert {(k, p) for k, a, z in merged for p in range(a, z + 1)} == covered
    assert all(b[1] > a[2] + 1 for a, b in itertools.pairwise(merged) if a[0] == b[0])


def test_as_of_is_strict(spark):
    l = spark.createDataFrame([("u", 1, 5), ("u", 2, 3), ("v", 3, 9)], "k string, i int, t int")
    r = spark.createDataFrame([("u", 3, "x"), ("u", 4, "y"), ("u", 5, "z")], "k string, t int, s string")
    assert rows(intervals.as_of(l, r, ["k"], "t", ["s"]).select("i", "s"), "i") == [(1, "y"), (2, None), (3, None)]
    rng = random.Random(5)
    left, right = [(rng.choice("ab"), i, rng.randint(0, 99)) for i in range(80)], [(rng.choice("ab"), rng.randint(0, 99), i) for i in range(40)]
    want = [(i, max(((u, j) for m, u, j in right if m == k and u < t), default=(None, None))[1]) for k, i, t in left]
    l, r = spark.createDataFrame(left, "k string, i int, t int"), spark.createDataFrame(right, "k string, t int, j int")
    for size in (None, 10, 3):
        assert rows(intervals.as_of(l, r, ["k"], "t", ["j"], size).select("i", "j"), "i") == want


def test_clip_and_shift(spark):
    seg = spark.createDataFrame([("t", 1, 4, 6, False), ("t", 10, 15, 6, False), ("m", 1, 4, 5, True), ("m", 10, 12, 5, True)], "t string, start bigint, end bigint, n bigint, minus boolean")
    got = rows(intervals.clip(seg, ["t"], [F.when(F.col("minus"), -F.col("end")).otherwise(F.col("start"))], "n", "minus").select("t", "start", "end"), "t", "start")
    assert got == [("m", 1, 2), ("t", 12, 15)]
    rng, bases = random.Random(3), []
    for _ in range(40):
        bases += ["N"] * rng.randint(1, 9) if rng.random() < 0.4 else [rng.choice("ACGT")] * 2
    seq = "".join(bases)
    df = spark.createDataFrame([("s", seq)], "seqid string, seq string")
    new, edits = df.select(S.normalise_gaps("seq" and F.col("seq"), 5, 2, 8)).first()[0], df.select("seqid", F.explode(S.gap_edits(F.col("seq"), 5, 2, 8)).alias("e")).select("seqid", "e.*")
    pos = [p for p in range(1, len(seq) + 1) if seq[p - 1] != "N"]
    got = rows(intervals.shift(spark.createDataFrame([("s", p, "start") for p in pos], "seqid string, position bigint, kind string"), edits, "seqid").select("position", "shifted"), "position")
    assert [new[q - 1] for _, q in got] == [seq[p - 1] for p in pos] and len(set(q for _, q in got)) == len(pos)


GENOME = ">c1 first contig\nATGAAATTTGGG\nNNNNNN\nCCCAAATAGTTTNN\n>c2\nTTACATCATGGGTAA\n"
TABLE = """##gff-version 3
c1\ts\tgene\t1\t27\t.\t+\t.\tID=g1
c1\ts\tmRNA\t1\t27\t.\t+\t.\tID=g1.t1;Parent=g1;product=kinase A
c1\ts\texon\t1\t12\t.\t+\t.\tParent=g1.t1
c1\ts\texon\t19\t27\t.\t+\t.\tParent=g1.t1
c1\ts\tCDS\t1\t12\t.\t+\t0\tID=g1.c;Parent=g1.t1
c1\ts\tCDS\t19\t27\t.\t+\t0\tID=g1.c;Parent=g1.t1
c1\ts\tmRNA\t1\t12\t.\t+\t.\tID=g1.t2;Parent=g1
c1\ts\tCDS\t1\t12\t.\t+\t0\tParent=g1.t2
c1\ts\tgene\t1\t27\t.\t+\t.\tID=g2
c1\ts\tmRNA\t1\t27\t.\t+\t.\tID=g2.t1;Parent=g2
c1\ts\tCDS\t2\t12\t.\t+\t0\tParent=g2.t1
c2\ts\tgene\t1\t99\t.\t-\t.\tID=g3
c2\ts\tmRNA\t1\t6\t.\t-\t.\tID=g3.t1;Parent=g3
c2\ts\tCDS\t1\t6\t.\t-\t0\tParent=g3.t1
c2\ts\ttRNA\t10\t15\t.\t+\t.\tID=r1;product=tRNA-Met
"""


@pytest.fixture(scope="module")
def genome(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("genome")
    (d / "g.fa").write_text(GENOME)
    (d / "g.gff3").write_text(TABLE)
    return fasta.read(spark, str(d / "g.fa")), gff3.read(spark, str(d / "g.gff3"))


def test_readers(genome):
    seqs, features = genome
    assert [(r.id, r.description, r.sequence) for r in seqs.orderBy("seq_no").collect()] == [("c1", "c1 first contig", "ATGAAATTTGGGNNNNNNCCCAAATAGTTTNN"), ("c2", "c2", "TTACATCATGGGTAA")]
    first = features.orderBy("row_no").collect()
    assert len(first) == 15 and first[1].attributes["product"] == "kinase A" and first[1].parents == ["g1"]
    lines = [r.value for r in fasta.lines(seqs, 10, submission=True).orderBy("seq_no").collect()]
    assert lines[1] == ">c2\nTTACATCATG\nGGTAA\n//"


def test_stages(spark, genome):
    seqs, features = genome
    bounded = stages.trim_to_bounds(features, seqs)
    assert bounded.where("id = 'g3'").first().end == 15
    pairs = stages.coordinate_duplicates(bounded, seqs).collect()
    assert [(p.group_id, p.kept, p.removed, p.reason) for p in pairs] == [("coordinate_duplicate_000001", "g1", "g2", "valid_structure")]
    left = stages.one_isoform(stages.drop_coordinate_duplicates(bounded, seqs))
    assert sorted(r.id for r in left.where("id is not null and type <> 'CDS'").collect()) == ["g1", "g1.t1", "g3", "g3.t1", "r1"]
    assert left.count() == 10
    issues = stages.containment_issues(spark.createDataFrame([(1, "c", "gene", 1, 9, "g", []), (2, "c", "mRNA", 1, 12, "t", ["g"]), (3, "c", "CDS", 2, 4, None, ["t"])], "row_no bigint, seqid string, type string, start bigint, end bigint, id string, parents array<string>"))
    assert rows(issues, "row_no") == [(2, "outside_parent")]


def test_frame_and_padding(spark):
    part = "array<struct<start:bigint,end:bigint,phase:string,row_no:bigint>>"
    m = spark.createDataFrame([("a", "c", "+", [(1, 1, "1", 1), (5, 14, "2", 2)]), ("b", "c", "-", [(1, 9, "0", 3), (20, 24, "1", 4)]), ("c", "c", "+", [(1, 6, "0", 5)])], f"transcript_id string, seqid string, strand string, cds {part}")
    got = {r.transcript_id: ([(c.start, c.end, c.phase) for c in r.cds], r.changed) for r in models.in_frame(m).collect()}
    assert got == {"a": ([(7, 12, "0")], True), "b": ([(2, 9, "0"), (20, 23, "0")], True), "c": ([(1, 6, "0")], False)}
    d = spark.createDataFrame([("a", 1, 2, 0), ("c", 0, 0, 2)], "transcript_id string, head int, tail int, stops_after bigint")
    got = {r.transcript_id: ([(c.start, c.end) for c in r.cds], r.status) for r in models.apply_padding(m, d).collect()}
    assert got == {"a": ([(6, 13)], "padded"), "b": ([(1, 9), (20, 24)], "unchanged"), "c": ([(1, 6)], "stops")}


def test_package(spark, genome, tmp_path):
    made = package.run(*genome, package.Options(locus_prefix="AB", gap_target=9, gap_least=5, gap_most=8, gap_feature_least=5))
    assert {r.id: r.sequence for r in made["sequences"].collect()}["c1"] == "ATGAAATTTGGGNNNNNNNNNCCCAAATAGTTT"
    body = [r.value for r in made["body"].orderBy("seq_no", "block", "line_in_block").collect()]
    assert body[:4] == ["c1\tsource\t1..33\tff_definition\t@@[organism]@@ DNA, @@[submitter_seqid]@@", "\t\t\tmol_type\tgenomic DNA", "\t\t\torganism\tunknown", "\t\t\tsubmitter_seqid\t@@[entry]@@"]
    assert body[4] == "\tassembly_gap\t13..21\testimated_length\tknown"
    assert body[7:11] == ["\tmRNA\tjoin(1..12,22..30)\tlocus_tag\tAB_g1", "\t\t\tnote\ttranscript_id:g1.t1", "\tCDS\tjoin(1..12,22..30)\tlocus_tag\tAB_g1", "\t\t\tnote\ttranscript_id:g1.t1"]
    assert "\tCDS\tjoin(1..12,22..30)\tlocus_tag\tAB_g1" in body and "\t\t\tproduct\tkinase A" in body
    assert "\tassembly_gap\t13..21\testimated_length\tknown" in body and "\ttRNA\t10..15\tlocus_tag\tAB_000000300" in body and "\t\t\tproduct\ttRNA-Met" in body
    assert "\tCDS\tcomplement(1..6)\tlocus_tag\tAB_g3" in body
    assert [(r.stage, r.genes) for r in made["counts"].orderBy("step").collect()] == [("input", 3), ("trim_bounds", 3), ("normalise_gaps", 3), ("drop_duplicates", 2), ("one_isoform", 2), ("into_frame", 2), ("padding", 2)]
    assert [r.value for r in made["metrics"].orderBy("nth").collect()] == [3, 1, 2, 1, 1, 1, 2, 0, 2, 2, 0, 0, 2, 2, 0, 2, 2, 2, 0]
    assert {(r.pattern, r.genes) for r in made["patterns"].collect()} == {("", 1), ("duplicate_removed_genes", 1), ("transcript_changed_genes", 1)}
    p = str(tmp_path / "out")
    made["body"].coalesce(1).orderBy("seq_no", "block", "line_in_block").select("value").write.text(p)
    found = review.blocks(tables.submission_rows(spark, p))
    assert {r.feature for r in found.collect()} == {"source", "mRNA", "CDS", "assembly_gap", "tRNA"}
    assert {r.warning for r in review.warnings(tables.submission_rows(spark, p)).collect()} == {"short_cds"}
    misc = review.stops_to_misc(found, spark.createDataFrame([("AB_g1",)], "locus string")).where("changed").first()
    assert misc.feature == "misc_feature" and [q.key for q in misc.qualifiers] == ["locus_tag", "note", "note", "artificial_location"]


def test_package_runs_all_stages(spark, tmp_path):
    (tmp_path / "g.fa").write_text(">c1\n" + "ATGTAATTAGTTGATTAGCTAACC" + "ATGAAACCCTAG" + "\n")
    table = [("gene", 1, 24, "ID=AB_1;"), ("CDS", 1, 24, "ID=c1;Parent=AB_1.t1"), ("mRNA", 1, 24, "ID=AB_1.t1;Parent=AB_1;product=stop;ped"), ("mRNA", 25, 36, "ID=AB_2.t1;Parent=AB_2;product=Belongs to the X family"), ("CDS", 25, 36, "Parent=AB_2.t1"), ("gene", 25, 36, "ID=AB_2")]
    (tmp_path / "g.gff3").write_text("##gff-version 3\n" + "".join(f"c1\ts\t{t}\t{a}\t{b}\t.\t+\t{'0' if t == 'CDS' else '.'}\t{x}\n" for t, a, b, x in table))
    header = render.Header("PRJ1", "SAM1", ["A,B.", "C,D."], "c", "i", "d", "co", "s", "ci", "st", "z", "p", "e", "T", ["A,B."], 2026, hold_date="20270101", genome_coverage=" 30X")
    options = package.Options(locus_prefix="AB", locus_digits=4, replace_products=["x (family|group)"], header=header)
    package.package(spark, str(tmp_path / "g.fa"), str(tmp_path / "g.gff3"), str(tmp_path / "out"), options)
    read = lambda name: [r.value for part in sorted((tmp_path / "out" / name).glob("part-*")) for r in spark.read.text(str(part)).collect()]
    body = read("annotation")
    assert body[:2] == ["COMMON\tDATE\t\thold_date\t20270101", "\tDATATYPE\t\ttype\tWGS"] and "\t\t\tGenome Coverage\t30x" in body and "\t\t\tab_name\tC,D." in body
    at = body.index("c1\tsource\t1..36\tff_definition\t@@[organism]@@ DNA, @@[submitter_seqid]@@")
    assert body[at - 2 : at] == ["\tST_COMMENT\t\ttagset_id\tGenome-Assembly-Data", "\t\t\tGenome Coverage\t30x"]
    assert [x.split("\t")[1:2] + x.split("\t")[3:] for x in body[at + 4 :] if "mRNA" not in x] == [["", "note", "transcript_id:AB_0001.t1"], ["misc_feature", "locus_tag", "AB_0001"], ["", "note", "transcript_id:AB_0001.t1"], ["", "note", "stop.ped"], ["", "note", "transcript_id:AB_0002.t1"], ["CDS", "locus_tag", "AB_0002"], ["", "note", "transcript_id:AB_0002.t1"], ["", "product", "hypothetical protein"], ["", "transl_table", "1"], ["", "codon_start", "1"]]
    features = read("features")
    assert features[0] == "##gff-version 3" and [x.split("\t")[2] for x in features[1:]] == ["gene", "mRNA", "CDS"] * 2 and features[1].endswith("ID=AB_0001")
    review_rows = read("review")
    assert read("metrics")[:2] == ["metric\tvalue\tunit", "initial_genes\t2\tgenes"] and read("metrics")[-4:] == ["final_cds_genes\t1\tgenes", "total_cds_input\t2\tfeatures", "total_cds_output\t1\tfeatures", "misc_feature_output\t1\tfeatures"]
    assert read("changes")[-2:] == ["genes_with_stops\tGenes with stops\t1\tgenes", "converted_to_misc_genes\tGenes converted to misc_feature\t1\tgenes"]
    assert "short_cds\tc1\tCDS\tAB_0002\t25..36\t12 coding bp; review against the 93 bp threshold" in review_rows


def test_locations_and_gaps(spark):
    part = "array<struct<start:bigint,end:bigint>>"
    df = spark.createDataFrame([("+", [(1, 30)], [(10, 13)]), ("-", [(1, 30)], [(10, 13)]), ("+", [(5, 8)], [(1, 20)]), ("+", [(5, 20), (25, 25)], [(1, 6), (19, 22)])], f"strand string, parts {part}, gaps {part}")
    cut = render.without_gaps(F.col("parts"), F.col("gaps"), F.col("strand"))
    assert [r[0] for r in df.select(render.location(cut, F.col("strand"))).collect()] == ["join(1..9,16..30)", "complement(join(1..7,14..30))", "5..8", "join(7..18,25)"]


def test_consensus_and_assignment(spark):
    hits = [("q1", 1, "swissprot", 90.0, 90.0, 90.0, 1e-30, 100.0, "heat shock protein 70", 1.0), ("q1", 2, "uniref90", 90.0, 90.0, 90.0, 1e-30, 99.0, "heat shock protein", 0.5), ("q1", 3, "uniref90", 90.0, 90.0, 90.0, 1e-30, 60.0, "kinase", 0.5), ("q2", 4, "uniref90", 20.0, 90.0, 90.0, 1e-30, 90.0, "kinase", 0.5)]
    df = spark.createDataFrame(hits, "qseqid string, hit_no bigint, database string, pident double, qcovhsp double, scovhsp double, evalue double, bitscore double, description string, weight double").withColumns({"taxonomy_relation": F.lit("unknown"), "taxonomy_weight": F.lit(0.9)})
    got = evidence.consensus(evidence.accepted_hits(df)).collect()
    assert [(r.qseqid, r["product"], r.source, r.quality, r.confidence, r.hits) for r in got] == [("q1", "heat shock protein", "uniref90", "***", "moderate", 2)]
    assert got[0].score == pytest.approx(1.0)
    a = spark.createDataFrame([("q", "x", "pfam", 0.9, 80.0, 50.0, "high", 0.9, 1), ("q", "y", "swissprot", 0.7, 80.0, 50.0, "high", 0.9, 2)], "qseqid string, product string, source string, score double, coverage double, bitscore double, confidence string, taxonomy_weight double, input_no int")
    assert evidence.best_assignment(a).first()["product"] == "y"
    ann = spark.createDataFrame([("q", "hypothetical protein", "L1"), ("r", "Probable kinase", "L2")], "ID string, Description string, Locus_tag string")
    got = rows(evidence.apply_products(ann, a.where("product = 'y'")).select("ID", "Description", "source"), "ID")
    assert got == [("q", "y", "swissprot"), ("r", "putative kinase", "existing")]


def test_taxonomy_relation(spark):
    df = spark.sql("select * from values (101L, array(7L, 2759L)), (102L, array(8L, 2759L)), (103L, array(2L)), (104L, array(99L)), (null, null), (70L, array(2759L)), (105L, null), (2157L, array(131567L)) t(s, l)")
    relation = lambda ranks: [r[0] for r in df.select(evidence.taxonomy_relation(F.col("s"), F.col("l"), F.lit(101), F.expr(ranks))).collect()]
    # without one of NCBI's domains in the lineage, which the subject itself is part of, the relation is unknown
    assert relation("map('genus', 7L, 'kingdom', 70L, 'domain', 2759L)") == ["same_species", "cross_kingdom", "cross_domain", "unknown", "unknown", "same_kingdom", "unknown", "cross_domain"]
    assert relation("map('domain', 2759L)") == ["same_species", "same_domain", "cross_domain", "unknown", "unknown", "same_domain", "unknown", "cross_domain"]
    assert set(relation("map('genus', 8L)")) == {"same_species", "same_genus", "unknown"}


def test_best_hit_may_say_nothing(spark):
    hits = [("a", 1000.0, "hypothetical protein"), ("a", 500.0, "kinase"), ("b", 1000.0, "hypothetical protein"), ("b", 950.0, "kinase"), ("c", 1000.0, ""), ("c", 1000.0, None), ("c", 500.0, "ligase")]
    df = spark.createDataFrame([(*h, 90.0, 90.0, 90.0, 1e-30) for h in hits], "qseqid string, bitscore double, description string, pident double, qcovhsp double, scovhsp double, evalue double")
    assert rows(evidence.accepted_hits(df).select("qseqid", "description", "best_bitscore"), "qseqid") == [("b", "kinase", 1000.0), ("c", "ligase", 500.0)]


def test_audit(spark):
    genes = spark.createDataFrame([("a", "heat shock protein 70", "swissprot"), ("b", "Heat shock protein-70", "pfam"), ("c", "kinase", "uniref90"), ("d", "", "none"), ("e", "ligase", "pfam")], "id string, name string, source string")
    sim = spark.createDataFrame([("a", "b", 95.0, 95.0, 95.0, 1e-40, 9.0, 1), ("b", "a", 95.0, 95.0, 95.0, 1e-40, 8.0, 2), ("a", "c", 75.0, 90.0, 90.0, 1e-40, 7.0, 3), ("c", "d", 45.0, 70.0, 70.0, 1e-40, 7.0, 4), ("a", "a", 100.0, 100.0, 100.0, 0.0, 99.0, 5)], "qseqid string, sseqid string, pident double, qcovhsp double, scovhsp double, evalue double, bitscore double, hit_no bigint")
    out = audit.audit(sim, genes)
    assert sorted((r.a, r.b, r.tier, r.relation) for r in out["pairs"].collect()) == [("a", "b", "broad", "exact"), ("a", "b", "family", "exact"), ("a", "b", "near_identical", "exact"), ("a", "c", "broad", "review"), ("a", "c", "family", "review"), ("c", "d", "broad", "not_evaluable")]
    assert {(r.tier, r.status): 1 for r in out["families"].collect()}.keys() >= {("near_identical", "exact"), ("family", "review"), ("broad", "review"), ("broad", "one_annotated")}
    assert rows(out["genes"].select("id", "status"), "id") == [("a", "review"), ("b", "consistent"), ("c", "review"), ("d", "unannotated"), ("e", "no_close_family_peer")]
    summary = {r.tier: r for r in out["summary"].collect()}
    assert summary["near_identical"].strict_rate == 1.0 and summary["family"].strict_rate == 0.0 and summary["near_identical"].total_clusters == 4


def test_flow(spark):
    m = spark.createDataFrame([("s1", "changed", 1), ("s2", "changed", 1), ("s2", "changed", 2)], "stage string, group string, id int")
    got = rows(flow.links(m, ["s1", "s2"], spark.createDataFrame([(5,)], "total bigint")).drop("position"), "source", "target")
    assert got == [("s1", "changed", "changed", 1), ("s1", "unchanged", "changed", 1), ("s1", "unchanged", "unchanged", 3)]
    r = flow.rollup_status(spark.createDataFrame([("g", "consistent"), ("g", "review"), ("h", "odd")], "k string, s string"), "k", "s", {"review": 0, "consistent": 4}, 9)
    assert rows(r, "k") == [("g", "review"), ("h", "odd")]


def test_checks_and_differences(spark, genome):
    got = {r.check: r.failures for r in review.input_checks(*genome).collect()}
    assert got == {"repeated_sequence_id": 0, "empty_sequence": 0, "letters_outside_dna": 0, "inverted_coordinates": 0, "unknown_sequence": 0, "unknown_parent": 0}
    a, b = (spark.createDataFrame(x, "v string") for x in ([("x",), ("x",), ("y",)], [("x",), ("z",)]))
    assert rows(review.multiset_difference(a, b), "v") == [("x", 2, 1), ("y", 1, 0), ("z", 0, 1)]


def test_semicolons_of_lines(spark):
    lines = spark.createDataFrame([(0, "comment", "##gff-version 3"), (1, "record", "c\ts\tgene\t1\t9\t.\t+\t.\tID=a;Note=b;c;")], "line_no bigint, section string, line string")
    got = rows(stages.repair_semicolons(lines).select("line", "trailing", "glued"), "line")
    assert got == [("##gff-version 3", False, False), ("c\ts\tgene\t1\t9\t.\t+\t.\tID=a;Note=b.c", True, True)]


def test_order_puts_parents_first(spark):
    f = spark.createDataFrame([(1, "c", 1, "e", ["t"]), (2, "c", 1, "t", ["g"]), (3, "c", 1, "g", []), (4, "b", 9, None, [])], "row_no bigint, seqid string, start bigint, id string, parents array<string>")
    assert [(r.row_no, r.depth) for r in stages.hierarchical_order(f).orderBy("seqid", "start", "depth", "visit").collect()] == [(4, 0), (3, 0), (2, 1), (1, 2)]


def test_domains_and_redundant_mrna(spark):
    d = spark.createDataFrame([("q", "Pkinase", "PF1", 100, 1e-9, 50.0, 1, 90, "Protein kinase domain", 1), ("q", "X", "PF2", 100, 1e-9, 60.0, 1, 90, "coiled coil", 2), ("r", "DUF12", "PF3", 100, 1e-9, 60.0, 1, 20, "DUF12", 3)], "query_id string, name string, accession string, hmm_length bigint, i_evalue double, bitscore double, hmm_from bigint, hmm_to bigint, description string, hit_no bigint")
    assert [(r.qseqid, r["product"]) for r in evidence.domain_assignments(d).collect()] == [("q", "Protein kinase domain-containing protein")]
    q = lambda *pairs: [(i, *p) for i, p in enumerate(pairs)]
    tag, note = lambda x: ("locus_tag", x), ("note", "n")
    made = [
        ("mRNA", "1..9", "L1", q(tag("L1"))), ("CDS", "<1..>9", "L1", q(tag("L1"), ("product", "p"))),  # said by the CDS
        ("mRNA", "1..9", "L2", q(tag("L2"))), ("CDS", "2..9", "L2", q(tag("L2"))),  # other parts
        ("mRNA", "1..9", "L3", q(tag("L3"), note)), ("CDS", "1..9", "L3", q(tag("L3"))),  # a qualifier of its own
        ("mRNA", "1..9", "L4", q(tag("L4"))), ("CDS", "1..9", "L4", q(tag("L4"), ("pseudo", ""))),
        ("mRNA", "<1..9", "L5", q(tag("L5"))), ("CDS", "1..9", "L5", q(tag("L5"))),
        ("mRNA", "1..9", "L6", q(tag("L6"))), ("CDS", "1..9", "L6", q(tag("L6"))), ("ncRNA", "1..3", "L6", q(tag("L6"))),
        ("mRNA", "1..9", "L7", q(tag("L7"))), ("CDS", "1..9", "L7", q(tag("L7"))), ("regulatory", "1..3", "L7", q(tag("L7"))),  # not among the features that count
        ("mRNA", "order(1..3,5..9)", "L8", q(tag("L8"))), ("CDS", "order(1..3,5..9)", "L8", q(tag("L8"))),
    ]
    b = spark.createDataFrame([("e", i, *m) for i, m in enumerate(made)], "entry string, block_no bigint, feature string, location string, locus string, qualifiers array<struct<line_no:bigint,key:string,value:string>>")
    assert [made[i][2] for _, i in rows(review.redundant_mrna(b), "block_no")] == ["L1", "L7"]


def test_review_of_blocks(spark):
    q = lambda *pairs: [(i, *p) for i, p in enumerate(pairs)]
    made = [
        ("CDS", "join(1..30,40..40)", "L1", q(("locus_tag", "L1"))),
        ("CDS", "complement(join(<1..30,50..200))", "L2", q(("locus_tag", "L2"), ("codon_start", "2"))),
        ("CDS", "complement(50..200)", "L3", q(("locus_tag", "L3"))),
        ("CDS", "complement(50..200)", "L4", q(("locus_tag", "L4"))),
        ("CDS", "order(1..3,7..9)", "L5", q(("locus_tag", "L5"))),
        ("CDS", "1..300", "L6", q(("locus_tag", "L6"), ("codon_start", "4"))),
        ("CDS", "5..5", "L7", q(("locus_tag", "L7"), ("pseudogene", "unknown"))),
        ("misc_feature", "5..5", "L8", q(("locus_tag", "L8"))),
        ("tRNA", "7..70", "L9", q(("gene", "trnM-CAU"), ("product", "tRNA-Leu"))),
        ("tRNA", "7..70", "L10", q(("gene", "trnM-CAU"), ("product", "tRNA-Met"))),
        ("CDS", "<1..20", "L11", q(("locus_tag", "L11"))),
    ]
    b = spark.createDataFrame([("e", i, *m) for i, m in enumerate(made)], "entry string, block_no bigint, feature string, location string, locus string, qualifiers array<struct<line_no:bigint,key:string,value:string>>")
    got = sorted((r.warning, r.locus_tag, r.location, r.detail) for r in review.block_warnings(b).collect())
    assert got == sorted([
        ("short_cds", "L1", "join(1..30,40..40)", "31 coding bp; review against the 93 bp threshold"),
        ("single_base_cds_segment", "L1", "40", "CDS join(1..30,40..40)"),
        ("short_cds", "L11", "<1..20", "20 coding bp; review against the 93 bp threshold (partial CDS)"),
        ("shared_cds_segment", "L2,L3,L4", "complement(50..200)", "Exact same-strand segment at distinct loci"),
        ("unreviewed_cds_location", "L5", "order(1..3,7..9)", "Review the CDS location with the DDBJ validators"),
        ("unreviewed_codon_start", "L6", "1..300", "Unexpected codon_start=4"),
        ("trna_gene_product_mismatch", "L9", "7..70", "trnM-CAU indicates tRNA-Met; product=tRNA-Leu"),
    ])


def test_missing_coverage(spark):
    head = [("COMMON", 1, "DATATYPE", "", "type", "WGS")]
    data = [("a", 2, "source", "1..9", "organism", "o"), ("b", 3, "source", "1..9", "organism", "o"), ("b", 4, "ST_COMMENT", "", "Genome Coverage", "30x")]
    table = lambda some: spark.createDataFrame([(i, *x) for i, x in enumerate(some)], "line_no bigint, entry string, block_no bigint, feature string, location string, qualifier string, value string")
    entries = lambda some: [r.entry for r in review.warnings(table(some)).where("warning = 'missing_genome_coverage'").collect()]
    assert entries(head + data) == ["a"] and entries(head + data[:2]) == ["COMMON"] and entries(data) == []
    assert entries([*head, ("COMMON", 9, "ST_COMMENT", "", "Genome Coverage", "30x"), *data]) == []


def test_shared_transcript_keeps_the_genes_that_chose_it(spark):
    """ga chooses the shared transcript, gb its own longer one; ties go to the transcript's own place, not its parts'."""
    table = [
        ("gene", 1, 99, "ga", []), ("gene", 1, 99, "gb", []), ("mRNA", 1, 60, "shared", ["ga", "gb"]), ("CDS", 1, 30, None, ["shared"]), ("mRNA", 1, 99, "own", ["gb"]), ("CDS", 1, 60, None, ["own"]),
        ("gene", 1, 99, "gc", []), ("mRNA", 10, 50, "late", ["gc"]), ("CDS", 12, 20, None, ["late"]), ("mRNA", 5, 60, "early", ["gc"]), ("CDS", 20, 28, None, ["early"]), ("UTR", 1, 60, None, ["late"]),
    ]
    text = lambda i, p: ";".join(([f"ID={i}"] if i else []) + ([f"Parent={','.join(p)}"] if p else []))
    f = spark.createDataFrame([(n, "c", t, a, z, text(i, p), i, p) for n, (t, a, z, i, p) in enumerate(table)], "row_no bigint, seqid string, type string, start bigint, end bigint, attributes_text string, id string, parents array<string>")
    left = {r.row_no: r for r in stages.one_isoform(f).collect()}
    assert left[2].parents == ["ga"] and left[2].attributes_text == "ID=shared;Parent=ga" and left[4].parents == ["gb"]
    assert {r.id for r in left.values() if r.type == "mRNA"} == {"shared", "own", "early"} and 8 not in left and 11 not in left


def test_feature_keys_and_classes(spark):
    kinds = ["siRNA", "misc_RNA", "attenuator", "polyA_signal", "pseudogenic_transcript", "pseudogene", "LINE", "minisatellite", "silencer", "5_prime_UTR", "gene", "start_codon", "primary_transcript", "odd", "D-loop", "exon"]
    df = spark.createDataFrame([(i, k, {"pseudogene": "Processed"} if k == "pseudogene" else {"ncRNA_class": "other"} if k == "siRNA" else {}) for i, k in enumerate(kinds)], "i int, k string, a map<string,string>")
    got = [(r.key, r.c.ncRNA_class, r.c.regulatory_class, r.c.pseudogene) for r in df.select("i", render.feature_key(F.col("k")).alias("key"), render.feature_class(F.col("k"), F.col("a")).alias("c")).orderBy("i").collect()]
    assert [g[0] for g in got] == ["ncRNA", "misc_RNA", "regulatory", "regulatory", "misc_RNA", "misc_feature", "mobile_element", "repeat_region", "regulatory", "5'UTR", None, None, "prim_transcript", "misc_feature", "D-loop", "exon"]
    assert got[0][1] == "other" and got[3][2] == "polyA_signal_sequence" and got[8][2] == "other" and got[4][3] == "unknown" and got[5][3] == "processed" and got[1][3] is None


def test_cds_block_policies(spark):
    part = "array<struct<start:bigint,end:bigint,phase:string,row_no:bigint>>"
    made = [("cut", "c", "+", [(1, 30, "0", 1)], "ATG" + "A" * 24 + "TAA"), ("short", "c", "-", [(101, 109, "0", 2), (115, 120, "1", 3)], "GAAAAAAAAAAAAAA"), ("whole", "c", "+", [(201, 206, "0", 4)], "ATGTAA")]
    m = spark.createDataFrame(made, f"transcript_id string, seqid string, strand string, cds {part}, cds_seq string")
    gaps = spark.createDataFrame([("c", [(10, 12)])], "seqid string, gaps array<struct<start:bigint,end:bigint>>")
    a = spark.createDataFrame([(x[0], f"{x[0]} -like kinase", f"L_{x[0]}") for x in made], "ID string, Description string, Locus_tag string")
    ids = spark.createDataFrame([("whole", "P1")], "transcript_id string, protein_id string")
    of = lambda policy: {r.transcript_id: (r.feature, r.location, [q.key for q in r.qualifiers]) for r in render.cds_blocks(m, gaps, a, gap_policy=policy, protein_ids=ids).collect()}
    base = ["locus_tag", "note", "product", "transl_table", "codon_start"]
    misc, asis = of("misc_feature"), of("asis")
    assert misc["cut"] == ("misc_feature", "join(1..9,13..30)", base[:2]) and asis["cut"] == ("CDS", "join(1..9,13..30)", [*base, "artificial_location"])
    assert misc["short"] == ("CDS", "complement(join(<101..109,115..>120))", [*base, "artificial_location"])
    assert misc["whole"] == ("CDS", "201..206", [*base, "protein_id"])
    first = render.cds_blocks(m, gaps, a).where("transcript_id = 'whole'").first()
    assert first.qualifiers[2].value == "whole-like kinase"


def test_start_codons_of_the_code(spark):
    part = "array<struct<start:bigint,end:bigint,phase:string,row_no:bigint>>"
    m = spark.createDataFrame([(s, "c", "+", [(1, len(s), "0", 1)], s) for s in ("TTGAAATAA", "GTGAAATAA", "ATGAAAAAA")], f"transcript_id string, seqid string, strand string, cds {part}, cds_seq string")
    lengths = spark.createDataFrame([("c", 99)], "id string, length bigint")
    found = lambda code: {r.transcript_id: r.completeness for r in models.candidates(m, lengths, code).collect()}
    assert found(1) == {"TTGAAATAA": 2, "GTGAAATAA": 1, "ATGAAAAAA": 1} and found(11)["GTGAAATAA"] == 2
