"""Ownership, fates, blocks and events of feature rows, against a plain depth-first walk and by cases."""
import random

import pytest
from pyspark.sql import functions as F

from loomgene.operators import graph, traversal

COLUMNS = "row_no bigint, seqid string, source string, type string, start bigint, end bigint, score string, strand string, phase string, attributes_text string, attributes map<string,string>, id string, parents array<string>"


def table(spark, rows):
    """rows: (type, start, end, strand, id, parents, attributes[, seqid[, phase]])."""
    full = [(i + 1, r[7] if len(r) > 7 else "c", "s", r[0], r[1], r[2], ".", r[3], r[8] if len(r) > 8 else ".", ".", r[6], r[4], r[5]) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, COLUMNS)


def walk(rows):
    """row -> (owner, unit, turn) by visiting."""
    n = range(len(rows))
    kids, at = {}, {}
    for i in n:
        for p in rows[i][5]:
            kids.setdefault(p, []).append(i)
    for k in kids.values():
        k.sort(key=lambda i: (rows[i][1], rows[i][2], rows[i][0], rows[i][4] or "", i))
    seen = {}

    def down(i, owner, unit, turn):
        if i in seen:
            return
        seen[i] = (owner, unit, turn)
        if rows[i][4] and rows[i][0] not in (*traversal.CONTAINERS, *traversal.CODONS):
            for k in kids.get(rows[i][4], []):
                down(k, owner, (k if rows[owner][0] == "gene" and i == owner else unit), turn)

    for g in sorted((i for i in n if rows[i][0] == "gene"), key=lambda i: (rows[i][1], rows[i][2], rows[i][4] or "", i)):
        down(g, g, g, 0)
    transcripts = {rows[i][4] for i in n if rows[i][0] in ("mRNA", "transcript")}
    for i in n:
        if rows[i][0] in ("mRNA", "transcript") or not transcripts & set(rows[i][5]):
            down(i, i, i, 1)
    return {i + 1: (o + 1, u + 1, t) for i, (o, u, t) in seen.items()}


def test_visits_are_those_of_a_walk(spark):
    rng = random.Random(4)
    rows, ids = [], []
    for i in range(400):
        kind = rng.choice(["gene", "gene", "mRNA", "transcript", "exon", "CDS", "tRNA", "ncRNA", "start_codon", "region", "repeat"])
        parents = [rng.choice(ids)] if ids and kind != "gene" and rng.random() < 0.8 else []
        own = f"{kind}{i}" if rng.random() < 0.9 else None
        rows.append((kind, s := rng.randrange(1, 1000), s + rng.randrange(50), "+", own, parents, {}))
        if own:
            ids.append(own)
    rng.shuffle(rows)  # children before their parents too
    got = {r.row_no: (r.owner, r.unit, r.turn) for r in traversal.visits(table(spark, rows)).collect()}
    assert got == walk(rows)


def test_paths_and_nearest_ancestors(spark):
    chain = [(i, i - 1 if i else None, (i * 7) % 50) for i in range(200)] + [(1000, 999, 1), (2000, None, 0)]
    got = {r.id: (r.best, r.below) for r in graph.first_on_path(spark.createDataFrame(chain, "id bigint, up bigint, key bigint")).collect()}
    for i in range(200):
        best = min(range(i, -1, -1), key=lambda k: (k * 7) % 50)
        key = (best * 7) % 50
        on = [k for k in range(i, -1, -1) if (k * 7) % 50 == key][0]  # the nearest of that key
        assert got[i] == (key, on + 1 if on < i else None)
    assert got[1000] == (1, None) and got[2000] == (0, None)
    pairs = spark.createDataFrame([(i, i - 1) for i in range(1, 100)] + [(200, 201), (201, 200)], "child bigint, parent bigint")
    near = {r.child: r.ancestor for r in graph.nearest_ancestors(pairs, spark.createDataFrame([(0,), (30,), (31,)], "id bigint")).collect()}
    assert near == {i: 0 if i <= 30 else 30 if i == 31 else 31 for i in range(1, 100)}


CASES = [
    ("gene", 1, 300, "+", "g1", [], {"Name": "abc", "gene_synonym": "x, y"}),
    ("mRNA", 1, 300, "+", "t1", ["g1"], {"Dbxref": "A:1,B:2", "product": "own"}),
    ("five_prime_UTR", 1, 20, "+", None, ["t1"], {}),
    ("CDS", 21, 60, "+", "c1", ["t1"], {}),
    ("CDS", 101, 140, "+", "c1", ["t1"], {}),
    ("three_prime_UTR", 141, 150, "+", None, ["t1"], {}),
    ("polyA_site", 150, 150, "+", "p1", ["t1"], {"Note": "end"}),
    ("gene", 400, 500, "-", "g2", [], {}),
    ("tRNA", 400, 500, "-", "r2", ["g2"], {"Name": "tRNA-Ser", "anticodon": "(pos:1..3,aa:Ser)"}),
    ("exon", 400, 430, "-", None, ["r2"], {}),
    ("exon", 450, 500, "-", None, ["r2"], {}),
    ("gene", 600, 700, "+", "g3", [], {"Name": "lone"}),
    ("gene", 800, 900, "+", "g4", [], {"pseudogene": "processed"}),
    ("mRNA", 800, 900, "+", "t4", ["g4"], {}),
    ("CDS", 800, 850, "+", None, ["t4"], {}),
    ("gene", 1000, 1100, "+", "g5", [], {}),
    ("CDS", 1000, 1020, "+", "c5", ["g5"], {"product": "split"}, "c", "1"),
    ("CDS", 1050, 1100, "+", "c5", ["g5"], {}, "c", "0"),
    ("rRNA", 1200, 1300, "+", "r6", [], {"product": "16S"}),
    ("repeat", 1400, 1450, "-", None, [], {"rpt_type": "tandem"}),
    ("novel", 1500, 1510, "+", None, [], {"Note": "odd"}),
    ("gene", 1600, 1700, "+", "g7", [], {}),
    ("rRNA", 1600, 1700, "+", "r7", ["g7"], {"product": "18S"}),
    ("rRNA", 1620, 1630, "+", "i7", ["g7"], {"product": "ITS1"}),
    ("gene", 1800, 1900, "+", "g8", [], {}),
    ("mRNA", 1800, 1900, "+", "t8", ["g8"], {"product": "swapped"}),
    ("exon", 1800, 1900, "+", None, ["t8"], {}),
    ("misc_feature", 1810, 1820, "+", None, ["t8"], {"Note": traversal.REPLACEMENT + "internal stops", "Dbxref": "Q:1"}),
    ("misc_feature", 1830, 1840, "+", None, ["t8"], {"Note": traversal.REPLACEMENT + "internal stops", "Dbxref": "Q:1"}),
    ("exon", 1950, 1960, "+", None, ["t9"], {}),
    ("mRNA", 1950, 2000, "+", "t9", [], {}),
]


@pytest.fixture(scope="module")
def made(spark):
    sequences = spark.createDataFrame([("c", 1)], "id string, seq_no int")
    runs = spark.createDataFrame([("c", 31, 36), ("c", 131, 136), ("c", 1405, 1409)], "seqid string, r_start bigint, r_end bigint")
    annotation = spark.createDataFrame([("t1", "kinase", "AB_7"), ("g5", "of the gene", None)], "ID string, Description string, Locus_tag string")
    found, named = traversal.blocks(table(spark, CASES), sequences, runs, annotation, "AB_", gap_policy="asis")
    events = {r.event: r.n for r in traversal.event_counts(found, named).collect()}
    fates = {r.row_no: r.fate for r in named.collect()}
    return [(r.row_no, r.feature, r.location, [(q.key, q.value) for q in r.qualifiers]) for r in found.orderBy("visit").collect()], fates, events


def test_blocks_of_cases(made):
    blocks, fates, events = made
    by = {}
    for row, feature, location, q in blocks:
        by.setdefault(row, []).append((feature, location, q))
    low = ("artificial_location", traversal.LOW_QUALITY)
    # UTR and CDS merged where they touch, without the runs of N
    assert by[2] == [("mRNA", "join(1..30,37..60,101..130,137..150)", [("locus_tag", "AB_7"), ("note", "db_xref:A:1"), ("note", "db_xref:B:2"), ("note", "transcript_id:t1"), low])]
    assert by[7] == [("polyA_site", "150", [("locus_tag", "AB_7"), ("note", "end")])]
    assert by[9] == [("tRNA", "complement(join(400..430,450..500))", [("product", "tRNA-Ser"), ("locus_tag", "AB_000000200"), ("anticodon", "(pos:1..3,aa:Ser)")])]
    assert by[10] == [("exon", "complement(400..430)", [("locus_tag", "AB_000000200")])]
    assert by[12] == [("misc_feature", "600..700", [("locus_tag", "AB_000000300"), ("gene", "lone"), ("note", "GFF3 feature type: gene")])]
    assert by[13][0][0] == "misc_feature" and ("pseudogene", "processed") in by[13][0][2]
    assert by[14] == [("misc_RNA", "800..850", [("locus_tag", "AB_000000400"), ("pseudogene", "processed"), ("note", "transcript_id:t4")])]
    assert by[17] == [("CDS", "join(1000..1020,1050..1100)", [("locus_tag", "AB_000000500"), ("note", "transcript_id:g5"), ("product", "of the gene"), ("transl_table", "1"), ("codon_start", "2")])]
    assert by[19] == [("rRNA", "1200..1300", [("locus_tag", "AB_000000800"), ("product", "16S rRNA"), ("note", "transcript_id:r6")])]
    assert by[20] == [("repeat_region", "complement(join(1400..1403,1410..1450))", [("rpt_type", "tandem"), low])]
    assert by[21] == [("misc_feature", "1500..1510", [("note", "odd; GFF3 feature type: novel")])]
    assert by[23][0] == ("rRNA", "1600..1700", [("product", "18S rRNA"), ("locus_tag", "AB_000000600"), ("note", "transcript_id:r7")])
    assert by[24][0] == ("misc_RNA", "1620..1630", [("note", "internal transcribed spacer 1"), ("locus_tag", "AB_000000600"), ("note", "transcript_id:i7")])
    assert by[26] == [
        ("mRNA", "1800..1900", [("locus_tag", "AB_000000700"), ("note", "transcript_id:t8")]),
        ("misc_feature", "join(1810..1820,1830..1840)", [("locus_tag", "AB_000000700"), ("note", "transcript_id:t8"), ("note", "swapped"), ("db_xref", "Q:1"), ("note", traversal.REPLACEMENT + "internal stops")]),
    ]
    assert by[31][0][:2] == ("mRNA", "1950..1960") and by[31][0][2][0] == ("locus_tag", "AB_000000900")
    # in the order of the visit: genes by place with what they own, then the rest
    assert [row for row, *_ in blocks] == [2, 7, 9, 10, 11, 12, 13, 14, 17, 23, 24, 26, 26, 19, 20, 21, 31]
    assert {r: f for r, f in fates.items() if r not in by and f not in ("coding", "container")} == {3: "omitted_utr", 6: "omitted_utr", 15: "covered", 18: "cds", 27: "omitted_exon", 28: "replaced", 29: "replaced", 30: "omitted_exon"}
    assert events == {"mrna_emitted": 3, "non_cds_features": 16, "unknown_features": 1, "omitted_utr_features": 2, "omitted_exon_features": 2}


def test_structure_that_says_no_more_than_the_cds_is_left_out(spark):
    rows = [("gene", 1, 90, "+", "g", [], {}), ("mRNA", 1, 90, "+", "t", ["g"], {}), ("exon", 1, 30, "+", None, ["t"], {}), ("exon", 61, 90, "+", None, ["t"], {}), ("CDS", 1, 30, "+", None, ["t"], {}), ("CDS", 61, 90, "+", None, ["t"], {}), ("intron", 31, 60, "+", None, ["t"], {}), ("exon", 61, 95, "-", None, ["t"], {})]
    fate = lambda r: [x.fate for x in traversal.fates(table(spark, r)).orderBy("row_no").collect()]
    assert fate(rows[:7]) == ["container", "mrna", "suppressed", "suppressed", "coding", "coding", "suppressed"]
    # an exon beyond the CDS, or a second transcript, makes the structure worth telling; exons inside the mRNA's parts still go
    assert fate(rows) == ["container", "mrna", "omitted_exon", "omitted_exon", "coding", "coding", "generic", "generic"]
    assert fate([*rows[:7], ("transcript", 1, 50, "+", "t2", ["g"], {})]) == ["container", "mrna", "omitted_exon", "omitted_exon", "coding", "coding", "generic", "mrna"]
    utr = [("mRNA", 1, 90, "+", "t", [], {}), ("CDS", 1, 30, "+", None, ["t"], {}), ("3'UTR", 31, 40, "+", None, ["t"], {}), ("3'UTR", 60, 61, "-", None, ["t"], {})]
    assert fate(utr) == ["mrna", "coding", "omitted_utr", "generic"]
    assert [x.fate for x in traversal.fates(table(spark, utr), retain_utrs=True).orderBy("row_no").collect()] == ["mrna", "coding", "generic", "generic"]


def test_no_rows(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert traversal.fates(empty).count() == 0


def test_tours_of_random_forests(spark):
    rng = random.Random(8)
    up = {i: rng.choice([*range(max(0, i - 6), i), None]) if i else None for i in range(300)} | {i: i - 1 for i in range(301, 700)} | {300: None, 900: 901, 901: 900, 950: 7777}
    key = {i: rng.random() for i in up}
    nodes = spark.createDataFrame([(i, u, key[i]) for i, u in up.items()], "id bigint, up bigint, key double")
    got = {r.id: (r.root, r.nth, r.size, r.depth) for r in graph.tours(nodes).collect()}
    kids = {}
    for i, u in up.items():
        kids.setdefault(u if u in up else None, []).append(i)
    want = {}

    def down(i, root, depth, n):
        mine, stack, count = n, [], 1
        for k in sorted(kids.get(i, []), key=key.get):
            count += down(k, root, depth + 1, n + count)
        want[i] = (root, mine, count, depth)
        return count

    import sys

    sys.setrecursionlimit(5000)
    for r in kids[None]:
        down(r, r, 0, 0)
    assert got == want  # 900 and 901 are a cycle
    pairs = {(r.ancestor, r.id) for r in graph.descendants(graph.tours(nodes), spark.createDataFrame([(0,), (1,), (5,), (690,)], "id bigint")).collect()}
    chain = lambda i: [] if up.get(i) not in up else [up[i], *chain(up[i])]
    assert pairs == {(a, i) for i in want for a in chain(i) if a in (0, 1, 5, 690)}


def test_rows_of_one_start_come_as_a_queue_serves_them(spark):
    from loomgene.operators import stages

    rng = random.Random(3)
    rows = []
    for i in range(200):
        parents = [f"x{rng.randrange(200)}"] if rng.random() < 0.7 else []
        rows.append(("gene", rng.randrange(1, 4), 9, "+", f"x{i}", parents if parents != [f"x{i}"] else [], {}))
    out = stages.hierarchical_order(table(spark, rows)).orderBy("seqid", "start", "depth", "visit", "row_no")
    want = []
    for start in (1, 2, 3):
        own = [i for i, r in enumerate(rows) if r[1] == start]
        index = {rows[i][4]: i for i in own}
        queue = [i for i in own if not rows[i][5] or rows[i][5][0] not in index]
        for i in queue:
            queue += [k for k in own if rows[k][5] == [rows[i][4]]]
        want += queue + [i for i in own if i not in queue]
    assert [r.row_no - 1 for r in out.collect()] == want


def test_removal_on_long_chains_and_several_parents(spark):
    rng = random.Random(6)
    for _ in range(2):
        edges = {(i, rng.randrange(max(0, i - 4), i)) for i in range(1, 150)} | {(i, rng.randrange(0, i)) for i in rng.sample(range(1, 150), 40)} | {(i, i - 1) for i in range(201, 500)} | {(600, 601), (601, 600)}
        seeds = {3, 200, 350, 777}
        gone = set(seeds)
        while True:
            more = {c for c, _ in edges if c not in gone and all(p in gone for x, p in edges if x == c)}
            if not more:
                break
            gone |= more
        got = [r.id for r in graph.removed(spark.createDataFrame(list(edges), "child bigint, parent bigint"), spark.createDataFrame([(s,) for s in seeds], "id bigint")).collect()]
        assert sorted(got) == sorted(gone)
