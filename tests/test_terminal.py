"""Codons and introns that follow their CDS and exons."""
import pytest

from loomgene.operators import stages, terminal
from loomgene.shared import same_ids
from tests.test_traversal import COLUMNS, table


def places(df, kind):
    return [(r.start, r.end) for r in df.where(f"type = '{kind}'").orderBy("row_no").collect()]


def model(strand, cds, others, phase="0"):
    rows = [("mRNA", 1, 100, strand, "t", [], {})]
    rows += [("CDS", a, z, strand, None, ["t"], {}, "c", phase) for a, z in cds] + [("exon", a, z, strand, None, ["t"], {}) for a, z in cds]
    return rows + [(kind, a, z, strand, None, ["t"], {}) for kind, a, z in others]


@pytest.mark.parametrize(
    ("strand", "start", "stop"),
    [("+", [(10, 10), (20, 21)], [(40, 40), (31, 32)]), ("-", [(40, 40), (31, 32)], [(10, 10), (20, 21)])],
)
def test_split_codons(spark, strand, start, stop):
    cds = [(10, 10), (20, 25), (31, 32), (40, 40)]
    codons = [(kind, a, a + 2) for kind in ("start_codon", "stop_codon") for a in (1, 5)]
    out = terminal.rebuilt(table(spark, model(strand, cds, codons)))
    # rows are taken in reading order, spans from the end of the CDS inwards
    order = (lambda x: x) if strand == "+" else (lambda x: x[::-1])
    assert places(out, "start_codon") == order(start) and places(out, "stop_codon") == order(stop)
    assert {r.phase for r in out.where("type like '%codon'").collect()} == {"0"}
    # one row can't say a split codon; a third one is too many
    one = terminal.rebuilt(table(spark, model(strand, cds, codons[:1] + codons[2:3])))
    assert places(one, "start_codon") == places(one, "stop_codon") == []
    more = terminal.rebuilt(table(spark, model(strand, cds, [*codons[:2], ("start_codon", 7, 9)])))
    assert len(places(more, "start_codon")) == 2


def test_cds_shorter_than_a_codon_and_transcripts_without_cds(spark):
    assert places(terminal.rebuilt(table(spark, model("+", [(5, 6)], [("start_codon", 5, 7)]))), "start_codon") == []
    assert places(terminal.rebuilt(table(spark, model("+", [], [("start_codon", 5, 7), ("intron", 8, 9)]))), "intron") == [(8, 9)]


def test_introns(spark):
    exons = [(1, 10), (11, 20), (31, 40), (51, 60)]
    assert places(terminal.rebuilt(table(spark, model("+", exons, [("intron", 5, 6), ("intron", 7, 8), ("intron", 9, 9)]))), "intron") == [(21, 30), (41, 50)]
    assert places(terminal.rebuilt(table(spark, model("-", exons, [("intron", 5, 6)]))), "intron") == [(41, 50)]


def test_into_frame_moves_codons(spark):
    """A CDS of 8 bases and phase 1 begins at its second base and has six bases; codons, exon, transcript and gene follow."""
    rows = [("gene", 1, 8, "+", "g", [], {}), ("mRNA", 1, 8, "+", "t", ["g"], {}), ("exon", 1, 8, "+", None, ["t"], {}), ("CDS", 1, 8, "+", None, ["t"], {}, "c", "1"), ("start_codon", 1, 3, "+", None, ["t"], {}), ("stop_codon", 6, 8, "+", None, ["t"], {}), ("polyA_site", 8, 8, "+", None, ["t"], {})]
    out = stages.into_frame(table(spark, rows))
    assert [(r.type, r.start, r.end) for r in out.orderBy("row_no").collect()] == [("gene", 2, 7), ("mRNA", 2, 7), ("exon", 2, 7), ("CDS", 2, 7), ("start_codon", 2, 4), ("stop_codon", 5, 7)]


def test_padding_that_makes_one_id_of_two_is_refused(spark):
    rows = [(i, "c", "s", "gene", 1, 2, ".", "+", ".", f"ID={x}", {"ID": x}, x, []) for i, x in enumerate(("g7", "AB_g007", "g8"))]
    features = spark.createDataFrame(rows, COLUMNS)
    assert [r.id for r in stages.padded_loci(features.where("row_no <> 1"), "AB", 3, "g").orderBy("row_no").collect()] == ["AB_g007", "AB_g008"]
    with pytest.raises(ValueError, match="AB_g007 from AB_g007 and g7"):
        stages.padded_loci(features, "AB", 3, "g")


def test_sets_of_ids_must_agree(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    same_ids(ids("a", "b", "a"), ids("b", "a"), "id", "tables")
    with pytest.raises(ValueError, match=r"tables \(12\): \+a, -b0, -b1, -b10, "):
        same_ids(ids("a", "c"), ids("c", *(f"b{i}" for i in range(11))), "id", "tables")
