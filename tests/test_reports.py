"""Reports and organelle checks on small examples."""
import pytest
from pyspark.sql import functions as F

from loomgene.operators import organelles
from loomgene.sources import reports


def test_domain_sections(spark, tmp_path):
    hit = "\t".join(["1", "Q#1", "Specific", "99", "1", "80", "1e-9", "55.5", "cd1", "Abc", "-"])
    (tmp_path / "d.txt").write_text("DATA\nSESSION\t1\n" + "".join(f"QUERY\tQ#{i}\tPeptide\t90\tp{i} text\nDOMAINS\n{hit}\nENDDOMAINS\n1\tother\nENDQUERY\n" for i in (1, 2)))
    got = [tuple(r) for r in reports.domain_sections(spark, str(tmp_path / "d.txt")).drop("line_no").orderBy("query_id").collect()]
    assert got == [(q, "Specific", "99", 1e-9, 55.5, "cd1", "Abc", "-") for q in ("p1", "p2")]


def test_logs_and_summaries(spark, tmp_path):
    (tmp_path / "p.log").write_text("noise\na, b, original_seqlen=10, head_padding=1, tail_padding=2, original_num_stop=3, new_num_stop=0\n")
    assert tuple(reports.padding_log(spark, str(tmp_path / "p.log")).first()) == ("a, b", 10, 1, 2, 3, 0)
    (tmp_path / "s.txt").write_text("# The lineage dataset is: fungi_odb10 (x)\n\n\tC:98.5%[S:90.0%,D:8.5%],F:1.0%,M:0.5%,n:200\n")
    assert tuple(reports.completeness(spark, str(tmp_path / "s.txt")).first()) == ("fungi_odb10", 200, 98.5, 90.0, 8.5, 1.0, 0.5)
    (tmp_path / "ids.txt").write_text(" b \n\na\nb\n")
    assert [r.id for r in reports.ids(spark, str(tmp_path / "ids.txt")).orderBy("line_no").collect()] == ["b", "a"]


def test_organelle_checks(spark):
    df = spark.createDataFrame([("trnM-CAU", "tRNA-Met", " 30x"), ("trnfM", "tRNA-Xyz", "UNKNOWN"), ("trnK", None, "12.5X"), ("x", None, ""), ("x", None, None)], "g string, p string, c string")
    got = [(r.t.gene, r.t["product"], r.c) for r in df.select(organelles.trna_amino_acids(F.col("g"), F.col("p")).alias("t"), organelles.genome_coverage(F.col("c")).alias("c")).collect()]
    assert got == [("Met", "Met", "30x"), (None, None, "Unknown"), ("Lys", None, "12.5x"), (None, None, ""), (None, None, "")]
    for bad in ("30", "0x", "about 5", "30 x"):
        with pytest.raises(Exception, match="genome coverage"):
            spark.createDataFrame([(bad,)], "c string").select(organelles.genome_coverage(F.col("c"))).collect()
    cds = spark.createDataFrame([("a", 1, 10, 0), ("a", 2, 5, 2), ("a", 3, 6, 1)], "id string, order_no int, length bigint, phase int")
    assert [(r.order_no, r.expected) for r in organelles.phase_breaks(cds).collect()] == [(3, 0)]
    g = spark.createDataFrame([("m", "core", "complete"), ("m", "core", "partial"), ("m", "rna", "not_evaluated")], "record string, category string, state string")
    got = {r.category: (r.genes, r.complete_percent, r.detected_percent) for r in organelles.assessment(g).collect()}
    assert got == {"core": (2, 50.0, 100.0), "rna": (1, None, None)}
    p = spark.createDataFrame([("a", 1, 5), ("a", 5, 9), ("b", 1, 4), ("b", 5, 9)], "id string, start int, end int")
    assert [r.id for r in organelles.overlapping_parts(p).collect()] == ["a"]
