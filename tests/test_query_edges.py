"""Queries against their SQL on small tables of what large ones hold."""
import duckdb
import pytest

from loomgene.operators import organelles, traversal
from tests.test_queries import compare
from tests.test_traversal import table


def tables(tmp_path, **selects):
    """A folder of the tables that these SELECTs give."""
    con = duckdb.connect()
    for name, sql in selects.items():
        con.execute(f"COPY ({sql}) TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
    return str(tmp_path)


def lines(*rows):
    """Lines of l_orderkey, l_partkey, l_linenumber, l_quantity, l_tax and l_returnflag."""
    values = ", ".join(f"({o}::BIGINT, {p}::BIGINT, {n}::INTEGER, {q}::DOUBLE, {tax}::DOUBLE, '{flag}')" for o, p, n, q, tax, flag in rows)
    return f"SELECT * FROM (VALUES {values}) t(l_orderkey, l_partkey, l_linenumber, l_quantity, l_tax, l_returnflag)"


def test_organelle_features_of_equal_numbers(spark, tmp_path):
    """Lines of one order, or of two, whose numbers are equal, as part keys pass 100000: of a tag, of a place, of both, and one line twice."""
    rows = [(3, 7, 3, 5, 0.01, "N"), (3, 100007, 2, 5, 0.01, "N"), (4, 8, 3, 6, 0.01, "R"), (4, 100008, 2, 6, 0.01, "R"), (6, 9, 3, 7, 0.08, "R"), (6, 100009, 2, 7, 0.01, "N")]
    rows += [(1, 200001, 7, 5, 0.01, "R"), (2, 1, 1, 5, 0.01, "R"), (5, 7, 3, 5, 0.08, "A"), (5, 7, 3, 5, 0.01, "A"), (5, 7, 3, 5, 0.01, "A"), (5, 7, 3, 5, 0.08, "R"), (5, 100007, 2, 5, 0.08, "A")]
    sf = tables(tmp_path, lineitem=lines(*rows), orders="SELECT range AS o_orderkey, 1::BIGINT AS o_custkey FROM range(8)")
    assert compare(spark, sf, "q_organelle_parent") == 17


@pytest.mark.parametrize("name", ["q_event_summary", "q_rna_blocks"])
def test_features_where_an_exon_has_a_run(spark, tmp_path, name):
    """RNAs, their exons, and a CDS without a transcript lie where an exon of their order has its run of N."""
    rows = [(1, 0, 2, 40), (1, 10000, 5, 20), (1, 10001, 3, 30), (4, 0, 1, 9), (4, 0, 2, 40), (4, 9000, 5, 20), (4, 10003, 6, 10), (7, 5, 2, 40), (10, 0, 2, 30), (10, 10001, 5, 9), (10, 20000, 7, 5), (12, 3, 1, 5), (12, 3, 4, 5)]
    sf = tables(tmp_path, lineitem=lines(*((*r, 0.0, "N") for r in rows)), orders="SELECT range AS o_orderkey FROM range(1, 14)")
    assert compare(spark, sf, name) > 1


def test_runs_cut_what_lies_there(spark):
    """What the tables above would give with their runs: the operator cuts an RNA, and makes a CDS without a transcript misc_feature."""
    rows = [("gene", 1, 90, "+", "g1", [], {}), ("tRNA", 10, 40, "+", "r1", ["g1"], {}), ("CDS", 20, 60, "+", "c1", ["g1"], {}), ("exon", 15, 55, "+", "e1", ["t1"], {})]
    sequences = spark.createDataFrame([("c", 1)], "id string, seq_no int")
    runs = spark.createDataFrame([("c", 25, 27)], "seqid string, r_start bigint, r_end bigint")
    found, named = traversal.blocks(table(spark, rows), sequences, runs, spark.createDataFrame([], "ID string, Description string, Locus_tag string"), "AB_")
    got = {r.feature: (r.location, "artificial_location" in [q.key for q in r.qualifiers]) for r in found.where("feature <> 'exon'").collect()}
    assert got == {"tRNA": ("join(10..24,28..40)", True), "misc_feature": ("join(20..24,28..60)", False)}
    assert "gap_misc_feature" in {r.event for r in traversal.event_counts(found, named).collect()}


def test_tags_in_use_of_seven_digits(spark, tmp_path):
    """A part key of 1000001 takes that number alone, not the one of its first six digits."""
    sf = tables(tmp_path, lineitem=lines(*((1, p, 1, 1, 0.0, flag) for p, flag in ((1000001, "R"), (3, "R"), (100002, "R"), (7, "A")))), orders="SELECT range AS o_orderkey, CASE WHEN range < 100005 THEN 'F' ELSE 'P' END AS o_orderstatus FROM range(100010)")
    assert compare(spark, sf, "q_organelle_tags") == 100010


def test_tags_of_more_than_six_digits_stay_whole(spark):
    """Longer numbers are not cut, which would give one tag to several genes."""
    wanted = spark.range(2).selectExpr("'F' AS item", "1 AS item_no", "CAST(id AS STRING) AS identity", "id AS place")
    reserved = spark.range(1, 1000001).selectExpr("format_string('AB_F%06d', id) AS locus_tag")
    assert {r.locus_tag for r in organelles.assigned_tags(wanted, reserved, "AB").collect()} == {"AB_F1000001", "AB_F1000002"}


def test_loci_of_more_than_nine_digits_stay_whole(spark):
    rows = traversal.fates(table(spark, [("gene", 1, 90, "+", "g1", [], {}), ("gene", 100, 190, "+", "g2", [], {})]))
    sequences = spark.createDataFrame([("c", 1)], "id string, seq_no int")
    assert {r.row_no: r.locus for r in traversal.loci(rows, sequences, "AB_", step=500000050).collect()} == {1: "AB_500000050", 2: "AB_1000000100"}
