"""Streams give what the same rows give at once, and files come back as written."""
from pyspark.sql import functions as F

from loomgene.functions import sequence as S
from loomgene.sources import fasta, gff3, tables
from loomgene.streaming import events


def test_windowed_counts(spark, sf, tmp_path):
    batch = spark.read.parquet(f"{sf}/events.parquet")
    src = str(tmp_path / "in")
    batch.write.parquet(src)
    q = events.counts(events.read(spark, src, batch.schema)).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(str(r.start), r.event_type): r.events for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = batch.groupBy(F.window(F.col("ts").cast("timestamp"), "1 hour"), "event_type").count()
    want = {(str(r.window.start), r.event_type): r["count"] for r in want.collect()}
    assert got and got.items() <= want.items()  # windows that the watermark hasn't passed are still open


def test_repaired_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.gff3").write_text("##gff-version 3\nc\ts\tgene\t1\t9\t.\t+\t.\tID=a;Note=b;c;\n")
    q = events.repaired(spark.readStream.text(str(tmp_path / "in"))).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = sorted((r.value, r.glued) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("##gff-version 3", False), ("c\ts\tgene\t1\t9\t.\t+\t.\tID=a;Note=b.c", True)]


def test_runs_of_nulls_and_wide_characters(spark):
    df = spark.createDataFrame([(0, "éNNxN"), (1, None), (2, ""), (3, "nN"), (4, "NA")], "i int, v string").coalesce(1)
    got = [None if r[0] is None else [(x.start, x.end) for x in r[0]] for r in df.orderBy("i").select(S.n_runs(F.col("v"))).collect()]
    assert got == [[(2, 3), (5, 5)], None, [], [(1, 2)], [(1, 1)]]


def test_files_come_back(spark, tmp_path):
    seqs = spark.createDataFrame([(1, "a", "a first", "ACGT" * 40), (2, "b", "b", "N")], "seq_no bigint, id string, description string, sequence string")
    fasta.write(seqs.coalesce(1), str(tmp_path / "fa"))
    assert [(r.id, r.description, r.sequence) for r in fasta.read(spark, str(tmp_path / "fa")).orderBy("seq_no").collect()] == [("a", "a first", "ACGT" * 40), ("b", "b", "N")]
    assert [r.id for r in fasta.without(seqs, spark.createDataFrame([("a",)], "id string")).collect()] == ["b"]
    (tmp_path / "x.gff3").write_text("##gff-version 3\nc\ts\tgene\t1\t9\t.\t+\t.\tID=a%2Cb\n##FASTA\n>c\nACGT\n")
    lines = gff3.lines(spark, str(tmp_path / "x.gff3"))
    gff3.write(gff3.features(lines), str(tmp_path / "gff"), lines)
    text = "".join(r.value + "\n" for r in spark.read.text(str(tmp_path / "gff")).collect())
    assert sorted(text.splitlines()) == sorted((tmp_path / "x.gff3").read_text().splitlines())
    hits = spark.createDataFrame([("d", "q", "s", 1.5)], "database string, qseqid string, sseqid string, pident double")
    tables.write_tsv(hits, str(tmp_path / "tsv"))
    assert tables.read_tsv(spark, str(tmp_path / "tsv"), hits.schema.simpleString()[7:-1].replace(":", " ")).first().pident == 1.5
    (tmp_path / "d.txt").write_text("# comment\nSer PF1.2 100 q1 - 300 1e-9 50 0.1 1 1 1e-8 1e-7 44.5 0.1 5 90 1 90 1 95 0.9 Serine repeat family\n")
    row = tables.domain_hits(spark, str(tmp_path / "d.txt")).first()
    assert (row.query_id, row.name, row.hmm_length, row.i_evalue, row.hmm_to, row.description) == ("q1", "Ser", 100, 1e-7, 90, "Serine repeat family")
