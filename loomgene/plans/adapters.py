"""General tables seen as sequences, features, hits, links and intervals."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LETTERS = string.ascii_letters
BASES = "".join("ACGT"[i % 4] for i in range(26)) * 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day(column: str):
    return F.unix_date(F.col(column).cast("date")).cast("bigint")


def seqs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and seq: letters become bases, everything else N."""
    return table(spark, sf_dir, "documents").select("doc_id", F.regexp_replace(F.translate("text", LETTERS, BASES), "[^ACGT]", "N").alias("seq"))


SEQS = f"seqs AS (SELECT doc_id, regexp_replace(translate(text, '{LETTERS}', '{BASES}'), '[^ACGT]', 'N', 'g') AS seq FROM documents)"


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gene, transcript, kind, start, end: lines of orders as parts of transcripts."""
    kind = F.when(F.col("l_returnflag") == "R", "UTR").otherwise("CDS")
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("gene"), F.concat_ws(".", "l_orderkey", "l_linenumber").alias("transcript"), kind.alias("kind"), F.col("l_partkey").alias("start"), (F.col("l_partkey") + F.col("l_quantity").cast("bigint") - 1).alias("end"))


PARTS = """parts AS (
  SELECT l_orderkey AS gene, l_orderkey || '.' || l_linenumber AS transcript, CASE WHEN l_returnflag = 'R' THEN 'UTR' ELSE 'CDS' END AS kind,
    l_partkey AS s, l_partkey + CAST(l_quantity AS BIGINT) - 1 AS e
  FROM lineitem)"""


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supp, flag, row (order.line.part), start, end: days from shipping on, as many as the quantity."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("supp"), F.col("l_returnflag").alias("flag"), F.concat_ws(".", "l_orderkey", "l_linenumber", "l_partkey").alias("row"), day("l_shipdate").alias("start"), (day("l_shipdate") + F.col("l_quantity").cast("bigint")).alias("end"))


DAY = "CAST(date_diff('day', DATE '1970-01-01', CAST({} AS DATE)) AS BIGINT)"
SPANS = f"""spans AS (
  SELECT l_suppkey AS supp, l_returnflag AS flag, l_orderkey || '.' || l_linenumber || '.' || l_partkey AS row_id,
    {DAY.format("l_shipdate")} AS s, {DAY.format("l_shipdate")} + CAST(l_quantity AS BIGINT) AS e
  FROM lineitem)"""


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders as hits of queries (orders) to subjects (parts)."""
    flag = F.col("l_returnflag")
    relation = F.when(F.col("l_linestatus") == "F", "same_family").otherwise("unknown")
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_orderkey").alias("qseqid"),
            ((F.col("l_linenumber") * 1000000 + F.col("l_partkey")) * 100000 + F.col("l_suppkey")).cast("bigint").alias("hit_no"),
            F.when(flag == "A", "swissprot").when(flag == "N", "uniref90").otherwise("reference").alias("database"),
            F.when(flag == "A", 1.0).when(flag == "N", 0.5).otherwise(1.2).alias("weight"),
            relation.alias("taxonomy_relation"),
            F.when(F.col("l_linestatus") == "F", 1.25).otherwise(0.9).alias("taxonomy_weight"),
            (F.lit(30.0) + F.col("l_quantity")).alias("pident"),
            (F.lit(60.0) + F.col("l_quantity") / 2).alias("qcovhsp"),
            (F.lit(100.0) - F.col("l_quantity") / 2).alias("scovhsp"),
            F.lit(1e-20).alias("evalue"),
            (F.col("l_extendedprice") / 100).alias("bitscore"),
            F.when(F.col("p_size") % 7 == 0, "hypothetical protein").when(F.col("p_size") % 11 == 0, "").otherwise(F.col("p_name")).alias("description"),
        )
    )


HITS = """hits AS (
  SELECT l_orderkey AS qseqid, (CAST(l_linenumber AS BIGINT) * 1000000 + l_partkey) * 100000 + l_suppkey AS hit_no,
    CASE l_returnflag WHEN 'A' THEN 'swissprot' WHEN 'N' THEN 'uniref90' ELSE 'reference' END AS database,
    CASE l_returnflag WHEN 'A' THEN 1.0::DOUBLE WHEN 'N' THEN 0.5::DOUBLE ELSE 1.2::DOUBLE END AS weight,
    CASE WHEN l_linestatus = 'F' THEN 'same_family' ELSE 'unknown' END AS relation,
    CASE WHEN l_linestatus = 'F' THEN 1.25::DOUBLE ELSE 0.9::DOUBLE END AS taxonomy_weight,
    30.0::DOUBLE + l_quantity AS pident, 60.0::DOUBLE + l_quantity / 2 AS qcov, 100.0::DOUBLE - l_quantity / 2 AS scov,
    l_extendedprice / 100 AS bitscore, CASE WHEN p_size % 7 = 0 THEN 'hypothetical protein' WHEN p_size % 11 = 0 THEN '' ELSE p_name END AS description
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, name, source: parts as genes with product names."""
    n = F.col("p_size") % 5
    source = F.when(n == 0, "none").when(n == 1, "swissprot").when(n == 2, "uniref90").when(n == 3, "pfam").otherwise("existing")
    name = F.when(F.col("p_size") % 4 == 0, F.concat("p_name", F.lit(" protein 2"))).when(F.col("p_size") % 4 == 1, F.concat(F.initcap("p_name"), F.lit(" 3"))).otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), name.alias("name"), source.alias("source"))


NAMED = r"""named AS (
  SELECT p_partkey AS id,
    CASE p_size % 4 WHEN 0 THEN lower(p_name) || ' protein 2' WHEN 1 THEN lower(p_name) || ' 3' ELSE lower(p_name) END AS surface,
    CASE p_size % 4 WHEN 0 THEN p_name || ' protein 2' WHEN 1 THEN upper(left(split_part(p_name, ' ', 1), 1)) || substr(split_part(p_name, ' ', 1), 2) || ' ' || upper(left(split_part(p_name, ' ', 2), 1)) || substr(split_part(p_name, ' ', 2), 2) || ' 3' ELSE p_name END AS name,
    CASE p_size % 5 WHEN 0 THEN 'none' WHEN 1 THEN 'swissprot' WHEN 2 THEN 'uniref90' WHEN 3 THEN 'pfam' ELSE 'existing' END AS source
  FROM part),
tok AS MATERIALIZED (SELECT id, surface, name, source, CASE WHEN source = 'none' THEN NULL ELSE list_sort(list_distinct(list_filter(string_split(surface, ' '), lambda x: x <> '' AND x <> 'protein'))) END AS tokens FROM named)"""


def similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders as alignments between parts."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("qseqid"),
        (F.col("l_suppkey") * 20 + F.col("l_linenumber")).cast("bigint").alias("sseqid"),
        (F.col("l_quantity") * 2).alias("pident"),
        (F.lit(100.0) - F.round(F.col("l_discount") * 100) * 2).alias("qcovhsp"),
        (F.lit(100.0) - F.round(F.col("l_tax") * 100) * 2).alias("scovhsp"),
        F.lit(1e-30).alias("evalue"),
        F.col("l_extendedprice").alias("bitscore"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("hit_no"),
    )


LINKS = """raw AS MATERIALIZED (
  SELECT least(l_partkey, l_suppkey * 20 + l_linenumber) AS a, greatest(l_partkey, l_suppkey * 20 + l_linenumber) AS b, l_quantity * 2 AS pident,
    100.0::DOUBLE - round(l_discount * 100) * 2 AS qcov, 100.0::DOUBLE - round(l_tax * 100) * 2 AS scov, l_extendedprice AS bitscore, l_orderkey * 10 + l_linenumber AS hit_no
  FROM lineitem),
links AS MATERIALIZED (SELECT * FROM raw WHERE a <> b QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY bitscore DESC, hit_no, pident) = 1)"""
