"""Reports of other tools: sectioned domain hits, padding logs, completeness summaries, lists of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def domain_sections(spark: SparkSession, path: str) -> DataFrame:
    """Rows between DOMAINS and ENDDOMAINS with the query that the last QUERY line names.

    Columns: query_id, hit_type, pssm_id, evalue, bitscore, accession, name, incomplete, line_no. One file is one ordered group.
    """
    f = F.split("value", "\t", -1)
    word = F.get(f, F.lit(0))
    rows = spark.read.text(path).select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line_no"), f.alias("f"), word.alias("word"))
    w = W.partitionBy("file").orderBy("line_no")
    query = F.when(F.col("word") == "QUERY", F.substring_index(F.trim(F.get("f", F.lit(4))), " ", 1))
    mark = F.when(F.col("word") == "DOMAINS", True).when(F.col("word") == "ENDDOMAINS", False)
    rows = rows.withColumn("query_id", F.last(query, ignorenulls=True).over(w)).withColumn("inside", F.last(mark, ignorenulls=True).over(w))
    at = lambda i: F.get("f", F.lit(i))
    return rows.where("inside and word <> 'DOMAINS'").select("query_id", at(2).alias("hit_type"), at(3).alias("pssm_id"), at(6).try_cast("double").alias("evalue"), at(7).try_cast("double").alias("bitscore"), at(8).alias("accession"), at(9).alias("name"), at(10).alias("incomplete"), "line_no")


def padding_log(spark: SparkSession, path: str) -> DataFrame:
    """record_id, original_seqlen, head_padding, tail_padding, original_num_stop, new_num_stop of `id, key=value, ...` lines."""
    names = ("original_seqlen", "head_padding", "tail_padding", "original_num_stop", "new_num_stop")
    number = lambda k: F.regexp_extract("value", rf"\b{k}=(\d+)", 1).try_cast("bigint").alias(k)
    record = F.regexp_extract("value", r"^(.*), original_seqlen=", 1)
    return spark.read.text(path).where(F.col("value").contains(", original_seqlen=")).select(record.alias("record_id"), *map(number, names))


def completeness(spark: SparkSession, path: str) -> DataFrame:
    """lineage, total and the shares complete, single, duplicated, fragmented, missing of short summaries, one row a file."""
    share = lambda k: F.regexp_extract("value", rf"\b{k}:([0-9.]+)%", 1).try_cast("double")
    cols = {"complete": "C", "single": "S", "duplicated": "D", "fragmented": "F", "missing": "M"}
    lineage = F.regexp_extract("value", r"lineage dataset is:\s*(\S+)", 1)
    return spark.read.text(path, wholetext=True).select(lineage.alias("lineage"), F.regexp_extract("value", r"\bn:(\d+)", 1).try_cast("bigint").alias("total"), *(share(v).alias(k) for k, v in cols.items()))


def ids(spark: SparkSession, path: str) -> DataFrame:
    """id and the first line of each id that isn't blank."""
    rows = spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), F.trim("value").alias("id")).where("id <> ''")
    return rows.groupBy("id").agg(F.min("line_no").alias("line_no"))
