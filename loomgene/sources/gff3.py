"""GFF3 feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgene.functions import attributes as A


def lines(spark: SparkSession, path: str) -> DataFrame:
    """line_no, section (comment, record, fasta) and line; what follows ##FASTA is fasta."""
    whole = spark.read.text(path).select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line_no"), F.regexp_replace("value", "\r$", "").alias("line"))
    first = whole.where(F.col("line").rlike("^##FASTA")).groupBy("file").agg(F.min("line_no").alias("fasta"))
    section = F.when(F.col("line_no") >= F.coalesce("fasta", F.lit(1 << 62)), "fasta").when(F.col("line").rlike(r"^\s*(#|$)"), "comment").otherwise("record")
    return whole.join(F.broadcast(first), "file", "left").select("line_no", section.alias("section"), "line")  # one row a file


def features(rows: DataFrame) -> DataFrame:
    """Feature rows from lines(). Other than nine columns, or coordinates that aren't whole numbers, are errors."""
    # exploded, as a plain filter on the section may be moved behind later filters, which would meet comments
    own = rows.select("line_no", F.explode(F.when(F.col("section") == "record", F.array("line")).otherwise(F.array().cast("array<string>"))).alias("line"))
    parts = F.split("line", "\t", -1)
    f = [F.get(parts, F.lit(i)) for i in range(9)]
    bad = F.raise_error(F.concat(F.lit("malformed feature row: "), F.col("line"))).cast("bigint")
    number = lambda i: F.when((F.size(parts) == 9) & f[i].rlike(r"^\s*\d+\s*$"), F.trim(f[i]).try_cast("bigint")).otherwise(bad)
    text = f[8]
    return own.select(
        F.col("line_no").alias("row_no"),
        f[0].alias("seqid"),
        f[1].alias("source"),
        f[2].alias("type"),
        number(3).alias("start"),
        number(4).alias("end"),
        f[5].alias("score"),
        f[6].alias("strand"),
        f[7].alias("phase"),
        text.alias("attributes_text"),
        A.parse(text).alias("attributes"),
        A.percent_decode(A.raw_value(text, "ID")).alias("id"),
        A.parents(text).alias("parents"),
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    return features(lines(spark, path))


def text(rows: DataFrame) -> DataFrame:
    """row_no and the line of each feature row."""
    cols = ["seqid", "source", "type", F.col("start").cast("string"), F.col("end").cast("string"), "score", "strand", "phase", "attributes_text"]
    return rows.select("row_no", F.concat_ws("\t", *cols).alias("value"))


def write(rows: DataFrame, path: str, others: DataFrame | None = None) -> None:
    """Comments first, then the rows in the order of row_no, then the embedded sequences."""
    out = text(rows).select(F.lit(1).alias("part"), F.col("row_no").alias("at"), "value")
    if others is not None:
        rest = others.where("section <> 'record'").select(F.when(F.col("section") == "fasta", 2).otherwise(0).alias("part"), F.col("line_no").alias("at"), F.col("line").alias("value"))
        out = out.unionByName(rest)
    out.orderBy("part", "at").select("value").write.text(path)


def last_by_id(rows: DataFrame) -> DataFrame:
    """One row for each id, the last one, as look-ups take it."""
    return rows.where("id is not null").withColumn("__n", F.row_number().over(W.partitionBy("id").orderBy(F.desc("row_no")))).where("__n = 1").drop("__n")
