"""Tab-separated side tables, domain tables and five-column submission files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgene import schemas


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table with a header; a value that doesn't fit the schema is an error."""
    return spark.read.schema(schema).options(sep="\t", header=True, mode="FAILFAST", enforceSchema=False).csv(path)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.options(sep="\t", header=True, emptyValue="").csv(path)


def annotation(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, schemas.ANNOTATION)


def hits(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, schemas.HITS)


def domain_hits(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a table of domains in columns of white space, the description last."""
    f = F.split(F.trim("value"), r"\s+", 23)
    cols = {"query_id": f[3], "name": f[0], "accession": f[1], "hmm_length": f[2].cast("bigint"), "i_evalue": f[12].cast("double"), "bitscore": f[13].cast("double"), "hmm_from": f[15].cast("bigint"), "hmm_to": f[16].cast("bigint"), "description": F.try_element_at(f, F.lit(23))}
    return spark.read.text(path).where(~F.col("value").rlike(r"^\s*(#|$)")).select(*(c.alias(k) for k, c in cols.items()))


def domain_models(spark: SparkSession, path: str) -> DataFrame:
    """name, accession and description of records that end with //."""
    field = lambda k: F.nullif(F.trim(F.regexp_extract("value", rf"(?m)^{k}[ \t]+(.*)$", 1)), F.lit(""))
    return spark.read.option("lineSep", "//\n").text(path).select(field("NAME").alias("name"), field("ACC").alias("accession"), field("DESC").alias("description")).where("name is not null")


def header_metadata(sequences: DataFrame) -> DataFrame:
    """subject_id, description, subject_taxon_id and subject_organism from headers of protein databases."""
    rest = F.trim(F.regexp_replace("description", r"^\S+\s*", ""))
    name = F.trim(F.regexp_extract(rest, r"^(.*?)(?:\s+(?:OS|OX|GN|PE|SV|n|Tax|TaxID|RepID)=.*)?$", 1))
    taxon = F.regexp_extract("description", r"(?:OX|TaxID)=(\d+)", 1).try_cast("bigint")
    organism = F.nullif(F.trim(F.regexp_extract("description", r"(?:OS|Tax)=(.*?)(?:\s+(?:OX|GN|PE|SV|TaxID|RepID)=|$)", 1)), F.lit(""))
    return sequences.select(F.col("id").alias("subject_id"), name.alias("description"), taxon.alias("subject_taxon_id"), organism.alias("subject_organism"))


def submission_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a five-column file; a blank entry, feature or location goes on from above.

    Blocks are numbered in their file. Rows are ordered by line_no, so fill one file at a time; a file of one submission fits a task.
    """
    f = F.split("value", "\t", -1)
    raw = spark.read.text(path).select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line_no"), *(F.trim(F.coalesce(F.get(f, F.lit(i)), F.lit(""))).alias(c) for i, c in enumerate(("entry", "feature", "location", "qualifier", "value"))))
    return fill(raw, ["file"]).drop("file")


def fill(raw: DataFrame, by: list[str]) -> DataFrame:
    """Forward fill of entry, feature and location within `by`, in the order of line_no."""
    w = W.partitionBy(*by).orderBy("line_no")
    opens = F.col("feature") != ""
    out = raw.withColumn("entry", F.last(F.nullif("entry", F.lit("")), ignorenulls=True).over(w)).withColumn("block_no", F.sum(opens.cast("bigint")).over(w))
    block = W.partitionBy(*by, "block_no").orderBy("line_no")
    first = lambda c: F.first(F.nullif(c, F.lit("")), ignorenulls=True).over(block)
    return out.withColumn("location", first("location")).withColumn("feature", first("feature"))
