"""FASTA files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgene.functions import sequence as S


def read(spark: SparkSession, path: str) -> DataFrame:
    """seq_no, id, description, sequence: one row for each record of the (also gzipped) files.

    Lines are stripped and blank lines skipped. Text before the first header and a header without a name are errors.
    seq_no rises in the order of the records of one file.
    """
    parts = spark.read.option("lineSep", "\n>").text(path).select(F.monotonically_increasing_id().alias("seq_no"), F.regexp_replace("value", "\r", "").alias("value"))
    text = F.regexp_replace("value", r"^\s*>", "")
    header, body = F.trim(F.substring_index(text, "\n", 1)), F.when(text.contains("\n"), F.substr(text, F.instr(text, "\n") + 1)).otherwise("")
    name = F.regexp_extract(header, r"^(\S+)", 1)
    wrong = F.when((F.col("seq_no") == 0) & ~F.col("value").rlike(r"^\s*>"), F.raise_error(F.lit("data before the first header"))).when(name == "", F.raise_error(F.lit("a header has no name")))
    rows = parts.where(F.trim("value") != "").withColumn("wrong", wrong.cast("string"))
    return rows.select("seq_no", F.coalesce("wrong", name).alias("id"), header.alias("description"), F.regexp_replace(body, r"\s+", "").alias("sequence"))


def without(sequences: DataFrame, excluded: DataFrame) -> DataFrame:
    """Records whose id is not among the excluded ones (column id)."""
    return sequences.join(excluded.select("id").distinct(), "id", "left_anti").select(sequences.columns)


def lines(sequences: DataFrame, width: int = 60, submission: bool = False) -> DataFrame:
    """seq_no and the text of each record; for submission: bare id, upper case, `//` at the end."""
    head = F.col("id") if submission else F.coalesce(F.nullif("description", F.lit("")), F.col("id"))
    body = S.wrap(F.upper("sequence") if submission else F.col("sequence"), width)
    return sequences.select("seq_no", F.concat(F.lit(">"), head, F.lit("\n"), body, F.lit("\n//" if submission else "")).alias("value"))


def write(sequences: DataFrame, path: str, width: int = 60, submission: bool = False) -> None:
    """Part files whose order is the order of the records."""
    lines(sequences, width, submission).orderBy("seq_no").select("value").write.text(path)
