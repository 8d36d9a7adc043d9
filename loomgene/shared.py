"""Where iterative operators cut their lineage, and numbers over sorted rows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

def cut(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet below spark.checkpoint.dir and read back; where that is unset, below a new local folder in local mode, and an error on a cluster."""
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="loomgene-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """df with `name`: 1, 2, 3, ... in this order, which must have no ties.

    Rows are dealt to ranges and numbered within them; only the ranges' counts, one row a range, are summed in one task.
    """
    placed = cut(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "numbered")
    counts = placed.groupBy("__range").agg(F.count("*").alias("__n"))
    before = counts.select("__range", F.coalesce(F.sum("__n").over(W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    own = F.row_number().over(W.partitionBy("__range").orderBy(*order))
    return placed.join(F.broadcast(before), "__range").withColumn(name, own + F.col("__before")).drop("__range", "__before")


def refuse(wrong: DataFrame, what: str) -> None:
    """An error if `wrong` (column name) has rows: it gives their number and the first ten names."""
    n = wrong.count()
    if n:
        first = [str(r[0]) for r in wrong.select("name").orderBy("name").limit(10).collect()]
        raise ValueError(f"{what} ({n}): {', '.join(first)}")


def same_ids(left: DataFrame, right: DataFrame, key: str, what: str) -> None:
    """An error unless both tables have the same set of ids; it gives the first ten that are in one of them alone."""
    ids = lambda df, side: df.select(F.col(key).alias("id"), F.lit(side).alias("side"))
    sides = ids(left, 1).unionByName(ids(right, 2)).groupBy("id").agg(F.min("side").alias("a"), F.max("side").alias("b")).where("a = b")
    refuse(sides.select(F.concat(F.when(F.col("a") == 1, "+").otherwise("-"), F.col("id").cast("string")).alias("name")), what)
