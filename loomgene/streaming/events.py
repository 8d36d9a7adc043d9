"""Event streams: windowed counts and the attribute repair of feature lines, in append mode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgene.functions import attributes as A


def read(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def counts(events: DataFrame, every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events and their value by type and window; a window closes when the watermark has passed it, later rows are left out."""
    kept = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    out = kept.groupBy(F.window("ts", every), "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("value"))
    return out.select(F.col("window.start").alias("start"), "event_type", "events", "value")


def repaired(lines: DataFrame) -> DataFrame:
    """Feature rows (value) as they arrive, their attributes repaired; no state."""
    f = F.split("value", "\t", -1)
    fixed = A.repair(F.get(f, F.lit(8)))
    return lines.select(F.when(F.size(f) == 9, F.concat_ws("\t", F.slice(f, 1, 8), F.coalesce(fixed["text"], F.get(f, F.lit(8))))).otherwise(F.col("value")).alias("value"), F.coalesce(fixed["glued"], F.lit(False)).alias("glued"))
