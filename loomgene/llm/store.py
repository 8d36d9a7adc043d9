"""Where lineage is cut, and how small sides of a join are recognised."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only if it is measured to be no larger than this.
BROADCAST_BYTES = 32 << 20


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a new local folder in local mode (tests), and an error on a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="loomgene-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: a lost executor costs no recomputation."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, row_bytes: int | str) -> DataFrame:
    """df, which should be cheap to count, marked for broadcast if its measured size is within BROADCAST_BYTES.

    row_bytes: of each row, or an SQL expression of them where rows hold arrays.
    """
    size = df.selectExpr(f"coalesce(sum({row_bytes}), 0)").first()[0]
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


#: Arrays that are added up in one group.
_ADDED = 256


def summed(parts: DataFrame, keys: list[str], kind: type) -> DataFrame:
    """The arrays of numbers in `counts` (binary) added up over all tasks (column `task`) by the keys.

    First in groups of _ADDED tasks, then their sums, so no group holds an array of every task.
    """
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema)

    def add(table: pa.Table) -> pa.Table:
        own = sorted(zip(table.column("task").to_pylist(), table.column("counts").to_pylist(), strict=True))
        total = np.sum([np.frombuffer(c, kind) for _, c in own], axis=0)
        first = {"task": pa.array([own[0][0]], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())}
        return pa.table([first.get(c, table.column(c)[:1]) for c in table.column_names], names=table.column_names)

    few = parts.groupBy(*keys, F.floor(F.col("task") / _ADDED)).applyInArrow(lambda _, t: add(t), schema)
    return few.groupBy(*keys).applyInArrow(lambda _, t: add(t), schema)


def import_path(spark: SparkSession) -> None:
    """Python workers find this package where the driver found it (clusters: install it or use --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
