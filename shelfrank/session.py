"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_session(cpus: int | str = "*", app: str = "shelfrank", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SHELFRANK_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables, seen by every executor.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session may
    fall back to a folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="shelfrank-")
    context.setCheckpointDir(folder)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str, tight: bool = False) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts lineage like a checkpoint and keeps column pruning, filter pushdown and
    size statistics; a lost executor costs a re-read, not a recomputation.
    A table that is most of what a job writes may be packed ``tight``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.write.option("compression", "zstd") if tight else df.write).parquet(path)
    return spark.read.parquet(path)


def small_table(spark: SparkSession, rows: Sequence[Sequence], schema: str | T.StructType) -> DataFrame:
    """A table of a few rows known to the driver.

    Given as Arrow it becomes part of the plan, so that joins with it need no job of their own.
    """
    kinds = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
    arrow = to_arrow_schema(kinds)
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), kinds)
