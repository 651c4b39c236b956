"""Lineage cuts: tables written to the folder that all executors and the driver share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a local one only where that is unset and all runs in one process."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not found:
        folder = tempfile.mkdtemp(prefix="tallyforge-")
        atexit.register(shutil.rmtree, folder, True)
        found = "file://" + folder
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def saved(df: DataFrame, name: str, small: bool = False) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: recovery restarts from these files. small: rows are narrow
    beside what the tasks read, so they are gathered into files of the advised size first; every file that a task creates
    costs the executor some processes."""
    spark = df.sparkSession
    if small:
        df = df.hint("rebalance")
    path = f"{shared_dir(spark)}/tallyforge-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(StructType.fromJson(df.schema.jsonValue())).parquet(path)
    back._tallyforge_path = path
    return back


def dropped(*frames: DataFrame) -> None:
    """Remove tables of saved() that no later plan reads."""
    for df in frames:
        spark, path = df.sparkSession, df._tallyforge_path
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
