"""Tables that cut lineage: written to the folder every executor shares."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir); in local mode a new one where unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="lexmill-")
    spark.conf.set("spark.checkpoint.dir", f"file://{made}")
    return f"file://{made}"


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    if not _made:
        atexit.register(_drop_all)
    _made.append((spark, path))
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read back; it outlives any executor."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _drop_all() -> None:
    for spark, path in _made:
        try:
            hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
            hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)
        except Exception:  # the session has ended
            return
