"""The folder that all machines of the session share, and lineage cut by tables in it."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where that is unset, a local session gets a temporary one for itself.

    On a cluster a machine's own folder would lose rows, so there the setting is needed.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    made = tempfile.mkdtemp(prefix="factloom-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", f"file://{made}")
    return f"file://{made}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage: write df to the shared folder and read it back, so a lost executor loses nothing."""
    path = f"{shared_dir(df.sparkSession)}/factloom/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
