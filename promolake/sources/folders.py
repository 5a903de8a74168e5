"""Where queries write what they read back."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A new folder under spark.checkpoint.dir, which the driver and all executors share; it goes when the application
    ends, unless it is kept.  Where that is unset, a local folder will do for a local session only."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or getattr(sc, "_promolake_scratch", None)
    if not root:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = sc._promolake_scratch = "file://" + tempfile.mkdtemp(prefix="promolake-")
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"

    if keep:
        return path

    def drop() -> None:
        try:
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - the application may have stopped its JVM already
            pass

    atexit.register(drop)
    return path


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written to a scratch folder and read back: several plans then read it instead of computing it again, and a lost executor
    costs no more than the tasks that were running."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
