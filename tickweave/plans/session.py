"""Session helpers: shared folder, code shipping, written tables."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers (once per application)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    out = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(out))
    _SHIPPED.add(sc.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; in local mode, where there is one machine, a folder of our own if that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = os.path.join(tempfile.gettempdir(), "tickweave-shared")
        spark.sparkContext.setCheckpointDir(base)
        base = f"file://{base}"
    return base.rstrip("/")


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, deleted when the application ends."""
    path = f"{shared_dir(spark)}/tickweave/{tag}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path


def saved(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now; it does so when the driver collects its garbage, which may be half an hour later."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
