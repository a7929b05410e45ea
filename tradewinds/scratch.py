"""Intermediate tables in the folder that a cluster's machines share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

#: Tables that this process has written and not deleted.
_TABLES: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Where none is set, a session of one machine gets a folder that goes with the process; any other must
    set one, as its executors share no local folder.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("tradewinds.scratch", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tradewinds-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        found = f"file://{folder}"
        spark.conf.set("tradewinds.scratch", found)
    return found.rstrip("/")


def written(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again, as ``files`` files if given.

    This cuts the lineage: a lost executor costs a re-read, not a recomputation, and Catalyst
    knows the size of the table, so that it broadcasts it only below its threshold.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df.repartition(files) if files else df).write.parquet(path)
    _TABLES.append(path)
    return spark.read.schema(df.schema).parquet(path)


def tables() -> list[str]:
    """The written tables that still stand, oldest first."""
    return list(_TABLES)


def delete(spark: SparkSession, paths: Iterable[str]) -> None:
    """Deletes written tables; nothing may read them any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        _TABLES.remove(path)
