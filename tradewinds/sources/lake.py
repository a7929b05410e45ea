"""Keyed Parquet tables with snapshots, in any folder that Spark can write.

Rows are dealt to buckets by a hash of their key; the number of buckets is the table's, fixed by its first
version. A version is a commit file that names the folder of each bucket, and is renamed into place once the
data is whole: readers see a version with its commit file only, and what an interrupted run leaves is never
read. An upsert writes the new rows once, beside the table, and then anew those buckets only that they fall
into; the other buckets of the version are the folders that an older one has written.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

#: Buckets of a table whose first upsert names none, and the column that tells them in a folder's name.
BUCKETS = 64
_BUCKET = "lake_bucket"


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _commits(self, table: str):
        return self._path(f"{self.root}/{table}/_commits")

    def exists(self, table: str) -> bool:
        return bool(self.versions(table))

    def versions(self, table: str) -> list[dict]:
        """``version, time, keys, data`` of each version, oldest first."""
        if not self._fs.exists(self._commits(table)):
            return []
        out = []
        for status in self._fs.listStatus(self._commits(table)):
            if status.getPath().getName().endswith(".json"):
                stream = self._fs.open(status.getPath())
                try:
                    out.append(json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
                finally:
                    stream.close()
        return sorted(out, key=lambda v: v["version"])

    def _commit(self, table: str, keys: Sequence[str], buckets: int, folders: dict[str, str]) -> int:
        version = max((v["version"] for v in self.versions(table)), default=0) + 1
        part, final = (self._path(f"{self._commits(table).toString()}/{name}") for name in (f"{uuid.uuid4().hex}.part", f"{version:09d}.json"))
        stream = self._fs.create(part, True)
        stream.write(bytearray(json.dumps({"version": version, "time": time.time(), "keys": list(keys), "buckets": buckets, "folders": folders}).encode()))
        stream.close()
        if self._fs.exists(final) or not self._fs.rename(part, final):
            raise RuntimeError(f"version {version} of {table} was written by another run")
        return version

    def _rows(self, table: str, folders: Iterable[str]) -> DataFrame:
        paths = [f"{self.root}/{table}/{f}" for f in folders]
        return self.spark.read.option("mergeSchema", True).parquet(*paths)

    def upsert(self, table: str, new: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> int:
        """The table with rows of ``new`` in place of those with their keys; keys of ``new`` must be unique and whole."""
        if not keys:
            raise ValueError("an upsert needs a key")
        held = self.versions(table)
        buckets, folders = (held[-1]["buckets"], held[-1]["folders"]) if held else (buckets, {})
        own = uuid.uuid4().hex
        staged = f"{self.root}/{table}/staged-{own}"
        bucket = F.pmod(F.xxhash64(*(F.col(f"`{k}`").cast("string") for k in keys)), F.lit(buckets)).cast("int")
        new.withColumn(_BUCKET, bucket).write.parquet(staged)
        try:
            rows = self.spark.read.schema(StructType([*new.schema.fields, StructField(_BUCKET, IntegerType())])).parquet(staged)
            whole = F.count(F.when(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)), 1))
            n, with_key, distinct = rows.groupBy(*(F.col(f"`{k}`") for k in keys)).agg(F.count("*").alias("n"), whole.alias("whole")).agg(F.sum("n"), F.sum("whole"), F.count("*")).first()
            if n is not None and with_key < n:
                raise ValueError(f"the key {list(keys)} is null in some row")
            if n is not None and distinct < n:
                raise ValueError(f"rows repeat the key {list(keys)}")
            touched = sorted(r[0] for r in rows.select(_BUCKET).distinct().collect()) if n else []  # buckets at most
            old = [folders[str(k)] for k in touched if str(k) in folders]
            if old:
                before = self._rows(table, old).withColumn(_BUCKET, bucket)
                rows = before.join(rows.select(*(F.col(f"`{k}`") for k in keys)), list(keys), "left_anti").unionByName(rows, allowMissingColumns=True)
            if touched or not held:
                rows.repartition(max(1, len(touched)), _BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.root}/{table}/{own}")
            folders = {**folders, **{str(k): f"{own}/{_BUCKET}={k}" for k in touched}}
            if not folders:  # a table without rows still has columns
                rows.drop(_BUCKET).write.parquet(f"{self.root}/{table}/{own}/empty")
                folders = {"empty": f"{own}/empty"}
            return self._commit(table, keys, buckets, folders)
        finally:
            self._fs.delete(self._path(staged), True)

    def read(self, table: str, version: int | None = None, as_of: float | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        """The last version, a given one, or the last at a time; a version wins over a time.

        A table in a schema is ``schema/table``.
        """
        held = self.versions(table)
        if version is not None:
            held = [v for v in held if v["version"] == version]
        elif as_of is not None:
            held = [v for v in held if v["time"] <= as_of]
        if not held:
            raise ValueError(f"{table} has no such version")
        rows = self._rows(table, sorted(held[-1]["folders"].values()))
        return rows.select(*columns) if columns else rows

    def expire(self, table: str, keep: int = 1) -> int:
        """Deletes all but the last ``keep`` versions and the folders that only they name; returns how many went."""
        if keep < 1:
            raise ValueError("a table keeps a version at least")
        every = self.versions(table)
        old, stay = every[:-keep], {f for v in every[-keep:] for f in v["folders"].values()}
        for v in old:
            self._fs.delete(self._path(f"{self._commits(table).toString()}/{v['version']:09d}.json"), False)
        for folder in {f for v in old for f in v["folders"].values()} - stay:
            self._fs.delete(self._path(f"{self.root}/{table}/{folder}"), True)
        return len(old)
