"""What lies outside Spark: object stores, databases, credentials and spreadsheets.

Object stores and databases are reached by Spark itself; its settings are made here. Spreadsheets need a
reader or writer that isn't part of the library, and say so where there is none.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def secret(name: str, said: Mapping[str, str] | None = None, env: Mapping[str, str] | None = None) -> str | None:
    """A credential: as said, else of the environment; None if there is none, for the provider chain to find."""
    return (said or {}).get(name) or (os.environ if env is None else env).get(name.upper())


def object_store(said: Mapping[str, str] | None = None, env: Mapping[str, str] | None = None) -> dict[str, str]:
    """Settings of a session that reads ``s3a://`` paths: explicit keys, or the chain of providers; TLS stays verified."""
    pick = lambda name: secret(name, said, env)
    out = {"spark.hadoop.fs.s3a.connection.ssl.enabled": "true"}
    for setting, name in (("endpoint", "aws_endpoint_url"), ("endpoint.region", "aws_region")):
        if value := pick(name):
            out[f"spark.hadoop.fs.s3a.{setting}"] = value
    if (key := pick("aws_access_key_id")) and (hidden := pick("aws_secret_access_key")):
        out |= {"spark.hadoop.fs.s3a.access.key": key, "spark.hadoop.fs.s3a.secret.key": hidden}
        if token := pick("aws_session_token"):
            out["spark.hadoop.fs.s3a.session.token"] = token
    return out


def database(host: str, name: str, user: str | None = None, port: int = 5432, said: Mapping[str, str] | None = None, env: Mapping[str, str] | None = None) -> dict[str, str]:
    """JDBC options of a PostgreSQL database; its driver must be on the session's class path."""
    if not all(c.isalnum() or c in "_-." for c in name + host):
        raise ValueError(f"{host!r} or {name!r} isn't a plain name")
    held = {"user": user or secret("pguser", said, env), "password": secret("pgpassword", said, env)}
    return {"url": f"jdbc:postgresql://{host}:{port}/{name}", "driver": "org.postgresql.Driver", **{k: v for k, v in held.items() if v}}


def quoted(name: str, mark: str = '"') -> str:
    """A name or text in SQL, with its marks doubled."""
    return mark + name.replace(mark, mark * 2) + mark


def create_database(name: str, owner: str) -> str:
    """The statement that creates a database with an owner."""
    return f"CREATE DATABASE {quoted(name)} OWNER {quoted(owner)}"


def catalog_settings(options: Mapping[str, str], warehouse: str) -> dict[str, str]:
    """Settings of a session whose table catalog is in a database."""
    names = {"url": "ConnectionURL", "driver": "ConnectionDriverName", "user": "ConnectionUserName", "password": "ConnectionPassword"}
    return {"spark.sql.catalogImplementation": "hive", "spark.sql.warehouse.dir": warehouse} | {f"spark.hadoop.javax.jdo.option.{names[k]}": v for k, v in options.items() if k in names}


def read_table(spark: SparkSession, options: Mapping[str, str], table: str, key: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 16) -> DataFrame:
    """A table of a database, read in ranges of a key by ``parts`` tasks."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if key and bounds:
        reader = reader.option("partitionColumn", key).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", parts)
    return reader.load()


def read_sheet(spark: SparkSession, path: str | Path, sheet: str | int = 0, schema: str | None = None) -> DataFrame:
    """A sheet of an ``.xls`` file: a small table, read on the driver, all text unless a schema is given."""
    if Path(path).suffix != ".xls":
        raise ValueError(f"{path} isn't an .xls file")
    try:
        import xlrd  # noqa: F401
    except ImportError as error:
        raise RuntimeError("reading .xls needs xlrd; else convert the file to CSV") from error
    import pandas as pd

    frame = pd.read_excel(path, sheet_name=sheet, engine="xlrd", dtype=None if schema else str)
    return spark.createDataFrame(frame.astype(object).where(frame.notna(), None), schema or ", ".join(f"`{c}` string" for c in frame.columns))


def write_sheet(df: DataFrame, path: str | Path, most: int = 1_000_000) -> None:
    """A small table as a sheet; ValueError if it has more rows than a sheet holds."""
    rows = df.limit(most + 1).toPandas()
    if len(rows) > most:
        raise ValueError(f"a sheet holds {most} rows")
    try:
        rows.to_excel(path, index=False)
    except ImportError as error:
        raise RuntimeError("writing spreadsheets needs openpyxl") from error
