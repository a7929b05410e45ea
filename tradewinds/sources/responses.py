"""A data source of HTTP responses: a row for each, with its text or its error.

Requests are dealt to ``lanes`` tasks and the quota is shared out between them, so that no task needs
to know of another. ``land`` writes the responses to Parquet before anything reads them: a lost executor
repeats its own lane, and no later action asks the service again.
"""

from __future__ import annotations

import importlib
import io
import json
import logging
import warnings
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import asdict

import pyarrow as pa
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tradewinds.deploy import ship
from tradewinds.sources import planning
from tradewinds.sources.limits import Quota
from tradewinds.sources.requests import Request
from tradewinds.sources.transport import NoRecords, url_of

SCHEMA = "request string, body string, error string"


def _texts(request: dict, get, quota: Quota | None) -> Iterator[tuple[str, str]]:
    """The URL and the text of each response of a request that may have to be halved."""
    wanted = {n: planning.as_list(request["params"][n]) for n in request["halve"]}
    rest = {k: v for k, v in request["params"].items() if k not in wanted}

    def ask(selection: Mapping[str, Sequence[str]]) -> Iterator[tuple[str, str]]:
        url = url_of(request["base"], request["path"], rest | {k: ",".join(v) for k, v in selection.items()})
        if quota:
            quota.acquire()
        try:
            body = get(url, request["headers"], request["timeout"])
        except NoRecords:
            return
        if request["limit"] and len(json.loads(body).get("data") or ()) >= request["limit"]:
            if parts := planning.halved(selection, request["halve"]):
                for part in parts:
                    yield from ask(part)
                return
            logging.getLogger(__name__).warning("%s has as many rows as a response can, and can't be halved", url)
        yield url, body

    yield from ask(wanted)


class _Lane(InputPartition):
    def __init__(self, requests: list[dict]):
        self.requests = requests


class _Reader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]):
        self.requests = json.loads(options["requests"])
        self.lanes = max(1, min(int(options.get("lanes", 1)), len(self.requests)))
        self.quota = json.loads(options.get("quota", "null"))
        self.module, _, self.name = options.get("transport", "tradewinds.sources.transport:get").partition(":")

    def partitions(self) -> list[InputPartition]:
        return [_Lane(self.requests[k :: self.lanes]) for k in range(self.lanes)]

    def read(self, partition: _Lane) -> Iterator[tuple]:
        get = getattr(importlib.import_module(self.module), self.name)
        quota = Quota.of(self.quota, lanes=self.lanes) if self.quota else None
        for request in partition.requests:
            try:
                for url, body in _texts(request, get, quota):
                    yield url, body, None
            except Exception as error:  # noqa: BLE001 - the error is a row; land() decides what it means
                yield url_of(request["base"], request["path"], request["params"]), None, f"{type(error).__name__}: {error}"


class Responses(DataSource):
    """``spark.read.format("responses")``, with options ``requests``, ``lanes``, ``quota``, ``transport``."""

    @classmethod
    def name(cls) -> str:
        return "responses"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def land(spark: SparkSession, requests: Sequence[Request], path: str, *, lanes: int = 1, quota=None, transport: str | None = None) -> DataFrame:
    """The responses of all requests, written to ``path`` and read again.

    Nothing found is no error. ValueError if every request failed; a warning that counts them if some did.
    """
    options = {"requests": json.dumps([asdict(r) | {"timeout": r.timeout} for r in requests]), "lanes": str(lanes)}
    if quota:
        options["quota"] = json.dumps(quota)
    if transport:
        options["transport"] = transport
    ship(spark)
    spark.dataSource.register(Responses)
    spark.read.format("responses").options(**options).load().write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path)
    bad, example = rows.where("error IS NOT NULL").agg(F.count("*"), F.min("error")).first()
    if bad and bad == len(requests):
        raise ValueError(f"all {bad} requests failed, such as by {example}")
    if bad:
        warnings.warn(f"{bad} of {len(requests)} requests failed, such as by {example}", stacklevel=2)
    return rows.where("body IS NOT NULL").select("request", "body")


def csv_rows(responses: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns of CSV responses as text, whatever their order in each; an empty cell is null.

    Responses are parsed whole columns at a time; quoted cells may hold line feeds.
    """
    schema = pa.schema([(c, pa.string()) for c in columns])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parse = pacsv.ParseOptions(newlines_in_values=True)
        convert = pacsv.ConvertOptions(column_types=schema, include_columns=list(columns), include_missing_columns=True, strings_can_be_null=True, null_values=[""])
        for batch in batches:
            for body in batch.column(0).to_pylist():
                if body.strip():
                    table = pacsv.read_csv(io.BytesIO(body.encode()), parse_options=parse, convert_options=convert)
                    yield from table.cast(schema).to_batches(max_chunksize=10_000)

    return responses.select("body").mapInArrow(rows, ", ".join(f"`{c}` string" for c in columns))


def declaration_rows(responses: DataFrame, schema: str) -> DataFrame:
    """The ``data`` of JSON responses, by a schema of the wanted columns."""
    held = F.from_json("body", f"data array<struct<{schema}>>")["data"]
    return responses.select(F.explode(held).alias("row")).select("row.*")


def references(responses: DataFrame, schema: str) -> DataFrame:
    """The ``results`` of a listing of codes or of files, flat, by a schema of the wanted columns."""
    held = F.from_json("body", f"results array<struct<{schema}>>")["results"]
    return responses.select(F.explode(held).alias("row")).select("row.*")


def category_file(listing: Mapping[str, str], category: str) -> str:
    """Where the codes of a category are; ValueError for one that isn't listed."""
    if category not in listing:
        raise ValueError(f"unknown category {category!r}; there are {sorted(listing)}")
    return listing[category]


def valid_codes(codes: DataFrame, category: str) -> DataFrame:
    """``code`` of a category: areas only while they haven't expired."""
    column = {"reporter": "reporterCode", "partner": "PartnerCode"}.get(category)
    if column is None:
        return codes.select(F.col("id").cast("string").alias("code"))
    return codes.where("entryExpiredDate IS NULL").select(F.col(column).cast("string").alias("code"))
