"""Queries of the statistical services from end to end.

A query names a dataflow and what is wanted of it. Its structure is resolved, its requests are planned, sent
in lanes and landed as Parquet; rows are parsed from what landed, filtered by what a request can't say, held
against the policy for repeated keys, and typed. Only structures, code lists and listings come to the driver.
"""

from __future__ import annotations

import json
import uuid
import warnings
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, fields
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewinds.functions.exprs import number
from tradewinds.operators import relational
from tradewinds.sources import planning, requests, responses, structures
from tradewinds.sources.control import instant, read_json
from tradewinds.sources.requests import Request
from tradewinds.sources.structures import Structure, Structures
from tradewinds.streaming.sync import changed, last_release

TIME, VALUE = "TIME_PERIOD", "OBS_VALUE"
#: Columns of tariff lines that are read of a response.
TARIFF_LINES = "period string, reporterCode int, reporterISO string, flowCode string, partnerCode int, partnerISO string, partner2Code int, cmdCode string, customsCode string, motCode int, qtyUnitCode int, qty double, netWgt double, primaryValue double"
TARIFF_MEASURES = ("qty", "netWgt", "primaryValue")


@dataclass(frozen=True)
class Query:
    """What is wanted of a dataflow; ``options`` go to the planner of the service's requests."""

    source: str
    dataflow: str
    agency: str = ""
    version: str | None = None
    wanted: Mapping[str, Sequence[str]] = field(default_factory=dict)
    split_by: Sequence[str] = ()
    options: Mapping[str, object] = field(default_factory=dict)
    duplicates: str = "raise"

    @classmethod
    def of(cls, said: Mapping) -> Query:
        """From a mapping; what isn't a field is left out."""
        return cls(**{f.name: said[f.name] for f in fields(cls) if f.name in said})

    def plain(self) -> dict:
        return asdict(self)

    @property
    def key(self) -> str:
        return planning.identity_key(self.agency or self.source, self.dataflow, self.version or "*", self.wanted)


def quota_of(path: str | Path) -> list[dict] | None:
    """The limits in a provider's parameter file, ``{"RATE_LIMIT": {"requests", "unit", "count"}}`` or a list of such; None if it sets none."""
    held = read_json(path, {}).get("RATE_LIMIT")
    return [held] if isinstance(held, Mapping) else held or None


@dataclass
class Client:
    """A service: where its responses land, its quota, and how it is reached."""

    spark: SparkSession
    folder: str
    known: Structures = field(default_factory=Structures)
    quota: list[dict] | None = None
    lanes: int = 1
    transport: str | None = None

    source = ""

    def landed(self, wanted: Sequence[Request], name: str) -> DataFrame:
        """``request, body`` of the responses, written under the client's folder."""
        path = f"{self.folder.rstrip('/')}/{self.source}-{name}-{uuid.uuid4().hex}"
        return responses.land(self.spark, wanted, path, lanes=self.lanes, quota=self.quota, transport=self.transport)

    def text(self, request: Request, name: str) -> str:
        """The one response to a request; LookupError if there is none."""
        found = self.landed([request], name).select("body").first()
        if found is None:
            raise LookupError(f"{request.path} has no answer")
        return found[0]

    def resolve(self, query: Query) -> Structure:
        """The known structure of the dataflow, else the service's, which is known from then on."""
        return self.known.resolve(query.agency, query.dataflow, lambda: self.fetched(query))

    def fetched(self, query: Query) -> Structure:
        raise NotImplementedError

    def planned(self, query: Query, structure: Structure) -> tuple[list[Request], dict[str, list[str]]]:
        """Requests, and the filters that rows must still pass."""
        raise NotImplementedError

    def execute(self, query: Query) -> DataFrame:
        """The rows of a query: its dimensions, the period and the value."""
        structure = self.resolve(query)
        wanted, left = self.planned(query, structure)
        keys = [*structure.names, *([TIME] if TIME not in structure.names else [])]
        rows = responses.csv_rows(self.landed(wanted, "rows"), [*keys, VALUE])
        rows = relational.post_filter(rows, left).withColumn(VALUE, number(F.col(VALUE)))
        return relational.check_duplicates(rows, keys, query.duplicates)

    def primary_key(self, query: Query) -> list[str]:
        names = self.resolve(query).names
        return planning.primary_key(names, [*names, TIME])

    def updates(self, query: Query) -> Callable[[datetime | None], DataFrame | None]:
        """For a run's job: all at first, then what changed since; None for no news."""
        return lambda since: self.execute(query)


class Estat(Client):
    source = "estat"
    #: Observations of each series that are fetched again where data changed.
    last = 12

    def fetched(self, query: Query) -> Structure:
        """Of the newer interface, else of the older one."""
        try:
            xml = self.text(requests.estat_structure("datastructure", query.dataflow, query.agency, query.version), "structure")
            return structures.structure_of_xml(xml, query.agency, query.dataflow)
        except (LookupError, ValueError) as error:
            warnings.warn(f"{query.dataflow}: {error}; the older interface is asked", stacklevel=2)
        xml = self.text(requests.estat_structure("datastructure", query.dataflow, query.agency, query.version, "2.1"), "structure")
        return structures.structure_of_xml(xml, query.agency, query.dataflow)

    def planned(self, query, structure):
        return requests.estat_data(structure, query.wanted, version=query.version, split_by=query.split_by, **query.options), {}

    def dataflows(self, agency: str = "ESTAT") -> list[dict]:
        """``id, name, version, agency`` of all dataflows."""
        return structures.dataflows_of_xml(self.text(requests.estat_structure("dataflow", "*", agency), "dataflows"))

    def codes(self, codelist: str, agency: str = "ESTAT") -> list[dict]:
        """``code, name`` of a code list."""
        return structures.codes_of_xml(self.text(requests.estat_structure("codelist", codelist, agency), "codes"))

    def last_update(self, query: Query) -> datetime | None:
        return structures.last_update_of_xml(self.text(requests.estat_structure("dataflow", query.dataflow, query.agency, query.version), "update"))

    def updates(self, query):
        def since_then(since: datetime | None) -> DataFrame | None:
            if since is None:
                return self.execute(query)
            if not changed(self.last_update(query), since):
                return None
            return self.execute(Query.of({**query.plain(), "options": {**query.options, "last_n": self.last}}))

        return since_then


class Oecd(Client):
    source = "oecd"

    def fetched(self, query: Query) -> Structure:
        body = self.text(requests.oecd_structure(query.agency, query.dataflow, query.version or "+"), "structure")
        return structures.structure_of_json(json.loads(body), query.agency, query.dataflow)

    def planned(self, query, structure):
        return requests.oecd_data(structure, query.wanted, version=query.version or "+", split_by=query.split_by, **query.options)

    def updates(self, query):
        """The service itself leaves out what it had before an instant."""

        def since_then(since: datetime | None) -> DataFrame | None:
            return self.execute(query if since is None else Query.of({**query.plain(), "options": {**query.options, "updated_after": since}}))

        return since_then


class Declarations(Client):
    """Tariff lines: the dataflow is the classification, the agency the type of trade."""

    source = "declarations"

    def _plan(self, query: Query) -> list[Request]:
        said = dict(query.options)
        frequency = said.pop("frequency", "A")
        if "start" in said:
            begin, end = instant(said.pop("start")), instant(said.pop("end", None)) or datetime.now()
            said["periods"] = planning.periods(begin.date(), end.date(), frequency)
        selection = {**query.wanted, **({"periods": said.pop("periods")} if "periods" in said else {})}
        return requests.declarations(selection, type_code=query.agency or "C", frequency=frequency, classification=query.dataflow, **said)

    def resolve(self, query: Query) -> Structure:
        dims = [c.split()[0] for c in TARIFF_LINES.split(", ") if c.split()[0] not in (*TARIFF_MEASURES, "reporterISO", "partnerISO")]
        return Structure(query.agency or "C", query.dataflow, tuple(structures.Dimension(n, k) for k, n in enumerate(dims)))

    def get(self, query: Query) -> tuple[DataFrame, dict[str, str]]:
        """Tariff lines as declared, and the parameters that were asked with."""
        plan = self._plan(query)
        asked = {k: ",".join(map(str, v)) if isinstance(v, (list, tuple)) else str(v) for k, v in (plan[0].params if len(plan) == 1 else {**query.wanted, **query.options}).items()}
        return responses.declaration_rows(self.landed(plan, "lines"), TARIFF_LINES), asked

    def execute(self, query: Query) -> DataFrame:
        """Tariff lines, one for each combination of dimensions."""
        rows, _ = self.get(query)
        return relational.sum_duplicates(rows, [c for c in rows.columns if c not in TARIFF_MEASURES], TARIFF_MEASURES)

    def primary_key(self, query: Query) -> list[str]:
        return self.resolve(query).names

    def listing(self) -> dict[str, str]:
        """Where the codes of each category are."""
        rows = responses.references(self.landed([requests.reference_listing()], "listing"), "category string, fileuri string")
        return {r["category"]: r["fileuri"] for r in rows.collect()}  # some tens of categories

    def metadata(self, category: str | None = None, schema: str = "id string, text string") -> DataFrame:
        """The codes of a category by a schema of the wanted columns, or the categories; ValueError for an unknown one."""
        listing = self.listing()
        if category is None:
            return self.spark.createDataFrame(sorted(listing.items()), "category string, fileuri string")
        return responses.references(self.landed([requests.whole_url(responses.category_file(listing, category))], "codes"), schema)

    def codes(self, category: str) -> DataFrame:
        """Valid codes of a category."""
        columns = {"reporter": "reporterCode int, entryExpiredDate string", "partner": "PartnerCode int, entryExpiredDate string"}
        return responses.valid_codes(self.metadata(category, columns.get(category, "id string")), category)

    def availability(self, query: Query) -> DataFrame:
        """``period, lastReleased``: the last release of each period."""
        asked = requests.declared_availability(query.wanted.get("reporters"), query.agency or "C", query.options.get("frequency", "A"), query.dataflow)
        rows = responses.declaration_rows(self.landed([asked], "availability"), "period string, lastReleased string")
        return rows.groupBy("period").agg(F.max("lastReleased").alias("lastReleased"))

    def updates(self, query):
        def since_then(since: datetime | None) -> DataFrame | None:
            if since is not None:
                released = {r["period"]: r["lastReleased"] for r in self.availability(query).collect()}  # a row a period
                asked = {p for r in self._plan(query) for p in planning.as_list(r.params.get("period"))}
                if not changed(last_release(released, asked or None), since):
                    return None
            return self.execute(query)

        return since_then


CLIENTS: dict[str, type[Client]] = {c.source: c for c in (Estat, Oecd, Declarations)}


def client(source: str, spark: SparkSession, folder: str, **options) -> Client:
    """The client of a source; ``limits`` names its parameter file, ``structures`` the file of known structures."""
    if source not in CLIENTS:
        raise ValueError(f"unknown source {source!r}; there are {sorted(CLIENTS)}")
    limits, known = options.pop("limits", None), options.pop("structures", None)
    if limits and not options.get("quota"):
        options["quota"] = quota_of(limits)
    return CLIENTS[source](spark, folder, Structures(known), **options)


def queries(source: str, said: Sequence[Mapping]) -> list[Query]:
    """The queries of a source's parameter file, each once."""
    if source not in CLIENTS:
        raise ValueError(f"unknown source {source!r}; there are {sorted(CLIENTS)}")
    found = [Query.of({**one, "source": source}) for one in said]
    return list({q.key: q for q in found}.values())
