"""Requests of the statistical services: a base URL, a path, parameters and headers for each dialect."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from tradewinds.sources import planning
from tradewinds.sources.structures import Structure

# Fixed values of the services: addresses, media types and names of formats.
ESTAT = "https://ec.europa.eu/eurostat/api/dissemination"
COMEXT = "https://ec.europa.eu/eurostat/api/comext/dissemination"
OECD = "https://sdmx.oecd.org/public/rest"
DECLARATIONS = "https://comtradeapi.un.org"
ESTAT_FORMATS = {"csv": "csvdata", "tsv": "tsv", "json": "json"}
OECD_FORMATS = {"csv_labels": "csvfilewithlabels", "csv": "csvfile", "json": "jsondata"}
ESTAT_ACCEPT = {"3.0": "application/vnd.sdmx.structure+xml;version=3.0.0", "2.1": "application/vnd.sdmx.structure+xml;version=2.1"}
OECD_ACCEPT = {("json", "v1"): "application/vnd.sdmx.data+json; charset=utf-8; version=1.0", ("json", "v2"): "application/vnd.sdmx.data+json; charset=utf-8; version=2", ("csv", "v1"): "application/vnd.sdmx.data+csv; charset=utf-8", ("csv", "v2"): "application/vnd.sdmx.data+csv; charset=utf-8; version=2"}
OECD_STRUCTURE_ACCEPT = "application/vnd.sdmx.structure+json; charset=utf-8; version=1.0"
TIMEOUTS = {ESTAT: 90, COMEXT: 90, OECD: 60, DECLARATIONS: 120}
ARTEFACTS = ("dataflow", "datastructure", "dataconstraint", "conceptscheme", "codelist")
#: Arguments of the declarations service, in the order in which a request is halved.
ARGUMENTS = {"flows": "flowCode", "products": "cmdCode", "reporters": "reporterCode", "partners": "partnerCode", "partners2": "partner2Code", "customs": "customsCode", "mot": "motCode", "periods": "period"}


@dataclass(frozen=True)
class Request:
    """One GET. ``halve`` names list parameters that may be split where a response has ``limit`` rows."""

    base: str
    path: str
    params: Mapping[str, object] = field(default_factory=dict)
    headers: Mapping[str, str] = field(default_factory=dict)
    halve: Sequence[str] = ()
    limit: int = 0

    @property
    def timeout(self) -> float:
        """Seconds that the service gets to answer."""
        return TIMEOUTS.get(self.base, 30)


def estat_base(dataflow: str) -> str:
    """Trade statistics have an address of their own."""
    return COMEXT if dataflow.upper().startswith(("DS-", "CXT_")) else ESTAT


def _window(start: str | None, end: str | None) -> str:
    return "+".join(f"{op}:{v}" for op, v in (("ge", start), ("le", end)) if v)


def _present(**params) -> dict[str, str]:
    return {k: str(v) for k, v in params.items() if v not in (None, "")}


def _moment(value: str | datetime | None) -> str | None:
    if isinstance(value, datetime):
        return value.isoformat() if value.tzinfo else value.strftime("%Y-%m-%dT%H:%M:%SZ")
    return value


def estat_data(structure: Structure, wanted: Mapping[str, Iterable] | None = None, style: str = "3.0", *, version: str | None = None, split_by: Sequence[str] = (), most: int = 100, start=None, end=None, last_n=None, first_n=None, format: str = "csv", lang=None, labels=None, compress: bool = False, headers: Mapping[str, str] | None = None) -> list[Request]:
    """Data requests, one for each combination of the dimensions in ``split_by``.

    In style 3.0 single values go into the key and several into ``c[DIM]``; in 2.1 all go into the key.
    """
    if format not in ESTAT_FORMATS:
        raise ValueError(f"format {format!r} isn't one of {list(ESTAT_FORMATS)}")
    names = {n.lower(): n for n in structure.names}
    if unknown := sorted(k for k in wanted or {} if k.lower() not in names):
        warnings.warn(f"unknown dimensions {unknown} are left out; there are {structure.names}", stacklevel=2)
    wanted = {names[k.lower()]: planning.as_list(v) for k, v in (wanted or {}).items() if k.lower() in names}
    accept = {"Accept": ESTAT_ACCEPT[style], **(headers or {})}
    out = []
    for one in planning.split({k: wanted[k] for k in split_by}, most):
        filters = wanted | {k: [v] for k, v in one.items()}
        if style == "3.0":
            key = planning.positional_key(structure.names, {k: v for k, v in filters.items() if len(v) == 1}, style)
            params = {f"c[{k.upper()}]": ",".join(v) for k, v in filters.items() if len(v) > 1}
            params |= _present(**{"c[TIME_PERIOD]": _window(start, end)}, lastNObservations=last_n, firstNObservations=first_n, format=ESTAT_FORMATS[format], lang=lang, labels=labels, compress=str(compress).lower())
            path = f"sdmx/3.0/data/dataflow/{structure.agency}/{structure.dataflow}/{version or '*'}/{key}"
        else:
            key = planning.positional_key(structure.names, filters, style) if filters else "all"
            params = _present(startPeriod=start, endPeriod=end, firstNObservations=first_n, lastNObservations=last_n, format={"csv": "SDMX-CSV", "tsv": "TSV", "json": "JSON"}[format], compressed=str(compress).lower())
            flow = ",".join(filter(None, (structure.agency, structure.dataflow, version if version != "*" else None)))
            path = f"sdmx/2.1/data/{flow}/{key}"
        out.append(Request(estat_base(structure.dataflow), path, params, accept))
    return out


def estat_structure(kind: str, name: str, agency: str = "ESTAT", version: str | None = None, style: str = "3.0", *, references: str = "none", detail: str = "full") -> Request:
    """The XML of an artefact; all of a kind need all versions."""
    if kind not in ARTEFACTS:
        raise ValueError(f"artefact {kind!r} isn't one of {list(ARTEFACTS)}")
    base, accept = estat_base(name), {"Accept": ESTAT_ACCEPT[style]}
    if style == "3.0":
        version = "*" if name == "*" else version
        path = "/".join(filter(None, ("sdmx/3.0/structure", kind, agency, name, version)))
        return Request(base, path, _present(references=references, detail=detail, format="structure", formatVersion="3.0", compress="true"), accept)
    words = {"*": "all", "+": "latest", "~": "latest", None: "latest"}
    kind = "contentconstraint" if kind == "dataconstraint" else kind
    path = "/".join(("sdmx/2.1", kind, words.get(agency, agency), words["*"] if name == "*" else name, words.get(version, version)))
    return Request(base, path, _present(references=references, detail=detail), accept)


def oecd_data(structure: Structure, wanted: Mapping[str | int, Iterable] | None = None, style: str = "v2", *, version: str = "+", split_by: Sequence[str | int] = (), most: int = 100, start=None, end=None, last_n=None, updated_after=None, format: str = "csv_labels", attributes=None, measures=None) -> tuple[list[Request], dict[str, list[str]]]:
    """Data requests and the filters that rows must still pass: in v2 a key takes one value a dimension."""
    if format == "xml":
        raise NotImplementedError("data in XML")
    if format not in OECD_FORMATS:
        raise ValueError(f"format {format!r} isn't one of {list(OECD_FORMATS)}")
    names = structure.names
    filters = {names[p]: planning.as_list(v) for p, v in structure.by_position(wanted or {}).items()}
    splits = [names[p] for p in structure.by_position(dict.fromkeys(split_by))]
    if missing := [s for s in splits if s not in filters]:
        raise ValueError(f"nothing to split {missing} by; values are given of {list(filters)}")
    left = {k: v for k, v in filters.items() if style == "v2" and len(v) > 1 and k not in splits}
    out = []
    for one in planning.split({k: filters[k] for k in splits}, most):
        inside = {k: v for k, v in filters.items() if k not in left} | {k: [v] for k, v in one.items()}
        key = planning.positional_key(names, inside, style)
        params = _present(dimensionAtObservation="AllDimensions", format=OECD_FORMATS[format], lastNObservations=last_n)
        if style == "v2":
            params |= _present(**{"c[TIME_PERIOD]": _window(start, end)}, attributes=attributes, measures=measures, updatedAfter=_moment(updated_after))
            path = f"v2/data/dataflow/{structure.agency}/{structure.dataflow}/{version}/{key if inside else '*'}"
        else:
            params |= _present(startPeriod=start, endPeriod=end)
            path = f"data/{structure.agency},{structure.dataflow},{version}/{key if inside else 'all'}"
        out.append(Request(OECD, path, params, {"Accept": OECD_ACCEPT[format.split("_")[0], style], "Accept-Encoding": "gzip"}))
    return out, left


def oecd_structure(agency: str, dataflow: str, version: str = "+", style: str = "v2") -> Request:
    """The JSON structure message of a dataflow."""
    version = "+" if version in ("*", "~") else version
    path = f"v2/structure/dataflow/{agency}/{dataflow}/{version}" if style == "v2" else f"dataflow/{agency}/{dataflow}/{version}"
    return Request(OECD, path, {"references": "all", "detail": "referencepartial"}, {"Accept": OECD_STRUCTURE_ACCEPT})


def declarations(selection: Mapping[str, Iterable], *, type_code: str = "C", frequency: str = "A", classification: str = "HS", limit: int = 100_000, key: str | None = None, batch: int | None = None) -> list[Request]:
    """Tariff-line requests, one for each batch of products; each is halved where it reaches the limit."""
    unknown = sorted(set(selection) - set(ARGUMENTS))
    if unknown:
        raise ValueError(f"unknown dimensions {unknown}; there are {list(ARGUMENTS)}")
    held = {"flows": ["M", "X"]} | {n: planning.as_list(v) for n, v in selection.items() if v is not None}
    products = planning.batches(held["products"], batch) if batch and held.get("products") else [held.get("products")]
    out = []
    for some in products:
        now = {ARGUMENTS[n]: v for n, v in (held | ({"products": some} if some else {})).items() if v}
        headers = {"Ocp-Apim-Subscription-Key": key} if key else {}
        out.append(Request(DECLARATIONS, f"data/v1/getTariffline/{type_code}/{frequency}/{classification}", {**now, "maxRecords": limit, "includeDesc": "true"}, headers, tuple(a for a in ARGUMENTS.values() if a in now), limit))
    return out


def reference_listing() -> Request:
    """Which categories of codes the declarations service has, and where."""
    return Request(DECLARATIONS, "files/v1/app/reference/ListofReferences.json")


def whole_url(url: str) -> Request:
    """The request of a URL as it is."""
    base, _, path = url.rpartition("/")
    return Request(base, path)


def declared_availability(reporters=None, type_code: str = "C", frequency: str = "A", classification: str = "HS") -> Request:
    """Which periods of tariff lines there are, and when each was released."""
    return Request(DECLARATIONS, f"public/v1/getDATariffline/{type_code}/{frequency}/{classification}", {"reporterCode": ",".join(planning.as_list(reporters))} if reporters else {})
