"""Structures of dataflows: their dimensions, code lists and update times, from XML or JSON."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import asdict, dataclass
from datetime import datetime
from pathlib import Path
from xml.etree import ElementTree

from tradewinds.sources.control import instant, read_json, write_json

_LANG = "{http://www.w3.org/XML/1998/namespace}lang"


@dataclass(frozen=True)
class Dimension:
    name: str
    position: int
    description: str | None = None
    codelist: str | None = None


@dataclass(frozen=True)
class Structure:
    agency: str
    dataflow: str
    dimensions: tuple[Dimension, ...]
    description: str | None = None

    @property
    def names(self) -> list[str]:
        return [d.name for d in sorted(self.dimensions, key=lambda d: d.position)]

    def position(self, name: str) -> int | None:
        """Where a dimension stands in a key: by its name, else by its name in any case."""
        exact = [d.position for d in self.dimensions if d.name == name]
        loose = [d.position for d in self.dimensions if d.name.lower() == name.lower()]
        return next(iter(exact + loose), None)

    def by_position(self, wanted: Mapping[str | int, object]) -> dict[int, object]:
        """Filters by position, from names or positions; ValueError for a name that isn't there."""
        at = {name: name if isinstance(name, int) else self.position(name) for name in wanted}
        unknown = sorted(name for name, place in at.items() if place is None)
        if unknown:
            raise ValueError(f"unknown dimensions {unknown}; there are {self.names}")
        return {at[name]: values for name, values in wanted.items()}


def _root(xml: str) -> ElementTree.Element:
    try:
        return ElementTree.fromstring(xml.encode())
    except ElementTree.ParseError as error:
        raise ValueError(f"no XML: {error}") from error


def _name(element: ElementTree.Element) -> str | None:
    """The English name of an artefact, else its first."""
    held = {n.get(_LANG): n.text for n in reversed(element.findall("{*}Name"))}
    return held.get("en", next(reversed(held.values()), None))


def codelist_of(urn: str | None) -> str | None:
    """The code list that a URN names."""
    found = re.search(r"Codelist=[^:]*:([^()]+)", urn or "")
    return found and found.group(1)


def structure_of_xml(xml: str, agency: str, dataflow: str) -> Structure:
    """The dimensions of a data structure definition; ValueError without one. Namespaces of any version do."""
    root = _root(xml)
    top = root.find(".//{*}DataStructure")
    if top is None:
        raise ValueError(f"no data structure of {dataflow}")
    concepts = {c.get("id"): _name(c) for c in root.iterfind(".//{*}Concept")}
    dims = [
        Dimension(d.get("id"), int(d.get("position", k)), concepts.get(d.get("id")), codelist_of(d.findtext("{*}LocalRepresentation/{*}Enumeration")))
        for k, d in enumerate(top.iterfind(".//{*}DimensionList/{*}Dimension"))
    ]
    return Structure(agency, dataflow, tuple(sorted(dims, key=lambda d: d.position)))


def structure_of_json(doc: Mapping, agency: str, dataflow: str) -> Structure:
    """The dimensions in a JSON structure message, of observations or of a definition; ValueError without any."""
    data = doc.get("data", doc)
    concepts = {c.get("id"): (c.get("names") or {}).get("en") or c.get("name") for s in data.get("conceptSchemes", ()) for c in s.get("concepts", ())}
    shape = data.get("structure") or data.get("structures") or {}
    listed = shape.get("dimensions") if isinstance(shape, Mapping) else None
    if isinstance(listed, Mapping):
        listed = listed.get("observation")
    for definition in data.get("dataStructures", ())[:1] if listed is None else ():
        listed = definition["dataStructureComponents"]["dimensionList"]["dimensions"]
    if listed is None:
        raise ValueError(f"no dimensions of {dataflow}")
    dims = []
    for k, d in enumerate(listed):
        name = d.get("id") or d.get("name") or f"DIM_{k}"
        label = d.get("name") or (d.get("names") or {}).get("en") or concepts.get((d.get("conceptIdentity") or name).rsplit(".", 1)[-1])
        dims.append(Dimension(name, int(d.get("position", d.get("keyPosition", k))), label if label != name else None))
    return Structure(agency, dataflow, tuple(sorted(dims, key=lambda d: d.position)))


def dataflows_of_xml(xml: str) -> list[dict]:
    """``id, name, version, agency`` of each dataflow in a listing."""
    return [{"id": f.get("id"), "name": _name(f), "version": f.get("version"), "agency": f.get("agencyID")} for f in _root(xml).iterfind(".//{*}Dataflow") if f.get("id")]


def codes_of_xml(xml: str) -> list[dict]:
    """``code, name`` of each code in a code list."""
    return [{"code": c.get("id"), "name": _name(c)} for c in _root(xml).iterfind(".//{*}Codelist/{*}Code")]


def last_update_of_xml(xml: str) -> datetime | None:
    """When the data changed, by the annotations of a data constraint; else when the message was made; else None.

    An annotation of the data's update goes before those of other updates, and its title before its text.
    """
    try:
        root = _root(xml)
    except ValueError:
        return None
    dated = []
    for note in root.iterfind(".//{*}Annotation"):
        kind = (note.findtext("{*}AnnotationType") or "").upper()
        when = instant(note.findtext("{*}AnnotationTitle")) or instant(note.findtext("{*}AnnotationText"))
        if "UPDATE" in kind and when:
            dated.append(("DATA" not in kind, len(dated), when))
    return min(dated)[2] if dated else instant(root.findtext(".//{*}Prepared"))


class Structures:
    """Known structures by agency and dataflow, kept in a JSON file if one is named."""

    def __init__(self, path: str | Path | None = None, known: Iterable[Structure] = ()):
        self.path, self.held = path, {(s.agency, s.dataflow): s for s in known}
        doc = read_json(path, {}) if path else {}
        for s in doc.get("STRUCTURES") or doc.get("structures") or ():
            dims = tuple(Dimension(d["name"], d["position"], d.get("description"), d.get("codelist")) for d in s["dimensions"])
            self.held[s["agency"], s["dataflow"]] = Structure(s["agency"], s["dataflow"], dims, s.get("description"))

    def add(self, structure: Structure) -> Structure:
        self.held[structure.agency, structure.dataflow] = structure
        if self.path:
            write_json(self.path, {"STRUCTURES": [asdict(s) | {"num_dimensions": len(s.dimensions)} for s in self.held.values()]})
        return structure

    def resolve(self, agency: str, dataflow: str, fetch: Callable[[], Structure]) -> Structure:
        """The known structure, else the fetched one, which is known from then on."""
        return self.held.get((agency, dataflow)) or self.add(fetch())
