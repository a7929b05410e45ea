"""Request planning: pure functions from dimensions to keys, splits and periods."""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Mapping, Sequence
from datetime import date

#: How a key is written: between dimensions, between values, and for any value.
KEY_STYLES = {"3.0": (".", "+", "*"), "2.1": (".", "+", "all"), "v1": (".", ",", ""), "v2": (".", None, "*")}


def as_list(value) -> list[str]:
    """A scalar or an iterable as a list of texts; None as an empty one."""
    if value is None:
        return []
    return [str(value)] if isinstance(value, (str, int)) else [str(v) for v in value]


def identity_key(agency: str, dataflow: str, version: str = "*", params: Mapping | None = None) -> str:
    """One text for a request, whatever the order of its dimensions and values; None is left out."""
    parts = [f"{name}={','.join(sorted(as_list(values)))}" for name, values in sorted((params or {}).items()) if values is not None]
    return f"{agency}::{dataflow}::{version}::{';'.join(parts)}"


def split(dimensions: Mapping[str, Iterable], most: int = 100) -> list[dict[str, str]]:
    """One request for each combination of values; ValueError beyond ``most``."""
    names = list(dimensions)
    out = [dict(zip(names, values, strict=True)) for values in itertools.islice(itertools.product(*(as_list(dimensions[n]) for n in names)), most + 1)]
    if len(out) > most:
        raise ValueError(f"the split has more than {most} combinations")
    return out


def positional_key(order: Sequence[str], wanted: Mapping[str, Iterable], style: str) -> str:
    """The key of a request, dimension by dimension."""
    between, values, anything = KEY_STYLES[style]
    unknown = set(wanted) - set(order)
    if unknown:
        raise ValueError(f"unknown dimensions {sorted(unknown)}; there are {list(order)}")
    parts = []
    for name in order:
        held = as_list(wanted.get(name))
        if len(held) > 1 and values is None:
            raise ValueError(f"{name} takes one value in a {style} key")
        parts.append((values or "").join(held) or anything)
    return between.join(parts)


def periods(start: date, end: date, frequency: str = "A") -> list[str]:
    """Years or months from ``start`` to ``end``, as ``YYYY`` or ``YYYYMM``."""
    if frequency == "A":
        return [str(y) for y in range(start.year, end.year + 1)]
    months = range(start.year * 12 + start.month - 1, end.year * 12 + end.month)
    return [f"{m // 12}{m % 12 + 1:02d}" for m in months]


def valid_periods(today: date, frequency: str = "A", wanted: Iterable[str] | None = None, first: int = 1962) -> list[str]:
    """Complete periods up to today: the last isn't over; only those of ``wanted``, if given."""
    whole = periods(date(first, 1, 1), today, frequency)[:-1]
    return whole if wanted is None else [p for p in whole if p in set(wanted)]


def batches(codes: Sequence[str], size: int) -> list[list[str]]:
    return [list(codes[k : k + size]) for k in range(0, len(codes), size)]


def halved(selection: Mapping[str, Sequence], order: Sequence[str]) -> list[dict[str, Sequence]]:
    """A selection as two, cut along the first dimension of ``order`` that has several values; none if there is none."""
    name = next((n for n in order if len(selection.get(n) or ()) > 1), None)
    if name is None:
        return []
    half = len(selection[name]) // 2
    return [{**selection, name: part} for part in (selection[name][:half], selection[name][half:])]


def schema_name(dataflow: str) -> str:
    """A dataflow's name as that of a schema."""
    name = "".join(c if c.isascii() and c.isalnum() else "_" for c in dataflow)
    return f"df_{name}" if name[:1].isdigit() else name


def primary_key(dimensions: Sequence[str], columns: Sequence[str], time: str = "TIME_PERIOD") -> list[str]:
    """The columns that are dimensions, in any case, and the time column; ValueError if there is none."""
    known = {d.lower() for d in dimensions} | {time.lower()}
    out = [c for c in columns if c.lower() in known]
    if not out:
        raise ValueError(f"no column of {list(columns)} is a dimension")
    return out


def by_priority(queries: Iterable[str], last: Mapping[str, object]) -> list[str]:
    """Requests in the order of a run: never fetched first, then the oldest."""
    return sorted(queries, key=lambda q: (q in last, last.get(q) if q in last else 0))
