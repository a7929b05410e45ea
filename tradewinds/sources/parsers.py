"""Payloads to rows, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewinds.functions.exprs import number


def tsv_to_rows(wide: DataFrame, dimensions: Sequence[str] | None = None) -> DataFrame:
    """A wide table whose first column holds all dimensions: one row for each period, flagged values null."""
    first, *rest = wide.columns
    held = [c for c in rest if any(x.isdigit() for x in c)]
    count = len(dimensions) if dimensions else first.count(",") + 1
    names = list(dimensions or (f"DIM_{k}" for k in range(count)))
    parts = F.split(F.col(f"`{first}`"), ",")
    cells = F.explode(F.array(*(F.struct(F.lit(c.strip()).alias("TIME_PERIOD"), F.col(f"`{c}`").cast("string").alias("raw")) for c in held)))
    rows = wide.select(*(F.trim(F.get(parts, F.lit(k))).alias(n) for k, n in enumerate(names)), cells.alias("cell"))
    return rows.select(*names, "cell.TIME_PERIOD", number(F.col("cell.raw")).alias("value"))


def jsonstat_to_rows(payloads: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """JSON-stat payloads, each by its own header: a column for each named dimension and the value; nulls are skipped.

    Cells are numbered row by row over the sizes, in the payload's order of dimensions; the values are a list or
    a map of those that there are, and so are the codes of a dimension. Text that isn't of this form has no rows.
    """
    part = lambda path: F.get_json_object(column, path)
    listed = part("$.value").startswith("[")
    dense, sparse = F.from_json(part("$.value"), "array<double>"), F.from_json(part("$.value"), "map<string,double>")
    as_cells = F.when(listed, F.transform(dense, lambda v, i: F.struct(i.cast("long").alias("at"), v.alias("value")))).otherwise(F.transform(F.map_entries(sparse), lambda e: F.struct(e["key"].cast("long").alias("at"), e["value"].alias("value"))))

    def codes(name: str) -> Column:
        held = part(f"$.dimension['{name}'].category.index")
        by_place = F.array_sort(F.transform(F.map_entries(F.from_json(held, "map<string,int>")), lambda e: F.struct(e["value"].alias("at"), e["key"].alias("code"))))
        return F.when(held.startswith("["), F.from_json(held, "array<string>")).otherwise(F.transform(by_place, lambda x: x["code"]))

    headers = [F.from_json(part("$.id"), "array<string>").alias("ids"), F.from_json(part("$.size"), "array<long>").alias("sizes")]
    rows = payloads.select(*headers, *(codes(n).alias(f"codes{k}") for k, n in enumerate(names)), F.explode(as_cells).alias("cell")).where("cell.value IS NOT NULL AND size(ids) = size(sizes)")
    out = []
    for k, name in enumerate(names):
        nth = F.array_position("ids", F.lit(name)).cast("int")
        after = F.aggregate(F.slice("sizes", nth + 1, F.size("sizes")), F.lit(1).cast("long"), lambda a, x: a * x)
        place = F.floor(F.col("cell.at") / after) % F.get("sizes", nth - 1)
        out.append(F.get(F.col(f"codes{k}"), place.cast("int")).alias(name))
    return rows.select(*out, F.col("cell.value").alias("value"))


def sdmxjson_to_rows(payloads: DataFrame, column: str, dimensions: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """SDMX-JSON payloads: keys ``0:1:2`` of the first data set to codes, with the value of each.

    An observation is a number, or a list of one and attributes of any type.
    """
    held = F.from_json(F.get_json_object(column, "$.dataSets[0].observations"), "map<string,string>")
    rows = payloads.select(F.explode(held).alias("key", "said"))
    part = F.split("key", ":")
    codes = [F.get(F.array(*map(F.lit, values)), F.get(part, F.lit(k)).cast("int")).alias(name) for k, (name, values) in enumerate(dimensions)]
    said = F.when(F.col("said").startswith("["), F.get_json_object("said", "$[0]")).otherwise(F.col("said"))
    return rows.select(*codes, number(said).alias("value"))


def availability(rows: DataFrame) -> DataFrame:
    """The last release of each period."""
    return rows.groupBy("period").agg(F.max("lastReleased").alias("lastReleased"))
