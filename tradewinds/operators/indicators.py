"""Supply-vulnerability indicators over observations ``(freq, reporter, product, flow, indicators, TIME_PERIOD, partner, OBS_VALUE)``.

All indicators are expressions over the same few sums. Observations, one row a partner, are aggregated
once, with map-side combining, to one row a cell. Cells of imports meet the cell of exports of the same
reporter, product and period in one join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewinds.functions.exprs import ratio
from tradewinds.operators.relational import individual


@dataclass(frozen=True)
class Layout:
    """Names of columns, and codes of flows and of partners that stand for several."""

    cell: tuple[str, ...] = ("freq", "reporter", "product", "flow", "indicators", "TIME_PERIOD")
    flow: str = "flow"
    partner: str = "partner"
    value: str = "OBS_VALUE"
    inward: int = 1
    outward: int = 2
    everyone: str = "WORLD"
    outside: str = "EXT_EU"
    several: tuple[str, ...] = ("WORLD", "QW", "EXT_EU", "INT_EU27_2020")
    reject_underscore: bool = True

    def columns(self) -> list[str]:
        return [*self.cell, self.partner, self.value]


COMEXT = Layout()


def _measures(layout: Layout) -> Mapping[str, Column]:
    """Each indicator over a cell's sums; null where it has none.

    HHI is the sum of the partners' squared shares in the total, CDI2 the share of imports from outside, and
    CDI3 imports from outside over all exports.
    """
    inward = F.col(layout.flow) == layout.inward
    return {
        "HHI": ratio(F.col("_squares"), F.col("_total") * F.col("_total")),
        "CDI2": F.when(inward, ratio(F.col("_outside"), F.col("_total"))),
        "CDI3": F.when(inward, ratio(F.col("_outside"), F.col("_sold"))),
    }


NAMES = ("HHI", "CDI2", "CDI3")


def cells(observations: DataFrame, layout: Layout = COMEXT, sold: bool = True) -> DataFrame:
    """One row a cell: ``_squares`` of single partners, ``_total`` and ``_outside`` as declared; ``_sold`` of the export cell, if asked for."""
    if lack := [c for c in layout.columns() if c not in observations.columns]:
        raise ValueError(f"missing columns {lack}; there are {observations.columns}")
    v, partner = F.col(layout.value), F.col(layout.partner)
    rows = observations.dropna(subset=[layout.partner, layout.value])
    single = individual(partner, layout.several, layout.reject_underscore)
    sums = rows.groupBy(*layout.cell).agg(
        F.sum(F.when(single, v * v)).alias("_squares"),
        F.max(F.when(partner == layout.everyone, v)).alias("_total"),
        F.max(F.when(partner == layout.outside, v)).alias("_outside"),
    )
    if not sold:
        return sums
    beside = [c for c in layout.cell if c != layout.flow]
    exports = sums.where(F.col(layout.flow) == layout.outward).select(*beside, F.col("_total").alias("_sold"))
    return sums.join(exports, beside, "left")


def indicators(observations: DataFrame, names: Sequence[str] = NAMES, layout: Layout = COMEXT, more: Mapping[str, Column] | None = None) -> DataFrame:
    """All cells with a column for each named indicator; ``more`` are further ones over the sums of ``cells``."""
    known = {**_measures(layout), **(more or {})}
    if unknown := [n for n in names if n not in known]:
        raise ValueError(f"unknown indicators {unknown}; there are {list(known)}")
    return cells(observations, layout, "CDI3" in names or bool(more)).select(*layout.cell, *(known[n].alias(n) for n in names))


def indicator(observations: DataFrame, name: str, layout: Layout = COMEXT) -> DataFrame:
    """The cells that have a value of one indicator."""
    return indicators(observations, [name], layout).where(F.col(name).isNotNull())


def indicators_of_pairs(observations: DataFrame, pairs: DataFrame, layout: Layout = COMEXT) -> DataFrame:
    """The indicators of the (reporter, product) pairs only: a semi-join before any aggregation."""
    return indicators(observations.join(pairs, ["reporter", "product"], "left_semi"), layout=layout)


def overview(observations: DataFrame, layout: Layout = COMEXT) -> DataFrame:
    """``flow, n, partners``: rows and single partners of each flow."""
    rows = observations.where(~F.col(layout.partner).isin(list(layout.several)))
    return rows.groupBy(layout.flow).agg(F.count("*").alias("n"), F.countDistinct(layout.partner).alias("partners"))
