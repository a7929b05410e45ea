"""Whole runs over a lake: indicators and reconciliation from stored tables, with a report of what was done."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewinds.functions.exprs import floored
from tradewinds.operators import estimation, indicators, reconcile
from tradewinds.operators.indicators import COMEXT, Layout
from tradewinds.scratch import written
from tradewinds.sources.lake import Lake
from tradewinds.streaming.sync import recompute


@dataclass(frozen=True)
class IndicatorReport:
    """``cells`` written, those that have a value of each indicator, and whether the table is new."""

    cells: int
    with_value: dict[str, int]
    created: bool


@dataclass(frozen=True)
class ReconciliationReport:
    """``flows`` written, the mean of their freight rates, as fitted and with negative ones as 0, and whether the table is new."""

    flows: int
    mean_freight: float | None
    mean_freight_floored: float | None
    created: bool


def _reported(results: DataFrame, layout: Layout, created: bool) -> IndicatorReport:
    said = results.agg(F.count("*"), *(F.count(n) for n in indicators.NAMES)).first()
    return IndicatorReport(said[0], dict(zip(indicators.NAMES, said[1:], strict=True)), created)


def all_indicators(lake: Lake, source: str, target: str, layout: Layout = COMEXT) -> IndicatorReport:
    """Computes the indicators of all observations of a table into another."""
    created = not lake.exists(target)
    results = written(indicators.indicators(lake.read(source, columns=layout.columns()), layout=layout), "indicators")
    lake.upsert(target, results, layout.cell)
    return _reported(results, layout, created)


def stale_indicators(lake: Lake, source: str, target: str, downloads: str, log: str, layout: Layout = COMEXT, into: Lake | None = None, now: Callable[[], datetime] = lambda: datetime.now(UTC)) -> IndicatorReport | None:
    """Computes the indicators of those (reporter, product) pairs whose downloads are newer than their last computation.

    ``downloads`` has the pairs and ``last_download``; ``log`` records what was computed. Results go to ``into``,
    which may be another lake. None if nothing is stale.
    """
    into = into or lake
    created, pair = not into.exists(target), ["reporter", "product"]
    done = into.read(log) if into.exists(log) else lake.read(downloads).select(*pair).limit(0).withColumn("last_computed", F.lit(None).cast("timestamp"))
    seen: list[DataFrame] = []

    def compute(stale: DataFrame) -> DataFrame:
        seen.append(written(indicators.indicators_of_pairs(lake.read(source, columns=layout.columns()), stale, layout), "indicators"))
        return seen[0]

    recompute(lake.read(downloads), done, pair, compute, into, target, layout.cell, log, now)
    return _reported(seen[0], layout, created) if seen else None


def mean_freight(flows: DataFrame) -> tuple[float | None, float | None]:
    """The mean of the freight rates that there are, and that with negative rates as 0."""
    rate = F.when(~F.isnan("tau") & (F.abs("tau") < F.lit(float("inf"))), F.col("tau"))
    return tuple(flows.agg(F.avg(rate), F.avg(floored(rate))).first())


def reconciliation(declarations: DataFrame, countries: DataFrame, dist: DataFrame, geo: DataFrame, config: reconcile.ReconcileConfig, sigma: Callable[[DataFrame], pd.DataFrame] = estimation.fit_quality) -> tuple[DataFrame, DataFrame]:
    """All six steps; the reconciled flows, and all flows with their freight rates."""
    spark = declarations.sparkSession
    flows = written(reconcile.mirror(declarations, countries, config), "mirror")
    tons = written(reconcile.tonnage(flows, reconcile.conversion_rates(flows, config), config), "tonnes")
    design = written(reconcile.design(tons, reconcile.gravity(dist, geo), reconcile.unit_values(tons)), "design")  # read by five passes of the fit
    rated = estimation.fit_freight(reconcile.freight_sample(design)).predict(design)
    fob = written(reconcile.fobized(rated, config), "fob")
    spread = {t: spark.createDataFrame(sigma(reconcile.reporting_distance(fob, t)), "country string, sigma_export double, sigma_import double") for t in ("value", "quantity")}
    out = reconcile.with_nes(written(reconcile.reconciled(fob, spread), "reconciled"), reconcile.nes_declarations(declarations, config))
    return out.where(F.col("reconciled_value").isNotNull()).select(*reconcile.columns_of_result()), fob


def reconcile_into(lake: Lake, target: str, *inputs, keys: Sequence[str] = reconcile.KEYS, **options) -> ReconciliationReport:
    """``reconciliation`` into a keyed table."""
    created = not lake.exists(target)
    out, fob = reconciliation(*inputs, **options)
    out = written(out, "baci")
    lake.upsert(target, out, keys)
    return ReconciliationReport(out.count(), *mean_freight(fob), created)
