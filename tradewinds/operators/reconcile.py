"""Reconciliation of mirror declarations: relational steps.

Declarations of exports and imports are set side by side, brought to tonnes and to values without
freight, weighted by the reporters' quality and extended by flows of unspecified partners.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewinds.functions.exprs import floored, log_positive, not_in, number, ratio, sum0
from tradewinds.operators.relational import first_per_key

KEYS = ("exporter", "importer", "product", "year")


@dataclass(frozen=True)
class ReconcileConfig:
    world_code: int = 0
    nes_codes: tuple[int, ...] = (899,)
    skip_codes: tuple[int, ...] = (490,)
    kg_unit: int = 8
    weight_units: tuple[int, ...] = (8,)
    least_ratios: int = 10
    most_deviation: float = 2.5
    non_cif: tuple[str, ...] = ()
    fas: tuple[str, ...] = ()
    excluded_pairs: tuple[tuple[str, str], ...] = ()
    prefer_net_weight: bool = True


def gravity(dist: DataFrame, geo: DataFrame) -> DataFrame:
    """Distances with contiguity and both ends' landlockedness; ``"."`` and other text is missing."""
    geo = first_per_key(geo, ["iso3"], [F.col("landlocked").asc_nulls_last()]).select("iso3", number(F.col("landlocked").cast("string")).alias("landlocked"))
    out = dist.select("iso_o", "iso_d", number(F.col("distw").cast("string")).alias("distw"), number(F.col("contig").cast("string")).alias("contig"))
    for side in ("o", "d"):
        out = out.join(geo.select(F.col("iso3").alias(f"iso_{side}"), F.col("landlocked").alias(f"landlocked_{side}")), f"iso_{side}", "left")
    return out.select("iso_o", "iso_d", "distw", "contig", "landlocked_o", "landlocked_d")


def declared(rows: DataFrame) -> DataFrame:
    """Declarations with a year and a direction."""
    sold = F.col("flowCode") == "X"
    return rows.select("flowCode", "partnerCode", F.col("cmdCode").alias("product"), F.substring("period", 1, 4).cast("int").alias("year"), F.when(sold, F.col("reporterISO")).otherwise(F.col("partnerISO")).alias("exporter"), F.when(sold, F.col("partnerISO")).otherwise(F.col("reporterISO")).alias("importer"), F.col("primaryValue").alias("value"), "qty", F.col("qtyUnitCode").alias("unit"), F.col("netWgt").alias("net"))


def nes_declarations(rows: DataFrame, config: ReconcileConfig) -> DataFrame:
    """Exports to unspecified partners."""
    return declared(rows).where((F.col("flowCode") == "X") & F.col("partnerCode").isin(list(config.nes_codes)))


def side(rows: DataFrame, tag: str) -> DataFrame:
    """One side's value, net weight, and quantity in the unit that holds most; ties go to the smaller unit."""
    rows = rows.where(F.col("exporter").isNotNull() & F.col("importer").isNotNull() & F.col("product").isNotNull() & F.col("year").isNotNull())
    units = rows.groupBy(*KEYS, "unit").agg(sum0("value").alias("v"), sum0("net").alias("nw"), sum0("qty").alias("q"))
    best = F.max(F.when(F.col("unit").isNotNull(), F.struct(F.col("q").alias("q"), (-F.col("unit")).alias("minus"))))
    out = units.groupBy(*KEYS).agg(F.sum("v").alias(f"v_{tag}"), F.sum("nw").alias(f"nw_{tag}"), best.alias("best"))
    return out.select(*KEYS, f"v_{tag}", f"nw_{tag}", F.col("best.q").alias(f"q_{tag}"), (-F.col("best.minus")).alias(f"unit_{tag}"))


def mirror(rows: DataFrame, countries: DataFrame, config: ReconcileConfig) -> DataFrame:
    """Both declarations of each directed flow, product and year."""
    flows = declared(rows).where(not_in(F.col("partnerCode"), (config.world_code, *config.skip_codes)))
    for end in ("exporter", "importer"):
        flows = flows.join(countries.select(F.col("iso").alias(end)), end, "left_semi")
    out = side(flows.where("flowCode = 'X'"), "x").join(side(flows.where("flowCode = 'M'"), "m"), list(KEYS), "full")
    for a, b in config.excluded_pairs:
        out = out.where(~(F.col("exporter").isin(a, b) & F.col("importer").isin(a, b)))
    return out


def known_tonnes(tag: str, config: ReconcileConfig) -> Column:
    net, q, unit = F.col(f"nw_{tag}"), F.col(f"q_{tag}"), F.col(f"unit_{tag}")
    by_unit = F.when(unit.isin(list(config.weight_units)), q * 1e-3)
    by_net = F.when(net > 0, net * 1e-3)
    return F.coalesce(by_net, by_unit) if config.prefer_net_weight else F.coalesce(by_unit, by_net)


def conversion_rates(flows: DataFrame, config: ReconcileConfig) -> DataFrame:
    """Tonnes for a unit of quantity: means of enough ratios that agree well enough."""
    sides = []
    for tag, other in (("x", "m"), ("m", "x")):
        t, q, unit = known_tonnes(other, config), F.col(f"q_{tag}"), F.col(f"unit_{tag}")
        sides.append(flows.where(unit.isNotNull() & not_in(unit, config.weight_units) & (q > 0) & (t > 0)).select("product", unit.alias("unit"), ratio(t, q).alias("ratio")))
    out = sides[0].unionByName(sides[1]).groupBy("product", "unit").agg(F.avg("ratio").alias("rate"), F.stddev_samp("ratio").alias("deviation"), F.count("ratio").alias("n"))
    return out.where((F.col("n") >= config.least_ratios) & (F.col("deviation") < config.most_deviation))


def tonnage(flows: DataFrame, rates: DataFrame, config: ReconcileConfig) -> DataFrame:
    """Flows with both sides' quantities in tonnes."""
    for tag in ("x", "m"):
        of = rates.select("product", F.col("unit").alias(f"unit_{tag}"), F.col("rate").alias("_rate"))
        flows = flows.join(of, ["product", f"unit_{tag}"], "left").withColumn(f"q_{tag}_t", F.coalesce(known_tonnes(tag, config), F.col(f"q_{tag}") * F.col("_rate"))).drop("_rate")
    return flows


def unit_values(flows: DataFrame) -> DataFrame:
    """The median export value of a tonne of each product."""
    return flows.where("v_x > 0 AND q_x_t > 0").groupBy("product").agg(F.median(F.col("v_x") / F.col("q_x_t")).alias("uv"))


def design(flows: DataFrame, grav: DataFrame, values: DataFrame) -> DataFrame:
    """Flows with the regressors of the freight model; null where one is missing."""
    out = flows.join(grav, (F.col("exporter") == F.col("iso_o")) & (F.col("importer") == F.col("iso_d")), "left").drop("iso_o", "iso_d").join(values, "product", "left")
    ln_d = log_positive(F.col("distw"))
    return out.withColumn("ln_d", ln_d).withColumn("ln_d2", ln_d * ln_d).withColumn("ln_uv", log_positive(F.col("uv")))


def freight_sample(rows: DataFrame) -> DataFrame:
    """Rows that the freight model is fitted on, with ``y`` and ``w``."""
    rows = rows.where("v_x > 0 AND v_m > 0 AND q_x_t > 0 AND q_m_t > 0")
    y = F.ln((F.col("v_m") / F.col("q_m_t")) / (F.col("v_x") / F.col("q_x_t")))
    w = F.least("q_x_t", "q_m_t") / F.greatest("q_x_t", "q_m_t")
    return rows.withColumn("y", y).withColumn("w", w).dropna(subset=["y", "w", "ln_d", "ln_d2", "contig", "landlocked_o", "landlocked_d", "ln_uv"])


def fobized(flows: DataFrame, config: ReconcileConfig) -> DataFrame:
    """``v_m_fob``: import values without freight, of rows with a rate ``tau``."""
    cut = floored(F.coalesce(F.col("v_m") / (1 + F.col("tau")), F.col("v_m")))
    cut = F.when(F.col("importer").isin(list(config.non_cif)), F.col("v_m")).otherwise(cut) if config.non_cif else cut
    if config.fas:
        gap = lambda v: F.abs(log_positive(ratio(F.col("v_x"), v)))
        both = (F.col("v_x") > 0) & (F.col("v_m") > 0)
        better = F.coalesce(gap(cut) < gap(F.col("v_m")), F.lit(False))
        cut = F.when(F.col("importer").isin(list(config.fas)) & both & ~better, F.col("v_m")).otherwise(cut)
    return flows.withColumn("v_m_fob", cut)


def reporting_distance(flows: DataFrame, target: str) -> DataFrame:
    """Log distances of both declarations of a value or quantity, with their weights."""
    pairs = {"value": ("v_x", "v_m_fob"), "quantity": ("q_x_t", "q_m_t")}
    if target not in pairs:
        raise ValueError(f"unknown target {target!r}; there are {list(pairs)}")
    a, b = map(F.col, pairs[target])
    weight = log_positive(F.coalesce("v_x", F.lit(0.0)) + F.coalesce("v_m_fob", F.lit(0.0)))
    return flows.where((a > 0) & (b > 0)).select(*KEYS, F.abs(F.ln(a / b)).alias("distance"), weight.alias("weight")).where("weight > 0")


def spread(sigma: Column) -> Column:
    """The variance of a log-normal error."""
    return F.exp(sigma * sigma) * (F.exp(sigma * sigma) - 1)


def optimal_weight(sigma_exporter: Column, sigma_importer: Column) -> Column:
    """The exporter's weight in the mean of both declarations."""
    i, j = spread(sigma_exporter), spread(sigma_importer)
    return F.when(i + j > 0, j / (i + j)).otherwise(0.5)


def reconciled(flows: DataFrame, sigma: dict[str, DataFrame]) -> DataFrame:
    """Flows with one value and quantity. ``sigma`` has ``country, sigma_export, sigma_import`` for each target."""
    for target, (a, b) in {"value": ("v_x", "v_m_fob"), "quantity": ("q_x_t", "q_m_t")}.items():
        table = sigma[target]
        middle = table.agg(F.coalesce(F.median("sigma_export"), F.lit(0.0)).alias("_mx"), F.coalesce(F.median("sigma_import"), F.lit(0.0)).alias("_mm"))  # one row
        flows = flows.join(table.select(F.col("country").alias("exporter"), F.col("sigma_export").alias("_sx")), "exporter", "left")
        flows = flows.join(table.select(F.col("country").alias("importer"), F.col("sigma_import").alias("_sm")), "importer", "left").crossJoin(F.broadcast(middle))
        w = optimal_weight(F.coalesce("_sx", "_mx"), F.coalesce("_sm", "_mm"))
        x, m = F.col(a), F.col(b)
        flows = flows.withColumn(f"reconciled_{target}", F.when((x > 0) & (m > 0), w * x + (1 - w) * m).when(x > 0, x).when(m > 0, m)).drop("_sx", "_sm", "_mx", "_mm")
    return flows


GROUP = ("exporter", "product", "year")


def nes_shortfall(flows: DataFrame, nes: DataFrame) -> DataFrame:
    """For each exporter, product and year: unspecified exports, the shortfall of both-sided flows, and what is reallocated."""
    v_nes = nes.groupBy(*GROUP).agg(F.sum("value").alias("v_nes"))
    sums = flows.where("v_x > 0 AND v_m_fob > 0").groupBy(*GROUP).agg(F.sum("v_x").alias("sum_x"), F.sum("v_m_fob").alias("sum_m"))
    out = v_nes.join(sums, list(GROUP), "left").withColumn("shortfall", F.greatest(F.coalesce(F.col("sum_m") - F.col("sum_x"), F.lit(0.0)), F.lit(0.0)))
    return out.withColumn("realloc", F.least("v_nes", "shortfall"))


def nes_shares(flows: DataFrame, shortfall: DataFrame) -> DataFrame:
    """What each under-declared flow gets of its group's reallocation."""
    complete = flows.where("v_x > 0 AND v_m_fob > 0").select(*KEYS, "v_x", "v_m_fob")
    joined = complete.join(shortfall.where("realloc > 0").select(*GROUP, "realloc"), list(GROUP))
    missing = F.greatest(F.col("v_m_fob") - F.col("v_x"), F.lit(0.0))
    total = F.sum("missing").over(Window.partitionBy(*GROUP))
    joined = joined.withColumn("missing", missing).withColumn("total", total)
    return joined.withColumn("addition", F.when(F.col("total") > 0, F.col("realloc") * F.col("missing") / F.col("total")).otherwise(0.0))


def nes_safeguard(shares: DataFrame) -> DataFrame:
    """Shares of the groups whose mirror gap shrinks, by more than the rounding of sums whose order isn't fixed (12 places)."""
    before = F.abs(F.ln(F.col("v_m_fob") / F.col("v_x")))
    after = F.abs(F.ln(F.col("v_m_fob") / (F.col("v_x") + F.col("addition"))))
    gaps = shares.groupBy(*GROUP).agg(F.sum(before).alias("before"), F.sum(after).alias("after"))
    return shares.join(gaps.where(F.round("after", 12) < F.round("before", 12)).select(*GROUP), list(GROUP), "left_semi")


def nes_residual(flows: DataFrame, shortfall: DataFrame, kept: DataFrame) -> DataFrame:
    """What is left of unspecified exports, beside flows that only importers declare."""
    given = kept.groupBy(*GROUP).agg(F.sum("addition").alias("allocated"))
    only = flows.where("coalesce(v_x, 0) <= 0 AND v_m_fob > 0").groupBy(*GROUP).agg(F.sum("v_m_fob").alias("import_only"))
    out = shortfall.select(*GROUP, "v_nes").join(given, list(GROUP), "left").join(only, list(GROUP), "left")
    return out.select(*GROUP, (F.col("v_nes") - F.coalesce("allocated", F.lit(0.0))).alias("residual"), F.coalesce("import_only", F.lit(0.0)).alias("import_only"))


def with_nes(flows: DataFrame, nes: DataFrame) -> DataFrame:
    """Reconciled flows with their share of unspecified exports."""
    kept = nes_safeguard(nes_shares(flows, nes_shortfall(flows, nes))).select(*KEYS, "addition")
    out = flows.join(kept, list(KEYS), "left")
    return out.withColumn("reconciled_value", F.col("reconciled_value") + F.coalesce("addition", F.lit(0.0))).drop("addition")


HALF_PI = math.pi / 2


def columns_of_result() -> Sequence[str]:
    return [*KEYS, "reconciled_value", "reconciled_quantity"]
