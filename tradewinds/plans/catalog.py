"""The trade queries by name, each with the SQL it is held against."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import date
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewinds.functions.exprs import number
from tradewinds.operators import estimation, indicators, reconcile, relational
from tradewinds.operators.reconcile import GROUP, KEYS
from tradewinds.plans import crosswalk as cw
from tradewinds.plans import runs
from tradewinds.scratch import shared_dir, written
from tradewinds.sources import parsers, planning, responses
from tradewinds.sources.lake import Lake
from tradewinds.sources.requests import Request, whole_url

_J = """j AS (
  SELECT s_nationkey AS sk, c_nationkey AS ck, 'N' || s_nationkey AS exporter, 'N' || c_nationkey AS importer, p_brand AS product, CAST(year(o_orderdate) AS INTEGER) AS year,
    l_extendedprice * (1 - l_discount) AS v, CAST(l_quantity AS DOUBLE) AS quantity, l_tax AS tax, l_returnflag AS flag, l_linenumber AS line, p_size AS size
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
  WHERE s_nationkey <> c_nationkey)"""
_OBS = _J + """, one AS (
  SELECT 1 AS flow, importer AS reporter, exporter AS partner, sk AS pk, product, CAST(year AS VARCHAR) AS t, sum(v) AS v FROM j GROUP BY ALL
  UNION ALL SELECT 2, exporter, importer, ck, product, CAST(year AS VARCHAR), sum(v) FROM j GROUP BY ALL
), cells AS (
  SELECT flow, reporter, product, t, sum(v) AS world, sum(v * v) AS sq, sum(v) FILTER (WHERE n_regionkey <> 3) AS extra FROM one JOIN nation ON pk = n_nationkey GROUP BY ALL
), out AS (
  SELECT 'A' AS freq, a.reporter, a.product, a.flow, 'VALUE_IN_EUROS' AS indicators, a.t AS "TIME_PERIOD", a.sq / nullif(a.world * a.world, 0) AS "HHI",
    CASE WHEN a.flow = 1 THEN a.extra / nullif(a.world, 0) END AS "CDI2", CASE WHEN a.flow = 1 THEN a.extra / nullif(b.world, 0) END AS "CDI3"
  FROM cells a LEFT JOIN cells b ON b.flow = 2 AND a.reporter = b.reporter AND a.product = b.product AND a.t = b.t)"""
_DECL = _J + """, decl AS (
  SELECT 'X' AS flow, CASE WHEN line = 7 THEN 899 WHEN line = 6 AND size % 10 = 0 THEN 490 ELSE ck + 1 END AS code, product, year, exporter, CASE WHEN line = 7 THEN '_X' ELSE importer END AS importer,
    v AS value, quantity * 1000 AS qty, 8 AS unit, CASE WHEN size % 5 <> 0 THEN quantity * 1000 END AS net FROM j WHERE flag <> 'R'
  UNION ALL SELECT 'M', sk + 1, product, year, exporter, importer, v * (1 + tax), CASE WHEN size % 3 = 0 THEN quantity * 2 ELSE quantity * 1000 END,
    CASE WHEN size % 3 = 0 THEN 5 ELSE 8 END, CASE WHEN size % 3 <> 0 AND size % 5 <> 0 THEN quantity * 1000 END FROM j WHERE flag <> 'A'
), good AS (SELECT * FROM decl WHERE code NOT IN (0, 490) AND importer <> '_X'
), units AS (SELECT flow, exporter, importer, product, year, unit, sum(value) AS v, coalesce(sum(net), 0) AS nw, sum(qty) AS q FROM good GROUP BY ALL
), sides AS (SELECT flow, exporter, importer, product, year, sum(v) AS v, sum(nw) AS nw, max(q) AS q, first(unit ORDER BY q DESC, unit) AS unit FROM units GROUP BY ALL
), mirror AS (
  SELECT exporter, importer, product, year, x.v AS v_x, x.nw AS nw_x, x.q AS q_x, x.unit AS unit_x, m.v AS v_m, m.nw AS nw_m, m.q AS q_m, m.unit AS unit_m
  FROM (SELECT * FROM sides WHERE flow = 'X') x FULL JOIN (SELECT * FROM sides WHERE flow = 'M') m USING (exporter, importer, product, year)
  WHERE NOT (exporter IN ('N1', 'N2') AND importer IN ('N1', 'N2'))
), known AS (
  SELECT *, coalesce(CASE WHEN nw_x > 0 THEN nw_x * 1e-3 END, CASE WHEN unit_x = 8 THEN q_x * 1e-3 END) AS t_x, coalesce(CASE WHEN nw_m > 0 THEN nw_m * 1e-3 END, CASE WHEN unit_m = 8 THEN q_m * 1e-3 END) AS t_m FROM mirror
), rates AS (
  SELECT product, unit, avg(r) AS rate, stddev_samp(r) AS deviation, count(r) AS n FROM (
    SELECT product, unit_x AS unit, t_m / q_x AS r FROM known WHERE unit_x <> 8 AND q_x > 0 AND t_m > 0 UNION ALL SELECT product, unit_m, t_x / q_m FROM known WHERE unit_m <> 8 AND q_m > 0 AND t_x > 0)
  GROUP BY ALL HAVING count(r) >= 10 AND stddev_samp(r) < 2.5
), tons AS (
  SELECT k.*, coalesce(t_x, q_x * a.rate) AS q_x_t, coalesce(t_m, q_m * b.rate) AS q_m_t FROM known k LEFT JOIN rates a ON a.product = k.product AND a.unit = k.unit_x LEFT JOIN rates b ON b.product = k.product AND b.unit = k.unit_m
), uv AS (SELECT product, median(v_x / q_x_t) AS uv FROM tons WHERE v_x > 0 AND q_x_t > 0 GROUP BY product
), grav AS (
  SELECT 'N' || a.n_nationkey AS iso_o, 'N' || b.n_nationkey AS iso_d, CASE WHEN a.n_nationkey + b.n_nationkey <> 47 THEN 500.0 + 137 * abs(a.n_nationkey - b.n_nationkey) END::DOUBLE AS distw, (a.n_regionkey = b.n_regionkey)::INTEGER::DOUBLE AS contig,
    (a.n_nationkey % 4 = 0)::INTEGER::DOUBLE AS landlocked_o, (b.n_nationkey % 4 = 0)::INTEGER::DOUBLE AS landlocked_d FROM nation a JOIN nation b ON a.n_nationkey <> b.n_nationkey
), design AS (
  SELECT t.*, distw, contig, landlocked_o, landlocked_d, CASE WHEN distw > 0 THEN ln(distw) END AS ln_d, CASE WHEN distw > 0 THEN ln(distw) * ln(distw) END AS ln_d2, CASE WHEN uv > 0 THEN ln(uv) END AS ln_uv
  FROM tons t LEFT JOIN grav ON exporter = iso_o AND importer = iso_d LEFT JOIN uv USING (product)
), sample AS (
  SELECT *, ln((v_m / q_m_t) / (v_x / q_x_t)) AS y, least(q_x_t, q_m_t) / greatest(q_x_t, q_m_t) AS w FROM design WHERE v_x > 0 AND v_m > 0 AND q_x_t > 0 AND q_m_t > 0 AND ln_d IS NOT NULL AND ln_uv IS NOT NULL
), taus AS (SELECT *, exp(0.002 * ln_d + 0.005 * contig) - 1 AS tau FROM design
), cut0 AS (SELECT *, CASE WHEN importer = 'N3' THEN v_m ELSE greatest(coalesce(v_m / (1 + tau), v_m), 0) END AS cut FROM taus
), fob AS (
  SELECT *, CASE WHEN importer = 'N7' AND v_x > 0 AND v_m > 0 AND NOT coalesce(abs(CASE WHEN v_x / nullif(cut, 0) > 0 THEN ln(v_x / cut) END) < abs(ln(v_x / v_m)), false) THEN v_m WHEN v_m IS NOT NULL THEN cut END AS v_m_fob FROM cut0
), short AS (
  SELECT n.*, greatest(coalesce(sm - sx, 0), 0) AS shortfall, least(v_nes, greatest(coalesce(sm - sx, 0), 0)) AS realloc
  FROM (SELECT exporter, product, year, sum(value) AS v_nes FROM decl WHERE flow = 'X' AND code = 899 GROUP BY ALL) n
  LEFT JOIN (SELECT exporter, product, year, sum(v_x) AS sx, sum(v_m_fob) AS sm FROM fob WHERE v_x > 0 AND v_m_fob > 0 GROUP BY ALL) USING (exporter, product, year)
), shares0 AS (
  SELECT exporter, importer, product, year, v_x, v_m_fob, realloc, greatest(v_m_fob - v_x, 0) AS missing, sum(greatest(v_m_fob - v_x, 0)) OVER (PARTITION BY exporter, product, year) AS total
  FROM fob JOIN short USING (exporter, product, year) WHERE v_x > 0 AND v_m_fob > 0 AND realloc > 0
), shares AS (SELECT *, CASE WHEN total > 0 THEN realloc * missing / total ELSE 0 END AS addition FROM shares0
), kept AS (
  SELECT * FROM shares SEMI JOIN (SELECT exporter, product, year FROM shares GROUP BY ALL HAVING round(sum(abs(ln(v_m_fob / (v_x + addition)))), 12) < round(sum(abs(ln(v_m_fob / v_x))), 12)) USING (exporter, product, year)
), sigma AS (SELECT 'N' || n_nationkey AS country, CAST(0.05 AS DOUBLE) * (n_nationkey % 7) AS se, CAST(0.03 AS DOUBLE) * (n_nationkey % 5) AS si FROM nation WHERE n_nationkey <> 5
), weights AS (
  SELECT f.*, coalesce(a.se, (SELECT median(se) FROM sigma)) AS s1, coalesce(b.si, (SELECT median(si) FROM sigma)) AS s2 FROM fob f LEFT JOIN sigma a ON a.country = exporter LEFT JOIN sigma b ON b.country = importer
), weighted AS (
  SELECT *, CASE WHEN d1 + d2 > 0 THEN d2 / (d1 + d2) ELSE 0.5 END AS ow FROM (SELECT *, exp(s1 * s1) * (exp(s1 * s1) - 1) AS d1, exp(s2 * s2) * (exp(s2 * s2) - 1) AS d2 FROM weights))"""

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def _rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*((F.round(c, places) + 0.0).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def _r(columns: str, places: int = 6) -> str:
    return ", ".join(f'round({c}, {places}) AS {c}' for c in columns.split())


_CELL = 'freq, reporter, product, flow, indicators, "TIME_PERIOD"'


_EACH = _r('"HHI" "CDI2" "CDI3"')


@query("vuln_all", f"WITH {_OBS} SELECT {_CELL}, {_EACH} FROM out")
def vuln_all(spark, sf):
    """All three indicators of every cell."""
    return _rounded(indicators.indicators(cw.observations(spark, sf)))


def _one_indicator(name: str) -> None:
    where = "" if name == "HHI" else f' WHERE flow = 1 AND "{name}" IS NOT NULL'

    @query(f"vuln_{name.lower()}", f'WITH {_OBS} SELECT {_CELL}, round("{name}", 6) AS "{name}" FROM out{where}')
    def run(spark, sf):
        return _rounded(indicators.indicator(cw.observations(spark, sf), name))


for _name in indicators.NAMES:
    _one_indicator(_name)


@query("vuln_hhi_onepass", ORACLES["vuln_hhi"])
def vuln_hhi_onepass(spark, sf):
    """HHI of every cell by one aggregation, without a join."""
    return _rounded(indicators.indicators(cw.observations(spark, sf), ["HHI"]))


@query("vuln_incremental_pairs", f'WITH {_OBS}, stale AS (SELECT reporter, product FROM one GROUP BY ALL HAVING max(t) FILTER (WHERE v < 30000) IS NULL OR max(t) FILTER (WHERE v < 30000) < max(t)) SELECT {_CELL}, {_EACH} FROM out SEMI JOIN stale USING (reporter, product)')
def vuln_incremental(spark, sf):
    """Indicators of the stale (reporter, product) pairs: small trade stands for what was computed, all for downloads."""
    obs = cw.observations(spark, sf)
    last = obs.where(~F.col("partner").isin("WORLD", "EXT_EU")).groupBy("reporter", "product")
    when = last.agg(F.max("TIME_PERIOD").alias("last_download"), F.max(F.when(F.col("OBS_VALUE") < 30000, F.col("TIME_PERIOD"))).alias("last_computed"))
    pairs = relational.stale_pairs(when.drop("last_computed"), when.where("last_computed IS NOT NULL").drop("last_download"), ["reporter", "product"])
    return _rounded(indicators.indicators_of_pairs(obs, pairs))


_K = "exporter, importer, product, year"


def _lines(spark, sf):
    """Order lines as flows, joined and written once."""
    return written(cw.flows(spark, sf), "lines")


def _mirror_of(lines, spark, sf):
    """Mirror flows, written once: all that follows reads them several times."""
    return written(reconcile.mirror(cw.declarations(lines), cw.countries(spark, sf), cw.CONFIG), "mirror")


def _mirror(spark, sf):
    return _mirror_of(_lines(spark, sf), spark, sf)


def _tons_of(flows):
    return reconcile.tonnage(flows, reconcile.conversion_rates(flows, cw.CONFIG), cw.CONFIG)


def _tons(spark, sf):
    return _tons_of(_mirror(spark, sf))


def _design_of(flows, spark, sf):
    tons = written(_tons_of(flows), "tonnes")
    return reconcile.design(tons, reconcile.gravity(*cw.gravity_inputs(spark, sf)), reconcile.unit_values(tons))


def _design(spark, sf):
    return _design_of(_mirror(spark, sf), spark, sf)


def _fob_of(flows, spark, sf):
    return reconcile.fobized(_design_of(flows, spark, sf).withColumn("tau", F.exp(0.002 * F.col("ln_d") + 0.005 * F.col("contig")) - 1), cw.CONFIG)


def _fob(spark, sf):
    return _fob_of(_mirror(spark, sf), spark, sf)


def _sigma(spark, sf):
    n = F.col("n_nationkey")
    return cw.table(spark, sf, "nation").where(n != 5).select(F.concat(F.lit("N"), n.cast("string")).alias("country"), (0.05 * (n % 7)).alias("sigma_export"), (0.03 * (n % 5)).alias("sigma_import"))


def _nes(lines):
    return reconcile.nes_declarations(cw.declarations(lines), cw.CONFIG)


def _fob_and_nes(spark, sf):
    """Flows without freight, written once, and unspecified exports, of the same lines."""
    lines = _lines(spark, sf)
    return written(_fob_of(_mirror_of(lines, spark, sf), spark, sf), "fob"), _nes(lines)


@query("mirror_flows", f"WITH {_DECL} SELECT {_K}, {_r('v_x nw_x q_x v_m nw_m q_m', 7)}, unit_x, unit_m FROM mirror")
def mirror_flows(spark, sf):
    return _rounded(_mirror(spark, sf), 7)


@query("nes_declarations", f"WITH {_DECL} SELECT exporter, product, year, round(sum(value), 7) AS value, count(*) AS n FROM decl WHERE flow = 'X' AND code = 899 GROUP BY ALL")
def nes_declarations(spark, sf):
    return _rounded(_nes(cw.flows(spark, sf)).groupBy(*GROUP).agg(F.sum("value").alias("value"), F.count("*").alias("n")), 7)


@query("dominant_unit", f"WITH {_DECL} SELECT {_K}, unit AS unit_m, round(q, 7) AS q_m FROM sides WHERE flow = 'M'")
def dominant_unit(spark, sf):
    rows = reconcile.declared(cw.declarations(cw.flows(spark, sf))).where("flowCode = 'M'")
    return _rounded(reconcile.side(rows, "m").select(*KEYS, "unit_m", "q_m"), 7)


@query("conversion_rates", f"WITH {_DECL} SELECT product, unit, round(rate, 6) AS rate, round(deviation, 6) AS deviation, n FROM rates")
def conversion_rates(spark, sf):
    return _rounded(reconcile.conversion_rates(_mirror(spark, sf), cw.CONFIG))


@query("tonnage", f"WITH {_DECL} SELECT {_K}, {_r('q_x_t q_m_t', 4)} FROM tons")
def tonnage(spark, sf):
    return _rounded(_tons(spark, sf).select(*KEYS, "q_x_t", "q_m_t"), 4)


@query("world_unit_values", f"WITH {_DECL} SELECT product, round(uv, 4) AS uv FROM uv")
def world_unit_values(spark, sf):
    return _rounded(reconcile.unit_values(_tons(spark, sf)), 4)


@query("gravity_variables", f"WITH {_DECL} SELECT * FROM grav")
def gravity_variables(spark, sf):
    return reconcile.gravity(*cw.gravity_inputs(spark, sf))


@query("gravity_design", f"WITH {_DECL} SELECT {_K}, {_r('y w ln_d ln_d2 contig landlocked_o landlocked_d ln_uv')} FROM sample")
def gravity_design(spark, sf):
    return _rounded(reconcile.freight_sample(_design(spark, sf)).select(*KEYS, "y", "w", *estimation.REGRESSORS))


_GRAM = ["1.0", "ln_d", "ln_d2", "contig", "landlocked_o", "landlocked_d", "ln_uv", "y"]
_PAIRS = [(i, j) for i in range(len(_GRAM)) for j in range(i, len(_GRAM))]


@query("gravity_gram", f"WITH {_DECL} " + " UNION ALL ".join(f"SELECT {i} AS i, {j} AS j, round(sum(w * {_GRAM[i]} * {_GRAM[j]}), 4) AS s FROM sample" for i, j in _PAIRS))
def gravity_gram(spark, sf):
    """The upper triangle of the weighted normal equations."""
    sample = reconcile.freight_sample(_design(spark, sf))
    sums = sample.agg(*(F.round(F.sum(F.expr(f"w * {_GRAM[i]} * {_GRAM[j]}")), 4).alias(f"s{i}_{j}") for i, j in _PAIRS))
    cells = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"s{i}_{j}").alias("s")) for i, j in _PAIRS))
    return sums.select(F.explode(cells).alias("c")).select("c.*")


@query("fobized_fixed_beta", f"WITH {_DECL} SELECT {_K}, {_r('tau v_m_fob', 7)} FROM fob")
def fobized(spark, sf):
    return _rounded(_fob(spark, sf).select(*KEYS, "tau", "v_m_fob"), 7)


@query("reporting_distance", f"WITH {_DECL} SELECT {_K}, round(abs(ln(v_x / v_m_fob)), 6) AS distance, round(ln(v_x + v_m_fob), 6) AS weight FROM fob WHERE v_x > 0 AND v_m_fob > 0 AND ln(v_x + v_m_fob) > 0")
def reporting_distance(spark, sf):
    return _rounded(reconcile.reporting_distance(_fob(spark, sf), "value"))


@query("quality_group_means", f"WITH {_DECL} SELECT product, exporter, round(sum(ln(v_x + v_m_fob)), 4) AS s FROM fob WHERE v_x > 0 AND v_m_fob > 0 AND ln(v_x + v_m_fob) > 0 GROUP BY ALL")
def quality_group_means(spark, sf):
    return _rounded(reconcile.reporting_distance(_fob(spark, sf), "value").groupBy("product", "exporter").agg(F.sum("weight").alias("s")), 4)


@query("optimal_weights", f"WITH {_DECL} SELECT a.country AS exporter, b.country AS importer, round(CASE WHEN x + m > 0 THEN m / (x + m) ELSE 0.5 END, 6) AS weight FROM (SELECT country, exp(se * se) * (exp(se * se) - 1) AS x FROM sigma) a, (SELECT country, exp(si * si) * (exp(si * si) - 1) AS m FROM sigma) b")
def optimal_weights(spark, sf):
    s = _sigma(spark, sf)  # countries by countries
    pairs = s.select(F.col("country").alias("exporter"), "sigma_export").crossJoin(F.broadcast(s.select(F.col("country").alias("importer"), "sigma_import")))
    return _rounded(pairs.select("exporter", "importer", reconcile.optimal_weight(F.col("sigma_export"), F.col("sigma_import")).alias("weight")))


def _reconciled(spark, sf):
    s = _sigma(spark, sf)
    return reconcile.reconciled(_fob(spark, sf), {"value": s, "quantity": s})


_BOTH = "CASE WHEN {a} > 0 AND {b} > 0 THEN ow * {a} + (1 - ow) * {b} WHEN {a} > 0 THEN {a} WHEN {b} > 0 THEN {b} END"


@query("reconciled_fixed_sigma", f"WITH {_DECL} SELECT {_K}, round({_BOTH.format(a='v_x', b='v_m_fob')}, 7) AS reconciled_value, round({_BOTH.format(a='q_x_t', b='q_m_t')}, 7) AS reconciled_quantity FROM weighted")
def reconciled_fixed_sigma(spark, sf):
    return _rounded(_reconciled(spark, sf).select(*reconcile.columns_of_result()), 7)


@query("nes_shortfall", f"WITH {_DECL} SELECT exporter, product, year, {_r('v_nes shortfall realloc', 7)} FROM short")
def nes_shortfall(spark, sf):
    return _rounded(reconcile.nes_shortfall(*_fob_and_nes(spark, sf)).select(*GROUP, "v_nes", "shortfall", "realloc"), 7)


def _shares(spark, sf):
    flows, nes = _fob_and_nes(spark, sf)
    short = written(reconcile.nes_shortfall(flows, nes), "shortfall")
    return flows, short, reconcile.nes_shares(flows, short)


@query("nes_shares", f"WITH {_DECL} SELECT {_K}, {_r('missing total addition', 7)} FROM shares")
def nes_shares(spark, sf):
    return _rounded(_shares(spark, sf)[2].select(*KEYS, "missing", "total", "addition"), 7)


@query("nes_safeguard", f"WITH {_DECL} SELECT {_K}, round(addition, 7) AS addition FROM kept")
def nes_safeguard(spark, sf):
    return _rounded(reconcile.nes_safeguard(_shares(spark, sf)[2]).select(*KEYS, "addition"), 7)


@query("nes_residual", f"WITH {_DECL} SELECT exporter, product, year, round(v_nes - coalesce(a, 0), 7) + 0.0 AS residual, round(coalesce(o, 0), 7) AS import_only FROM short LEFT JOIN (SELECT exporter, product, year, sum(addition) AS a FROM kept GROUP BY ALL) USING (exporter, product, year) LEFT JOIN (SELECT exporter, product, year, sum(v_m_fob) AS o FROM fob WHERE coalesce(v_x, 0) <= 0 AND v_m_fob > 0 GROUP BY ALL) USING (exporter, product, year)")
def nes_residual(spark, sf):
    flows, short, shares = _shares(spark, sf)
    return _rounded(reconcile.nes_residual(flows, short, reconcile.nes_safeguard(shares)), 7)


def _fitted_of(flows, spark, sf):
    rows = written(_design_of(flows, spark, sf), "design")  # read by five passes of the fit
    return estimation.fit_freight(reconcile.freight_sample(rows)).predict(rows)


@query("freight_rates")
def freight_rates(spark, sf):
    """Fitted freight rates of all flows."""
    return _fitted_of(_mirror(spark, sf), spark, sf).select(*KEYS, "tau")


@query("baci_mirror_two_step")
def two_step(spark, sf):
    """Mirror flows in tonnes with their freight rates, before reconciliation."""
    return _fitted_of(_mirror(spark, sf), spark, sf).select(*KEYS, "v_x", "v_m", "q_x_t", "q_m_t", "tau")


@query("baci_full")
def baci_full(spark, sf):
    """All six steps: mirror, tonnes, freight, quality, reconciliation, unspecified partners."""
    return runs.reconciliation(cw.declarations(_lines(spark, sf)), cw.countries(spark, sf), *cw.gravity_inputs(spark, sf), cw.CONFIG)[0]


@query("duplicate_lines", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_lines(spark, sf):
    return relational.duplicates(cw.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dedupe_sum_lines", "SELECT l_orderkey, l_linenumber, round(sum(l_quantity), 2) AS l_quantity, round(sum(l_extendedprice), 2) AS l_extendedprice FROM lineitem GROUP BY ALL")
def dedupe_sum_lines(spark, sf):
    return _rounded(relational.sum_duplicates(cw.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_extendedprice"]), 2)


@query("code_filter", "SELECT DISTINCT p_brand FROM part WHERE regexp_full_match(p_brand, 'Brand#[1-4][0-9]*') AND NOT regexp_full_match(p_brand, '.*3') AND p_brand NOT IN ('Brand#12')")
def code_filter(spark, sf):
    return relational.filter_codes(cw.table(spark, sf, "part"), "p_brand", exclude=["Brand#12"], include_regex="Brand#[1-4][0-9]*", exclude_regex=".*3")


@query("split_grid", "SELECT DISTINCT 'N' || n_nationkey AS reporter, p_brand AS product FROM nation, (SELECT DISTINCT p_brand FROM part)")
def split_grid(spark, sf):
    """Reporters by products: two lists of codes."""
    return cw.countries(spark, sf).select(F.col("iso").alias("reporter")).crossJoin(cw.table(spark, sf, "part").select(F.col("p_brand").alias("product")).distinct())


@query("product_batches", "SELECT CAST((rn - 1) // 10 AS BIGINT) AS batch, string_agg(p_brand, ',' ORDER BY p_brand) AS codes FROM (SELECT p_brand, row_number() OVER (ORDER BY p_brand) AS rn FROM (SELECT DISTINCT p_brand FROM part)) GROUP BY 1")
def product_batches(spark, sf):
    return relational.batches(cw.table(spark, sf, "part").select("p_brand").distinct(), "p_brand", 10)


@query("last_n_per_series", f'WITH {_OBS} SELECT reporter, product, partner, flow, t AS "TIME_PERIOD", round(v, 7) AS "OBS_VALUE" FROM one QUALIFY row_number() OVER (PARTITION BY reporter, product, partner, flow ORDER BY t DESC) <= 2')
def last_n_per_series(spark, sf):
    obs = cw.observations(spark, sf).where(~F.col("partner").isin("WORLD", "EXT_EU")).select("reporter", "product", "partner", "flow", "TIME_PERIOD", "OBS_VALUE")
    return _rounded(relational.last_n(obs, ["reporter", "product", "partner", "flow"], "TIME_PERIOD", 2), 7)


@query("flow_overview", f"WITH {_OBS} SELECT flow, count(*) + 0 AS n, count(DISTINCT partner) AS partners FROM one GROUP BY flow")
def flow_overview(spark, sf):
    return indicators.overview(cw.observations(spark, sf))


@query("top_cells", f'WITH {_OBS} SELECT reporter, product, flow, "TIME_PERIOD", round("HHI", 6) AS "HHI" FROM out ORDER BY round("HHI", 6) DESC, reporter, product, flow, "TIME_PERIOD" LIMIT 10')
def top_cells(spark, sf):
    cells = _rounded(indicators.indicator(cw.observations(spark, sf), "HHI")).select("reporter", "product", "flow", "TIME_PERIOD", "HHI")
    return cells.orderBy(F.desc("HHI"), "reporter", "product", "flow", "TIME_PERIOD").limit(10)


@query("period_range", "SELECT strftime(d, '%Y%m') AS period FROM (SELECT unnest(generate_series(DATE '1994-01-01', DATE '1998-12-01', INTERVAL 1 MONTH)) AS d)")
def period_range(spark, sf):
    return spark.createDataFrame([(p,) for p in planning.periods(date(1994, 1, 1), date(1998, 12, 31), "M")], "period string")


@query("period_intersection", f"WITH {_J} SELECT DISTINCT CAST(year AS VARCHAR) AS period FROM j WHERE year BETWEEN 1996 AND 2010")
def period_intersection(spark, sf):
    years = spark.range(1996, 2011).select(F.col("id").cast("string").alias("period"))
    return cw.flows(spark, sf).select(F.col("year").cast("string").alias("period")).intersect(years)


@query("union_subresults", "SELECT o_orderkey AS k, o_totalprice AS total, NULL::INTEGER AS nation FROM orders UNION ALL SELECT c_custkey, NULL, c_nationkey FROM customer")
def union_subresults(spark, sf):
    a = cw.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("total"))
    b = cw.table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("nation"))
    return a.unionByName(b, allowMissingColumns=True)


_YEARS = [str(y) for y in range(1995, 2002)]
_TOTALS = "totals AS (SELECT c_nationkey AS nk, CAST(year(o_orderdate) AS INTEGER) AS y, round(sum(o_totalprice), 2) AS v, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) BETWEEN 1995 AND 2001 GROUP BY ALL)"


def _totals(spark: SparkSession, sf: str) -> DataFrame:
    """Order totals by nation and year: ``nk, y, v, n``."""
    orders, customers = (cw.table(spark, sf, t) for t in ("orders", "customer"))
    rows = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).withColumn("y", F.year("o_orderdate")).where(F.col("y").between(1995, 2001))
    return rows.groupBy(F.col("c_nationkey").alias("nk"), "y").agg(F.round(F.sum("o_totalprice"), 2).alias("v"), F.count("*").alias("n"))


@query("tsv_unpivot", f"WITH {_TOTALS} SELECT 'A' AS freq, 'N' || n_nationkey AS geo, CAST(t AS VARCHAR) AS \"TIME_PERIOD\", CASE WHEN n_nationkey % 5 <> 0 THEN v END AS \"value\" FROM nation CROSS JOIN range(1995, 2002) r(t) LEFT JOIN totals ON nk = n_nationkey AND y = t WHERE n_nationkey IN (SELECT nk FROM totals)")
def tsv_unpivot(spark, sf):
    """A wide table with flagged and missing cells to rows."""
    wide = _totals(spark, sf).groupBy("nk").pivot("y", list(map(int, _YEARS))).agg(F.first("v"))
    cells = [F.concat(F.coalesce(F.col(y).cast("decimal(20,2)").cast("string"), F.lit(":")), F.when(F.col("nk") % 5 == 0, " p").otherwise(" ")).alias(f"{y} ") for y in _YEARS]
    return parsers.tsv_to_rows(wide.select(F.concat(F.lit("A,N"), "nk").alias("freq,geo\\TIME_PERIOD"), *cells), ["freq", "geo"])


def _inline(kind: str, body: str) -> Request:
    """A request whose URL holds its response, so that it needs no network."""
    return whole_url(f"data:{kind},{quote(body, safe='')}")


@query("landed_csv", f"WITH {_TOTALS} SELECT 'N' || nk AS geo, CAST(y AS VARCHAR) AS \"TIME_PERIOD\", v AS \"OBS_VALUE\" FROM totals")
def landed_csv(spark, sf):
    """CSV responses, one for each nation, landed by the data source in lanes, then parsed and typed."""
    held = _totals(spark, sf).groupBy("nk").agg(F.array_join(F.collect_list(F.concat_ws(",", F.concat(F.lit("N"), "nk"), "y", "v")), "\n").alias("lines"))
    wanted = [_inline("text/csv", "geo,TIME_PERIOD,OBS_VALUE\n" + r["lines"]) for r in held.collect()]  # a request for each nation
    landed = responses.land(spark, wanted, f"{shared_dir(spark)}/landed-{uuid.uuid4().hex}", lanes=4, quota={"requests": 1000, "unit": "seconds"})
    return responses.csv_rows(landed, ["geo", "TIME_PERIOD", "OBS_VALUE"]).withColumn("OBS_VALUE", number(F.col("OBS_VALUE")))


@query("landed_declarations", f"WITH {_TOTALS} SELECT 'N' || nk AS \"reporterISO\", sum(n) AS n, round(sum(v), 2) AS \"primaryValue\" FROM totals GROUP BY ALL")
def landed_declarations(spark, sf):
    """JSON responses of tariff lines, landed, exploded and summed by reporter."""
    line = F.struct(F.concat(F.lit("N"), "nk").alias("reporterISO"), F.col("n"), F.col("v").alias("primaryValue"))
    held = _totals(spark, sf).groupBy("nk").agg(F.to_json(F.struct(F.collect_list(line).alias("data"))).alias("body"))
    landed = responses.land(spark, [_inline("application/json", r["body"]) for r in held.collect()], f"{shared_dir(spark)}/landed-{uuid.uuid4().hex}", lanes=4)
    rows = relational.sum_duplicates(responses.declaration_rows(landed, "reporterISO string, n long, primaryValue double"), ["reporterISO"], ["n", "primaryValue"])
    return _rounded(rows, 2)


@query("jsonstat_decode", f"WITH {_TOTALS} SELECT 'N' || nk AS geo, CAST(y AS VARCHAR) AS time, n::DOUBLE AS \"value\" FROM totals")
def jsonstat_decode(spark, sf):
    """A payload for each nation, with cells numbered over nations and years, to rows."""
    header = json.dumps({"id": ["geo", "time"], "size": [25, len(_YEARS)], "dimension": {"geo": {"category": {"index": [f"N{k}" for k in range(25)]}}, "time": {"category": {"index": {y: k for k, y in enumerate(_YEARS)}}}}})
    cell = F.struct((F.col("nk") * len(_YEARS) + F.col("y") - int(_YEARS[0])).cast("string"), F.col("n").cast("double"))
    payloads = _totals(spark, sf).groupBy("nk").agg(F.to_json(F.map_from_entries(F.collect_list(cell))).alias("value"))
    payloads = payloads.select(F.concat(F.lit(header[:-1] + ', "value": '), "value", F.lit("}")).alias("payload"))
    return parsers.jsonstat_to_rows(payloads, "payload", ["geo", "time"])


@query("sdmxjson_decode", f"WITH {_TOTALS} SELECT 'N' || nk AS geo, CAST(y AS VARCHAR) AS time, v AS \"value\" FROM totals")
def sdmxjson_decode(spark, sf):
    """A payload for each nation, with keys of positions, to rows."""
    cell = F.struct(F.concat_ws(":", "nk", F.col("y") - int(_YEARS[0])), F.array("v", F.lit(0.0)))
    held = _totals(spark, sf).groupBy("nk").agg(F.map_from_entries(F.collect_list(cell)).alias("observations"))
    payloads = held.select(F.to_json(F.struct(F.array(F.struct("observations")).alias("dataSets"))).alias("payload"))
    return parsers.sdmxjson_to_rows(payloads, "payload", [("geo", [f"N{k}" for k in range(25)]), ("time", _YEARS)])


@query("identity_keys", "SELECT p_size, 'TPC::part::*::brand=' || string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) || ';size=' || p_size AS identity FROM part GROUP BY p_size")
def identity_keys(spark, sf):
    """One text for the request of each size's brands."""
    rows = cw.table(spark, sf, "part").groupBy("p_size").agg(F.collect_set("p_brand").alias("brands")).collect()  # a code list for each size
    keys = [(r["p_size"], planning.identity_key("TPC", "part", params={"size": r["p_size"], "brand": r["brands"], "none": None})) for r in rows]
    return spark.createDataFrame(keys, "p_size int, identity string")


def _seen(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Last events of each user and type, and the last of those with a low value, as downloads and computations."""
    events = cw.table(spark, sf, "events")
    keys = ["user_id", "event_type"]
    return events.groupBy(*keys).agg(F.max("ts").alias("last_download")), events.where("value < 50").groupBy(*keys).agg(F.max("ts").alias("last_computed"))


@query("stale_pairs", "SELECT user_id, event_type FROM events GROUP BY ALL HAVING max(ts) FILTER (WHERE value < 50) IS NULL OR max(ts) FILTER (WHERE value < 50) < max(ts)")
def stale_pairs(spark, sf):
    """Pairs never computed or computed before their last download."""
    return relational.stale_pairs(*_seen(spark, sf), ["user_id", "event_type"])


@query("query_priority", "SELECT user_id, max(ts) FILTER (WHERE event_type = 'purchase' AND value < 50) AS last FROM events GROUP BY user_id ORDER BY last NULLS FIRST, user_id LIMIT 20")
def query_priority(spark, sf):
    """The next twenty of a run: never done first, then the oldest."""
    last = F.max(F.when((F.col("event_type") == "purchase") & (F.col("value") < 50), F.col("ts"))).alias("last")
    return cw.table(spark, sf, "events").groupBy("user_id").agg(last).orderBy(F.asc_nulls_first("last"), "user_id").limit(20)


_LATEST = "SELECT user_id, event_type, event_id, round(value, 6) AS value FROM events {} QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"


def _upserted(spark: SparkSession, sf: str) -> Lake:
    """A lake with two versions of the latest event of each user and type: of early events, then of all."""
    lake, keys = Lake(spark, f"{shared_dir(spark)}/lake-{uuid.uuid4().hex}"), ["user_id", "event_type"]
    events = cw.table(spark, sf, "events").select(*keys, "event_id", "ts", F.round("value", 6).alias("value"))
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    for part in (events.where(early), events.where(~early)):
        lake.upsert("latest", relational.first_per_key(part, keys, [F.desc("ts"), F.desc("event_id")]), keys)
    return lake


@query("upsert_latest", _LATEST.format(""))
def upsert_latest(spark, sf):
    """Two upserts leave the latest row of each key."""
    return _upserted(spark, sf).read("latest").drop("ts")


@query("time_travel_read", _LATEST.format("WHERE ts < TIMESTAMP '2024-01-16'"))
def time_travel_read(spark, sf):
    """The first version, after a second was written."""
    return _upserted(spark, sf).read("latest", version=1).drop("ts")
