import math
from datetime import UTC, datetime

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tradewinds.operators import estimation, indicators, reconcile, relational
from tradewinds.plans import catalog, runs
from tradewinds.plans import crosswalk as cw
from tradewinds.sources import external
from tradewinds.sources.lake import Lake

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def rows_of(frame, places=6):
    columns = sorted(frame.columns)

    def cell(v):
        if pd.isna(v):
            return ""
        return str(round(float(v), places)) if isinstance(v, (int, float, np.number)) else str(v)

    return sorted(tuple(cell(v) for v in r) for r in frame[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF).toPandas()
    want = duck.sql(catalog.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = rows_of(got, 5), rows_of(want, 5)
    assert len(a) == len(b)
    near = lambda x, y: x == y or abs(float(x) - float(y)) <= 2e-5 * max(1.0, abs(float(y)))  # noqa: E731  a rounding tie
    assert all(near(u, v) for x, y in zip(a, b, strict=True) for u, v in zip(x, y, strict=True))


def test_hhi_of_known_shares(spark):
    key = ("A", "FR", "01", 1, "V", "2020")
    rows = [(*key, "US", 60.0), (*key, "CN", 40.0), (*key, "WORLD", 100.0), (*key, "X_Y", 5.0)]
    data = spark.createDataFrame(rows, "freq string, reporter string, product string, flow int, indicators string, TIME_PERIOD string, partner string, OBS_VALUE double")
    out = indicators.indicators(data).collect()
    assert len(out) == 1 and out[0]["HHI"] == pytest.approx(0.52) and out[0]["CDI2"] is None
    with pytest.raises(ValueError, match="OBS_VALUE"):
        indicators.indicators(data.drop("OBS_VALUE"))
    own = indicators.indicators(data, ["HHI", "total"], more={"total": F.col("_total")}).first()
    assert own["total"] == 100.0 and own["HHI"] == pytest.approx(0.52)
    with pytest.raises(ValueError, match="unknown indicators"):
        indicators.indicators(data, ["nope"])


def test_duplicate_policies(spark):
    df = spark.createDataFrame([(1, 2), (1, 3)], "k int, v int")
    with pytest.raises(ValueError):
        relational.check_duplicates(df, ["k"])
    with pytest.warns(UserWarning):
        relational.check_duplicates(df, ["k"], "warn")
    assert relational.check_duplicates(df, ["k"], "ignore").count() == 2


def test_code_filter_matches_whole_codes(spark):
    codes = spark.createDataFrame([("27",), ("2710",), ("271012",), ("28",), ("27\n",), (None,)], "c string")
    assert [r[0] for r in relational.filter_codes(codes, "c", include_regex="27[0-9]*").collect()] == ["27", "2710", "271012"]


def test_freight_fit_equals_dense_least_squares(spark):
    sample = reconcile.freight_sample(catalog._design(spark, SF)).cache()
    model = estimation.fit_freight(sample)
    f = sample.toPandas()
    years = sorted(f.year.unique())

    def design(g):
        return np.column_stack([np.ones(len(g)), g.ln_d - model.centre, (g.ln_d - model.centre) ** 2, *(g[c] for c in estimation.REGRESSORS[2:]), *((g.year == y).astype(float) for y in years[1:])])

    def solve(g):
        s = np.sqrt(g.w.to_numpy())
        return np.linalg.lstsq(design(g) * s[:, None], g.y * s, rcond=None)[0]

    beta = solve(f)
    x, w = design(f), f.w.to_numpy()
    inverse = np.linalg.pinv((x * w[:, None]).T @ x)
    rank = np.linalg.matrix_rank(x)
    h = np.einsum("ij,jk,ik->i", x, inverse, x) * w
    e2 = (f.y.to_numpy() - x @ beta) ** 2 * w
    cook = e2 / (rank * e2.sum() / (len(f) - rank)) * h / (1 - h) ** 2
    kept = f[cook < 4 / len(f)]
    assert model.dropped == len(f) - len(kept)
    assert np.allclose(design(f) @ model.beta, design(f) @ solve(kept), atol=1e-6)


def test_quality_fit_equals_dense_dummies(spark):
    rows = reconcile.reporting_distance(catalog._fob(spark, SF), "value").cache()
    got = estimation.fit_quality(rows, robust=False).set_index("country")
    f = rows.toPandas()
    ex, im, yr, pr = (sorted(f[c].unique()) for c in ("exporter", "importer", "year", "product"))
    x = np.column_stack([*((f.exporter == v).astype(float) for v in ex[1:]), *((f.importer == v).astype(float) for v in im[1:]), *((f.year == v).astype(float) for v in yr[1:]), *((f["product"] == v).astype(float) for v in pr)])
    s = np.sqrt(f.weight.to_numpy())
    beta = np.linalg.lstsq(x * s[:, None], f.distance * s, rcond=None)[0]
    inverse = np.linalg.pinv((x * s[:, None]).T @ (x * s[:, None]))
    cov = inverse * (((f.distance - x @ beta) * s) ** 2).sum() / (len(f) - x.shape[1])
    m = len(ex)
    pick = np.zeros((m, x.shape[1]))
    pick[np.arange(1, m), np.arange(m - 1)] = 1
    contrast = pick - pick.mean(0)
    mean, error = contrast @ beta, np.sqrt(np.einsum("ij,jk,ik->i", contrast, cov, contrast))
    want = np.maximum(math.pi / 2 * (mean - mean.min() - 2 * error), 0)
    assert np.allclose(got.sigma_export.reindex(ex), want, atol=1e-6)


def test_robust_quality_fit_equals_dense_clusters(spark):
    rows = reconcile.reporting_distance(catalog._fob(spark, SF), "value").cache()
    got = estimation.fit_quality(rows).set_index("country")
    f = rows.toPandas()
    ex, im, yr = (sorted(f[c].unique()) for c in ("exporter", "importer", "year"))
    x = np.column_stack([*((f.exporter == v).astype(float) for v in ex[1:]), *((f.importer == v).astype(float) for v in im[1:]), *((f.year == v).astype(float) for v in yr[1:])])
    w, y, of = f.weight.to_numpy(), f.distance.to_numpy().copy(), f["product"].to_numpy()
    for p in set(of):
        k = of == p
        x[k] -= w[k] @ x[k] / w[k].sum()
        y[k] -= w[k] @ y[k] / w[k].sum()
    inverse = np.linalg.pinv((x * w[:, None]).T @ x)
    beta = inverse @ (x * w[:, None]).T @ y
    cov = inverse @ (x * ((w * (y - x @ beta)) ** 2)[:, None]).T @ x @ inverse
    m = len(im)
    pick = np.zeros((m, x.shape[1]))
    pick[np.arange(1, m), len(ex) - 1 + np.arange(m - 1)] = 1
    contrast = pick - pick.mean(0)
    mean, error = contrast @ beta, np.sqrt(np.einsum("ij,jk,ik->i", contrast, cov, contrast))
    want = np.maximum(math.pi / 2 * (mean - mean.min() - 2 * error), 0)
    assert np.allclose(got.sigma_import.reindex(im), want, atol=1e-6)


def test_mirror_tables_read_the_lines_once(spark):
    plan = catalog.QUERIES["nes_residual"](spark, SF)._jdf.queryExecution().toString()
    assert "lineitem" not in plan  # what the plan reads is written already


def test_runs_over_a_lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    key = ("A", "FR", "01", 1, "V", "2020")
    kind = "freq string, reporter string, product string, flow int, indicators string, TIME_PERIOD string, partner string, OBS_VALUE double"
    obs = spark.createDataFrame([(*key, "US", 60.0), (*key, "CN", 40.0), (*key, "WORLD", 100.0), (*key, "EXT_EU", 100.0), ("A", "DE", "01", 1, "V", "2020", "WORLD", 0.0)], kind)
    lake.upsert("s/obs", obs, obs.columns[:-1])
    report = runs.all_indicators(lake, "s/obs", "out")
    assert report == runs.IndicatorReport(2, {"HHI": 1, "CDI2": 1, "CDI3": 0}, True)
    t0 = datetime(2024, 1, 1, tzinfo=UTC)
    lake.upsert("seen", spark.createDataFrame([("FR", "01", t0), ("DE", "01", t0)], "reporter string, product string, last_download timestamp"), ["reporter", "product"])
    lake.upsert("log", spark.createDataFrame([("DE", "01", t0)], "reporter string, product string, last_computed timestamp"), ["reporter", "product"])
    other = Lake(spark, str(tmp_path / "other"))
    assert runs.stale_indicators(lake, "s/obs", "out", "seen", "log").cells == 1
    assert runs.stale_indicators(lake, "s/obs", "out", "seen", "log") is None
    assert runs.stale_indicators(lake, "s/obs", "out", "seen", "log", into=other).created and other.read("out").count() == 2
    rates = spark.createDataFrame([(0.1,), (-0.1,), (None,), (float("nan"),)], "tau double")
    assert runs.mean_freight(rates) == (pytest.approx(0.0), pytest.approx(0.05))


def test_reconciliation_run_reports(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    report = runs.reconcile_into(lake, "baci", cw.declarations(cw.flows(spark, SF)), cw.countries(spark, SF), *cw.gravity_inputs(spark, SF), cw.CONFIG)
    assert report.created and report.flows == lake.read("baci").count() > 0 and report.mean_freight <= report.mean_freight_floored


def test_external_settings(spark, tmp_path):
    assert external.object_store({"aws_access_key_id": "a", "aws_secret_access_key": "b"}, {"AWS_REGION": "x"}) == {"spark.hadoop.fs.s3a.connection.ssl.enabled": "true", "spark.hadoop.fs.s3a.endpoint.region": "x", "spark.hadoop.fs.s3a.access.key": "a", "spark.hadoop.fs.s3a.secret.key": "b"}
    options = external.database("db", "trade", "me", env={"PGPASSWORD": "p"})
    assert options["url"] == "jdbc:postgresql://db:5432/trade" and options["password"] == "p"
    assert external.catalog_settings(options, "w")["spark.hadoop.javax.jdo.option.ConnectionUserName"] == "me"
    assert external.create_database('a"b', "o") == 'CREATE DATABASE "a""b" OWNER "o"'
    for call in (lambda: external.database("db", "x;y"), lambda: external.read_sheet(spark, "a.csv")):
        with pytest.raises(ValueError):
            call()
    for call in (lambda: external.read_sheet(spark, "a.xls"), lambda: external.write_sheet(spark.range(1), tmp_path / "a.xlsx")):
        with pytest.raises(RuntimeError, match="needs"):
            call()


def test_filters_warn_of_what_is_absent(spark):
    codes = spark.createDataFrame([("27",)], "c string")
    with pytest.warns(UserWarning, match="99"):
        assert relational.filter_codes(codes, "c", include=["27", "99"]).count() == 1
    with pytest.warns(UserWarning, match="nope"):
        assert relational.post_filter(codes, {"nope": ["1"], "c": ["27"]}).count() == 1


def test_full_reconciliation_equals_plain_steps(spark):
    declared = cw.declarations(cw.flows(spark, SF))
    out, fob = runs.reconciliation(declared, cw.countries(spark, SF), *cw.gravity_inputs(spark, SF), cw.CONFIG)
    f, got = fob.toPandas(), out.toPandas()
    assert not got.duplicated(list(reconcile.KEYS)).any()
    model = estimation.fit_freight(reconcile.freight_sample(fob))
    d = f.ln_d - model.centre
    x = np.column_stack([np.ones(len(f)), d, d**2, *(f[c] for c in estimation.REGRESSORS[2:]), *((f.year == y).astype(float) for y in model.years[1:])])
    assert np.allclose(f.tau, np.expm1(x @ model.beta), equal_nan=True)
    cif = np.where(f.importer.isin(cw.CONFIG.non_cif) | f.tau.isna(), f.v_m, f.v_m / (1 + f.tau))
    plain = ~f.importer.isin(cw.CONFIG.fas)
    assert np.allclose(f.v_m_fob[plain], np.maximum(cif, 0)[plain], equal_nan=True)

    spread = lambda s: np.exp(s * s) * (np.exp(s * s) - 1)
    for target, a, b in (("value", "v_x", "v_m_fob"), ("quantity", "q_x_t", "q_m_t")):
        sigma = estimation.fit_quality(reconcile.reporting_distance(fob, target)).set_index("country")
        i, j = (spread(f[end].map(sigma[c]).fillna(sigma[c].median()).to_numpy(float)) for end, c in (("exporter", "sigma_export"), ("importer", "sigma_import")))
        w = np.divide(j, i + j, out=np.full(len(f), 0.5), where=i + j > 0)
        f[f"want_{target}"] = np.where((f[a] > 0) & (f[b] > 0), w * f[a] + (1 - w) * f[b], np.where(f[a] > 0, f[a], np.where(f[b] > 0, f[b], np.nan)))
    nes = reconcile.nes_declarations(declared, cw.CONFIG).toPandas().groupby(list(reconcile.GROUP)).value.sum()
    f["addition"], moved = 0.0, 0
    for key, g in f[(f.v_x > 0) & (f.v_m_fob > 0)].groupby(list(reconcile.GROUP)):
        given = min(nes.get(key, 0.0), max(g.v_m_fob.sum() - g.v_x.sum(), 0.0))
        missing = np.maximum(g.v_m_fob - g.v_x, 0)
        if given > 0 and missing.sum() > 0:
            more = given * missing / missing.sum()
            if round(np.abs(np.log(g.v_m_fob / (g.v_x + more))).sum(), 12) < round(np.abs(np.log(g.v_m_fob / g.v_x)).sum(), 12):
                f.loc[g.index, "addition"], moved = more, moved + 1
    f["want_value"] += f.addition
    both = got.merge(f[f.want_value.notna()], on=list(reconcile.KEYS), how="outer", indicator=True)
    assert moved and (both._merge == "both").all()
    assert np.allclose(both.reconciled_value, both.want_value, rtol=1e-6) and np.allclose(both.reconciled_quantity, both.want_quantity, rtol=1e-6, equal_nan=True)


def test_reallocation_adds_no_more_than_was_unspecified(spark):
    flows, short, shares = catalog._shares(spark, SF)
    added = reconcile.nes_safeguard(shares).agg({"addition": "sum"}).first()[0] or 0.0
    assert added <= short.agg({"v_nes": "sum"}).first()[0] + 1e-6


def test_null_partner_codes_stay(spark):
    rows = [("X", "N1", "N2", None, "p", "2000", 1.0, 1.0, 8, None)]
    d = spark.createDataFrame(rows, "flowCode string, reporterISO string, partnerISO string, partnerCode int, cmdCode string, period string, primaryValue double, qty double, qtyUnitCode int, netWgt double")
    c = spark.createDataFrame([("N1",), ("N2",)], "iso string")
    assert reconcile.mirror(d, c, reconcile.ReconcileConfig()).count() == 1
    assert cw.CONFIG.excluded_pairs == (("N1", "N2"),)
