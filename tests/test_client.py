"""Queries from end to end against the stand-in service."""

from datetime import UTC, datetime

import pytest

from tradewinds.sources import client as cl
from tradewinds.sources.control import Instants, write_json
from tradewinds.sources.lake import Lake
from tradewinds.streaming import sync

FAKE = {"transport": "tests.fake_service:get", "lanes": 2}
LATER, EARLIER = datetime(2030, 1, 1, tzinfo=UTC), datetime(2000, 1, 1, tzinfo=UTC)


def test_estat_from_structure_to_rows(spark, tmp_path):
    known = str(tmp_path / "structures.json")
    estat = cl.client("estat", spark, str(tmp_path), structures=known, **FAKE)
    query = cl.Query("estat", "gdp", "ESTAT", wanted={"geo": ["FR", "DE"]}, split_by=["geo"], duplicates="ignore")
    rows = estat.execute(query)
    assert rows.columns == ["freq", "geo", "TIME_PERIOD", "OBS_VALUE"]
    assert sorted((r.geo, r.OBS_VALUE) for r in rows.collect() if r.OBS_VALUE) == [("DE", 1.5), ("FR", 1.5)]
    assert estat.primary_key(query) == ["freq", "geo", "TIME_PERIOD"]
    with pytest.raises(ValueError, match="repeat the key"):
        estat.execute(cl.Query.of({**query.plain(), "duplicates": "raise", "nothing": 1}))
    assert cl.client("estat", spark, str(tmp_path), structures=known, transport="tests.fake_service:gone").resolve(query).names == ["freq", "geo"]
    with pytest.warns(UserWarning, match="older interface"):
        assert estat.resolve(cl.Query("estat", "old", "ESTAT")).names == ["freq", "geo"]
    assert estat.dataflows()[0]["id"] == "gdp" and estat.codes("GEO") == [{"code": "FR", "name": "France"}]
    assert estat.last_update(query) == datetime(2024, 5, 1, tzinfo=UTC)
    updates = estat.updates(query)
    assert updates(LATER) is None and updates(EARLIER).count() == updates(None).count() == 4


def test_oecd_filters_what_a_key_cannot_say(spark, tmp_path):
    oecd = cl.client("oecd", spark, str(tmp_path), **FAKE)
    query = cl.Query("oecd", "flow", "OECD", wanted={"geo": ["FR", "DE"]}, split_by=["geo"], duplicates="ignore")
    assert {r.geo for r in oecd.execute(query).collect()} == {"FR", "DE"}
    assert oecd.updates(query)(EARLIER).count() == 4


def test_declarations_with_metadata_and_releases(spark, tmp_path):
    limits = tmp_path / "limits.json"
    write_json(limits, {"RATE_LIMIT": [{"requests": 1000, "unit": "seconds"}]})
    service = cl.client("declarations", spark, str(tmp_path), limits=limits, **FAKE)
    assert service.quota == [{"requests": 1000, "unit": "seconds"}]
    query = cl.Query("declarations", "HS", wanted={"products": list("abcde")}, options={"limit": 3, "start": "2020-01-01", "end": "2021-01-01"})
    rows, asked = service.get(query)
    assert rows.count() == 10 and asked["period"] == "2020,2021" and asked["flowCode"] == "M,X"
    assert service.execute(query).select("flowCode", "cmdCode").distinct().count() == 10
    assert {r.category for r in service.metadata().collect()} == {"reporter", "flow"}
    assert [r.text for r in service.metadata("flow").orderBy("id").collect()] == ["Import", "Export"]
    assert [r.code for r in service.codes("reporter").collect()] == ["4"] and service.codes("flow").count() == 2
    with pytest.raises(ValueError, match="unknown category"):
        service.metadata("nope")
    assert {r.period: r.lastReleased for r in service.availability(query).collect()} == {"2020": "2021-07-01", "2021": "2022-05-01"}
    updates = service.updates(query)
    assert updates(LATER) is None and updates(datetime(2022, 1, 1, tzinfo=UTC)).count() == 10


def test_a_run_from_queries(spark, tmp_path):
    said = [{"dataflow": "gdp", "agency": "ESTAT", "wanted": {"geo": ["FR"]}, "split_by": ["geo"], "duplicates": "ignore"}] * 2
    (query,) = cl.queries("estat", said)
    estat, lake = cl.client("estat", spark, str(tmp_path), **FAKE), Lake(spark, str(tmp_path / "lake"))
    job = sync.Job(query.key, "gdp", ("geo", "freq", "TIME_PERIOD"), lambda since: (news := estat.updates(query)(since)) and news.where("OBS_VALUE IS NOT NULL").fillna("-"))
    registry = Instants(tmp_path / "r.json")
    assert sync.run([job], lake, registry, now=lambda: LATER).written == {query.key: 1}
    assert sync.run([job], lake, registry).empty == [query.key] and lake.read("gdp").count() == 1
    for call in (lambda: cl.client("nope", spark, "x"), lambda: cl.queries("nope", [])):
        with pytest.raises(ValueError, match="unknown source"):
            call()


def test_upserts_write_touched_buckets_only(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    rows = spark.range(200).selectExpr("id AS k", "id * 2 AS v")
    assert lake.upsert("t", rows, ["k"], buckets=8) == 1
    news = spark.createDataFrame([(5, -1, "new"), (900, -2, "new")], "k long, v long, w string")
    assert lake.upsert("t", news, ["k"]) == 2
    first, second = (v["folders"] for v in lake.versions("t"))
    assert len(first) == 8 and 1 <= sum(first[b] != second[b] for b in first) <= 2
    held = {r.k: (r.v, r.w) for r in lake.read("t").collect()}
    assert len(held) == 201 and held[5] == (-1, "new") and held[900] == (-2, "new") and held[7] == (14, None)
    assert lake.read("t", version=1).count() == 200
    with pytest.raises(ValueError, match="repeat"):
        lake.upsert("t", news.unionByName(news), ["k"])
    with pytest.raises(ValueError, match="null"):
        lake.upsert("t", spark.createDataFrame([(None, 1)], "k long, v long"), ["k"])
    assert lake.upsert("t", rows.limit(0), ["k"]) == 3 and lake.expire("t") == 2
    assert lake.read("t").count() == 201 and len(lake.versions("t")) == 1
    assert lake.upsert("empty", rows.limit(0), ["k"]) == 1 and lake.read("empty").columns == ["k", "v"]
    assert lake.upsert("empty", rows, ["k"]) == 2 and lake.read("empty").count() == 200
