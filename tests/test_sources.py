import json
from datetime import date

import pytest

from tradewinds.sources import parsers, planning
from tradewinds.sources.lake import Lake


def test_planning():
    assert planning.identity_key("ESTAT", "namq_10_gdp", "*", {"GEO": ["FR", "DE"], "FREQ": "Q", "X": None}) == "ESTAT::namq_10_gdp::*::FREQ=Q;GEO=DE,FR"
    assert planning.split({}) == [{}]
    assert planning.split({"a": [1, 2], "b": "x"}) == [{"a": "1", "b": "x"}, {"a": "2", "b": "x"}]
    with pytest.raises(ValueError):
        planning.split({"a": range(11), "b": range(10)})
    want = {"G": ["DE", "FR"]}
    assert [planning.positional_key(["F", "G"], want, s) for s in ("3.0", "2.1", "v1")] == ["*.DE+FR", "all.DE+FR", ".DE,FR"]
    with pytest.raises(ValueError):
        planning.positional_key(["F", "G"], want, "v2")
    assert planning.periods(date(2020, 11, 1), date(2021, 2, 1), "M") == ["202011", "202012", "202101", "202102"]
    assert planning.valid_periods(date(1965, 5, 1), wanted=["1963", "1965"]) == ["1963"]
    assert planning.schema_name("DS-045409") == "DS_045409" and planning.schema_name("1x") == "df_1x"
    assert planning.primary_key(["GEO"], ["geo", "TIME_PERIOD", "v"]) == ["geo", "TIME_PERIOD"]
    assert planning.by_priority(["a", "b", "c"], {"a": 5, "c": 2}) == ["b", "c", "a"]


def test_halves_keep_all_values():
    order = ["flow", "product"]
    assert planning.halved({"flow": ["M"], "product": list("abc")}, order) == [{"flow": ["M"], "product": ["a"]}, {"flow": ["M"], "product": ["b", "c"]}]
    assert planning.halved({"flow": ["M", "X"], "product": list("abc")}, order)[1] == {"flow": ["X"], "product": list("abc")}
    assert planning.halved({"flow": ["M"], "product": []}, order) == []


def test_parsers(spark):
    wide = spark.createDataFrame([("A,FR", "1.5", "12.3 p", ":")], ["freq,geo\\TIME", "2020 ", "2021", "2022"])
    assert [tuple(r) for r in parsers.tsv_to_rows(wide).orderBy("TIME_PERIOD").collect()] == [("A", "FR", "2020", 1.5), ("A", "FR", "2021", None), ("A", "FR", "2022", None)]
    shape = {"id": ["geo", "time"], "size": [2, 3], "dimension": {"geo": {"category": {"index": ["FR", "DE"]}}, "time": {"category": {"index": {"2020": 0, "2021": 1, "2022": 2}}}}}
    dense, sparse = json.dumps({**shape, "value": [1, None, 3, 4, 5, 6]}), json.dumps({**shape, "value": {"0": 1, "4": 5}})
    rows = {tuple(r) for r in parsers.jsonstat_to_rows(spark.createDataFrame([(dense,), (sparse,)], "p string"), "p", ["geo", "time"]).collect()}
    assert ("DE", "2021", 5.0) in rows and ("FR", "2021", None) not in rows and len(rows) == 5
    turned = json.dumps({"id": ["time", "geo"], "size": [1, 2], "dimension": {"geo": {"category": {"index": {"IT": 1, "FR": 0}}}, "time": {"category": {"index": ["1999"]}}}, "value": [7, 8]})
    odd = spark.createDataFrame([(turned,), ("no json",), ("{}",), (None,)], "p string")
    assert {tuple(r) for r in parsers.jsonstat_to_rows(odd, "p", ["geo", "time"]).collect()} == {("FR", "1999", 7.0), ("IT", "1999", 8.0)}
    text = json.dumps({"dataSets": [{"observations": {"0:1": [2.5, 0], "1:0": [7]}}]})
    got = parsers.sdmxjson_to_rows(spark.createDataFrame([(text,)], "p string"), "p", [("geo", ["FR", "DE"]), ("t", ["2020", "2021"])]).collect()
    assert {tuple(r) for r in got} == {("FR", "2021", 2.5), ("DE", "2020", 7.0)}


def test_sdmxjson_has_scalars_and_attributes(spark):
    said = ({"0:0": 5.0, "0:1": [6.0]}, {"1:0": [5.5, None, "A", {"en": "x, [y]"}], "1:1": [7, 0]}, {"0:2": [None, "M"], "1:2": None}, {"2:0": [], "2:1": 1e-7, "2:2": ["A"]})
    table = spark.createDataFrame([(json.dumps({"dataSets": [{"observations": x}]}),) for x in said], "p string")
    got = {tuple(r) for r in parsers.sdmxjson_to_rows(table, "p", [("geo", "FDI"), ("t", "XYZ")]).collect()}
    assert got == {("F", "X", 5.0), ("F", "Y", 6.0), ("D", "X", 5.5), ("D", "Y", 7.0), ("F", "Z", None), ("D", "Z", None), ("I", "X", None), ("I", "Y", 1e-7), ("I", "Z", None)}


def test_lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    row = lambda *r: spark.createDataFrame(list(r), "k string, v int")
    assert not lake.exists("t") and lake.upsert("t", row(("a", 1), ("b", 2)), ["k"]) == 1
    first = lake.versions("t")[0]["time"]
    for _ in range(2):  # the same upsert twice gives the same table
        lake.upsert("t", row(("b", 3), ("c", 4)), ["k"])
        assert {tuple(r) for r in lake.read("t").collect()} == {("a", 1), ("b", 3), ("c", 4)}
    assert {tuple(r) for r in lake.read("t", version=1).collect()} == {("a", 1), ("b", 2)} == {tuple(r) for r in lake.read("t", as_of=first).collect()}
    for bad in (row(("a", 1), ("a", 2)), row((None, 1))):
        with pytest.raises(ValueError):
            lake.upsert("t", bad, ["k"])
    assert lake.expire("t", keep=2) == len(lake.versions("t")) - 1 == 1 and not lake.expire("t", keep=2)
    assert {tuple(r) for r in lake.read("t").collect()} == {("a", 1), ("b", 3), ("c", 4)}
