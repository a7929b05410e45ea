import gzip
import io
import urllib.error
import urllib.request
from datetime import UTC, datetime

import pytest

from tradewinds.sources import control, responses, structures, transport
from tradewinds.sources import requests as rq
from tradewinds.sources.limits import Quota
from tradewinds.sources.structures import Dimension, Structure

S = Structure("ESTAT", "namq", (Dimension("freq", 0), Dimension("geo", 1)))


def test_quota_keeps_every_window():
    now, starts = [0.0], []
    quota = Quota([(2, 10), (3, 100)], clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    for _ in range(5):
        quota.acquire()
        starts.append(now[0])
    assert starts == [0, 0, 10, 100, 100] and quota.remaining() == 0
    quota.reset()
    assert quota.remaining() == 2
    assert Quota([(1, 1), (500, 86400)], lanes=4).limits == [(1, 4), (125, 86400)]
    assert Quota.of({"requests": 30, "unit": "minutes", "count": 2}).limits == [(30, 120)]
    for bad in ({"requests": 1, "unit": "years"}, {"requests": 0, "unit": "days"}):
        with pytest.raises(ValueError):
            Quota.of(bad)


def test_transport_retries(monkeypatch):
    codes, slept = [503, 429, 200], []

    class Opener:
        def open(self, request, timeout):
            code = codes.pop(0)
            if code != 200:
                raise urllib.error.HTTPError(request.full_url, code, "", {}, io.BytesIO(b"why"))
            return io.BytesIO(gzip.compress(b"text"))

    monkeypatch.setattr(urllib.request, "build_opener", lambda *_: Opener())
    assert transport.get("http://x/", sleep=slept.append) == "text" and slept == [0.5, 1.0]
    codes[:] = [404]
    with pytest.raises(transport.NoRecords):
        transport.get("http://x/")
    codes[:] = [400]
    with pytest.raises(urllib.error.HTTPError):
        transport.get("http://x/", sleep=slept.append)
    assert transport.url_of("http://x/", "/a", {"c[T]": "ge:1+le:2"}) == "http://x/a?c[T]=ge:1+le:2"


def test_requests():
    (one,) = rq.estat_data(S, {"GEO": ["FR", "DE"], "freq": "A"}, start="2020", end="2021", last_n=3)
    assert one.path == "sdmx/3.0/data/dataflow/ESTAT/namq/*/A.*"
    assert one.params == {"c[GEO]": "FR,DE", "c[TIME_PERIOD]": "ge:2020+le:2021", "lastNObservations": "3", "format": "csvdata", "compress": "false"}
    old = rq.estat_data(S, {"geo": ["FR", "DE"]}, "2.1", split_by=["geo"], version="1.0")
    assert [r.path for r in old] == ["sdmx/2.1/data/ESTAT,namq,1.0/all.FR", "sdmx/2.1/data/ESTAT,namq,1.0/all.DE"]
    with pytest.warns(UserWarning):
        rq.estat_data(S, {"nope": "x"})
    with pytest.raises(ValueError):
        rq.estat_data(S, format="xml")
    assert rq.estat_base("ds-045409") == rq.COMEXT
    assert rq.estat_structure("dataflow", "*").path == "sdmx/3.0/structure/dataflow/ESTAT/*/*"
    assert rq.estat_structure("dataconstraint", "*", "*", "+", "2.1").path == "sdmx/2.1/contentconstraint/all/all/latest"
    some, left = rq.oecd_data(S, {1: ["FR", "DE"], "freq": ["A", "Q"]}, split_by=["geo"], updated_after=datetime(2024, 1, 2))
    assert [r.path[-4:] for r in some] == ["*.FR", "*.DE"] and left == {"freq": ["A", "Q"]}
    assert some[0].params["updatedAfter"] == "2024-01-02T00:00:00Z"
    some, left = rq.oecd_data(S, {"geo": ["FR", "DE"]}, "v1")
    assert some[0].path == "data/ESTAT,namq,+/.FR,DE" and not left
    for call in (lambda: rq.oecd_data(S, {"nope": 1}), lambda: rq.oecd_data(S, split_by=["geo"]), lambda: rq.declarations({"nope": 1})):
        with pytest.raises(ValueError):
            call()
    two = rq.declarations({"products": list("abc"), "reporters": 4}, batch=2)
    assert [r.params["cmdCode"] for r in two] == [["a", "b"], ["c"]] and two[0].halve == ("flowCode", "cmdCode", "reporterCode")


XML = """<mes:Structure xmlns:mes="m" xmlns:str="s" xmlns:com="c"><mes:Header><mes:Prepared>2024-05-01T00:00:00</mes:Prepared></mes:Header>
<str:Concept id="geo"><com:Name xml:lang="fr">Pays</com:Name><com:Name xml:lang="en">Country</com:Name></str:Concept>
<str:Codelist id="GEO"><str:Code id="FR"><com:Name xml:lang="fr">France</com:Name></str:Code><str:Code id="XX"/></str:Codelist>
<str:Dataflow id="namq" agencyID="ESTAT" version="1.0"><com:Name>GDP</com:Name></str:Dataflow>
<str:DataStructure><str:DimensionList><str:Dimension id="geo" position="1"><str:LocalRepresentation><str:Enumeration>urn:x.Codelist=ESTAT:GEO(1.0)</str:Enumeration></str:LocalRepresentation></str:Dimension>
<str:Dimension id="freq" position="0"/></str:DimensionList></str:DataStructure>{notes}</mes:Structure>"""


def test_structures(tmp_path):
    note = "<com:Annotation><com:AnnotationType>UPDATE_{}</com:AnnotationType><com:AnnotationTitle>{}</com:AnnotationTitle></com:Annotation>"
    s = structures.structure_of_xml(XML, "ESTAT", "namq")
    assert s.names == ["freq", "geo"] and s.dimensions[1] == Dimension("geo", 1, "Country", "GEO")
    assert s.position("GEO") == 1 and s.position("freq") == 0 and s.position("x") is None
    assert structures.codes_of_xml(XML) == [{"code": "FR", "name": "France"}, {"code": "XX", "name": None}]
    assert structures.dataflows_of_xml(XML) == [{"id": "namq", "name": "GDP", "version": "1.0", "agency": "ESTAT"}]
    assert structures.last_update_of_xml(XML) == datetime(2024, 5, 1, tzinfo=UTC)
    notes = note.format("STRUCTURE", "2024-03-01") + note.format("DATA", "2024-02-01T02:00:00+02:00")
    assert structures.last_update_of_xml(XML.replace("{notes}", notes)) == datetime(2024, 2, 1, tzinfo=UTC)
    assert structures.last_update_of_xml("no xml") is None
    for bad in ("<a/>", "no xml"):
        with pytest.raises(ValueError):
            structures.structure_of_xml(bad, "a", "b")
    v2 = {"data": {"conceptSchemes": [{"concepts": [{"id": "AREA", "name": "Area"}]}], "dataStructures": [{"dataStructureComponents": {"dimensionList": {"dimensions": [{"id": "B", "position": 1}, {"id": "A", "position": 0, "conceptIdentity": "urn:S(1.0).AREA"}]}}}]}}
    assert structures.structure_of_json(v2, "O", "f").dimensions == (Dimension("A", 0, "Area"), Dimension("B", 1))
    v1 = {"structure": {"dimensions": {"observation": [{"id": "T", "keyPosition": 2, "name": "Time"}]}}}
    assert structures.structure_of_json(v1, "O", "f").dimensions == (Dimension("T", 2, "Time"),)
    path = tmp_path / "s.json"
    structures.Structures(path).add(s)
    assert structures.Structures(path).resolve("ESTAT", "namq", lambda: 1 / 0) == s


def test_control(tmp_path):
    path = tmp_path / "a" / "b.json"
    control.Instants(path).mark(["x"], datetime(2024, 1, 1, tzinfo=UTC))
    assert control.Instants(path).get("x") == datetime(2024, 1, 1, tzinfo=UTC) and not list(path.parent.glob("*.part"))
    assert control.instant("2024-01-01T00:00:00Z") == control.instant("2024-01-01") and control.instant("soon") is None
    control.write_json(tmp_path / "c.json", {"PATHS": {"a": 1}})
    assert control.settings(tmp_path / "c.json", {"TRADEWINDS_PATHS__b": "[2]", "OTHER": "x"}) == {"PATHS": {"a": 1, "b": [2]}}
    with pytest.raises(ValueError):
        control.read_json("x.csv")


def test_json_in_any_store(spark, tmp_path):
    store = control.Store(spark, f"file://{tmp_path}/deep")
    assert store.load("a.json", {}) == {}
    for n in (1, 2):
        store.save("x/a.json", {"n": n, "when": datetime(2024, 1, 1, tzinfo=UTC), "é": "ü"})
        assert store.load("x/a.json") == {"n": n, "when": "2024-01-01T00:00:00+00:00", "é": "ü"}
    assert not list(tmp_path.rglob("*.part"))
    with pytest.raises(ValueError):
        store.load("a.csv")


def test_responses(spark, tmp_path):
    fake = {"transport": "tests.fake_service:get", "lanes": 2}
    some = rq.estat_data(S, {"geo": ["FR", "DE"]}, split_by=["geo"])
    nothing, broken = rq.Request("http://x", "a/nothing/b"), rq.Request("http://x", "a/broken/b")
    with pytest.warns(UserWarning, match="1 of 4"):
        got = responses.land(spark, [*some, nothing, broken], str(tmp_path / "a"), **fake)
    rows = responses.csv_rows(got, ["geo", "OBS_VALUE", "note", "gone"])
    assert sorted(map(tuple, rows.collect()), key=str) == sorted([(g, v, n, None) for g in ("FR", "DE") for v, n in (("1.5", "two\nlines"), (None, "x"))], key=str)
    with pytest.raises(ValueError, match="all 1"):
        responses.land(spark, [broken], str(tmp_path / "b"), **fake)
    assert responses.land(spark, [nothing], str(tmp_path / "c"), **fake).isEmpty()
    lines = responses.land(spark, rq.declarations({"products": list("abcdefg")}, limit=3), str(tmp_path / "d"), quota={"requests": 1000, "unit": "seconds"}, **fake)
    got = responses.declaration_rows(lines, "flowCode string, cmdCode string, primaryValue double")
    assert sorted((r.flowCode, r.cmdCode) for r in got.collect()) == [(f, c) for f in "MX" for c in "abcdefg"]
    codes = spark.createDataFrame([('{"results": [{"id": 1, "reporterCode": 4}, {"id": 2, "reporterCode": 8, "entryExpiredDate": "1990"}]}',)], "body string")
    flat = responses.references(codes, "id int, reporterCode int, entryExpiredDate string")
    assert [r.code for r in responses.valid_codes(flat, "reporter").collect()] == ["4"]
    assert [r.code for r in responses.valid_codes(flat, "flow").collect()] == ["1", "2"]
    with pytest.raises(ValueError):
        responses.category_file({"a": "u"}, "b")
