"""Stands in for the services: CSV by key, declarations with a limit, errors by path."""

import json
from itertools import product
from urllib.parse import parse_qs, urlparse

from tradewinds.sources.transport import NoRecords

LIMIT = 3
XML = """<m:Structure xmlns:m="m" xmlns:s="s" xmlns:c="c"><m:Header><m:Prepared>2024-05-01T00:00:00</m:Prepared></m:Header>
<s:Codelist id="GEO"><s:Code id="FR"><c:Name>France</c:Name></s:Code></s:Codelist><s:Dataflow id="gdp" agencyID="ESTAT" version="1.0"><c:Name>GDP</c:Name></s:Dataflow>
<s:DataStructure><s:DimensionList><s:Dimension id="freq" position="0"/><s:Dimension id="geo" position="1"/></s:DimensionList></s:DataStructure></m:Structure>"""


def get(url, headers=None, timeout=30):
    parts = urlparse(url)
    if "/broken/" in parts.path:
        raise OSError("down")
    if "/nothing/" in parts.path:
        raise NoRecords(url)
    if "getTariffline" in parts.path:
        q = {k: v[0].split(",") for k, v in parse_qs(parts.query).items()}
        rows = [{"flowCode": f, "cmdCode": c, "primaryValue": 1.5} for f, c in product(q["flowCode"], q["cmdCode"])]
        return json.dumps({"data": rows[:LIMIT]})
    if "ListofReferences" in parts.path:
        return json.dumps({"results": [{"category": "reporter", "fileuri": "http://x/files/reporters.json"}, {"category": "flow", "fileuri": "http://x/files/flows.json"}]})
    if "/files/" in parts.path:
        areas = [{"id": 4, "reporterCode": 4, "text": "A"}, {"id": 8, "reporterCode": 8, "text": "B", "entryExpiredDate": "1990-01-01"}]
        return json.dumps({"results": areas if "reporters" in parts.path else [{"id": "M", "text": "Import"}, {"id": "X", "text": "Export"}]})
    if "getDATariffline" in parts.path:
        return json.dumps({"data": [{"period": "2020", "lastReleased": "2021-05-01"}, {"period": "2020", "lastReleased": "2021-07-01"}, {"period": "2021", "lastReleased": "2022-05-01"}]})
    if "/v2/structure/" in parts.path:
        return json.dumps({"data": {"dataStructures": [{"dataStructureComponents": {"dimensionList": {"dimensions": [{"id": "freq", "position": 0}, {"id": "geo", "position": 1}]}}}]}})
    if "/sdmx/3.0/structure/" in parts.path and parts.path.endswith("/old"):
        raise NoRecords(url)
    if "/structure/dataflow/" in parts.path or "/structure/datastructure/" in parts.path or "/sdmx/2.1/datastructure/" in parts.path:
        return XML
    if "/codelist/" in parts.path:
        return XML
    geo = parts.path.rsplit(".", 1)[-1]
    return f'OBS_VALUE,geo,note\n1.5,{geo},"two\nlines"\n,{geo},x\n'
