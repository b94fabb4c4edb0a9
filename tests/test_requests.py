"""Requests as rows: shaping, transports by name, retries, refusals."""

import json
import re
import sys
import types
from urllib.parse import parse_qsl, urlencode, urlsplit

import pytest

from pagelake.functions.schema import dataset_spec
from pagelake.operators.pages import PageError, check_pages
from pagelake.plans.ingest import ingest, stage_api_pages
from pagelake.plans.registry import SourceSpec, source_spec
from pagelake.sources.requests import CallTransport, TableTransport, shape_requests, transport_of

COLS = [{"name": "id", "type": "integer"}]


def spec(paged=True, params=None, **paging):
    return dataset_spec({"responsePath": "data", "pagination": {"enabled": paged, **paging}, "columns": COLS},
                        source="api", name="asked", endpoint="/v1/x", params=params or {})


def test_shape_matches_an_http_client(spark):
    params = {"q": "a b&c=d/é~*", "empty": "", "page": "99", "päge": "1+1%"}
    source = SourceSpec("api", base_url="https://h.test/", headers={"k": "{api_key}"}, timeout=3, retries=4)
    rows = shape_requests(spark, source, spec(params=params), 5, 7).orderBy("page").collect()
    assert [r.page for r in rows] == [5, 6, 7]
    for r in rows:
        sent = {k: v for k, v in params.items() if k != "page"} | {"page": str(r.page)}
        assert r.params == sent and r.request == f"https://h.test/v1/x?{urlencode(sent)}"
        assert dict(parse_qsl(urlsplit(r.request).query, keep_blank_values=True)) == sent
        assert (r.url, r.headers, r.timeout, r.attempts) == ("https://h.test/v1/x", {"k": "{api_key}"}, 3.0, 5)
    (one,) = shape_requests(spark, source, spec(paged=False, params={"page": "7"})).collect()
    assert one.request == "https://h.test/v1/x?page=7" and one.page == 1
    (bare,) = shape_requests(spark, source, spec(paged=False)).collect()
    assert bare.request == "https://h.test/v1/x" and bare.params == {}


def answers(spark, rows):
    return spark.createDataFrame(rows, "request string, attempt int, status int, body string, headers map<string,string>")


def test_attempts_end_with_the_first_lasting_answer(spark):
    source = SourceSpec("api", base_url="https://h.test", headers={"k": "v"}, retries=2)
    url = "https://h.test/v1/x?page="
    said = [(url + "1", 0, 503, "busy", None), (url + "1", 1, 200, "one", None), (url + "1", 2, 200, "never sent", None),
            (url + "2", 0, 500, "broken", None), (url + "2", 1, 200, "never sent", None),
            (url + "3", 0, -1, "lost", None), (url + "3", 1, 429, "slow", None), (url + "3", 2, 504, "late", None),
            (url + "3", 3, 200, "a fourth attempt is not allowed", None),
            (url + "5", 0, 200, "five", {"k": "v"}), (url + "6", 0, 200, "six", {"k": "other"}),
            (url + "7", 0, 200, "seven", {"k": "v", "more": "x"})]
    transport = TableTransport(answers(spark, said))
    requests = shape_requests(spark, source, spec(), 1, 7)
    sent = sorted((r.page, r.attempt, r.status) for r in transport.attempts(requests).collect())
    assert sent == [(1, 0, 503), (1, 1, 200), (2, 0, 500), (3, 0, -1), (3, 1, 429), (3, 2, 504), (4, 0, 404), (5, 0, 200),
                    (6, 0, 401), (7, 0, 401)]
    got = sorted(tuple(r) for r in transport.answer(requests).collect())
    assert got == [(1, 200, "one"), (2, 500, "broken"), (3, 504, "late"), (4, 404, ""), (5, 200, "five"), (6, 401, ""),
                   (7, 401, "")]


def test_a_wave_moves_only_the_answers_to_its_requests(spark):
    source = SourceSpec("api", base_url="https://h.test", headers={"k": "v"})
    said = spark.range(1, 2001).selectExpr(
        "concat('https://h.test/v1/x?page=', id) request", "0 attempt", "200 status", "concat('page ', id) body",
        "cast(null as map<string,string>) headers")
    transport = TableTransport(said)
    got = transport.answer(shape_requests(spark, source, spec(), 1000, 1002))
    assert sorted(tuple(r) for r in got.collect()) == [(p, 200, f"page {p}") for p in (1000, 1001, 1002)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    semi = re.compile(r"BroadcastHashJoin \[_request#\d+\], \[_asked#\d+\], LeftSemi, BuildRight")
    # every use of the answers is cut to the wave before an exchange deals it out
    assert len(semi.findall(plan)) >= 2


def service(fails=(), last=20):
    def call(url, params, headers, timeout):
        assert (url, headers, timeout) == ("https://h.test/v1/x", {"key": "k-1"}, 2.0)
        page = int(params["page"])
        if page in fails:
            return 500, "broken"
        return 200, json.dumps({"data": [{"id": page}] if page <= last else []})
    return call


def test_a_function_as_transport(spark, monkeypatch):
    monkeypatch.setenv("API_KEY", "k-1")
    module = types.ModuleType("pagelake_test_transport")
    module.good = lambda spark, source: CallTransport(service(), source.key_env, 0)
    module.bad = lambda spark, source: CallTransport(service({3}), source.key_env, 0)
    monkeypatch.setitem(sys.modules, "pagelake_test_transport", module)
    source = source_spec({"name": "api", "variables": {"base_url": "https://h.test", "timeout": 2, "first_wave": 4, "max_wave": 8,
                                                       "transport": "pagelake_test_transport:good"},
                          "headers": {"key": "{api_key}"}})
    done = ingest(spark, spec(), source=source, layer="asked_t")
    assert (done.pages, done.records, done.stop) == (20, 20, 21)
    bad = SourceSpec("api", base_url="https://h.test", headers={"key": "{api_key}"}, timeout=2,
                     transport="pagelake_test_transport:bad")
    with pytest.raises(PageError, match="page 3 answered 500: broken"):
        check_pages(stage_api_pages(spark, bad, spec()), spec())
    monkeypatch.delenv("API_KEY")
    with pytest.raises(ValueError, match="API_KEY"):
        stage_api_pages(spark, source, spec())
    with pytest.raises(ValueError, match="a transport is"):
        transport_of(spark, SourceSpec("api", transport="nothing"))


def test_transient_failures_of_a_function_are_sent_again(spark):
    def call(url, params, headers, timeout):
        call.sent = getattr(call, "sent", 0) + 1
        return (-1, "lost") if call.sent == 1 else (503, "busy") if call.sent == 2 else (200, '{"data":[{"id":1}]}')

    source = SourceSpec("api", base_url="https://h.test", headers={"k": "v"}, retries=2)
    (row,) = CallTransport(call, backoff=0).answer(shape_requests(spark, source, spec(paged=False))).collect()
    assert (row.status, row.body) == (200, '{"data":[{"id":1}]}')
