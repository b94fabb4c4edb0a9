"""Random page sequences: Spark result == a sequential client walking the pages (brute force)."""

import json
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import make_pages
from pagelake.functions.schema import dataset_spec
from pagelake.operators.pages import PageError, read_records
from pagelake.sources.landed import land_pages, read_landed_pages

COLS = [{"name": "id", "type": "integer"}]
KINDS = ["records", "records", "records", "empty_list", "missing_key", "falsy_obj", "http_500", "truncated"]


def body_of(kind, ids):
    return {
        "records": json.dumps({"body": [{"id": i} for i in ids]}),
        "empty_list": '{"body":[]}',
        "missing_key": '{"other":1}',
        "falsy_obj": '{"body":{}}',
        "http_500": json.dumps({"body": [{"id": i} for i in ids]}),
        "truncated": '{"body":[{"id":',
    }[kind]


def sequential_client(pages, max_pages):
    """What a client requesting page=1,2,... sees: records, or 'error'."""
    by_number = {p: (k, ids) for p, k, ids in pages}
    out, page = [], 1
    while max_pages is None or page <= max_pages:
        if page not in by_number:
            return out if max_pages is None and page > max(by_number, default=0) else "error"
        kind, ids = by_number[page]
        if kind in ("http_500", "truncated"):
            return "error"
        if kind != "records" or not ids:
            return out
        out.extend(ids)
        page += 1
    return out


pages_strategy = st.lists(st.tuples(st.sampled_from(KINDS), st.integers(min_value=0, max_value=3)),
                          min_size=0, max_size=7)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(layout=pages_strategy, max_pages=st.one_of(st.none(), st.integers(min_value=0, max_value=8)),
       landed=st.booleans())
def test_matches_sequential_client(spark, layout, max_pages, landed):
    pages, next_id = [], 0
    for number, (kind, n) in enumerate(layout, start=1):
        ids = list(range(next_id, next_id + n))
        next_id += n
        pages.append((number, kind, ids))
    # a folder of responses has an empty page after its last one
    rows = [(p, 500 if k == "http_500" else 200, body_of(k, ids)) for p, k, ids in pages]
    rows.append((len(pages) + 1, 200, '{"body":[]}'))
    expected = sequential_client(pages + [(len(pages) + 1, "empty_list", [])], max_pages)
    sp = dataset_spec({"responsePath": "body", "pagination": {"enabled": True, "maxPages": max_pages},
                       "columns": COLS}, source="m", name="d")
    df = make_pages(spark, rows)
    try:
        if landed:
            df = read_landed_pages(spark, land_pages(df, tempfile.mkdtemp() + "/pages"))
        out = read_records(df, sp)
        got = sorted(r.id for r in out.collect())
    except PageError:
        got = "error"
    assert got == (expected if expected == "error" else sorted(expected))
