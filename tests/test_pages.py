"""Page rules on tiny hand-made pages; every case runs directly and from landed pages."""

import json
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import make_pages
from pagelake.functions.schema import dataset_spec
from pagelake.operators.pages import PageError, parse_pages, read_records
from pagelake.sources.landed import land_pages, read_landed_pages

COLS = [{"name": "id", "type": "integer"}, {"name": "s", "type": "string"}]


def spec(paged=True, max_pages=None, columns=COLS, key="body"):
    return dataset_spec({"responsePath": key, "pagination": {"enabled": paged, "maxPages": max_pages},
                         "columns": columns}, source="t", name="d")


def body(*ids, key="body"):
    return json.dumps({key: [{"id": i, "s": f"r{i}"} for i in ids]})


def source(spark, pages, mode):
    """The pages as they are, or as they come back from their landed copy."""
    df = make_pages(spark, pages)
    return df if mode == "direct" else read_landed_pages(spark, land_pages(df, tempfile.mkdtemp() + "/pages"))


def run(spark, pages, sp, mode):
    return sorted(r["id"] for r in read_records(source(spark, pages, mode), sp).collect())


def fails(spark, pages, sp, mode, match=None):
    with pytest.raises(PageError, match=match):
        read_records(source(spark, pages, mode), sp)


MODES = ["direct", "landed"]
BASIC = [(1, 200, body(1, 2)), (2, 200, body(3)), (3, 200, '{"body":[]}'), (4, 200, body(4))]


@pytest.mark.parametrize("mode", MODES)
def test_basic_stops_at_first_empty(spark, mode):
    assert run(spark, BASIC, spec(), mode) == [1, 2, 3]


@pytest.mark.parametrize("mode", MODES)
def test_cap(spark, mode):
    assert run(spark, BASIC, spec(max_pages=1), mode) == [1, 2]
    assert run(spark, BASIC, spec(max_pages=0), mode) == []


@pytest.mark.parametrize("mode", MODES)
@pytest.mark.parametrize("end", ['{"x":1}', '{"body":null}', '{"body":{}}', '{"body":""}', '{"body":0}',
                                 '{"body":0.0}', '{"body":false}', '{"body":[]}'])
def test_falsy_or_missing_ends(spark, mode, end):
    pages = [(1, 200, body(1)), (2, 200, end), (3, 200, body(3)), (4, 500, "boom")]
    assert run(spark, pages, spec(), mode) == [1]


@pytest.mark.parametrize("mode", MODES)
@pytest.mark.parametrize("broken", [(500, body(2)), (200, '{"body":['), (200, "[1]"), (200, ""), (200, "null"),
                                    (200, '{"body":"txt"}'), (200, '{"body":{"a":1}}'), (404, "not found")])
def test_bad_before_stop_fails(spark, mode, broken):
    pages = [(1, 200, body(1)), (2, *broken), (3, 200, '{"body":[]}')]
    fails(spark, pages, spec(), mode)


@pytest.mark.parametrize("mode", MODES)
def test_bad_after_stop_ignored(spark, mode):
    pages = [(1, 200, body(1)), (2, 200, '{"body":[]}'), (3, 500, "err"), (4, 200, '{"body":[')]
    assert run(spark, pages, spec(), mode) == [1]


@pytest.mark.parametrize("mode", MODES)
@pytest.mark.parametrize("value", ["1.5", '"x"', "3000000000"])
def test_wrong_type_fails(spark, mode, value):
    pages = [(1, 200, '{"body":[{"id":%s}]}' % value)]
    fails(spark, pages, spec(), mode)


@pytest.mark.parametrize("mode", MODES)
def test_null_record_fails(spark, mode):
    fails(spark, [(1, 200, '{"body":[null,{"id":1}]}')], spec(), mode)


@pytest.mark.parametrize("mode", MODES)
def test_record_that_is_array_fails(spark, mode):
    fails(spark, [(1, 200, '{"body":[["p","q"]]}')], spec(), mode)


@pytest.mark.parametrize("mode", MODES)
def test_page_gap_fails(spark, mode):
    fails(spark, [(1, 200, body(1)), (3, 200, body(3))], spec(), mode)
    fails(spark, [(2, 200, body(2)), (3, 200, '{"body":[]}')], spec(), mode)


@pytest.mark.parametrize("mode", MODES)
def test_repeated_page_number_fails(spark, mode):
    fails(spark, [(1, 200, body(1)), (1, 200, body(2))], spec(), mode)


@pytest.mark.parametrize("mode", MODES)
def test_duplicate_records_kept(spark, mode):
    assert run(spark, [(1, 200, body(7)), (2, 200, body(7))], spec(), mode) == [7, 7]


@pytest.mark.parametrize("mode", MODES)
def test_first_page_empty_gives_empty_result(spark, mode):
    assert run(spark, [(1, 200, '{"body":[]}'), (2, 200, body(2))], spec(), mode) == []


@pytest.mark.parametrize("mode", MODES)
def test_single_request(spark, mode):
    sp = spec(paged=False)
    assert run(spark, [(1, 200, body(1, 2))], sp, mode) == [1, 2]
    assert run(spark, [(1, 200, '{"body":[]}')], sp, mode) == []
    # several independent responses, one empty: no end-of-data rule
    assert run(spark, [(1, 200, body(1)), (2, 200, '{"body":[]}'), (3, 200, body(3))], sp, mode) == [1, 3]
    fails(spark, [(1, 200, '{"x":1}')], sp, mode, match="page 1 has no list under 'body'")
    fails(spark, [(1, 200, '{"body":null}')], sp, mode)
    fails(spark, [(1, 500, body(1))], sp, mode)


@pytest.mark.parametrize("mode", MODES)
@pytest.mark.parametrize("text", [
    '{"body":[{"id":2}]} garbage', '{"body":[{"id":2}]}<html>', '{"body":[{"id":2}]}{"body":[{"id":3}]}',
    '{"body":[]}{"body":[{"id":3}]}', '{"body":[{"id":2}]},{"body":[]}', '{"body":[{"id":2}]},"x":1',
    "{'body':[{'id':2}]}", '{"body":[{"id":2}]', '{"body":[]}]', "{}{}", "   "])
def test_a_body_is_one_document(spark, mode, text):
    fails(spark, [(1, 200, body(1)), (2, 200, text), (3, 200, '{"body":[]}')], spec(), mode, match="page 2 is not")
    if mode == "direct":
        fails(spark, [(1, 200, text)], spec(paged=False), mode)


@pytest.mark.parametrize("value", ['"NaN"', '"Infinity"', '"-Infinity"', "NaN"])
def test_numbers_that_are_none(spark, value):
    cols = [{"name": "f", "type": "float"}]
    fails(spark, [(1, 200, '{"body":[{"f":%s}]}' % value)], spec(columns=cols), "direct")


def test_the_whole_body_is_in_the_problem(spark):
    text = json.dumps({"body": [{"id": 1, "s": "x" * 50} for _ in range(400)] + [{"id": "the value"}]})
    fails(spark, [(1, 200, text)], spec(), "direct", match="do not fit the declared columns.*the value")


def test_a_failed_request_is_bad_whatever_it_holds(spark):
    fails(spark, [(1, 200, body(1)), (2, -1, body(2)), (3, 200, '{"body":[]}')], spec(), "direct", match="answered -1")


def test_value_rules(spark):
    cols = [{"name": "a", "type": "double"}, {"name": "b", "type": "integer"}, {"name": "c", "type": "string"},
            {"name": "f", "type": "float"}, {"name": "t", "type": "timestamp"}, {"name": "ok", "type": "boolean"}]
    page = '{"body":[{"a":1.5,"b":1,"extra":9,"f":2,"t":"2020-01-01 00:00:00","ok":true}, {"c":{"x":1}}]}'
    rows = read_records(make_pages(spark, [(1, 200, page)]), spec(columns=cols)).collect()
    assert rows[0]["a"] == "1.5" and rows[0]["b"] == 1 and rows[0]["c"] is None and rows[0]["f"] == 2.0
    assert str(rows[0]["t"]) == "2020-01-01 00:00:00" and rows[0]["ok"] is True
    assert "extra" not in rows[0].asDict()
    assert rows[1]["c"] == '{"x":1}' and rows[1]["a"] is None


def test_nested_records(spark):
    cols = [{"name": "id", "type": "integer"},
            {"name": "d", "type": "dict", "columns": [
                {"name": "x", "type": "integer"},
                {"name": "inner", "type": "dict", "columns": [{"name": "y", "type": "string"},
                                                              {"name": "z", "type": "string"}]}]},
            {"name": "l", "type": "list", "columns": [{"name": "k", "type": "string"}]}]
    page = '{"body":[{"id":1,"d":{"x":2,"inner":{"y":"q"}},"l":[{"k":"a"},{"k":"b"}]}]}'
    row = read_records(make_pages(spark, [(1, 200, page)]), spec(columns=cols)).first()
    assert row["d"]["x"] == 2 and row["d"]["inner"]["y"] == "q" and row["d"]["inner"]["z"] is None
    assert [e["k"] for e in row["l"]] == ["a", "b"]


def test_dotted_response_key(spark):
    sp = spec(key="data.items")
    pages = [(1, 200, body(1, key="data.items")), (2, 200, '{"data.items":[]}')]
    assert run(spark, pages, sp, "direct") == [1]


def test_problem_text_names_page_and_status(spark):
    pages = [(1, 200, body(1)), (2, 503, "unavailable"), (3, 200, '{"body":[]}')]
    with pytest.raises(PageError, match="page 2 answered 503: unavailable"):
        read_records(make_pages(spark, pages), spec())


def test_flags(spark):
    pages = [(1, 200, body(1)), (2, 200, '{"body":{}}'), (3, 200, '{"body":{"a":1}}')]
    flags = parse_pages(make_pages(spark, pages), spec()).orderBy("page").collect()
    assert [(r["bad"], r["empty"], r["n_records"]) for r in flags] == [(False, False, 1), (False, True, 0),
                                                                      (True, False, 0)]


def test_page_order_in_output(spark):
    pages = [(2, 200, body(3, 4)), (1, 200, body(1, 2))]
    out = read_records(make_pages(spark, pages), spec(), with_page=True)
    assert [(r["page"], r["id"]) for r in out.orderBy("page", "id").collect()] == [(1, 1), (1, 2), (2, 3), (2, 4)]
    assert out.where(F.col("page") == 2).count() == 2


@pytest.mark.parametrize("mode", MODES)
@pytest.mark.parametrize("broken", ["[]", "[{\"body\":[]}]", "42", "\"text\""])
def test_non_object_roots_fail(spark, mode, broken):
    fails(spark, [(1, 200, body(1)), (2, 200, broken), (3, 200, '{"body":[]}')], spec(), mode)


@pytest.mark.parametrize("mode", MODES)
def test_whitespace_around_body(spark, mode):
    pages = [(1, 200, "  \n" + body(1, 2) + "\n  "), (2, 200, ' { "body" : [ ] } ')]
    assert run(spark, pages, spec(), mode) == [1, 2]


@pytest.mark.parametrize("pages", [[32768, 32769, 65536, 65537], [0, 1, -1, -32768], list(range(1, 70000, 997))])
def test_page_set_counts_every_number_once(spark, pages):
    from pagelake.operators.pages import page_set

    flags = spark.createDataFrame([(p,) for p in pages * 2], "page long")
    rows = page_set(flags).select(F.sum(F.bitmap_count("seen")).alias("distinct"), F.sum("n").alias("n")).first()
    assert (rows["distinct"], rows["n"]) == (len(pages), 2 * len(pages))


def test_a_page_without_number_fails(spark):
    with pytest.raises(PageError, match="repeated page numbers"):
        read_records(make_pages(spark, [(1, 200, body(1)), (None, 200, body(2))]), spec())
