"""Numbers in string columns: the text that the declared rules give, whatever way the number is written."""

import json
import math
import random
import struct

from conftest import make_pages
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagelake.functions.audit import with_row_hash
from pagelake.functions.numbers import double_text, kinds_schema
from pagelake.functions.schema import dataset_spec
from pagelake.operators.pages import read_records

TOKENS = ["1e10", "1e-05", "1.0", "1.50", "0.1", "123456789012345.678", "1234567890123456789012", "9" * 50, "-0", "-0.0", "0e0",
          "1E400", "-1E400", "8.41E21", "2.0E-3", "1e16", "1e15", "9007199254740993.0", "0.00001", "0.0001", "-12345678.9",
          "1.7976931348623157e308", "2e23", "1.0E22", "9999999999999998.0", "123456789.0", "1e-7", "5e-5", "0.1e1", "2.5e-300"]
COLUMNS = [{"name": "i", "type": "integer"}, {"name": "a", "type": "double"},
           {"name": "d", "type": "dict", "columns": [{"name": "x.y", "type": "string"}, {"name": "f", "type": "float"}]},
           {"name": "l", "type": "list", "columns": [{"name": "k", "type": "decimal"}]}]


def said(token):
    """What a client that decodes JSON and takes ``str`` of a number gets."""
    return str(json.loads(token))


def spec(columns):
    return dataset_spec({"responsePath": "body", "pagination": {"enabled": True}, "columns": columns}, source="n", name="t")


def test_every_token_and_every_place(spark):
    pages = []
    for p, token in enumerate(TOKENS, 1):
        records = [f'{{"i":1,"a":{token},"d":{{"x.y":{token},"f":1.5}},"l":[{{"k":{token}}},{{"k":"{token}"}},{{"k":null}},null]}}',
                   f'{{"i":2,"a":"{token}"}}', '{"i":3,"a":{"z":1.0,"b":[1e3]}}', '{"i":4,"a":true}', '{"i":5,"a":[1.0, 2]}',
                   '{"i":6}', '{"i":7,"a":"plain"}']
        pages.append((p, 200, f'{{"body":[{",".join(records)}]}}'))
    rows = read_records(make_pages(spark, pages), spec(COLUMNS), with_page=True).collect()
    assert len(rows) == 7 * len(TOKENS)
    for r in rows:
        token = TOKENS[r.page - 1]
        if r.i == 1:
            assert (r.a, r.d["x.y"], r.d["f"]) == (said(token), said(token), 1.5), token
            assert [None if e is None else e["k"] for e in r.l] == [said(token), token, None, None]
        else:
            assert r.a == {2: token, 3: '{"z":1.0,"b":[1000.0]}', 4: "true", 5: "[1.0,2]", 6: None, 7: "plain"}[r.i]


def test_row_hash_covers_the_texts(spark):
    columns = [{"name": "i", "type": "integer"}, {"name": "a", "type": "double"}]
    page = (1, 200, '{"body":[{"i":1,"a":1e10},{"i":2,"a":2.5e-7}]}')
    rows = with_row_hash(read_records(make_pages(spark, [page]), spec(columns))).orderBy("i").collect()
    for row, text in zip(rows, ("10000000000.0", "2.5e-07"), strict=True):
        assert row["_rowHash"] == spark.sql(f"select sha2('{row.i}||{text}', 256)").first()[0]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10**9))
def test_doubles_of_any_size(spark, seed):
    rnd = random.Random(seed)
    doubles = [struct.unpack("<d", rnd.randbytes(8))[0] for _ in range(1500)]
    doubles += [rnd.choice([1, -1]) * rnd.randint(1, 10 ** rnd.randint(1, 17)) * 10.0 ** rnd.randint(-30, 30) for _ in range(1500)]
    doubles += [round(rnd.uniform(-1e6, 1e6), rnd.randint(0, 6)) for _ in range(500)]
    doubles = [d for d in doubles if math.isfinite(d) and (d == 0 or abs(d) >= 2.3e-308)]
    rows = spark.createDataFrame([(d,) for d in doubles], "d double").select("d", double_text(F.col("d").cast("string")).alias("t"))
    wrong = [(r.d, r.t) for r in rows.collect() if r.t != repr(r.d)]
    assert all(float(t) == d for d, t in wrong)  # at worst a digit too many or another nearest one
    assert len(wrong) <= len(doubles) // 500, wrong[:5]


def test_schemas_without_strings_are_parsed_once():
    columns = [{"name": "i", "type": "integer"}, {"name": "l", "type": "list", "columns": [{"name": "f", "type": "float"}]}]
    assert kinds_schema(spec(columns).schema) is None
