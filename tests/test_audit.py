from pyspark.sql import functions as F

from pagelake.functions.audit import row_hash, with_audit_columns, with_row_hash

# Hash vectors: SHA-256 hex of the "||"-joined non-null values.
XY = "f89b03760ce0682ad82158e8fad67b6a75dd6f423f5854be656c969fad1b2271"
EMPTY = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
EMPTY_FIRST = "4afa438a16995d1bee7d158a96e78d44f6bb0e97c9cbea694dad67097c9abb8a"
A = "559aead08264d5795d3909718cdd05abd49572e84fe55590eef31a88a08fdffd"


def test_hash_vectors(spark):
    df = spark.createDataFrame(
        [("x", None, "y"), ("x", "y", None), ("x||y", None, None), (None, None, None), ("", "x", "y")],
        "a string, b string, c string")
    got = [r[0] for r in df.select(row_hash(df)).collect()]
    assert got == [XY, XY, XY, EMPTY, EMPTY_FIRST]


def test_null_audit_columns_do_not_change_hash(spark):
    df = spark.createDataFrame([("A", None, None)], "v string, _rowHash string, _processedTimestamp timestamp")
    out = with_audit_columns(df)
    assert out.columns == ["v", "_rowHash", "_processedTimestamp"]
    row = out.first()
    assert row["_rowHash"] == A and row["_processedTimestamp"] is not None
    plain = with_row_hash(spark.createDataFrame([("A",)], "v string"))
    assert plain.columns == ["v", "_rowHash"] and plain.first()["_rowHash"] == A


def test_audit_columns_appended_in_order(spark):
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    out = with_audit_columns(df)
    assert out.columns == ["i", "s", "_rowHash", "_processedTimestamp"]
    assert out.first()["_rowHash"] == out.select(F.sha2(F.lit("1||a"), 256)).first()[0]


def test_nested_columns_hash_json(spark):
    df = spark.sql("select 1 as i, named_struct('x', 2) as st, array(named_struct('y', 'q')) as arr")
    got = df.select(row_hash(df)).first()[0]
    want = spark.sql("""select sha2('1||{"x":2}||[{"y":"q"}]', 256)""").first()[0]
    assert got == want


def test_dotted_column_name(spark):
    df = spark.createDataFrame([("p", "q")], "`a.b` string, c string")
    assert with_row_hash(df).first()["_rowHash"] == spark.sql("select sha2('p||q', 256)").first()[0]
