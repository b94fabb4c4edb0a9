import gzip
import hashlib

from cases import SF
from hypothesis import given
from hypothesis import strategies as st

from pagelake.llm import warc
from pagelake.llm.common import table
from pagelake.session import resolve_filesystem


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'x' as digest", "'x' as _digest2", "'x' as file", "1 as offset")


@given(st.lists(st.tuples(st.integers(0, 2000), st.integers(1, 50)), max_size=30), st.integers(0, 100), st.integers(1, 300))
def test_reads_cover_their_ranges(ranges, gap, most):
    ranges = sorted(ranges)
    reads = warc.coalesced(ranges, gap, most)
    assert sum(n for *_, n in reads) == len(ranges)
    at = 0
    for begin, end, n in reads:
        for offset, length in ranges[at:at + n]:
            assert begin <= offset and offset + length <= end
        at += n
        assert n == 1 or end - begin <= most


def test_round_trip_and_revisits(spark):
    big = "<p>é same" * 40
    rows = [(3, "http://a/\r\nx y", big), (1, None, big), (2, "http://b", big), (2, "http://b", big), (None, "http://c", big),
            (7, "u", None), (8, "u", ""), (9, "u", "tiny"), (10, "u", "tiny"), (11, "u", "z" * 300_000)]
    index = warc.write_archives(pages(spark, rows))
    assert set(index.columns) == {"page_id", "file", "offset", "length", "url", "digest", "revisit", "refers_to"}
    got = {}
    for r in warc.read_records(index).collect():
        got.setdefault(r.page_id, []).append(r)
    assert {k: {r.record_type for r in v} for k, v in got.items()} == {
        1: {"response"}, 2: {"revisit"}, 3: {"revisit"}, None: {"revisit"}, 7: {"response"}, 8: {"response"},
        9: {"response"}, 10: {"response"}, 11: {"response"}}
    assert got[3][0].refers_to == 1 and got[3][0].payload is None and got[3][0].payload_bytes == len(big.encode())
    assert got[3][0].url == "http://a/\r\nx y" and len(got[2]) == 2
    assert bytes(got[11][0].payload) == b"z" * 300_000 and got[7][0].payload_bytes == 0
    assert got[1][0].payload_digest == hashlib.sha256(big.encode()).hexdigest()


def test_selected_records_and_valid_members(spark):
    docs = table(spark, SF, "pages")
    index = warc.write_archives(docs)
    some = index.filter("page_id % 7 = 3")
    html = {r.page_id: r.html for r in docs.collect()}
    got = warc.read_records(some).collect()
    assert {r.page_id for r in got} == {p for p in html if p % 7 == 3}
    assert all(bytes(r.payload).decode() == html[r.page_id] for r in got if r.record_type == "response")
    for name in {r.file for r in index.collect()}:
        filesystem, path = resolve_filesystem(name)
        with filesystem.open_input_file(path) as file:
            raw = gzip.decompress(file.read())  # the members in a row are one valid file
        assert raw.count(b"WARC/1.1\r\n") == index.filter(index.file == name).count()


def test_nothing(spark):
    assert warc.read_records(warc.write_archives(pages(spark, []))).count() == 0


def test_ids_that_are_text(spark):
    df = spark.createDataFrame([("b", "u", "x" * 200), ("a", "u", "x" * 200)], "page_id string, url string, html string")
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.read_records(warc.write_archives(df)).collect()}
    assert got == {"a": ("response", None), "b": ("revisit", "a")}
