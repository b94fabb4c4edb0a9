import random
import re

from cases import SF, Union, documents, odd_rows, prose
from pyspark.sql import functions as F

from pagelake.llm import line_dedup
from pagelake.llm.common import table


def shingles(line):
    raw = line.encode()
    return {raw[k:k + line_dedup.SHINGLE] for k in range(max(1, len(raw) - line_dedup.SHINGLE + 1))}


def lines_of(rows):
    return [((i is None, i or 0, k), line) for i, t in rows for k, line in enumerate((t or "").split("\n"))
            if t is not None and line.strip(" \t\n\x0b\x0c\r")]


def brute_force(rows):
    """(id, line, class id, class line) of every line that counts, by comparing all different lines."""
    lines = lines_of(rows)
    sets = {line: shingles(line) for _, line in lines}
    distinct, union = sorted(sets), Union()
    for a, x in enumerate(distinct):
        union.find(x)
        for y in distinct[a + 1:]:
            small, large = sorted((len(sets[x]), len(sets[y])))
            if small >= line_dedup.SIMILARITY * large:
                both = len(sets[x] & sets[y])
                if both >= line_dedup.SIMILARITY * (small + large - both):
                    union.join(x, y)
    first = {}
    for place, line in sorted(lines):
        first.setdefault(union.find(line), place)
    return {(place, first[union.find(line)]) for place, line in lines}


def place(i, k):
    return (i is None, i or 0, k)


def classes(spark, rows):
    got = line_dedup.line_classes(documents(spark, rows)).collect()
    assert all(r.kept == (place(r.doc_id, r.line) == place(r.class_doc_id, r.class_line)) for r in got)
    return {(place(r.doc_id, r.line), place(r.class_doc_id, r.class_line)) for r in got}


def variants(seed, n, edits):
    rnd = random.Random(seed)
    base = prose(seed, 60)
    out = []
    for _ in range(n):
        line = list(base)
        for _ in range(rnd.randint(0, edits)):
            line[rnd.randrange(len(line))] = rnd.choice("abcxyz")
        out.append("".join(line))
    return out


def test_groups_of_variants_match_brute_force(spark):
    rows = [(100 + k, line + "\n" + prose(1000 + k, 25)) for k, line in enumerate(variants(1, 60, 3))]
    rows += [(300 + k, line) for k, line in enumerate(variants(2, 5, 2))]
    rows += [(None, variants(2, 1, 0)[0]), (1, None), (2, ""), (3, "short line"), (400, rows[0][1]), (401, rows[0][1])]
    assert classes(spark, rows) == brute_force(rows)


def test_recall_on_the_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = line_dedup.line_classes(table(spark, SF, "documents")).collect()
    pairs = {(place(r.doc_id, r.line), place(r.class_doc_id, r.class_line)) for r in got}
    expected = brute_force(rows)
    assert len(pairs) == len(expected)
    assert len(pairs & expected) / len(expected) > 0.99


def test_odd_rows(spark):
    docs = documents(spark, odd_rows())
    cleaned = line_dedup.clean_documents(docs)
    assert cleaned.columns == docs.columns
    got = {}
    for r in cleaned.collect():
        got.setdefault(r.doc_id, []).append((r.text, r.n_chars))
    texts = dict(odd_rows())
    assert got[4] == [(texts[4], len(texts[4]))]  # the first line of its class
    assert got[5] == [("", 0)] * 2 and ("", 0) in got[None]
    assert got[1] == [(None, None)] and got[2] == [("", 0)] and got[6] == [("x", 1)]
    assert got[10] == [(texts[10].split("\n")[0], len(texts[10].split("\n")[0]))]
    assert len(got[8][0][0]) == len(texts[8])
    assert line_dedup.line_classes(documents(spark, [])).count() == 0
    assert line_dedup.clean_documents(documents(spark, [])).count() == 0


def test_short_lines_are_nodes(spark):
    rows = [(1, "All rights reserved.\n\n# Notes\nok"), (2, "All rights reserved.\n \t\n# Notes\nok\n####"),
            (3, "ok!\nAll rights reserved?\n# Notes\n")]
    got = {(place(r.doc_id, r.line), place(r.class_doc_id, r.class_line))
           for r in line_dedup.line_classes(documents(spark, rows)).collect()}
    first = {place(1, 0): 0, place(1, 2): 2, place(1, 3): 3}
    expected = {(p, p) for p in first} | {(place(2, 0), place(1, 0)), (place(2, 2), place(1, 2)), (place(2, 3), place(1, 3)),
                                          (place(2, 4), place(2, 4)), (place(3, 0), place(3, 0)),
                                          (place(3, 2), place(1, 2))}
    alone = (place(3, 1), place(3, 1)) if jaccard("All rights reserved.", "All rights reserved?") < line_dedup.SIMILARITY \
        else (place(3, 1), place(1, 0))
    assert got == expected | {alone}
    kept = {r.doc_id: r.text for r in line_dedup.clean_documents(documents(spark, rows)).collect()}
    assert kept[1] == rows[0][1] and kept[2] == " \t\n####"


def test_minima_of_lines_around_a_block_of_shingles(spark):
    ends = {1, 2, line_dedup.SHINGLE - 1, line_dedup.SHINGLE} | {line_dedup.SHINGLE - 1 + blocks * line_dedup.AT_ONCE + k
                                                                 for blocks in (1, 2) for k in (-1, 0, 1)}
    rows = [(n, prose(n, 60)[:n - 1] + "z") for n in sorted(ends)]
    cuts = sorted({cut for _, line in rows for cut in shingles(line)})
    hashed = spark.createDataFrame([(bytearray(c),) for c in cuts], "cut binary").selectExpr("cut", "xxhash64(cut) h").collect()
    hashes = {bytes(r.cut): r.h for r in hashed}
    got = {r._id: [w >> 8 * k & 255 for w in r._low for k in range(8)]
           for r in line_dedup.signatures(documents(spark, rows)).collect()}
    assert got == {n: [min(hashes[c] ^ a for c in shingles(line)) & 255 for a in line_dedup._ANCHORS] for n, line in rows}


def jaccard(a, b):
    return len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))


def test_no_python_in_the_plan(spark):
    docs = documents(spark, odd_rows())
    for df in (line_dedup.signatures(docs), line_dedup.line_classes(docs), line_dedup.clean_documents(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_candidates_agree_by_bytes_of_their_minima(spark):
    rnd = random.Random(5)
    rows = []
    for k in range(400):
        a = [rnd.choice([0, -1, -(1 << 63), rnd.getrandbits(64) - (1 << 63)]) for _ in range(4)]
        masks = [sum(rnd.choice([0, 0, 1, 128, 255]) << 8 * n for n in range(8)) for _ in a]
        rows.append((k, a, [x ^ (m - (1 << 64) if m >> 63 else m) for x, m in zip(a, masks)]))
    frame = spark.createDataFrame(rows, "k int, a array<bigint>, b array<bigint>")
    got = {r.k for r in frame.filter(line_dedup.alike(F.col("a"), F.col("b"))).collect()}
    differing = {k: sum((x ^ y) >> 8 * n & 255 != 0 for x, y in zip(a, b) for n in range(8)) for k, a, b in rows}
    assert got == {k for k, n in differing.items() if n <= line_dedup.BANDS * line_dedup.ROWS - line_dedup.AGREEING}
    assert 0 < len(got) < len(rows)


def test_pairs_are_verified_by_hashed_shingles(spark):
    lines = variants(7, 12, 6) + ["ab", "abc", "aaaaaaaaaaaaaaaaaaaa", "aaaaaaaaa", "é" * 9 + "x", "é" * 10 + "x", "12345678", "123456789"]
    lines = sorted(set(lines))
    texts = line_dedup.sketched(spark.createDataFrame(list(enumerate(lines)), "_node long, _line string"))
    assert {r._node: r._n for r in texts.collect()} == {k: len(shingles(line)) for k, line in enumerate(lines)}
    pairs = spark.createDataFrame([(u, v) for v in range(len(lines)) for u in range(v)], "u long, v long")
    found = line_dedup.similar(pairs, texts)
    got = sorted((r.u, r.v) for r in found.collect())
    assert got == sorted((u, v) for v in range(len(lines)) for u in range(v) if jaccard(lines[u], lines[v]) >= line_dedup.SIMILARITY)
    assert 0 < len(got) < len(lines) * (len(lines) - 1) // 2
    for df in (texts, found):  # patterns cut shingles several times slower
        assert "regexp_extract_all" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_joins_of_crowded_buckets_are_compiled(spark, monkeypatch):
    joined, pairs_of = [], line_dedup._pairs

    def kept(*args):
        joined.append(pairs_of(*args))
        return joined[-1]

    monkeypatch.setattr(line_dedup, "_pairs", kept)
    rows = list(enumerate(variants(1, 60, 3)))
    assert classes(spark, rows) == brute_force(rows)
    assert len(joined) == 2  # with the pivots, and of the lines apart from them
    wanted = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        for df in joined:
            code = spark._jvm.PythonSQLUtils.explainString(df.select("u", "v")._jdf.queryExecution(), "codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
            assert "SortMergeJoin" in code and 0 < max(sizes) < 8000  # the JVM never compiles larger methods
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_candidates_of_small_buckets(spark):
    rows = [(b, n, [n * low] * 4) for b, (nodes, low) in enumerate([([1, 2, 3], 0), ([2, 3, 5], 0), ([7, 8], 1), ([9], 0),
                                                                    ([11, 12], 0x0101010101010101)]) for n in nodes]
    frame = spark.createDataFrame(rows, "_band long, _node long, _low array<bigint>").withColumn("_n", F.lit(3))
    got = sorted((r.u, r.v) for r in line_dedup.pairs_within(frame).collect())
    assert got == [(1, 2), (1, 3), (2, 3), (2, 5), (3, 5), (7, 8)]  # no byte of the minima of 11 and 12 agrees
    # compared by generated code, not by functions over arrays of rows
    assert "transform" not in line_dedup.pairs_within(frame)._jdf.queryExecution().optimizedPlan().toString()
