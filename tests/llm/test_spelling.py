import random
import zlib
from collections import Counter

import pytest
from cases import SF, documents, odd_rows

from pagelake.llm import spelling as S
from pagelake.llm.common import table



def words_of(text):
    out, run = [], ""
    for c in (text or "") + " ":
        if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
            run += c.lower() if c <= "Z" else c
        elif run:
            out.append(run)
            run = ""
    return out


def brute_force(rows, damage=31, ratio=10):
    n = Counter()
    for doc_id, text in rows:
        for w in words_of(text):
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{w}".encode())
            if h % damage == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    by_rest = {}  # words meet in what a deletion leaves of them
    for w in n:
        for at in range(len(w)):
            by_rest.setdefault((w[:at] + w[at + 1:], at), set()).add(w)
    near = {w: set() for w in n}
    for (_, _), some in by_rest.items():
        for w in some:
            near[w] |= some - {w}
    for w in n:
        for at in range(len(w)):
            short = w[:at] + w[at + 1:]
            if short in n:
                near[w].add(short)
                near[short].add(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def result(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def crafted():
    """Chains of ever rarer variants, ties, runs of equal letters, accents, and words at the least length."""
    rnd = random.Random(5)
    base = ["letterbox", "bookkeeper", "aaaaaaaa", "mississippi", "éclairéà", "öffnung", "seventh", "eleventh"]
    words = []
    for w in base:
        for k, times in ((0, 300), (1, 25), (2, 2)):
            for _ in range(3):
                v = w
                for _ in range(k):
                    at, kind = rnd.randrange(len(v)), rnd.randrange(3)
                    v = v[:at] + ("" if kind == 0 else rnd.choice("abeé")) + v[at + (kind < 2):]
                words += [v] * times
    rnd.shuffle(words)
    return [(i, " ".join(words[i::40])) for i in range(40)]


@pytest.mark.parametrize("crowded", [128, 2])
def test_crafted_words(spark, monkeypatch, crowded):
    rows = crafted()
    docs = documents(spark, rows)
    for damage in (31, 3):
        expected = brute_force(rows, damage)
        assert any(f for f, *_ in expected.values()) and any(r != f for f, r, *_ in expected.values() if f)
        if crowded == 128:
            assert result(S.variants(docs, damage=damage)) == expected
        else:  # every signature that two words share takes the way of the crowded ones
            words = spark.createDataFrame([(w, v[2]) for w, v in expected.items()], "word string, n long")
            pairs = S.crowded_pairs(S.signature_rows(words))
            near = Counter((r.word, r.other) for r in pairs.collect())
            assert set(near.values()) <= {1}
            assert Counter(w for w, _ in near) == Counter({w: v[3] for w, v in expected.items() if v[3]})


def test_both_ways_agree_in_a_stream():
    """Rows of one signature over many batches: crowded ones pass through, the others are compared whole."""
    import pyarrow as pa

    words = [f"a{chr(97 + i)}{chr(97 + j)}defgh" for i in range(20) for j in range(20)]
    def batches(names, key):
        for at in range(0, len(names), 7):
            some = names[at:at + 7]
            yield pa.RecordBatch.from_arrays([pa.array([key] * len(some)), pa.array([0] * len(some), pa.int32()),
                                              pa.array(some), pa.array([1] * len(some))], names=["signature", "code", "word", "n"])
    out = [r for b in S.met([*batches(words, 5), *batches(words[:3], 6)]) for r in b.to_pylist()]
    passed = [r["word"] for r in out if r["other"] is None]
    assert passed == words


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(S.variants(docs, damage=S.DAMAGE)) == brute_force(rows)


def test_odd_rows(spark):
    rows = [*odd_rows(), (20, "Ünterwegs ünterwegs " + "z" * 3000 + " " + "z" * 3000 + "y " + "z" * 3000 + "y"),
            (21, "z" * 3000 + " x×÷yzabc x×÷yzabc")]
    got = result(S.variants(documents(spark, rows), damage=S.DAMAGE))
    assert got == brute_force(rows)
    assert got["z" * 3000][3] == 1 and "x×÷yzabc" in got
    assert S.variants(documents(spark, rows).limit(0)).collect() == []
