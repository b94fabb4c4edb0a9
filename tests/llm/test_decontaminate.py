import random

import numpy as np
from cases import SF, documents, odd_rows, prose
from hypothesis import given
from hypothesis import strategies as st

from pagelake.llm import decontaminate as d
from pagelake.llm.common import table


def slow_distance(item, passage):
    """Least edits between the item and any beginning of the passage."""
    row = list(range(len(passage) + 1))
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(passage, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


@given(st.lists(st.integers(1, 3), min_size=1, max_size=9), st.lists(st.integers(1, 3), max_size=12), st.integers(0, 4))
def test_edit_distance(item, passage, most):
    passage = passage[:len(item) + most]
    got = d.edit_distances(np.array([item]), np.array([passage], np.int64).reshape(1, -1), most)[0]
    assert got == min(slow_distance(item, passage), most + 1)


def edited(words, edits, rnd):
    words = list(words)
    for _ in range(edits):
        at, kind = rnd.randrange(len(words)), rnd.randrange(3)
        if kind == 0:
            words[at] = "other"
        elif kind == 1:
            words.insert(at, "more")
        elif len(words) > 1:
            del words[at]
    return words


def test_recall_at_the_most_edits():
    rnd = random.Random(4)
    items = [prose(k, 8 + k) for k in range(50)]
    block = d.Block([d.words_of(t) for t in items])
    found = tried = 0
    for k, item in enumerate(items):
        for _ in range(6):
            words = edited(item.split(), d.edits_allowed(8 + k), rnd)
            text = prose(rnd.random(), 30) + " " + " ".join(words) + " " + prose(rnd.random(), 30)
            tried += 1
            found += any(i == k for _, i, *_ in block.search([text]))
    assert found / tried >= 0.95


def kind_edited(words, edits, kind, rnd):
    words = list(words)
    for _ in range(edits):
        at, edit = rnd.randrange(len(words)), kind if kind < 3 else rnd.randrange(3)
        if edit == 0:
            words[at] = "other"
        elif edit == 1:
            words.insert(at, "more")
        elif len(words) > 1:
            del words[at]
    return words


def test_every_kind_of_edit_is_found_on_the_real_items(spark):
    """Replaced, inserted, deleted and mixed words apart, with the most edits, in running text and at its end."""
    items = [w for w in (d.words_of(r.text) for r in table(spark, "/root/testdata/sf0.01", "benchmark").collect()) if w]
    block = d.Block(items)
    rnd = random.Random(11)
    for kind in range(4):
        texts, wanted = [], []
        for k, item in enumerate(items):
            for copy in range(8):
                words = kind_edited([w.decode() for w in item], d.edits_allowed(len(item)), kind, rnd)
                texts.append(prose(rnd.random(), 20) + " " + " ".join(words) + (" " + prose(rnd.random(), 20) if copy % 2 else ""))
                wanted.append(k)
        found = {(t, i) for t, i, *_ in block.search(texts)}
        got = sum((t, k) in found for t, k in enumerate(wanted)) / len(wanted)
        assert got >= 0.97, (kind, got)
    hard = d.Block([[f"w{k}".encode() for k in range(59)]])
    texts = [" ".join(kind_edited([f"w{k}" for k in range(59)], 11, 2, rnd)) for _ in range(200)]
    assert len({t for t, *_ in hard.search(texts)}) >= 194


def test_a_text_is_searched_alone():
    """What stands in the texts beside it changes nothing, also for passages at the end of a text."""
    rnd = random.Random(12)
    items = [d.words_of(prose(k, 15 + k)) for k in range(25)]
    block = d.Block(items)
    texts = [prose(rnd.random(), 10) + " " + " ".join(kind_edited([w.decode() for w in items[k % 25]],
             d.edits_allowed(15 + k % 25), k % 4, rnd)) for k in range(160)]
    together = {}
    for t, *rest in block.search(texts):
        together.setdefault(t, []).append(rest)
    for t, text in enumerate(texts):
        assert [r[1:] for r in map(list, block.search([text]))] == together.get(t, [])


def test_short_items_are_sought_exactly():
    block = d.Block([[b"one"], [b"two", b"words"], [b"now", b"three", b"words"]])
    got = [(t, i, e) for t, i, e, _ in block.search(["say two words", "two other words", "one", "now three words", None, ""])]
    assert got == [(0, 1, 0), (2, 0, 0), (3, 2, 0)]


def test_long_items_are_found_at_the_most_edits():
    rnd = random.Random(5)
    for n in (500, 1000):
        item = [f"w{rnd.randrange(5000)}" for _ in range(n)]
        texts = [" ".join(edited(item, d.edits_allowed(n), rnd)) for _ in range(25)]
        block = d.Block([d.words_of(" ".join(item))])
        size = block.sizes[0]
        windows = []
        for text in texts:
            words = [block.vocabulary.get(w, d.UNKNOWN) for w in d.words_of(text)][:n]
            windows.append(words + [d.UNKNOWN] * (n - len(words)))
        row, _ = size.candidates(np.array(windows))
        assert len(set(row.tolist())) == len(texts)
        if n == 500:
            assert {t for t, *_ in block.search(texts[:1])} == {0}


def test_whole_table_against_brute_force(spark):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    got = {(r.doc_id, r.item_id): r for r in d.find_leaks(docs, bench).collect()}
    items = [(r.item_id, d.words_of(r.text)) for r in bench.collect()]
    exact = 0
    for r in docs.collect():
        words = d.words_of(r.text)
        joined = b" " + b" ".join(words) + b" "
        for i, item in items:
            if len(item) >= d.LEAST_WORDS and b" " + b" ".join(item) + b" " in joined:
                exact += 1
                assert got[(r.doc_id, i)].edits == 0
    assert exact
    by_id = {r.doc_id: d.words_of(r.text) for r in docs.collect()}
    for (doc, i), r in got.items():  # every reported passage is within the allowed edits
        item = dict(items)[i]
        passage = by_id[doc][r.first_word:r.first_word + len(item) + d.edits_allowed(len(item))]
        assert slow_distance(item, passage) == r.edits <= d.edits_allowed(len(item))


def test_odd_rows_and_blocks(spark, monkeypatch):
    bench = spark.createDataFrame([(1, prose(1, 60)), (2, None), (3, "too short"), (None, prose(8, 30)), (5, prose(1, 60))],
                                  "item_id long, text string")
    rows = [*odd_rows(), (20, "start " + prose(8, 30).upper() + ", end")]
    got = sorted((tuple(r)[:3] for r in d.find_leaks(documents(spark, rows), bench).collect()), key=str)
    assert got == sorted([(i, k, 0) for i in (None, 4, 5, 5) for k in (1, 5)] + [(20, None, 0)], key=str)
    monkeypatch.setattr(d, "BLOCK_WORDS", 65)
    assert len(list(d.blocks_of(bench, "item_id", "text"))) == 3
    assert sorted((tuple(r)[:3] for r in d.find_leaks(documents(spark, rows), bench).collect()), key=str) == got
    docs = documents(spark, rows)
    kept = d.clean_documents(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in rows if i not in (4, 5, 20)
                                                                   and not (i is None and _))
    assert d.find_leaks(documents(spark, []), bench).count() == 0
    assert d.find_leaks(docs, bench.limit(0)).count() == 0
    assert d.clean_documents(docs, bench.limit(0)).count() == len(rows)
