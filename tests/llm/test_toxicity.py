import zlib

import numpy as np
from cases import documents, odd_rows, prose

from pagelake.llm import toxicity
from pagelake.llm.common import table


def test_held_out_accuracy(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", n) for n in ("documents", "labels"))
    rows = toxicity.score_documents(docs, toxicity.learn(docs, labels)).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out]
    share = np.mean([r.toxic for r in held])
    assert np.mean([r.predicted == r.toxic for r in held]) > 1 - share / 2
    assert np.mean([r.predicted for r in held if not r.toxic]) < 0.03


def learned():
    toxic = [prose(k, 9 + k % 50) + " " + w + " " + prose(k + 500, 40) for k, w in enumerate(["vileword", "grimslur"] * 40)]
    plain = [prose(k + 2000, 40 + k % 60) for k in range(160)]
    return toxicity.fit(toxic + plain, [1] * 80 + [0] * 160)


def test_new_texts_with_known_words_stand_out():
    model = learned()
    scores = model.scores([prose(9000, 50) + " vileword", prose(9001, 50), None, "", "GrimSlur " + prose(9002, 70)])
    assert scores[0] > 0.5 > scores[1] and scores[4] > 0.5
    assert scores[2] == scores[3] < 0.5


def test_odd_rows_and_missing_classes(spark):
    docs = documents(spark, odd_rows())
    got = toxicity.score_documents(docs, learned()).collect()
    assert len(got) == len(odd_rows()) and not any(r.held_out for r in got if r.doc_id is None)
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (6, None)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)  # one class only: the share of its labels
    assert set(model.scores(["a", None])) == {1.0}
    nothing = toxicity.learn(docs, labels.limit(0))
    assert set(nothing.scores(["a", None])) == {0.0}
    assert toxicity.score_documents(documents(spark, []), nothing).count() == 0


def test_learning_sample_is_bounded_and_held_out_rows_are_not_used(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TOXIC_DOCUMENTS", 3)
    monkeypatch.setattr(toxicity, "ORDINARY_DOCUMENTS", 5)
    seen = {}
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels, share: seen.update(t=texts, y=labels, s=share))
    docs = documents(spark, [(k, f"text {k}") for k in range(100)])
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(100)], "doc_id long, toxic int")
    toxicity.learn(docs, labels)
    assert sorted(seen["y"]) == [0] * 5 + [1] * 3
    assert all(zlib.crc32(t.split()[1].encode()) % 5 for t in seen["t"])
    used = [k for k in range(100) if zlib.crc32(str(k).encode()) % 5]
    assert abs(seen["s"] - np.mean([k % 4 == 0 for k in used])) < 1e-9


def test_recall_of_minority_languages(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", n) for n in ("documents", "labels"))
    rows = toxicity.score_documents(docs, toxicity.learn(docs, labels)).join(labels, "doc_id").join(
        docs.select("doc_id", "lang"), "doc_id").filter("held_out and toxic = 1").distinct().collect()
    for lang in ("en", "de", "fr", "es"):
        assert np.mean([r.predicted for r in rows if r.lang == lang]) > 0.5, lang


def test_typical_words_do_not_depend_on_the_commonest():
    own = [[b"insult"]] * 185 + [[b"rareslur"]] * 15
    other = [[b"plain"]] * 1000
    assert toxicity.typical_words(own, other) == {b"insult", b"rareslur"}


def test_dictionaries_see_whole_texts():
    late = [toxicity.words_of(prose(k, 300) + " latecoming passage of every ordinary text") for k in range(200)]
    model = toxicity.dictionaries([[b"insult"]] * 40, late)
    assert b"LATECOMI" in model.ordinary


def test_language_source_and_ids_are_no_inputs(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.01", n) for n in ("documents", "labels"))
    model = toxicity.learn(docs, labels)
    plain = {r.doc_id: r.score for r in toxicity.score_documents(docs, model).collect()}
    other = docs.selectExpr("doc_id + 1000000 as doc_id", "text", "reverse(source) as lang", "lang as source", "n_chars")
    moved = {r.doc_id - 1_000_000: r.score for r in toxicity.score_documents(other, model).collect()}
    assert moved == plain
    again = toxicity.learn(docs.selectExpr("doc_id", "text", "'xx' as lang", "lang as source"), labels)
    assert {r.doc_id: r.score for r in toxicity.score_documents(docs, again).collect()} == plain


def test_rows_of_one_id_do_not_pass_the_bound(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TOXIC_DOCUMENTS", 4)
    monkeypatch.setattr(toxicity, "ORDINARY_DOCUMENTS", 6)
    seen = {}
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels, share: seen.update(t=texts, y=labels))
    rows = [(1, f"text {k}") for k in range(300)] + [(1, "text 0")] * 200 + [(2, "other")]
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    toxicity.learn(documents(spark, rows), labels)
    assert len(seen["t"]) == len(set(seen["t"])) <= 10 and set(seen["y"]) == {0, 1}
