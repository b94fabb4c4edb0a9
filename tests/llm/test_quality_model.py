import math
import random
from collections import Counter, defaultdict

import numpy as np
from cases import SF, documents, odd_rows, prose

from pagelake.llm import quality_model as q
from pagelake.llm.common import table


def slow_model(texts):
    """Interpolated modified Kneser-Ney, straight from its definition."""
    grams = Counter()
    for text in texts:
        s = (q.START,) * (q.ORDER - 1) + tuple(ord(c) for c in text)
        grams.update(s[k:k + q.ORDER] for k in range(len(s) - q.ORDER + 1))
    counts = {q.ORDER: grams}
    for order in range(q.ORDER - 1, 0, -1):
        counts[order] = Counter(g[1:] for g in counts[order + 1])
    cuts, totals, left = {}, {}, {}
    for order, table_ in counts.items():
        n = Counter(v for v in table_.values() if v <= 4)
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        d = [1 - 2 * y * n[2] / n[1] if n[1] else 0.5, 2 - 3 * y * n[3] / n[2] if n[2] else 1.0,
             3 - 4 * y * n[4] / n[3] if n[3] else 1.5]
        cuts[order] = [min(max(x, 0.1), k - 0.1) for k, x in enumerate(d, 1)]
        totals[order], left[order] = defaultdict(float), defaultdict(float)
        for g, c in table_.items():
            totals[order][g[:-1]] += c
            left[order][g[:-1]] += cuts[order][min(c, 3) - 1]

    def p(gram):
        if not gram:
            return 1 / (len(counts[1]) + 1)
        order, context = len(gram), gram[:-1]
        below = p(gram[1:])
        if not totals[order][context]:
            return below
        c = counts[order].get(gram, 0)
        return ((c - cuts[order][min(c, 3) - 1] if c else 0) + left[order][context] * below) / totals[order][context]

    return p


def test_probabilities_match_the_definition(spark):
    texts = [prose(k, 30) for k in range(8)] + ["", "ab"]
    docs = documents(spark, list(enumerate(texts)))
    model = q.train(docs)
    p = slow_model([t for t in texts if t])
    held = q.Model(model.toArrow())
    for text in (prose(99, 20), "zzz unseen? é", texts[0]):
        s = (q.START,) * (q.ORDER - 1) + tuple(map(ord, text))
        expected = [math.log(p(s[k:k + q.ORDER])) for k in range(len(text))]
        assert np.allclose(held.log_probabilities(q.symbols([text])[0]), expected)
    # the probabilities of all symbols and the unseen one sum to 1 after any context
    for context in ("the ", "zzzz"):
        symbols = sorted({c for t in texts for c in t})
        assert abs(sum(p(tuple(map(ord, context + c))) for c in symbols) + p(tuple(map(ord, context)) + (0x3FF,)) - 1) < 1e-9


def test_both_ways_of_scoring_agree(spark):
    docs = documents(spark, [*odd_rows()[:8], *[(100 + k, prose(k, 25)) for k in range(6)]])
    model = q.train(docs.filter("doc_id >= 100"))
    a = q.score(docs, model).select("doc_id", "perplexity").collect()
    b = q.score(docs, model, sent_rows=0).select("doc_id", "perplexity").collect()

    def key(rows):
        return sorted((str(r.doc_id), -1.0 if r.perplexity is None else round(r.perplexity, 8)) for r in rows)

    assert key(a) == key(b)


def test_hash_table():
    rnd = random.Random(1)
    keys = np.array(sorted({rnd.getrandbits(60) for _ in range(5000)}))
    found = q.Table(keys, np.arange(len(keys), dtype=float))
    assert np.array_equal(found.find(keys), np.arange(len(keys)))
    assert np.isnan(found.find(keys + 1)[~np.isin(keys + 1, keys)]).all()
    assert np.isnan(q.Table(keys[:0], np.zeros(0)).find(keys[:3])).all()


def test_junk_goes_and_clean_documents_stay(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    rows = q.classify(docs, labels).join(labels, "doc_id").collect()
    clean, junk = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert np.mean(clean) > 0.98
    assert np.mean(junk) < 0.2


def test_unseen_clean_documents_of_rare_languages_stay(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    good = labels.filter("quality = 1").join(docs.select("doc_id", "lang"), "doc_id").filter("lang = 'es'")
    ids = sorted({r.doc_id for r in good.collect()})
    hidden = ids[:len(ids) // 2]
    rows = q.classify(docs, labels.filter(~labels.doc_id.isin(hidden))).filter("lang = 'es'").collect()
    assert np.mean([r.kept for r in rows if r.doc_id in set(hidden)]) > 0.85


def test_odd_rows(spark):
    docs = documents(spark, odd_rows())
    labels = spark.createDataFrame([(4, 1), (8, 1), (None, 1), (5, None)], "doc_id long, quality int")
    rows = q.classify(docs, labels).collect()
    assert len(rows) == len(odd_rows())
    assert all(r.perplexity is None and not r.kept for r in rows if r.doc_id in (1, 2))
    assert all(r.threshold is not None for r in rows)
    none = q.classify(docs, labels.limit(0)).collect()
    assert len(none) == len(odd_rows()) and not any(r.kept for r in none)
    assert q.classify(documents(spark, []), labels).count() == 0
    assert table(spark, SF, "documents").count()
