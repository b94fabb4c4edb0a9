import corpus_pipeline
import numpy as np
import public_tokenizers
import test_line_dedup
import test_simhash
from cases import SF, documents, odd_rows
from tokenizers import Tokenizer

import __spark_entry__
from pagelake.llm import decontaminate, quality_rules
from pagelake.llm.common import table

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def brute_force(rows, items):
    """The whole pipeline on (id, text) rows with distinct ids, without any of its shortcuts."""
    rows = [(i, quality_rules.judge(t)[1]) for i, t in rows if quality_rules.judge(t)[0]["kept"]]
    gone = {}
    for (_, i, k), first in test_line_dedup.brute_force(rows):
        if first != (False, i, k):
            gone.setdefault(i, set()).add(k)
    rows = [(i, "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(i, ()))) for i, t in rows]
    prints = {t: test_simhash.slow_fingerprint(t) for _, t in rows}
    union = test_simhash.components(sorted(set(prints.values())))
    first = {}
    for i, t in sorted(rows):
        first.setdefault(union.find(prints[t]), i)
    rows = [(i, t) for i, t in rows if i in set(first.values())]
    out = {}
    for i, t in rows:
        joined = b" " + b" ".join(decontaminate.words_of(t)) + b" "
        if not any(b" " + item + b" " in joined for item in items):
            out[i] = t
    return out


def test_run_matches_brute_force(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    items = [decontaminate.words_of(r.text) for r in table(spark, SF, "benchmark").collect()]
    items = [b" ".join(w) for w in items if len(w) >= decontaminate.LEAST_WORDS]
    expected = brute_force([tuple(r) for r in docs], items)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == set(expected)
    for i, text in expected.items():
        assert got[i].decoded == text
        assert np.array_equal(got[i].ids, LIBRARY.encode(text, add_special_tokens=False).ids)


def test_stages_keep_the_columns_and_cope_with_odd_rows(spark):
    for docs in (documents(spark, odd_rows()), documents(spark, [])):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            out.count()
    last = corpus_pipeline.STAGES[-1][1](spark, documents(spark, odd_rows()), SF)
    assert last.count() == len(odd_rows())


def test_registered():
    names = __spark_entry__.queries()
    assert names["pipeline"] is corpus_pipeline.run
    assert [n.split("_")[0] for n in names if n.startswith("op")] == [f"op{k}" for k in range(1, 14)]
