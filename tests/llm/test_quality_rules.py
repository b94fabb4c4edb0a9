from cases import SF, documents, odd_rows, prose
from hypothesis import given
from hypothesis import strategies as st

from pagelake.llm import quality_rules as q
from pagelake.llm.common import table


def slow_repeats(words):
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return len(covered)


@given(st.lists(st.sampled_from(["a", "b", "c"]), max_size=40))
def test_repeated_words_match_slow_count(words):
    assert q.repeated_words(words) == slow_repeats(words)


def test_line_rules():
    good = "This is a plain sentence, with more than a few words in it."
    for bad in ("a ### b *** c %%% d", "WOW!! SUCH!! LINE!! HERE!!", "Home About", "of of in in to to it it",
                "Please click here to go on.", "one | two | three | four"):
        assert q.line_fails(bad, bad.encode().split()), bad
    assert not q.line_fails(good, good.encode().split())
    stats, cleaned = q.judge(good + "\n\nHome About\n" + good)
    assert cleaned == good + "\n\n" + good
    assert stats["n_dup_lines"] == 1 and stats["lost_chars"] == len("HomeAbout")


def test_loss_and_base_rules_reject():
    lines = [f"{prose(i, 20)}." for i in range(5)]
    assert q.judge("\n".join(lines))[0]["kept"]
    assert not q.judge("\n".join([lines[0], *["x ### y *** z %%% w"] * 30]))[0]["kept"]
    assert q.judge("only a few words.")[0]["base_failed"]


def test_odd_rows(spark):
    rows = {(r.doc_id, r.n_words): r for r in q.quality_stats(documents(spark, odd_rows())).collect()}
    assert rows[(1, 0)].base_failed and not rows[(1, 0)].kept and rows[(1, 0)].word_chars == 0
    assert rows[(8, 30_000)].n_words == 30_000
    assert len(q.quality_stats(documents(spark, odd_rows())).collect()) == len(odd_rows())
    kept = q.clean_documents(documents(spark, odd_rows()))
    assert kept.columns == documents(spark, odd_rows()).columns
    assert {r.doc_id for r in kept.collect()} <= {None, 4, 5, 8, 10}
    assert q.clean_documents(documents(spark, [])).count() == 0 == q.quality_stats(documents(spark, [])).count()


def test_cleaned_texts_match_the_judgement(spark):
    docs = table(spark, SF, "documents")
    expected = sorted((r.doc_id, q.judge(r.text)[1]) for r in docs.collect() if q.judge(r.text)[0]["kept"])
    got = q.clean_documents(docs).collect()
    assert sorted((r.doc_id, r.text) for r in got) == expected
    assert all(r.n_chars == len(r.text) for r in got)
