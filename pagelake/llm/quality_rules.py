"""Line-first quality rules.

Every line that has a word is judged by itself (symbols, exclamation marks,
stuttered words, navigation, boilerplate); failing lines are removed, and a document goes when it
loses too much of its text, or fails a rule on its whole text (too few words, too
many words in repeated five-word windows).

Words are ``[^\\x20\\x09-\\x0D]+``, lines are split at ``\\n``; lines without a word
are neither judged nor removed.  A null text counts as empty: no words, so it is
rejected.  Repeated rows are judged one by one.  Texts are handled whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from operator import eq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pagelake.llm.common import WHITE, on_workers, slices

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_LOST_PERCENT = 30
NAVIGATION_WORDS = 3
BOILERPLATE_WORDS = 30
WINDOW = 5
# Symbols counted by the contract, sentence ends, and phrases of page furniture.
SYMBOLS = "#*$%&|<>"
TERMINAL = ".!?:;\"'”’»)]…"
BOILERPLATE = ("all rights reserved", "terms of service", "terms of use", "privacy policy", "cookie policy",
               "accept cookies", "enable javascript", "click here", "sign up for our newsletter",
               "subscribe to our newsletter", "skip to content", "lorem ipsum")

_SYMBOL = re.compile("[" + re.escape(SYMBOLS) + "]")
_PHRASE = re.compile("|".join(map(re.escape, BOILERPLATE)))
_LOWER = {c: c + 32 for c in range(65, 91)}


def line_fails(line: str, words: list) -> bool:
    """Whether a line that has these words is noise."""
    n_words = len(words)
    symbols = len(_SYMBOL.findall(line))
    if symbols >= 3 and 3 * symbols >= n_words:
        return True
    stutters = sum(map(eq, words, words[1:]))
    if stutters >= 3 and 3 * stutters >= n_words:
        return True
    shouts = line.count("!")
    if shouts >= 3 and 2 * shouts >= n_words:
        return True
    if n_words <= NAVIGATION_WORDS and line.rstrip(WHITE)[-1] not in TERMINAL:
        return True
    return n_words <= BOILERPLATE_WORDS and _PHRASE.search(line.translate(_LOWER)) is not None


def repeated_words(words: list) -> int:
    """Words that lie in a five-word window found twice or more in the text."""
    grams = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
    if len(set(grams)) == len(grams):
        return 0
    counts = Counter(grams)
    covered, upto = 0, 0
    for at, gram in enumerate(grams):
        if counts[gram] > 1:
            covered += at + WINDOW - max(at, upto)
            upto = at + WINDOW
    return covered


def judge(text: str | None) -> tuple[dict, str]:
    """The statistics of a text, and the text without its failing lines."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    seen: set[str] = set()
    kept_lines, dup_lines, lost = [], 0, 0
    for line in text.split("\n"):
        own = line.encode("utf-8", "surrogatepass").split()
        if own:
            dup_lines += line in seen
            seen.add(line)
            if line_fails(line, own):
                lost += len(line) - sum(map(line.count, WHITE))
                continue
        kept_lines.append(line)
    chars = len(text) - sum(map(text.count, WHITE))
    repeats = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)
    stats = {"n_words": len(words), "word_chars": chars, "n_symbols": sum(map(text.count, SYMBOLS)),
             "n_dup_lines": dup_lines, "n_repeat_words": repeats, "base_failed": failed,
             "kept": not failed and 100 * lost <= MAX_LOST_PERCENT * chars, "lost_chars": lost}
    return stats, "\n".join(kept_lines)


STATS = T.StructType([T.StructField(n, T.BooleanType() if n in ("base_failed", "kept") else T.LongType()) for n in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars")])


def quality_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, the statistics and the verdict (``kept``)."""
    on_workers(docs.sparkSession)
    narrow = docs.select(id_col, text_col)
    schema = T.StructType([narrow.schema[id_col], *STATS.fields])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            found = [judge(t)[0] for t in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), *(pa.array([s[f.name] for s in found],
                                                  pa.bool_() if f.dataType == T.BooleanType() else pa.int64())
                                         for f in STATS.fields)], names=schema.names)

    return narrow.mapInArrow(rows, schema)


def clean_documents(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The documents that pass, without their failing lines; all other columns stay as they are.

    ``chars_col``, where the table has it, is set to the length of the cleaned text.
    """
    on_workers(docs.sparkSession)
    names = docs.columns

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            judged = [judge(t) for t in batch.column(text_col).to_pylist()]
            keep = pa.array([s["kept"] for s, _ in judged], pa.bool_())
            columns = dict(zip(names, batch.columns, strict=True))
            columns[text_col] = pa.array([t for _, t in judged], batch.schema.field(text_col).type)
            if chars_col in columns:
                columns[chars_col] = pa.array([len(t) for _, t in judged]).cast(batch.schema.field(chars_col).type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names).filter(keep)

    return docs.mapInArrow(rows, docs.schema)
