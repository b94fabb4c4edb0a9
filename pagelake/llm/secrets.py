"""Secret scan: all rules in one pass of a combined automaton.

The rules' detection patterns are compiled once into one minimal automaton
(:mod:`pagelake.llm.automaton`).  A task scans its texts' bytes once for all rules;
for the few (text, rule) pairs that the automaton reports, the rule's own pattern
then gives the exact spans in code points.  A detection pattern accepts every text
in which its rule has a valid match, so nothing is missed.  Where a long minimum
length would multiply the automaton's states, detection asks for a shorter one.

Base kinds: ``assign``, ``access``, ``hex``; the method adds ``pem``, ``github``,
``slack``, ``google``, ``stripe`` and ``jwt``.  Spans
of one kind do not overlap; spans of different kinds may.  A null text counts as
empty.  Repeated rows give repeated results; texts are scanned whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pagelake.llm.automaton import BREAK, compile_rules, scan
from pagelake.llm.common import joined_spans, on_workers, slices


@dataclass(frozen=True)
class Rule:
    """A kind of secret: what the automaton looks for, and the exact pattern with its check."""

    kind: str
    detect: str
    exact: str
    valid: Callable[[re.Match], bool] = lambda match: True
    either_case: bool = False
    base: bool = False


# The patterns of the rules.
_KEYWORD = "(password|passwd|secret|token|api_?key)"
RULES = (
    Rule("assign", _KEYWORD + "[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{6}",
         "(?i:" + _KEYWORD + ")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
         lambda m: len(m.group(2)) >= 6, either_case=True, base=True),
    Rule("access", "AKIA[A-Z0-9]{4}", "AKIA[A-Z0-9]+", lambda m: m.end() - m.start() >= 20, base=True),
    Rule("hex", "[0-9a-f]{24}", "[0-9a-f]+", lambda m: m.end() - m.start() >= 24, base=True),
    Rule("pem", "-----BEGIN ", "-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{4}", "gh[pousr]_[A-Za-z0-9]+", lambda m: m.end() - m.start() >= 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9]", "xox[abprs]-[A-Za-z0-9][A-Za-z0-9-]+",
         lambda m: m.end() - m.start() >= 20),
    Rule("google", "AIza[A-Za-z0-9_-]{4}", "AIza[A-Za-z0-9_-]+", lambda m: m.end() - m.start() >= 39),
    Rule("stripe", "[rs]k_(live|test)_[A-Za-z0-9]{4}", "[rs]k_(?:live|test)_[A-Za-z0-9]+",
         lambda m: m.end() - m.start() >= 24),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{4}", "eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+",
         lambda m: m.end() - m.start() >= 32),
)
KINDS = [r.kind for r in RULES]
BASE = [r.kind for r in RULES if r.base]


@cache
def _exact() -> list[re.Pattern]:
    return [re.compile(r.exact, re.ASCII) for r in RULES]


def spans_of(text: str, rules: Iterable[int]) -> list[tuple[str, int, int]]:
    """The spans of some rules in a text, by start, then in the order of the rules."""
    found = [(m.start(), k, m.end()) for k in rules for m in _exact()[k].finditer(text) if RULES[k].valid(m)]
    return [(KINDS[k], start, end) for start, k, end in sorted(found)]


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Texts as one byte buffer, each followed by BREAK; where each begins."""
    parts = [s.as_py() or b"" for s in texts.cast(pa.binary())]
    starts = np.cumsum([0, *(len(p) + 1 for p in parts)])[:-1]
    joined = bytes([BREAK]).join([*parts, b""])
    return np.frombuffer(joined, np.uint8), starts


def rules_by_text(automaton: dict[str, np.ndarray], texts: pa.Array) -> dict[int, list[int]]:
    """For each text in which the automaton reports something: the rules reported."""
    data, starts = buffer_of(texts)
    hits = scan(automaton, data)
    at = np.flatnonzero(hits)
    if not len(at):
        return {}
    row = np.searchsorted(starts, at, side="right") - 1
    first = np.flatnonzero(np.diff(row, prepend=-1))
    masks = np.bitwise_or.reduceat(hits[at], first)
    return {r: [k for k in range(len(RULES)) if m >> k & 1]
            for r, m in zip(row[first].tolist(), masks.tolist(), strict=True)}


def detector() -> dict[str, np.ndarray]:
    """The automaton of all rules."""
    return compile_rules([(r.detect, r.either_case) for r in RULES])


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType())]))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """One row per document: its id and its ``secrets`` (array of kind, start, end in code points).

    With ``digests`` the counts of the base kinds and all spans as text instead.
    """
    spark = docs.sparkSession
    on_workers(spark)
    automaton = spark.sparkContext.broadcast(detector())  # some hundred kilobytes, fixed by the rules
    narrow = docs.select(id_col, text_col)
    more = ([*(T.StructField(f"n_{k}", T.LongType()) for k in BASE), T.StructField("base_sha256", T.StringType()),
             T.StructField("spans", T.StringType())] if digests else [T.StructField("secrets", SPANS)])
    schema = T.StructType([narrow.schema[id_col], *more])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            texts = batch.column(text_col)
            if isinstance(texts, pa.ChunkedArray):
                texts = texts.combine_chunks()
            reported = rules_by_text(automaton.value, texts)
            found: list[list] = [[] for _ in range(batch.num_rows)]
            for row, rules in reported.items():
                found[row] = spans_of(texts[row].as_py(), rules)
            if digests:
                columns = [pa.array([sum(s[0] == kind for s in spans) for spans in found], pa.int64())
                           for kind in BASE]
                base = [joined_spans(s for s in spans if s[0] in BASE) for spans in found]
                columns.append(pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base]))
                columns.append(pa.array([joined_spans(spans) for spans in found], pa.string()))
            else:
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
                columns = [pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans]
                                     for spans in found], kind)]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), *columns], names=schema.names)

    return narrow.mapInArrow(rows, schema)


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced by a mark; all other columns stay."""
    spark = docs.sparkSession
    on_workers(spark)
    automaton = spark.sparkContext.broadcast(detector())
    names = docs.columns

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            texts = batch.column(text_col).to_pylist()
            for row, rules in rules_by_text(automaton.value, batch.column(text_col)).items():
                out, upto = [], 0
                for _, start, end in spans_of(texts[row], rules):
                    if end > upto:
                        if start >= upto:
                            out += [texts[row][upto:start], mark]
                        upto = end
                texts[row] = "".join([*out, texts[row][upto:]])
            columns = dict(zip(names, batch.columns, strict=True))
            columns[text_col] = pa.array(texts, pc.cast(batch.column(text_col), pa.string()).type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return docs.mapInArrow(rows, docs.schema)
