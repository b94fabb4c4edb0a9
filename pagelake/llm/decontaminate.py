"""Benchmark decontamination: edit distance by random-walk embedding and bit sampling.

Texts are words (ASCII letters lower-cased, ASCII signs dropped).  A document leaks an
item if a passage of it is within ``MAX_EDITS`` (a share of the item's words) word
edits of the item.  At every word of every document begins a window of the size of each
item:

1. A window must hold nearly all of its words among those of one item of its size, as
   any leak of it does (running sums over the words of all items, then those of that
   size, then of each item with repeats; this loses nothing).
2. Windows and items are embedded by the CGK random walk: a walk over the words that
   moves on or stays by a random bit of (step, word) writes the word it stands on, so
   that few edits become few differing places.  Repeated bit sampling of two places per
   repetition gives candidates.  The number of repetitions is chosen, size by size, by
   embedding copies of the items with the most edits allowed until :data:`TARGET_RECALL` of them
   are found, of those with only replaced, only inserted, only deleted and mixed words alike.  For a size (long items) of which :data:`WALKS`
   walks do not find that share, every window and item that pass the first step are
   candidates, so no leak is lost.
3. Candidates are verified by the exact edit distance.

The benchmark is the stated query set; it is read in blocks of at most
:data:`BLOCK_WORDS` words, and each block is sought in all documents.  Items
without a word, and null texts, are not sought; items of fewer than five words allow no edit.  Documents with null
or empty text leak nothing.  Repeated rows give repeated results.
"""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.llm.common import on_workers, slices

MAX_EDITS = 0.2
LEAST_WORDS = 1
BLOCK_WORDS = 50_000
TARGET_RECALL = 0.99
WALKS, SAMPLES, PLACES = 24, 6, 2
TRIALS = 1000
#: Bytes of text that are searched at a time.
SEARCHED_BYTES = 16 << 20
#: Window positions whose running sums are looked at together (they stay in the processor's cache).
POSITIONS = 1 << 17
#: Words of windows times words of an item that are compared at a time.
COMPARED = 1 << 26
UNKNOWN, END = 0, -1

_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


def edits_allowed(n: int) -> int:
    return int(MAX_EDITS * n)


class Size:
    """The items of one length: their words, embedding, and the repetitions of bit sampling."""

    def __init__(self, rows: list[int], items: np.ndarray, bits: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        vocabulary = bits.shape[2] - 2
        self.rows, self.items = np.array(rows), items
        self.n = items.shape[1]
        self.edits = edits_allowed(self.n)
        self.length = 2 * self.n
        self.bits = bits
        self.known = np.zeros(vocabulary + 2, bool)
        self.known[items.ravel() + 1] = True
        self.counts = []
        for item in items:
            own, times = np.unique(item.astype(np.int32), return_counts=True)
            known = np.zeros(vocabulary + 2, bool)
            known[own + 1] = True
            self.counts.append((own, times, known))
        self.distinct = min(len(own) for own, *_ in self.counts)
        self.places = rng.integers(0, self.length, (WALKS, SAMPLES, PLACES))
        self.base = vocabulary + 2
        self.own = np.zeros((len(items), 0), np.int64)
        self.walks = self.enough(rng)

    def walk(self, words: np.ndarray, number: int) -> np.ndarray:
        """The embedding of rows of words by one walk: row, step."""
        m, n = words.shape
        padded = np.concatenate([words + 1, np.zeros((m, 1), words.dtype)], axis=1)  # END comes after the last word
        out = np.empty((m, self.length), np.int32)
        at, rows, one = np.zeros(m, np.int64), np.arange(m), np.uint64(1)
        for step in range(self.length):
            word = padded[rows, np.minimum(at, n)]
            out[:, step] = word
            at += (self.bits[number, step >> 6, word] >> np.uint64(step & 63) & one).astype(np.int64)
        return out

    def keys_of(self, words: np.ndarray, number: int) -> np.ndarray:
        """The places that one walk's repetitions sample of each row, as one number per repetition."""
        out = self.walk(words, number).astype(np.int64)
        return np.stack([reduce(lambda key, place: key * self.base + out[:, place], places, np.zeros(len(words), np.int64))
                         for places in self.places[number]], axis=1)

    def keys(self, words: np.ndarray) -> np.ndarray:
        return np.concatenate([self.keys_of(words, number) for number in range(self.walks)], axis=1)

    def edited_copies(self, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
        """(copy, item): windows of copies of the items with the most edits, :data:`TRIALS` of each kind of edit
        (replaced, inserted, deleted, all mixed), kind by kind."""
        pick = random.Random(int(rng.integers(1 << 30)))
        which = [pick.randrange(len(self.items)) for _ in range(4 * TRIALS)]
        copies = np.full((len(which), self.n), UNKNOWN, np.int64)
        for t, item in enumerate(which):
            words, kind = self.items[item].tolist(), t // TRIALS
            for _ in range(self.edits):
                at, edit = pick.randrange(len(words)), kind if kind < 3 else pick.randrange(3)
                if edit == 0:
                    words[at] = UNKNOWN
                elif edit == 1:
                    words.insert(at, UNKNOWN)
                elif len(words) > 1:
                    del words[at]
            words = words[:self.n]
            copies[t, :len(words)] = words
        return copies, np.array(which)

    def enough(self, rng: np.random.Generator) -> int:
        """How many walks find the target share of edited copies, whatever the kind of edit; 0 if :data:`WALKS` do not.

        Leaves the items' keys of these walks in ``own``.
        """
        copies, which = self.edited_copies(rng)
        missed = np.arange(len(which))
        for number in range(WALKS):
            own = self.keys_of(self.items, number)
            self.own = np.concatenate([self.own, own], axis=1)
            missed = missed[~(self.keys_of(copies[missed], number) == own[which[missed]]).any(1)]
            if np.bincount(missed // TRIALS, minlength=4).max() <= (1 - TARGET_RECALL) * TRIALS:
                return number + 1
        return 0

    def promising(self, windows: np.ndarray) -> np.ndarray:
        """Which windows hold nearly all of their words among those of one item, as every leak of it does."""
        least = self.n - self.edits
        some = np.flatnonzero(self.known[windows + 1].sum(1) >= least)
        if len(some):
            ordered = np.sort(windows[some], axis=1)
            distinct = 1 + (np.diff(ordered, axis=1) != 0).sum(1)
            some = some[distinct >= self.distinct - self.edits]  # else a few words over and over
        keep = np.zeros(len(some), bool)
        if len(some):
            words = windows[some]
            for item in range(len(self.counts)):
                rest = np.flatnonzero(~keep)
                keep[rest[self.holding(words[rest], item)]] = True
        return some[keep]

    def holding(self, windows: np.ndarray, item: int) -> np.ndarray:
        """The windows that share nearly all words with an item, repeats included."""
        own, times, known = self.counts[item]
        least = self.n - self.edits
        rows = np.flatnonzero(known[windows + 1].sum(1) >= least)
        step = max(1, COMPARED // (self.n * len(own)))
        found = [some[np.minimum((windows[some][:, :, None] == own).sum(1), times).sum(1) >= least]
                 for some in np.split(rows, range(step, len(rows), step))]
        return np.concatenate(found)

    def candidates(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of windows, item) that agree in some repetition, or all that :meth:`holding` lets through."""
        if self.walks:
            keys = self.keys(windows)
            pairs = [np.flatnonzero((keys == own).any(1)) for own in self.own]
        else:
            pairs = [self.holding(windows, item) for item in range(len(self.items))]
        return (np.concatenate(pairs) if pairs else np.zeros(0, np.int64),
                np.repeat(np.arange(len(pairs)), [len(p) for p in pairs]))


def edit_distances(items: np.ndarray, passages: np.ndarray, most: int) -> np.ndarray:
    """Row by row, the least word edits between an item and any beginning of a passage (``most`` + 1 if more).

    Dynamic programming in a band around the diagonal, all rows side by side.
    """
    m, n = items.shape
    wide = passages.shape[1]
    much = most + 1
    row = np.full((m, wide + 2), much, np.int16)
    row[:, :min(most, wide) + 1] = np.arange(min(most, wide) + 1)
    for i in range(1, n + 1):
        new = np.full_like(row, much)
        if i <= most:
            new[:, 0] = i
        for j in range(max(1, i - most), min(wide, i + most) + 1):
            same = passages[:, j - 1] == items[:, i - 1]
            new[:, j] = np.minimum(np.minimum(row[:, j], new[:, j - 1]) + 1, row[:, j - 1] + ~same)
        row = np.minimum(new, much)
    return row[:, :wide + 1].min(1)


class Block:
    """A block of items, ready to be sought."""

    def __init__(self, texts: list[list[bytes]], seed: int = 7):
        self.vocabulary: dict[bytes, int] = {}
        coded = [[self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words] for words in texts]
        by_size: dict[int, list[int]] = {}
        for row, words in enumerate(coded):
            by_size.setdefault(len(words), []).append(row)
        # random bits of the walks, by walk, step and word: shared by all sizes
        steps = 2 * max(by_size, default=1)
        bits = np.random.default_rng(seed).integers(0, 1 << 64, (WALKS, steps // 64 + 1, len(self.vocabulary) + 2),
                                                    np.uint64)
        self.sizes = [Size(rows, np.array([coded[r] for r in rows], np.int64), bits, seed + n)
                      for n, rows in sorted(by_size.items())]
        sampled = [s for s in self.sizes if s.walks]
        kept = bits[:max((s.walks for s in sampled), default=0),
                    :2 * max((s.n for s in sampled), default=0) // 64 + 1].copy()
        for size in self.sizes:
            size.bits = kept

    def search(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, edits, first word) of every leak; of an item in a text the closest, then the first passage."""
        get = self.vocabulary.get
        coded = [np.array([get(w, UNKNOWN) for w in words_of(t)], np.int32) for t in texts]
        starts = np.cumsum([0, *map(len, coded)])
        reach = max((s.n + s.edits for s in self.sizes), default=0)
        words = np.concatenate([*coded, np.zeros(reach, np.int32)])
        total = np.zeros(len(words) + 1, np.int32)
        np.cumsum(words != UNKNOWN, out=total[1:])

        def within(begin: np.ndarray, n: int) -> np.ndarray:
            """``n`` words from each place on; END behind the last word of its text."""
            place = begin[:, None] + np.arange(n)
            end = starts[np.searchsorted(starts, begin, side="right")]
            return np.where(place < end[:, None], words[place], END)

        best: dict[tuple[int, int], tuple[int, int]] = {}
        places: list[list[np.ndarray]] = [[] for _ in self.sizes]
        for begin in range(0, int(starts[-1]), POSITIONS):  # a part of the running sum at a time, for all sizes
            end = min(begin + POSITIONS, int(starts[-1]))
            for size, found in zip(self.sizes, places, strict=True):
                held = total[begin + size.n:end + size.n] - total[begin:end]
                found.append(np.flatnonzero(held >= size.n - size.edits) + begin)
        for size, found in zip(self.sizes, places, strict=True):
            at = np.concatenate(found) if found else np.zeros(0, np.int64)
            kept = []
            for some in np.split(at, range(4096, len(at), 4096)):
                kept.append(some[size.promising(within(some, size.n))])
            at = np.concatenate(kept)
            for some in np.split(at, range(8192, len(at), 8192)):
                if not len(some):
                    continue
                windows = within(some, size.n)
                row, item = size.candidates(windows)
                begin = some[row]
                text = np.searchsorted(starts, begin, side="right") - 1
                for k in range(0, len(begin), 4096):
                    b, t, i = begin[k:k + 4096], text[k:k + 4096], item[k:k + 4096]
                    found = edit_distances(size.items[i], within(b, size.n + size.edits), size.edits)
                    for r in np.flatnonzero(found <= size.edits).tolist():
                        key = int(t[r]), int(size.rows[i[r]])
                        value = int(found[r]), int(b[r] - starts[t[r]])
                        if value < best.get(key, (1 << 30, 0)):
                            best[key] = value
        for (text, item), (edits, first) in sorted(best.items()):
            yield text, item, edits, first


def blocks_of(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[list, Block]]:
    """The benchmark's items in blocks: their ids, and the items ready to be sought."""
    ids, texts, size = [], [], 0
    for row in benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).dropna(
            subset=["text"]).toLocalIterator():
        words = words_of(row.text)
        if len(words) < LEAST_WORDS:
            continue
        if texts and size + len(words) > BLOCK_WORDS:
            yield ids, Block(texts)
            ids, texts, size = [], [], 0
        ids.append(row.id)
        texts.append(words)
        size += len(words)
    if texts:
        yield ids, Block(texts)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per (document, item) that leaks: both ids, ``edits``, ``first_word`` and ``item_words``."""
    spark = docs.sparkSession
    on_workers(spark)
    narrow = docs.select(id_col, text_col)
    item_kind = benchmark.schema[item_col].dataType
    schema = T.StructType([narrow.schema[id_col], T.StructField(item_col, item_kind),
                           T.StructField("edits", T.IntegerType()), T.StructField("first_word", T.IntegerType()),
                           T.StructField("item_words", T.IntegerType())])
    arrow_item = pa.string() if isinstance(item_kind, T.StringType) else None
    parts = []
    for ids, block in blocks_of(benchmark, item_col, item_text_col):
        shared = spark.sparkContext.broadcast((ids, block))  # at most BLOCK_WORDS words of items
        parts.append(narrow.mapInArrow(_searcher(shared, id_col, text_col, schema.names, arrow_item), schema))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def _searcher(shared, id_col: str, text_col: str, names: list[str], item_kind):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, block = shared.value
        words = {int(r): s.n for s in block.sizes for r in s.rows}
        for batch in slices(batches, text_col, SEARCHED_BYTES):
            found = list(block.search(batch.column(text_col).to_pylist()))
            text, item, edits, first = zip(*found, strict=True) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col).take(pa.array(text, pa.int64())),
                 pa.array([ids[i] for i in item], item_kind if item_kind else (None if item else pa.int64())),
                 pa.array(edits, pa.int32()), pa.array(first, pa.int32()),
                 pa.array([words[i] for i in item], pa.int32())], names=names)

    return rows


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text") -> DataFrame:
    """The documents that leak no item; all columns stay."""
    spark = docs.sparkSession
    on_workers(spark)
    names = docs.columns
    for _, block in blocks_of(benchmark, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(block)
        docs = docs.mapInArrow(_keeper(shared, text_col, names), docs.schema)
    return docs


def _keeper(shared, text_col: str, names: list[str]):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, SEARCHED_BYTES):
            keep = np.ones(batch.num_rows, bool)
            keep[[text for text, *_ in shared.value.search(batch.column(text_col).to_pylist())]] = False
            yield pa.RecordBatch.from_arrays(batch.columns, names=names).filter(pa.array(keep))

    return rows
