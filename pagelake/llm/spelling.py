"""Spelling variants: words one edit apart, found by partition-and-enumerate signatures of their letters.

A word's multiset of letters is a binary vector with one dimension per letter and
occurrence.  One replaced letter changes two dimensions, one inserted or deleted
letter one.  PartEnum cuts the dimensions into parts and enumerates the parts that may
hold the changes: two words of equal length agree on all but two of four parts, two
words whose lengths differ by one on all but one of three.  The letters of the parts
that agree are an exact signature.  It also carries the length and one half of the word, since
one edit leaves the first or the second half as it is.  Words meet by equality of the
signature, and each pair is verified letter by letter.  A pair counts in one signature
only, the one that leaves out exactly the parts and the half that changed.

Signatures are dealt over all tasks, sorted, and read as a stream.  A signature that
more than ``CROWDED`` words share is not compared all with all: its words
are spelled out once per place an edit may have (the letter left out), and meet only where
everything else is equal, so no group can make more rows than there are near words.

Defined cases: null, empty and letterless texts have no words; repeated rows (also of
one id) count each time; a null id counts as the text ``null`` in the damage rule; words
of equal count are chosen by code-point order; a word without near words is its own root.  Words
of any length are compared whole.  An empty table gives no rows.  Other columns are not
looked at.
"""

from __future__ import annotations

import re
import string
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import on_workers, slices, staged

# What a word is.
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
# end of fixed values
LEAST_LETTERS, LEAST_COUNT = 7, 2
#: A form must be so many times as frequent as the word.
RATIO = 10
#: One run in so many loses a letter (test damage of the registered query; the operator's default is none).
DAMAGE = 31
PARTS_REPLACED, PARTS_MOVED = 4, 3
#: Left-out parts for replaced letters, by number; a signature's code is twice this number plus the half it keeps.
LEFT_OUT = list(combinations(range(PARTS_REPLACED), 2))
#: Codes from here on belong to inserted and deleted letters.
MOVED = 2 * len(LEFT_OUT)
CROWDED = 128
#: Distinct words that a counting task holds, signature rows compared at a time, and letters of a plain word.
COUNTED_AT_ONCE, COMPARED_AT_ONCE, PLAIN_LETTERS = 400_000, 100_000, 64


# ---------------------------------------------------------------------------
# Words and their counts
# ---------------------------------------------------------------------------


def damaged(doc_id: object, word: str, one_in: int) -> str:
    """The word without one letter, for one pair of id and word in ``one_in``; else the word."""
    h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{word}".encode())
    if h % one_in:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int | None = None,
                least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all documents: summed in tasks, then by word."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = [w for w in held if len(w) >= least_letters]
            n = [held[w] for w in words]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], names=["word", "n"])

        for batch in slices(batches, text_col):
            for doc_id, text in zip(batch.column(id_col).to_pylist(), batch.column(text_col).to_pylist(), strict=True):
                found = _RUN.findall((text or "").translate(_LOWER))
                if damage is None:
                    held.update(found)
                    continue
                for word, n in Counter(found).items():
                    if len(word) >= least_letters:
                        held[damaged(doc_id, word, damage)] += n
                if len(held) >= COUNTED_AT_ONCE:
                    yield out()
            if len(held) >= COUNTED_AT_ONCE:
                yield out()
        yield out()

    on_workers(docs.sparkSession)
    return (docs.select(id_col, text_col).mapInArrow(rows, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count))


# ---------------------------------------------------------------------------
# Signatures
# ---------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_LETTER = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _spelled(letters: np.ndarray) -> np.ndarray:
    """A hash of each row in order."""
    out = np.full(len(letters), letters.shape[1] + 1, np.uint64)
    for k in range(letters.shape[1]):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + _LETTER[letters[:, k]])
    return out


def _part_sums(letters: np.ndarray, parts: int) -> list[np.ndarray]:
    """A hash of the multiset of each row's letters, for every part of the alphabet."""
    return [np.where(letters % parts == p, _LETTER[letters], np.uint64(0)).sum(1, dtype=np.uint64) for p in range(parts)]


def signatures(letters: np.ndarray, least_letters: int = LEAST_LETTERS) -> Iterator[tuple[int, np.ndarray]]:
    """(code, signature of each row) for words of one length, given as rows of letters.

    Codes below ``MOVED``: replaced letters.  From there on four for each left-out part: first half as the shorter
    word, as the longer word, second half as the shorter word, as the longer word.
    """
    size = letters.shape[1]

    def signed(code: int, length: int, rest: np.ndarray, half: np.ndarray) -> np.ndarray:
        return _mixed(rest * np.uint64(0xD1342543DE82EF95) + half + np.uint64(code * 0x10001 + length * 0x1000003))

    half = size // 2
    kept = (_spelled(letters[:, :half]), _spelled(letters[:, half:]))
    sums = _part_sums(letters, PARTS_REPLACED)
    for number, (p, q) in enumerate(LEFT_OUT):
        rest = sum((s for k, s in enumerate(sums) if k not in (p, q)), np.zeros(len(letters), np.uint64))
        for h in (0, 1):
            yield 2 * number + h, signed(2 * number + h, size, rest, kept[h])
    sums = _part_sums(letters, PARTS_MOVED)
    below = (size - 1) // 2
    longer = (_spelled(letters[:, :below]), _spelled(letters[:, below + 1:]))
    for p in range(PARTS_MOVED):
        rest = sum((s for k, s in enumerate(sums) if k != p), np.zeros(len(letters), np.uint64))
        for h in (0, 1):
            code = MOVED + 4 * p + 2 * h
            yield code, signed(code, size, rest, kept[h])
            if size > least_letters:
                yield code + 1, signed(code, size - 1, rest, longer[h])


def signature_rows(words: DataFrame, least_letters: int = LEAST_LETTERS) -> DataFrame:
    """(signature, code, word, n), some 24 rows a word."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "word", 1 << 17):
            raw = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            sizes = np.fromiter(map(len, raw), np.int64, len(raw))
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                letters = np.frombuffer(b"".join([raw[i] for i in at.tolist()]), np.uint8).reshape(-1, size)
                some = batch.take(pa.array(at))
                for code, key in signatures(letters, least_letters):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(np.full(len(at), code, np.int32)), *some.columns],
                        names=["signature", "code", "word", "n"])

    return words.select("word", "n").mapInArrow(rows, "signature long, code int, word string, n long")


# ---------------------------------------------------------------------------
# Verification
# ---------------------------------------------------------------------------


def _left_out_by(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of the left-out parts that a pair with letters ``a`` and ``b`` counts under."""
    p, q = a % PARTS_REPLACED, b % PARTS_REPLACED
    low, high = np.minimum(p, q), np.maximum(p, q)
    high = np.where(low == high, np.where(low == 0, 1, high), high)
    low = np.where(p == q, 0, low)
    number = np.zeros((PARTS_REPLACED, PARTS_REPLACED), np.int64)
    for k, (x, y) in enumerate(LEFT_OUT):
        number[x, y] = k
    return number[low, high]


def replaced(a: np.ndarray, b: np.ndarray, size: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Which rows of ``a`` and ``b`` (equal lengths) differ in one letter and count under this code."""
    differ = a != b
    at = differ.argmax(1)
    rows = np.arange(len(a))
    return ((differ.sum(1) == 1) & ((at < size // 2) == (code % 2 == 1))
            & (_left_out_by(a[rows, at], b[rows, at]) == code // 2))


def moved(short: np.ndarray, long_: np.ndarray, size: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Which rows of ``long_`` hold the row of ``short`` (``size`` letters) and one letter more, and count under this code."""
    width = short.shape[1]
    differ = short != long_
    at = np.where(differ.any(1), differ.argmax(1), size)  # the last place where the letter may have been put in
    behind = np.zeros_like(short)
    behind[:, :width - 1] = long_[:, 1:]
    same = ((short == behind) | (np.arange(width) < at[:, None])).all(1)
    letter = long_[np.arange(len(long_)), np.minimum(at, width - 1)]
    half, part = (code - MOVED) // 2 % 2, (code - MOVED) // 4
    return same & ((at < size // 2) == (half == 1)) & (letter % PARTS_MOVED == part)


def compare(signature: np.ndarray, code: np.ndarray, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the near pairs among rows sorted by signature, vectorised over all signatures at once."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    width = int(size.max()) + 1
    letters = np.array(words, f"S{width}").view(np.uint8).reshape(len(words), width)
    group = np.cumsum(np.concatenate([[0], (signature[1:] != signature[:-1]).astype(np.int64)]))
    left = np.arange(len(words))
    for step in range(1, CROWDED):
        left = left[left + step < len(words)]
        left = left[group[left] == group[left + step]]
        if not len(left):
            return
        right = left + step
        plain = (code[left] < MOVED) & (code[left] == code[right]) & (size[left] == size[right])
        for chosen, kind in ((plain, 0), ((code[left] >= MOVED) & (code[left] != code[right]), 1)):
            a, b = left[chosen], right[chosen]
            if not len(a):
                continue
            if kind:
                a, b = np.where(code[a] < code[b], a, b), np.where(code[a] < code[b], b, a)
                fits = size[a] + 1 == size[b]
                a, b = a[fits], b[fits]
            hit = (moved if kind else replaced)(letters[a], letters[b], size[a], code[a])
            yield a[hit], b[hit]


class _Rows:
    """Signature rows that wait in a task."""

    def __init__(self):
        self.batches: list[pa.RecordBatch] = []
        self.count = 0

    def add(self, batch: pa.RecordBatch) -> None:
        if batch.num_rows:
            self.batches.append(batch)
            self.count += batch.num_rows

    def take(self) -> pa.Table:
        out = pa.Table.from_batches(self.batches).combine_chunks()
        self.batches, self.count = [], 0
        return out


_MET = "signature long, code int, word string, n long, other string, other_n long"


def met(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs, both ways, of rows sorted by signature; rows of crowded signatures come out as they are."""
    names = ["signature", "code", "word", "n", "other", "other_n"]

    def crowded_rows(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.append_column("other", pa.nulls(rows.num_rows, pa.string()))
        yield from rows.append_column("other_n", pa.nulls(rows.num_rows, pa.int64())).to_batches()

    def pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if not rows.num_rows:
            return
        signature = rows["signature"].to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(signature[1:] != signature[:-1]) + 1, [len(signature)]])
        sizes = np.diff(cuts)
        of_row = np.repeat(sizes, sizes)
        if (of_row > CROWDED).any():
            yield from crowded_rows(rows.filter(pa.array(of_row > CROWDED)))
        rows = rows.filter(pa.array((of_row > 1) & (of_row <= CROWDED)))
        if not rows.num_rows:
            return
        words = [w.encode("latin-1") for w in rows["word"].to_pylist()]
        signature, code = rows["signature"].to_numpy(), rows["code"].to_numpy()
        length = np.fromiter(map(len, words), np.int64, len(words))
        firsts = np.concatenate([[0], np.flatnonzero(signature[1:] != signature[:-1]) + 1])
        longest = np.repeat(np.maximum.reduceat(length, firsts), np.diff(np.append(firsts, len(words))))
        plain = np.flatnonzero(longest <= PLAIN_LETTERS)
        runs = [plain] if len(plain) else []
        long_ = np.flatnonzero(longest > PLAIN_LETTERS)  # one signature at a time: a wide word widens no other
        if len(long_):
            runs += np.split(long_, np.flatnonzero(np.diff(signature[long_])) + 1)
        for run in runs:
            found = list(compare(signature[run], code[run], [words[i] for i in run.tolist()]))
            if not found:
                continue
            a, b = (run[np.concatenate(x)] for x in zip(*found, strict=True))
            one, two = pa.array(np.concatenate([a, b])), pa.array(np.concatenate([b, a]))
            n, word = rows["n"].combine_chunks(), rows["word"].combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(one), pa.int64()), pa.nulls(len(one), pa.int32()), word.take(one), n.take(one),
                 word.take(two), n.take(two)], names=names)

    waiting, passing = _Rows(), None
    for batch in batches:
        signature = batch.column("signature").to_numpy()
        if passing is not None and batch.num_rows:
            same = int(np.argmax(signature != passing)) if (signature != passing).any() else len(signature)
            if same:
                yield from crowded_rows(pa.Table.from_batches([batch.slice(0, same)]))
            if same < len(signature):
                passing = None
            batch = batch.slice(same)
        waiting.add(batch)
        if waiting.count < COMPARED_AT_ONCE:
            continue
        rows = waiting.take()
        signature = rows["signature"].to_numpy()
        last = int(np.flatnonzero(signature != signature[-1])[-1]) + 1 if (signature != signature[-1]).any() else 0
        yield from pairs(rows.slice(0, last))
        rest = rows.slice(last)
        if rest.num_rows > CROWDED:
            passing = int(signature[-1])
            yield from crowded_rows(rest)
        else:
            for part in rest.to_batches():
                waiting.add(part)
    if waiting.count:
        yield from pairs(waiting.take())


# ---------------------------------------------------------------------------
# Crowded signatures
# ---------------------------------------------------------------------------


def spelled_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of crowded signatures, once for each place that an edit may have: (rest, letter, side) beside the row.

    ``side`` is 0 for replaced letters, 1 for the shorter and 2 for the longer word.
    """
    for batch in batches:
        out: list[tuple] = []
        for signature, code, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if code < MOVED:
                half = len(word) // 2
                for at in range(half) if code % 2 else range(half, len(word)):
                    out.append((signature, code, word, n, f"{word[:at]}\0{word[at + 1:]}", ord(word[at]), 0))
                continue
            part, half, longer = (code - MOVED) // 4, (code - MOVED) // 2 % 2, (code - MOVED) % 2
            if not longer:
                out.append((signature, code, word, n, word, 0, 1))
                continue
            below = (len(word) - 1) // 2
            for at in range(below) if half else range(below, len(word)):
                if word[at] != word[at + 1:at + 2] and ord(word[at]) % PARTS_MOVED == part:
                    out.append((signature, code, word, n, word[:at] + word[at + 1:], 0, 2))
        kinds = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int32()]
        names = ["signature", "code", "word", "n", "rest", "letter", "side"]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=names)


def crowded_pairs(rows: DataFrame) -> DataFrame:
    """(word, n, other, other_n): near words of crowded signatures, which meet where all else is equal.

    A meeting of replaced letters has at most one word a letter of the alphabet; a longer word meets one shorter word.
    """
    placed = staged(rows.select("signature", "code", "word", "n").mapInArrow(
        spelled_out, "signature long, code int, word string, n long, rest string, letter int, side int"), "spelling-places")
    a, b = placed.alias("a"), placed.alias("b")
    p, q = F.col("a.letter") % PARTS_REPLACED, F.col("b.letter") % PARTS_REPLACED
    low = F.when(p == q, F.lit(0)).otherwise(F.least(p, q))
    high = F.when((p == q) & (p == 0), F.lit(1)).otherwise(F.greatest(p, q))
    number = F.coalesce(*[F.when((low == x) & (high == y), F.lit(k)) for k, (x, y) in enumerate(LEFT_OUT)])
    meet = ((F.col("a.signature") == F.col("b.signature")) & (F.col("a.rest") == F.col("b.rest"))
            & (F.col("a.word") != F.col("b.word")))
    once = (((F.col("a.side") == 0) & (F.col("b.side") == 0) & (number == F.floor(F.col("a.code") / 2)))
            | ((F.col("a.side") == 1) & (F.col("b.side") == 2)) | ((F.col("a.side") == 2) & (F.col("b.side") == 1)))
    return a.join(b, meet & once).select("a.word", "a.n", F.col("b.word").alias("other"), F.col("b.n").alias("other_n"))


# ---------------------------------------------------------------------------
# Forms and roots
# ---------------------------------------------------------------------------


def near_words(words: DataFrame, least_letters: int = LEAST_LETTERS) -> DataFrame:
    """(word, n, other, other_n): every pair of words one edit apart, both ways, once."""
    rows = signature_rows(words, least_letters)
    rows = rows.repartition("signature").sortWithinPartitions("signature").mapInArrow(met, _MET)
    rows = staged(rows, "spelling-pairs")
    found = rows.filter("other is not null").select("word", "n", "other", "other_n")
    return found.unionByName(crowded_pairs(rows.filter("other is null")))


def roots(forms: DataFrame, most_rounds: int = 70) -> DataFrame:
    """(word, root) of (word, form): every chain followed to its end by doubling the step, so rounds are few."""
    now = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(most_rounds):
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        then = staged(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                             F.col("next").isNotNull().alias("went")), "spelling-roots")
        if not then.filter("went").limit(1).count():
            return then.select("word", "root")
        now = then.select("word", "root")
    raise RuntimeError(f"chains of forms did not end in {most_rounds} doublings")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int | None = None,
             least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``."""
    words = staged(count_words(docs, id_col, text_col, damage, least_letters, least_count), "spelling-words")
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))).alias("best")
    near = near_words(words, least_letters).groupBy("word").agg(F.count("*").alias("n_near"), best)
    frequent = -F.col("best.n") >= F.lit(ratio) * F.col("n")
    judged = staged(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best.word")).alias("form"), F.when(frequent, -F.col("best.n")).alias("form_n")),
        "spelling-forms")
    ends = roots(judged.filter("form is not null"))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
