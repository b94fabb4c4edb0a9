"""Language identification by interpolated Kneser-Ney character models, one per language.

Learning counts character n-grams inside words (maximal runs of letters, lower-cased,
with a mark at either end) over **all** documents that may be learned from, per
language.  Counts, continuation counts, discounts, context masses and interpolated
probabilities are Spark joins and aggregates.  The finished models are one sorted
array of 64-bit hashes (language and n-gram) with their log probabilities, cut by
leading bits into files that tasks write to shared storage and map into memory.

Scoring looks every distinct word of a task up once, and gives a text the language of
lowest cross-entropy per symbol.  A tenth of the documents that may be learned from is
kept out of the counts.  On it the operator calibrates ``score`` (how likely the
language is right, by logistic regression over the margin and the length) and the
rejection: ``accepted`` is false where the cross-entropy lies beyond what 99.5 % of
the documents of that language have.

Defined cases: a text that is null, empty or without a letter is ``und`` with score 0
and is never accepted.  Languages of equal cross-entropy: the first in code-point
order.  A null language is not learned from, a null id neither held out nor learned
from.  Repeated rows count and score like any other.  Texts of any length are read
whole, word by word.  Where nothing can be learned (an empty table) every text is
``und``; an empty table to score gives no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.llm.common import on_workers, slices, staged
from pagelake.session import resolve_filesystem, scratch_folder

ORDER = 4
UNDETERMINED = "und"
HELD_OUT_OF, HELD_OUT = 4, 2
#: One in so many learnable documents calibrates instead of being counted.
CALIBRATE_OF = 10
ACCEPTED_SHARE = 0.995
#: Documents a language needs for a bar of its own; with fewer, the bar of all documents holds.
OWN_BAR = 50
#: Distinct words that a counting task holds before it passes their n-grams on.
COUNTED_AT_ONCE = 400_000
#: Numbers in a scoring task's table of known words before it starts anew.
KNOWN_CELLS = 8_000_000
#: Most entries of one model file.
SHARD_ENTRIES = 4_000_000
START, END = "\x02", "\x03"  # marks around a word; no letters
_WORD = re.compile(r"[^\W\d_]+")
_CONTEXT = 64  # kind of a context entry: this and its length


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters (and of numerals that are no digits)."""
    return _WORD.findall((text or "").lower())


def has_letter(word: str) -> bool:
    return word.isalpha() or any(map(str.isalpha, word))


# ---------------------------------------------------------------------------
# N-grams of words as arrays
# ---------------------------------------------------------------------------


def windows(words: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each symbol of each word (code points, one row each), and the rows of each word."""
    pad = START * (order - 1)
    codes = np.frombuffer("".join([f"{pad}{w}{END}" for w in words]).encode("utf-32-le"), np.uint32)
    if not len(codes):
        return np.zeros((0, order), np.uint32), np.zeros(0, np.int64)
    every = np.lib.stride_tricks.sliding_window_view(codes, order)
    return every[codes[order - 1:] != ord(START)], np.fromiter(map(len, words), np.int64, len(words)) + 1


def packed(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of code points, and for each row the number of its distinct one; exact."""
    symbols, dense = np.unique(grams, return_inverse=True)
    dense, bits = dense.reshape(grams.shape), max(1, int(len(symbols) - 1).bit_length())
    if bits * grams.shape[1] > 64:
        distinct, number = np.unique(grams, axis=0, return_inverse=True)
        return distinct, number.reshape(-1)
    key = np.zeros(len(grams), np.uint64)
    for k in range(grams.shape[1]):
        key = key << np.uint64(bits) | dense[:, k].astype(np.uint64)
    _, first, number = np.unique(key, return_index=True, return_inverse=True)
    return grams[first], number


def texts_of(grams: np.ndarray) -> list[str]:
    width, text = grams.shape[1], np.ascontiguousarray(grams).tobytes().decode("utf-32-le")
    return [text[at:at + width] for at in range(0, len(text), width)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input reaches every bit of the result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hash(grams: np.ndarray) -> np.ndarray:
    """64-bit hashes of rows of code points; zeros on the left do not count."""
    out = np.zeros(len(grams), np.uint64)
    for k in range(grams.shape[1]):
        column = grams[:, k].astype(np.uint64)
        out = np.where(column > 0, mixed(out * np.uint64(0x9E3779B97F4A7C15) + column + np.uint64(1)), out)
    return out


def entry_key(hashes: np.ndarray, language: int, kind: int) -> np.ndarray:
    return mixed(hashes + mixed(np.array([language * 1024 + kind + 1], np.uint64)))


# ---------------------------------------------------------------------------
# Counting and probabilities (Spark)
# ---------------------------------------------------------------------------


def count_grams(docs: DataFrame, lang_col: str, text_col: str, order: int) -> DataFrame:
    """(lang, gram, n): the n-grams of highest order of every document, summed in tasks before the shuffle."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                words = [w for w in counts if has_letter(w)]
                grams, sizes = windows(words, order)
                if not len(grams):
                    continue
                distinct, number = packed(grams)
                weight = np.repeat(np.fromiter((counts[w] for w in words), np.int64, len(words)), sizes)
                n = np.zeros(len(distinct), np.int64)
                np.add.at(n, number, weight)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(n), pa.string()), pa.array(texts_of(distinct), pa.string()), pa.array(n)],
                    names=["lang", "gram", "n"])
            held.clear()

        for batch in slices(batches, text_col):
            for lang, text in zip(batch.column(lang_col).to_pylist(), batch.column(text_col).to_pylist(), strict=True):
                held.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, held.values())) >= COUNTED_AT_ONCE:
                yield from out()
        yield from out()

    return (docs.select(lang_col, text_col).mapInArrow(rows, "lang string, gram string, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def adjusted_counts(highest: DataFrame, order: int) -> dict[int, DataFrame]:
    """Counts of each order: how many n-grams a lower one continues (how often it occurs, at a word's start)."""
    out = {order: highest}
    for k in range(order - 1, 0, -1):
        suffix = F.substring("gram", 2, k)
        n = F.when(F.first("gram").startswith(START), F.sum("n")).otherwise(F.count("*"))
        out[k] = staged(out[k + 1].select("lang", suffix.alias("gram"), "n").groupBy("lang", "gram")
                        .agg(n.alias("n")), "language-counts")
    return out


def _discounts(counts: DataFrame) -> DataFrame:
    once, twice = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
    d = F.when(once > 0, once / (once + 2 * twice)).otherwise(F.lit(0.5))
    return counts.groupBy("lang").agg(F.least(d, F.lit(0.9)).alias("d"))  # one row per language


def probabilities(counts: dict[int, DataFrame], order: int, symbols: int) -> DataFrame:
    """(lang, kind, gram, value): log probability of each n-gram (kind: its length) and log weight of
    the shorter context for each context (kind: 64 and its length)."""
    lower, parts = None, []
    for k in range(1, order + 1):
        rows = counts[k].withColumn("ctx", F.substring("gram", 1, k - 1) if k > 1 else F.lit(""))
        masses = (rows.groupBy("lang", "ctx").agg(F.sum("n").alias("mass"), F.count("*").alias("kinds"))
                  .join(_discounts(counts[k]), "lang"))
        below = F.lit(1.0 / symbols) if lower is None else F.col("p")
        rows = rows.join(masses, ["lang", "ctx"])
        if lower is not None:
            rows = rows.withColumn("rest", F.substring("gram", 2, k)).join(
                lower.select("lang", F.col("gram").alias("rest"), "p"), ["lang", "rest"])
        p = (F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) + F.col("d") * F.col("kinds") * below) / F.col("mass")
        lower = staged(rows.select("lang", "gram", p.alias("p")), "language-probabilities")
        parts.append(lower.select("lang", F.lit(k).alias("kind"), "gram", F.log("p").alias("value")))
        parts.append(masses.select("lang", F.lit(_CONTEXT + k - 1).alias("kind"), F.col("ctx").alias("gram"),
                                   F.log(F.col("d") * F.col("kinds") / F.col("mass")).alias("value")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return staged(out, "language-entries")


# ---------------------------------------------------------------------------
# Sorted hash arrays
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Shard:
    name: str
    entries: int


@dataclass(frozen=True)
class LanguageModel:
    """What scoring needs: the languages in order, the files of the sorted arrays, and the calibration."""

    languages: tuple[str, ...]
    order: int
    symbols: int
    bits: int
    shards: tuple[Shard | None, ...]
    #: intercept, weight of the margin per symbol, weight of log(1 + symbols)
    confidence: tuple[float, float, float] = (0.0, 0.0, 0.0)
    bars: tuple[float, ...] = ()


def write_model(spark: SparkSession, entries: DataFrame, languages: tuple[str, ...], order: int,
                symbols: int, shard_entries: int = SHARD_ENTRIES) -> LanguageModel:
    """Hash, sort and write the entries; each file holds the keys of one run of leading bits."""
    number = {lang: i for i, lang in enumerate(languages)}
    bits = max(0, math.ceil(math.log2(max(1, entries.count()) / shard_entries)))
    folder = scratch_folder(spark, "language-model")

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            langs, grams = batch.column("lang").to_pylist(), batch.column("gram").to_pylist()
            wide = np.frombuffer("".join([g.rjust(order, "\0") for g in grams]).encode("utf-32-le"), np.uint32)
            hashes = gram_hash(wide.reshape(-1, order))
            salt = np.array([number[x] for x in langs], np.uint64) * np.uint64(1024) + np.uint64(1)
            key = mixed(hashes + mixed(salt + batch.column("kind").to_numpy().astype(np.uint64)))
            shard = (key >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(key), np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(key.view(np.int64)), batch.column("value")],
                                             names=["shard", "key", "value"])

    def written(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: int | None = None
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            key, value = (np.concatenate(x) for x in zip(*held, strict=True))
            at = np.argsort(key)
            filesystem, root = resolve_filesystem(folder)
            name = f"{now}-{uuid.uuid4().hex}.bin"  # a repeated task writes a file of its own
            with filesystem.open_output_stream(f"{root}/{name}") as file:
                file.write(key[at].tobytes())
                file.write(value[at].astype(np.float32).tobytes())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([name]),
                                               pa.array([len(key)], pa.int64())], names=["shard", "name", "entries"])

        for batch in batches:
            shard = batch.column("shard").to_numpy()
            key, value = batch.column("key").to_numpy().view(np.uint64), batch.column("value").to_numpy()
            cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if now is not None and now != int(shard[a]):
                    yield out()
                now = int(shard[a])
                held.append((key[a:b], value[a:b]))
        if held:
            yield out()

    rows = (entries.mapInArrow(keyed, "shard int, key long, value double")
            .repartition(1 << bits, "shard").sortWithinPartitions("shard")
            .mapInArrow(written, "shard int, name string, entries long").collect())  # one row per file
    shards: list[Shard | None] = [None] * (1 << bits)
    for r in rows:
        spark.sparkContext.addFile(f"{folder}/{r.name}")
        shards[r.shard] = Shard(r.name, r.entries)
    return LanguageModel(languages, order, symbols, bits, tuple(shards))


class Scorer:
    """Log probabilities of words under every language, in one task."""

    def __init__(self, model: LanguageModel):
        from pyspark import SparkFiles

        self.model = model
        self.arrays = [None if s is None else (
            np.memmap(SparkFiles.get(s.name), np.uint64, "r", 0, (s.entries,)),
            np.memmap(SparkFiles.get(s.name), np.float32, "r", 8 * s.entries, (s.entries,))) for s in model.shards]
        self.known: dict[str, int] = {}
        self.table = np.zeros((1024, len(model.languages) + 1), np.float32)

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """Values of the keys, NaN where there are none."""
        out = np.full(len(keys), np.nan, np.float32)
        shard = keys >> np.uint64(64 - self.model.bits) if self.model.bits else np.zeros(len(keys), np.uint64)
        for s, arrays in enumerate(self.arrays):
            mine = np.flatnonzero(shard == s)
            if arrays is None or not len(mine):
                continue
            mine = mine[np.argsort(keys[mine])]  # neighbours in the file one after the other
            at = np.minimum(np.searchsorted(arrays[0], keys[mine]), len(arrays[0]) - 1)
            hit = arrays[0][at] == keys[mine]
            out[mine[hit]] = arrays[1][at[hit]]
        return out

    def gram_scores(self, grams: np.ndarray, language: int) -> np.ndarray:
        """Log probability of the last symbol of each row: the longest known n-gram, and the weights on the way to it."""
        order = self.model.order
        out, open_ = np.zeros(len(grams), np.float64), np.arange(len(grams))
        for k in range(order, 0, -1):
            if not len(open_):
                return out
            some = grams[open_].copy()
            some[:, :order - k] = 0
            value = self.look_up(entry_key(gram_hash(some), language, k))
            hit = ~np.isnan(value)
            out[open_[hit]] += value[hit]
            some = some[~hit]
            open_ = open_[~hit]
            if len(open_):
                context = np.zeros_like(some)
                context[:, 1:] = some[:, :-1]
                weight = self.look_up(entry_key(gram_hash(context), language, _CONTEXT + k - 1))
                out[open_] += np.where(np.isnan(weight), 0.0, weight)
        out[open_] -= math.log(self.model.symbols)
        return out

    def learn_words(self, words: list[str]) -> None:
        """Rows of the table for words that it lacks: log probability by language, then the number of symbols."""
        if (len(self.known) + len(words)) * self.table.shape[1] > KNOWN_CELLS:
            self.known.clear()
        first = len(self.known)
        self.known.update(zip(words, range(first, first + len(words)), strict=True))
        if first + len(words) > len(self.table):
            grown = np.zeros((2 * (first + len(words)), self.table.shape[1]), np.float32)
            grown[:first] = self.table[:first]
            self.table = grown
        self.table[first:first + len(words)] = 0
        scored = [i for i, w in enumerate(words) if has_letter(w)]
        grams, sizes = windows([words[i] for i in scored], self.model.order)
        if not len(grams):
            return
        distinct, number = packed(grams)
        starts = np.cumsum(sizes) - sizes
        rows = first + np.array(scored)
        for language in range(len(self.model.languages)):
            self.table[rows, language] = np.add.reduceat(self.gram_scores(distinct, language)[number], starts)
        self.table[rows, -1] = sizes

    def totals(self, texts: list[str | None]) -> np.ndarray:
        """Log probability by language and number of symbols of each text."""
        lists = [words_of(t) for t in texts]
        distinct = set(chain.from_iterable(lists))
        if (len(self.known) + len(distinct)) * self.table.shape[1] > KNOWN_CELLS:
            self.known.clear()
        self.learn_words([w for w in distinct if w not in self.known])
        out = np.zeros((len(texts), self.table.shape[1]))
        for i, words in enumerate(lists):
            codes = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            for at in range(0, len(codes), 1 << 16):
                out[i] += self.table[codes[at:at + (1 << 16)]].sum(0, dtype=np.float64)
        return out


_SCORERS: dict[LanguageModel, Scorer] = {}


def scorer_of(model: LanguageModel) -> Scorer:
    if model not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[model] = Scorer(model)
    return _SCORERS[model]


def judged(docs: DataFrame, model: LanguageModel, text_col: str) -> DataFrame:
    """The frame with ``language`` (its number, null without a letter), ``cross_entropy``, ``margin`` and ``symbols``."""
    kept = [f.name for f in docs.schema.fields if f.name != text_col]
    schema = T.StructType([*(docs.schema[n] for n in kept), T.StructField("language", T.IntegerType()),
                           T.StructField("cross_entropy", T.DoubleType()), T.StructField("margin", T.DoubleType()),
                           T.StructField("symbols", T.LongType())])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(model)
        for batch in slices(batches, text_col):
            totals = scorer.totals(batch.column(text_col).to_pylist())
            symbols = totals[:, -1]
            there = symbols > 0
            entropy = -totals[:, :-1] / np.maximum(symbols, 1)[:, None]
            best = entropy.argmin(1)
            lowest = entropy.min(1)
            rest = entropy.copy()
            rest[np.arange(len(rest)), best] = np.inf
            margin = rest.min(1) - lowest if rest.shape[1] > 1 else np.zeros(len(rest))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(best, pa.int32(), mask=~there),
                 pa.array(lowest, pa.float64(), mask=~there), pa.array(margin, pa.float64(), mask=~there),
                 pa.array(symbols.astype(np.int64))], names=schema.names)

    return docs.mapInArrow(rows, schema)


# ---------------------------------------------------------------------------
# Learning, calibration, prediction
# ---------------------------------------------------------------------------


def held_out(id_col: str) -> Column:
    remainder = F.crc32(F.col(id_col).cast("string").cast("binary")) % HELD_OUT_OF
    return F.coalesce(remainder == HELD_OUT, F.lit(False))


def fit_confidence(bins: list[tuple[float, float, int, int]]) -> tuple[float, float, float]:
    """Logistic regression of being right on margin and log length, over counted bins (Newton steps, ridge 1e-2)."""
    if not bins:
        return 0.0, 0.0, 0.0
    x = np.array([[1.0, margin, length] for margin, length, _, _ in bins])
    right, total = (np.array([b[k] for b in bins], float) for k in (2, 3))
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (right - total * p) - 1e-2 * w
        step = np.linalg.solve((x * (total * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3), gradient)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def calibrate(sample: DataFrame, model: LanguageModel, lang_col: str, text_col: str) -> LanguageModel:
    """The model with confidence weights and bars from documents that it has not counted."""
    scored = staged(judged(sample, model, text_col).filter("language is not null"), "language-calibration")
    names = F.array(*[F.lit(x) for x in model.languages])
    scored = scored.withColumn("right", F.get(names, F.col("language")) == F.col(lang_col))
    bins = (scored.groupBy(F.least(F.round(F.col("margin") * 50), F.lit(250.0)).alias("m"),
                           F.round(F.log1p("symbols") * 4).alias("s"))
            .agg(F.count_if("right").alias("right"), F.count("*").alias("n")).collect())  # 251 x some 100 bins at most
    weights = fit_confidence([(b.m / 50, b.s / 4, b.right, b.n) for b in bins])
    bar = F.percentile_approx("cross_entropy", ACCEPTED_SHARE, 100_000)
    whole = scored.filter("right").agg(bar.alias("bar")).first().bar
    own = {r.language: r.bar for r in scored.filter("right").groupBy("language")
           .agg(F.count("*").alias("n"), bar.alias("bar")).filter(F.col("n") >= OWN_BAR).collect()}
    bars = tuple(own.get(i, math.inf if whole is None else whole) for i in range(len(model.languages)))
    return LanguageModel(model.languages, model.order, model.symbols, model.bits, model.shards, weights, bars)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          order: int = ORDER) -> LanguageModel | None:
    """The models of the languages of all documents that are not held out; None where there are none."""
    spark = docs.sparkSession
    on_workers(spark)
    fold = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(CALIBRATE_OF))
    usable = docs.filter(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), (fold == 0).alias("kept_back"))
    grams = staged(count_grams(usable.filter("not kept_back"), "lang", "text", order), "language-counts")
    languages = tuple(sorted(r.lang for r in grams.select("lang").distinct().collect()))
    if not languages:
        return None
    counts = adjusted_counts(grams, order)
    symbols = counts[1].select("gram").distinct().count() + 1
    model = write_model(spark, probabilities(counts, order, symbols), languages, order, symbols)
    return calibrate(usable.filter("kept_back").select("lang", "text"), model, "lang", "text")


def predict(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Per document: id, ``held_out``, ``lang_pred``, ``score``, ``cross_entropy`` and ``accepted``."""
    narrow = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    if model is None:
        return narrow.select(id_col, held_out(id_col).alias("held_out"), F.lit(UNDETERMINED).alias("lang_pred"),
                             F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("cross_entropy"),
                             F.lit(False).alias("accepted"))
    scored = judged(narrow, model, "_text")
    language = F.col("language")
    names = F.get(F.array(*[F.lit(x) for x in model.languages]), language)
    bar = F.get(F.array(*[F.lit(x) for x in model.bars]), language)
    base, by_margin, by_length = model.confidence
    z = F.lit(base) + by_margin * F.least(F.col("margin"), F.lit(5.0)) + by_length * F.log1p("symbols")
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))
    return scored.select(
        id_col, held_out(id_col).alias("held_out"), F.coalesce(names, F.lit(UNDETERMINED)).alias("lang_pred"),
        F.when(language.isNull(), 0.0).otherwise(score).alias("score"), "cross_entropy",
        F.coalesce(F.col("cross_entropy") <= bar, F.lit(False)).alias("accepted"))
