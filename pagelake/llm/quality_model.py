"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model predicts every character of a text from the four before it.  Characters are
12-bit symbols (code points up to U+0EFF by themselves, those beyond in 256 classes), so
that five of them are a 60-bit number; context and suffix of an n-gram are shifts and
masks of that number.

Training counts the 5-grams of all trusted documents.  The lower orders' continuation
counts, the discounts (from the counts of counts), the contexts' masses and the
interpolated probabilities are aggregates and joins of count tables that Spark shards by
context and by suffix.

Scoring needs the probability of each distinct n-gram of a document.  A model of up to
:data:`SENT_ROWS` rows (its rows are counted first) is sent to the executors as two
hash tables; a larger one stays sharded, and the documents' distinct n-grams are joined
to it.  Both give the same figures.

A document is kept if its perplexity is at most the ``quantile`` of the trusted documents
of its language (languages without trusted documents: of all trusted documents).  For that
quantile each of :data:`FOLDS` parts of the trusted documents, equal texts together, is
scored by a model of the other parts, since a model knows the texts it was trained on.
Texts without a character (null, empty) have no perplexity and are not kept; without any
trusted text nothing has a perplexity.  Repeated rows are scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.llm.common import forget, on_workers, slices, staged

ORDER = 5
BITS = 12
CLASSES_FROM = 0xF00
START = 2  # the symbol that stands ORDER - 1 times before every text
QUANTILE = 0.995
FOLDS = 2
#: Rows (n-grams and contexts of all orders) up to which a model is sent to the executors: 64 MB.
SENT_ROWS = 4_000_000
#: Distinct n-grams that a counting task holds before it passes them on.
HELD = 2_000_000


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each character of the texts, and where each text begins."""
    points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    start = np.full(ORDER - 1, START, np.uint32)
    joined = np.concatenate([x for p in points for x in (start, p)]) if points else start[:0]
    sizes = np.array([len(p) for p in points], np.int64)
    symbol = np.where(joined < CLASSES_FROM, joined, CLASSES_FROM + joined % 256).astype(np.int64)
    gram = symbol.copy()
    for back in range(1, ORDER):
        gram[back:] |= symbol[:-back] << BITS * back
    begin = np.cumsum(sizes + ORDER - 1) - sizes
    real = np.ones(len(joined), bool)
    for back in range(1, ORDER):
        real[begin - back] = False
    return gram[real], np.cumsum(sizes) - sizes


def mask(order: int) -> int:
    return (1 << BITS * order) - 1


def count_grams(docs: DataFrame, text_col: str) -> DataFrame:
    """(gram, n) of the highest order over all rows; tasks pre-aggregate."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in slices(batches, text_col):
            grams, _ = symbols([t or "" for t in batch.column(text_col).to_pylist()])
            some, n = np.unique(grams, return_counts=True)
            merged, at = np.unique(np.concatenate([known, some]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, n]), len(merged)).astype(np.int64)
            known = merged
            if len(known) > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(known), pa.array(counts)], names=["gram", "n"])
                known, counts = known[:0], counts[:0]
        yield pa.RecordBatch.from_arrays([pa.array(known), pa.array(counts)], names=["gram", "n"])

    return (docs.select(text_col).mapInArrow(rows, "gram long, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")))


def discounts(counted: DataFrame) -> list[float]:
    """The three discounts of modified Kneser-Ney, from how many n-grams occur once to four times."""
    have = {r.n: r["count"] for r in counted.filter("n <= 4").groupBy("n").count().collect()}
    n1, n2, n3, n4 = (have.get(k, 0) for k in range(1, 5))
    share = n1 / (n1 + 2 * n2) if n1 else 0.5
    wanted = (1 - 2 * share * n2 / n1 if n1 else 0.5, 2 - 3 * share * n3 / n2 if n2 else 1.0,
              3 - 4 * share * n4 / n3 if n3 else 1.5)
    return [min(max(d, 0.1), k - 0.1) for k, d in enumerate(wanted, 1)]


def train(trusted: DataFrame, text_col: str = "text") -> DataFrame:
    """The model as a written table: (kind, order, gram, value).

    Kind ``p``: log probability of a seen n-gram; kind ``g``: log of the mass that a seen
    context (an n-gram without its last symbol) leaves to the next lower order.
    """
    on_workers(trusted.sparkSession)
    counted = {ORDER: staged(count_grams(trusted, text_col), "kn-counts")}
    for order in range(ORDER - 1, 0, -1):
        counted[order] = staged(counted[order + 1].groupBy(F.col("gram").bitwiseAND(F.lit(mask(order))).alias("gram"))
                                .agg(F.count("*").alias("n")), "kn-counts")
    types = counted[1].count()
    lower, parts, steps = None, [], list(counted.values())
    for order in range(1, ORDER + 1):
        d1, d2, d3 = discounts(counted[order])
        cut = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        rows = counted[order].select("gram", "n", F.shiftright("gram", BITS).alias("context"))
        mass = rows.groupBy("context").agg(F.sum("n").alias("total"), F.sum(cut).alias("left"))
        contexts = staged(mass.select("context", "total", (F.col("left") / F.col("total")).alias("left")), "kn-contexts")
        joined = rows.join(contexts, "context")
        share = (F.col("n") - cut) / F.col("total")
        if order == 1:
            probable = joined.select("gram", (share + F.col("left") / (types + 1)).alias("p"))
        else:
            below = lower.select(F.col("gram").alias("suffix"), F.col("p").alias("below"))
            probable = joined.withColumn("suffix", F.col("gram").bitwiseAND(F.lit(mask(order - 1)))).join(
                below, "suffix").select("gram", (share + F.col("left") * F.col("below")).alias("p"))
        lower = staged(probable, "kn-probabilities")
        steps += [contexts, lower]
        parts += [lower.select(F.lit("p").alias("kind"), F.lit(order).alias("order"), "gram", F.log("p").alias("value")),
                  contexts.select(F.lit("g").alias("kind"), F.lit(order).alias("order"),
                                  F.col("context").alias("gram"), F.log("left").alias("value"))]
    # what an unseen single symbol gets, after the mass of the empty context
    parts.append(trusted.sparkSession.range(1).select(F.lit("p").alias("kind"), F.lit(0).alias("order"),
                                                      F.lit(0).cast("long").alias("gram"),
                                                      F.lit(-float(np.log(types + 1))).alias("value")))
    model = staged(reduce(DataFrame.unionByName, parts), "kn-model")
    forget(*steps)
    return model


class Table:
    """Numbers by key: open addressing in numpy, all keys of a query side by side."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        size = 1 << max(4, int(np.ceil(np.log2(max(1, len(keys)) * 3))))
        self.shift = np.uint64(64 - size.bit_length() + 1)
        self.keys, self.values = np.full(size, -1, np.int64), np.zeros(size)
        slot, rest = self.slots(keys), np.arange(len(keys))
        while len(rest):
            empty = self.keys[slot] == -1
            self.keys[slot[empty]] = keys[rest[empty]]  # of several for one slot, the last gets it
            placed = self.keys[slot] == keys[rest]
            self.values[slot[placed]] = values[rest[placed]]
            rest, slot = rest[~placed], (slot[~placed] + 1) % size

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray, absent: float = np.nan) -> np.ndarray:
        out = np.full(len(keys), absent)
        slot, rest = self.slots(keys), None
        while len(slot):
            own = keys if rest is None else keys[rest]
            there = self.keys[slot]
            hit = there == own
            out[np.flatnonzero(hit) if rest is None else rest[hit]] = self.values[slot[hit]]
            go = np.flatnonzero(~hit & (there != -1))
            rest = go if rest is None else rest[go]
            slot = (slot[go] + 1) % len(self.keys)
        return out


class Model:
    """A model held in memory."""

    def __init__(self, table: pa.Table):
        likely = pc.equal(table["kind"], "p").to_numpy()
        orders, grams, values = (table[c].to_numpy() for c in ("order", "gram", "value"))
        self.unseen = float(values[likely & (orders == 0)][0])
        self.p, self.g = {}, {}
        for order in range(1, ORDER + 1):
            for own, tables in ((likely, self.p), (~likely, self.g)):
                some = own & (orders == order)
                tables[order] = Table(grams[some], values[some])

    def log_probabilities(self, grams: np.ndarray) -> np.ndarray:
        out = self.p[ORDER].find(grams)
        rest = np.flatnonzero(np.isnan(out))
        out[rest] = 0.0
        for order in range(ORDER, 0, -1):
            own = grams[rest] & mask(order)
            found = np.zeros(len(rest), bool)
            if order < ORDER:
                value = self.p[order].find(own)
                found = ~np.isnan(value)
                out[rest[found]] += value[found]
            rest, own = rest[~found], own[~found]
            out[rest] += self.g[order].find(own >> BITS, 0.0)
        out[rest] += self.unseen
        return out

    def perplexities(self, texts: list[str | None]) -> np.ndarray:
        """Of each text, NaN for one without a character."""
        grams, begin = symbols([t or "" for t in texts])
        total = np.concatenate([[0.0], np.cumsum(self.log_probabilities(grams))])
        n = np.diff(np.append(begin, len(grams)))
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.exp(-(total[begin + n] - total[begin]) / n)


def _log_probability(model: DataFrame, grams: DataFrame) -> DataFrame:
    """(gram, logp) of distinct n-grams, by joins with the sharded model."""
    unseen = model.filter("kind = 'p' and order = 0").first().value
    out, value = grams, F.lit(unseen)
    for order in range(1, ORDER + 1):
        own = F.col("gram").bitwiseAND(F.lit(mask(order)))
        p = model.filter((F.col("kind") == "p") & (F.col("order") == order)).select(
            F.col("gram").alias(f"_k{order}"), F.col("value").alias(f"_p{order}"))
        g = model.filter((F.col("kind") == "g") & (F.col("order") == order)).select(
            F.col("gram").alias(f"_c{order}"), F.col("value").alias(f"_g{order}"))
        out = out.join(p, own == F.col(f"_k{order}"), "left")
        out = out.join(g, F.shiftright(own, BITS) == F.col(f"_c{order}"), "left")
        value = F.coalesce(F.col(f"_p{order}"), F.coalesce(F.col(f"_g{order}"), F.lit(0.0)) + value)
    return out.select("gram", value.alias("logp"))


def score_by_joins(docs: DataFrame, model: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns but the text, and ``perplexity``: distinct n-grams of each row joined to the sharded model."""
    on_workers(docs.sparkSession)
    names = [c for c in docs.columns if c != text_col]
    keyed = staged(docs.withColumn("_row", F.monotonically_increasing_id()), "kn-rows")

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            for row, text in zip(batch.column("_row").to_pylist(), texts, strict=True):
                grams, n = np.unique(symbols([text])[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(grams), row)), pa.array(grams), pa.array(n)],
                                                 names=["_row", "gram", "n"])

    own = staged(keyed.select("_row", text_col).mapInArrow(rows, "_row long, gram long, n long"), "kn-grams")
    known = _log_probability(model, own.select("gram").distinct())
    scored = (own.join(known, "gram").groupBy("_row")
              .agg(F.exp(-F.sum(F.col("n") * F.col("logp")) / F.sum("n")).alias("perplexity")))
    return keyed.drop(text_col).join(scored, "_row", "left").select(*names, "perplexity")


def score(docs: DataFrame, model: DataFrame, text_col: str = "text", sent_rows: int = SENT_ROWS) -> DataFrame:
    """All columns but the text, and ``perplexity`` (null for texts without a character)."""
    spark = docs.sparkSession
    if model.limit(sent_rows + 1).count() > sent_rows:
        return score_by_joins(docs, model, text_col)
    on_workers(spark)
    shared = spark.sparkContext.broadcast(Model(model.toArrow()))
    names = [c for c in docs.columns if c != text_col]
    schema = T.StructType([*(docs.schema[c] for c in names), T.StructField("perplexity", T.DoubleType())])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            found = shared.value.perplexities(batch.column(text_col).to_pylist())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names),
                                              pa.array(found, pa.float64(), from_pandas=True)], names=schema.names)

    return docs.mapInArrow(rows, schema)


def unseen_scores(trusted: DataFrame) -> DataFrame:
    """(_lang, perplexity) of trusted documents (_lang, _text), each by a model that has not seen its text."""
    part = F.coalesce(F.crc32(F.col("_text").cast("binary")) % FOLDS, F.lit(0))
    dealt = trusted.select("_lang", "_text", part.alias("_part"))
    scored = []
    for k in range(FOLDS):
        own, others = dealt.filter(F.col("_part") == k), dealt.filter(F.col("_part") != k)
        if others.filter(F.length("_text") > 0).isEmpty():
            others = dealt  # nothing else to learn from
        model = train(others.select("_text"), "_text")
        scored.append(staged(score(own.select("_lang", "_text"), model, "_text"), "kn-unseen"))
        forget(model)
    return reduce(DataFrame.unionByName, scored)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", label_col: str = "quality", quantile: float = QUANTILE) -> DataFrame:
    """One row per document: id, language, ``perplexity``, ``threshold`` of its language and ``kept``."""
    marked: Column = F.col("_trusted").isNotNull()
    ids = staged(labels.filter(F.col(label_col) == 1).select(F.col(id_col).alias("_trusted")).dropna().distinct(),
                 "kn-trusted")
    if ids.limit(SENT_ROWS + 1).count() <= SENT_ROWS:
        ids = F.broadcast(ids)
    narrow = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang"))
    known = narrow.join(ids, F.col("_id") == F.col("_trusted"), "left")
    trusted = known.filter(marked).select("_lang", "_text")
    if trusted.filter(F.length("_text") > 0).isEmpty():
        return docs.select(F.col(id_col), F.col(lang_col), F.lit(None).cast("double").alias("perplexity"),
                           F.lit(None).cast("double").alias("threshold"), F.lit(False).alias("kept"))
    unseen = unseen_scores(trusted)
    model = train(trusted.select("_text"), "_text")
    scored = staged(score(known.select("_id", "_lang", "_text"), model, "_text"), "kn-scores")
    forget(model)
    level = F.expr(f"percentile_approx(perplexity, {quantile}, 10000)")
    whole = unseen.agg(level.alias("t")).first().t
    by_lang = unseen.groupBy(F.col("_lang").alias("_of")).agg(level.alias("_t"))
    threshold = F.coalesce("_t", F.lit(whole))
    return (scored.join(by_lang, F.col("_lang").eqNullSafe(F.col("_of")), "left")
            .select(F.col("_id").alias(id_col), F.col("_lang").alias(lang_col), "perplexity",
                    threshold.alias("threshold"),
                    F.coalesce(F.col("perplexity") <= threshold, F.lit(False)).alias("kept")))
