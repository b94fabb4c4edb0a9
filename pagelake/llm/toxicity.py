"""Toxicity by compression distance.

Two zstandard dictionaries are trained, on ordinary and on toxic text.  A text is cut
into windows of a few words; a window's saving is how many bytes fewer it takes with
the toxic dictionary at hand than with the ordinary one alone.  A logistic model of
the windows' savings, calibrated on labelled documents, turns them into a score.

The labelled sample is bounded by :data:`TOXIC_DOCUMENTS` and :data:`ORDINARY_DOCUMENTS`
different texts (of the ids with the smallest hashes); scoring covers every whole text.  For
calibration each of :data:`FOLDS` parts of the sample is measured with dictionaries of
the others.  Toxic samples are reduced to the words that are typical of toxic documents,
since a dictionary holds only what recurs.  The beginning of each word is put in
capitals, so that it does not match the inside of longer words.

One model serves all documents: language, source, ids and labels are no inputs of a score.

A null text counts as empty and is scored like one.  Documents without labels, with
null labels or with a null id are scored, never learned from.  If one of the classes
has no labelled document, every score is the share of toxic labels (0 without any).  An
empty table gives no rows; equal texts have equal scores.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.llm.common import on_workers, slices

#: Most labelled documents that are learned from, by class.
TOXIC_DOCUMENTS = 2000
ORDINARY_DOCUMENTS = 4000
WINDOW_WORDS = 5
DICTIONARY_BYTES = 8192
LEVEL, SHORTEST_MATCH = 9, 6
#: A word is typical if its excess in toxic documents is so many standard deviations.
LEAST_EXCESS = 5.0
#: Bytes at the beginning of each word that are put in capitals.
BEGINNING = 8
#: Parts of the sample for calibration.
FOLDS = 5
#: Savings, in bytes, from which windows are counted.
SAVINGS = (4, 6, 8)
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def windows(words: list[bytes], size: int = WINDOW_WORDS) -> list[bytes]:
    words = [w[:BEGINNING].upper() + w[BEGINNING:] for w in words]
    return [b" ".join([b"", *words[at:at + size], b""]) for at in range(0, max(1, len(words)), size)]


@dataclass
class Model:
    """Dictionaries (raw content) and the weights of the calibrated score."""

    ordinary: bytes
    toxic: bytes
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    spread: np.ndarray = field(default_factory=lambda: np.ones(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))

    def __post_init__(self):
        self._pair = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_pair"} | {"_pair": None}

    def compressors(self):
        import zstandard

        if self._pair is None:
            settings = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, min_match=SHORTEST_MATCH, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0,
                write_checksum=0, write_dict_id=0)
            made = []
            for content in (self.ordinary, self.toxic + self.ordinary):
                known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                known.precompute_compress(compression_params=settings)
                made.append(zstandard.ZstdCompressor(dict_data=known, compression_params=settings))
            self._pair = made
        return self._pair

    def savings(self, words: list[bytes]) -> np.ndarray:
        """The bytes that each window saves with the toxic dictionary."""
        plain, toxic = self.compressors()
        return np.array([len(plain.compress(w)) - len(toxic.compress(w)) for w in windows(words)], float)

    def features(self, text: str | None) -> list[float]:
        saved = np.sort(self.savings(words_of(text)))[::-1]
        n = len(saved)
        over = [(saved >= s).sum() for s in SAVINGS]
        top = max(0.0, saved[0])
        return [saved[0], saved[min(1, n - 1)], saved[:3].mean(), saved.mean(), saved[0] ** 2, *np.log1p(over),
                np.log(n), over[0] / n, over[1] / n, np.sqrt(top) * np.log(n)]

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        texts = list(texts)
        if not len(self.mean):
            with np.errstate(over="ignore"):
                return np.full(len(texts), 1 / (1 + np.exp(-self.weights[-1])))
        rows = (np.array([self.features(t) for t in texts]).reshape(len(texts), -1) - self.mean) / self.spread
        return 1 / (1 + np.exp(-np.clip(rows @ self.weights[:-1] + self.weights[-1], -50, 50)))


def typical_words(own: list[list[bytes]], other: list[list[bytes]]) -> set[bytes]:
    """Words in far more documents of the first class than chance would have there."""
    mine, theirs = Counter(), Counter()
    for words in own:
        mine.update(set(words))
    for words in other:
        theirs.update(set(words))
    share = len(own) / max(1, len(own) + len(other))
    excess = {}
    for word, n in mine.items():
        expected = (n + theirs[word]) * share
        excess[word] = (n - expected) / (expected + 0.5) ** 0.5
    bar = min(LEAST_EXCESS, max(excess.values(), default=0))
    return {w for w, e in excess.items() if e >= bar}


def trained(samples: list[bytes]) -> bytes:
    """The content of a zstandard dictionary trained on samples (the samples themselves where they are too few)."""
    import zstandard

    if sum(map(len, samples)) > DICTIONARY_BYTES:
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except zstandard.ZstdError:
            pass  # too few distinct samples
    return b"".join(dict.fromkeys(samples))[-DICTIONARY_BYTES:]


def dictionaries(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> Model:
    """The two dictionaries of a labelled sample."""
    typical = typical_words(toxic, ordinary)
    samples = [w for words in toxic for w in windows([x for x in words if x in typical], 8) if w.strip()]
    plain = [w for words in ordinary for w in windows(words, 8) if w.strip()]
    return Model(trained(plain), trained(samples))


def calibrate(model: Model, rows: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> Model:
    """Fit the score: penalised logistic regression by Newton's method."""
    model.mean, model.spread = rows.mean(0), rows.std(0)
    model.spread[model.spread < 1e-6] = 1.0  # a figure that never varied in the sample
    x = np.column_stack([(rows - model.mean) / model.spread, np.ones(len(rows))])
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), 1.0)
    ridge[-1] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        slope = x.T @ (weight * (p - labels)) + ridge * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    model.weights = w
    return model


def fit(texts: list[str], labels: list[int], toxic_share: float | None = None) -> Model:
    """A model from labelled texts; ``toxic_share``: that of all labels, if the sample's differs."""
    known: dict[str, int] = {}
    for text, label in zip(texts, labels, strict=True):
        known[text] = max(label, known.get(text, 0))  # copies of a text count once
    texts = sorted(known, key=lambda t: zlib.crc32(t.encode("utf-8", "surrogatepass")))
    y = np.array([known[t] for t in texts], float)
    if not len(y) or y.min() == y.max():
        share = float(np.mean(labels)) if labels else 0.0
        with np.errstate(divide="ignore"):
            return Model(b"", b"", weights=np.array([np.log(share) - np.log1p(-share)]))
    words = [words_of(t) for t in texts]

    def of(rows: Iterable[int]) -> Model:
        rows = list(rows)
        return dictionaries([words[i] for i in rows if y[i]], [words[i] for i in rows if not y[i]])

    model = of(range(len(texts)))
    features: dict[int, list[float]] = {}
    for fold in range(FOLDS):
        others = of(i for i in range(len(texts)) if i % FOLDS != fold)
        features |= {i: others.features(texts[i]) for i in range(fold, len(texts), FOLDS)}
    rows = np.array([features[i] for i in range(len(texts))])
    share = y.mean() if toxic_share is None else min(max(toxic_share, 1e-6), 1 - 1e-6)
    weight = np.where(y > 0, share / y.mean(), (1 - share) / (1 - y.mean()))
    return calibrate(model, rows, y, weight)


def held_out(id_col: str):
    """Whether a document is kept from learning: crc32 of its id's text, modulo 5, is 0 (false for a null id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model:
    """Learn from labelled documents that are not held out: at most the documented number of texts of each class."""
    marked = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
              .dropna().filter(~held_out("id")).groupBy("id").agg(F.max("label").alias("label")))
    kind = (F.col("label") > 0).cast("int")
    counts = {r.label: r["count"] for r in marked.groupBy(kind.alias("label")).count().collect()}

    def some(df: DataFrame, key: str) -> DataFrame:
        """The documented number of rows of each class, by their key's hash."""
        parts = [df.filter(kind == k).orderBy(F.xxhash64(key), key).limit(most)
                 for k, most in ((1, TOXIC_DOCUMENTS), (0, ORDINARY_DOCUMENTS))]
        return parts[0].unionByName(parts[1])

    chosen = some(marked, "id").select("id", kind.alias("label"))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(chosen, "id")
    texts = texts.groupBy(F.sha2("text", 256).alias("digest")).agg(  # rows that repeat an id or a text count once
        F.first("text").alias("text"), F.max("label").alias("label"))
    rows = some(texts, "digest").select("text", "label").collect()
    total = sum(counts.values())
    return fit([r.text for r in rows], [r.label for r in rows], counts.get(1, 0) / total if total else None)


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, whether it is held out, ``score`` (0 to 1) and ``predicted``."""
    spark = docs.sparkSession
    on_workers(spark)
    shared = spark.sparkContext.broadcast(model)  # two dictionaries of a few kilobytes
    narrow = docs.select(id_col, text_col, held_out(id_col).alias("held_out"))
    schema = T.StructType([narrow.schema[id_col], T.StructField("held_out", T.BooleanType()),
                           T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            scores = shared.value.scores(batch.column(text_col).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array(scores >= 0.5).cast(pa.int32())], names=schema.names)

    return narrow.mapInArrow(rows, schema)
