"""Byte-level BPE encoding and decoding with a word automaton.

The corpus' frequent words (all documents are counted) are compiled with their ids
into a minimal acyclic automaton, which tasks map into memory.  A task cuts its
texts at spaces that follow a visible character (always a token boundary), looks
every distinct piece up in the automaton, and encodes the others exactly: the
vocabulary's split pattern, then merges by rank, leftmost first, for many words at
once.  The automaton is a shortcut only: no id depends on which words it holds.

A null text counts as empty and has no ids.  Special tokens in a text become their
ids, as the vocabulary's own library does it.  Texts are encoded whole; repeated
rows give repeated results.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.llm import lexicon
from pagelake.llm.common import on_workers, shared_file, slices, staged

#: Most words in the automaton, and the longest one (longer words are always merged).
LEXICON_WORDS = 65_536
LEXICON_BYTES = 48
#: Distinct words that a counting task holds before it passes them on.
COUNTED_AT_ONCE = 500_000
#: Distinct pieces whose ids a task keeps from slice to slice before it starts anew (fewer where the ids themselves
#: are returned, which takes more memory), and bytes of text in a slice.
KNOWN_PIECES, KNOWN_WITH_IDS, SLICE = 400_000, 80_000, 4 << 20
#: Symbols up to which words are merged side by side; longer ones one by one with a heap.
SIDE_BY_SIDE = 48
NONE = np.int64(1 << 40)
FIRST, SPECIAL = "\ud800", "\ud801"  # marks on pieces; texts hold no lone surrogates

# The split pattern of byte-level BPE vocabularies.
_SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
          r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
_CUT = re.compile(r" (?<=\S )")
_TAIL = frozenset(".,;:!?")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in such vocabularies, as letter -> byte.

    Visible Latin-1 bytes stand for themselves, the others take the letters from U+0100 on.
    """
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> dict[str, np.ndarray]:
    """The vocabulary file as arrays: bytes of every id, id of every byte, merges by pair, special tokens."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters, ids = byte_letters(), spec["model"]["vocab"]
    special = {t["id"]: t["content"] for t in spec["added_tokens"]}
    texts = [b""] * (1 + max([*ids.values(), *special]))
    for token, i in ids.items():
        texts[i] = bytes(letters[c] for c in token)
    for i, token in special.items():
        texts[i] = token.encode()
    of_byte = np.zeros(256, np.int32)
    for letter, byte in letters.items():
        of_byte[byte] = ids[letter]
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    pair = np.array([ids[a] << 20 | ids[b] for a, b in merges], np.int64)
    order = np.argsort(pair, kind="stable")
    made = np.array([ids[a + b] for a, b in merges], np.int32)
    return {"id_bytes": np.frombuffer(b"".join(texts), np.uint8),
            "id_end": np.cumsum([len(t) for t in texts]).astype(np.int64), "byte_id": of_byte,
            "pair": pair[order], "pair_rank": order.astype(np.int64), "pair_id": made[order],
            "special": np.array(sorted(special), np.int64)}


class Numbers(dict):
    """Keys numbered as they are asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


class Codec:
    """Encodes pieces with a vocabulary and, if it has one, a word automaton."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        import regex

        self.arrays = arrays
        self.split = regex.compile(_SPLIT).findall
        ends = arrays["id_end"].tolist()
        raw = arrays["id_bytes"].tobytes()
        self.id_bytes = [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        self.names = [str(i) for i in range(len(ends))]
        self.special = {self.id_bytes[i].decode(): i for i in arrays["special"].tolist()}
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
                                        + ")").split if self.special else lambda text: [text]
        self.forget()

    def forget(self) -> None:
        """Drop the pieces that are known so far."""
        self.known = Numbers()
        self.described_as: tuple[list[str], list[int], list[bytes]] = ([], [], [])

    # -- merging ---------------------------------------------------------------

    def ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of the merge of each pair (NONE where there is none)."""
        key = left.astype(np.int64) << 20 | right
        pairs = self.arrays["pair"]
        at = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
        hit = (pairs[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.arrays["pair_rank"][at], NONE), self.arrays["pair_id"][at]

    def merge_side_by_side(self, words: list[bytes]) -> list[list[int]]:
        """The ids of words of similar length: in each round every word makes its best merge."""
        n, width = len(words), max(map(len, words))
        length = np.fromiter(map(len, words), np.int64, n)
        ids = np.full((n, width + 2), -1, np.int64)
        filled = np.arange(width + 2) < length[:, None]
        ids[filled] = self.arrays["byte_id"][np.frombuffer(b"".join(words), np.uint8)]
        rank, made = self.ranked(ids[:, :-1].ravel(), ids[:, 1:].ravel())
        rank, made = rank.reshape(n, width + 1), made.reshape(n, width + 1).astype(np.int64)
        live = np.arange(n)
        done: list[list[int] | None] = [None] * n
        columns = np.arange(width + 1)
        while True:
            best = rank.argmin(1)
            rows = np.arange(len(live))
            over = rank[rows, best] == NONE
            if over.any():
                for row, k in zip(ids[over].tolist(), live[over].tolist(), strict=True):
                    done[k] = row[:row.index(-1)]
                go = ~over
                ids, rank, made, live, best = ids[go], rank[go], made[go], live[go], best[go]
                if not len(live):
                    return done
                rows = np.arange(len(live))
            ids[rows, best] = made[rows, best]
            after = columns[:width] > best[:, None]  # what stands behind the pair moves up by one
            ids[:, 1:width + 1] = np.where(columns[1:] > best[:, None], ids[:, 2:], ids[:, 1:-1])
            rank[:, :width] = np.where(after, rank[:, 1:], rank[:, :width])
            made[:, :width] = np.where(after, made[:, 1:], made[:, :width])
            rank[:, width] = NONE
            rank[rows, best], made[rows, best] = self.ranked(ids[rows, best], ids[rows, best + 1])
            inner = best > 0
            r, b = rows[inner], best[inner]
            rank[r, b - 1], made[r, b - 1] = self.ranked(ids[r, b - 1], ids[r, b])

    def merge_long(self, word: bytes) -> list[int]:
        """The ids of one word of any length, with a heap of its pairs."""
        ids = self.arrays["byte_id"][np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[int, int, int, int, int]] = []
        rank, made = self.ranked(np.array(ids[:-1], np.int64), np.array(ids[1:], np.int64))
        for at in np.flatnonzero(rank != NONE).tolist():
            heap.append((int(rank[at]), at, ids[at], ids[at + 1], int(made[at])))
        heapq.heapify(heap)
        pairs = self.merges()
        while heap:
            _, at, left, right, new = heapq.heappop(heap)
            nxt = after[at]
            if ids[at] != left or nxt < 0 or ids[nxt] != right:
                continue  # one of the two has been merged meanwhile
            ids[at], ids[nxt] = new, -1
            after[at] = after[nxt]
            if after[at] >= 0:
                before[after[at]] = at
            for a, b in ((before[at], at), (at, after[at])):
                if a >= 0 and b >= 0 and (hit := pairs.get(ids[a] << 20 | ids[b])):
                    heapq.heappush(heap, (hit[0], a, ids[a], ids[b], hit[1]))
        return [i for i in ids if i >= 0]

    def merges(self) -> dict[int, tuple[int, int]]:
        if not hasattr(self, "_merges"):
            self._merges = dict(zip(self.arrays["pair"].tolist(), zip(
                self.arrays["pair_rank"].tolist(), self.arrays["pair_id"].tolist(), strict=True), strict=True))
        return self._merges

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word (a token of the split pattern), exactly."""
        out: list = [None] * len(words)
        order = sorted((i for i, w in enumerate(words) if len(w) <= SIDE_BY_SIDE), key=lambda i: len(words[i]))
        for at in range(0, len(order), 8192):
            some = order[at:at + 8192]
            for i, ids in zip(some, self.merge_side_by_side([words[i] for i in some]), strict=True):
                out[i] = ids
        for i, word in enumerate(words):
            if out[i] is None:
                out[i] = self.merge_long(word)
        return out

    # -- pieces ----------------------------------------------------------------

    def pieces(self, text: str) -> list[str]:
        """A text cut where a token boundary is certain; all pieces but marked ones follow a space."""
        out: list[str] = []
        for k, part in enumerate(self.at_special(text) if "<" in text else (text,)):
            if k % 2:
                out.append(SPECIAL + part)
            elif part:
                cut = _CUT.split(part)
                cut[0] = FIRST + cut[0]
                out += cut
        return out

    def tokens(self, piece: str) -> list[str]:
        if piece[:1] == FIRST:
            return self.split(piece[1:])
        if piece.isalpha():
            return [" " + piece]
        if piece[:-1].isalpha() and piece[-1] in _TAIL:
            return [" " + piece[:-1], piece[-1]]
        return self.split(" " + piece)

    def encode_pieces(self, pieces: list[str]) -> list[tuple[str, int, bytes]]:
        """Of each distinct piece: its ids joined by commas, how many they are, and the bytes they stand for."""
        out: list = [None] * len(pieces)
        plain = [i for i, p in enumerate(pieces) if p[:1] not in (FIRST, SPECIAL)]
        for i, found in zip(plain, self.in_lexicon([b" " + pieces[i].encode() for i in plain]), strict=True):
            out[i] = found
        open_: list[tuple[int, list[str]]] = []
        distinct = Numbers()
        for i, piece in enumerate(pieces):
            if out[i] is None:
                if piece[:1] == SPECIAL:
                    out[i] = self.described([self.special[piece[1:]]])
                    continue
                tokens = self.tokens(piece)
                open_.append((i, [distinct[token] for token in tokens]))
        words = [t.encode() for t in distinct]
        merged = self.in_lexicon(words)
        rest = [i for i, found in enumerate(merged) if found is None]
        for i, ids in zip(rest, self.merge([words[i] for i in rest]), strict=True):
            merged[i] = self.described(ids)
        for i, tokens in open_:
            if len(tokens) == 1:
                out[i] = merged[tokens[0]]
            else:
                found = [merged[t] for t in tokens]
                out[i] = (",".join(f[0] for f in found), sum(f[1] for f in found), b"".join(f[2] for f in found))
        return out

    def in_lexicon(self, words: list[bytes]) -> list[tuple[str, int, bytes] | None]:
        """What the automaton holds of these words (with the space before them), None for others."""
        if "edge_key" not in self.arrays or not words:
            return [None] * len(words)
        starts, flat = self.arrays["word_start"], self.arrays["word_ids"]
        number = lexicon.find(self.arrays, words)
        at = np.maximum(number, 0)
        return [self.described(flat[a:b].tolist()) if n >= 0 else None for n, a, b in zip(
            number.tolist(), starts[at].tolist(), starts[at + 1].tolist(), strict=True)]

    def described(self, ids: list[int]) -> tuple[str, int, bytes]:
        return ",".join([self.names[i] for i in ids]), len(ids), b"".join([self.id_bytes[i] for i in ids])

    def encode_texts(self, texts: list[str | None], most_known: int = KNOWN_PIECES) -> Iterator[tuple[str, int, bytes]]:
        """Of each text: ids joined by commas, their number, and the decoded bytes."""
        if len(self.known) > most_known:
            self.forget()
        known = self.known
        before = len(known)
        coded = [list(map(known.__getitem__, self.pieces(t or ""))) for t in texts]
        names, counts, raw = self.described_as
        with collector_paused():
            found = self.encode_pieces(list(known)[before:])
        for column, values in zip(self.described_as, zip(*found, strict=True), strict=False):
            column.extend(values)
        for codes in coded:
            yield (",".join(map(names.__getitem__, codes)), sum(map(counts.__getitem__, codes)),
                   b"".join(map(raw.__getitem__, codes)))

    def encode(self, text: str | None) -> list[int]:
        ids = next(self.encode_texts([text]))[0]
        return [int(i) for i in ids.split(",")] if ids else []

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join([self.id_bytes[i] for i in ids]).decode("utf-8", "replace")


@contextmanager
def collector_paused() -> Iterator[None]:
    """No search for reference cycles meanwhile: the many small tuples of a slice make none."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def count_words(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, n): how often each word that follows a space occurs, over all documents."""
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            some = [(w, n) for w, n in counts.items() if 0 < len(w) <= LEXICON_BYTES]
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.string()),
                                               pa.array([n for _, n in some], pa.int64())], names=["word", "n"])

        for batch in slices(batches, text_col):
            for text in batch.column(text_col).to_pylist():
                counts.update(_CUT.split(text or "")[1:])
            if len(counts) >= COUNTED_AT_ONCE:
                yield out()
        yield out()

    return (docs.select(text_col).mapInArrow(rows, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def frequent_words(docs: DataFrame, text_col: str = "text", most: int = LEXICON_WORDS) -> list[str]:
    """The most frequent words, at most ``most``: all those from the lowest count level that fits.

    Counts cover every document.  Levels are eighths of a doubling, so that the
    driver gets a short histogram and then at most ``most`` words.
    """
    counted = staged(count_words(docs, text_col).filter("n > 1")
                     .withColumn("level", F.floor(F.log2("n") * 8).cast("int")), "bpe-words")
    total, least = 0, None
    for level, words in sorted(((r.level, r["count"]) for r in counted.groupBy("level").count().collect()),
                               reverse=True):
        total += words
        if total > most:
            break
        least = level
    if least is None:
        return []
    return [r.word for r in counted.filter(F.col("level") >= least).select("word").collect()]


def build_model(spark: SparkSession, vocabulary: str, words: Iterable[str]) -> bytes:
    """Vocabulary and word automaton as one packed block."""
    arrays = read_vocabulary(vocabulary)
    codec = Codec(arrays)
    keyed = sorted({b" " + w.encode(): w for w in words}.items())
    keyed = [(k, w) for k, w in keyed if len(k) <= LEXICON_BYTES]
    ids = [[int(i) for i in found[0].split(",")] for found in codec.encode_pieces([w for _, w in keyed])]
    arrays |= lexicon.build([k for k, _ in keyed])
    arrays["word_start"] = np.cumsum([0, *map(len, ids)]).astype(np.int64)
    arrays["word_ids"] = np.array([i for x in ids for i in x], np.int32)
    return lexicon.pack(arrays)


_CODECS: dict[str, Codec] = {}


def codec_of(name: str) -> Codec:
    """The codec of a file that Spark gave to this executor, loaded once per worker."""
    from pyspark import SparkFiles

    if name not in _CODECS:
        _CODECS.clear()
        _CODECS[name] = Codec(lexicon.mapped(SparkFiles.get(name)))
    return _CODECS[name]


def publish_model(docs: DataFrame, vocabulary: str, text_col: str = "text") -> str:
    """Count, compile and hand out the model of a corpus; the name that :func:`codec_of` takes."""
    spark = docs.sparkSession
    on_workers(spark)
    model = build_model(spark, vocabulary, frequent_words(docs, text_col))
    return shared_file(spark, "bpe-model", model, "words.bin")


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                     digests: bool = False) -> DataFrame:
    """One row per document: its id, ``ids`` (array) and the ``decoded`` text.

    With ``digests`` the same content as ``n_tokens`` and the SHA-256 of the ids
    (decimal, joined by commas) and of the decoded text in UTF-8.
    """
    model = publish_model(docs, vocabulary, text_col)
    narrow = docs.select(id_col, text_col)
    more = ([("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
            if digests else [("ids", T.ArrayType(T.IntegerType())), ("decoded", T.StringType())])
    schema = T.StructType([narrow.schema[id_col], *(T.StructField(n, k) for n, k in more)])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model)
        for batch in slices(batches, text_col, SLICE if digests else SLICE // 2):
            found = codec.encode_texts(batch.column(text_col).to_pylist(), KNOWN_PIECES if digests else KNOWN_WITH_IDS)
            if digests:
                made = [(n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(
                    raw.decode("utf-8", "replace").encode()).hexdigest()) for ids, n, raw in found]
                kinds = [pa.int64(), pa.string(), pa.string()]
            else:
                made = [(np.fromstring(ids, np.int32, sep=","), raw.decode("utf-8", "replace")) for ids, n, raw in found]
                kinds = [pa.list_(pa.int32()), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), *(pa.array([m[k] for m in made], kind) for k, kind in enumerate(kinds))],
                names=schema.names)

    return narrow.mapInArrow(rows, schema)
