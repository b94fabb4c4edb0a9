"""Fuzzy line deduplication by MinHash, with DataFrame functions only.

Lines (split at ``\\n``) of at least ``least_chars`` characters count (0 unless the caller sets it);
blank ones never do, they are always kept.  Two lines are linked if the Jaccard
similarity of their character shingles (every eight bytes of the UTF-8 form; the line itself if it is
shorter) is at least :data:`SIMILARITY`; equal lines are one node from the start.  Of every component the first
line is kept, by document id, then place in the text.

1. Signatures: a line's shingles are hashed once (XXH64).  Of each of 32 fixed numbers,
   the shingle nearest to it (least exclusive-or) is the same for two lines with the
   probability of their similarity.  Documents are dealt out by their own key first, so the
   minima need no further exchange, and equal lines never meet in one task.
2. Banding: eight bands of four minima find 98.5 % of the pairs at similarity 0.8, and
   99.7 % at 0.85.  Only bands that two different lines share go on.  Two lines that share a
   band are candidates if at least :data:`AGREEING` of all 32 minima agree (by eight bits of each),
   which 99.9 % of the pairs at similarity 0.8 do, and few of those below 0.5.
3. Verification: all candidates of a bucket of up to :data:`BUCKET` lines are compared exactly,
   by the number of different shingles that both lines have together.
   Larger ones are connected over a central line (:func:`crowded_links`), with the same result.
   Parity sketches of the shingle sets (:func:`sketched`) come first: the bits in which two of them
   differ are never more than the shingles that only one line has, so no similar pair is ruled out.
4. Union-find: :func:`pagelake.llm.graph.connected_components`.

Lines are told apart by their 64-bit hash.  A null text has no lines.  Null ids come
last in the order.  Rows repeated with id and text are kept or cut alike.  Lines of any
length are taken whole.  An empty table gives an empty result.
"""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import SENT_ROWS, forget, fresh, small, staged
from pagelake.llm.graph import connected_components

#: The least characters of a line that counts, where the caller sets no other.
LEAST_CHARS = 0
SHINGLE = 8
#: Shingles that one row of the signature's aggregate takes in.
AT_ONCE = 16
SIMILARITY = 0.8
BANDS, ROWS = 8, 4
#: Minima, of all, that two candidates share at least.
AGREEING = 18
#: Words of 64 bits in a parity sketch.
WORDS = 16
#: Lines in a bucket up to which all its pairs are compared.
BUCKET = 16

_ANCHORS = [random.Random(1000 + k).getrandbits(64) - (1 << 63) for k in range(BANDS * ROWS)]


def counts(line: Column, least_chars: int) -> Column:
    """Whether a line counts: long enough and not blank."""
    return (F.length(line) >= least_chars) & line.rlike(r"\S")


def lines_of(docs: DataFrame, id_col: str, text_col: str, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(id, _row, _at, _line): the lines that count; _row tells texts of one id apart."""
    parts = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_row"),
                        F.posexplode(F.split(F.col(text_col), "\n")).alias("_at", "_line"))
    return parts.filter(counts(F.col("_line"), least_chars))


def hashed(lines: DataFrame, *keys: str) -> DataFrame:
    """(keys, _h0, _h1, ...): the hashed shingles of ``_raw``, a line's UTF-8 form, :data:`AT_ONCE` to a row.

    A line of fewer bytes than a shingle is its only shingle.  Beyond a line's end its last shingle repeats.
    XXH64 is one-to-one on eight bytes, so equal hashes are equal shingles.
    """
    last = F.greatest(F.octet_length("_raw") - (SHINGLE - 1), F.lit(1))
    places = lines.select(*keys, "_raw", last.alias("_last"), F.explode(F.sequence(F.lit(1), last, F.lit(AT_ONCE))).alias("_i"))
    return places.select(*keys, *[
        F.xxhash64(F.substring(F.col("_raw"), F.least(F.col("_i") + k, F.col("_last")), F.lit(SHINGLE))).alias(f"_h{k}")
        for k in range(AT_ONCE)])


def shingle_sets(lines: DataFrame, *keys: str) -> DataFrame:
    """(keys, _set): the different hashed shingles of all lines ``_line`` of each key; lines dealt out by keys stay where they are."""
    cut = hashed(lines.select(*keys, F.col("_line").cast("binary").alias("_raw")), *keys)
    some = cut.select(*keys, F.array(*[f"_h{k}" for k in range(AT_ONCE)]).alias("_some"))
    return some.groupBy(*keys).agg(F.array_distinct(F.flatten(F.collect_list("_some"))).alias("_set"))


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               least_chars: int = LEAST_CHARS) -> DataFrame:
    """(_id, _row, _at, _node, _bands, _low): every line that counts, its hash, its band keys, and the low bytes of its
    minima, eight to a number."""
    dealt = docs.select(F.col(id_col), F.col(text_col), F.xxhash64(text_col).alias("_row")).repartition(id_col, "_row")
    lines = dealt.select(F.col(id_col).alias("_id"), "_row",
                         F.posexplode(F.split(F.col(text_col), "\n")).alias("_at", "_line"))
    lines = lines.filter(counts(F.col("_line"), least_chars)).select(
        "_id", "_row", "_at", F.xxhash64("_line").alias("_node"), F.col("_line").cast("binary").alias("_raw"))
    # several shingles a row spare look-ups of the row's group; a repeated one changes no minimum
    cut = hashed(lines, "_id", "_row", "_at", "_node")
    least = cut.groupBy("_id", "_row", "_at", "_node").agg(
        *[F.min(F.least(*[F.col(f"_h{n}").bitwiseXOR(F.lit(a)) for n in range(AT_ONCE)])).alias(f"_m{k}")
          for k, a in enumerate(_ANCHORS)])
    bands = F.array(*[F.xxhash64(F.lit(b), *[f"_m{b * ROWS + r}" for r in range(ROWS)]) for b in range(BANDS)])
    low = F.array(*[reduce(Column.bitwiseOR, [F.shiftleft(F.col(f"_m{8 * w + k}").bitwiseAND(F.lit(255)), 8 * k)
                                              for k in range(8)]) for w in range(BANDS * ROWS // 8)])
    return least.select("_id", "_row", "_at", "_node", bands.alias("_bands"), low.alias("_low"))


def alike(a: Column, b: Column) -> Column:
    """Whether enough minima of two lines agree, given their low bytes."""
    differing, lanes = F.lit(0), 0x00FF00FF00FF00FF
    for w in range(BANDS * ROWS // 8):
        x = F.get(a, w).bitwiseXOR(F.get(b, w))
        for every_other in (x, F.shiftrightunsigned(x, 8)):  # a byte that is not zero carries into the empty one above it
            carried = every_other.bitwiseAND(F.lit(lanes)) + F.lit(lanes)
            differing = differing + F.bit_count(carried.bitwiseAND(F.lit(0x0100010001000100)))
    return differing <= BANDS * ROWS - AGREEING


def sketched(texts: DataFrame) -> DataFrame:
    """(_node, _line) with the number of different shingles ``_n`` and their parity sketch ``_odd``.

    Each shingle flips one bit of the sketch.  A shingle that two lines share flips the same bit of both.
    """
    cut = shingle_sets(texts.repartition("_node"), "_node").select("_node", F.explode("_set").alias("_h"))
    cut = cut.select("_node", F.col("_h").bitwiseAND(F.lit(WORDS - 1)).alias("_word"),
                     F.expr("shiftleft(1L, cast(shiftright(_h, 32) & 63 as int))").alias("_bit"))
    odd = [F.bit_xor(F.when(F.col("_word") == w, F.col("_bit")).otherwise(F.lit(0).cast("long"))) for w in range(WORDS)]
    words = F.struct(*[word.alias(f"w{w}") for w, word in enumerate(odd)])  # read with less code than an array
    made = cut.groupBy("_node").agg(F.count("*").alias("_n"), words.alias("_odd"))
    return texts.select("_node", "_line").join(made, "_node")


def near(a: Column, a_n: Column, b: Column, b_n: Column) -> Column:
    """Whether two lines can be similar enough, given their sketches and numbers of shingles."""
    apart = reduce(Column.__add__, [F.bit_count(a[f"w{w}"].bitwiseXOR(b[f"w{w}"])) for w in range(WORDS)])
    return F.greatest(apart, F.abs(a_n - b_n)) * (1 + SIMILARITY) <= (a_n + b_n) * (1 - SIMILARITY) + 1e-6


def similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (u, v) whose lines are similar enough; ``texts`` as of :func:`sketched`."""
    x = texts.select(F.col("_node").alias("u"), F.col("_line").alias("_x"), F.col("_n").alias("_xn"), F.col("_odd").alias("_xo"))
    y = texts.select(F.col("_node").alias("v"), F.col("_line").alias("_y"), F.col("_n").alias("_yn"), F.col("_odd").alias("_yo"))
    joined = pairs.join(x, "u").join(y, "v").filter(near(F.col("_xo"), F.col("_xn"), F.col("_yo"), F.col("_yn")))
    # the lines of a pair are dealt out before they are cut, so that only texts move
    lines = joined.select("u", "v", "_xn", "_yn", "_x", "_y").repartition("u", "v").select(
        "u", "v", "_xn", "_yn", F.explode(F.array("_x", "_y")).alias("_line"))
    counted = shingle_sets(lines, "u", "v", "_xn", "_yn").withColumn("_all", F.size("_set"))
    return counted.filter((F.col("_xn") + F.col("_yn") - F.col("_all")) / F.col("_all") >= SIMILARITY).select("u", "v")


def pairs_within(buckets: DataFrame) -> DataFrame:
    """All candidates (u, v) in each bucket (_band, _node, _low), once."""
    x, y = buckets.select("_band", "_node", "_low").alias("x"), buckets.select("_band", "_node", "_low").alias("y")
    both = x.join(y, (F.col("x._band") == F.col("y._band")) & (F.col("x._node") < F.col("y._node"))
                  & alike(F.col("x._low"), F.col("y._low")))
    return both.select(F.col("x._node").alias("u"), F.col("y._node").alias("v")).distinct()


def sized(buckets: DataFrame) -> DataFrame:
    """Buckets (_band, _node, _low) of at least two nodes, with the number of nodes ``_n``."""
    return buckets.join(buckets.groupBy("_band").agg(F.count("*").alias("_n")).filter("_n > 1"), "_band")


def links(docs: DataFrame, marked: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          least_chars: int = LEAST_CHARS) -> DataFrame:
    """Verified edges (u, v) between different lines, from a written table of signatures."""
    rows = marked.select("_node", "_low", F.explode("_bands").alias("_band"))
    live = staged(rows.groupBy("_band").agg(F.min("_node").alias("_least"), F.max("_node").alias("_most"))
                  .filter("_least < _most").select("_band"), "lines-bands")
    buckets = staged(sized(rows.join(small(live), "_band", "left_semi")
                    .dropDuplicates(["_node", "_band"])), "lines-buckets")
    pairs = staged(pairs_within(buckets.filter(F.col("_n") <= BUCKET)), "lines-candidates")
    crowded = staged(buckets.filter(F.col("_n") > BUCKET).select("_band", "_node", "_low"), "lines-crowded")
    forget(live, buckets)
    wanted = staged(pairs.select(F.explode(F.array("u", "v")).alias("_w")).union(crowded.select("_node")).distinct(),
                    "lines-wanted")
    texts = lines_of(docs, id_col, text_col, least_chars).select(F.xxhash64("_line").alias("_node"), "_line")
    plain = staged(texts.join(small(wanted), F.col("_node") == F.col("_w"), "left_semi").groupBy("_node").agg(
        F.first("_line").alias("_line")), "lines-texts")
    texts = staged(sketched(plain), "lines-texts")
    forget(plain)
    found = staged(similar(pairs, texts), "lines-links")
    forget(pairs, wanted)
    return found if crowded.isEmpty() else crowded_links(found, crowded, texts)


def crowded_links(found: DataFrame, crowded: DataFrame, texts: DataFrame) -> DataFrame:
    """The edges ``found`` so far, and those of buckets (_band, _node) with many lines.

    A bucket's pivot is the line with the largest share of shingles that other crowded
    lines have too, the one the others are variants of.  All lines are compared with it.
    Lines that are not in its component then are compared with every line of the bucket
    outside their own component.  Pairs are left out where the sketches, or the shingles that no other
    crowded line has, rule the similarity out.  That connects what all pairs of the
    bucket would connect.
    """
    own = staged(texts.join(crowded.select("_node").distinct(), "_node", "left_semi"), "lines-crowded")
    cut = hashed(own.select("_node", F.col("_line").cast("binary").alias("_raw")), "_node")
    shingles = cut.select("_node", F.explode(F.array(*[f"_h{k}" for k in range(AT_ONCE)])).alias("_shingle"))
    alone = (shingles.groupBy("_shingle").agg(F.min("_node").alias("_node"), F.max("_node").alias("_other"))
             .filter("_node = _other").groupBy("_node").agg(F.count("*").alias("_alone")))
    counted = own.join(alone, "_node", "left").select(
        "_node", "_n", "_odd", (F.col("_n") - F.coalesce("_alone", F.lit(0))).alias("_common"))
    members = staged(crowded.join(counted, "_node"), "lines-members")
    best = F.max(F.struct((F.col("_common") / F.col("_n")).alias("share"), F.col("_node").alias("node"),
                          F.col("_n").alias("n"), F.col("_common").alias("common"), F.col("_low").alias("low"), F.col("_odd").alias("odd")))
    pivots = staged(members.groupBy("_band").agg(best.alias("p")).select(
        "_band", F.col("p.node").alias("_node"), F.col("p.n").alias("_n"), F.col("p.common").alias("_common"),
        F.col("p.low").alias("_low"), F.col("p.odd").alias("_odd")), "lines-pivots")
    m, p = members.alias("m"), pivots.alias("p")
    star = m.join(p, (F.col("m._band") == F.col("p._band")) & (F.col("m._node") != F.col("p._node")) & _possible("m", "p"))
    found = staged(found.unionByName(similar(_pairs(star, "m", "p"), texts)), "lines-links")

    parts = staged(connected_components(found, "lines-found"), "lines-found")
    placed = members.join(small(parts), F.col("_node") == F.col("node"), "left").select(
        *members.columns, F.coalesce("root", "_node").alias("_part"))
    hub = pivots.select(F.col("_band").alias("_b"), F.col("_node").alias("_pivot"))
    placed = placed.join(hub, F.col("_band") == F.col("_b")).drop("_b")
    of_pivot = placed.filter("_node = _pivot").select(F.col("_band").alias("_b"), F.col("_part").alias("_main"))
    placed = staged(placed.filter("_node <> _pivot").join(of_pivot, F.col("_band") == F.col("_b")).drop("_b"),
                    "lines-placed")
    of_line = placed.groupBy("_node").agg(F.collect_set("_band").alias("_bands")).withColumnRenamed("_node", "_of")
    placed = staged(placed.join(of_line, F.col("_node") == F.col("_of")).drop("_of"), "lines-placed")
    out, rest = placed.filter("_part <> _main").alias("o"), placed.alias("m")
    # once: if both are outside, from the smaller one; of the buckets that they share, in the first (compared last, for few pairs)
    once = (F.col("m._part") == F.col("m._main")) | (F.col("o._node") < F.col("m._node"))
    first = F.array_min(F.array_intersect("o._bands", "m._bands")) == F.col("o._band")
    apart = out.join(rest, (F.col("o._band") == F.col("m._band")) & (F.col("o._part") != F.col("m._part")) & once
                     & _possible("o", "m") & first)
    more = staged(similar(_pairs(apart, "o", "m"), texts), "lines-links")
    return parts.select(F.col("root").alias("u"), F.col("node").alias("v")).unionByName(more)


def _possible(a: str, b: str) -> Column:
    """Whether two lines are candidates, and can be similar enough, given their sketches and the shingles that only one line has.

    The cheapest test comes first: all pairs of a crowded bucket may get here.  The code that Spark makes of a join with
    these tests must stay below 8,000 bytes, beyond which the JVM only interprets it.
    """
    sketch = near(F.col(f"{a}._odd"), F.col(f"{a}._n"), F.col(f"{b}._odd"), F.col(f"{b}._n"))
    most = F.least(f"{a}._common", f"{b}._common")
    shared = most >= (SIMILARITY - 1e-9) * (F.col(f"{a}._n") + F.col(f"{b}._n") - most)
    return shared & alike(F.col(f"{a}._low"), F.col(f"{b}._low")) & sketch


def _pairs(joined: DataFrame, a: str, b: str) -> DataFrame:
    return joined.select(F.least(f"{a}._node", f"{b}._node").alias("u"),
                         F.greatest(f"{a}._node", f"{b}._node").alias("v")).distinct()


def classed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            least_chars: int = LEAST_CHARS) -> DataFrame:
    """(_id, _row, _at, _first): every line that counts, and the first line (``no_id, id, row, at``) of its component."""
    marked = staged(signatures(docs, id_col, text_col, least_chars), "lines-signatures")
    parts = connected_components(links(docs, marked, id_col, text_col, least_chars), "lines")
    placed = marked.select("_id", "_row", "_at", "_node").join(
        small(parts), F.col("_node") == F.col("node"), "left").select(
        "_id", "_row", "_at", F.coalesce("root", "_node").alias("_part"))
    order = F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"), F.col("_row").alias("row"),
                     F.col("_at").alias("at"))
    first = placed.groupBy("_part").agg(F.min(order).alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    return placed.join(first.drop("_n"), "_part", "left").select(
        "_id", "_row", "_at", F.coalesce("_first", order).alias("_first"))


def _kept() -> Column:
    return (F.col("_first.id").eqNullSafe(F.col("_id")) & (F.col("_first.row") == F.col("_row"))
            & (F.col("_first.at") == F.col("_at")))


def line_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 least_chars: int = LEAST_CHARS) -> DataFrame:
    """One row per line that counts: document id, ``line`` (from 0), id and line of its class's first line, ``kept``."""
    return classed(docs, id_col, text_col, least_chars).select(
        F.col("_id").alias(id_col), F.col("_at").alias("line"), F.col("_first.id").alias("class_doc_id"),
        F.col("_first.at").alias("class_line"), _kept().alias("kept"))


def clean_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    chars_col: str | None = "n_chars", least_chars: int = LEAST_CHARS) -> DataFrame:
    """The documents without the lines that repeat an earlier one; all rows and columns stay.

    ``chars_col``, where the table has it, is set to the new length of changed texts.
    """
    cut = (classed(docs, id_col, text_col, least_chars).filter(~_kept()).groupBy("_id", "_row")
           .agg(F.collect_set("_at").alias("_cut")))
    cut = staged(cut, "lines-cut")
    if cut.agg(F.coalesce(F.sum(F.size("_cut") + 1), F.lit(0))).first()[0] <= SENT_ROWS:
        cut = F.broadcast(cut)  # else the documents are dealt out once more
    row, gone = fresh(docs, "_row"), fresh(docs, "_cut")
    rows = docs.withColumn(row, F.xxhash64(text_col)).alias("d")
    joined = rows.join(cut.alias("c"), F.col(f"d.{id_col}").eqNullSafe(F.col("c._id"))
                       & (F.col(f"d.{row}") == F.col("c._row")), "left").select("d.*", F.col("c._cut").alias(gone))
    shorter = F.array_join(F.filter(F.split(F.col(text_col), "\n"), lambda line, i: ~F.array_contains(gone, i)), "\n")
    changed = joined.withColumn(text_col, F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(shorter))
    if chars_col and chars_col in docs.columns:
        changed = changed.withColumn(chars_col, F.when(F.col(gone).isNull(), F.col(chars_col)).otherwise(
            F.length(text_col)).cast(docs.schema[chars_col].dataType))
    return changed.select(*docs.columns)
