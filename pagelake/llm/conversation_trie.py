"""Prefix trie of conversations, built as a burst trie.

Every turn gets an id (a 128-bit digest of role and text), so a conversation is a string
of turn ids and a node of the trie a distinct prefix of such strings.  Equal
conversations become one weighted string first.  A container holds the strings
below one trie head; a container with more turns than ``CONTAINER_TURNS`` bursts: its strings
move to containers by the next turn id behind what they all share.  The remaining
containers are dealt over the tasks, sorted, and each is swept once into its nodes.
The heads above them are summed from their containers, burst round by burst round.

Nothing is gathered by conversation or by node but bounded pieces: turns are numbered
by range partitions, a string is at most ``STRING_TURNS`` turns, and the rest of a longer conversation is
a string of a next layer, whose head is the whole prefix before it.  Layers are swept from the
deepest on, and hand their sums to the strings they continue.  The digest of the ids that
end at a node reads them sorted, as a stream.

Defined cases: a null role or text is empty; turns of equal number are ordered by their
turn ids (digests); repeated rows are turns like any other; rows without conversation
id are left out; a conversation without rebuilt turns is a member of the root only; texts
of any length count whole.  An empty table has no nodes, not even a root.  Other
columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.llm.common import on_workers, small, staged
from pagelake.operators.index import with_row_index

#: Characters of a turn id.
ID = 32
STRING_TURNS = 4096
CONTAINER_TURNS = 100_000
#: Conversations share the opening of the one at the start of their block of ids, up to so many turns less one.
BLOCK, MOST_SHARED = 100, 6
ROOT = "0" * ID
NOBODY = hashlib.sha256(b"").hexdigest()


def digest(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, ID)


# ---------------------------------------------------------------------------
# Turns and strings
# ---------------------------------------------------------------------------


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv, pos, id, size): turn ids in order, from 1; size is the text's code points.  No texts from here on."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn",
        digest(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)).alias("id"),
        F.char_length(text).cast("long").alias("size"))
    placed = turns.repartitionByRange("conv", "turn", "id").sortWithinPartitions("conv", "turn", "id")
    rows = with_row_index(placed, "at")  # a long conversation may lie in many partitions
    first = rows.groupBy("conv").agg(F.min("at").alias("first"))
    return rows.join(first, "conv").select("conv", (F.col("at") - F.col("first") + 1).alias("pos"), "id", "size")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of the rebuilt conversations (conv, place, id, size), and (conv, turns) of all of them.

    A conversation opens with the first h turns of its block's first one, then come its own turns after its first h;
    h is drawn from its id.
    """
    own = staged(turns.groupBy("conv").agg(F.count("*").alias("own"))
                 .withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % MOST_SHARED)
                 .withColumn("lead", F.col("conv") - F.col("conv") % BLOCK), "trie-conversations")
    leads = own.select(F.col("conv").alias("lead"), F.col("own").alias("lead_own"))
    convs = staged(own.join(leads, "lead", "left").select(
        "conv", "h", "lead", F.least("h", F.coalesce("lead_own", F.lit(0))).alias("taken"),
        F.greatest(F.col("own") - F.col("h"), F.lit(0)).alias("rest")), "trie-conversations")
    opening = (turns.filter(F.col("pos") < MOST_SHARED).withColumnRenamed("conv", "lead")
               .join(convs.filter("h > 0").select("conv", "lead", "h"), "lead").filter("pos <= h")  # a lead has 100 at most
               .select("conv", F.col("pos").alias("place"), "id", "size"))
    rest = (turns.join(convs.select("conv", "h", "taken"), "conv").filter("pos > h")
            .select("conv", (F.col("taken") + F.col("pos") - F.col("h")).alias("place"), "id", "size"))
    return opening.unionByName(rest), convs.select("conv", (F.col("taken") + F.col("rest")).alias("turns"))


def strings(turns: DataFrame, convs: DataFrame, string_turns: int = STRING_TURNS) -> DataFrame:
    """(conv, layer, last, path, sizes): each conversation cut into strings; the last one may be empty."""
    layers = convs.select("conv", F.expr(f"turns div {string_turns}").alias("last")).select(
        "conv", "last", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))).alias("layer"))
    parts = (turns.withColumn("layer", F.expr(f"(place - 1) div {string_turns}")).groupBy("conv", "layer")
             .agg(F.sort_array(F.collect_list(F.struct("place", "id", "size"))).alias("turns")))  # string_turns at most
    turn = F.coalesce("turns", F.array().cast("array<struct<place:bigint,id:string,size:bigint>>"))
    return layers.join(parts, ["conv", "layer"], "left").select(
        "conv", "layer", "last", F.array_join(F.transform(turn, lambda t: t["id"]), "").alias("path"),
        F.transform(turn, lambda t: t["size"]).alias("sizes"))


# ---------------------------------------------------------------------------
# Ids that end at a node
# ---------------------------------------------------------------------------


def ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, ends): SHA-256 of the ids of each run of rows, which come sorted; one id at a time is held."""
    node, sha, fresh = None, hashlib.sha256(), True
    for batch in batches:
        out: list[tuple[str, str]] = []
        for name, conv in zip(batch.column("node").to_pylist(), batch.column("conv").to_pylist(), strict=True):
            if name != node:
                if node is not None:
                    out.append((node, sha.hexdigest()))
                node, sha, fresh = name, hashlib.sha256(), True
            sha.update(str(conv).encode() if fresh else f",{conv}".encode())
            fresh = False
        yield _pairs(out)
    if node is not None:
        yield _pairs([(node, sha.hexdigest())])


def _pairs(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in (0, 1)], names=["node", "ends"])


# ---------------------------------------------------------------------------
# Bursting
# ---------------------------------------------------------------------------

_SUMS = ["n", "conv", "children", "leaves", "saved", "ends"]


def burst(items: DataFrame, container_turns: int) -> tuple[DataFrame, list[DataFrame]]:
    """Strings with the container they end in (``key``, ``parent``, ``round``, ``ended``), and the burst
    containers of each round: ``key, parent, round``, ``shared`` (how many ids all their strings share) and ``sizes``.

    ``ended``: the string ends where its container burst, it is part of the head itself.
    """
    null = F.lit(None).cast("string")
    open_ = items.select("*", F.substring("path", 1, ID).alias("key"), null.alias("parent"), F.lit(0).alias("round"),
                         F.lit(False).alias("ended"))
    settled, bursts = [], []
    while True:
        low, high = F.col("low"), F.col("high")
        units = F.least(F.length("low"), F.length("high")) / ID
        same = F.transform(F.sequence(F.lit(0), units.cast("int") - 1),
                           lambda i: F.substring(low, i * ID + 1, F.lit(ID)) == F.substring(high, i * ID + 1, F.lit(ID)))
        first = F.array_position(same, False)
        over = (open_.filter("not ended").groupBy("key", "parent", "round")
                .agg(F.count("*").alias("strings"), F.sum(F.length("path") / ID).alias("turns"), F.min("path").alias("low"),
                     F.max("path").alias("high"), F.min_by("sizes", "path").alias("sizes"))
                .filter((F.col("strings") > 1) & (F.col("turns") > container_turns))
                .select("key", "parent", "round", F.when(first > 0, first - 1).otherwise(units.cast("long")).alias("shared"),
                        "sizes"))
        over = staged(over, "trie-bursts")
        if not over.limit(1).count():
            return _union([*settled, open_]), bursts
        bursts.append(over)
        marks = small(over.select("key", "shared"))
        settled.append(open_.join(marks.select("key"), "key", "left_anti").select(open_.columns))
        moved = open_.filter("not ended").join(marks, "key")
        open_ = staged(moved.select(
            *[c for c in items.columns], F.expr(f"substring(path, 1, {ID} * (cast(shared as int) + 1))").alias("key"),
            F.col("key").alias("parent"), F.lit(len(bursts)).alias("round"),
            (F.length("path") == ID * F.col("shared")).alias("ended")), "trie-strings")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# ---------------------------------------------------------------------------
# Sweeping
# ---------------------------------------------------------------------------

_NODES = ("top boolean, key string, parent string, round int, depth int, size long, conv long, parent_conv long, n long, "
          "children long, leaves long, saved long, ends string")


def swept(key: str, parent: str | None, round_: int, rows: list[tuple]) -> list[tuple]:
    """The nodes of one container from its strings in order: (path, sizes, n, conv, children, leaves, saved, ends).

    The first one, marked ``top``, is the container's head node.
    """
    base = len(key) // ID
    depth, up, size = [base - 1], [-1], [rows[0][1][base - 1]]
    n, conv, children, leaves, saved, end = [0], [None], [0], [0], [0], [NOBODY]
    stack, before = [0], key
    for path, sizes, r_n, r_conv, r_children, r_leaves, r_saved, r_ends in rows:
        shared = base
        most = min(len(before), len(path)) // ID
        while shared < most and before[shared * ID:(shared + 1) * ID] == path[shared * ID:(shared + 1) * ID]:
            shared += 1
        del stack[shared - base + 1:]
        for unit in range(shared, len(path) // ID):
            up.append(stack[-1])
            stack.append(len(depth))
            depth.append(unit)
            size.append(sizes[unit])
            for column, value in ((n, 0), (conv, None), (children, 0), (leaves, 0), (saved, 0), (end, NOBODY)):
                column.append(value)
        at, before = stack[-1], path
        n[at] += r_n
        conv[at] = r_conv if conv[at] is None else min(conv[at], r_conv)
        children[at] += r_children
        leaves[at] += r_leaves
        saved[at] += r_saved
        end[at] = r_ends
    for at in range(len(depth) - 1, -1, -1):  # children come after their parents
        if not children[at]:
            leaves[at] = 1
        saved[at] += (n[at] - 1) * size[at]
        if at:
            to = up[at]
            n[to] += n[at]
            conv[to] = conv[at] if conv[to] is None else min(conv[to], conv[at])
            children[to] += 1
            leaves[to] += leaves[at]
            saved[to] += saved[at]
    return [(at == 0, key if at == 0 else None, parent if at == 0 else None, round_, depth[at], size[at], conv[at],
             conv[up[at]] if at else None, n[at], children[at], leaves[at], saved[at], end[at]) for at in range(len(depth))]


def sweep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Containers one after the other, as their rows come sorted by key and path."""
    kinds = [pa.bool_(), pa.string(), pa.string(), pa.int32(), pa.int32(), *[pa.int64()] * 7, pa.string()]
    names = [part.split()[0] for part in _NODES.split(", ")]

    def out(nodes: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in nodes], kind) for k, kind in enumerate(kinds)],
                                          names=names)

    now, held, nodes = None, [], []
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("key", "parent", "round", "path", "sizes", *_SUMS))
        for key, parent, round_, path, sizes, n, conv, children, leaves, saved, end in zip(*columns, strict=True):
            if now is not None and now[0] != key:
                nodes += swept(*now, held)
                held = []
                if len(nodes) > 10_000:
                    yield out(nodes)
                    nodes = []
            now = (key, parent, round_)
            held.append((path, sizes, n, conv, children, leaves, saved, end))
    if held:
        nodes += swept(*now, held)
    yield out(nodes)


# ---------------------------------------------------------------------------
# A layer: containers, then the heads above them
# ---------------------------------------------------------------------------

_OUT = ["depth", "conv", "parent_conv", "n", "children", "leaves", "saved", "ends"]


def layer_nodes(items: DataFrame, container_turns: int) -> tuple[DataFrame, DataFrame]:
    """Nodes below the heads of a layer (``depth`` within it), and the heads: ``key`` and sums.

    ``items``: distinct strings with their head in front (``path``, ``sizes``), and the sums of their end node.
    """
    placed, bursts = burst(items, container_turns)
    whole = (placed.filter("not ended").repartition("key").sortWithinPartitions("key", "path")
             .select("key", "parent", "round", "path", "sizes", *_SUMS).mapInArrow(sweep, _NODES))
    whole = staged(whole, "trie-nodes")
    nodes = [whole.filter("not top").select(*_OUT)]
    columns = ["key", "parent", "round", "depth", "size", *_SUMS, "ended"]
    ended = placed.filter("ended").select("key", "parent", "round", (F.length("path") / ID - 1).cast("int").alias("depth"),
                                          F.lit(0).cast("long").alias("size"), *_SUMS, "ended")
    tops = whole.filter("top").withColumn("ended", F.lit(False)).select(columns).unionByName(ended)
    for round_ in range(len(bursts), 0, -1):
        kids = tops.filter(F.col("round") == round_)
        heads = staged(kids.groupBy("parent").agg(
            F.sum("n").alias("n"), F.min("conv").alias("conv"),
            F.sum(F.when(F.col("ended"), F.col("children")).otherwise(1)).alias("children"), F.sum("leaves").alias("leaves"),
            F.sum("saved").alias("saved"), F.coalesce(F.max(F.when(F.col("ended"), F.col("ends"))), F.lit(NOBODY)).alias("ends"))
            .withColumnRenamed("parent", "key"), "trie-heads")
        above = small(heads.select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv")))
        nodes.append(kids.filter("not ended").join(above, "parent").select(*_OUT))
        # what the strings of a burst container share is a chain of nodes with the same members
        chain = heads.join(bursts[round_ - 1], "key")
        unit = F.col("unit")
        below = F.aggregate(F.slice("sizes", unit, F.col("shared").cast("int") - unit + 1), F.lit(0).cast("long"),
                            lambda a, x: a + x)
        least = (F.length("key") / ID).cast("int")
        chain = (chain.withColumn("unit", F.explode(F.sequence(least, F.col("shared").cast("int"))))
                 .select("key", "parent", "round", (unit - 1).alias("depth"), F.get("sizes", unit - 1).alias("size"), "n", "conv",
                         F.when(unit == F.col("shared"), F.col("children")).otherwise(1).alias("children"), "leaves",
                         (F.col("saved") + (F.col("n") - 1) * below).alias("saved"),
                         F.when(unit == F.col("shared"), F.col("ends")).otherwise(NOBODY).alias("ends"),
                         F.lit(False).alias("ended"), (unit > least).alias("inner")))
        chain = staged(chain, "trie-chains")
        nodes.append(chain.filter("inner").withColumn("parent_conv", F.col("conv")).select(*_OUT))
        tops = tops.filter(F.col("round") < round_).unionByName(chain.filter("not inner").select(columns))
    return _union(nodes), tops.select("key", *_SUMS)


def build(spark: SparkSession, turns: DataFrame, convs: DataFrame, string_turns: int = STRING_TURNS,
          container_turns: int = CONTAINER_TURNS) -> DataFrame:
    """The trie of conversations given as (conv, place, id, size) and (conv, turns): one row per node."""
    on_workers(spark)
    cut = staged(strings(turns, convs, string_turns), "trie-strings")
    deepest = cut.agg(F.max("layer")).first()[0]
    if deepest is None:
        deepest = 0
    layers, head = [], cut.filter("layer = 0").withColumn("head", F.lit(ROOT))
    for layer in range(deepest + 1):
        layers.append(staged(head.select("conv", "last", F.concat("head", "path").alias("path"), F.concat(
            F.array(F.lit(0).cast("long")), "sizes").alias("sizes")), "trie-layer"))
        if layer < deepest:
            ahead = layers[-1].filter(F.col("last") > layer).select("conv", digest(F.col("path")).alias("head"))
            head = cut.filter(F.col("layer") == layer + 1).join(ahead, "conv")
    nodes, tops = [], None
    for layer in range(deepest, -1, -1):
        rows = layers[layer].withColumn("node", digest(F.col("path")))
        ended = (rows.filter(F.col("last") == layer).select("node", "conv").repartition("node")
                 .sortWithinPartitions("node", "conv").mapInArrow(ends, "node string, ends string"))
        items = (rows.groupBy("node").agg(F.first("path").alias("path"), F.first("sizes").alias("sizes"),
                                          F.count("*").alias("n"), F.min("conv").alias("conv"))
                 .join(ended, "node", "left"))
        if tops is None:
            sums = [F.lit(0).cast("long").alias(c) for c in ("children", "leaves", "saved")]
            end = F.coalesce("ends", F.lit(NOBODY)).alias("ends")
        else:  # strings that a deeper layer continues carry its sums; its head is their end
            items = items.join(tops.select(F.col("key").alias("node"), "children", "leaves", "saved",
                                           F.col("ends").alias("deep_ends")), "node", "left")
            sums = [F.coalesce("children", F.lit(0)).alias("children"),
                    F.when(F.col("children") > 0, F.col("leaves")).otherwise(0).alias("leaves"),
                    F.coalesce("saved", F.lit(0)).alias("saved")]
            end = F.coalesce("deep_ends", "ends", F.lit(NOBODY)).alias("ends")
        items = staged(items.select("path", "sizes", "n", "conv", *sums, end), "trie-strings")
        found, tops = layer_nodes(items, container_turns)
        tops = staged(tops, "trie-tops")
        nodes.append(found.withColumn("depth", (F.col("depth") + layer * string_turns).cast("long")))
    root = tops.withColumn("parent_conv", F.lit(None).cast("long")).withColumn("depth", F.lit(0).cast("long"))
    return _union([*nodes, root.select(*_OUT)]).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, string_turns: int = STRING_TURNS,
                container_turns: int = CONTAINER_TURNS, rebuild: bool = False) -> DataFrame:
    """The nodes of the conversations' trie; with ``rebuild`` each first gets the opening of its block's first one."""
    numbered = staged(numbered_turns(conversations), "trie-turns")
    if rebuild:
        turns, convs = rebuilt_turns(numbered)
    else:
        turns = numbered.withColumnRenamed("pos", "place")
        convs = numbered.groupBy("conv").agg(F.count("*").alias("turns"))
    return build(conversations.sparkSession, turns, convs, string_turns, container_turns)
