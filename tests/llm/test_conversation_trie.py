import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from cases import SF

from pagelake.llm import conversation_trie as C
from pagelake.llm.common import table


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rebuilt(rows):
    """{conv_id: [(role, text), ...]} from (conv_id, turn, role, text)."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            order = (turn is not None, turn or 0, sha(f"{len(role)}:{role}{text}"))
            turns[c].append((order, (role, text)))
    own = {c: [t for _, t in sorted(some)] for c, some in turns.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h] + own[c][h:]
    return out


def brute_force(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)

    def below(node):  # node and all beneath it
        todo, found = [node], []
        while todo:
            found.append(todo.pop())
            todo += kids[found[-1]]
        return found

    rows = set()
    for node, some in members.items():
        under = below(node)
        ends = sorted(c for c in some if len(convs[c]) == len(node))
        rows.add((min(some), len(node), min(members[node[:-1]]) if node else None, len(some), len(kids[node]),
                  sum(not kids[u] for u in under), sum((len(members[u]) - 1) * len(u[-1][1]) for u in under if u),
                  sha(",".join(map(str, ends)))))
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("conv", "id", "path", "node", "key", "n", "at", "ends"):  # names that the operator uses inside
        df = df.selectExpr("*", f"'x' as {name}")
    return df


def crafted():
    """Copies, shared openings, one long conversation, missing block leads, short leads, ties, nulls, repeated rows."""
    rnd = random.Random(3)
    rows = []
    for c in [*range(0, 40), *range(100, 110), *range(205, 215), -3, -105]:
        copy = c % 4 == 0
        for turn in range(rnd.choice([1, 2, 4, 7]) if not copy else 5):
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", f"same {turn}" if copy else rnd.choice("abc") * 3))
    rows += [(300, t, "user", f"long {t}") for t in range(60)]
    rows += [(304, t, "user", f"long {t}") for t in range(60)] + [(304, 60, "user", "one more")]
    rows += [(310, None, "user", "first"), (310, 1, None, "tie"), (310, 1, "user", None), (310, 1, "user", None),
             (310, 2, "", ""), (None, 1, "user", "nobody"), (401, 0, "system", "é世" * 2000), (402, 0, "system", "é世" * 2000)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("settings", [{}, {"container_turns": 12}, {"string_turns": 7, "container_turns": 12},
                                      {"string_turns": 20, "container_turns": 1}])
def test_crafted_conversations(spark, settings):
    rows = crafted()
    expected = brute_force(rebuilt(rows))
    got = [tuple(r) for r in C.prefix_trie(frame(spark, rows), rebuild=True, **settings).collect()]
    assert len(got) == len(expected) and set(got) == expected


def test_without_rebuilding(spark):
    rows = [r for r in crafted() if r[0] is not None]
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        role, text = role or "", text or ""
        turns[c].append(((turn is not None, turn or 0, sha(f"{len(role)}:{role}{text}")), (role, text)))
    expected = brute_force({c: [t for _, t in sorted(some)] for c, some in turns.items()})
    assert {tuple(r) for r in C.prefix_trie(frame(spark, rows), container_turns=30).collect()} == expected


def test_whole_table(spark):
    conversations = table(spark, SF, "conversations")
    expected = brute_force(rebuilt([tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()]))
    got = [tuple(r) for r in C.prefix_trie(conversations, rebuild=True).collect()]
    assert len(got) == len(expected) and set(got) == expected


def test_empty_tables(spark):
    for rows in ([], [(None, 1, "user", "nobody")]):
        assert C.prefix_trie(frame(spark, rows), rebuild=True).collect() == []


def test_many_equal_conversations_in_a_stream():
    import pyarrow as pa

    def batches():
        for at in range(0, 100, 7):
            convs = list(range(at, min(at + 7, 100)))
            yield pa.RecordBatch.from_arrays([pa.array(["a" if c < 90 else "b" for c in convs]), pa.array(convs)],
                                             names=["node", "conv"])

    got = {r["node"]: r["ends"] for b in C.ends(batches()) for r in b.to_pylist()}
    assert got == {"a": sha(",".join(map(str, range(90)))), "b": sha(",".join(map(str, range(90, 100))))}
