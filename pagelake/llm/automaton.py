"""One deterministic automaton for many byte patterns, and its scan over whole batches.

Patterns become one nondeterministic automaton, subset construction makes it
deterministic, partition refinement minimises it, and byte classes shrink its
transition array.  The scan cuts a buffer into lanes that advance side by side, one
byte per step; lanes whose true entry state differs from the assumed one are run
again until they agree, so the states equal those of a plain scan from the start.
"""

from __future__ import annotations

import re._constants as _op
import re._parser as _parser

import numpy as np

#: A byte that no UTF-8 text holds: it stands between texts and resets the automaton.
BREAK = 0xFF
#: Bytes that one lane handles (a short buffer gets shorter lanes).
LANE = 512


def _byte_set(items, ignore_case: bool) -> frozenset[int]:
    chosen: set[int] = set()
    negate = False
    for kind, value in items:
        if kind is _op.NEGATE:
            negate = True
        elif kind is _op.LITERAL:
            chosen.add(value)
        elif kind is _op.RANGE:
            chosen.update(range(value[0], value[1] + 1))
        else:
            raise ValueError(f"not supported in a byte class: {kind}")
    if ignore_case:
        chosen |= {b ^ 32 for b in chosen if chr(b).isalpha() and b < 128}
    return frozenset(set(range(255)) - chosen if negate else chosen & set(range(255)))


class _Graph:
    """States of the nondeterministic automaton: byte edges and free moves."""

    def __init__(self):
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.free.append([])
        return len(self.edges) - 1

    def add(self, tree, at: int, ignore_case: bool) -> int:
        """Append a parsed pattern behind a state; the state where it ends."""
        for kind, value in tree:
            if kind is _op.LITERAL or kind is _op.IN:
                items = [(kind, value)] if kind is _op.LITERAL else value
                after = self.state()
                self.edges[at].append((_byte_set(items, ignore_case), after))
                at = after
            elif kind is _op.SUBPATTERN:
                at = self.add(value[3], at, ignore_case)
            elif kind is _op.BRANCH:
                after = self.state()
                for branch in value[1]:
                    begin = self.state()
                    self.free[at].append(begin)
                    self.free[self.add(branch, begin, ignore_case)].append(after)
                at = after
            elif kind is _op.MAX_REPEAT:
                least, most, body = value
                for _ in range(least):
                    at = self.add(body, at, ignore_case)
                if most is _op.MAXREPEAT:
                    loop = self.state()
                    self.free[at].append(loop)
                    self.free[self.add(body, loop, ignore_case)].append(loop)
                    at = loop
                else:
                    after = self.state()
                    for _ in range(most - least):
                        self.free[at].append(after)
                        at = self.add(body, at, ignore_case)
                    self.free[at].append(after)
                    at = after
            else:
                raise ValueError(f"not supported in a byte pattern: {kind}")
        return at

    def closed(self, states) -> frozenset[int]:
        out, stack = set(states), list(states)
        while stack:
            for nxt in self.free[stack.pop()]:
                if nxt not in out:
                    out.add(nxt)
                    stack.append(nxt)
        return frozenset(out)


def compile_rules(patterns: list[tuple[str, bool]]) -> dict[str, np.ndarray]:
    """The minimal automaton that tells, after each byte, which patterns end there.

    ``patterns``: (ASCII pattern, either case) - literals, classes, groups, branches
    and greedy repeats.  Returned: ``klass`` (class of each byte), ``step`` (next
    state times the number of classes, by state and class), ``hits`` (bit set of the
    patterns by state).
    """
    graph = _Graph()
    start = graph.state()
    ends = []
    for pattern, ignore_case in patterns:
        begin = graph.state()
        graph.free[start].append(begin)
        ends.append(graph.add(_parser.parse(pattern), begin, ignore_case))

    # bytes that no pattern tells apart share a class
    sets = {s for edges in graph.edges for s, _ in edges}
    kinds: dict[tuple, int] = {}
    klass = np.zeros(256, np.uint8)
    members: list[int] = []
    ordered = sorted(sets, key=sorted)
    for byte in range(256):
        mark = ("break",) if byte == BREAK else tuple(byte in s for s in ordered)
        if mark not in kinds:
            kinds[mark] = len(kinds)
            members.append(byte)
        klass[byte] = kinds[mark]

    origin = graph.closed([start])
    numbers = {origin: 0}
    rows: list[list[int]] = []
    todo = [origin]
    for states in todo:  # grows while it runs
        row = []
        for byte in members:
            if byte == BREAK:
                nxt = origin
            else:
                nxt = graph.closed([t for s in states for chosen, t in graph.edges[s] if byte in chosen]) | origin
            if nxt not in numbers:
                numbers[nxt] = len(numbers)
                todo.append(nxt)
            row.append(numbers[nxt])
        rows.append(row)
    step = np.array(rows, np.int64)
    hits = np.array([sum(1 << k for k, end in enumerate(ends) if end in states) for states in todo], np.int64)

    # minimise: split groups of states until all of a group lead to the same groups
    group = np.unique(hits, return_inverse=True)[1].ravel()
    while True:
        finer = np.unique(np.column_stack([group, group[step]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == group.max():
            break
        group = finer
    first = np.unique(group, return_index=True)[1]
    order = np.argsort(first)  # the start state stays state 0
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    chosen = first[order]
    small = rank[group[step[chosen]]]
    return {"klass": klass, "step": (small * len(members)).astype(np.int32).ravel(),
            "hits": hits[chosen], "classes": np.array([len(members)])}


def scan(rules: dict[str, np.ndarray], data: np.ndarray) -> np.ndarray:
    """The patterns that end at each byte of a buffer, as bit sets (texts are divided by BREAK)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    step, wide = rules["step"], int(rules["classes"][0])
    depth = min(LANE, max(16, int(n ** 0.5)))
    lanes = -(-n // depth)
    padded = np.full(lanes * depth, rules["klass"][BREAK], np.uint8)
    padded[:n] = rules["klass"][data]
    across = np.ascontiguousarray(padded.reshape(lanes, depth).T)
    states = np.empty((depth, lanes), np.int32)
    now = np.zeros(lanes, np.int32)
    for i in range(depth):
        now = step[now + across[i]]
        states[i] = now
    assumed = np.zeros(lanes, np.int32)
    while True:
        entry = np.concatenate([np.zeros(1, np.int32), states[-1, :-1]])
        lane = np.flatnonzero(entry != assumed)
        if not len(lane):
            break
        assumed, now = entry, entry[lane]
        for i in range(depth):
            now = step[now + across[i, lane]]
            differs = now != states[i, lane]
            if not differs.all():
                lane, now = lane[differs], now[differs]
                if not len(lane):
                    break
            states[i, lane] = now
    return rules["hits"][(states // wide).T.ravel()[:n]]
