"""Minimal acyclic word automaton with numbered words, as flat arrays.

Built from sorted words by incremental minimisation: equal suffixes share states.
Every edge carries how many words precede those it leads to, so the sum along a
word's path is the word's number, and the number leads to the word's output.
The arrays go to one file that tasks map into memory; many words are looked up at
once, all of them one byte further in each step.
"""

from __future__ import annotations

import numpy as np


def build(words: list[bytes]) -> dict[str, np.ndarray]:
    """Arrays of the automaton of distinct, sorted words."""
    children: list[dict[int, int]] = [{}]
    final: list[bool] = [False]
    register: dict[tuple, int] = {}
    path = [0]  # states of the last word; those beyond the common prefix can still change
    free: list[int] = []

    def settle(upto: int, word: bytes) -> None:
        while len(path) > upto + 1:
            state = path.pop()
            signature = (final[state], *children[state].items())
            known = register.setdefault(signature, state)
            if known != state:
                children[path[-1]][word[len(path) - 1]] = known
                children[state], final[state] = {}, False
                free.append(state)

    last = b""
    for word in words:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        settle(common, last)
        for byte in word[common:]:
            if free:
                state = free.pop()
            else:
                state = len(children)
                children.append({})
                final.append(False)
            children[path[-1]][byte] = state
            path.append(state)
        final[path[-1]] = True
        last = word
    settle(0, last)

    below: dict[int, int] = {}
    order, stack = [], [0]  # children before parents, without recursion
    while stack:
        state = stack.pop()
        if state >= 0:
            if state not in below:
                below[state] = 0
                stack.append(~state)
                stack.extend(c for c in children[state].values() if c not in below)
        else:
            order.append(~state)
    for state in order:
        below[state] = final[state] + sum(below[c] for c in children[state].values())
    number = {state: i for i, state in enumerate([0, *(s for s in order if s)])}
    keys, targets, skips = [], [], []
    for state in number:
        ahead = int(final[state])
        for byte, child in sorted(children[state].items()):
            keys.append(number[state] * 256 + byte)
            targets.append(number[child])
            skips.append(ahead)
            ahead += below[child]
    return {"edge_key": np.array(keys, np.int64), "edge_to": np.array(targets, np.int32),
            "edge_skip": np.array(skips, np.int32), "final": np.array([final[s] for s in number], np.uint8)}


def find(arrays: dict[str, np.ndarray], words: list[bytes]) -> np.ndarray:
    """The number of each word in the automaton, -1 for words that it lacks."""
    out = np.full(len(words), -1, np.int64)
    keys = arrays["edge_key"]
    if not len(keys) or not words:
        return out
    data = np.frombuffer(b"".join(words), np.uint8)
    length = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(length) - length
    live = np.arange(len(words))
    state, total = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    step = 0
    while len(live):
        over = length[live] == step
        if over.any():
            done = live[over]
            ends = arrays["final"][state[over]] > 0
            out[done[ends]] = total[over][ends]
            live, state, total = live[~over], state[~over], total[~over]
            if not len(live):
                break
        key = state * 256 + data[start[live] + step]
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        hit = keys[at] == key
        live, at = live[hit], at[hit]
        state, total = arrays["edge_to"][at].astype(np.int64), total[hit] + arrays["edge_skip"][at]
        step += 1
    return out


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    """Named arrays as one block: a line of names, types and places, then the arrays."""
    import json

    at, places, parts = 0, {}, []
    for name, array in arrays.items():
        raw = np.ascontiguousarray(array).tobytes()
        places[name] = [array.dtype.str, len(array), at]
        parts.append(raw + bytes(-len(raw) % 64))
        at += len(parts[-1])
    head = json.dumps(places).encode()
    head += b" " * (-(len(head) + 1) % 64) + b"\n"
    return head + b"".join(parts)


def mapped(path: str) -> dict[str, np.ndarray]:
    """The arrays of a packed file, mapped into memory."""
    import json

    with open(path, "rb") as file:
        head = file.readline()
    block = np.memmap(path, np.uint8, "r", offset=0)
    return {name: block[len(head) + at:len(head) + at + n * np.dtype(kind).itemsize].view(kind)
            for name, (kind, n, at) in json.loads(head).items()}
