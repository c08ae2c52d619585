"""Byte automata from regular expressions: subset construction, minimisation, a scan by lanes.

The parse tree is that of Python's own ``re``. Of its syntax these take part: bytes, sets,
groups, alternatives and repeats. Patterns are of ASCII characters; any other byte is matched by
negated sets only. The byte 0xFF, which no UTF-8 text has, separates texts: nothing matches it.
"""

from __future__ import annotations

import re._parser as parser
from collections import defaultdict
from dataclasses import dataclass

import numpy as np

SEPARATOR = 0xFF
LANES = 2048  # pieces of a block that are scanned side by side


def _byte_set(items: list) -> frozenset[int]:
    negated, out = False, set()
    for kind, value in items:
        name = str(kind)
        if name == "NEGATE":
            negated = True
        elif name == "LITERAL":
            out.add(value)
        elif name == "RANGE":
            out.update(range(value[0], value[1] + 1))
        else:
            raise ValueError(f"{name} is not supported in a set")
    return frozenset(set(range(SEPARATOR)) - out if negated else out)


def _tree(items: list, fold: bool) -> tuple:
    """("cat", parts), ("alt", parts), ("rep", least, most or None, part) or ("set", bytes)."""
    def byte(s: frozenset[int]) -> tuple:
        both = s | {ord(chr(b).swapcase()) for b in s if b < 128 and chr(b).isalpha()} if fold else s
        return "set", frozenset(both)

    parts = []
    for kind, value in items:
        name = str(kind)
        if name == "LITERAL":
            parts.append(byte(frozenset([value])))
        elif name == "NOT_LITERAL":
            parts.append(("set", frozenset(set(range(SEPARATOR)) - {value})))
        elif name == "IN":
            parts.append(byte(_byte_set(value)))
        elif name == "BRANCH":
            parts.append(("alt", [_tree(branch, fold) for branch in value[1]]))
        elif name == "SUBPATTERN":
            parts.append(_tree(value[3], fold or bool(value[1] & parser.SRE_FLAG_IGNORECASE)))
        elif name == "MAX_REPEAT":
            least, most, part = value
            parts.append(("rep", least, None if most == parser.MAXREPEAT else most, _tree(part, fold)))
        else:
            raise ValueError(f"{name} is not supported")
    return "cat", parts


def _reversed(tree: tuple) -> tuple:
    if tree[0] == "cat":
        return "cat", [_reversed(t) for t in reversed(tree[1])]
    if tree[0] == "alt":
        return "alt", [_reversed(t) for t in tree[1]]
    if tree[0] == "rep":
        return (*tree[:3], _reversed(tree[3]))
    return tree


class _Nfa:
    """States with edges on byte sets and edges on nothing."""

    def __init__(self) -> None:
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.free.append([])
        return len(self.edges) - 1

    def add(self, tree: tuple, start: int) -> int:
        """Edges that read ``tree`` from ``start``; the state they end in."""
        kind = tree[0]
        if kind == "set":
            end = self.state()
            self.edges[start].append((tree[1], end))
            return end
        if kind == "cat":
            for part in tree[1]:
                start = self.add(part, start)
            return start
        if kind == "alt":
            end = self.state()
            for part in tree[1]:
                before = self.state()
                self.free[start].append(before)
                self.free[self.add(part, before)].append(end)
            return end
        _, least, most, part = tree
        for _ in range(least):
            start = self.add(part, start)
        if most is None:
            loop, end = self.state(), self.state()
            self.free[start].append(loop)
            self.free[self.add(part, loop)].append(loop)
            self.free[loop].append(end)
            return end
        end = self.state()
        self.free[start].append(end)
        for _ in range(most - least):
            start = self.add(part, start)
            self.free[start].append(end)
        return end

    def closure(self, states: set[int]) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in found:
                    found.add(s)
                    todo.append(s)
        return frozenset(found)


@dataclass(frozen=True)
class Automaton:
    """A minimal deterministic automaton; its start is state 0.

    classes: the class of each byte. step: for state x width + class the next state x width, so
    that no multiplication is needed on the way. accepts: for state x width the rules that
    accept there, as bits. dead: the state x width that nothing leaves, or -1.
    """

    classes: np.ndarray
    width: int
    step: np.ndarray
    accepts: np.ndarray
    dead: int

    def ends(self, data: bytes, start: int) -> int:
        """The end of the longest match that begins at ``start``, or -1."""
        step, classes, accepts = self.step, self.classes, self.accepts
        state, found = 0, start if accepts[0] else -1
        for at in range(start, len(data)):
            state = step[state + classes[data[at]]]
            if state == self.dead:
                break
            if accepts[state]:
                found = at + 1
        return found

    def states(self, data: np.ndarray) -> np.ndarray:
        """The state x width behind each byte of ``data``, read as one text.

        The bytes are cut into lanes that are stepped through side by side, each from the
        start state. Where a lane in truth begins in another state, which the lane before it ends in,
        it is run again until it is in the states it was in before.
        """
        lanes = min(LANES, max(1, len(data) // 64))
        length = -(-len(data) // lanes)
        padded = np.full(lanes * length, SEPARATOR, np.uint8)
        padded[:len(data)] = data
        classes = np.ascontiguousarray(self.classes[padded].reshape(lanes, length).T).astype(np.int32)
        out = np.empty((length, lanes), np.int32)
        begin, which, whole = np.zeros(lanes, np.int32), np.arange(lanes), True
        while len(which):
            state = begin[which]
            for t in range(length):
                if whole:
                    out[t] = state = self.step[state + classes[t]]
                    continue
                state = self.step[state + classes[t, which]]
                if (state == out[t, which]).all():
                    break  # as before from here on
                out[t, which] = state
            truth = np.concatenate([np.zeros(1, np.int32), out[-1, :-1]]) if length else begin
            which, whole = np.flatnonzero(truth != begin), False
            begin = truth
        return out.T.reshape(-1)[:len(data)]


def _byte_classes(nfa: _Nfa) -> tuple[np.ndarray, list[int]]:
    """(class of each byte, a byte of each class): bytes that no edge tells apart share a class."""
    groups: dict[tuple, list[int]] = defaultdict(list)
    sets = sorted({tuple(sorted(s)) for edges in nfa.edges for s, _ in edges})
    members = [frozenset(s) for s in sets]
    for b in range(256):
        groups[tuple(b in s for s in members) + (b == SEPARATOR,)].append(b)
    classes = np.zeros(256, np.int32)
    for k, bytes_ in enumerate(groups.values()):
        classes[bytes_] = k
    return classes, [bytes_[0] for bytes_ in groups.values()]


def _minimal(step: np.ndarray, accepts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """States are told apart as long as a byte leads them to blocks that differ; start stays 0."""
    block = np.unique(accepts, return_inverse=True)[1]
    while True:
        rows = np.concatenate([block[:, None], block[step]], 1)
        finer = np.unique(rows, axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    first = np.unique(block, return_index=True)[1]
    order = np.argsort(first)  # the start state's block comes first
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    keep = first[order]
    return rank[block[step[keep]]], accepts[keep]


def compiled(rules: list[tuple[str, bool]], backwards: bool = False, anywhere: bool = False) -> Automaton:
    """One automaton of all rules, (regular expression, letters in either case).

    ``backwards`` reads the text from its end, ``anywhere`` lets a match begin at any byte.
    """
    nfa = _Nfa()
    start = nfa.state()
    ends = []
    for regex, fold in rules:
        tree = _tree(parser.parse(regex), fold)
        begin = nfa.state()
        nfa.free[start].append(begin)
        ends.append(nfa.add(_reversed(tree) if backwards else tree, begin))
    classes, samples = _byte_classes(nfa)
    first = nfa.closure({start})
    number, order, step = {first: 0}, [first], []
    for states in order:  # grows on the way
        row = []
        for b in samples:
            reached = {to for s in states for on, to in nfa.edges[s] if b in on}
            if b == SEPARATOR:
                after = first if anywhere else frozenset()
            else:
                after = nfa.closure(reached | ({start} if anywhere else set()))
            if after not in number:
                number[after] = len(order)
                order.append(after)
            row.append(number[after])
        step.append(row)
    accepts = np.array([sum(1 << k for k, e in enumerate(ends) if e in s) for s in order], np.int64)
    table, accepts = _minimal(np.array(step), accepts)
    width = len(samples)
    spread = np.zeros(len(table) * width, np.int64)
    spread[::width] = accepts
    dead = [k for k in range(len(table)) if not accepts[k] and (table[k] == k).all()]
    return Automaton(classes, width, (table * width).astype(np.int32).reshape(-1), spread, dead[0] * width if dead else -1)
