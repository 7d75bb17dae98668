"""Regular expressions over bytes compiled to one minimal deterministic automaton.

The syntax: literals, escapes (``\\xHH``, ``\\.``), classes with ranges and negation, groups, ``|``,
``?``, ``*``, ``+``, ``{m}``, ``{m,}``, ``{m,n}`` and ``(?i:...)``. Expressions become one
non-deterministic automaton, the subset construction makes it deterministic over classes of bytes that
no rule tells apart, and partition refinement merges equivalent states.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

ALL = (1 << 256) - 1


class _Net:
    """States with labelled arcs (a 256-bit set of bytes) and empty arcs."""

    def __init__(self):
        self.arcs: list[list[tuple[int, int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.arcs.append([])
        self.empty.append([])
        return len(self.arcs) - 1


class _Parser:
    """Recursive descent over the pattern; builds a tree of tuples."""

    def __init__(self, pattern: str):
        self.text, self.at, self.fold = pattern, 0, False

    def parse(self):
        tree = self.choice()
        if self.at != len(self.text):
            raise ValueError(f"unexpected {self.text[self.at]!r} at {self.at} in {self.text!r}")
        return tree

    def peek(self) -> str:
        return self.text[self.at] if self.at < len(self.text) else ""

    def choice(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.at += 1
            options.append(self.sequence())
        return options[0] if len(options) == 1 else ("or", options)

    def sequence(self):
        items = []
        while self.peek() not in ("", "|", ")"):
            items.append(self.repeated())
        return ("seq", items)

    def repeated(self):
        item = self.atom()
        while (c := self.peek()) and c in "?*+{":
            self.at += 1
            if c == "{":
                low, _, high = self.text[self.at:self.text.index("}", self.at)].partition(",")
                comma = "," in self.text[self.at:self.text.index("}", self.at)]
                self.at = self.text.index("}", self.at) + 1
                item = ("rep", item, int(low), int(high) if high else (None if comma else int(low)))
            else:
                item = ("rep", item, int(c == "+"), 1 if c == "?" else None)
        return item

    def atom(self):
        c = self.peek()
        self.at += 1
        if c == "(":
            before = self.fold
            if self.text.startswith("?i:", self.at):
                self.at, self.fold = self.at + 3, True
            elif self.text.startswith("?:", self.at):
                self.at += 2
            tree = self.choice()
            if self.peek() != ")":
                raise ValueError(f"no ) in {self.text!r}")
            self.at, self.fold = self.at + 1, before
            return tree
        if c == "[":
            return ("set", self.bracket())
        if c == "\\":
            return ("set", self.cased(1 << self.escape()))
        return ("set", self.cased(1 << ord(c)))

    def escape(self) -> int:
        c = self.peek()
        self.at += 1
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2:self.at], 16)
        return {"n": 10, "r": 13, "t": 9}.get(c) or ord(c)

    def one(self) -> int:
        c = self.peek()
        self.at += 1
        return self.escape() if c == "\\" else ord(c)

    def bracket(self) -> int:
        negated = self.peek() == "^"
        self.at += negated
        bits = 0
        while self.peek() != "]":
            low = high = self.one()
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.at += 1
                high = self.one()
            for code in range(low, high + 1):
                bits |= 1 << code
        self.at += 1
        bits = self.cased(bits)
        return ALL & ~bits if negated else bits

    def cased(self, bits: int) -> int:
        if self.fold:
            for upper in range(65, 91):
                pair = (1 << upper) | (1 << (upper + 32))
                if bits & pair:
                    bits |= pair
        return bits


def _build(net: _Net, tree, start: int) -> int:
    """Append the tree behind ``start``; the state it ends in."""
    kind = tree[0]
    if kind == "set":
        end = net.state()
        net.arcs[start].append((tree[1], end))
        return end
    if kind == "seq":
        for item in tree[1]:
            start = _build(net, item, start)
        return start
    if kind == "or":
        end = net.state()
        for option in tree[1]:
            inner = net.state()
            net.empty[start].append(inner)
            net.empty[_build(net, option, inner)].append(end)
        return end
    _, item, low, high = tree
    for _ in range(low):
        start = _build(net, item, start)
    if high is None:
        inner = net.state()
        net.empty[start].append(inner)
        back = _build(net, item, inner)
        end = net.state()
        net.empty[back] += [inner, end]
        net.empty[inner].append(end)
        return end
    end = net.state()
    net.empty[start].append(end)
    for _ in range(high - low):
        start = _build(net, item, start)
        net.empty[start].append(end)
    return end


@dataclass(frozen=True)
class Automaton:
    """``trans[state, byte]`` is the next state, ``accepts[state]`` the bits of the rules that end there.

    State 0 is the start; accepting states come last, from ``first_accepting`` on.
    """

    trans: np.ndarray
    accepts: np.ndarray
    first_accepting: int
    dead: int  # a state that nothing leads out of and that accepts nothing; -1 if there is none

    def resets(self) -> list[int]:
        """Bytes that lead to the start from every state: a text may be cut behind them."""
        return np.nonzero((self.trans == 0).all(axis=0))[0].tolist()


def compile_all(patterns: Sequence[str], anchored: bool = False) -> Automaton:
    """One automaton for all patterns. Unless anchored, a match may begin at any byte."""
    net = _Net()
    start = net.state()
    if not anchored:
        net.arcs[start].append((ALL, start))
    ends: dict[int, int] = {}
    for rule, pattern in enumerate(patterns):
        inner = net.state()
        net.empty[start].append(inner)
        end = _build(net, _Parser(pattern).parse(), inner)
        ends[end] = ends.get(end, 0) | 1 << rule

    # Bytes that every arc treats alike share a class.
    signature = {}
    sets = sorted({bits for arcs in net.arcs for bits, _ in arcs})
    for byte in range(256):
        signature.setdefault(tuple(bits >> byte & 1 for bits in sets), []).append(byte)
    groups = list(signature.values())

    def closure(states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for to in net.empty[todo.pop()]:
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        return frozenset(seen)

    numbers = {closure([start]): 0}
    order = list(numbers)
    rows: list[list[int]] = []
    while len(rows) < len(order):
        here, row = order[len(rows)], []
        for group in groups:
            byte = group[0]
            to = closure({t for s in here for bits, t in net.arcs[s] if bits >> byte & 1})
            if to not in numbers:
                numbers[to] = len(order)
                order.append(to)
            row.append(numbers[to])
        rows.append(row)
    table = np.array(rows, np.int64)
    marks = [_union(ends[s] for s in states if s in ends) for states in order]

    # Partition refinement: states stay together while they accept alike and lead to the same blocks.
    block = np.unique(np.array(marks, np.int64), return_inverse=True)[1].reshape(-1)
    while True:
        keys = np.column_stack([block[:, None], block[table]])
        finer = np.unique(keys, axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    n = int(block.max()) + 1
    sample = np.zeros(n, np.int64)
    sample[block[::-1]] = np.arange(len(block))[::-1]
    mark = np.array(marks, np.int64)[sample]
    begins = int(block[0])
    ranked = sorted(range(n), key=lambda b: (mark[b] != 0, b != begins, b))
    number = np.zeros(n, np.int64)
    number[ranked] = np.arange(n)
    trans = np.zeros((n, 256), np.int64)
    for k, group in enumerate(groups):
        trans[:, group] = number[block[table[sample[ranked], k]]][:, None]
    accepts = mark[ranked]
    first = int((accepts == 0).sum())
    still = [s for s in range(first) if (trans[s] == s).all()]
    return Automaton(trans, accepts, first, still[0] if still else -1)


def _union(marks) -> int:
    total = 0
    for mark in marks:
        total |= mark
    return total
