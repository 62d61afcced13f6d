"""Regular expressions over bytes, compiled together into one minimal automaton.

The rules are parsed into position automata without empty moves, joined, made
deterministic by the subset construction and minimised by partition refinement.
The result is one table of transitions over classes of bytes; a scan takes one
step per byte for all rules together.

Supported: literals, escapes (``\\.``, ``\\n``, ``\\xHH``), classes, groups,
``|``, ``?``, ``*``, ``+``, ``{m}``, ``{m,}``, ``{m,n}``. A rule must not match
the empty string.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

MAX_STATES = 50_000
Node = tuple


@dataclass
class Positions:
    """Glushkov's form of a rule: sets of bytes, and which may come first, last and after which."""

    sets: list[frozenset[int]] = field(default_factory=list)
    after: list[set[int]] = field(default_factory=list)

    def add(self, node: Node) -> tuple[bool, set[int], set[int]]:
        """Whether the node may be empty, its first and its last positions."""
        kind = node[0]
        if kind == "set":
            self.sets.append(node[1])
            self.after.append(set())
            at = {len(self.sets) - 1}
            return False, at, set(at)
        if kind == "or":
            parts = [self.add(part) for part in node[1]]
            return any(p[0] for p in parts), set().union(*[p[1] for p in parts]), set().union(*[p[2] for p in parts])
        if kind == "then":
            empty, first, last = True, set(), set()
            for part in node[1]:
                e, f, la = self.add(part)
                for position in last:
                    self.after[position] |= f
                first |= f if empty else set()
                last = last | la if e else la
                empty &= e
            return empty, first, last
        low, high, inner = node[1:]
        if high is None:  # the last copy loops
            copies = [inner] * max(low, 1)
            empty, first, last = self.add(("then", copies[:-1])) if len(copies) > 1 else (True, set(), set())
            e, f, la = self.add(inner)
            for position in la:
                self.after[position] |= f
            for position in last:
                self.after[position] |= f
            first |= f if empty else set()
            optional = e or low == 0
            return empty and optional, first, last | la if optional and low else la
        nested: Node = ("then", [])
        for _ in range(high - low):
            nested = ("or", [("then", []), ("then", [inner, nested])])
        return self.add(("then", [inner] * low + [nested]))


class Parser:
    def __init__(self, pattern: str, fold: bool) -> None:
        self.pattern, self.at, self.fold = pattern, 0, fold

    def parse(self) -> Node:
        node = self._either()
        if self.at < len(self.pattern):
            raise ValueError(f"unbalanced: {self.pattern}")
        return node

    def _peek(self) -> str:
        return self.pattern[self.at : self.at + 1]

    def _either(self) -> Node:
        parts = [self._sequence()]
        while self._peek() == "|":
            self.at += 1
            parts.append(self._sequence())
        return parts[0] if len(parts) == 1 else ("or", parts)

    def _sequence(self) -> Node:
        parts = []
        while self._peek() not in ("", "|", ")"):
            parts.append(self._repeated(self._atom()))
        return ("then", parts)

    def _repeated(self, node: Node) -> Node:
        while (mark := self._peek()) and mark in "?*+{":
            self.at += 1
            if mark == "{":
                end = self.pattern.index("}", self.at)
                low, comma, high = self.pattern[self.at : end].partition(",")
                self.at = end + 1
                bounds = int(low), (int(high) if high else None) if comma else int(low)
            else:
                bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}[mark]
            node = ("repeat", *bounds, node)
        return node

    def _atom(self) -> Node:
        mark = self._peek()
        if mark == "(":
            self.at += 1
            node = self._either()
            self.at += 1
            return node
        return ("set", self._folded(self._class() if mark == "[" else {self._byte()}))

    def _byte(self) -> int:
        mark = self.pattern[self.at]
        self.at += 1
        if mark != "\\":
            return ord(mark)
        mark = self.pattern[self.at]
        self.at += 1
        if mark == "x":
            self.at += 2
            return int(self.pattern[self.at - 2 : self.at], 16)
        return ord({"n": "\n", "t": "\t", "r": "\r"}.get(mark, mark))

    def _class(self) -> set[int]:
        self.at += 1
        negated = self._peek() == "^"
        self.at += negated
        found: set[int] = set()
        while self._peek() != "]":
            low = self._byte()
            if self._peek() == "-" and self.pattern[self.at + 1] != "]":
                self.at += 1
                found |= set(range(low, self._byte() + 1))
            else:
                found.add(low)
        self.at += 1
        return set(range(256)) - found if negated else found

    def _folded(self, found: set[int]) -> frozenset[int]:
        if self.fold:
            found = found | {b ^ 32 for b in found if chr(b).isascii() and chr(b).isalpha()}
        return frozenset(found)


@dataclass
class Automaton:
    """``step[state, byte_class[byte]]`` is the next state; state 0 is the start.

    ``accepts[state]`` has the numbers of the rules that a match may end for.
    """

    byte_class: np.ndarray
    step: np.ndarray
    accepts: list[tuple[int, ...]]
    dead: int | None

    def rows(self) -> list[list]:
        """The states as lists that lead to one another by byte; entry 256 has the accepted rules."""
        rows: list[list] = [[] for _ in self.accepts]
        for row, steps, accepted in zip(rows, self.step[:, self.byte_class].tolist(), self.accepts):
            row.extend([rows[to] for to in steps])
            row.append(accepted)
        return rows


def compiled(rules: list[tuple[str, bool]], search: bool, backwards: bool = False) -> Automaton:
    """One automaton for all rules: (pattern, letters in either case).

    With ``search`` a match may begin anywhere, else only at the start.
    ``backwards`` reads the rules from their ends.
    """
    sets: list[frozenset[int]] = []
    after: list[frozenset[int]] = []
    ends: dict[int, int] = {}
    first: set[int] = set()
    for number, (pattern, fold) in enumerate(rules):
        own = Positions()
        empty, start, last = own.add(Parser(pattern, fold).parse())
        if empty:
            raise ValueError(f"matches the empty string: {pattern}")
        if backwards:
            turned: list[set[int]] = [set() for _ in own.sets]
            for position, following in enumerate(own.after):
                for later in following:
                    turned[later].add(position)
            own.after, start, last = turned, last, start
        shift = len(sets)
        sets += own.sets
        after += [frozenset(shift + p for p in following) for following in own.after]
        first |= {shift + p for p in start}
        ends |= {shift + p: number for p in last}
    return _minimal(*_subsets(sets, after, frozenset(first), ends, search))


def _subsets(sets, after, first, ends, search):
    kinds: dict[tuple[bool, ...], int] = {}
    byte_class = np.array([kinds.setdefault(tuple(byte in s for s in sets), len(kinds)) for byte in range(256)])
    holds = [[position for position, has in enumerate(kind) if has] for kind in kinds]
    holds = [frozenset(positions) for positions in holds]
    # A state is the set of positions read last; the start has read nothing.
    number = {(frozenset(), True): 0}
    steps, todo = [], [(frozenset(), True)]
    while todo:
        found = []
        for read, fresh in todo:
            row = []
            open_ = set(first) if search or fresh else set()
            for position in read:
                open_ |= after[position]
            for held in holds:
                state = (frozenset(open_ & held), False)
                if state not in number:
                    number[state] = len(number)
                    found.append(state)
                row.append(number[state])
            steps.append(row)
        if len(number) > MAX_STATES:
            raise ValueError(f"the rules need more than {MAX_STATES} states")
        todo = found
    accepts = [tuple(sorted({ends[p] for p in read if p in ends})) for read, _ in number]
    return byte_class, np.array(steps), accepts


def _minimal(byte_class: np.ndarray, step: np.ndarray, accepts: list[tuple[int, ...]]) -> Automaton:
    """Merge states that no rest of the input tells apart."""
    names: dict[tuple[int, ...], int] = {}
    block = np.array([names.setdefault(accepted, len(names)) for accepted in accepts])
    while True:
        _, finer = np.unique(np.column_stack([block, block[step]]), axis=0, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    order = np.full(block.max() + 1, -1)
    _, chosen = np.unique(block, return_index=True)
    ranks = np.argsort(np.argsort(chosen))  # the start's block stays first
    order[:] = ranks
    states = np.sort(chosen)
    merged = order[block[step[states]]]
    kept = [accepts[state] for state in states]
    idle = [s for s in range(len(states)) if not kept[s] and (merged[s] == s).all()]
    return Automaton(byte_class, merged, kept, idle[0] if idle else None)
