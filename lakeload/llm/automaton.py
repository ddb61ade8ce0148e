"""Several expressions as one deterministic automaton over bytes.

Expressions are parsed to a tree, the tree becomes a non-deterministic automaton, subset
construction makes it deterministic, and states that no input can tell apart are merged. What
scans is an array of next states by state and byte.

An expression may hold literals, ``.``, classes, groups, ``|`` and the repeats ``? * + {m} {m,}
{m,n}``; escapes are ``\\n \\t \\r \\xHH \\d \\w`` and punctuation. It stands for bytes, is greedy,
and must not match nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np

_DIGITS = frozenset(b"0123456789")
_WORD = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_")
_ANY = frozenset(range(256)) - frozenset(b"\n")
_ESCAPES = {"n": frozenset(b"\n"), "t": frozenset(b"\t"), "r": frozenset(b"\r")}
_ESCAPES |= {"d": _DIGITS, "w": _WORD}

# Nodes of the tree: ("bytes", set), ("then", nodes), ("or", nodes), ("repeat", node, least, most).


class _Parser:
    def __init__(self, pattern: str, ignore_case: bool) -> None:
        self.text = pattern
        self.at = 0
        self.ignore_case = ignore_case

    def parse(self):
        node = self.either()
        if self.at < len(self.text):
            raise ValueError(f"unexpected {self.text[self.at]!r} at {self.at} in {self.text!r}")
        return node

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        if self.at >= len(self.text):
            raise ValueError(f"unexpected end of {self.text!r}")
        self.at += 1
        return self.text[self.at - 1]

    def either(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return options[0] if len(options) == 1 else ("or", options)

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated())
        return ("then", parts)

    def repeated(self):
        node = self.single()
        while self.peek() and self.peek() in "?*+{":
            sign = self.take()
            if sign == "{":
                end = self.text.index("}", self.at)
                least, comma, most = self.text[self.at : end].partition(",")
                self.at = end + 1
                bounds = int(least), (int(most) if most else None) if comma else int(least)
            else:
                bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}[sign]
            node = ("repeat", node, *bounds)
        return node

    def single(self):
        sign = self.take()
        if sign == "(":
            node = self.either()
            if self.take() != ")":
                raise ValueError(f"unclosed group in {self.text!r}")
            return node
        if sign == "[":
            return ("bytes", self.klass())
        if sign == ".":
            return ("bytes", _ANY)
        return ("bytes", self.cased(self.escape() if sign == "\\" else self.literal(sign)))

    def literal(self, sign: str) -> frozenset[int]:
        if ord(sign) > 127:
            raise ValueError(f"only ASCII is allowed in {self.text!r}")
        return frozenset([ord(sign)])

    def escape(self) -> frozenset[int]:
        sign = self.take()
        if sign == "x":
            return frozenset([int(self.take() + self.take(), 16)])
        return _ESCAPES.get(sign) or self.literal(sign)

    def cased(self, found: frozenset[int]) -> frozenset[int]:
        if not self.ignore_case:
            return found
        both = bytes(b for b in found if b < 128)
        return found | frozenset(both.lower()) | frozenset(both.upper())

    def klass(self) -> frozenset[int]:
        negated = self.peek() == "^"
        if negated:
            self.take()
        found: set[int] = set()
        while True:
            sign = self.take()
            if sign == "]":
                break
            one = self.escape() if sign == "\\" else self.literal(sign)
            if self.peek() == "-" and self.text[self.at + 1 : self.at + 2] != "]":
                self.take()
                upper = self.take()
                last = self.escape() if upper == "\\" else self.literal(upper)
                one = frozenset(range(min(one), max(last) + 1))
            found |= one
        cased = self.cased(frozenset(found))
        return frozenset(range(256)) - cased if negated else cased


def _reverse(node):
    kind = node[0]
    if kind == "bytes":
        return node
    if kind == "repeat":
        return ("repeat", _reverse(node[1]), *node[2:])
    parts = [_reverse(part) for part in node[1]]
    return (kind, parts[::-1] if kind == "then" else parts)


class _Nfa:
    """Thompson's construction: steps that read nothing, and steps on a set of bytes."""

    def __init__(self) -> None:
        self.free: list[list[int]] = []
        self.steps: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.steps.append([])
        return len(self.free) - 1

    def add(self, node, start: int) -> int:
        """Append what ``node`` reads behind ``start``; the state after it."""
        kind = node[0]
        if kind == "bytes":
            end = self.state()
            self.steps[start].append((node[1], end))
            return end
        if kind == "then":
            for part in node[1]:
                start = self.add(part, start)
            return start
        if kind == "or":
            end = self.state()
            for part in node[1]:
                first = self.state()
                self.free[start].append(first)
                self.free[self.add(part, first)].append(end)
            return end
        _, part, least, most = node
        for _ in range(least):
            start = self.add(part, start)
        end = self.state()
        self.free[start].append(end)
        if most is None:
            loop = self.state()
            self.free[start].append(loop)
            last = self.add(part, loop)
            self.free[last] += [loop, end]
        else:
            for _ in range(most - least):
                start = self.add(part, start)
                self.free[start].append(end)
        return end

    def closure(self, states: Iterable[int]) -> frozenset[int]:
        found = set(states)
        waiting = list(found)
        while waiting:
            for state in self.free[waiting.pop()]:
                if state not in found:
                    found.add(state)
                    waiting.append(state)
        return frozenset(found)


@dataclass(frozen=True)
class Automaton:
    """``step[state, byte]`` is the next state, ``accepts[state]`` a bit for each expression.

    State 0 is the start. Accepting states have the highest numbers, from ``first_accepting`` on.
    ``dead`` is the state that nothing leads out of, or -1.
    """

    step: np.ndarray
    accepts: np.ndarray
    first_accepting: int
    dead: int

    def rows(self) -> list[list[int]]:
        return self.step.tolist()


def compiled(
    patterns: Sequence[str],
    *,
    ignore_case: Sequence[bool] | None = None,
    anywhere: bool = False,
    backwards: bool = False,
) -> Automaton:
    """One minimal automaton for all patterns.

    With ``anywhere`` a match may begin at any byte, otherwise at the first. With ``backwards`` it
    reads a text from its end.
    """
    nfa = _Nfa()
    start = nfa.state()
    ends = {}
    for k, pattern in enumerate(patterns):
        tree = _Parser(pattern, bool(ignore_case and ignore_case[k])).parse()
        first = nfa.state()
        nfa.free[start].append(first)
        ends[nfa.add(_reverse(tree) if backwards else tree, first)] = 1 << k
    classes, members = _byte_classes(nfa)

    # Sets of states are bits of an integer. Only states that read or end something are kept.
    telling = {s for s, steps in enumerate(nfa.steps) if steps} | ends.keys()

    def bits(states: Iterable[int]) -> int:
        return sum(1 << s for s in nfa.closure(states) & telling)

    moves: list[list[tuple[int, int]]] = []
    for steps in nfa.steps:
        reached = [(read, bits([to])) for read, to in steps]
        moves.append([(c, m) for c, b in enumerate(members) for read, m in reached if b in read])
    begin = bits([start])
    if any(begin >> end & 1 for end in ends):
        raise ValueError("an expression matches nothing")
    numbers = {begin: 0}
    waiting = [begin]
    table: list[list[int]] = []
    for states in waiting:  # grows as it runs
        row = [begin if anywhere else 0] * len(members)
        rest = states
        while rest:
            low = rest & -rest
            rest ^= low
            for c, reached in moves[low.bit_length() - 1]:
                row[c] |= reached
        for reached in row:
            if reached not in numbers:
                numbers[reached] = len(numbers)
                waiting.append(reached)
        table.append([numbers[reached] for reached in row])
    accepts = [sum(bit for end, bit in ends.items() if states >> end & 1) for states in waiting]
    return _minimal(np.array(table), np.array(accepts, dtype=np.int64), classes)


def _byte_classes(nfa: _Nfa) -> tuple[np.ndarray, list[int]]:
    """Bytes that no step tells apart share a class: the class of each byte, a byte of each class."""
    sets = {read for steps in nfa.steps for read, _ in steps}
    seen: dict[tuple[bool, ...], int] = {}
    classes = np.array([seen.setdefault(tuple(b in s for s in sets), len(seen)) for b in range(256)])
    members = [int(np.flatnonzero(classes == k)[0]) for k in range(len(seen))]
    return classes, members


def _minimal(table: np.ndarray, accepts: np.ndarray, classes: np.ndarray) -> Automaton:
    """Split states by what they accept, then by where their steps lead, until nothing splits."""
    label = np.unique(accepts, return_inverse=True)[1].ravel()
    while True:
        sign = np.column_stack([label, label[table]])
        new = np.unique(sign, axis=0, return_inverse=True)[1].ravel()
        if new.max() == label.max():
            break
        label = new
    n = label.max() + 1
    first = np.array([int(np.flatnonzero(label == k)[0]) for k in range(n)])
    # The start first, accepting states last.
    order = sorted(range(n), key=lambda k: (accepts[first[k]] != 0, k != label[0]))
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    step = place[label[table[first[order]]]][:, classes].astype(np.int32)
    accepting = accepts[first[order]]
    stuck = (step == np.arange(n)[:, None]).all(axis=1) & (accepting == 0)
    dead = int(np.flatnonzero(stuck)[0]) if stuck.any() else -1
    return Automaton(step, accepting, int((accepting == 0).sum()), dead)
