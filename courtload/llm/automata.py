"""Deterministic automata over bytes, from regular expressions, by subset construction and minimisation.

Expressions are parsed by the standard library; literals, classes, groups, alternatives and repeats
with any bounds are taken (ASCII only), not assertions, back references or flags other than ``(?i:...)``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import cached_property
from re import _constants as rc   # type: ignore[attr-defined]
from re import _parser as rp      # type: ignore[attr-defined]

import numpy as np

#: Expressions whose automaton is larger are refused, with an error.
MOST_STATES = 20_000
_ALL = frozenset(range(256))


def _class(items: list, fold: bool) -> frozenset[int]:
    out: set[int] = set()
    for kind, value in items:
        if kind is rc.LITERAL:
            out.add(value)
        elif kind is rc.RANGE:
            out.update(range(value[0], value[1] + 1))
        elif kind is not rc.NEGATE:
            raise ValueError(f"unsupported in a class: {kind}")
    if fold:
        out |= {ord(f(chr(b))) for b in out if b < 128 for f in (str.lower, str.upper)}
    return frozenset(_ALL - out if items and items[0][0] is rc.NEGATE else out)


@dataclass
class _Nfa:
    """States with empty moves and at most one move on a set of bytes; built from either end of an expression."""

    backward: bool
    empty: list[list[int]] = field(default_factory=list)
    move: list[tuple[frozenset[int], int] | None] = field(default_factory=list)

    def state(self) -> int:
        self.empty.append([])
        self.move.append(None)
        return len(self.empty) - 1

    def add(self, items: list, at: int, fold: bool = False) -> int:
        """The state after ``items`` read from state ``at``."""
        for kind, value in reversed(items) if self.backward else items:
            at = self._one(kind, value, at, fold)
        return at

    def _one(self, kind, value, at: int, fold: bool) -> int:
        if kind in (rc.LITERAL, rc.NOT_LITERAL, rc.IN):
            listed = value if kind is rc.IN else [(rc.LITERAL, value)]
            accepted = _class([(rc.NEGATE, None), *listed] if kind is rc.NOT_LITERAL else listed, fold)
            start, end = self.state(), self.state()
            self.empty[at].append(start)
            self.move[start] = (accepted, end)
            return end
        if kind is rc.SUBPATTERN:
            _, on, off, inner = value
            if (on | off) & ~re.IGNORECASE:
                raise ValueError("unsupported flags")
            return self.add(list(inner), at, bool(on & re.IGNORECASE) or (fold and not off & re.IGNORECASE))
        if kind is rc.BRANCH:
            end = self.state()
            for inner in value[1]:
                self.empty[self.add(list(inner), at, fold)].append(end)
            return end
        if kind is rc.MAX_REPEAT:
            least, most, inner = value
            for _ in range(least):
                at = self.add(list(inner), at, fold)
            if most is rc.MAXREPEAT:
                loop, end = self.state(), self.state()
                self.empty[at] += [loop, end]
                self.empty[self.add(list(inner), loop, fold)] += [loop, end]
                return end
            ends = [at]
            for _ in range(most - least):
                ends.append(self.add(list(inner), ends[-1], fold))
            end = self.state()
            for e in ends:
                self.empty[e].append(end)
            return end
        raise ValueError(f"unsupported in an expression: {kind}")


@dataclass(frozen=True)
class Automaton:
    """Transition array of a minimal automaton: ``step[state * 256 + byte]`` is the next state times 256.

    Accepting states come last, from ``accepting`` on; ``accepts[state]`` has a bit for each expression.
    """

    step: np.ndarray
    accepts: np.ndarray
    accepting: int
    start: int

    @property
    def states(self) -> int:
        return len(self.accepts)

    @cached_property
    def resets(self) -> np.ndarray:
        """For each byte, whether it leads to the start from every state."""
        return (self.step.reshape(-1, 256) == self.start * 256).all(0)

    @cached_property
    def dead(self) -> int:
        """The state, times 256, that nothing leaves and that accepts nothing; -1 if there is none."""
        table = self.step.reshape(-1, 256)
        stuck = (table == np.arange(self.states)[:, None] * 256).all(1) & (self.accepts == 0)
        return int(np.flatnonzero(stuck)[0]) * 256 if stuck.any() else -1

    @cached_property
    def rows(self) -> list[int]:
        return self.step.tolist()

    def longest(self, data: bytes, at: int, end: int) -> list[int]:
        """For each expression the end of its longest match from ``at`` on, -1 where there is none."""
        out, step, dead, limit, state = [-1] * self._bits, self.rows, self.dead, self.accepting * 256, self.start * 256
        for k in range(at, end):
            state = step[state + data[k]]
            if state >= limit:
                mask = int(self.accepts[state >> 8])
                for b in range(self._bits):
                    if mask >> b & 1:
                        out[b] = k + 1
            elif state == dead:
                break
        return out

    @cached_property
    def _bits(self) -> int:
        return int(self.accepts.max()).bit_length()


def _minimal(table: np.ndarray, accepts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """States that nothing tells apart made one, by refinement; (table, accepts, start) with accepting states last."""
    _, part = np.unique(accepts, return_inverse=True)
    parts = part.max() + 1
    while True:
        _, part = np.unique(np.column_stack([part, part[table]]), axis=0, return_inverse=True)
        part = part.reshape(-1)
        if part.max() + 1 == parts:
            break
        parts = part.max() + 1
    one = np.zeros(parts, np.int64)
    one[part] = np.arange(len(part))
    order = np.argsort(accepts[one] != 0, kind="stable")
    place = np.empty(parts, np.int64)
    place[order] = np.arange(parts)
    return place[part[table[one[order]]]], accepts[one[order]], int(place[part[0]])


def compile_all(expressions: list[str], backward: bool = False, anywhere: bool = False) -> Automaton:
    """One automaton for all expressions, bit k for the k-th.

    ``backward``: for texts read from their end.  ``anywhere``: matches may start at any byte read, not the first alone.
    """
    nfa = _Nfa(backward)
    start = nfa.state()
    final = {}
    for k, e in enumerate(expressions):
        end = nfa.add(list(rp.parse(e)), start)
        final.setdefault(end, 0)
        final[end] |= 1 << k
    sets = sorted({m[0] for m in nfa.move if m}, key=sorted)
    member = np.zeros((256, len(sets)), bool)
    for k, s in enumerate(sets):
        member[list(s), k] = True
    _, first, kind = np.unique(member, axis=0, return_index=True, return_inverse=True)
    kind = kind.reshape(-1)

    def closure(states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for to in nfa.empty[todo.pop()]:
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        return frozenset(s for s in seen if nfa.move[s] or s in final)   # the others tell nothing apart

    begin = closure({start})
    number, todo, table = {begin: 0}, [begin], []
    while len(table) < len(todo):
        here = todo[len(table)]
        row = []
        for byte in first.tolist():
            to = closure({m[1] for s in here if (m := nfa.move[s]) and byte in m[0]})
            if anywhere:
                to |= begin
            if to not in number:
                if len(number) == MOST_STATES:
                    raise ValueError(f"more than {MOST_STATES} states")
                number[to] = len(number)
                todo.append(to)
            row.append(number[to])
        table.append(row)
    accepts = np.zeros(len(todo), np.int64)
    for k, here in enumerate(todo):
        for s in here:
            accepts[k] |= final.get(s, 0)
    if accepts[0]:
        raise ValueError("an expression matches the empty text")
    small, accepts, at = _minimal(np.array(table, np.int64), accepts)
    accepting = int((accepts == 0).sum())
    return Automaton((small[:, kind].reshape(-1) * 256).astype(np.int32), accepts, accepting, at)
