"""Rule regexes compiled into one deterministic automaton over bytes.

The regexes are read with the standard library's pattern parser, turned into one
nondeterministic automaton, determinised by subset construction, minimised by partition
refinement and stored as numpy arrays over classes of equivalent bytes.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from re import _constants as op
from re import _parser

import numpy as np

NO_STATE = -1


@dataclass
class _Nfa:
    moves: list[list[tuple[frozenset, int]]] = field(default_factory=list)
    jumps: list[list[int]] = field(default_factory=list)

    def state(self) -> int:
        self.moves.append([])
        self.jumps.append([])
        return len(self.moves) - 1

    def add(self, tree, start: int) -> int:
        """Append the pattern ``tree`` behind ``start``; the state in which it has matched."""
        for kind, value in tree:
            if kind is op.LITERAL:
                start = self._step(start, frozenset((value,)))
            elif kind is op.IN:
                start = self._step(start, _members(value))
            elif kind is op.SUBPATTERN:
                start = self.add(value[3], start)
            elif kind is op.BRANCH:
                end = self.state()
                for branch in value[1]:
                    self.jumps[self.add(branch, start)].append(end)
                start = end
            elif kind is op.MAX_REPEAT:
                start = self._repeat(*value, start)
            else:
                raise ValueError(f"a rule may not use {kind}")
        return start

    def _step(self, start: int, members: frozenset) -> int:
        if max(members) > 127:
            raise ValueError("rules are over ASCII")
        end = self.state()
        self.moves[start].append((members, end))
        return end

    def _repeat(self, least: int, most: int, tree, start: int) -> int:
        for _ in range(least):
            start = self.add(tree, start)
        if most is op.MAXREPEAT:
            loop = self.state()
            self.jumps[start].append(loop)
            self.jumps[self.add(tree, loop)].append(loop)
            return loop
        ends = [start]
        for _ in range(most - least):
            ends.append(start := self.add(tree, start))
        end = self.state()
        for x in ends:
            self.jumps[x].append(end)
        return end

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for x in self.jumps[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)


def _members(items) -> frozenset:
    found: set[int] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            found.add(value)
        elif kind is op.RANGE:
            found.update(range(value[0], value[1] + 1))
        else:
            raise ValueError(f"a rule may not use {kind}")
    return frozenset(found)


@dataclass(frozen=True)
class Automaton:
    """``step[state * classes + byte_class[byte]]`` is the next state times ``classes``.

    State 0 is the start. States from ``accepting`` on accept; ``rules[state]`` has a bit for
    each rule that matches there. ``resets[byte]``: the byte leads every state to the start.
    ``dead``: the state without a way to a match, if there is one.
    """

    byte_class: np.ndarray
    step: np.ndarray
    classes: int
    accepting: int
    rules: np.ndarray
    resets: np.ndarray
    dead: int


def compile_rules(patterns: list[str], anywhere: bool) -> Automaton:
    """One automaton for all patterns; ``anywhere`` lets a match begin at every byte.

    Without ``anywhere`` matches begin at the first byte only.
    """
    if len(patterns) > 62:
        raise ValueError("more than 62 rules")
    nfa = _Nfa()
    root = nfa.state()
    finals: dict[int, int] = {}
    for k, pattern in enumerate(patterns):
        first = nfa.state()
        nfa.jumps[root].append(first)
        finals[nfa.add(_parser.parse(pattern), first)] = k
    byte_class, members = _classes(nfa)
    start = nfa.closure([root])
    number, table, todo = {start: 0}, [], [start]
    while todo:
        fresh: list[frozenset] = []
        for states in todo:
            moves = [m for x in states for m in nfa.moves[x]]
            row = []
            for byte in members:
                target = nfa.closure({end for on, end in moves if byte in on})
                if anywhere:
                    target |= start
                if target not in number:
                    number[target] = len(number)
                    fresh.append(target)
                row.append(number[target])
            table.append(row)
        todo = fresh
    rules = np.zeros(len(number), dtype=np.int64)
    for states, k in number.items():
        for x in states:
            if x in finals:
                rules[k] |= 1 << finals[x]
    step, rules = _minimise(np.array(table, dtype=np.int64), rules)
    return _arranged(byte_class, step, rules)


def _classes(nfa: _Nfa) -> tuple[np.ndarray, list[int]]:
    """Class of each byte and one byte of each class; bytes that no set tells apart share one."""
    sets = sorted({on for moves in nfa.moves for on, _ in moves}, key=sorted)
    kinds: dict[tuple, int] = {}
    byte_class, members = np.zeros(256, dtype=np.uint8), []
    for byte in range(256):
        key = tuple(byte in on for on in sets)
        if key not in kinds:
            kinds[key] = len(kinds)
            members.append(byte)
        byte_class[byte] = kinds[key]
    return byte_class, members


def _minimise(step: np.ndarray, rules: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Moore's refinement: states stay together while their successors' groups agree.

    The start's group comes first, the accepting ones last.
    """
    group = np.unique(rules, return_inverse=True)[1].reshape(-1)
    while True:
        refined = np.unique(np.column_stack([group, group[step]]), axis=0, return_inverse=True)[1].reshape(-1)
        if refined.max() == group.max():
            break
        group = refined
    first = np.unique(group, return_index=True)[1]
    order = np.lexsort((np.arange(len(first)), first != 0, rules[first] != 0))
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    return place[group[step[first[order]]]], rules[first[order]]


def _arranged(byte_class: np.ndarray, step: np.ndarray, rules: np.ndarray) -> Automaton:
    if rules[0]:
        raise ValueError("a rule matches the empty text")
    classes = step.shape[1]
    dead = np.flatnonzero((step == np.arange(len(step))[:, None]).all(axis=1) & (rules == 0))
    return Automaton(
        byte_class=byte_class,
        step=np.ascontiguousarray(step * classes).reshape(-1),
        classes=classes,
        accepting=int(np.argmax(rules != 0)) * classes,
        rules=rules,
        resets=(step == 0).all(axis=0)[byte_class],
        dead=int(dead[0]) * classes if len(dead) else NO_STATE,
    )
