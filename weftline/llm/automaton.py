"""Regexes to one minimal deterministic automaton over bytes, which finds the spans of all of them in one pass.

The syntax is a small one: literals, escapes (\\xHH too), classes, groups, |, ?, *, +, {m}, {m,} and {m,n}. Characters are ASCII.

Of each rule, overlapping matches are told apart as a regex search does: the leftmost one, as long as it goes, then on from its end. A rule's state is therefore the list of its live threads, oldest first; once a thread has matched, the others are dropped until it ends. The rules' automata are minimised one by one, and run side by side: since every rule has an output of its own, the reachable part of their product is minimal too. Starts are found by the rule's reversed automaton, from the place where the rule was first fulfilled.
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass


class Nfa:
    """States with byte-set moves and empty moves (Thompson's construction)."""

    def __init__(self) -> None:
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1


def parse(pattern: str):
    """A tree: ('set', bytes), ('cat', parts), ('or', parts), ('rep', part, least, most or None)."""
    at = 0

    def char() -> int:
        nonlocal at
        c = pattern[at]
        at += 1
        if c != "\\":
            return ord(c)
        c = pattern[at]
        at += 1
        if c == "x":
            at += 2
            return int(pattern[at - 2 : at], 16)
        return ord({"n": "\n", "r": "\r", "t": "\t"}.get(c, c))

    def klass() -> frozenset[int]:
        nonlocal at
        out: set[int] = set()
        no = pattern[at] == "^"
        at += no
        while pattern[at] != "]":
            low = high = char()
            if pattern[at] == "-" and pattern[at + 1] != "]":
                at += 1
                high = char()
            out.update(range(low, high + 1))
        at += 1
        return frozenset(range(256)) - out if no else frozenset(out)

    def either():
        nonlocal at
        parts = [chain()]
        while at < len(pattern) and pattern[at] == "|":
            at += 1
            parts.append(chain())
        return parts[0] if len(parts) == 1 else ("or", parts)

    def chain():
        nonlocal at
        parts = []
        while at < len(pattern) and pattern[at] not in "|)":
            c = pattern[at]
            if c == "(":
                at += 1
                if pattern.startswith("?:", at):
                    at += 2
                node = either()
                at += 1
            elif c == "[":
                at += 1
                node = ("set", klass())
            else:
                node = ("set", frozenset([char()]))
            while at < len(pattern) and pattern[at] in "?*+{":
                if pattern[at] == "{":
                    m = re.compile(r"\{(\d+)(,?)(\d*)\}").match(pattern, at)
                    least = int(m[1])
                    most = int(m[3]) if m[3] else (None if m[2] else least)
                    at = m.end()
                else:
                    least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[pattern[at]]
                    at += 1
                node = ("rep", node, least, most)
            parts.append(node)
        return ("cat", parts)

    return either()


def build(nfa: Nfa, node, start: int) -> int:
    """Add node's states from start on; the state where it ends."""
    kind = node[0]
    if kind == "set":
        end = nfa.state()
        nfa.moves[start].append((node[1], end))
        return end
    if kind == "cat":
        for part in node[1]:
            start = build(nfa, part, start)
        return start
    if kind == "or":
        end = nfa.state()
        for part in node[1]:
            first = nfa.state()
            nfa.empty[start].append(first)
            nfa.empty[build(nfa, part, first)].append(end)
        return end
    _, part, least, most = node
    for _ in range(least):
        start = build(nfa, part, start)
    if most is None:
        loop, end = nfa.state(), nfa.state()
        nfa.empty[start].append(loop)
        nfa.empty[build(nfa, part, loop)].append(loop)
        nfa.empty[loop].append(end)
        return end
    end = nfa.state()
    nfa.empty[start].append(end)
    for _ in range(most - least):
        start = build(nfa, part, start)
        nfa.empty[start].append(end)
    return end


def reversed_tree(node):
    """The tree of the same strings read backwards."""
    kind = node[0]
    if kind == "set":
        return node
    if kind == "rep":
        return ("rep", reversed_tree(node[1]), *node[2:])
    parts = [reversed_tree(p) for p in node[1]]
    return (kind, parts[::-1] if kind == "cat" else parts)


def byte_sets(node) -> set[frozenset[int]]:
    if node[0] == "set":
        return {node[1]}
    return byte_sets(node[1]) if node[0] == "rep" else set().union(*map(byte_sets, node[1]))


class Steps:
    """The NFA of one tree, by classes of bytes."""

    def __init__(self, tree, sample: dict[int, int]) -> None:
        nfa = Nfa()
        root = nfa.state()
        self.end = build(nfa, tree, root)
        self.nfa, self.sample = nfa, sample
        self.begin = self.closure({root})
        self.known: dict[tuple[frozenset[int], int], frozenset[int]] = {}

    def closure(self, states: set[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for r in self.nfa.empty[todo.pop()]:
                if r not in seen:
                    seen.add(r)
                    todo.append(r)
        return frozenset(seen)

    def after(self, states: frozenset[int], c: int) -> frozenset[int]:
        if (states, c) not in self.known:
            byte = self.sample[c]
            self.known[states, c] = self.closure({to for q in states for s, to in self.nfa.moves[q] if byte in s})
        return self.known[states, c]


def explore(begin, after, width: int) -> tuple[list, list[list[int]]]:
    """All states reachable from begin, and where each class of bytes leads."""
    index, order, delta = {begin: 0}, [begin], []
    for state in order:  # grows meanwhile
        row = []
        for c in range(width):
            to = after(state, c)
            if to not in index:
                index[to] = len(order)
                order.append(to)
            row.append(index[to])
        delta.append(row)
    return order, delta


def minimal(delta: list[list[int]], outputs: list[bool]) -> tuple[list[list[int]], list[bool]]:
    """Blocks of states are split by their output and where they lead, until nothing splits; the first state stays first."""
    keys: dict = {}
    block, count = [keys.setdefault(o, len(keys)) for o in outputs], 0
    while len(keys) > count:
        count, keys = len(keys), {}
        block = [keys.setdefault((block[i], *(block[j] for j in delta[i])), len(keys)) for i in range(len(delta))]
    first: dict[int, int] = {}
    for i, b in enumerate(block):
        first.setdefault(b, i)
    return [[block[j] for j in delta[first[b]]] for b in range(len(keys))], [outputs[first[b]] for b in range(len(keys))]


def forward(pattern: str, tree, sample: dict[int, int]) -> tuple[list[list[int]], list[bool]]:
    """One rule's automaton over any input: its output says that the leftmost match is fulfilled and goes on."""
    steps = Steps(tree, sample)
    if steps.end in steps.begin:
        raise ValueError(f"{pattern} matches the empty string")

    def searching(threads: list[frozenset[int]]):
        alive: list[frozenset[int]] = []
        for t in threads:
            if steps.end in t:
                return (True, t)
            if t and not any(t <= older for older in alive):
                alive.append(t)
        return (False, tuple(alive))

    def after(state, c: int):
        matched, threads = state
        if not matched:
            return searching([steps.after(t, c) for t in (*threads, steps.begin)])
        if on := steps.after(threads, c):
            if steps.end not in on:
                raise ValueError(f"{pattern} can go on unfulfilled after a match")
            return (True, on)
        again = searching([steps.after(steps.begin, c)])
        if again[0]:
            raise ValueError(f"{pattern} matches a single character beside a match")
        return again

    order, delta = explore((False, ()), after, len(sample))
    return minimal(delta, [matched for matched, _ in order])


def backward(tree, sample: dict[int, int]) -> tuple[list[list[int]], list[bool], int]:
    """The automaton of the rule's strings read backwards, and its dead state (-1 without one)."""
    steps = Steps(reversed_tree(tree), sample)
    order, delta = explore(steps.begin, steps.after, len(sample))
    delta, ends = minimal(delta, [steps.end in q for q in order])
    dead = next((i for i, row in enumerate(delta) if not ends[i] and all(j == i for j in row)), -1)
    return delta, ends, dead


@dataclass(frozen=True)
class Automaton:
    """table[state + class] is the next state; states are multiples of `width`; in those from `accepting` on the rules of found[state // width] (a bit each) are fulfilled."""

    classes: bytes
    width: int
    table: array
    accepting: int
    found: list[int]
    start: int
    back: list[tuple[list[list[int]], list[bool], int]]

    def spans(self, data: bytes) -> list[tuple[int, int, int, int]]:
        """(start, rule, end, where the rule was first fulfilled) of all matches, in bytes; one pass, one step a byte."""
        s, table, accepting, found, width = self.start, self.table, self.accepting, self.found, self.width
        codes = data.translate(self.classes)
        out: list[tuple[int, int, int, int]] = []
        begun, last = [0] * len(self.back), [0] * len(self.back)
        open_ = 0

        def change(now: int, at: int) -> None:
            for k in range(len(begun)):
                bit = 1 << k
                if open_ & bit and not now & bit:
                    out.append((self.start_of(codes, k, begun[k], last[k]), k, at, begun[k]))
                    last[k] = at
                elif now & bit and not open_ & bit:
                    begun[k] = at + 1

        for i, c in enumerate(codes):
            s = table[s + c]
            if s < accepting:
                if open_:
                    change(0, i)
                    open_ = 0
            elif found[s // width] != open_:
                change(found[s // width], i)
                open_ = found[s // width]
        change(0, len(codes))
        return sorted(out)

    def start_of(self, codes: bytes, rule: int, end: int, least: int) -> int:
        """The leftmost start, at `least` or after, of the rule's match that was fulfilled at `end`."""
        delta, ends, dead = self.back[rule]
        q, best = 0, end
        for i in range(end - 1, least - 1, -1):
            q = delta[q][codes[i]]
            if q == dead:
                break
            if ends[q]:
                best = i
        return best


def compile_rules(patterns: list[str]) -> Automaton:
    """One automaton for all patterns."""
    trees = [parse(p) for p in patterns]
    # bytes that no set tells apart share a class
    sets = sorted(set().union(*map(byte_sets, trees)), key=sorted)
    marks: dict[tuple[bool, ...], int] = {}
    classes = bytes(marks.setdefault(tuple(b in s for s in sets), len(marks)) for b in range(256))
    sample = {classes[b]: b for b in range(256)}
    rules = [forward(p, t, sample) for p, t in zip(patterns, trees)]
    deltas = [d for d, _ in rules]
    order, delta = explore((0,) * len(rules), lambda state, c: tuple([d[q][c] for d, q in zip(deltas, state)]), len(sample))
    outputs = [sum(1 << k for k, (q, (_, o)) in enumerate(zip(state, rules)) if o[q]) for state in order]
    ranked = sorted(range(len(order)), key=lambda i: (outputs[i] != 0, i))
    number = {i: n for n, i in enumerate(ranked)}
    width = len(sample)
    table = array("l", [number[j] * width for i in ranked for j in delta[i]])
    return Automaton(classes, width, table, sum(o == 0 for o in outputs) * width, [outputs[i] for i in ranked], number[0] * width, [backward(t, sample) for t in trees])
