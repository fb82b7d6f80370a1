"""Secret scans with one automaton for all rules.

Rule patterns are parsed into one non-deterministic automaton, made deterministic by subset construction over byte
classes, minimised by partition refinement, and laid out as one flat transition array. A text is read once,
byte by byte; each visit to an accepting state says which rules have a match that can end there (for a pattern
with an open end the shortest is enough to look for, which keeps the product of the rules small). From such an end, the rule's reversed automaton is run backwards to the leftmost start and its forward automaton onwards to
the longest end. Both walks stay within the match.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltmark.llm._common import parquet, small_batches

# --- patterns -> syntax trees -------------------------------------------------------------------------------


def parse(pattern: str, any_case: bool = False):
    """Trees of ('set', bytes), ('seq', parts), ('alt', parts) and ('rep', part, least, most or None)."""
    at = 0

    def char() -> int:
        nonlocal at
        c = pattern[at]
        at += 1
        if c == "\\":
            c = pattern[at]
            at += 1
            if c == "x":
                at += 2
                return int(pattern[at - 2 : at], 16)
            return ord({"n": "\n", "t": "\t", "r": "\r"}.get(c, c))
        return ord(c)

    def cased(codes: set[int]):
        if any_case:
            codes = codes | {c ^ 32 for c in codes if chr(c).isalpha()}
        return "set", frozenset(codes)

    def bracket():
        nonlocal at
        inverse, codes = pattern[at] == "^", set()
        at += inverse
        while pattern[at] != "]":
            low = high = char()
            if pattern[at] == "-" and pattern[at + 1] != "]":
                at += 1
                high = char()
            codes |= set(range(low, high + 1))
        at += 1
        return ("set", frozenset(range(256)) - codes) if inverse else cased(codes)

    def atom():
        nonlocal at
        if pattern[at] == "(":
            at += 3 if pattern.startswith("(?:", at) else 1
            found = alternatives()
            at += 1
            return found
        if pattern[at] == "[":
            at += 1
            return bracket()
        return cased({char()})

    def repeated():
        nonlocal at
        part = atom()
        while at < len(pattern) and pattern[at] in "?*+{":
            if pattern[at] == "{":
                end = pattern.index("}", at)
                low, _, high = pattern[at + 1 : end].partition(",")
                least, most, at = int(low), (int(high) if high else None) if "," in pattern[at:end] else int(low), end + 1
            else:
                least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[pattern[at]]
                at += 1
            part = ("rep", part, least, most)
        return part

    def alternatives():
        nonlocal at
        found, parts = [], []
        while at < len(pattern) and pattern[at] != ")":
            if pattern[at] == "|":
                at += 1
                found.append(("seq", parts))
                parts = []
            else:
                parts.append(repeated())
        return ("alt", [*found, ("seq", parts)])

    return alternatives()


def mirrored(tree):
    kind = tree[0]
    if kind == "set":
        return tree
    if kind == "rep":
        return ("rep", mirrored(tree[1]), *tree[2:])
    return (kind, [mirrored(x) for x in (tree[1][::-1] if kind == "seq" else tree[1])])


def shortest(tree):
    """The tree without its matches' open ends: what it matches ends where a match of the tree first can."""
    kind = tree[0]
    if kind == "rep" and tree[3] is None:
        return ("rep", tree[1], tree[2], tree[2])
    if kind == "seq" and tree[1]:
        return (kind, [*tree[1][:-1], shortest(tree[1][-1])])
    return (kind, [shortest(x) for x in tree[1]]) if kind == "alt" else tree


# --- trees -> automata --------------------------------------------------------------------------------------


class Nondeterministic:
    def __init__(self):
        self.free: list[list[int]] = []  # moves that read nothing
        self.moves: list[list[tuple[frozenset, int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.moves.append([])
        return len(self.free) - 1

    def add(self, tree, start: int) -> int:
        kind = tree[0]
        if kind == "set":
            end = self.state()
            self.moves[start].append((tree[1], end))
            return end
        if kind == "seq":
            for part in tree[1]:
                start = self.add(part, start)
            return start
        if kind == "alt":
            end = self.state()
            for part in tree[1]:
                self.free[self.add(part, start)].append(end)
            return end
        _, part, least, most = tree
        for _ in range(least):
            start = self.add(part, start)
        if most is None:
            loop = self.state()
            self.free[start].append(loop)
            self.free[self.add(part, loop)].append(loop)
            return loop
        ends = [start]
        for _ in range(most - least):
            ends.append(start := self.add(part, start))
        end = self.state()
        for x in ends:
            self.free[x].append(end)
        return end


@dataclass
class Automaton:
    """A byte's class is kind[byte], and next_[s + class] the next state; a state s is a multiple of the number of classes. State 0 starts, states from ``accepting`` on accept the rules in accepts[s], and nothing follows ``dead`` (-1: none)."""

    kind: bytes
    next_: list[int]
    accepting: int
    accepts: dict[int, tuple[int, ...]]
    dead: int
    size: int


def compiled(trees: list, anywhere: bool, most_states: int = 50_000) -> Automaton:
    """One minimal automaton for all trees; with ``anywhere`` a match may start at any byte."""
    nfa = Nondeterministic()
    root = nfa.state()
    final = {}
    for rule, tree in enumerate(trees):
        start = nfa.state()
        nfa.free[root].append(start)
        final[nfa.add(tree, start)] = rule

    sets = {s for moves in nfa.moves for s, _ in moves}
    kinds: dict[tuple, int] = {}
    kind_of = [kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(256)]
    sample = [kind_of.index(k) for k in range(len(kinds))]
    step = [[[to for s, to in moves if b in s] for b in sample] for moves in nfa.moves]

    def closure(states) -> frozenset:
        todo, seen = list(states), set(states)
        while todo:
            for x in nfa.free[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(x for x in seen if nfa.moves[x] or x in final)

    reach = [[closure(x) for x in per] for per in step]
    first = closure({root})
    number, order, table = {first: 0}, [first], []
    for states in order:
        row = []
        for k in range(len(kinds)):
            to = frozenset().union(*[reach[s][k] for s in states], first if anywhere else ())
            if to not in number:
                number[to] = len(order)
                order.append(to)
                if len(order) > most_states:
                    raise ValueError(f"the rules need more than {most_states} states")
            row.append(number[to])
        table.append(row)
    accepts = [tuple(sorted({final[s] for s in states if s in final})) for states in order]

    # minimisation: states stay together while their accepted rules and all their successors' blocks agree
    moves, labels = np.array(table), {a: i for i, a in enumerate(sorted(set(accepts)))}
    block = np.array([labels[a] for a in accepts])
    while True:
        _, finer = np.unique(np.column_stack([block, block[moves]]), axis=0, return_inverse=True)
        if finer.max() == block.max():
            break
        block = finer.ravel()
    chosen = {int(b): i for i, b in reversed(list(enumerate(block)))}
    ranked = sorted(chosen, key=lambda b: (bool(accepts[chosen[b]]), b != block[0], chosen[b]))
    new = {b: i for i, b in enumerate(ranked)}
    width = len(kinds)
    rows = [[new[int(block[t])] * width for t in table[chosen[b]]] for b in ranked]
    kept = {i * width: accepts[chosen[b]] for i, b in enumerate(ranked)}
    dead = next((s for s, row in zip(kept, rows, strict=True) if not kept[s] and set(row) == {s}), -1)
    return Automaton(bytes(kind_of), [x for row in rows for x in row], min((s for s in kept if kept[s]), default=len(rows) * width), kept, dead, len(rows))


# --- rules --------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    any_case: bool = False
    holds: Callable[[bytes], bool] | None = None  # of the match; a match that fails is passed over


_VALUE = re.compile(rb"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)\Z""")


def long_value(match: bytes) -> bool:
    return len(_VALUE.search(match)[1]) >= 8


#: The kinds and patterns that the query's base columns count.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, long_value),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
#: Further well-known formats.
MORE = (
    Rule("private_key", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]+", holds=lambda match: len(match) >= 24),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", holds=lambda match: len(match) >= 15),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)


class Scanner:
    def __init__(self, rules=BASE + MORE, tables=None):
        """tables: of a scanner that was made for the same rules."""
        self.rules = tuple(rules)
        if tables:
            self.all, self.forward, self.backward = tables
            return
        trees = [parse(r.pattern, r.any_case) for r in self.rules]
        self.all = compiled([shortest(t) for t in trees], anywhere=True)
        self.forward = [compiled([t], anywhere=False) for t in trees]
        self.backward = [compiled([mirrored(t)], anywhere=False) for t in trees]

    @property
    def tables(self):
        return self.all, self.forward, self.backward

    def ends(self, data: bytes) -> list[tuple[int, int]]:
        """(end, accepting state) wherever the one pass over the bytes is in an accepting state."""
        next_, accepting, s, found = self.all.next_, self.all.accepting, 0, []
        for at, b in enumerate(data.translate(self.all.kind), 1):
            s = next_[s + b]
            if s >= accepting:
                found.append((at, s))
        return found

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, end, rule) in bytes: for each rule leftmost, longest and without overlap, then those that hold."""
        done, found = [0] * len(self.rules), []
        for end, state in self.ends(data):
            for rule in self.all.accepts[state]:
                if end <= done[rule]:
                    continue
                start = self._far(self.backward[rule], data, range(end - 1, done[rule] - 1, -1))
                if start is None:
                    continue  # it began within the match before
                stop = self._far(self.forward[rule], data, range(start, len(data))) + 1
                done[rule] = stop
                if (holds := self.rules[rule].holds) is None or holds(data[start:stop]):
                    found.append((start, stop, rule))
        return sorted(found, key=lambda x: (x[0], x[2]))

    @staticmethod
    def _far(machine: Automaton, data: bytes, places: range) -> int | None:
        """The furthest of the places at which the machine accepts."""
        s, last = 0, None
        for at in places:
            s = machine.next_[s + machine.kind[data[at]]]
            if s == machine.dead:
                break
            if s >= machine.accepting:
                last = at
        return last


_scanners: dict[str, Scanner] = {}


def secret_spans(text: Column, spark, rules=BASE + MORE) -> Column:
    """An array of (kind, start, stop), in code points, end exclusive, by start, then in the rules' order. Null counts as empty.

    The automata are compiled once, on the driver; their size depends on the rules alone.
    """
    rules, key = tuple(rules), uuid.uuid4().hex
    shipped = spark.sparkContext.broadcast(Scanner(rules).tables)

    @F.pandas_udf("array<struct<kind string, start int, stop int>>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if key not in _scanners:
            _scanners.clear()
            _scanners[key] = Scanner(rules, shipped.value)
        scanner = _scanners[key]
        for batch in texts:
            out = []
            for t in batch:
                data = (t or "").encode("utf-8", "surrogatepass")
                spans = scanner.spans(data)
                wide = len(data) != len(t or "")
                place, at, chars = {}, 0, 0
                for x in sorted({x for s in spans for x in s[:2]}):
                    chars += len(data[at:x].decode("utf-8", "surrogatepass")) if wide else x - at
                    at, place[x] = x, chars
                out.append([{"kind": rules[r].kind, "start": place[a], "stop": place[b]} for a, b, r in spans])
            yield pd.Series(out)

    return run(text)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=BASE + MORE) -> DataFrame:
    """Per input row: doc_id (as it is, null or repeated) and found, the array of spans; empty where there are none or the text is null. An empty table gives no rows."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), secret_spans(F.col(text_col), docs.sparkSession, rules).alias("found"))


def span_list(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def op3_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = scan_secrets(parquet(spark, sf_dir, "documents").select("doc_id", "text"))
    spans, base = F.col("found"), [r.kind for r in BASE]
    n = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[n(k) for k in base], F.sha2(span_list(F.filter(spans, lambda s: s["kind"].isin(base))), 256).alias("base_sha256"), span_list(spans).alias("spans"))
