"""Secret scan: one combined deterministic automaton for all rules.

Each rule is a regular expression over bytes. Subset construction turns every rule into a
machine for its leftmost, longest, non-overlapping matches; the product of these machines,
minimised, is one transition array, and a text is read once, byte by byte, for all rules
together. The automaton tells where matches end; a reversed automaton of the rule, run back
from there, tells where they start.

Null and empty texts have no spans. Repeated rows each get their row. Spans are counted in
code points, ends exclusive. Columns besides ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
import re._constants as C
import re._parser as parser
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stayline.llm.batches import documents, small


@dataclass(frozen=True)
class Rule:
    """``head`` then ``tail``, whose last byte may repeat; matches below a minimum length are dropped."""

    kind: str
    head: str
    tail: str
    least: int = 0  # of the whole match
    least_tail: int = 0


# The base rules, then formats that services publish for their keys.
BASE_RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=-]+", least_tail=8),
    Rule("access", r"AKIA", r"[A-Z0-9]+", least=16),
    Rule("hex", r"", r"[0-9a-f]{32,}", least=32),
)
ADDED_RULES = (
    Rule("github", r"gh[pousr]_", r"[A-Za-z0-9]+", least=40),
    Rule("google", r"AIza", r"[A-Za-z0-9_-]+", least=39),
    Rule("slack", r"xox[abprs]-", r"[A-Za-z0-9-]+", least=15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.", r"[A-Za-z0-9_-]+", least=40),
    Rule("pem", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY", r"-----"),
)
RULES = BASE_RULES + ADDED_RULES


class Nfa:
    """Thompson automaton of a byte regex; the standard parser supplies the syntax tree."""

    def __init__(self, pattern: str):
        self.empty: list[list[int]] = [[]]
        self.steps: list[list[tuple[frozenset[int], int]]] = [[]]
        self.accept = self._add(parser.parse(pattern.encode("ascii")), 0, 0)

    def _new(self) -> int:
        self.empty.append([])
        self.steps.append([])
        return len(self.empty) - 1

    def _add(self, tree, at: int, flags: int) -> int:
        for op, arg in tree:
            if op is C.LITERAL or op is C.IN:
                end = self._new()
                self.steps[at].append((_bytes_of(op, arg, flags), end))
                at = end
            elif op is C.BRANCH:
                end = self._new()
                for branch in arg[1]:
                    start = self._new()
                    self.empty[at].append(start)
                    self.empty[self._add(branch, start, flags)].append(end)
                at = end
            elif op is C.SUBPATTERN:
                at = self._add(arg[3], at, (flags | arg[1]) & ~arg[2])
            elif op is C.MAX_REPEAT:
                low, high, body = arg
                for _ in range(low):
                    at = self._add(body, at, flags)
                end = self._new()
                self.empty[at].append(end)
                if high is C.MAXREPEAT:
                    loop = self._new()
                    self.empty[at].append(loop)
                    back = self._add(body, loop, flags)
                    self.empty[back] += [loop, end]
                else:
                    for _ in range(high - low):
                        at = self._add(body, at, flags)
                        self.empty[at].append(end)
                at = end
            else:
                raise ValueError(f"{op} is not supported in a rule")
        return at

    def reversed(self) -> Nfa:
        out = object.__new__(Nfa)
        out.empty = [[] for _ in self.empty]
        out.steps = [[] for _ in self.steps]
        for a, targets in enumerate(self.empty):
            for b in targets:
                out.empty[b].append(a)
        for a, steps in enumerate(self.steps):
            for on, b in steps:
                out.steps[b].append((on, a))
        # State 0 starts an automaton; swap it with the old accepting state.
        swap = {0: self.accept, self.accept: 0}
        names = [swap.get(i, i) for i in range(len(out.empty))]
        out.empty = [[names[b] for b in out.empty[names[i]]] for i in range(len(names))]
        out.steps = [[(on, names[b]) for on, b in out.steps[names[i]]] for i in range(len(names))]
        out.accept = self.accept
        return out

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for b in self.empty[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        return frozenset(seen)

    def move(self, states: frozenset[int], byte: int) -> frozenset[int]:
        return self.closure({b for a in states for on, b in self.steps[a] if byte in on})


def _bytes_of(op, arg, flags: int) -> frozenset[int]:
    out: set[int] = set()
    for kind, x in [(op, arg)] if op is C.LITERAL else arg:
        if kind is C.LITERAL:
            out.add(x)
        elif kind is C.RANGE:
            out.update(range(x[0], x[1] + 1))
        else:
            raise ValueError(f"{kind} is not supported in a rule")
    if flags & C.SRE_FLAG_IGNORECASE:
        out |= {ord(f(chr(x))) for x in out if x < 128 for f in (str.lower, str.upper)}
    return frozenset(out)


def _classes(nfas: list[Nfa]) -> np.ndarray:
    """Bytes that no automaton tells apart share a class."""
    sets = {on for n in nfas for steps in n.steps for on, _ in steps}
    seen: dict[tuple, int] = {}
    order = sorted(sets, key=sorted)
    return np.array([seen.setdefault(tuple(b in on for on in order), len(seen)) for b in range(256)], np.uint8)


class Anchored:
    """Deterministic automaton that tells the longest match from a fixed position."""

    def __init__(self, nfa: Nfa):
        start = nfa.closure([0])
        numbers, todo, rows = {start: 0}, [start], []
        while len(rows) < len(todo):
            row = []
            for byte in range(256):
                nxt = nfa.move(todo[len(rows)], byte)
                if nxt and nxt not in numbers:
                    numbers[nxt] = len(todo)
                    todo.append(nxt)
                row.append(numbers[nxt] if nxt else -1)
            rows.append(row)
        self.rows, self.accepts = rows, [nfa.accept in s for s in todo]

    def longest(self, data) -> int:
        """Bytes of the longest match at the start of ``data`` (0 if none)."""
        s, best = 0, 0
        for i, byte in enumerate(data):
            s = self.rows[s][byte]
            if s < 0:
                break
            if self.accepts[s]:
                best = i + 1
        return best


class _Machine:
    """One rule's search automaton: generations of threads, the oldest start first.

    A state is (generations, hit). After a hit only the generation that matched goes on;
    when it can't go on, its match has ended and the search starts again at that byte.
    """

    def __init__(self, rule: Rule, nfa: Nfa):
        self.rule, self.nfa = rule, nfa
        self.fresh = nfa.closure([0])
        if nfa.accept in self.fresh:
            raise ValueError(f"rule {rule.kind} matches the empty string")
        self.memo: dict = {}

    def step(self, state, byte: int):
        """(next state, whether a match ended before this byte)"""
        key = (state, byte)
        if key not in self.memo:
            self.memo[key] = self._step(state, byte)
        return self.memo[key]

    def _step(self, state, byte: int):
        generations, hit = state
        if hit:
            nxt = self.nfa.move(generations[0], byte)
            if nxt:
                if self.nfa.accept not in nxt:
                    raise ValueError(f"rule {self.rule.kind}: a match must stay one while it goes on")
                return ((nxt,), True), False
            return self._step(((), False), byte)[0], True
        seen: frozenset[int] = frozenset()
        out = []
        for g in (*generations, self.fresh):
            nxt = self.nfa.move(g, byte) - seen
            if nxt:
                out.append(nxt)
                seen |= nxt
            if self.nfa.accept in nxt:
                if len(out) > 1:
                    raise ValueError(f"rule {self.rule.kind}: a later start may not match before an earlier one")
                return ((nxt,), True), False
        return (tuple(out), False), False


class Scanner:
    """All rules in one minimised transition array."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        nfas = [Nfa(r.head + r.tail) for r in rules]
        self.rules = rules
        self.back = [Anchored(n.reversed()) for n in nfas]
        self.heads = [Anchored(Nfa(r.head)) if r.least_tail and r.head else None for r in rules]
        classes = _classes(nfas)
        sample = [int(np.flatnonzero(classes == c)[0]) for c in range(classes.max() + 1)]
        machines = [_Machine(r, n) for r, n in zip(rules, nfas)]

        start = tuple(((), False) for _ in rules)
        numbers, todo = {start: 0}, [start]
        targets: list[list[int]] = []
        endings: dict[tuple[int, ...], int] = {(): 0}
        labels: list[list[int]] = []
        while len(targets) < len(todo):
            row, label = [], []
            for byte in sample:
                moved = [m.step(s, byte) for m, s in zip(machines, todo[len(targets)])]
                nxt = tuple(s for s, _ in moved)
                if nxt not in numbers:
                    numbers[nxt] = len(todo)
                    todo.append(nxt)
                row.append(numbers[nxt])
                ended = tuple(i for i, (_, e) in enumerate(moved) if e)
                label.append(endings.setdefault(ended, len(endings)))
            targets.append(row)
            labels.append(label)
        at_end = [endings.setdefault(tuple(i for i, (_, hit) in enumerate(s) if hit), len(endings)) for s in todo]
        self.states_built = len(todo)
        go, lab, last = _minimal(np.array(targets), np.array(labels), np.array(at_end))

        # A cell is the next state's row, or, below 0, the number of an exit: rules that ended, next row.
        width, names = len(sample), list(endings)
        exits: dict[tuple[int, int], int] = {}
        cells = []
        for g, e in zip((go * width).ravel().tolist(), lab.ravel().tolist()):
            cells.append(~exits.setdefault((e, g), len(exits)) if e else g)
        self.classes, self.width = classes.tobytes(), width
        self.cells = np.array(cells, np.int32)
        self.exits = [(names[e], g) for e, g in exits]
        self.at_end = [names[e] for e in last.tolist()]
        self.n_states = len(go)

    @property
    def table(self) -> list[int]:
        """The cells as a list, which the scanning loop reads fastest; equal numbers are shared."""
        if getattr(self, "_table", None) is None:
            shared = {int(v): int(v) for v in np.unique(self.cells)}
            self._table = [shared[v] for v in self.cells.tolist()]
        return self._table

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_table"}

    def ends(self, data: bytes) -> list[tuple[int, tuple[int, ...]]]:
        """(byte offset, rules whose match ends there), from one pass."""
        table, exits, s, found = self.table, self.exits, 0, []
        for i, c in enumerate(data.translate(self.classes)):
            s = table[s + c]
            if s < 0:
                rules, s = exits[~s]
                found.append((i, rules))
        if last := self.at_end[s // self.width]:
            found.append((len(data), last))
        return found

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, end, rule number) in code points, by start, then rule."""
        data = text.encode()
        out, floor = [], [0] * len(self.rules)
        for end, rules in self.ends(data):
            for k in rules:
                rule = self.rules[k]
                start = end - self.back[k].longest(data[floor[k] : end][::-1])
                floor[k] = end
                if end - start < rule.least:
                    continue
                if rule.least_tail:
                    head = self.heads[k].longest(data[start:end]) if self.heads[k] else 0
                    if end - start - head < rule.least_tail:
                        continue
                out.append((start, end, k))
        if out and len(data) != len(text):
            points = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
            out = [(int(points[a]), int(points[b]), k) for a, b, k in out]
        return sorted(out, key=lambda x: (x[0], x[2], x[1]))


def _minimal(go: np.ndarray, label: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge states that no input tells apart, by refining a partition."""
    part = np.unique(np.column_stack((label, last)), axis=0, return_inverse=True)[1].ravel()
    while True:
        finer = np.unique(np.column_stack((part, part[go])), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == part.max():
            break
        part = finer
    # Number the parts by first member, so that the start stays 0.
    _, first, part = np.unique(part, return_index=True, return_inverse=True)
    rank = np.argsort(np.argsort(first))
    first, part = np.sort(first), rank[part.ravel()]
    return part[go[first]], label[first], last[first]


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    return Scanner(rules)


FOUND = "doc_id bigint, spans array<struct<kind:string,start:bigint,stop:bigint>>"


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans) of every row: kind, start and end of each secret, by start, then kind as listed."""
    shared = docs.sparkSession.sparkContext.broadcast(scanner(rules))  # a few hundred kB, fixed by the rules

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = shared.value
        kinds = [r.kind for r in find.rules]
        spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
        for batch in small(batches):
            found = [
                [{"kind": kinds[k], "start": a, "stop": b} for a, b, k in find.spans(t)]
                for t in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, spans)], names=["doc_id", "spans"])

    return documents(docs).withColumn("doc_id", F.col("doc_id").cast("bigint")).mapInArrow(run, FOUND)


def digest(found: DataFrame) -> DataFrame:
    """Counts by base kind, the hash of the base spans and the text form of all spans."""
    spans, base = F.col("spans"), [r.kind for r in BASE_RULES]

    def joined(x):
        return F.array_join(F.transform(x, lambda s: F.concat_ws(":", s.kind, s.start, s.stop)), ",")

    def number(kind):
        return F.size(F.filter(spans, lambda s: s.kind == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *(number(k).alias(f"n_{k}") for k in base),
        F.sha2(joined(F.filter(spans, lambda s: s.kind.isin(base))), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )
