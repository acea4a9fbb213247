"""Secret scans by one deterministic automaton for all rules.

Rules are regular expressions over bytes. They are compiled together by subset construction to one
automaton that starts anew at each byte, minimised, and laid out as one flat transition array, so that
a text is read once, byte by byte, for all rules. States that accept carry a bit mask of rules and
stand last, so that one comparison a byte is enough. Where a rule accepts, its own automaton, run
backwards and forwards from there, gives the start and the greedy end of the match.

Null and empty texts have no spans. Very long texts are scanned whole. Repeated rows are scanned
alike; further columns pass through `masked` as they are.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import by_bytes, mapped_rows, texts

KEY, VALUE = "(password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?", "[A-Za-z0-9+/_.=-]+"
#: name, pattern, whether its letters match in either case, shortest value that counts, and what stands before the value.
#: Lengths of runs after a prefix are checked on the match: counting them in the automaton would multiply its states.
RULES = [
    ("assign", KEY + VALUE, True, 12, re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']? *[:=] *["']?""")),
    ("access", "AKIA[A-Z0-9]+", False, 18, None),
    ("hex", "[0-9a-f]{16,}", False, 16, None),
    ("github", "gh[pousr]_[A-Za-z0-9]+", False, 40, None),
    ("slack", "xox[abprs]-[A-Za-z0-9-]+", False, 15, None),
    ("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", False, 1, None),
]
BASE = ("assign", "access", "hex")
#: What belongs to a match but isn't needed to find it; only the extent of a match is read with it. A private key goes on
#: to its END line; where that is missing, over header fields and base64 runs of 16 or more, and the shorter line after them.
TAILS = {
    "private_key": "((-?[A-Za-z0-9+/=:;,.\\\"'#>*|<()&_@ \t\r\n])*-----END [A-Z ]*PRIVATE KEY-----"
    "|([ \t\r\n]*[A-Za-z0-9-]+: [A-Za-z0-9,-]+)*([\\\"'+>#*|, \t\r\n]*[A-Za-z0-9+/=]{16,})+([\\\"' \t]*[\r\n\\]+[\"' \t]*[A-Za-z0-9+/=]+)?)?",
}


class Nfa:
    """Thompson construction for literals, classes, groups, alternatives and the repeats ? * + {n,}."""

    def __init__(self) -> None:
        self.steps: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def add(self, pattern: str, either_case: bool) -> tuple[int, int]:
        self.rest, self.either = list(pattern), either_case
        begin, end = self.choice()
        if self.rest:
            raise ValueError(f"cannot read {pattern!r} at {''.join(self.rest)!r}")
        return begin, end

    def choice(self) -> tuple[int, int]:
        begin, end = self.state(), self.state()
        while True:
            a, b = self.chain()
            self.free[begin].append(a)
            self.free[b].append(end)
            if not self.rest or self.rest[0] != "|":
                return begin, end
            self.rest.pop(0)

    def chain(self) -> tuple[int, int]:
        begin = end = self.state()
        while self.rest and self.rest[0] not in "|)":
            a, b = self.repeated()
            self.free[end].append(a)
            end = b
        return begin, end

    def repeated(self) -> tuple[int, int]:
        before = list(self.rest)
        a, b = self.atom()
        sign = self.rest[0] if self.rest else ""
        if sign and sign in "?*+":
            self.rest.pop(0)
            if sign in "?*":
                self.free[a].append(b)
            if sign in "*+":
                self.free[b].append(a)
        elif sign == "{":
            close = self.rest.index("}")
            least = int("".join(self.rest[1:close]).rstrip(","))
            after = self.rest[close + 1 :]
            for _ in range(least - 1):  # the atom again, as often as asked
                self.rest = list(before)
                c, d = self.atom()
                self.free[b].append(c)
                b, last = d, c
            if least > 1:
                self.free[b].append(last)
            self.rest = after
        return a, b

    def atom(self) -> tuple[int, int]:
        head = self.rest.pop(0)
        if head == "(":
            found = self.choice()
            self.rest.pop(0)
            return found
        if head == "[":
            members: set[int] = set()
            while (c := self.rest.pop(0)) != "]":
                if self.rest[0] == "-" and self.rest[1] != "]":
                    self.rest.pop(0)
                    members.update(range(ord(c), ord(self.rest.pop(0)) + 1))
                else:
                    members.add(ord(c))
        else:
            members = {ord(head)}
        if self.either:
            members |= {ord(f(chr(m))) for m in members for f in (str.lower, str.upper) if chr(m).isalpha()}
        a, b = self.state(), self.state()
        self.steps[a].append((frozenset(members), b))
        return a, b

    def closed(self, states: frozenset[int] | set[int]) -> frozenset[int]:
        found, left = set(states), list(states)
        while left:
            for t in self.free[left.pop()]:
                if t not in found:
                    found.add(t)
                    left.append(t)
        return frozenset(found)

    def reversed(self) -> Nfa:
        other = Nfa()
        other.steps, other.free = [[] for _ in self.steps], [[] for _ in self.steps]
        for s, steps in enumerate(self.steps):
            for members, t in steps:
                other.steps[t].append((members, s))
            for t in self.free[s]:
                other.free[t].append(s)
        return other


class Dfa:
    """Minimal automaton: `table[256 * state + byte]` is 256 times the next state; accepting states are last."""

    def __init__(self, nfa: Nfa, begins: list[int], ends: dict[int, int], restart: bool):
        first = nfa.closed(set(begins))
        numbers, order, moves = {first: 0}, [first], []
        for states in order:  # subset construction
            by_byte: list[set[int]] = [set() for _ in range(256)]
            for s in states:
                for members, t in nfa.steps[s]:
                    for b in members:
                        by_byte[b].add(t)
            row, known = [], {}
            for targets in by_byte:
                key = frozenset(targets)
                if key not in known:
                    after = nfa.closed(targets | (set(begins) if restart else set()))
                    if after not in numbers:
                        numbers[after] = len(order)
                        order.append(after)
                    known[key] = numbers[after]
                row.append(known[key])
            moves.append(row)
        masks = [sum({1 << ends[s] for s in states if s in ends}) for states in order]
        kinds = masks
        while True:  # minimisation: split classes until no byte tells their members apart
            names: dict = {}
            new = [names.setdefault((kinds[s], *(kinds[t] for t in row)), len(names)) for s, row in enumerate(moves)]
            if len(names) == len(set(kinds)):
                break
            kinds = new
        kinds = new
        heads = {k: s for s, k in reversed(list(enumerate(kinds)))}
        ranked = sorted(heads, key=lambda k: (masks[heads[k]] > 0, heads[k]))
        place = {k: i for i, k in enumerate(ranked)}
        self.start = 256 * place[kinds[0]]
        self.masks = [masks[heads[k]] for k in ranked]
        self.accepting = 256 * sum(not m for m in self.masks)
        self.table = [256 * place[kinds[t]] for k in ranked for t in moves[heads[k]]]
        dead = [k for k in ranked if not masks[heads[k]] and all(kinds[t] == k for t in moves[heads[k]])]
        self.dead = 256 * place[dead[0]] if dead and not restart else -1

    def longest(self, data: bytes, at: int, end: int, step: int = 1) -> int:
        """The furthest place at which it accepts, read from `at` up to (or backwards down to) before `end`."""
        state, found, table = self.start, -1, self.table
        for i in range(at, end, step):
            state = table[state + data[i]]
            if state >= self.accepting:
                found = i
            elif state == self.dead:
                break
        return found

    def first(self, data: bytes, at: int) -> int:
        """The first place from `at` at which it accepts; the end if there is none."""
        state, table = self.start, self.table
        for i in range(at, len(data)):
            state = table[state + data[i]]
            if state >= self.accepting:
                return i
        return len(data)


class SecretScanner:
    """All rules in one automaton, and each rule's own for the extent of a match."""

    def __init__(self, rules: list[tuple] = RULES):
        self.rules, nfa, begins, ends, whole = rules, Nfa(), [], {}, []
        for i, (name, pattern, either, _, _) in enumerate(rules):
            a, b = nfa.add(pattern, either)
            begins.append(a)
            ends[b] = i
            whole.append(nfa.add(pattern + TAILS[name], either) if name in TAILS else (a, b))
        self.all = Dfa(nfa, begins, ends, True)
        back = nfa.reversed()
        finals = {i: b for b, i in ends.items()}
        self.ahead = [Dfa(nfa, [a], {b: 0}, False) for a, b in whole]
        self.alone = [Dfa(nfa, [begins[i]], {finals[i]: 0}, True) for i in range(len(rules))]
        self.behind = [Dfa(back, [finals[i]], {begins[i]: 0}, False) for i in range(len(rules))]

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(rule, start, end) in bytes, leftmost and not overlapping within a rule, sorted by start and rule."""
        table, state, limit, masks = self.all.table, self.all.start, self.all.accepting, self.all.masks
        over, found = [0] * len(self.rules), []
        for i, b in enumerate(data):
            state = table[state + b]
            if state >= limit:
                mask, rule = masks[state >> 8], 0
                while mask:
                    if mask & 1 and i >= over[rule]:
                        at, start = i, self.behind[rule].longest(data, i, over[rule] - 1, -1)
                        if start < 0:  # what accepts here began inside an earlier match: look on from its end
                            at = self.alone[rule].first(data, over[rule])
                            start = self.behind[rule].longest(data, at, over[rule] - 1, -1) if at < len(data) else at
                        over[rule] = end = self.ahead[rule].longest(data, start, len(data)) + 1 if at < len(data) else at
                        _, _, _, least, head = self.rules[rule]
                        if start < end and end - (head.match(data, start).end() if head else start) >= least:
                            found.append((rule, start, end))
                    mask >>= 1
                    rule += 1
        return sorted(found, key=lambda x: (x[1], x[0]))

    def text_spans(self, text: str) -> list[tuple[int, int, int]]:
        """The same in code points."""
        data = text.encode()
        found = self.spans(data)
        if found and len(data) != len(text):
            begins = np.append(0, np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))  # code points before each byte
            found = [(r, int(begins[a]), int(begins[b])) for r, a, b in found]
        return found


@lru_cache(1)
def scanner() -> SecretScanner:
    return SecretScanner()


def span_batches(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str], list[list[tuple[int, int, int]]]]]:
    own = scanner()
    for batch in by_bytes(batches, column):
        many = texts(batch, column)
        yield batch, many, [own.text_spans(x) for x in many]


def find(documents: DataFrame) -> DataFrame:
    """(doc_id, spans) with one row a document; spans in code points, end exclusive."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, spans in span_batches(batches):
            rows = [[{"kind": RULES[r][0], "start": a, "end": b} for r, a, b in x] for x in spans]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], ["doc_id", "spans"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def masked(documents: DataFrame, mask: Callable[[str], str] = lambda kind: f"[{kind}]") -> DataFrame:
    """All rows and columns, each secret in `text` replaced by a mark; overlapping spans become one mark."""
    names = [f.name for f in documents.schema]
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, many, spans in span_batches(batches):
            out = batch.column(at).to_pylist()
            for i, (text, found) in enumerate(zip(many, spans, strict=True)):
                if found:
                    parts, end = [], 0
                    for rule, a, b in found:
                        if a >= end:
                            parts += [text[end:a], mask(RULES[rule][0])]
                        end = max(end, b)
                    out[i] = "".join(parts) + text[end:]
            columns = [pa.array(out, batch.schema.field(at).type) if k == at else batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return mapped_rows(documents, run)
