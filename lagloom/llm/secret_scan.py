"""Secret scans: the regexes of all rules in one minimised automaton that reads every byte once.

Each rule regex becomes an NFA over bytes; subset construction of their union (started anew at every byte) and
partition refinement give one transition array. A text is cut into lanes at bytes after which the automaton is in
its start state whatever came before, and all lanes of a piece step through the array side by side. Lanes that
reach an accepting state are resolved with the automaton of each rule alone, which gives the leftmost longest
non-overlapping spans.

Defined results: a null text is an empty one and has no spans; a null doc_id stays null; repeated rows give
repeated results; further columns are left alone by ``redact`` and ignored by ``find_secrets``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import cache
from re import _parser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lagloom.llm.batches import buffers, pieces, texts_of

LANE_BYTES = 512
#: With fewer lanes than this a loop over single bytes is faster than array steps.
FEW_LANES = 48


class Rule(NamedTuple):
    """A match is ``pattern`` and then ``value``; it is dropped if the value part is shorter than ``least`` bytes."""

    kind: str
    pattern: str
    ignore_case: bool = False
    value: str = ""
    least: int = 0


#: The first three rules are the base kinds.
RULES = (
    Rule("assign", r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", True, "[A-Za-z0-9+/_.=-]+", 8),
    Rule("access", r"AKIA", False, "[A-Z0-9]+", 12),
    Rule("hex", r"[0-9a-f]{32,}"),
    Rule("github", r"gh[pousr]_", False, "[A-Za-z0-9]+", 20),
    Rule("slack", r"xox[abprs]-", False, "[A-Za-z0-9-]+", 10),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
BASE_KINDS = ("assign", "access", "hex")

SPANS = "array<struct<kind:string,start:int,end:int>>"


class Nfa:
    """Byte NFA built from a parsed regex: literals, classes, groups, alternatives and repeats."""

    def __init__(self) -> None:
        self.empty: dict[int, set[int]] = defaultdict(set)
        self.moves: dict[int, list[tuple[frozenset, int]]] = defaultdict(list)
        self.accepts: dict[int, int] = {}
        self.states = 0

    def state(self) -> int:
        self.states += 1
        return self.states - 1

    def add(self, pattern: str, rule: int, ignore_case: bool, start: int) -> None:
        self.accepts[self._sequence(_parser.parse(pattern), start, ignore_case)] = rule

    def _sequence(self, items: Iterable, at: int, fold: bool) -> int:
        for op, value in items:
            at = self._item(str(op), value, at, fold)
        return at

    def _item(self, op: str, value, at: int, fold: bool) -> int:
        if op in ("LITERAL", "IN"):
            bytes_ = {value} if op == "LITERAL" else _class(value)
            if fold:
                bytes_ |= {ord(c) for b in bytes_ for c in (chr(b).lower(), chr(b).upper()) if b < 128}
            end = self.state()
            self.moves[at].append((frozenset(bytes_), end))
            return end
        if op == "SUBPATTERN":
            return self._sequence(value[-1], at, fold)
        if op == "BRANCH":
            end = self.state()
            for branch in value[1]:
                self.empty[self._sequence(branch, at, fold)].add(end)
            return end
        if op == "MAX_REPEAT":
            least, most, items = value
            for _ in range(least):
                at = self._sequence(items, at, fold)
            if str(most) == "MAXREPEAT":
                loop = self.state()
                self.empty[at].add(loop)
                self.empty[self._sequence(items, loop, fold)].add(loop)
                return loop
            end = self.state()
            for _ in range(most - least):
                self.empty[at].add(end)
                at = self._sequence(items, at, fold)
            self.empty[at].add(end)
            return end
        raise ValueError(f"a rule regex can't have {op}")

    def closure(self, states: Iterable[int]) -> frozenset:
        found, todo = set(states), list(states)
        while todo:
            for nxt in self.empty.get(todo.pop(), ()):
                if nxt not in found:
                    found.add(nxt)
                    todo.append(nxt)
        return frozenset(found)


def _class(items: Iterable) -> set[int]:
    found: set[int] = set()
    for op, value in items:
        if str(op) == "LITERAL":
            found.add(value)
        elif str(op) == "RANGE":
            found.update(range(value[0], value[1] + 1))
        else:
            raise ValueError(f"a class of a rule regex can't have {op}")
    return found


class Automaton(NamedTuple):
    """``moves[state * classes + byte_class[byte]]``; accepting states have the highest numbers, from ``accepting``.

    State 0 is the start. ``dead`` is the state without a way out, -1 if there is none. ``resets`` are the bytes
    that lead to state 0 from every state.
    """

    moves: np.ndarray
    byte_class: np.ndarray
    classes: int
    accepting: int
    dead: int
    resets: np.ndarray


def compile_rules(rules: list[tuple[str, bool]], anywhere: bool) -> Automaton:
    """The minimised automaton of all patterns; ``anywhere``: a match may begin at any byte."""
    nfa = Nfa()
    start = nfa.state()
    for number, (pattern, fold) in enumerate(rules):
        first = nfa.state()
        nfa.empty[start].add(first)
        nfa.add(pattern, number, fold, first)
    marks = np.zeros(256, dtype=np.int64)
    for sets in {s for moves in nfa.moves.values() for s, _ in moves}:
        inside = np.isin(np.arange(256), list(sets)).astype(np.int64)
        marks = np.unique(marks * 2 + inside, return_inverse=True)[1]
    classes = int(marks.max()) + 1
    sample = [int(np.flatnonzero(marks == c)[0]) for c in range(classes)]

    first = nfa.closure([start])
    ids, order, moves = {first: 0}, [first], []
    for states in order:  # grows while it is walked
        row = []
        for byte in sample:
            reached = {to for s in states for allowed, to in nfa.moves.get(s, ()) if byte in allowed}
            target = nfa.closure(reached | ({start} if anywhere else set()))
            if target not in ids:
                ids[target] = len(order)
                order.append(target)
            row.append(ids[target])
        moves.append(row)
    table = np.array(moves, dtype=np.int64)
    accepts = np.array([bool(states & nfa.accepts.keys()) for states in order])

    block = accepts.astype(np.int64)  # partition refinement until no block splits
    while True:
        signature = np.column_stack([block, block[table]])
        refined = np.unique(signature, axis=0, return_inverse=True)[1].ravel()
        if refined.max() == block.max():
            break
        block = refined
    kinds = refined.max() + 1
    some = np.zeros(kinds, dtype=np.int64)
    some[refined] = np.arange(len(refined))
    rank = sorted(range(kinds), key=lambda b: (b != refined[0], bool(accepts[some[b]]), some[b]))
    number = np.zeros(kinds, dtype=np.int64)
    number[rank] = np.arange(kinds)
    small = number[refined[table[some[rank]]]]
    ends = accepts[some[rank]]
    accepting = int(np.flatnonzero(ends)[0]) if ends.any() else kinds
    stuck = [s for s in range(kinds) if not ends[s] and (small[s] == s).all()]
    resets = np.flatnonzero((small == 0).all(axis=0)[marks])
    dtype = np.uint16 if kinds < 1 << 16 else np.uint32
    return Automaton(small.astype(dtype).ravel(), marks.astype(np.uint8), classes, accepting, stuck[0] if stuck else -1, resets)


class Scanner:
    """The combined automaton of the rules, and each rule's own for exact spans."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = rules
        whole = [(rule.pattern + rule.value, rule.ignore_case) for rule in rules]
        self.any = compile_rules(whole, anywhere=True)
        self.alone = [compile_rules([pair], anywhere=False) for pair in whole]
        self.heads = [compile_rules([(r.pattern, r.ignore_case)], anywhere=False) if r.value else None for r in rules]
        self.reset = np.zeros(256, dtype=bool)
        self.reset[self.any.resets] = True

    def lanes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of lanes: cuts at row starts and behind resetting bytes, about LANE_BYTES apart."""
        behind = np.flatnonzero(self.reset[data]) + 1
        wanted = np.arange(LANE_BYTES, len(data), LANE_BYTES)
        at = np.searchsorted(behind, wanted)
        cuts = np.concatenate([offsets, behind[at[at < len(behind)]]])
        cuts = np.unique(cuts[cuts <= len(data)])
        return cuts[:-1], cuts[1:]

    def flagged(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
        """Lanes in which the combined automaton accepts somewhere."""
        starts, ends = self.lanes(data, offsets)
        if not len(starts):
            return []
        lengths = ends - starts
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        codes = self.any.byte_class[data]
        moves, classes = self.any.moves, self.any.classes
        state = np.zeros(len(starts), dtype=np.int64)
        top = np.zeros(len(starts), dtype=np.int64)
        active = np.searchsorted(-lengths, -np.arange(int(lengths[0])), side="left")
        step = 0
        for count in active:
            if count < FEW_LANES:
                break
            state[:count] = moves[state[:count] * classes + codes[starts[:count] + step]]
            np.maximum(top[:count], state[:count], out=top[:count])
            step += 1
        if step < len(active):
            table = moves.tolist()
            for lane in range(int(active[step])):
                now, best = int(state[lane]), int(top[lane])
                for code in codes[starts[lane] + step : starts[lane] + lengths[lane]].tobytes():
                    now = table[now * classes + code]
                    if now > best:
                        best = now
                top[lane] = best
        hit = np.flatnonzero(top >= self.any.accepting)
        return sorted((int(starts[i]), int(starts[i] + lengths[i])) for i in hit)

    def resolve(self, text: bytes) -> Iterator[tuple[int, int, int]]:
        """(rule, start, end) of the leftmost longest non-overlapping matches of every rule in one lane."""
        for number, rule in enumerate(self.rules):
            at = 0
            while at < len(text):
                end = _longest(self.alone[number], text, at)
                if end < 0:
                    at += 1
                    continue
                head = _longest(self.heads[number], text, at) if rule.value else at
                if end - head >= rule.least:
                    yield number, at, end
                at = end

    def spans(self, piece: pa.RecordBatch, column: str = "text") -> dict[int, list[tuple[str, int, int]]]:
        """Spans in code points of the rows that have any: by row, in the order of start, then of the rules."""
        data, offsets = buffers(texts_of(piece, column))
        found = defaultdict(list)
        for start, end in self.flagged(data, offsets):
            row = int(np.searchsorted(offsets, start, side="right")) - 1
            for number, a, b in self.resolve(data[start:end].tobytes()):
                found[row].append((start + a, number, start + b))
        result = {}
        for row, spans in found.items():
            begins = (data[offsets[row] : offsets[row + 1]] & 0xC0) != 0x80  # first bytes of code points
            before = np.concatenate([[0], np.cumsum(begins)])
            result[row] = [
                (self.rules[n].kind, int(before[a - offsets[row]]), int(before[b - offsets[row]])) for a, n, b in sorted(spans)
            ]
        return result


def _longest(automaton: Automaton, text: bytes, at: int) -> int:
    """End of the longest match that begins at ``at``, -1 without one."""
    state, end = 0, -1
    moves, codes, classes = automaton.moves, automaton.byte_class, automaton.classes
    for i in range(at, len(text)):
        state = moves[int(state) * classes + int(codes[text[i]])]
        if state == automaton.dead:
            break
        if state >= automaton.accepting:
            end = i + 1
    return end


@cache
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    """Compiled once in a Python worker."""
    return Scanner(rules)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and the spans of every row, in code points, the end exclusive."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        for piece in pieces(batches):
            found = scanner(rules).spans(piece)
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in found.get(i, ())] for i in range(piece.num_rows)]
            yield pa.record_batch([piece.column(0), pa.array(spans, type=pa.list_(kinds))], names=["doc_id", "spans"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {id_type}, spans {SPANS}")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows with every secret replaced by its kind in brackets; overlapping spans become one; n_chars follows."""
    names = docs.columns

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nulls = batch.column(names.index("text")).is_null()
            done = 0
            for piece in pieces([batch]):
                found = scanner(rules).spans(piece)
                texts = piece.column(names.index("text")).to_pylist()
                for row, spans in found.items():
                    texts[row] = _without(texts[row], spans)
                at_null = nulls.slice(done, piece.num_rows).to_pylist()
                done += piece.num_rows
                columns = list(piece.columns)
                columns[names.index("text")] = pa.array([None if n else t for t, n in zip(texts, at_null)], pa.string())
                if "n_chars" in names and found:
                    counts = piece.column(names.index("n_chars")).to_pylist()
                    for row in found:
                        counts[row] = len(texts[row])
                    columns[names.index("n_chars")] = pa.array(counts, piece.schema.field("n_chars").type)
                yield pa.record_batch(columns, names=names)

    return docs.mapInArrow(rewrite, docs.schema)


def _without(text: str, spans: list[tuple[str, int, int]]) -> str:
    parts, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            parts.append(f"{text[at:start]}[{kind}]")
        at = max(at, end)
    return "".join(parts) + text[at:]
