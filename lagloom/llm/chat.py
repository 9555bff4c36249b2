"""Chat formatting: conversations as turn-aligned windows under a token budget, with a loss mask.

Prefix sums of the turns' token counts choose the spans: a window begins with the conversation's first system turn,
repeats the last turns before it as far as the history budget allows, and takes new turns while the whole stays in
the budget. A turn counts the tokens of its rendered form, role, control strings and escapes included, encoded by itself. Only assistant turns that a window has for the first time are targets; repeated ones are masked. A new
turn that is too long on its own is kept whole and gives a window without history, marked ``oversize``.

Template (control strings marked with <>): a system turn is ``<<<SYS>>>text<<</SYS>>>``, a user turn ``<[INST]> text
<[/INST]>``, an assistant turn `` text<</s>>``, any other role ``<[ROLE]>role<[TEXT]>text<[/ROLE]>``. In texts and roles a
backslash is doubled, and a control string gets a backslash behind its first character, so control strings of a text
can't be taken for the template's, and ``unescape`` gives the text back.

Turns are read in the order (turn, role, text), nulls first, streamed from sorted partitions: a task holds one window
and the history, whatever the length of a conversation. Defined results: a null text is empty, a null role is "";
repeated rows are turns of their own; a null conv_id is a conversation like others.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: The control strings.
CONTROL = ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "</s>", "[ROLE]", "[TEXT]", "[/ROLE]")
BUDGET_TOKENS = 2048
HISTORY_TOKENS = 512

_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_MARK = re.compile(f"({_CONTROL.pattern})")

WINDOWS = "window int, text string, spans array<struct<start:int,end:int>>, repeated array<int>, oversize boolean"


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


class Turn(NamedTuple):
    role: str
    text: str
    tokens: int


def render(turn: Turn) -> tuple[str, int, int]:
    """The formatted turn and the span of its escaped text in it."""
    role, text = turn.role, escape(turn.text)
    if role == "system":
        before, after = "<<SYS>>", "<</SYS>>"
    elif role == "user":
        before, after = "[INST] ", " [/INST]"
    elif role == "assistant":
        before, after = " ", "</s>"
    else:
        before, after = f"[ROLE]{escape(role)}[TEXT]", "[/ROLE]"
    return before + text + after, len(before), len(before) + len(text)


def parse(text: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, escaped text, start, end) of the turns of a formatted window."""
    at = 0
    while at < len(text):
        if text.startswith("<<SYS>>", at):
            role, start, close, pad = "system", at + 7, "<</SYS>>", ""
        elif text.startswith("[INST]", at):
            role, start, close, pad = "user", at + 7, "[/INST]", " "
        elif text.startswith("[ROLE]", at):
            middle = text.index("[TEXT]", at)
            role, start, close, pad = unescape(text[at + 6 : middle]), middle + 6, "[/ROLE]", ""
        else:
            role, start, close, pad = "assistant", at + 1, "</s>", ""
        stop = text.index(close, start)
        yield role, text[start : stop - len(pad)], start, stop - len(pad)
        at = stop + len(close)


class Writer:
    """The windows of one conversation, turn by turn; spans are chosen on prefix sums of tokens."""

    def __init__(self, budget: int, history: int) -> None:
        self.budget, self.history = budget, history
        self.system: Turn | None = None
        self.recent: list[Turn] = []  # the last turns, as many as the history budget allows
        self.sums = [0]  # tokens of all turns before each of the recent ones, and behind the last
        self.new: list[Turn] = []
        self.used = 0
        self.before: list[Turn] = []  # repeated turns of the open window
        self.number = 0

    def add(self, turn: Turn) -> Iterator[tuple]:
        if self.new and self.used + turn.tokens > self.budget:
            yield self.close()
        if not self.new:
            self.open(turn)
        self.new.append(turn)
        self.used += turn.tokens

    def open(self, turn: Turn) -> None:
        """Choose what the next window repeats: the system turn, and the longest span of last turns there is room for."""
        kept = [self.system] if self.system else []
        fixed = sum(t.tokens for t in kept)
        first = self.first_within(min(self.history, self.budget - fixed - turn.tokens))
        self.before = kept + self.recent[first:]
        self.used = fixed + (self.sums[-1] - self.sums[first] if first < len(self.recent) else 0)

    def first_within(self, room: int) -> int:
        """The first of the recent turns from which on all together have at most ``room`` tokens."""
        return bisect_left(self.sums, self.sums[-1] - room)

    def close(self) -> tuple:
        parts, spans, at = [], [], 0
        for i, turn in enumerate(self.before + self.new):
            text, start, end = render(turn)
            if turn.role == "assistant" and i >= len(self.before):
                spans.append({"start": at + start, "end": at + end})
            parts.append(text)
            at += len(text)
        row = (self.number, "".join(parts), spans, list(range(len(self.before))), self.used > self.budget)
        for turn in self.new:
            if self.system is None and turn.role == "system":
                self.system = turn
            else:
                self.recent.append(turn)
                self.sums.append(self.sums[-1] + turn.tokens)
        gone = self.first_within(self.history)
        del self.recent[:gone], self.sums[:gone]
        self.new, self.number = [], self.number + 1
        return row


def format_conversations(
    turns: DataFrame, tokenizer: str, budget: int = BUDGET_TOKENS, history: int = HISTORY_TOKENS
) -> DataFrame:
    """conv_id and the windows: number, text, loss spans (code points), indexes of repeated turns, oversize.

    The windows of a conversation come one behind the other, in order, from one task.
    """
    id_type = turns.schema["conv_id"].dataType.simpleString()
    sortable = f"conv_id {id_type}, turn {turns.schema['turn'].dataType.simpleString()}, role string, text string"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(tokenizer)
        for batch in batches:
            rendered = [render(Turn(r, t, 0))[0] for r, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            tokens = pa.array(count(rendered), pa.int32())
            yield pa.record_batch([*batch.columns, tokens], names=[*batch.schema.names, "tokens"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_id, writer, kind = None, None, None
        for batch in batches:
            kind = batch.schema.field(0).type
            found = []
            for conv, role, text, tokens in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if writer is None or conv != open_id:
                    if writer is not None:
                        found.append((open_id, *writer.close()))
                    open_id, writer = conv, Writer(budget, history)
                found += [(conv, *row) for row in writer.add(Turn(role, text, tokens))]
            yield from _window_batch(found, kind)
        if writer is not None:
            yield from _window_batch([(open_id, *writer.close())], kind)

    filled = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    ordered = (  # tokens are counted before rows meet by conversation, so that a hot one isn't counted in one task
        filled.mapInArrow(measure, f"{sortable}, tokens int")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text", "tokens")
    )
    return ordered.mapInArrow(write, f"conv_id {id_type}, {WINDOWS}")


def _window_batch(rows: list[tuple], id_type) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    kinds = (id_type, pa.int32(), pa.string(), span, pa.list_(pa.int32()), pa.bool_())
    names = ["conv_id", "window", "text", "spans", "repeated", "oversize"]
    if rows:
        yield pa.record_batch([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)


def _counter(path: str) -> Callable[[list[str]], list[int]]:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = True
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, from the windows alone: its turns once each, the text under the mask, the formatted length.

    Windows must come as ``format_conversations`` gives them, or in (conv_id, window) order within partitions.
    """
    id_type = windows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = [part.split()[0] for part in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_id, state, kind = None, None, pa.int64()

        def rows(found: list[tuple]) -> Iterator[pa.RecordBatch]:
            if found:
                yield pa.record_batch([pa.array(list(c), kind if not i else None) for i, c in enumerate(zip(*found))], names=names)

        for batch in batches:
            kind = batch.schema.field(0).type
            done = []
            for conv, text, spans, repeated in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if state is None or conv != open_id:
                    if state is not None:
                        done.append((open_id, *state.row()))
                    open_id, state = conv, _Digest()
                state.add(text, spans, set(repeated))
            yield from rows(done)
        if state is not None:
            yield from rows([(open_id, *state.row())])

    return windows.select("conv_id", "text", "spans", "repeated").mapInArrow(read, schema)


class _Digest:
    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, text: str, spans: list[dict], repeated: set[int]) -> None:
        self.chars += len(text)
        for i, (role, escaped, _, _) in enumerate(parse(text)):
            if i not in repeated:
                self.n_turns += 1
                self.turns.update(f"{role}\n{unescape(escaped)}\n".encode())
        for span in spans:
            target = unescape(text[span["start"] : span["end"]])
            self.loss_chars += len(target)
            self.loss.update(target.encode())

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars
