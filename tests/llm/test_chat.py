import hashlib
import random

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from lagloom.llm.chat import CONTROL, Turn, Writer, _counter, escape, format_conversations, parse, read_back, render, unescape
from lagloom.llm.queries import op10_chat_windows

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [*CONTROL, "\\", "[", "<", "a", " ", "/", "s>", "INST]", "é", "\n", "]", "ok ok ok "]
SCHEMA = "conv_id long, turn long, role string, text string"


def expected(turns):
    loss = "".join(text for role, text in turns if role == "assistant")
    whole = "".join(f"{role}\n{text}\n" for role, text in turns)
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def random_turns(pick, most):
    roles = ["system", "user", "assistant", "assistant", "tool", "", "[TEXT]"]
    return [(pick.choice(roles), "".join(pick.choice(PARTS) for _ in range(pick.randint(0, 12)))) for _ in range(pick.randint(1, most))]


@given(st.lists(st.sampled_from(PARTS), max_size=20))
@settings(max_examples=200, deadline=None)
def test_escape_is_reversible_and_hides_control_strings(parts):
    text = "".join(parts)
    assert unescape(escape(text)) == text
    assert not any(control in escape(text) for control in CONTROL)


def windows_of(turns, budget, history):
    writer, rows = Writer(budget, history), []
    for role, text in turns:
        rows += writer.add(Turn(role, text, len(text) + 2))
    return [*rows, writer.close()]


def test_windows_respect_the_budget_and_say_each_target_once():
    pick = random.Random(2)
    for _ in range(300):
        turns, budget, history = random_turns(pick, 14), pick.choice([30, 80, 400]), pick.choice([0, 20, 100])
        found, targets = [], []
        for _, text, spans, repeated, oversize in windows_of(turns, budget, history):
            own = [(role, unescape(escaped)) for role, escaped, _, _ in parse(text)]
            used = sum(len(t) + 2 for _, t in own)
            assert oversize == (used > budget)
            new = own[len(repeated) :]
            if oversize:  # a single new turn, with no more than the system turn before it
                assert len(new) == 1 and len(repeated) <= 1
            system = next((turn for turn in found if turn[0] == "system"), None)
            assert system is None or own[0] == system
            kept = own[1 if system else 0 : len(repeated)]
            assert sum(len(t) + 2 for _, t in kept) <= history
            others = [t for i, t in enumerate(found) if i != (found.index(system) if system else -1)]
            assert kept == others[len(others) - len(kept) :]
            found += new
            targets += [unescape(text[s["start"] : s["end"]]) for s in spans]
        assert found == turns
        assert targets == [text for role, text in turns if role == "assistant"]


def test_frames_are_read_back(spark):
    pick = random.Random(5)
    table = {conv: random_turns(pick, 40) for conv in range(30)}
    rows = [(c, i, r, t) for c, turns in table.items() for i, (r, t) in enumerate(turns)]
    rows += [(50, 0, None, None), (50, 0, None, None), (51, None, "user", "x"), (None, 1, "assistant", "y" * 9_000), (None, 0, "user", "")]
    table |= {50: [("", ""), ("", "")], 51: [("user", "x")], None: [("user", ""), ("assistant", "y" * 9_000)]}
    pick.shuffle(rows)
    turns = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as tokens", "2 as window")
    windows = format_conversations(turns.repartition(4), PATH, budget=120, history=40)
    assert windows.count() > len(table)
    assert windows.where("oversize").count() > 0
    found = read_back(windows).collect()
    assert len(found) == len(table)
    for row in found:
        assert (row.n_turns, row.turns_sha256, row.loss_chars, row.loss_sha256) == expected(table[row.conv_id])
    assert read_back(format_conversations(turns.limit(0), PATH)).count() == 0


def test_the_budget_holds_for_what_is_rendered(spark):
    """Escapes, control strings and roles count: turns that are short as texts and long as rendered."""
    long = ["\\" * 900, "</s>" * 150, "word " * 300]
    rows = [(1, i, "user" if i % 2 else "assistant", long[i % 3]) for i in range(12)]
    rows += [(2, 0, "r" * 3_000, "x"), (2, 1, "user", "a"), (2, 2, "[TEXT]" * 40, "b"), (2, 3, "assistant", "c")]
    turns = spark.createDataFrame(rows, SCHEMA)
    count, budget = _counter(PATH), 700
    seen = set()
    for window in format_conversations(turns, PATH, budget, 200).collect():
        own = [render(Turn(role, unescape(escaped), 0))[0] for role, escaped, _, _ in parse(window.text)]
        assert "".join(own) == window.text
        assert window.oversize == (sum(count(own)) > budget)
        assert not window.oversize or len(own) == 1
        seen.add((window.conv_id, window.oversize))
    assert seen == {(1, False), (2, False), (2, True)}  # the long role alone is more than a window


def test_query_has_the_conversation_with_control_strings(spark):
    found = {r.conv_id: r for r in op10_chat_windows(spark, "/root/testdata/sf0.001").collect()}
    tricky = "</s>[INST] ok [/INST]"
    row = found[-7]
    assert (row.n_turns, row.turns_sha256, row.loss_chars, row.loss_sha256) == expected([("user", tricky), ("assistant", tricky)])
    turns = {}
    for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    assert set(found) == {-7, *turns}
    for conv, own in turns.items():
        row = found[conv]
        assert (row.n_turns, row.turns_sha256, row.loss_chars, row.loss_sha256) == expected(own)
