import random

from lagloom.llm import decontaminate
from lagloom.llm.decontaminate import EDIT_RATE, Q, build_items, clean_documents, find_contamination, matches, normalised
from tests.llm.fixtures import LONG, edge_rows, frame, prose

ITEMS = [(i, prose(1000 + i, 12 + 3 * i)) for i in range(8)]


def least_edits(text, item):
    """Brute force: edits between the item and the nearest passage."""
    before = [0] * (len(text) + 1)
    for char in item:
        row = [before[0] + 1]
        for j, other in enumerate(text):
            row.append(min(before[j] + (other != char), before[j + 1] + 1, row[j] + 1))
        before = row
    return min(before)


def mutated(pick, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = pick.randrange(len(chars))
        kind = pick.randrange(3)
        if kind == 0:
            chars[at] = pick.choice("abc ")
        elif kind == 1:
            del chars[at]
        else:
            chars.insert(at, pick.choice("abc "))
    return "".join(chars)


def test_matches_are_those_within_the_edit_budget():
    pick, items = random.Random(3), build_items(ITEMS, Q, EDIT_RATE)
    seen = 0
    for n in range(60):
        item = normalised(pick.choice(ITEMS)[1])
        text = normalised(f"{prose(n, 15)} {mutated(pick, item, pick.randint(0, len(item) // 12))} {prose(n + 500, 9)}")
        want = {}
        for place, item_id in enumerate(items.ids):
            edits = least_edits(text, normalised(dict(ITEMS)[item_id]))
            if edits <= items.budgets[place]:
                want[item_id] = edits
        seen += len(want)
        assert {i: edits for _, i, edits, _, _ in matches([text], items, Q)} == want
    assert seen > 20


def test_span_is_the_passage():
    item = normalised(ITEMS[0][1])
    found = matches([f"some words {item} more"], build_items(ITEMS[:1], Q, EDIT_RATE), Q)
    assert found == [(0, 0, 0, 11, 11 + len(item))]


def test_short_items_need_the_whole_item_between_blanks():
    items = build_items([(1, "Tiny Item"), (2, ""), (3, None)], Q, EDIT_RATE)
    assert matches(["a tiny item b", "a tiny items b", ""], items, Q) == [(0, 1, 0, 2, 11)]


def test_a_short_item_has_a_row_for_every_place():
    items = build_items([(1, "Tiny Item"), (2, "x y x")], Q, EDIT_RATE)
    assert matches(["tiny item tiny item b tiny items tiny item"], items, Q) == [(0, 1, 0, 0, 9), (0, 1, 0, 10, 19), (0, 1, 0, 33, 42)]
    assert matches(["x y x y x x y x"], items, Q) == [(0, 2, 0, 0, 5), (0, 2, 0, 10, 15)]


def test_frames_with_edge_rows_and_slices(spark, monkeypatch):
    hit = f"{prose(1)}\n{ITEMS[2][1].upper()}  {prose(2)}"
    docs = frame(spark, [*edge_rows(), (70, hit, None, None, None), (70, hit, None, None, None), (71, f"{LONG} {ITEMS[4][1]}", "en", "s", 1)])
    benchmark = frame(spark, [*ITEMS, (2, ITEMS[2][1]), (None, "x"), (9, None)], "item_id long, text string")
    want = [(70, 2, 0), (70, 2, 0), (71, 4, 0)]
    for chars in (4_000_000, 100):
        monkeypatch.setattr(decontaminate, "SLICE_CHARS", chars)
        found = find_contamination(docs, benchmark).collect()
        assert sorted((r.doc_id, r.item_id, r.edits) for r in found) == want
        kept = clean_documents(docs, benchmark)
        assert kept.count() == len(edge_rows()) and kept.where("doc_id >= 70").count() == 0
    assert kept.schema == docs.schema
    assert find_contamination(docs, benchmark.limit(0)).count() == 0
    assert find_contamination(docs.limit(0), benchmark).count() == 0
