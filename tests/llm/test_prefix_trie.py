import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from lagloom.llm import prefix_trie as trie
from lagloom.llm.prefix_trie import PerfectHash, prefix_trie, turn_number
from lagloom.llm.queries import ORACLES, op13_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, turn_number(role, text), role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        leader = conv - int(np.fmod(conv, 100))
        built = tuple(own.get(leader, [])[:h] + turns[h:])
        for d in range(len(built) + 1):
            members[built[:d]].append(conv)
        ends[built].append(conv)
    found = []
    for node, convs in members.items():
        below = [p for p in members if p[: len(node)] == node]
        leaves = sum(not any(len(q) == len(p) + 1 and q[:-1] == p for q in members) for p in below)
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        children = sum(len(p) == len(node) + 1 for p in below)
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        found.append((min(convs), len(node), parent, len(convs), children, leaves, saved, digest))
    return found


def compare(spark, rows, parts=4):
    turns = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as depth", "2 as hi", "'x' as owner").repartition(parts)
    found = [tuple(r) for r in prefix_trie(turns).collect()]
    key = lambda r: (r[1], r[0])
    assert sorted(found, key=key) == sorted(brute(rows), key=key)
    return found


def random_rows(seed, convs, most, words):
    pick, rows = random.Random(seed), []
    for conv in convs:
        for turn in range(pick.randint(1, most)):
            rows.append((conv, turn, pick.choice(["user", "assistant"][: 1 + (turn > 1)]), pick.choice(words)))
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, band", [(1, 1 << 16), (2, 2)])
def test_random_conversations(spark, monkeypatch, seed, band):
    monkeypatch.setattr(trie, "BAND", band)
    monkeypatch.setattr(trie, "SHARD_NODES", 7)
    convs = [*range(0, 12), *range(100, 130), *range(205, 212), -3, -100, -150, 10**15 + 7]
    compare(spark, random_rows(seed, convs, 9, ["a", "b", "é😀", ""]))


def test_edge_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"), (1, 0, "", "userx"), (None, 0, "user", "lost")]
    rows += [(100, 0, "user", "y" * 100_000), (101, 5, "user", "y" * 100_000), (250, None, "a", ""), (250, None, "b", None)]
    rows += [(c, t, "user", f"t{t}") for c in (300, 301, 302, 303, 377) for t in range(40)]  # equal conversations
    rows += [(404, 0, "u", "x"), (405, 0, "u", "x")]  # no leader
    compare(spark, rows)


def test_a_conversation_over_many_tasks(spark):
    rows = [(7, t, "user", f"t{t % 5}") for t in range(300)] + [(7, 300, "user", "same")] * 80
    rows += [(107, t, "user", f"t{t % 5}") for t in range(300)] + [(3, 0, "user", "t0")]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = spark.createDataFrame(rows, SCHEMA)
        found = {(r.conv_id, r.depth): r for r in prefix_trie(turns).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    want = {(r[0], r[1]): r for r in brute(rows)}
    assert {k: tuple(r) for k, r in found.items()} == want


def test_empty_table_and_turnless_conversations(spark):
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    turnless = next(c for c in range(501, 600) if zlib.crc32(str(c).encode()) % 6 >= 2)
    assert compare(spark, [(turnless, 0, "user", "gone")])[0][1:7] == (0, None, 1, 0, 1, 0)


def test_slots_are_a_bijection():
    pick = np.random.default_rng(4)
    for n in (0, 1, 2, 1000, 50_000):
        hi, lo = pick.integers(-(2**63), 2**63 - 1, n), pick.integers(-5, 5, n)
        table = PerfectHash(hi, lo)
        assert sorted(table.find(hi, lo)) == list(range(n))
        assert (table.find(hi + 1, lo) < 0).all()
    with pytest.raises(ValueError, match="distinct"):
        PerfectHash(np.array([1, 1]), np.array([2, 2]))


def test_plan_has_no_nested_loops(spark, capsys):
    op13_prefix_trie(spark, "/root/testdata/sf0.001").explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_query_agrees_with_sql(spark, agrees):
    agrees("op13_prefix_trie", op13_prefix_trie, ORACLES)
