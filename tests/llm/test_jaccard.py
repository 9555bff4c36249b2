import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from lagloom.llm import jaccard
from lagloom.llm.batches import texts_of
from lagloom.llm.components import components
from lagloom.llm.components import stars
from lagloom.llm.jaccard import jaccard_components, prefixes, shingle_sets
from lagloom.llm.queries import ORACLES, op1_ngram_jaccard_join
from tests.llm.fixtures import SCHEMA, edge_rows, frame, prose


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, size, percent):
    """(doc_id, n, component, links) of every row, by comparing all pairs."""
    sets = [shingles(text, size) for _, text, *_ in rows]
    links = [[] for _ in rows]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j and a and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                links[i].append(j)
    found = []
    for i, (doc_id, *_) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        if doc_id is not None:
            found.append((doc_id, len(sets[i]), min(rows[j][0] for j in seen), len(links[i])))
    return sorted(found)


def corpus(seed):
    """Families of near copies at all distances, chains, a shared passage, and unrelated texts."""
    pick = random.Random(seed)
    passage = " ".join(f"q{i}" for i in range(25))
    texts = [f"{passage} {prose(seed * 100 + i, 30)}" for i in range(12)] + [prose(seed * 200 + i, 60) for i in range(6)]
    for family in range(4):
        words = prose(seed * 300 + family, 90).split()
        for _ in range(14):
            copy = list(words)
            for _ in range(pick.randint(0, 4)):
                copy[pick.randrange(len(copy))] = f"z{pick.randrange(999)}"
            texts.append(" ".join(copy).upper() if pick.random() < 0.3 else " ".join(copy))
            if pick.random() < 0.3:
                words = copy  # a chain: the next ones are copies of the copy
    pick.shuffle(texts)
    return [(1000 + 7 * i, t, None, None, None) for i, t in enumerate(texts)]


def result(frame):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in frame.collect() if r.doc_id is not None)


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
def test_components_and_links_are_those_of_all_pairs(spark, size, percent):
    rows = corpus(size) + edge_rows()
    found = jaccard_components(frame(spark, rows).selectExpr("*", "1 as id", "2 as n"), size, percent)
    assert result(found) == brute(rows, size, percent)
    assert found.where("doc_id is null").count() == 1


def test_large_groups_in_parts_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP_PART", 3)
    monkeypatch.setattr(jaccard, "CLUSTER_PART", 4)
    monkeypatch.setattr(jaccard, "FREQUENT_LEAST", 2)
    rows = corpus(9)
    assert result(jaccard_components(frame(spark, rows), 3, 90)) == brute(rows, 3, 90)


def test_ids_of_another_type_make_the_same_links(spark):
    rows = corpus(6)
    found = jaccard_components(frame(spark, rows, SCHEMA.replace("doc_id long", "doc_id int")), 3, 90)
    assert result(found) == brute(rows, 3, 90) and any(links for *_, links in result(found))


def test_no_documents(spark):
    assert jaccard_components(frame(spark, []), 3, 90).count() == 0
    assert result(jaccard_components(frame(spark, [(1, None, None, None, None)]), 3, 90)) == [(1, 0, 1, 0)]


def test_linked_sets_share_a_prefix_token_in_every_order():
    rows = corpus(4)
    texts = texts_of(pa.record_batch([pa.array([t for _, t, *_ in rows])], names=["text"]))
    sets = shingle_sets(texts, 3)
    values, counts = np.unique(jaccard.bucket(sets.hashes), return_counts=True)
    own = [set(sets.hashes[a:b].tolist()) for a, b in zip(sets.rows[:-1], sets.rows[1:])]
    assert [len(s) for s in own] == [len(shingles(t, 3)) for _, t, *_ in rows]
    orders = prefixes(sets, (values[counts > 1], counts[counts > 1].astype(np.uint32)), 90)
    assert len(orders) == 3
    for i in range(len(own)):
        for j in range(i):
            if 100 * len(own[i] & own[j]) >= 90 * len(own[i] | own[j]):
                for tokens, ends in orders:
                    a, b = set(tokens[ends[i] : ends[i + 1]].tolist()), set(tokens[ends[j] : ends[j + 1]].tolist())
                    assert a & b


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
def test_linked_sets_share_enough_of_the_long_prefix(size, percent):
    texts = [t for _, t, *_ in corpus(7) + edge_rows()] + [" ".join(f"t{i * k % 60_013}" for i in range(1, 60_000)) for k in (1, 2, 3)]
    texts += [f"{texts[-1]} and one more", texts[-1][: len(texts[-1]) * 91 // 100]]  # so long that 16-bit tokens repeat
    sets = shingle_sets(texts_of(pa.record_batch([pa.array(texts)], names=["text"])), size)
    tokens, ends = jaccard.long_prefixes(sets, percent)
    own = [set(sets.hashes[a:b].tolist()) for a, b in zip(sets.rows[:-1], sets.rows[1:])]
    lists = [tokens[a:b] for a, b in zip(ends[:-1], ends[1:])]
    assert all(len(np.unique(x)) == len(x) for x in lists)
    passed = jaccard._sharing(lists, np.diff(sets.rows), percent)
    linked = np.array([[len(a & b) * 100 >= percent * len(a | b) and len(a) > 0 for b in own] for a in own])
    other = ~np.eye(len(own), dtype=bool)
    assert (linked & other).any() and passed[linked & other].all() and not passed[~linked & other].all()


def test_long_texts_that_share_little_are_not_compared(spark, monkeypatch):
    shared = [prose(5000 + i, 12) for i in range(30)]
    rows = [(i, " ".join(f"{part} {prose(100 * i + k, 24)}" for k, part in enumerate(shared)), None, None, None) for i in range(6)]
    rows += [(50, rows[0][1] + " end", None, None, None)]
    compared, verified = [], jaccard.verified

    def spy(docs, clusters, *more):
        compared.append(sorted(r.doc for r in clusters.collect()))
        return verified(docs, clusters, *more)

    monkeypatch.setattr(jaccard, "verified", spy)
    found = result(jaccard_components(frame(spark, rows), 3, 90))
    assert found == brute(rows, 3, 90) and compared == [[0, 50]]


@pytest.mark.parametrize("held", [1 << 20, 5])
def test_buckets_of_a_range_are_counted_in_its_width(monkeypatch, held):
    monkeypatch.setattr(jaccard, "COUNT_HELD", held)
    pick, cells = np.random.default_rng(held), 32
    many, wanted = (200, {3: 0, 7: 0, 9: 0}) if held > 5 else (6, {3: 0, 7: 0, 9: 0})

    def rows():
        for own in wanted:
            total = np.zeros(cells << 16, dtype=np.int64)
            for _ in range(many if own == 7 else 2):
                values = np.sort(pick.integers(0, cells << 16, 1 << (17 if own == 7 and held > 5 else 4)))
                total += np.bincount(values, minlength=cells << 16)
                counts = np.bincount(values >> 16, minlength=cells).astype("<u4")
                yield pa.record_batch([pa.array([own], pa.int32()), pa.array([counts.tobytes()]), pa.array([values.astype("<u2").tobytes()])], names=["range", "cells", "low"])
            wanted[own] = total

    tracemalloc.start()
    found = {own: (values.tolist(), counts.tolist()) for own, values, counts in jaccard.range_counts(rows(), cells) if own != 7 or held <= 5}
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 << 20  # the 26 million buckets of the largest range would take 105 MB, and as much again joined
    assert list(found) == ([3, 9] if held > 5 else [3, 7, 9])
    for own, (values, counts) in found.items():
        assert values == np.flatnonzero(wanted[own]).tolist() and counts == wanted[own][values].tolist()


def test_frequent_buckets_are_those_of_all_sets(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT_LEAST", 2)
    texts = [t for _, t, *_ in corpus(8) + edge_rows()]
    sets = shingle_sets(texts_of(pa.record_batch([pa.array(texts, pa.string())], names=["text"])), 3)
    values, counts = np.unique(jaccard.bucket(sets.hashes), return_counts=True)
    found = jaccard.frequent_buckets(frame(spark, corpus(8) + edge_rows()), 3)
    assert found[0].tolist() == values[counts > 1].tolist() and found[1].tolist() == counts[counts > 1].tolist()


def test_repeated_rows_make_no_groups_of_unrelated_sets(spark, monkeypatch):
    rows = [(i, prose(900 + i, 40), None, None, None) for i in range(40)]
    rows += [(90, rows[0][1] + " end", None, None, None)]
    groups, paired = [], jaccard._paired

    def spy(shared, parts, member):
        if "group" in shared.columns:
            groups.extend(tuple(r) for r in shared.groupBy("group", "members").count().collect())
        return paired(shared, parts, member)

    monkeypatch.setattr(jaccard, "_paired", spy)
    found = result(jaccard_components(frame(spark, rows + rows), 3, 90))
    assert found == brute(rows + rows, 3, 90)
    assert groups and all(members == count == 2 for _, members, count in groups)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 230)]
    found = {r.id: r.component for r in components(spark.createDataFrame(chain + star + star + [(5, 5)], "a long, b long")).collect()}
    assert found == {i: 100 for i in range(100, 141)} | {i: 7 for i in [7, *range(200, 230)]}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_against_its_sql(spark, agrees):
    agrees("op1_ngram_jaccard_join", op1_ngram_jaccard_join, ORACLES)


def test_stars_connect_what_edges_connect():
    pick = np.random.default_rng(5)
    for n, edges in ((5, 3), (300, 200), (300, 900), (2000, 1999)):
        a, b = pick.integers(0, n, edges), pick.integers(0, n, edges)
        if n == 2000:
            a, b = np.arange(1999), np.arange(1, 2000)  # a chain
        label = {i: i for i in {*a.tolist(), *b.tolist()}}
        moved = True
        while moved:
            moved = False
            for x, y in zip(a.tolist(), b.tolist()) if n != 2000 else ():
                least = min(label[x], label[y])
                moved |= label[x] != least or label[y] != least
                label[x] = label[y] = least
        want = {i: 0 for i in label} if n == 2000 else label
        roots, ids = stars(a, b)
        assert dict(zip(ids.tolist(), roots.tolist())) == {i: r for i, r in want.items() if i != r}
