import random

import numpy as np
import pyarrow as pa
import pytest

from lagloom.llm.batches import words_of
from lagloom.llm.pseudo_likelihood import (
    BOUNDARY,
    CHUNK,
    CLASSES,
    HASHED,
    NUMBER,
    RARE,
    REACH,
    ROUNDS,
    VOCABULARY,
    Lexicon,
    Network,
    Scorer,
    average,
    build_lexicon,
    neighbours,
    pseudo_likelihood,
    score,
    subtract_sums,
    targets,
    train,
    train_batch,
)
from tests.llm.fixtures import edge_rows, frame


def corpus(count=400, seed=2):
    """Sentences in which a word follows from its neighbours: a, then one of its four partners, then b."""
    pick = random.Random(seed)
    rows = []
    for i in range(count):
        words = []
        for _ in range(40):
            group = pick.randrange(12)
            words += [f"left{group}", f"mid{group}x{pick.randrange(4)}", f"right{group}"]
        rows.append((i, " ".join(words), None, None, None))
    return rows


def test_context_is_what_stands_around_in_the_same_row():
    found = neighbours(np.array([5, 6, 7, 8]), np.array([0, 3, 3, 4]))
    assert found.tolist() == [[0, 0, 6, 7], [0, 5, 7, 0], [5, 6, 0, 0], [0, 0, 0, 0]]
    assert BOUNDARY == 0 and REACH == 2


def test_neighbours_are_those_of_each_row_by_itself():
    pick = np.random.default_rng(4)
    counts = [0, 1, 0, 2, 3, 4, 0, 0, 9, 1, 1, 5, 0]
    rows = np.concatenate([[0], np.cumsum(counts)])
    numbers = pick.integers(2, 99, rows[-1])
    want = []
    for a, b in zip(rows[:-1], rows[1:]):
        padded = [BOUNDARY] * REACH + numbers[a:b].tolist() + [BOUNDARY] * REACH
        want += [padded[i : i + REACH] + padded[i + REACH + 1 : i + 2 * REACH + 1] for i in range(b - a)]
    assert neighbours(numbers, rows).tolist() == want
    assert neighbours(numbers[:0], np.array([0, 0])).shape == (0, 2 * REACH)
    assert neighbours(numbers[:1], np.array([0, 1])).tolist() == [[BOUNDARY] * 2 * REACH]


def test_known_words_are_found_and_others_hashed():
    pick = np.random.default_rng(6)
    near = np.uint64(7 << 48) + np.arange(40, dtype=np.uint64)  # with the same high bits
    known = np.unique(np.concatenate([near, pick.integers(0, 1 << 64, 900, dtype=np.uint64), np.array([0, (1 << 64) - 1], dtype=np.uint64)]))
    lexicon = Lexicon(known, np.arange(len(known)) + 2, np.zeros(1), np.zeros(1), "")
    others = np.concatenate([near + np.uint64(40), known[5:9] + np.uint64(1), pick.integers(0, 1 << 64, 500, dtype=np.uint64)])
    number = {int(h): i + 2 for i, h in enumerate(known)}
    for words in (np.concatenate([known, others]), others[:0], known[:1], known[-1:]):
        assert lexicon.lookup(words).tolist() == [number.get(w, VOCABULARY + (w >> 52)) for w in words.tolist()]
    few = Lexicon(known[1:-1], np.arange(len(known) - 2) + 2, np.zeros(1), np.zeros(1), "")
    assert few.lookup(known[[0, -1]]).tolist() == [VOCABULARY, VOCABULARY + HASHED - 1]


def test_tables_are_gathered_from_without_a_copy():
    scorer = Scorer(Network.start(), Lexicon(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(2, dtype=np.int64), np.zeros(2), ""))
    assert all(table.flags.c_contiguous for table in scorer.tables)


def test_what_is_scored_and_sorted_at_once_stays_small():
    assert CHUNK * CLASSES * 4 <= 1 << 20  # the logits of a chunk, in a core's cache
    assert np.dtype(NUMBER).itemsize == 2 and np.iinfo(NUMBER).max >= VOCABULARY + HASHED - 1  # sorted by radix


def test_every_word_is_a_target_once():
    rows = np.array([0, 1, 1, 6, 8, 21])
    for rounds in (1, ROUNDS, 6):
        chosen = [targets(rows, number, rounds) for number in range(rounds)]
        assert sorted(np.concatenate(chosen).tolist()) == list(range(21))
        behind = [targets(rows[2:] - 1, number, rounds) for number in range(rounds)]  # pieces that begin elsewhere
        assert all((found[found >= 1] - 1).tolist() == other.tolist() for found, other in zip(chosen, behind))


def test_every_word_of_a_short_text_teaches(spark):
    docs = frame(spark, [(1, "alpha beta gamma", None, None, None)])
    lexicon = build_lexicon(docs)
    assert len(set(lexicon.classes[2:].tolist())) == 3
    bias = train(docs, lexicon).out_bias
    assert (bias[lexicon.classes[2:]] > 0).all() and (np.delete(bias, lexicon.classes[2:]) < 0).all()


def test_gradient_is_the_slope_of_the_loss():
    random_ = np.random.default_rng(3)
    context, target = random_.integers(0, 30, (6, 2 * REACH)), random_.integers(0, CLASSES, 6)
    start = Network.of(Network.start().flat().astype(np.float64) * 5)

    def loss(net):
        hidden = np.tanh(np.einsum("bpw,pwh->bh", net.embed[context].astype(float), net.project) + net.bias)
        logits = hidden @ net.out + net.out_bias
        return float(np.mean(np.log(np.exp(logits).sum(axis=1)) - logits[np.arange(6), target]))

    moved = Network.of(start.flat().copy())
    train_batch(moved, context, target, 1e-3)
    step = start.flat().astype(np.float64) - moved.flat()  # the gradient times the rate
    assert loss(start) - loss(moved) == pytest.approx(float(step @ step) / 1e-3, rel=0.02)


def test_rows_are_subtracted_by_number_as_summed_one_by_one():
    pick = np.random.default_rng(8)
    mixed = pick.permutation(np.repeat(np.arange(40), [1, 2, 2, 2, 2, 2, 2, 3, 4, 20] * 4))
    for number in (mixed, mixed[:1], np.arange(9), np.repeat(np.arange(9), 2)):  # also without pairs, and with pairs only
        rows = pick.normal(size=(len(number), 3)).astype(np.float32)
        order = np.argsort(number, kind="stable")
        begins = np.flatnonzero(np.diff(number[order], prepend=-1))
        want = np.ones((40, 3), np.float32)
        want[number[order][begins]] -= np.add.reduceat(rows[order], begins)
        found = np.ones((40, 3), np.float32)
        subtract_sums(found, number, rows)
        assert found.tolist() == want.tolist()


def test_scores_are_summed_conditional_probabilities(spark):
    docs = frame(spark, corpus(60))
    lexicon = build_lexicon(docs)
    net = train(docs, lexicon, 1)
    scorer = Scorer(net, lexicon)
    numbers = np.array([2, 3, RARE, 4, 2])
    rows = np.array([0, 4, 5])
    found = scorer.words(numbers, rows)
    for i, context in enumerate(neighbours(numbers, rows)):
        hidden = np.tanh(sum(net.embed[c] @ net.project[p] for p, c in enumerate(context)) + net.bias)
        logits = hidden @ net.out + net.out_bias
        want = logits[lexicon.classes[numbers[i]]] - np.log(np.exp(logits).sum()) + lexicon.within[numbers[i]]
        assert found[i] == pytest.approx(want, abs=1e-4)
    sizes = np.bincount(lexicon.classes[2 : 2 + len(lexicon.hashes)], minlength=CLASSES)
    for kind in np.flatnonzero(sizes):  # words of a class share its probability
        members = np.flatnonzero(lexicon.classes[: 2 + len(lexicon.hashes)] == kind)
        assert np.exp(lexicon.within[members]).sum() == pytest.approx(1, abs=1e-4)
    assert VOCABULARY > len(lexicon.hashes)


def test_both_sides_tell_text_from_shuffled_text(spark):
    rows = corpus()
    pick = random.Random(9)
    held = []
    for i, text, *_ in corpus(40, seed=77):
        words = text.split()
        held.append((10_000 + i, text, None, None, None))
        pick.shuffle(words)
        held.append((20_000 + i, " ".join(words), None, None, None))
    docs = frame(spark, rows).repartition(4)
    lexicon = build_lexicon(docs)
    trained = {r.doc_id: r.mean_log_likelihood for r in score(frame(spark, held), train(docs, lexicon, 6), lexicon).collect()}
    untrained = {r.doc_id: r.mean_log_likelihood for r in score(frame(spark, held), Network.start(), lexicon).collect()}
    real = np.array([trained[10_000 + i] for i in range(40)])
    mixed = np.array([trained[20_000 + i] for i in range(40)])
    assert (real > mixed).mean() > 0.95
    assert real.mean() > np.mean([untrained[10_000 + i] for i in range(40)]) + 0.2


def test_rare_words_have_their_own_counts_and_contexts(spark):
    common = [f"c{i}" for i in range(VOCABULARY - 2)]
    texts = [" ".join(common)] * 4 + ["seldom twice seldom twice seldom single"]
    docs = frame(spark, [(i, text, None, None, None) for i, text in enumerate(texts)])
    lexicon = build_lexicon(docs)
    held = ["seldom", "twice", "single", "unheard", "seldom c1", "single c1", "single seldom"]
    net = Network.start()
    found = score(frame(spark, [(i, text, None, None, None) for i, text in enumerate(held)]), net, lexicon).collect()
    logs = [r.log_likelihood for r in sorted(found)]
    assert logs[0] - logs[2] == pytest.approx(np.log(3), abs=1e-6) and logs[1] - logs[2] == pytest.approx(np.log(2), abs=1e-6)
    assert logs[2] == logs[3]
    before = {i: neighbours(lexicon.lookup(words_of(pa.array([held[i]], pa.large_string())).hashes), np.array([0, 2]))[1] for i in (4, 5)}
    assert before[4].tolist() != before[5].tolist()
    assert abs(logs[4] - logs[5] - np.log(3)) > 1e-7
    assert np.exp(lexicon.within[RARE]) * (3 + 2 + 1) == pytest.approx(1)


def test_average_is_weighted():
    import pyarrow as pa

    blobs = [np.array([1, 2], np.float32).tobytes(), np.array([4, 8], np.float32).tobytes()]
    table = pa.table([pa.array([0, 0], pa.int32()), pa.array([0, 1], pa.int32()), pa.array(blobs), pa.array([1.0, 2.0])], names=["slice", "part", "weights", "seen"])
    found = average(table)
    assert np.frombuffer(found.column("weights")[0].as_py(), np.float32).tolist() == [3, 6]
    assert found.column("seen")[0].as_py() == 3.0


def test_edge_rows(spark):
    found = pseudo_likelihood(frame(spark, edge_rows()).selectExpr("*", "1 as n_words")).collect()
    assert len(found) == len(edge_rows())
    by_id = {r.doc_id: r for r in found}
    for i in (0, 1, 2):
        assert (by_id[i].n_words, by_id[i].log_likelihood, by_id[i].mean_log_likelihood) == (0, 0.0, 0.0)
    assert by_id[9].log_likelihood == pytest.approx(by_id[10].log_likelihood) and by_id[9].n_words == 9_000
    assert all(r.log_likelihood <= 0 for r in found)
    assert pseudo_likelihood(frame(spark, [])).count() == 0
