import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lagloom.llm.batches import texts_of
from lagloom.llm.queries import op4_toxicity
from lagloom.llm.toxicity import THRESHOLD, expressions, fit, fit_curve, ratios, score
from tests.llm.fixtures import edge_rows, frame

BAD = ["idiot", "scum", "vergeltung", "vergeltlich", "vergelten"]
LABELS = "doc_id long, quality int, toxic int"


def corpus(count=700, seed=3):
    """Prose of two invented languages; toxic documents have a few words of BAD."""
    pick = random.Random(seed)
    rows, labels = [], []
    for i in range(count):
        stem = pick.choice(["an", "och"])
        words = [stem + pick.choice("bdfgklmnprst") + pick.choice("aeiou") + pick.choice(["", "n", "ro", "li"]) for _ in range(pick.randint(30, 300))]
        toxic = pick.random() < 0.2
        for _ in range(1 + len(words) // 50 if toxic else 0):
            words[pick.randrange(len(words))] = pick.choice(BAD) + pick.choice(["", ".", ","])
        rows.append((i, " ".join(words), pick.choice(["en", "de"]), None, None))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("toxicity")
    rows, labels = corpus()
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{folder}/labels.parquet")
    return str(folder), {i: toxic for i, _, toxic in labels}


def test_held_out_documents_are_told_apart(spark, tables):
    folder, toxic = tables
    found = op4_toxicity(spark, folder).collect()
    assert len(found) == len(toxic)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= THRESHOLD) for r in found)
    held = [(r.predicted, toxic[r.doc_id]) for r in found if r.held_out]
    assert held.count((1, 0)) <= 0.01 * len(held)
    assert held.count((1, 1)) >= 0.9 * sum(t for _, t in held)


def test_held_out_labels_have_no_influence(spark, tables, tmp_path):
    folder, toxic = tables
    flipped = [(i, 0, t if zlib.crc32(str(i).encode()) % 3 != 1 else 1 - t) for i, t in toxic.items()]
    spark.createDataFrame(flipped, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    spark.read.parquet(f"{folder}/documents.parquet").write.parquet(f"{tmp_path}/documents.parquet")
    scores = [{r.doc_id: r.score for r in op4_toxicity(spark, where).collect()} for where in (folder, str(tmp_path))]
    assert scores[0] == pytest.approx(scores[1])


def test_ratio_is_the_difference_of_two_models_worked_out_word_by_word(spark, tables):
    folder, _ = tables
    model = fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    texts = texts_of(pa.record_batch([pa.array(["anba idiot, anba vergeltu", "", "unheard-of words", None])], names=["text"]))
    found = expressions(texts)
    words, pairs = dict(zip(model.words.tolist(), model.word_ratios)), dict(zip(model.bigrams.tolist(), model.bigram_ratios))
    heads, prefixes = dict(zip(model.contexts.tolist(), model.context_ratios)), dict(zip(model.prefixes.tolist(), model.prefix_ratios))
    from lagloom.llm.toxicity import bigrams, contexts

    before = contexts(found.words, found.rows)
    each = []
    for i, word in enumerate(found.words.tolist()):
        pair = int(bigrams(before[i : i + 1], found.words[i : i + 1])[0])
        if pair in pairs:
            each.append(pairs[pair])
            continue
        own = words.get(word)
        for hashes, owner in found.prefixes:
            for value in hashes[owner == i].tolist():
                own = prefixes.get(value) if own is None else own
        each.append((model.unseen_ratio if own is None else own) + heads.get(int(before[i]), 0.0))
    want = [np.mean(each[a:b]) if b > a else model.unseen_ratio for a, b in zip(found.rows[:-1], found.rows[1:])]
    assert ratios(model, texts).tolist() == pytest.approx(want)
    assert want[0] > 1 and model.slope > 0


def test_words_lose_marks_and_case_at_their_ends():
    found = expressions(texts_of(pa.record_batch([pa.array(['"Idiot!" idiot -- | idiot.', "x"])], names=["text"])))
    assert len(set(found.words[:3].tolist())) == 1 and found.rows.tolist() == [0, 3, 4]


def test_phrases_of_ordinary_words_are_known_by_their_own_counts(spark):
    pick = random.Random(4)
    rows = []
    for i in range(300):
        words = [f"plain{pick.randrange(20)}" for _ in range(40)]
        words[7:7] = ["green", "door"] if i % 2 else ["door", "green"]
        rows.append((i, " ".join(words), None, None, None))
    model = fit(frame(spark, rows), spark.createDataFrame([(i, 1, i % 2) for i in range(300)], LABELS))
    texts = texts_of(pa.record_batch([pa.array(["plain1 green door plain2", "plain1 door green plain2"])], names=["text"]))
    toxic, ordinary = ratios(model, texts)
    assert not np.isin(expressions(texts).words, model.words).any()
    assert toxic > 0.2 and ordinary < -0.2
    assert score(frame(spark, rows), model).where("(score >= 0.5) <> (doc_id % 2 = 1)").count() == 0


def test_curve_meets_the_odds():
    random = np.random.default_rng(1)
    x = random.normal(size=4_000)
    y = (random.random(4_000) < 1 / (1 + np.exp(-(2 * x - 1)))).astype(float)
    slope, intercept = fit_curve(x, y)
    assert abs(slope - 2) < 0.25 and abs(intercept + 1) < 0.2


def test_edge_rows(spark, tables):
    folder, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    odd = spark.createDataFrame([(None, 1, 1), (3, 1, None), (4, 1, 7), (5, None, 0), (5, None, 0)], LABELS)
    model = fit(docs, labels.unionByName(odd))
    edge = frame(spark, edge_rows()).selectExpr("*", "'x' as score", "1 as kind")
    found = score(edge, model).collect()
    assert len(found) == len(edge_rows()) and all(0 <= r.score <= 1 and r.kind == 1 for r in found)
    empty = {r.score for r in found if not (r.text or "").strip()}
    assert len(empty) == 1 and empty.pop() < THRESHOLD
    assert score(edge.limit(0), model).count() == 0
    assert fit(docs, labels.limit(0)) is None and fit(docs, labels.where("toxic = 0")) is None
    assert {r.score for r in score(edge, None).collect()} == {0.0}
