"""Toxicity: class-conditional Kneser-Ney word bigram models, compared by length-normalised log-likelihood.

Two models are counted from labelled documents, one from toxic and one from ordinary ones. A bigram probability is
interpolated with absolute discounting: bigram counts of the class, then the class's continuation counts of the word
(in how many contexts it occurs), then continuation counts of both classes together. An expression (word or bigram) has
counts of its own only if it is in ``MIN_COUNT`` documents or more and its document frequencies in the two classes differ
by ``MIN_Z`` standard errors or more; a rare or indifferent one is scored by the shared backoff counts alone, so that the
classes' sizes, topics and languages don't pass for evidence. A bigram is judged by its own counts, whatever its words
tell alone.

A word without counts of its own backs off to its beginning: the longest of its prefixes (PREFIXES bytes) that has counts,
with the words of the prefix in the proportions that both classes share; only then to the shared counts of all words.

The score is a logistic curve over the mean log-likelihood ratio per word; its two parameters are fitted on labelled
rows that the counts have not seen. Counting takes at most ``CLASS_ROWS`` labelled documents of a class, the first by
a hash of the id (a documented bound of the training sample, which bounds the model); every document is scored.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z as a-z, without punctuation ASCII has at their ends. Defined results: null and
empty texts score as a single word that tells nothing; without labelled rows of both classes every score is 0; labels with a null class or id
count for nothing; of repeated labels of a document the larger holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagloom.llm.batches import GOLDEN, buffers, hash_spans, mix64, pieces, texts_of, word_bounds
from lagloom.llm.staging import staged

CLASS_ROWS = 5_000
MIN_COUNT = 10
MIN_Z = 7.0
DISCOUNT = 0.75
#: Lengths in bytes, the longest first.
PREFIXES = (9, 8, 7, 6, 5, 4)
THRESHOLD = 0.7
#: One labelled row in so many fits the curve instead of the counts.
CURVE_SHARE = 4

_EDGE = np.zeros(256, dtype=bool)
_EDGE[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Expressions(NamedTuple):
    """Hashes of the words of all rows, where those of each row begin, and per length the hashes of the words' prefixes
    with the words they belong to."""

    words: np.ndarray
    rows: np.ndarray
    prefixes: list[tuple[np.ndarray, np.ndarray]]


def expressions(texts: pa.Array) -> Expressions:
    """Words of punctuation alone are left out; only words longer than a prefix have it."""
    data, offsets = buffers(texts)
    data = _LOWER[data]
    starts, ends = word_bounds(data, offsets)
    for _ in range(2):  # up to two marks at either end
        starts = starts + (_EDGE[data[starts]] & (ends - starts > 1))
        ends = ends - (_EDGE[data[ends - 1]] & (ends - starts > 1))
    plain = ~_EDGE[data[starts]] if len(starts) else np.zeros(0, dtype=bool)
    starts, ends = starts[plain], ends[plain]
    prefixes = []
    for length in PREFIXES:
        owner = np.flatnonzero(ends - starts > length)
        prefixes.append((hash_spans(data, starts[owner], starts[owner] + length), owner))
    return Expressions(hash_spans(data, starts, ends), np.searchsorted(starts, offsets).astype(np.int64), prefixes)


def contexts(words: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The word before each; 0 at the beginning of a row."""
    before = np.zeros_like(words)
    before[1:] = words[:-1]
    before[rows[:-1][rows[:-1] < rows[1:]]] = 0
    return before


def bigrams(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix64(before * GOLDEN + words)


def _first_in_row(row: np.ndarray, values: np.ndarray) -> np.ndarray:
    """1 where a value occurs for the first time in its row."""
    order = np.lexsort((np.arange(len(row)), values, row))
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[order][1:] != row[order][:-1]) | (values[order][1:] != values[order][:-1])
    first = np.zeros(len(row), dtype=np.int32)
    first[order[new]] = 1
    return first


class Model(NamedTuple):
    """Sorted hashes with the log-likelihood ratios (toxic over ordinary) a scorer needs, and the curve."""

    bigrams: np.ndarray
    bigram_ratios: np.ndarray
    words: np.ndarray
    word_ratios: np.ndarray
    contexts: np.ndarray
    context_ratios: np.ndarray
    unseen_ratio: float
    prefixes: np.ndarray
    prefix_ratios: np.ndarray
    slope: float = 0.0
    intercept: float = 0.0


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.full(len(wanted), default, dtype=float), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    found = keys[at] == wanted
    return np.where(found, values[at], default), found


def telling(in_toxic: np.ndarray, in_ordinary: np.ndarray, toxic: float, ordinary: float) -> np.ndarray:
    """Expressions in enough documents whose shares of the two classes' documents differ beyond chance."""
    both = in_toxic + in_ordinary
    share = np.clip(both / (toxic + ordinary), 1e-12, 1 - 1e-12)
    error = np.sqrt(share * (1 - share) * (1 / toxic + 1 / ordinary))
    return (both >= MIN_COUNT) & (np.abs(in_toxic / toxic - in_ordinary / ordinary) >= MIN_Z * error)


def fit_tables(words: dict, pairs: dict, heads: dict, prefixes: dict, totals: dict, documents: tuple[int, int]) -> Model:
    """The model from the counts of expressions in MIN_COUNT documents or more; columns ending in 0 and 1 are classes.

    ``words``: contexts together (types) and by class, documents; ``pairs``: occurrences and documents of bigrams;
    ``heads``: occurrences of contexts; ``totals``: distinct bigrams (types) together and by class, words by class.
    """
    known = telling(words["docs1"], words["docs0"], documents[1], documents[0])
    order = np.argsort(words["word"])
    vocabulary, known, shared = words["word"][order], known[order], words["types"][order] / totals["types"]
    used = telling(pairs["docs1"], pairs["docs0"], documents[1], documents[0])
    pairs = {name: column[used] for name, column in pairs.items()}
    at = np.searchsorted(vocabulary, pairs["word"])  # the words of a bigram are in no fewer documents, so all are there
    heads_kept, ctx = np.unique(pairs["before"], return_inverse=True)
    place = np.argsort(heads["before"])
    place = place[np.searchsorted(heads["before"][place], heads_kept)] if len(heads_kept) else place[:0]
    word_log, gamma_log, pair_log, spare_log = [], [], [], []
    for c in "01":
        held = np.where(known, np.maximum(words["types" + c][order] - DISCOUNT, 0) / max(totals["types" + c], 1), 0)
        spare = 1 - held.sum()  # discounts and words without counts of their own go to the shared counts
        p_word = held + spare * shared
        occurrences = np.maximum(heads["n" + c][place], 1)
        held = np.maximum(pairs["n" + c] - DISCOUNT, 0) / occurrences[ctx]
        gamma = np.maximum(1 - np.bincount(ctx, weights=held, minlength=len(heads_kept)), 1e-6)
        word_log.append(np.log(p_word))
        spare_log.append(np.log(spare))
        gamma_log.append(np.log(gamma))
        pair_log.append(np.log(held + gamma[ctx] * p_word[at]))
    keys = bigrams(pairs["before"], pairs["word"])
    sort = np.argsort(keys)
    kept = telling(prefixes["docs1"], prefixes["docs0"], documents[1], documents[0])
    prefixes = {name: column[kept] for name, column in prefixes.items()}
    shared = (prefixes["n0"] + prefixes["n1"]) / max(totals["n0"] + totals["n1"], 1)
    p = [np.log((np.maximum(prefixes["n" + c] - DISCOUNT, 0) + DISCOUNT * shared) / max(totals["n" + c], 1)) for c in "01"]
    by_hash = np.argsort(prefixes["word"])
    return Model(
        keys[sort], (pair_log[1] - pair_log[0])[sort],
        vocabulary[known], (word_log[1] - word_log[0])[known],
        heads_kept, gamma_log[1] - gamma_log[0],
        float(spare_log[1] - spare_log[0]),
        prefixes["word"][by_hash], (p[1] - p[0])[by_hash],
    )


def ratios(model: Model, texts: pa.Array) -> np.ndarray:
    """Mean log-likelihood ratio per word of every row; without words that of a word that tells nothing."""
    words, rows, prefixes = expressions(texts)
    before = contexts(words, rows)
    direct, known = _look_up(model.bigrams, model.bigram_ratios, bigrams(before, words), 0.0)
    by_word, own = _look_up(model.words, model.word_ratios, words, model.unseen_ratio)
    for hashes, owner in prefixes:
        ratio, found = _look_up(model.prefixes, model.prefix_ratios, hashes, 0.0)
        found &= ~own[owner]
        by_word[owner[found]], own[owner[found]] = ratio[found], True
    by_context = _look_up(model.contexts, model.context_ratios, before, 0.0)[0]
    each = np.concatenate([[0.0], np.cumsum(np.where(known, direct, by_word + by_context))])
    counts = np.diff(rows)
    return np.where(counts > 0, (each[rows[1:]] - each[rows[:-1]]) / np.maximum(counts, 1), model.unseen_ratio)


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic regression on one feature, by Newton steps with a weak prior."""
    scale = x.std() or 1.0
    features = np.column_stack([x / scale, np.ones(len(x))])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ beta, -30, 30)))
        gradient = features.T @ (p - y) + 1e-2 * beta
        hessian = (features * (p * (1 - p))[:, None]).T @ features + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, class_rows: int = CLASS_ROWS) -> Model | None:
    """The fitted model from the labelled documents (doc_id, text) and labels (doc_id, toxic); None without both classes."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(CURVE_SHARE)) == 0
    ranked = known.withColumn("fold", fold.cast("int"))
    picked = None
    for kind in (0, 1):
        for side, most in ((0, class_rows), (1, class_rows // 2)):
            part = ranked.where((F.col("toxic") == kind) & (F.col("fold") == side))
            part = part.orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(most)
            picked = part if picked is None else picked.unionByName(part)
    picked = picked.toPandas()  # at most 3 * class_rows ids
    counted = picked[picked.fold == 0]
    if counted.toxic.nunique() < 2:
        return None
    spark = docs.sparkSession
    classes = spark.sparkContext.broadcast(dict(zip(picked.doc_id.tolist(), (picked.toxic + 2 * picked.fold).tolist())))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = classes.value
        for batch in batches:
            kind = np.array([own.get(d, -1) for d in batch.column(0).to_pylist()], dtype=np.int32)
            some = batch.filter(pa.array(kind >= 0))
            if some.num_rows:
                yield some.append_column("kind", pa.array(kind[kind >= 0]))

    id_type = docs.schema["doc_id"].dataType.simpleString()
    sample = docs.select("doc_id", "text").mapInArrow(chosen, f"doc_id {id_type}, text string, kind int").persist()

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            words, rows, _ = expressions(texts_of(piece))
            kind = np.repeat(np.asarray(piece.column(2)), np.diff(rows))
            before, row = contexts(words, rows), np.repeat(np.arange(piece.num_rows), np.diff(rows))
            firsts = [_first_in_row(row, bigrams(before, words)), _first_in_row(row, words)]
            columns = (kind, before.view(np.int64), words.view(np.int64), *firsts)
            yield pa.record_batch([pa.array(c) for c in columns], names=["kind", "before", "word", "new_pair", "new_word"])

    def beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            _, rows, prefixes = expressions(texts_of(piece))
            row = np.repeat(np.arange(piece.num_rows), np.diff(rows))
            for hashes, owner in prefixes:
                columns = (np.asarray(piece.column(2))[row[owner]], hashes.view(np.int64), _first_in_row(row[owner], hashes))
                yield pa.record_batch([pa.array(c) for c in columns], names=["kind", "word", "new_word"])

    def by_class(name: str, column: str) -> list:
        return [F.sum(F.when(F.col("kind") == c, F.col(column)).otherwise(0)).alias(f"{name}{c}") for c in (0, 1)]

    known_rows = sample.where("kind < 2").withColumn("one", F.lit(1))
    seen = known_rows.mapInArrow(pairs, "kind int, before long, word long, new_pair int, new_word int")
    each = [*by_class("n", "one"), *by_class("docs", "new_pair"), *by_class("words", "new_word")]
    seen = staged(seen.withColumn("one", F.lit(1)).groupBy("before", "word").agg(*each), "toxicity-bigrams")
    types = [F.count("*").alias("types"), *(F.sum((F.col(f"n{c}") > 0).cast("int")).alias(f"types{c}") for c in (0, 1))]
    of_class = [F.sum(f"n{c}").alias(f"n{c}") for c in (0, 1)]
    words = seen.groupBy("word").agg(*types, *(F.sum(f"words{c}").alias(f"docs{c}") for c in (0, 1)))
    starts = known_rows.mapInArrow(beginnings, "kind int, word long, new_word int").withColumn("one", F.lit(1))
    starts = starts.groupBy("word").agg(*by_class("n", "one"), *by_class("docs", "new_word"))
    enough = F.col("docs0") + F.col("docs1") >= MIN_COUNT
    model = fit_tables(
        _arrays(words.where(enough)),
        _arrays(seen.where(enough).select("before", "word", "n0", "n1", "docs0", "docs1")),
        _arrays(seen.groupBy("before").agg(*of_class).where(F.col("n0") + F.col("n1") >= MIN_COUNT)),
        _arrays(starts.where(enough)),
        {name: column[0] or 0 for name, column in seen.agg(*types, *of_class).toPandas().items()},
        ((counted.toxic == 0).sum(), (counted.toxic == 1).sum()),
    )
    shared = spark.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            yield pa.record_batch([piece.column(2), pa.array(ratios(shared.value, texts_of(piece)))], names=["kind", "ratio"])

    curve = sample.where("kind >= 2").mapInArrow(measure, "kind int, ratio double").toPandas()
    sample.unpersist()
    if curve.kind.nunique() < 2:
        return model
    slope, intercept = fit_curve(curve.ratio.to_numpy(), curve.kind.to_numpy() - 2)
    return model._replace(slope=slope, intercept=intercept)


def _arrays(counts: DataFrame) -> dict[str, np.ndarray]:
    """Columns of counts of the bounded sample; hashes unsigned."""
    rows = counts.toArrow()
    columns = {c: rows.column(c).to_numpy() for c in rows.column_names}
    return {name: column.view(np.uint64) if name in ("before", "word") else column for name, column in columns.items()}


def score(docs: DataFrame, model: Model | None, name: str = "score") -> DataFrame:
    """All rows and columns with a column ``name`` from 0 to 1, computed from the text alone; one of that name is replaced."""
    docs = docs.drop(name)
    if model is None:
        return docs.withColumn(name, F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = []
            for piece in pieces([batch]):
                x = shared.value.slope * ratios(shared.value, texts_of(piece)) + shared.value.intercept
                values.append(1 / (1 + np.exp(-np.clip(x, -500, 500))))
            if values:
                yield pa.record_batch([*batch.columns, pa.array(np.concatenate(values))], names=[*names, name])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(rate, f"{fields}, `{name}` double")
