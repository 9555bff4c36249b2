"""Masked pseudo-likelihood: a bidirectional window network predicts every word of a text from both sides.

The score of a text is the sum over its words of log P(word | REACH words before and after it), the word itself
masked. P(word | context) is P(class | context), a network's softmax over frequency classes, times P(word | class),
from counts over the whole corpus: the VOCABULARY most frequent words reach the tasks, the count of every other word is
joined by its hash. The network adds position-dependent projections of the neighbours' embeddings,
then tanh, then a linear layer.

Counts are aggregated in Spark over all documents. Training is parallel: in each round every task trains a copy of the
model on all documents it reads, and Spark averages the copies weighted by their numbers of predictions, slice by slice,
so that one model's size reaches the driver. The rounds share out the words by their places in the documents: every
word of every document is a target in one round, wherever pieces begin.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z as a-z; those outside the VOCABULARY most frequent ones are rare. Rare words
are one class, in which each has the probability of its own count (a word that was never counted that of one occurrence);
as neighbours they share HASHED embeddings by hash.
Defined results: null, empty and white texts have no words, a sum and a mean of 0; beyond the ends of a text stands a
boundary; repeated rows have equal scores; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagloom.llm.batches import pieces, texts_of, words_of
from lagloom.llm.staging import staged
from lagloom.session import work_path

VOCABULARY = 4096
HASHED_BITS = 12
HASHED = 1 << HASHED_BITS
CLASSES = 64
REACH = 2
WIDTH = 24
HIDDEN = 32
ROUNDS = 2
LEARNING_RATE = 0.1
BATCH = 512
#: High bits of a hash by which the known words are looked up.
SLOT_BITS = 16
#: Words scored at once: their logits, 4 bytes for each class, fit into a core's cache.
CHUNK = 1 << 12
SLICE = 1 << 14
#: Logarithms of counts are summed in whole numbers of 1 / LOG_UNIT.
LOG_UNIT = 1 << 32
#: Copies of a model averaged in one group.
COPIES = 64

#: Of 16 bits, which are sorted by radix.
NUMBER = np.min_scalar_type(VOCABULARY + HASHED - 1)

BOUNDARY, RARE = 0, 1


class Lexicon(NamedTuple):
    """Sorted hashes of the known words with their numbers, every number's class and log P(word | class).

    That of RARE is for a single occurrence; ``counts`` is the folder with the occurrences of all words.
    """

    hashes: np.ndarray
    numbers: np.ndarray
    classes: np.ndarray
    within: np.ndarray
    counts: str

    def lookup(self, words: np.ndarray) -> np.ndarray:
        """Numbers of the words as neighbours; rare words have theirs from VOCABULARY on."""
        hashed = VOCABULARY + (words >> np.uint64(64 - HASHED_BITS)).astype(np.int64)
        if not len(self.hashes):
            return hashed
        slots = np.arange((1 << SLOT_BITS) + 1, dtype=np.uint64)[:-1] << np.uint64(64 - SLOT_BITS)
        first = np.searchsorted(self.hashes, slots)  # of the known words with the same high bits; a few at most
        deepest = int(np.diff(first, append=len(self.hashes)).max())
        at = first[words >> np.uint64(64 - SLOT_BITS)]
        known = np.concatenate([self.hashes, np.zeros(deepest, dtype=np.uint64)])
        numbers = np.concatenate([self.numbers, np.zeros(deepest, dtype=np.int64)])
        for step in range(deepest):
            hits = np.flatnonzero((known[at + step] == words) & (at + step < len(self.hashes)))
            hashed[hits] = numbers[at[hits] + step]
        return hashed


def as_targets(numbers: np.ndarray) -> np.ndarray:
    """Numbers of the words as targets: RARE for all rare words."""
    return np.where(numbers < VOCABULARY, numbers, RARE)


COUNTS = "word long, n long"


def count_words(docs: DataFrame) -> DataFrame:
    """(word hash, n) over all documents, summed in each piece before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, size=1 << 24):
            hashes = [words_of(texts_of(part), lower=True).hashes for part in pieces([piece])]
            values, counts = np.unique(np.concatenate(hashes), return_counts=True)
            yield pa.record_batch([pa.array(values.view(np.int64)), pa.array(counts)], names=["word", "n"])

    return docs.select("text").mapInArrow(count, COUNTS).groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame) -> Lexicon:
    """The VOCABULARY most frequent words in classes of about equal weight; all others are a class of their own."""
    folder = work_path(docs.sparkSession, "likelihood-words")
    count_words(docs).write.parquet(folder)
    counts = docs.sparkSession.read.schema(COUNTS).parquet(folder)
    top = counts.orderBy(F.desc("n"), "word").limit(VOCABULARY - 2).toArrow()
    total = counts.agg(F.sum("n")).first()[0] or 0
    hashes, n = top.column("word").to_numpy().view(np.uint64), top.column("n").to_numpy().astype(float)
    rare = max(total - n.sum(), 1)
    weight = np.cumsum(n) - n / 2
    known = 1 + np.minimum((weight / max(n.sum(), 1) * (CLASSES - 1)).astype(np.int64), CLASSES - 2)
    classes = np.concatenate([[0, 0], known])
    mass = np.bincount(known, weights=n, minlength=CLASSES)
    within = np.concatenate([[0.0, -np.log(rare)], np.log(n) - np.log(mass[known])])
    order = np.argsort(hashes)
    return Lexicon(hashes[order], order + 2, classes, within.astype(np.float32), folder)


class Network(NamedTuple):
    """Embeddings, a projection for each neighbour position, hidden bias, output layer and its bias."""

    embed: np.ndarray
    project: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @staticmethod
    def shapes() -> list[tuple[int, ...]]:
        return [(VOCABULARY + HASHED, WIDTH), (2 * REACH, WIDTH, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,)]

    @classmethod
    def start(cls, seed: int = 7) -> Network:
        random = np.random.default_rng(seed)
        return cls(*(random.normal(0, 0.1, shape).astype(np.float32) * (len(shape) > 1) for shape in cls.shapes()))

    def flat(self) -> np.ndarray:
        return np.concatenate([part.ravel() for part in self])

    @classmethod
    def of(cls, values: np.ndarray) -> Network:
        parts, at = [], 0
        for shape in cls.shapes():
            size = int(np.prod(shape))
            parts.append(values[at : at + size].reshape(shape).astype(np.float32))
            at += size
        return cls(*parts)


def neighbours(numbers: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The numbers of the REACH words before and after each word, BOUNDARY beyond its row."""
    found = np.full((len(numbers), 2 * REACH), BOUNDARY, dtype=np.int64)
    begin, end = rows[:-1], rows[1:]
    for k, step in enumerate(range(-REACH, 0)):
        found[-step:, k] = numbers[:step]
        for first in range(-step):  # words with fewer before them in their row
            found[(begin + first)[begin + first < end], k] = BOUNDARY
    for k, step in enumerate(range(1, REACH + 1), REACH):
        found[:-step, k] = numbers[step:]
        for last in range(1, step + 1):
            found[(end - last)[end - last >= begin], k] = BOUNDARY
    return found


def targets(rows: np.ndarray, number: int, rounds: int) -> np.ndarray:
    """The words that are targets in a round: every ``rounds``-th of each row, from the ``number``-th on."""
    return np.flatnonzero((np.arange(rows[-1]) - np.repeat(rows[:-1], np.diff(rows))) % rounds == number)


def largest(logits: np.ndarray) -> np.ndarray:
    """The largest value of each row; over short rows reduceat is faster than max."""
    return np.maximum.reduceat(logits.ravel(), np.arange(0, logits.size, logits.shape[1]))


def train_batch(net: Network, context: np.ndarray, target: np.ndarray, rate: float) -> None:
    """One gradient step on the mean negative log-likelihood of the targets' classes, in place."""
    inputs = net.embed.take(context.ravel(), axis=0).reshape(len(target), -1)  # batch, position and width
    project = net.project.reshape(-1, HIDDEN)
    hidden = inputs @ project
    hidden += net.bias
    np.tanh(hidden, out=hidden)
    delta = hidden @ net.out
    delta += net.out_bias
    delta -= largest(delta)[:, None]
    np.exp(delta, out=delta)
    delta /= delta.sum(axis=1, keepdims=True)
    delta.reshape(-1)[np.arange(0, delta.size, CLASSES) + target] -= 1
    delta *= rate / len(target)
    back = (delta @ net.out.T) * (1 - hidden * hidden)
    inner = back @ project.T
    net.out[...] -= hidden.T @ delta
    net.out_bias[...] -= delta.sum(axis=0)
    net.project[...] -= (inputs.T @ back).reshape(net.project.shape)
    net.bias[...] -= back.sum(axis=0)
    subtract_sums(net.embed, context.ravel(), inner.reshape(-1, WIDTH))


def subtract_sums(table: np.ndarray, numbers: np.ndarray, rows: np.ndarray) -> None:
    """Subtracts each row from the table's row of its number, summed per number first: much faster than np.subtract.at.

    Nearly all numbers have two rows (a word between two targets is a neighbour of both), which are added at once.
    """
    flat = numbers.astype(NUMBER)
    order = np.argsort(flat, kind="stable")
    flat = flat.take(order)
    bounds = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1], [True]]))
    begins, sizes = bounds[:-1], np.diff(bounds)
    two = sizes == 2
    first = begins[two]
    table[flat.take(first)] -= rows.take(order.take(first), axis=0) + rows.take(order.take(first + 1), axis=0)
    if len(rest := np.flatnonzero(~two)):
        sums = np.add.reduceat(rows.take(order[np.repeat(~two, sizes)], axis=0), np.cumsum(sizes[rest]) - sizes[rest])
        table[flat.take(begins[rest])] -= sums


AVERAGED = ["slice", "part", "weights", "seen"]
COPY = "slice int, part int, weights binary, seen double"


def average(group: pa.Table) -> pa.Table:
    """One slice of several copies of a model as their mean, weighted by their numbers of predictions."""
    seen = group.column("seen").to_numpy()
    mean = sum(np.frombuffer(w.as_py(), np.float32) * s for w, s in zip(group.column("weights"), seen)) / seen.sum()
    row = group.slice(0, 1).combine_chunks()
    columns = [row.column(0), row.column(1), pa.array([mean.astype(np.float32).tobytes()]), pa.array([seen.sum()])]
    return pa.table(columns, names=AVERAGED)


def train(docs: DataFrame, lexicon: Lexicon, rounds: int = ROUNDS) -> Network:
    spark = docs.sparkSession
    net = Network.start()
    words = spark.sparkContext.broadcast(lexicon)
    for number in range(rounds):
        shared = spark.sparkContext.broadcast(net.flat())

        def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, seen = Network.of(shared.value.copy()), 0
            for piece in pieces(batches):
                found = words_of(texts_of(piece), lower=True)
                numbers = words.value.lookup(found.hashes)
                context = neighbours(numbers, found.rows)
                chosen = targets(found.rows, number, rounds)
                context, kinds = context.take(chosen, axis=0), words.value.classes[as_targets(numbers[chosen])]
                for first in range(0, len(chosen), BATCH):
                    rate = LEARNING_RATE * BATCH ** 0.5 / (1 + number)
                    train_batch(own, context[first : first + BATCH], kinds[first : first + BATCH], rate)
                seen += len(chosen)
            if seen:
                values = own.flat()
                slices = [values[a : a + SLICE].tobytes() for a in range(0, len(values), SLICE)]
                group = [TaskContext.get().partitionId() // COPIES] * len(slices)
                columns = [range(len(slices)), group, slices, [float(seen)] * len(slices)]
                kinds = (pa.int32(), pa.int32(), pa.binary(), pa.float64())
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=AVERAGED)

        copies = docs.select("text").mapInArrow(fit, COPY)  # averaged in groups first, then the groups
        means = copies.groupBy("slice", "part").applyInArrow(average, COPY).groupBy("slice").applyInArrow(average, COPY)
        slices = means.orderBy("slice").collect()
        if not slices:
            break
        net = Network.of(np.frombuffer(b"".join(row.weights for row in slices), np.float32))
    return net


class Scorer:
    """Log-probabilities of words, of rare ones as if they occurred once; the projections of all words at all positions are
    worked out once."""

    def __init__(self, net: Network, lexicon: Lexicon) -> None:
        self.net, self.lexicon = net, lexicon
        self.tables = np.ascontiguousarray(np.einsum("vw,pwh->pvh", net.embed, net.project, optimize=True))

    def words(self, numbers: np.ndarray, rows: np.ndarray) -> np.ndarray:
        found = np.zeros(len(numbers), dtype=np.float64)
        context = neighbours(numbers, rows)
        for first in range(0, len(numbers), CHUNK):
            some = context[first : first + CHUNK]
            target = as_targets(numbers[first : first + CHUNK])
            hidden = self.tables[0].take(some[:, 0], axis=0)
            for p in range(1, 2 * REACH):
                hidden += self.tables[p].take(some[:, p], axis=0)
            hidden += self.net.bias
            logits = np.tanh(hidden, out=hidden) @ self.net.out
            logits += self.net.out_bias
            own = logits[np.arange(len(target)), self.lexicon.classes[target]]
            top = logits.max(axis=1)
            logits -= top[:, None]
            total = top + np.log(np.exp(logits, out=logits).sum(axis=1))
            found[first : first + CHUNK] = own - total + self.lexicon.within[target]
        return found


def score(docs: DataFrame, net: Network, lexicon: Lexicon) -> DataFrame:
    """doc_id, n_words, the summed log-probability and its mean per word.

    Tasks score all words with what the lexicon holds; the logarithms of the rare words' counts are joined and added.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((net, lexicon))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for piece in pieces(batches):
            words = words_of(texts_of(piece), lower=True)
            numbers = scorer.lexicon.lookup(words.hashes)
            each = np.concatenate([[0.0], np.cumsum(scorer.words(numbers, words.rows))])
            at = np.flatnonzero(numbers >= VOCABULARY)
            rare = pa.ListArray.from_arrays(np.searchsorted(at, words.rows).astype(np.int32), words.hashes[at].view(np.int64))
            columns = [piece.column(0), pa.array(np.diff(words.rows)), pa.array(each[words.rows[1:]] - each[words.rows[:-1]]), rare]
            yield pa.record_batch(columns, names=["doc_id", "n_words", "sum", "rare"])

    scored = docs.select("doc_id", "text").mapInArrow(rate, f"doc_id {id_type}, n_words long, sum double, rare array<long>")
    scored = staged(scored.withColumn("row", F.monotonically_increasing_id()), "likelihood-scores")
    # the logarithm of 1 is 0, also for words never counted; whole numbers, so that their order is of no influence
    counts = spark.read.schema(COUNTS).parquet(lexicon.counts).where("n > 1")
    counts = counts.select("word", F.round(F.log("n") * LOG_UNIT).cast("long").alias("log"))
    own = scored.select("row", F.explode("rare").alias("word")).join(counts, "word").groupBy("row").agg(F.sum("log").alias("log"))
    total = F.col("sum") + F.coalesce("log", F.lit(0)) / LOG_UNIT
    return scored.drop("rare").join(own, "row", "left").select(
        "doc_id", "n_words", total.alias("log_likelihood"), (total / F.greatest("n_words", F.lit(1))).alias("mean_log_likelihood")
    )


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    """Counts, trains and scores over all documents."""
    lexicon = build_lexicon(docs)
    return score(docs, train(docs, lexicon), lexicon)
