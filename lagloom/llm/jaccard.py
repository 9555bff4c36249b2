"""N-gram Jaccard join: links between documents whose shingle sets overlap enough, filtered by several global orders.

Two sets of sizes m <= n with a Jaccard similarity of s / 100 or more share a token among the first
n - ceil(s * n / 100) + 1 tokens of each, whatever global order the tokens are sorted in. Candidates come from the
first order, in which tokens that are frequent in the corpus come last and others follow a hash. Before sets are
compared they must also share enough of a longer prefix in an order by another hash: of p and q tokens of sets of sizes m
and n that have t tokens in common, p - (m - t) or q - (n - t) are shared, whichever is less. One shared token tells little
about long texts, a third of the prefix does.

Steps: (1) count hashed tokens over all documents and keep the most frequent buckets, a bounded list; (2) per
document the set's size, two sums that identify it, and its two prefixes; equal sets become one; (3) sets meet by
prefix token, tokens shared by the same sets as one group, a group of many in blocks of pairs of parts; inside a group
the filter is applied to all pairs and only a spanning star of what is left goes on, never the pairs; (4) stars give
candidate clusters; (5) sets of a cluster meet once, a large cluster again in blocks of pairs of parts, and all its pairs
of fitting sizes are verified exactly; (6) links, again as stars, give the components. No pair is dropped at any step.

Defined results: a text without words (null, empty, white space) has an empty set and links with nothing; a text with
fewer words than a shingle has its whole sequence as its only shingle; equal sets link; rows with one doc_id and
different texts are joined as different documents, repeated rows as copies; a row without a doc_id makes no links but
has the component of the documents with its set; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagloom.llm.batches import GOLDEN, in_row, mix64, pieces, texts_of, window_hashes, words_of
from lagloom.llm.components import components, contracted
from lagloom.llm.staging import staged

#: The list of frequent buckets has at most so many entries (4 + 4 bytes each in a broadcast).
FREQUENT_MOST = 1 << 20
FREQUENT_LEAST = 8
#: Ranges of the 32-bit buckets. A task counts one at a time, so its memory follows a range's width, not the corpus.
COUNT_RANGES = 2048
#: Buckets that a task holds before it packs them, and those of a range before they become counts.
SEND_HELD = 1 << 22
COUNT_HELD = 1 << 20
#: Bits of the fixed-size filters in front of joins.
MARK_BITS = 1 << 24
#: Members of a part of a large token group or cluster; a task holds two parts.
GROUP_PART = 512
CLUSTER_PART = 768
#: Bytes of set hashes of a part of a cluster.
CLUSTER_PART_BYTES = 12 << 20

_SEEDS = (np.uint64(0), np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F))


class Sets(NamedTuple):
    """Distinct shingle hashes of all rows of a piece, sorted within rows, and where those of each row begin."""

    hashes: np.ndarray
    rows: np.ndarray


def shingle_sets(texts: pa.Array, size: int) -> Sets:
    words = words_of(texts, lower=True)
    counts = np.diff(words.rows)
    values = window_hashes(words.hashes, size)
    at = np.flatnonzero(in_row(words.rows, size)) if len(values) else np.zeros(0, dtype=np.int64)
    row = np.repeat(np.arange(len(counts)), counts)
    hashes, owner = values[at], row[at]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):  # the whole sequence is the only shingle
        whole = np.array([_sequence(words.hashes[words.rows[r] : words.rows[r + 1]]) for r in short], dtype=np.uint64)
        hashes, owner = np.concatenate([hashes, whole]), np.concatenate([owner, short])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return Sets(hashes, np.searchsorted(owner, np.arange(len(counts) + 1)))


def _sequence(words: np.ndarray) -> np.uint64:
    value = np.full(1, len(words), dtype=np.uint64)
    for word in words:
        value = mix64((value ^ word) * GOLDEN)
    return value[0]


def least_common(m: np.ndarray, percent: int) -> np.ndarray:
    """The size of the smallest intersection a set of size m can have with a linked one."""
    return -(-m * percent // 100)


def bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(32)).astype(np.uint32)


def frequent_buckets(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent 32-bit buckets of shingle hashes over all documents, and their counts.

    Tasks send their sorted buckets as one row for each range, the high 16 bits as counts per value; rows of a range
    follow each other in the task that counts it. Which buckets make the list only decides how long the work takes.
    """
    cells = (1 << 16) // COUNT_RANGES

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for piece in pieces(batches):
            held.append(bucket(shingle_sets(texts_of(piece), size).hashes))
            total += len(held[-1])
            if total > SEND_HELD:
                yield packed(held)
                total = 0
        if total:
            yield packed(held)

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        values = np.concatenate(held)
        held.clear()
        values.sort()
        ends = np.searchsorted(values, np.arange(1, 1 << 16, dtype=np.uint32) << np.uint32(16))
        ends = np.concatenate([[0], ends, [len(values)]])
        counts = np.diff(ends).astype("<u4").reshape(COUNT_RANGES, cells)
        low, ends = values.astype("<u2"), ends[::cells]  # the low 16 bits
        own = np.flatnonzero(np.diff(ends))
        columns = [[counts[r].tobytes() for r in own], [low[ends[r] : ends[r + 1]].tobytes() for r in own]]
        return pa.record_batch([pa.array(own, pa.int32()), *(pa.array(c, pa.binary()) for c in columns)], names=["range", "cells", "low"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, values, counts in range_counts(batches, cells):
            often = np.flatnonzero(counts >= FREQUENT_LEAST)
            for first in range(0, len(often), 1 << 16):
                at = often[first : first + (1 << 16)]
                found = [own * (cells << 16) + values[at].astype(np.int64), counts[at].astype(np.int64)]
                yield pa.record_batch([pa.array(c) for c in found], names=["bucket", "n"])

    sent = docs.select("text").mapInArrow(send, "range int, cells binary, low binary")
    counted = sent.repartition("range").sortWithinPartitions("range").mapInArrow(count, "bucket long, n long")
    counted = staged(counted, "jaccard-counts")
    levels = counted.groupBy(F.floor(F.log2("n") * 4).alias("level")).count().orderBy(F.desc("level")).collect()
    total, lowest = 0, None  # a few dozen levels
    for level in levels:
        total += level["count"]
        if total > FREQUENT_MOST:
            break
        lowest = level["level"]
    if lowest is None:
        return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.uint32)
    rows = counted.where(F.floor(F.log2("n") * 4) >= lowest).toArrow()
    values, counts = rows.column("bucket").to_numpy().astype(np.uint32), rows.column("n").to_numpy()
    order = np.argsort(values)
    return values[order], np.minimum(counts[order], (1 << 32) - 1).astype(np.uint32)


def range_counts(batches: Iterator[pa.RecordBatch], cells: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per range, whose rows (range, cells, low) follow each other: it, its distinct values from its start on, their counts.

    Few values are sorted; more go to an array of the range's width, a bounded number at once.
    """
    current, held, total, dense = None, [], 0, None

    def summed() -> np.ndarray:
        found = np.bincount(np.concatenate(held), minlength=cells << 16)
        return found if dense is None else np.add(dense, found, out=dense)

    def ended() -> tuple[int, np.ndarray, np.ndarray]:
        if dense is None:
            return current, *np.unique(np.concatenate(held), return_counts=True)
        counts = summed() if held else dense
        values = np.flatnonzero(counts)
        return current, values, counts[values]

    for batch in batches:
        ranges = np.asarray(batch.column(0))
        cuts = [0, *(np.flatnonzero(ranges[1:] != ranges[:-1]) + 1).tolist(), len(ranges)]
        for first, stop in zip(cuts[:-1], cuts[1:]):
            if first == stop:
                continue
            if current is not None and current != ranges[first]:
                yield ended()
                held, total, dense = [], 0, None
            current = int(ranges[first])
            counts = np.frombuffer(b"".join(batch.column(1)[first:stop].to_pylist()), "<u4")
            low = np.frombuffer(b"".join(batch.column(2)[first:stop].to_pylist()), "<u2")
            high = np.repeat(np.tile(np.arange(cells, dtype=np.int32) << 16, stop - first), counts)
            held.append(high | low)
            total += len(low)
            if total > COUNT_HELD:
                dense, held, total = summed(), [], 0
    if current is not None:
        yield ended()


def prefixes(
    sets: Sets, frequent: tuple[np.ndarray, np.ndarray], percent: int, seeds: tuple[np.uint64, ...] = _SEEDS
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per order, one for each seed, the tokens of all rows' prefixes and where those of each row begin."""
    sizes = np.diff(sets.rows)
    keep = np.where(sizes > 0, sizes - least_common(sizes, percent) + 1, 0)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    rank_in_row = np.arange(len(owner)) - np.repeat(sets.rows[:-1], sizes)
    kept = rank_in_row < np.repeat(keep, sizes)  # after sorting within rows
    ends = np.concatenate([[0], np.cumsum(keep)])
    weight = np.zeros(len(owner), dtype=np.uint32)
    if len(frequent[0]):
        at = np.minimum(np.searchsorted(frequent[0], bucket(sets.hashes)), len(frequent[0]) - 1)
        found = frequent[0][at] == bucket(sets.hashes)
        weight[found] = frequent[1][at[found]]
    result = []
    for number, seed in enumerate(seeds):
        order = np.lexsort((mix64(sets.hashes + seed), weight, owner) if not number else (mix64(sets.hashes + seed), owner))
        result.append((sets.hashes[order][kept], ends))
    return result


def long_prefix(m: np.ndarray, percent: int) -> np.ndarray:
    """Tokens in the long prefix of a set of size m: half as many again as must be looked at for one shared token."""
    missing = m - least_common(m, percent)
    return np.where(m > 0, np.minimum(m, missing + missing // 2 + 1), 0)


def long_prefixes(sets: Sets, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The long prefixes in an order by hash as sorted distinct 16-bit tokens, and where those of each row begin."""
    sizes = np.diff(sets.rows)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    rank_in_row = np.arange(len(owner)) - np.repeat(sets.rows[:-1], sizes)
    kept = rank_in_row < np.repeat(long_prefix(sizes, percent), sizes)  # after sorting within rows
    order = np.lexsort((mix64(sets.hashes + _SEEDS[1]), owner))[kept]
    tokens = np.unique(owner[order] << 16 | (sets.hashes[order] >> np.uint64(48)).astype(np.int64))
    return (tokens & 0xFFFF).astype("<u2"), np.searchsorted(tokens >> 16, np.arange(len(sizes) + 1))


def _sharing(lists: list[np.ndarray], sizes: np.ndarray, percent: int) -> np.ndarray:
    """Pairs whose long prefixes share as many tokens as those of linked sets do at least.

    Tokens of one prefix that became equal when they were shortened are taken off what a pair needs.
    """
    outside = sizes - long_prefix(sizes, percent)
    equal = long_prefix(sizes, percent) - np.array([len(x) for x in lists])
    common = _overlaps(lists)
    shared = np.zeros(common.shape, dtype=bool)
    for rows in _slices(len(lists)):
        together = sizes[rows, None] + sizes[None, :]
        need = -(-percent * together // (100 + percent)) - np.maximum.outer(outside[rows], outside) - np.minimum.outer(equal[rows], equal)
        shared[rows] = common[rows] >= need
    return shared


def _row_sums(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums modulo 2^64 of the values of each row."""
    upto = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, out=upto[1:])
    return (upto[rows[1:]] - upto[rows[:-1]]).view(np.int64)


def set_keys(sets: Sets) -> list[np.ndarray]:
    """Two sums over the hashes of each set, which identify it."""
    return [_row_sums(mix64(values), sets.rows) for values in (sets.hashes ^ GOLDEN, sets.hashes + GOLDEN)]


def describe(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Per row doc_id, n, two sums that identify the set, and its prefix and long prefix as bytes.

    Tokens of the prefix are 64-bit, of the long one their high 16 bits: those can only let more candidates through.
    """
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_buckets(docs, size))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            sets = shingle_sets(texts_of(piece), size)
            blobs = []
            for tokens, ends in (*prefixes(sets, frequent.value, percent, _SEEDS[:1]), long_prefixes(sets, percent)):
                blobs.append(pa.array([tokens[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary()))
            columns = [piece.column(0), pa.array(np.diff(sets.rows)), *map(pa.array, set_keys(sets)), *blobs]
            yield pa.record_batch(columns, names=["doc_id", "n", "key1", "key2", "first", "second"])

    schema = f"doc_id {id_type}, n long, key1 long, key2 long, first binary, second binary"
    return docs.select("doc_id", "text").mapInArrow(work, schema)


def _paired(frame: DataFrame, parts: Column, member: str) -> DataFrame:
    """Rows dealt to the blocks (low part, high part) of their group: each row to all blocks that its own part is in."""
    own = F.pmod(F.xxhash64(F.col(member), F.lit(7)), F.col("parts")).cast("int")
    frame = frame.withColumn("parts", parts.cast("int")).withColumn("part", own)
    frame = frame.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return frame.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other")).drop("other")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The groups of rows with equal first ``keys`` columns, which follow each other."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.asarray(batch.column(k)) for k in range(keys)]
        change = np.zeros(batch.num_rows, dtype=bool)
        for column in columns:
            change[1:] |= column[1:] != column[:-1]
        if held and any(held[-1].column(k)[held[-1].num_rows - 1].as_py() != batch.column(k)[0].as_py() for k in range(keys)):
            yield pa.Table.from_batches(held)
            held = []
        cuts = np.flatnonzero(change)
        at = 0
        for cut in cuts.tolist():
            yield pa.Table.from_batches([*held, batch.slice(at, cut - at)])
            held, at = [], cut
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def _overlaps(lists: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sorted distinct arrays; tokens of one array alone are left out."""
    sizes = np.array([len(x) for x in lists])
    values = np.concatenate(lists)
    owner = np.repeat(np.arange(len(lists), dtype=np.int32), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    del order
    same = np.zeros(len(values), dtype=bool)
    same[1:] = values[1:] == values[:-1]
    shared = same.copy()
    shared[:-1] |= same[1:]
    owner = owner[shared]
    column = np.cumsum(~same)[shared]
    common = np.zeros((len(lists), len(lists)), dtype=np.float32)
    if not len(owner):
        return common
    column = np.concatenate([[0], np.cumsum(column[1:] != column[:-1])])  # ascending
    width = 1 + int(column[-1])
    for first in range(0, width, 4096):  # a bounded slice of the incidence matrix at once
        inside = slice(*np.searchsorted(column, [first, first + 4096]))
        held = np.zeros((len(lists), min(4096, width - first)), dtype=np.float32)
        held[owner[inside], column[inside] - first] = 1
        common += held @ held.T
    return common


def _slices(count: int) -> list[slice]:
    """Rows of a matrix of pairs, a bounded number at once: numbers of 64 bits for all pairs are large."""
    return [slice(first, first + 128) for first in range(0, count, 128)] or [slice(0, 0)]


def _stars(linked: np.ndarray, ids: np.ndarray) -> list[tuple[int, int]]:
    """Edges that span the same components as the boolean matrix: every member with the smallest id of its component."""
    label = ids.copy()
    while True:
        near = np.concatenate([np.where(linked[rows], label[None, :], np.iinfo(np.int64).max).min(axis=1) for rows in _slices(len(ids))])
        new = np.minimum(label, near)
        if (new == label).all():
            break
        label = new
    return [(int(a), int(b)) for a, b in zip(label, ids) if a != b]


def marks(values: DataFrame, column: str) -> np.ndarray:
    """Packed bits of fixed size, set at a hash of every value: says which values are certainly not in the column.

    The more values there are, the more others pass as well; an equality join behind it gives the exact answer.
    """
    bit = F.pmod(F.xxhash64(column), F.lit(MARK_BITS))
    flagged = values.select(bit.alias("bit")).selectExpr("shiftright(bit, 5) as word", "shiftleft(1L, cast(bit & 31 as int)) as flag")
    words = flagged.groupBy("word").agg(F.bit_or("flag").alias("flags")).toArrow()
    found = np.zeros(MARK_BITS // 32, dtype="<u4")
    found[words.column("word").to_numpy()] = words.column("flags").to_numpy()
    return found.view(np.uint8)


def marked(frame: DataFrame, column: str, bits: np.ndarray) -> DataFrame:
    """The rows whose value in ``column`` may be among those of ``bits``."""
    shared = frame.sparkSession.sparkContext.broadcast(bits)
    frame = frame.where(F.col(column).isNotNull()).withColumn("_bit", F.pmod(F.xxhash64(column), F.lit(MARK_BITS)))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.asarray(batch.column(batch.num_columns - 1))
            flags = shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1
            yield batch.filter(pa.array(flags.astype(bool)))

    return frame.mapInArrow(some, frame.schema).drop("_bit")


def token_groups(described: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(group, members, id): the sets that share a prefix token; tokens that the same sets share are one group.

    A set leaves a token's group if no other there has a fitting size (the next smaller or larger one would). ``reps`` has
    the id of every set and the row that stands for it. Copies of that row, and other rows of the set that pass the marks,
    bring a token again: they must not count, else two of them cancel out in the group's key.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column(2).to_pylist()
            lengths = [len(b) // 8 for b in blobs]
            columns = [np.frombuffer(b"".join(blobs), dtype="<i8"), *(np.repeat(np.asarray(batch.column(k)), lengths) for k in (0, 1))]
            yield pa.record_batch([pa.array(c) for c in columns], names=["token", "id", "n"])

    own = marked(described.selectExpr("cast(doc_id as long) as doc_id", "key1 as id", "cast(n as int) as n", "first"), "doc_id", marks(reps, "doc"))
    tokens = own.select("id", "n", "first").mapInArrow(spread, "token long, id long, n int")
    by_size = Window.partitionBy("token").orderBy("n", "id")
    tokens = tokens.withColumn("_before", F.lag("id").over(by_size)).where("_before is null or _before <> id").drop("_before")
    smaller, larger = F.lag("n").over(by_size).cast("long"), F.lead("n").over(by_size).cast("long")
    tokens = tokens.withColumn("_fits", (100 * smaller >= percent * F.col("n")) | (100 * F.col("n").cast("long") >= percent * larger))
    tokens = tokens.where("_fits")
    group = Window.partitionBy("token")
    members, group_key = F.count("*").over(group), F.bit_xor(F.xxhash64("id", F.lit(3))).over(group)
    shared = tokens.withColumn("members", members).withColumn("group", group_key).where("members > 1")
    return shared.select("group", "members", "id").distinct()


def candidate_stars(described: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) spanning the candidates: sets of fitting sizes that share a prefix token and enough of the long prefix."""
    shared = staged(token_groups(described, reps, percent), "jaccard-groups")
    sketches = marked(described.selectExpr("key1 as id", "n", "second"), "id", marks(shared, "id"))
    shared = shared.join(sketches.dropDuplicates(["id"]), "id")
    blocks = _paired(shared, F.ceil(F.col("members") / GROUP_PART), "id")
    keys = ["group", "members", "low", "high"]
    ordered = blocks.repartition(*keys).sortWithinPartitions(*keys).select(*keys, "id", "n", "second")

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = []
        for group in _groups(batches, len(keys)):
            if group.num_rows < 2:
                continue
            ids, sizes = group.column("id").to_numpy(), group.column("n").to_numpy()
            linked = _fitting(sizes, percent)
            if linked.any():
                linked &= _sharing([np.frombuffer(b.as_py(), "<u2") for b in group.column("second")], sizes, percent)
            edges += _stars(linked, ids)
            if len(edges) > 10_000:
                yield _edge_batch(edges)
                edges = []
        if edges:
            yield _edge_batch(edges)

    return contracted(ordered.mapInArrow(filtered, "a long, b long"))


def _fitting(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of different rows whose sizes allow the similarity."""
    fits = (100 * sizes)[:, None] >= (percent * sizes)[None, :]
    fits &= fits.T.copy()
    np.fill_diagonal(fits, False)
    return fits


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(c), pa.int64()) for c in zip(*edges)], names=["a", "b"])


def _placed(clusters: DataFrame, percent: int) -> DataFrame:
    """The blocks every set of the clusters is compared in: (id, doc, component, pair, class, part, low, high, copies).

    A small cluster is one block. In others sets are compared inside their class of sizes and with the next one;
    a class is as wide as linked sizes can differ. What is still too large is cut into pairs of parts.
    """
    totals = [F.count("*").alias("members"), F.sum("n").alias("tokens")]
    parts = F.ceil(F.greatest(F.col("members") / CLUSTER_PART, F.col("tokens") * 8 / CLUSTER_PART_BYTES)).cast("int")
    small = clusters.groupBy("component").agg(*totals).select("component", (parts <= 1).alias("small"))
    size_class = F.floor(F.log("n") / float(np.log(100 / percent + 1e-6))).cast("int")
    sets = clusters.join(small, "component").withColumn("class", F.when(F.col("small"), 0).otherwise(size_class)).drop("small")
    by_class = Window.partitionBy("component").orderBy("class")  # as many rows as sizes have classes
    near = lambda step: F.lead("class", step).over(by_class) == F.col("class") + step
    more = lambda name: F.col(name) + F.when(near(1), F.lead(name).over(by_class)).otherwise(0)
    classes = sets.groupBy("component", "class").agg(*totals)
    classes = classes.withColumns({"_members": more("members"), "_tokens": more("tokens"), "below": F.coalesce(near(-1), F.lit(False))})
    classes = classes.drop("members", "tokens").withColumnsRenamed({"_members": "members", "_tokens": "tokens"})
    pairs = classes.select("component", F.col("class").alias("pair"), parts.alias("parts"))
    own = F.when(F.col("below"), F.array(F.col("class") - 1, "class")).otherwise(F.array("class"))
    sets = sets.join(classes.select("component", "class", "below"), ["component", "class"]).withColumn("pair", F.explode(own))
    placed = _paired(sets.join(pairs, ["component", "pair"]), F.col("parts"), "id")
    return placed.select("id", "doc", "component", "pair", "class", "part", "low", "high", "copies")


def verified(docs: DataFrame, clusters: DataFrame, size: int, percent: int) -> DataFrame:
    """(id, root, links) of the sets of all clusters (id, component, doc, n, copies): exact links, as stars and numbers.

    A row says that the set links, directly or not, with ``root`` inside its block, and how many documents it links with.
    Texts travel to the blocks, which compress, and not their hashes, which are larger and don't.
    """
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            key = pa.array(set_keys(shingle_sets(texts_of(piece), size))[0])
            yield pa.record_batch([piece.column(0), key, texts_of(piece)], names=["doc", "id", "text"])

    placed = _placed(clusters, percent)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")  # hashed as ``doc`` is
    sets = marked(own, "doc_id", marks(clusters, "doc")).mapInArrow(keyed, "doc long, id long, text string")
    keys = ["component", "pair", "low", "high"]
    ordered = sets.join(placed, ["id", "doc"]).repartition(*keys).sortWithinPartitions(*keys)
    ordered = ordered.select(*keys, "part", "class", "id", "copies", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, len(keys)):
            firsts = np.unique(group.column("id").to_numpy(), return_index=True)[1]  # a repeated row is one set
            group = group.take(pa.array(firsts))
            ids, copies = group.column("id").to_numpy(), group.column("copies").to_numpy()
            own = group.column("part").to_numpy()
            lists = []
            for piece in pieces(group.select(["text"]).to_batches()):
                sets = shingle_sets(texts_of(piece), size)
                lists += [sets.hashes[a:b] for a, b in zip(sets.rows[:-1], sets.rows[1:])]
            sizes = np.array([len(x) for x in lists])
            linked = _fitting(sizes, percent)
            if group.column("low")[0].as_py() != group.column("high")[0].as_py():
                linked &= own[:, None] != own[None, :]  # pairs inside a part belong to that part's own block
            upper = group.column("class").to_numpy() > group.column("pair").to_numpy()
            linked &= ~(upper[:, None] & upper[None, :])  # and pairs of the upper class to the next pair of classes
            if linked.any():
                overlaps = _overlaps(lists)
                for rows in _slices(len(ids)):
                    common = overlaps[rows].astype(np.int64)
                    linked[rows] &= 100 * common >= percent * (sizes[rows, None] + sizes[None, :] - common)
            roots = dict((b, a) for a, b in _stars(linked, ids))
            links = np.concatenate([linked[rows] @ copies for rows in _slices(len(ids))])
            columns = [pa.array(ids), pa.array([roots.get(i, i) for i in ids.tolist()], pa.int64()), pa.array(links)]
            yield pa.record_batch(columns, names=["id", "root", "links"])

    return ordered.mapInArrow(compare, "id long, root long, links long")


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) and n_links of every row."""
    described = staged(describe(docs, size, percent), "jaccard-described")
    some = described.where("n > 0 and doc_id is not null")
    same = ["n", "key1", "key2"]
    reps = some.groupBy(*same).agg(
        F.min("doc_id").cast("long").alias("doc"),
        F.count("*").alias("copies"),
    )
    reps = staged(reps.withColumn("id", F.col("key1")), "jaccard-sets")
    candidates = components(staged(candidate_stars(described, reps, percent), "jaccard-candidates"))
    clusters = candidates.join(reps.select("id", "doc", "n", "copies"), "id")
    found = staged(verified(docs, staged(clusters, "jaccard-clusters"), size, percent), "jaccard-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    linked = components(found.where("id <> root").select(F.col("root").alias("a"), F.col("id").alias("b")))
    named = linked.join(reps.select("id", "doc"), "id")
    least = named.groupBy("component").agg(F.min("doc").alias("component_id"))
    named = named.join(least, "component").select("id", "component_id")
    sets = reps.select(*same, "id", "doc", "copies").join(links, "id", "left").join(named, "id", "left")
    sets = sets.select(
        *same,
        F.coalesce("component_id", "doc").alias("component_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    rows = described.select("doc_id", *same).join(sets, same, "left")
    return rows.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", F.col("doc_id").cast("long")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
