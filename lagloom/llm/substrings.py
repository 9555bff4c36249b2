"""Substring de-duplication: words covered by a window that also starts earlier in the corpus are removed.

Every window of ``size`` words of a document gets a 64-bit Rabin-Karp hash over its word hashes. Documents are dealt
into blocks of consecutive ids. A block sends the sorted distinct hashes of its windows to ranges of the hash space;
a range counts in how many blocks each hash occurs and tells every block but the first which of its hashes are there
earlier. Of windows that repeat only inside a block, the block itself keeps the first. Repeated windows of a
document that touch or overlap form the maximal intervals that go.

A message is one row per (block, range) and holds hashes without their shared high bits, so that the shuffle takes
six bytes a window; a hash that a third of the corpus holds is one entry per block. Texts move once.

Defined results: null and empty texts have no words; texts shorter than a window lose nothing; null ids come first;
rows with the same doc_id count as in the order of their texts; an empty table gives no rows. Two different windows
count as the same with a probability of about n * n / 2^65 for n windows in all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagloom.llm.batches import in_row, pieces, texts_of, window_hashes, words_of
from lagloom.llm.staging import arrow_schema

WINDOW_WORDS = 20
BLOCK_BYTES = 16 << 20
#: Low bits of a hash that are sent; the higher ones are counted per value (65,536 values over all ranges).
LOW_BITS = 48

INTERVALS = "n_words long, n_removed long, intervals array<struct<start:int,end:int>>, kept string"


def pack(hashes: np.ndarray, first: int, cells: int) -> bytes:
    """Sorted hashes of a range: how many have each value of the high bits from ``first`` on, then the low bits."""
    high = (hashes >> np.uint64(LOW_BITS)).astype(np.int64) - first
    counts = np.bincount(high, minlength=cells).astype("<u4")
    low = hashes & np.uint64((1 << LOW_BITS) - 1)
    return counts.tobytes() + (low >> np.uint64(16)).astype("<u4").tobytes() + (low & np.uint64(0xFFFF)).astype("<u2").tobytes()


def unpack(blob: bytes, first: int, cells: int) -> np.ndarray:
    counts = np.frombuffer(blob, "<u4", cells)
    total = int(counts.sum())
    upper = np.frombuffer(blob, "<u4", total, 4 * cells).astype(np.uint64)
    lower = np.frombuffer(blob, "<u2", total, 4 * cells + 4 * total).astype(np.uint64)
    high = np.repeat(np.arange(first, first + cells, dtype=np.uint64), counts)
    return high << np.uint64(LOW_BITS) | upper << np.uint64(16) | lower


class Windows:
    """Window hashes of a block: per flat position, with the rows' words."""

    def __init__(self, texts: pa.Array, size: int) -> None:
        table = pa.record_batch([texts], names=["text"])
        hashes, valid, rows, total = [], [], [np.zeros(1, dtype=np.int64)], 0
        for piece in pieces([table]):
            words = words_of(texts_of(piece))
            own = np.zeros(len(words.hashes), dtype=np.uint64)
            inside = np.zeros(len(words.hashes), dtype=bool)
            values = window_hashes(words.hashes, size)
            own[: len(values)] = values
            inside[: len(values)] = in_row(words.rows, size)
            hashes.append(own)
            valid.append(inside)
            rows.append(words.rows[1:] + total)
            total += len(own)
        self.rows = np.concatenate(rows)
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
        self.at = np.flatnonzero(np.concatenate(valid)) if valid else np.zeros(0, dtype=np.int64)

    def distinct(self) -> np.ndarray:
        return np.unique(self.hashes[self.at])

    def removed(self, earlier: np.ndarray, size: int) -> np.ndarray:
        """Flags of the words under a window whose hash is among the sorted ``earlier`` or occurs before in the block."""
        own = self.hashes[self.at]
        repeated = np.ones(len(own), dtype=bool)
        repeated[np.unique(own, return_index=True)[1]] = False
        if len(earlier):
            place = np.minimum(np.searchsorted(earlier, own), len(earlier) - 1)
            repeated |= earlier[place] == own
        change = np.zeros(len(self.hashes) + 1, dtype=np.int64)
        starts = self.at[repeated]
        np.add.at(change, starts, 1)
        np.add.at(change, starts + size, -1)
        return np.cumsum(change[:-1]) > 0


def _in_order(table: pa.Table) -> pa.Table:
    """Rows of a block by doc_id and text, nulls first."""
    keys = [("doc_id", "ascending"), ("text", "ascending")]
    return table.take(pa.compute.sort_indices(table, sort_keys=keys, null_placement="at_start")).combine_chunks()


def remove_repeats(
    docs: DataFrame,
    size: int = WINDOW_WORDS,
    finish: Callable | None = None,
    schema: str = INTERVALS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id and for every document the numbers of words and of removed words, the removed intervals, the kept words.

    ``finish(text, flags)`` makes a document's result columns instead, from the text and the flags of its removed words.
    """
    finish = finish or kept_words
    id_type = docs.schema["doc_id"].dataType.simpleString()
    blocked, blocks = with_blocks(docs.select("doc_id", "text"), block_bytes)
    ranges = min(blocks, 1 << (64 - LOW_BITS))
    cells = -(-(1 << (64 - LOW_BITS)) // ranges)
    spread = blocked.repartition("block")

    def send(group: pa.Table) -> pa.Table:
        windows = Windows(texts_of(_in_order(group)), size)
        hashes = windows.distinct()
        cuts = np.searchsorted(hashes >> np.uint64(LOW_BITS), np.arange(ranges + 1, dtype=np.uint64) * np.uint64(cells))
        block = group.column("block")[0].as_py()
        rows = [(r, block, pack(hashes[a:b], r * cells, cells)) for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
        kinds = (pa.int32(), pa.int32(), pa.binary())
        columns = list(zip(*rows)) if rows else [(), (), ()]
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["range", "block", "hashes"])

    def answer(group: pa.Table) -> pa.Table:
        group = group.sort_by("block").combine_chunks()
        first = group.column("range")[0].as_py() * cells
        known, rows = np.zeros(0, dtype=np.uint64), []
        lists = [unpack(blob.as_py(), first, cells) for blob in group.column("hashes")]
        merged = np.concatenate(lists)
        holder = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        order = np.argsort(merged, kind="stable")  # of equal hashes the earliest block first
        later = np.zeros(len(merged), dtype=bool)
        later[order[1:]] = merged[order[1:]] == merged[order[:-1]]
        for i, block in enumerate(group.column("block").to_pylist()):
            known = merged[later & (holder == i)]
            if len(known):
                rows.append((block, pack(known, first, cells), first))
        columns = list(zip(*rows)) if rows else [(), (), ()]
        kinds = (pa.int32(), pa.binary(), pa.int32())
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["block", "hashes", "first"])

    fields = list(arrow_schema(schema))

    def settle(left: pa.Table, right: pa.Table) -> pa.Table:
        left = _in_order(left)
        texts = texts_of(left)
        windows = Windows(texts, size)
        earlier = [unpack(b.as_py(), f.as_py(), cells) for b, f in zip(right.column("hashes"), right.column("first"))]
        flags = windows.removed(np.sort(np.concatenate(earlier)) if earlier else np.zeros(0, dtype=np.uint64), size)
        results = [finish(t, flags[a:b]) for t, a, b in zip(texts.to_pylist(), windows.rows[:-1], windows.rows[1:])]
        columns = [pa.array(list(c), field.type) for c, field in zip(zip(*results), fields)]
        return pa.table([left.column("doc_id"), *columns], names=["doc_id", *(field.name for field in fields)])

    messages = spread.groupBy("block").applyInArrow(send, "range int, block int, hashes binary")
    answers = messages.groupBy("range").applyInArrow(answer, "block int, hashes binary, first int")
    return spread.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(settle, f"doc_id {id_type}, {schema}")


def with_blocks(docs: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """The rows with the number of their block, blocks being ranges of doc_id of about ``block_bytes`` of text."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // block_bytes
    shares = [i / blocks for i in range(1, blocks)]
    cuts = docs.approxQuantile("doc_id", shares, 0.2 / blocks) if shares else []
    cuts = np.unique(np.array(cuts, dtype=np.int64))
    shared = docs.sparkSession.sparkContext.broadcast(cuts)  # a number per block

    @F.pandas_udf("int")
    def block_of(ids):
        return ids.__class__(np.searchsorted(shared.value, ids.to_numpy(), side="right").astype(np.int32))

    known = block_of(F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))) if len(cuts) else F.lit(0)
    return docs.withColumn("block", known), len(cuts) + 1


def kept_words(text: str, flags: np.ndarray) -> tuple:
    words = text.encode().split()
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    intervals = [{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])]
    return len(words), int(flags.sum()), intervals, b" ".join(compress(words, ~flags)).decode()


def kept_digest(text: str, flags: np.ndarray) -> tuple:
    """Numbers of words and removed words, digest of the kept words with blanks between."""
    words = text.encode().split()
    return len(words), int(flags.sum()), hashlib.sha256(b" ".join(compress(words, ~flags))).hexdigest()
