"""Benchmark decontamination: passages of documents within an edit budget of a benchmark item.

Texts are compared lower-cased, with runs of white space as one blank. By the q-gram lemma a passage within e edits
of an item of m characters shares at least m + 1 - q - q * e of its q-grams, all of them on diagonals (document
position minus item position) at most e apart. Shared q-grams are counted per item in bands of 2 * (e + 1) diagonals
that overlap by half, so that one band holds them all; bands that reach the bound are verified by an alignment
restricted to the band. A document is never split, so no passage is cut.

Items so short that the bound is below one q-gram get a smaller budget, down to exact occurrence; items shorter than
q are compared by occurrence of the whole item between blanks.

Defined results: null and empty texts and null or empty items match nothing; repeated documents each get their own
rows; of overlapping passages for one item the one with the fewest edits is kept, then the earliest.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagloom.llm.batches import GOLDEN, mix64, pieces

Q = 12
EDIT_RATE = 0.05
#: Benchmark characters held by a task at once; a larger benchmark is compared in so many slices.
SLICE_CHARS = 4_000_000
TABLE_BITS = 22
BANDS_AT_ONCE = 512

MATCH_COLUMNS = "item_id long, edits int, match_start int, match_end int"


def normalised(text: str) -> str:
    return " ".join(text.lower().split())


def grams(codes: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q-gram that begins at each position (the last q - 1 positions have none)."""
    if len(codes) < q:
        return np.zeros(0, dtype=np.uint64)
    values = mix64((codes.astype(np.uint64) + np.uint64(1)) * GOLDEN)
    power, part, length, out, done = np.uint64(0x9FB21C651E98DF25), values, 1, None, 0
    count, rest = len(codes) - q + 1, q
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                out = part if out is None else out[: len(part) - done] * power + part[done:][: len(out)]
                done += length
            rest >>= 1
            if rest:
                part = part[: len(part) - length] * power + part[length:]
                power, length = power * power, 2 * length
    return mix64(out[:count])


class Items(NamedTuple):
    """A slice of the benchmark: its q-grams sorted by hash, and a bit table that rules out most others."""

    ids: list[int]
    codes: list[np.ndarray]
    budgets: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray
    item: np.ndarray
    position: np.ndarray
    seen: np.ndarray
    short: list[tuple[int, str]]


def build_items(rows: list[tuple[int, str]], q: int, rate: float) -> Items:
    ids, codes, budgets, bounds, hashes, item, position, short = [], [], [], [], [], [], [], []
    for item_id, text in rows:
        text = normalised(text or "")
        if not text:
            continue
        if len(text) < q:
            short.append((item_id, text))
            continue
        size = len(text)
        budget = min(int(rate * size), (size - q) // q)
        own = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        values = grams(own, q)
        item.append(np.full(len(values), len(ids)))
        position.append(np.arange(len(values)))
        hashes.append(values)
        ids.append(item_id)
        codes.append(own)
        budgets.append(budget)
        bounds.append(size + 1 - q - q * budget)
    if not ids:
        empty = np.zeros(0, dtype=np.int64)
        return Items([], [], empty, empty, np.zeros(0, np.uint64), empty, empty, np.zeros(1 << TABLE_BITS, bool), short)
    hashes, item, position = np.concatenate(hashes), np.concatenate(item), np.concatenate(position)
    order = np.argsort(hashes, kind="stable")
    seen = np.zeros(1 << TABLE_BITS, dtype=bool)
    seen[hashes >> np.uint64(64 - TABLE_BITS)] = True
    return Items(ids, codes, np.array(budgets), np.array(bounds), hashes[order], item[order], position[order], seen, short)


def candidate_bands(codes: np.ndarray, heads: np.ndarray, items: Items, q: int) -> list[tuple[int, int, int, int]]:
    """(text, item, first diagonal, first diagonal behind) of the bands with enough shared q-grams.

    ``codes`` are the texts one behind the other with a NUL after each, ``heads`` their first positions.
    """
    values = grams(codes, q)
    at = np.flatnonzero(items.seen[values >> np.uint64(64 - TABLE_BITS)])
    if not len(at):
        return []
    low = np.searchsorted(items.hashes, values[at], side="left")
    many = np.searchsorted(items.hashes, values[at], side="right") - low
    at, low, many = at[many > 0], low[many > 0], many[many > 0]
    if not len(at):
        return []
    which = np.repeat(low, many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    at = np.repeat(at, many)
    text = np.searchsorted(heads, at, side="right") - 1
    item, position = items.item[which], items.position[which]
    band = np.floor_divide(at - heads[text] - position, items.budgets[item] + 1)
    # a band covers two steps of diagonals: a hit counts for the band that begins at its step and the one before
    text, item, position = (np.concatenate([x, x]) for x in (text, item, position))
    band = np.concatenate([band, band - 1])
    order = np.lexsort((position, band, item, text))
    text, item, band, position = text[order], item[order], band[order], position[order]
    first = np.ones(len(order), dtype=bool)
    first[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])
    new = first.copy()
    new[1:] |= position[1:] != position[:-1]  # a q-gram of the item that occurs twice in the band counts once
    begins = np.flatnonzero(first)
    counts = np.add.reduceat(new.astype(np.int64), begins)
    begins = begins[counts >= items.bounds[item[begins]]]
    width = items.budgets[item[begins]] + 1
    return list(zip(*(x.tolist() for x in (text[begins], item[begins], band[begins] * width, (band[begins] + 2) * width))))


def align(codes, heads, ends, bands: list[tuple[int, int, int, int]], items: Items) -> list[tuple[int, int, int]]:
    """(edits, start, end) of the best occurrence within each band, edits above the budget if there is none.

    All bands are aligned side by side: row b, column k of the arrays is diagonal low[b] + k, a step is one
    character of the items. A passage may begin anywhere in its band; cells carry where their path began.
    """
    sizes = np.array([len(items.codes[i]) for _, i, _, _ in bands])
    order = np.argsort(-sizes, kind="stable")
    sizes = sizes[order]
    text, item, low, high = (np.array(column)[order] for column in zip(*bands))
    head, length = heads[text], (ends - heads)[text]
    wanted = np.zeros((len(bands), int(sizes[0])), dtype=np.uint32)
    for b, i in enumerate(item):
        wanted[b, : sizes[b]] = items.codes[i]
    columns = np.arange(int((high - low).max()))
    diagonal = low[:, None] + columns
    far = 1 << 28
    inside = (columns < (high - low)[:, None]) & (diagonal >= 0) & (diagonal <= length[:, None])
    cost = np.where(inside, 0, far)
    begin = diagonal.copy()
    in_band = columns < (high - low)[:, None]
    active = np.searchsorted(-sizes, -np.arange(int(sizes[0])), side="left")
    for r, n in enumerate(active):
        here = diagonal[:n] + r  # document position that meets character r on each diagonal
        valid = (here >= 0) & (here < length[:n, None])
        same = codes[np.where(valid, here, 0) + head[:n, None]] == wanted[:n, r, None]
        new = np.where(valid, cost[:n] + ~same, far)
        start = begin[:n].copy()
        skip = cost[:n, 1:] + 1  # item character left out: from the next diagonal up
        better = skip < new[:, :-1]
        new[:, :-1][better] = skip[better]
        start[:, :-1][better] = begin[:n, 1:][better]
        reach = in_band[:n] & (here >= -1) & (here < length[:n, None])
        new[~reach] = far
        base = new - columns  # document characters put in: a running minimum along the row
        lowest = np.minimum.accumulate(base, axis=1)
        source = np.maximum.accumulate(np.where(base == lowest, columns, 0), axis=1)
        put_in = lowest + columns < new
        cost[:n] = np.where(reach, np.where(put_in, lowest + columns, new), far)
        begin[:n] = np.where(put_in, np.take_along_axis(start, source, axis=1), start)
    best = cost.argmin(axis=1)
    rows = np.arange(len(bands))
    found = np.column_stack([cost[rows, best], begin[rows, best], diagonal[rows, best] + sizes])
    result = np.empty_like(found)
    result[order] = found
    return [tuple(hit) for hit in result.tolist()]


def matches(texts: list[str], items: Items, q: int) -> list[tuple[int, int, int, int, int]]:
    """(index of the text, item_id, edits, start, end) of normalised texts, positions in code points of them."""
    found = [
        (row, item_id, 0, at, at + len(short))
        for item_id, short in items.short
        for row, text in enumerate(texts)
        for at in _places(f" {text} ", f" {short} ")
    ]
    if items.ids:
        codes = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.cumsum([len(text) + 1 for text in texts])
        heads = np.concatenate([[0], ends[:-1]])
        found += _verified(codes, heads, ends - 1, candidate_bands(codes, heads, items, q), items)
    return sorted(found)


def _places(text: str, item: str) -> Iterator[int]:
    """Where the item occurs; occurrences share at most the blank between them."""
    at = text.find(item)
    while at >= 0:
        yield at
        at = text.find(item, at + len(item) - 1)


def _verified(codes, heads, ends, bands, items: Items) -> list[tuple[int, int, int, int, int]]:
    hits: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for first in range(0, len(bands), BANDS_AT_ONCE):
        some = bands[first : first + BANDS_AT_ONCE]
        for (row, i, _, _), hit in zip(some, align(codes, heads, ends, some, items)):
            if hit[0] <= items.budgets[i]:
                hits.setdefault((row, i), []).append(hit)
    found = []
    for (row, i), passages in hits.items():
        taken: list[tuple[int, int]] = []
        for edits, start, end in sorted(passages):
            if all(end <= a or start >= b for a, b in taken):
                taken.append((start, end))
                found.append((row, items.ids[i], edits, start, end))
    return found


def _slices(benchmark: DataFrame) -> Iterator:
    """The items, broadcast in slices of about SLICE_CHARS characters by a hash of their id."""
    slices = 1 + (benchmark.agg(F.sum(F.length("text"))).first()[0] or 0) // SLICE_CHARS
    items = benchmark.select("item_id", "text").where("item_id is not null and text is not null").distinct()
    for number in range(slices):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(slices)) == number)
        rows = sorted((row.item_id, row.text) for row in part.toLocalIterator())
        yield benchmark.sparkSession.sparkContext.broadcast(rows)


def find_contamination(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = EDIT_RATE) -> DataFrame:
    """doc_id, item_id, edits, match_start and match_end (code points of the normalised text) of every passage.

    The benchmark reaches the tasks in slices of at most about SLICE_CHARS characters, each compared with all documents.
    """
    result = None
    id_type = docs.schema["doc_id"].dataType.simpleString()
    for items in _slices(benchmark):
        found = docs.select("doc_id", "text").mapInArrow(_scan_batches(items, q, rate), f"doc_id {id_type}, {MATCH_COLUMNS}")
        result = found if result is None else result.unionByName(found)
    return result


def _scan_batches(shared, q: int, rate: float):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = build_items(shared.value, q, rate)
        for piece in pieces(batches):
            ids = piece.column(0)
            found = matches([normalised(text) for text in piece.column(1).to_pylist()], items, q)
            picked = ids.take(pa.array([match[0] for match in found], pa.int64()))
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
            columns = [pa.array([match[k + 1] for match in found], kind) for k, kind in enumerate(kinds)]
            yield pa.record_batch([picked, *columns], names=["doc_id", "item_id", "edits", "match_start", "match_end"])

    return scan


def clean_documents(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = EDIT_RATE) -> DataFrame:
    """The documents without any benchmark passage, decided row by row inside one pass."""
    for items in _slices(benchmark):
        docs = docs.mapInArrow(_keep_batches(items, docs.columns, q, rate), docs.schema)
    return docs


def _keep_batches(shared, names: list[str], q: int, rate: float):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = build_items(shared.value, q, rate)
        for batch in batches:
            clean = np.ones(batch.num_rows, dtype=bool)
            done = 0
            for piece in pieces([batch]):
                texts = [normalised(text) for text in piece.column(names.index("text")).to_pylist()]
                for row, *_ in matches(texts, items, q):
                    clean[done + row] = False
                done += piece.num_rows
            yield batch.filter(pa.array(clean))

    return keep
