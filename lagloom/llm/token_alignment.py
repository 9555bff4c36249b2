"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, counted over the corpus.

A is a byte-level BPE file of the tokenizers library, B a sentencepiece model with byte fallback. Offsets at which tokens of
both end cut a text's bytes into groups; all A-B pairs of occurrences in a group are links. A map made once gives
for every A id the B id with the same bytes. Groups of one token each that follow the map are counted in vectors as
long as A's vocabulary, which tasks add up before they are shuffled; only pairs of the other groups go
through the shuffle by pair. A pair of the map that such a group holds too counts in the vector.

Long texts are cut into sections, before a space that stands between a printable ASCII character and an ASCII letter.
Neither tokenizer has a token across such a place (A's words begin there; no piece of B has a space behind another
character, which is checked), so both encode the sections apart. The groups of a batch of texts are found in flat arrays.

The counts that a document needs come back by equality joins: the 65,536 most frequent pairs, a bounded table, by
broadcast, and the rest, none of which can be hot then, by a shuffle join. That bound only deals out work.

Defined results: a text that is null or empty, or whose joined token bytes of A or B differ from space + text (a text
with U+2581), has no tokens: zeros, and '' for the digest. Rows are aligned one by one, so repeated rows and equal
or null ids count as documents of their own; extra columns are ignored; an empty table gives no rows. Memory follows
the longest text and the distinct links of its largest group.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lagloom.llm.batches import pieces
from lagloom.llm.staging import arrow_schema, staged

#: Pairs whose counts are broadcast; all others are joined by a shuffle.
FREQUENT_PAIRS = 1 << 16
PIECE_BYTES = 1 << 19
#: Characters of a section of a long text, at least.
SECTION_CHARS = 1 << 15
#: Links expanded at once, unless one group has more.
EXPANDED_LINKS = 1 << 20

#: Both tokenizers' vocabularies fit 16 bits: a pair is A's id * 2^16 + B's id.
ID_BITS = 16
_ID, _PAIR = (1 << ID_BITS) - 1, (1 << 2 * ID_BITS) - 1

_LONG_RUN = re.compile(r"[^ ]{1000}|\s{1000}")
_CUT = re.compile("(?<=[!-~])(?= [A-Za-z])")

ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "same array<int>, same_links array<int>, pairs array<long>, pair_links array<long>"
)


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 is itself, others follow 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def sections(text: str) -> list[str]:
    """The text in sections that both tokenizers encode apart, each beginning with a space."""
    found, start = [], 0
    while cut := _CUT.search(text, start + SECTION_CHARS):
        found.append(text[start : cut.start()])
        start = cut.start()
    return [*found, text[start:]]


class Aligner:
    """Both tokenizers, the bytes of their tokens, and the identity map."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        entries = sorted(self.a.get_vocab().items(), key=lambda e: e[1])
        self.a_bytes = [b""] * (entries[-1][1] + 1)
        for entry, i in entries:
            self.a_bytes[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        model = self.b
        pieces_of_b = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces_of_b)]
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << ID_BITS:
            raise ValueError("vocabularies of more than 65,536 ids")
        if any(re.search("[^▁]▁", p) for p in pieces_of_b):
            raise ValueError("a piece goes on over a space, so texts can't be cut there")
        written = {v: i for i, v in enumerate(self.b_bytes) if model.is_byte(i)}
        written |= {v: i for i, v in enumerate(self.b_bytes) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
        self.same = np.array([written.get(v, -1) for v in self.a_bytes])
        self.fast_a = self.ranked(a_path)
        self.a_sizes, self.b_sizes = (np.array([len(v) for v in table]) for table in (self.a_bytes, self.b_bytes))

    def ranked(self, path: str) -> tiktoken.Encoding | None:
        """A by ranks, which is faster, where its file says the same: ids in the order of merges, the public word pattern."""
        with open(path, encoding="utf-8") as file:
            written = json.load(file)
        merges = [m.split(" ") if isinstance(m, str) else m for m in written["model"]["merges"]]
        in_order = all(self.a.token_to_id(x + y) == 256 + i for i, (x, y) in enumerate(merges))
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if not in_order or written["normalizer"] or plain.items() - (written["pre_tokenizer"] or {}).items():
            return None
        ranks = {token: i for i, token in enumerate(self.a_bytes[: 256 + len(merges)])}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def a_ids(self, parts: list[str]) -> Iterator[list[int]]:
        """A's ids of every part; parts with a very long word or gap go through its own library, which takes them in bounded time."""
        long = [self.fast_a is None or _LONG_RUN.search(part) is not None for part in parts]
        others = iter(self.a.encode_batch_fast([p for p, own in zip(parts, long) if own], add_special_tokens=False))
        return (next(others).ids if own else self.fast_a.encode_ordinary(p) for p, own in zip(parts, long))

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B of every text; none where a text has no tokens by definition."""
        parts = [sections(f" {text}") if text else [] for text in texts]
        flat = [part for own in parts for part in own]
        a = self.a_ids(flat)
        b = iter(self.b.encode([part[1:] for part in flat], num_threads=1))  # the model adds the space
        found = []
        for own in parts:
            a_ids, b_ids = [], []
            for part in own:
                whole, a_part, b_part = part.encode(), next(a), next(b)
                a_ids.append(a_part if b"".join(map(self.a_bytes.__getitem__, a_part)) == whole else None)
                b_ids.append(b_part if b"".join(map(self.b_bytes.__getitem__, b_part)) == whole else None)
            # a section that differs loses bytes, so the whole text differs too
            equal = None not in a_ids and None not in b_ids
            found.append((list(chain(*a_ids)), list(chain(*b_ids))) if equal else ([], []))
        return [f[0] for f in found], [f[1] for f in found]


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def summed(keys: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of links of each."""
    order = np.argsort(keys)
    keys, links = keys[order], links[order]
    heads = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[heads], np.add.reduceat(links, heads) if len(heads) else links


_DIGITS = np.array([list(f"{i:<5}".encode()) + [0] for i in range(1 << ID_BITS)], dtype=np.uint8)
_N_DIGITS = np.array([len(str(i)) for i in range(1 << ID_BITS)])


def ragged(counts: np.ndarray) -> np.ndarray:
    """0, 1, … up to each count, one behind the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def align_texts(own: Aligner, texts: list[str]) -> list[tuple]:
    """Per text n_a, n_b, n_groups, n_links, digest, then distinct fast-path ids and other pairs, with the links of each."""
    a_lists, b_lists = own.encode(texts)
    n = len(texts)
    n_a, n_b = (np.array([len(ids) for ids in lists], dtype=np.int64) for lists in (a_lists, b_lists))
    a, b = (np.fromiter(chain.from_iterable(lists), np.int64) for lists in (a_lists, b_lists))
    a_ends, b_ends = np.cumsum(own.a_sizes[a]), np.cumsum(own.b_sizes[b])  # over all texts, alike for both
    ends = np.zeros(int(a_ends[-1]) + 1 if len(a_ends) else 1, dtype=np.uint8)
    ends[a_ends] += 1
    ends[b_ends] += 1
    a_cuts, b_cuts = ends[a_ends] == 2, ends[b_ends] == 2
    a_group, b_group = np.cumsum(a_cuts) - a_cuts, np.cumsum(b_cuts) - b_cuts
    groups = int(a_cuts.sum())
    a_count, b_count = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
    a_first, b_first = np.cumsum(a_count) - a_count, np.cumsum(b_count) - b_count
    doc = np.repeat(np.arange(n), n_a)[a_first]  # of each group
    n_groups = np.bincount(doc, minlength=n)
    link_ends = np.concatenate([[0], np.cumsum(a_count * b_count)])[np.concatenate([[0], np.cumsum(n_groups)])]

    # the digest's text: A's tokens of a group, then B's
    places = np.concatenate([np.arange(len(a)) + b_first[a_group], np.arange(len(b)) + (a_first + a_count)[b_group]])
    merged, marks = np.empty(len(places), dtype=np.int64), np.empty(len(places), dtype=np.uint8)
    merged[places] = np.concatenate([a, b])
    marks[places] = np.concatenate([np.where(a_cuts, ord("|"), ord(",")), np.where(b_cuts, ord(";"), ord(","))])
    letters, sizes = _DIGITS[merged], _N_DIGITS[merged]
    letters[np.arange(len(merged)), sizes] = marks
    text = letters[np.arange(6) <= sizes[:, None]].tobytes()
    text_ends = np.concatenate([[0], np.cumsum(sizes + 1)])[np.concatenate([[0], np.cumsum(n_a + n_b)])]

    single = (a_count == 1) & (b_count == 1)
    fast = single.copy()
    fast[single] = own.same[a[a_first[single]]] == b[b_first[single]]
    keys, links = other_links(a, a_group, b, b_group, ~fast, doc)
    mapped = own.same[keys >> ID_BITS & _ID] == (keys & _ID)
    fast_keys = np.concatenate([doc[fast] << ID_BITS | a[a_first[fast]], keys[mapped] >> ID_BITS])
    fast_keys, fast_links = summed(fast_keys, np.concatenate([np.ones(int(fast.sum()), dtype=np.int64), links[mapped]]))
    keys, links = keys[~mapped], links[~mapped]
    fast_at = np.searchsorted(fast_keys, np.arange(n + 1) << ID_BITS)
    other_at = np.searchsorted(keys, np.arange(n + 1) << 2 * ID_BITS)
    fast_keys, keys = fast_keys & _ID, keys & _PAIR
    found = []
    for k in range(n):
        digest = hashlib.sha256(text[text_ends[k] : text_ends[k + 1] - 1]).hexdigest() if n_a[k] else ""
        f, o = slice(fast_at[k], fast_at[k + 1]), slice(other_at[k], other_at[k + 1])
        found.append((n_a[k], n_b[k], n_groups[k], link_ends[k + 1] - link_ends[k], digest, fast_keys[f], fast_links[f], keys[o], links[o]))
    return found


def other_links(
    a: np.ndarray, a_group: np.ndarray, b: np.ndarray, b_group: np.ndarray, wanted: np.ndarray, doc: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(text, a, b) as one ascending key, and links, of the wanted groups; equal ids of a group are multiplied, not paired one by one."""
    sides, counts = [], []
    for ids, group in ((a, a_group), (b, b_group)):
        chosen = wanted[group]
        sides.append(summed(group[chosen] << ID_BITS | ids[chosen], np.ones(int(chosen.sum()), dtype=np.int64)))
        counts.append(np.bincount(sides[-1][0] >> ID_BITS, minlength=len(wanted)))
    (left, left_n), (right, right_n) = sides
    right_first = np.cumsum(counts[1]) - counts[1]
    many = counts[1][left >> ID_BITS]  # partners of each left id
    keys, links, start = [], [], 0
    running = np.cumsum(many)
    while start < len(left):
        stop = max(start + 1, int(np.searchsorted(running, (running[start - 1] if start else 0) + EXPANDED_LINKS, side="right")))
        part = slice(start, stop)
        group = left[part] >> ID_BITS
        at = np.repeat(right_first[group], many[part]) + ragged(many[part])
        key = np.repeat(doc[group] << 2 * ID_BITS | (left[part] & _ID) << ID_BITS, many[part]) | right[at] & _ID
        key, n = summed(key, np.repeat(left_n[part], many[part]) * right_n[at])
        keys.append(key)
        links.append(n)
        start = stop
    if not keys:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return summed(np.concatenate(keys), np.concatenate(links))


def aligned_texts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """ALIGNED: a row per document, with its distinct pairs."""
    schema = arrow_schema(ALIGNED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, row = aligner(a_path, b_path), TaskContext.get().partitionId() << 40
        for piece in pieces(batches, size=PIECE_BYTES):
            found = align_texts(own, piece.column(1).to_pylist())
            ids = [range(row, row + len(found)), piece.column(0).to_pylist()]
            columns = [*ids, *zip(*found)]
            yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)
            row += len(found)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ALIGNED)


def same_counts(aligned: DataFrame, ids: int) -> DataFrame:
    """(a, n): documents that hold A id a linked with the id of the map, added up in vectors by the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(ids, dtype=np.int64)
        for batch in batches:
            vector += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=ids)
        used = np.flatnonzero(vector)
        yield pa.record_batch([pa.array(used, pa.int32()), pa.array(vector[used])], names=["a", "n"])

    return aligned.select("same").mapInArrow(run, "a int, n long").groupBy("a").agg(F.sum("n").alias("n"))


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    A pair's count is the number of documents that hold it linked. n_best are the links whose count is the highest of
    their A id, count_sum the counts of all links; the digest is of ``a1,a2|b1;a3|b2,b3`` over the groups in order.
    """
    spark = docs.sparkSession
    aligned = staged(aligned_texts(docs, a_path, b_path), "alignment-texts")
    ids = Tokenizer.from_file(a_path).get_vocab_size()
    same = staged(same_counts(aligned, ids), "alignment-same")
    pairs = staged(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "alignment-pairs")
    left = F.shiftright("pair", ID_BITS).cast("int").alias("a")
    best = same.unionByName(pairs.groupBy(left).agg(F.max("n").alias("n"))).groupBy("a").agg(F.max("n").alias("top"))
    rows = same.join(best, "a", "right").select("a", F.coalesce("n", F.lit(0)).alias("n"), "top").collect()  # a row per A id
    counts, tops = np.zeros(ids, dtype=np.int64), np.zeros(ids, dtype=np.int64)
    for a, n, top in rows:
        counts[a], tops[a] = n, top

    def by_vector(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, links = batch.column(1), batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            a = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            totals = []
            for values in (links * (counts[a] == tops[a]), links * counts[a]):
                running = np.concatenate([[0], np.cumsum(values)])
                totals.append(pa.array(running[ends[1:]] - running[ends[:-1]], pa.int64()))
            yield pa.record_batch([batch.column(0), *totals], names=["row", "n_best", "count_sum"])

    ranked = pairs.join(F.broadcast(spark.createDataFrame(pa.table({"a": np.arange(ids, dtype=np.int32), "top": tops}))), left == F.col("a"))
    ranked = ranked.select("pair", "n", (F.col("n") == F.col("top")).alias("is_best"))
    floor = pairs.orderBy(F.desc("n"), "pair").limit(FREQUENT_PAIRS).agg(F.min(F.struct(F.col("n"), -F.col("pair"))).alias("f")).first().f
    frequent = F.lit(False) if floor is None else (F.col("n") > floor.n) | ((F.col("n") == floor.n) & (F.col("pair") <= -floor[1]))
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "pair_links")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.pair_links").alias("links"))
    common = F.broadcast(ranked.where(frequent))
    near = links.join(common, "pair")
    far = links.join(common.select("pair"), "pair", "left_anti").join(ranked.where(~frequent), "pair")
    best_links = F.when(F.col("is_best"), F.col("links")).otherwise(0).alias("n_best")
    other = near.unionByName(far).select("row", best_links, (F.col("links") * F.col("n")).alias("count_sum"))
    whole = aligned.select("row", "same", "same_links").mapInArrow(by_vector, "row long, n_best long, count_sum long").unionByName(other)
    sums = whole.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    plain = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    return aligned.join(sums, "row").select(*plain, "n_best", "count_sum", "groups_sha256")
