"""Exact top-k search over binary codes by incremental multi-index hashing.

The code of a vector is the signs of its numbers. Codes are cut into m segments of about log2(number of codes) bits.
If no segment of two codes is within distance r, the codes are at least m * (r + 1) apart. Rounds therefore search all
segments at distance exactly r = 0, 1, 2, ...; a query is done once its k-th verified distance is below m * (r + 1).

A segment table is dealt into blocks by the high bits of the value, a block with very many codes into parts. Queries
go to the blocks that are near enough and look up the remaining bits there. Equal codes are one entry with their k
smallest ids; a block answers with at most k codes a query, in the order of distance and smallest id, which keeps
every id of the true result.

Defined results: null and empty vectors and those of another length than the most frequent one have no code, and are
neither found nor queries; equal distances go by id; repeated ids count once; with fewer than k codes all are
returned; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagloom.llm.staging import staged

TOP = 10
#: High bits of a segment value that make its block.
BLOCK_BITS = 5
PART_CODES = 50_000
#: Candidates compared at once inside a block.
COMPARE = 1 << 20

RESULT = "query_id long, rank int, neighbor_id long, distance int"


def binary_codes(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> tuple[DataFrame, int]:
    """(id, code) with the signs of the vectors' numbers as bytes, and the number of bits."""
    lengths = vectors.where(F.size(column) > 0).groupBy(F.size(column).alias("bits")).count()
    common = lengths.orderBy(F.desc("count"), "bits").first()
    bits = common["bits"] if common else 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = np.asarray(batch.column(1).flatten()).reshape(-1, bits) >= 0
                padded = np.zeros((len(values), -(-bits // 64) * 64), dtype=bool)
                padded[:, :bits] = values
                codes = [row.tobytes() for row in np.packbits(padded, axis=1)]
                yield pa.record_batch([batch.column(0), pa.array(codes, pa.binary())], names=["id", "code"])

    usable = vectors.where((F.size(column) == bits) & F.col(id_column).isNotNull() & (F.size(column) > 0))
    filled = F.transform(F.col(column), lambda x: F.coalesce(x.cast("float"), F.lit(-1.0).cast("float")))
    return usable.select(F.col(id_column).cast("long").alias("id"), filled.alias("v")).mapInArrow(pack, "id long, code binary"), bits


def segments(bits: int, codes: int) -> list[tuple[int, int]]:
    """First bit and end of each segment."""
    width = min(24, max(BLOCK_BITS + 3, round(log2(max(codes, 2)))))
    many = max(1, round(bits / width))
    cuts = [round(i * bits / many) for i in range(many + 1)]
    return list(zip(cuts[:-1], cuts[1:]))


def _bits(codes: list[bytes]) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1), axis=1)


def _values(bits: np.ndarray) -> np.ndarray:
    return bits.astype(np.int64) @ (1 << np.arange(bits.shape[1] - 1, -1, -1, dtype=np.int64))


def masks(width: int, weight: int) -> np.ndarray:
    """All values of ``width`` bits with ``weight`` ones."""
    if not 0 <= weight <= width:
        return np.zeros(0, dtype=np.int64)
    chosen = np.array(list(combinations(range(width), weight)), dtype=np.int64).reshape(comb(width, weight), weight)
    return (1 << chosen).sum(axis=1)


def _deal(cut: list[tuple[int, int]]):
    """Rows (code) to rows (code, segment, block, low): the value's high bits and the rest."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bits = _bits(batch.column(0).to_pylist())
            for s, (a, b) in enumerate(cut):
                high = min(BLOCK_BITS, b - a)
                block, low = _values(bits[:, a : a + high]), _values(bits[:, a + high : b]) if b - a > high else None
                low = np.zeros(len(bits), dtype=np.int64) if low is None else low
                columns = [*batch.columns, pa.array(np.full(len(bits), s)), pa.array(block), pa.array(low)]
                yield pa.record_batch(columns, names=[*batch.schema.names, "segment", "block", "low"])

    return deal


def _search(cut: list[tuple[int, int]], radius: int, k: int):
    def search(index: pa.Table, queries: pa.Table) -> pa.Table:
        """The nearest k codes a query among those of a block whose segment is exactly ``radius`` away."""
        empty = pa.table([pa.array([], pa.binary())] * 2 + [pa.array([], pa.int32()), pa.array([], pa.int64())], names=["query", "code", "distance", "least"])
        if not index.num_rows or not queries.num_rows:
            return empty
        a, b = cut[index.column("segment")[0].as_py()]
        width = max(0, b - a - BLOCK_BITS)
        low = index.column("low").to_numpy()
        order = np.argsort(low, kind="stable")
        first = np.searchsorted(low[order], np.arange((1 << width) + 1))
        codes = np.array(index.column("code").to_pylist(), dtype=object)[order]
        words = np.frombuffer(b"".join(codes), dtype=np.uint64).reshape(len(codes), -1)
        least = index.column("least").to_numpy()[order]
        asked = queries.column("query").to_pylist()
        own = np.frombuffer(b"".join(asked), dtype=np.uint64).reshape(len(asked), -1)
        near, value = queries.column("near").to_numpy(), queries.column("low").to_numpy()
        found = []
        flips = {n: masks(width, radius - n) for n in np.unique(near).tolist()}
        for q in range(len(asked)):
            probe = value[q] ^ flips[int(near[q])]
            counts = first[probe + 1] - first[probe]
            probe, counts = probe[counts > 0], counts[counts > 0]
            best = np.zeros(0, dtype=np.int64)
            distance = np.zeros(0, dtype=np.int64)
            ends = np.cumsum(counts)
            at = 0
            while at < len(counts):  # bounded slices of the candidates
                stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + COMPARE, side="right")))
                some = counts[at:stop]
                place = np.repeat(first[probe[at:stop]], some) + np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
                apart = np.bitwise_count(words[place] ^ own[q]).sum(axis=1, dtype=np.int64)
                best, distance = np.concatenate([best, place]), np.concatenate([distance, apart])
                kept = np.lexsort((least[best], distance))[:k]
                best, distance = best[kept], distance[kept]
                at = stop
            found += [(asked[q], codes[i], int(d), int(least[i])) for i, d in zip(best, distance)]
        if not found:
            return empty
        return pa.table([pa.array(list(c), t) for c, t in zip(zip(*found), empty.schema.types)], names=empty.schema.names)

    return search


def top_k(vectors: DataFrame, queries: DataFrame, k: int = TOP, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """query_id, rank from 1, neighbor_id and distance of the k nearest vectors of every query, itself among them.

    ``queries`` has the ids of the rows that are queries.
    """
    spark = vectors.sparkSession
    coded, bits = binary_codes(vectors, id_column, column)
    coded = staged(coded.distinct(), "hamming-codes")
    per_code = Window.partitionBy("code").orderBy("id")
    entries = coded.withColumn("place", F.row_number().over(per_code)).where(F.col("place") <= k)
    entries = staged(
        entries.groupBy("code").agg(F.min("id").alias("least"), F.sort_array(F.collect_list("id")).alias("ids")), "hamming-entries"
    )
    asked = coded.join(queries.select(F.col(id_column).cast("long").alias("id")).distinct(), "id")
    if not bits or not asked.limit(1).count():
        return spark.createDataFrame([], RESULT)
    asked = staged(asked, "hamming-queries")
    cut = segments(bits, entries.count())
    index = entries.select("code", "least").mapInArrow(_deal(cut), "code binary, least long, segment long, block long, low long")
    blocks = index.groupBy("segment", "block").agg(F.ceil(F.count("*") / PART_CODES).cast("int").alias("parts"))
    blocks = staged(blocks, "hamming-blocks")  # a row a block, and a part for PART_CODES codes: small enough to broadcast
    index = index.join(F.broadcast(blocks), ["segment", "block"])
    index = staged(index.withColumn("part", F.pmod(F.xxhash64("code"), F.col("parts"))).drop("parts"), "hamming-index")
    dealt = asked.select(F.col("code").alias("query")).distinct().mapInArrow(_deal(cut), "query binary, segment long, block long, low long")
    dealt = staged(dealt, "hamming-dealt")

    keys = ["segment", "block", "part"]
    active = dealt.select("query").distinct()
    best, done = None, None
    for radius in range(max(b - a for a, b in cut) + 1):
        targets = blocks.withColumnRenamed("block", "target").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        near = F.bit_count(F.col("block").bitwiseXOR(F.col("target")))
        sent = dealt.join(active, "query").join(F.broadcast(targets), "segment").withColumn("near", near).where(F.col("near") <= radius)
        sent = sent.select("query", "segment", F.col("target").alias("block"), F.col("part").cast("long"), "low", "near")
        found = index.groupBy(*keys).cogroup(sent.groupBy(*keys))
        found = found.applyInArrow(_search(cut, radius, k), "query binary, code binary, distance int, least long")
        if best is not None:
            found = found.unionByName(best.join(active, "query"))
        by_query = Window.partitionBy("query").orderBy("distance", "least")
        found = found.distinct().withColumn("place", F.row_number().over(by_query)).where(F.col("place") <= k).drop("place")
        best = staged(found, "hamming-best")
        ids = best.join(entries.select("code", "ids"), "code").select("query", "distance", F.explode("ids").alias("neighbor_id"))
        by_id = Window.partitionBy("query").orderBy("distance", "neighbor_id")
        ids = ids.withColumn("rank", F.row_number().over(by_id)).where(F.col("rank") <= k)
        covered = len(cut) * (radius + 1)
        last = covered > bits
        ids = ids.withColumn("far", F.max(F.when(F.col("rank") == k, F.col("distance"))).over(Window.partitionBy("query")))
        ids = staged(ids.withColumn("done", F.lit(last) | (F.coalesce("far", F.lit(bits + 1)) < covered)), "hamming-ranked")
        finished = ids.where("done").select("query", "rank", "neighbor_id", "distance")
        done = finished if done is None else done.unionByName(finished)
        active = active.join(ids.where("done").select("query").distinct(), "query", "left_anti")
        active = staged(active, "hamming-active")
        if last or not active.limit(1).count():
            break
    named = asked.select(F.col("id").alias("query_id"), F.col("code").alias("query"))
    return named.join(done, "query").select("query_id", "rank", "neighbor_id", "distance")
