"""Token ids as directly addressable codes: any token of a file is read without decoding the ones before it.

An id is cut into 8-bit chunks, the lowest first. Level k holds the k-th chunk of every id that has one, in order,
and a bitmap that tells which of them go on in level k + 1; the place there is the number of ones before, found by a
rank directory with a count for every 512 bits. A shard file is

    magic "DAC1", then int64: documents, tokens, levels, and per level its number of chunks
    document ids (int64; a bitmap of nulls before them), first token of every document and the end (int64)
    per level: chunks (uint8), continuation bits (uint8, lowest bit first, whole 64-byte blocks), ranks (int64)

all little-endian. Shards are written by the tasks of a range partitioning by doc_id through ``pyarrow.fs``, each
under a name of its own; only those in the manifest, a Parquet table that Spark commits, belong to the result.

Defined results: null and empty texts have only the closing id; documents lie in ascending doc_id, nulls first,
repeated ids by text; an empty table gives no shards.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lagloom.llm.batches import pieces
from lagloom.llm.bpe import codec

MAGIC = b"DAC1"
BLOCK_BITS = 512
SHARD_TOKENS = 4_000_000
END_ID = 1

MANIFEST = "part int, shard int, documents long, tokens long, path string"


class Level(NamedTuple):
    chunks: np.ndarray
    bits: np.ndarray
    ranks: np.ndarray


def encode_levels(ids: np.ndarray) -> list[Level]:
    """The levels of the ids; the last one has no ones in its bitmap."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest >> np.uint32(8) > 0
        padded = np.zeros(-(-max(len(rest), 1) // BLOCK_BITS) * BLOCK_BITS, dtype=bool)
        padded[: len(rest)] = more
        bits = np.packbits(padded, bitorder="little")
        ones = padded.reshape(-1, BLOCK_BITS).sum(axis=1)
        levels.append(Level((rest & np.uint32(255)).astype(np.uint8), bits, np.cumsum(ones) - ones))
        rest = rest[more] >> np.uint32(8)
        if not len(rest):
            return levels


def decode_levels(levels: list[Level]) -> np.ndarray:
    """All ids of a file: every level is laid over the flagged places of the one before."""
    values = None
    for level in reversed(levels):
        here = level.chunks.astype(np.uint32)
        if values is not None:
            flags = np.unpackbits(level.bits, bitorder="little")[: len(here)].astype(bool)
            here[flags] |= values << np.uint32(8)
        values = here
    return values


def pack_shard(doc_ids: list, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    levels = encode_levels(ids)
    nulls = np.packbits([d is None for d in doc_ids], bitorder="little")
    header = struct.pack(f"<{3 + len(levels)}q", len(doc_ids), len(ids), len(levels), *(len(v.chunks) for v in levels))
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype("<i8")
    own = np.array([d or 0 for d in doc_ids], dtype="<i8")
    body = [MAGIC, header, nulls.tobytes(), own.tobytes(), starts.tobytes()]
    for level in levels:
        body += [level.chunks.tobytes(), level.bits.tobytes(), level.ranks.astype("<i8").tobytes()]
    return b"".join(body)


class Shard:
    """A shard file opened for random access; only the header and the document table are read at once."""

    def __init__(self, file: pa.NativeFile) -> None:
        self.file = file
        head = file.read_at(4 + 24, 0)
        if head[:4] != MAGIC:
            raise ValueError("not a token file of this format")
        self.documents, self.tokens, levels = struct.unpack("<3q", head[4:])
        self.counts = struct.unpack(f"<{levels}q", file.read_at(8 * levels, 28))
        at = 28 + 8 * levels
        nulls = np.unpackbits(np.frombuffer(file.read_at(-(-self.documents // 8), at), np.uint8), bitorder="little")
        at += -(-self.documents // 8)
        ids = np.frombuffer(file.read_at(8 * self.documents, at), dtype="<i8")
        self.doc_ids = [None if null else int(d) for d, null in zip(ids, nulls)]
        at += 8 * self.documents
        self.starts = np.frombuffer(file.read_at(8 * (self.documents + 1), at), dtype="<i8")
        at += 8 * (self.documents + 1)
        self.places = []
        for count in self.counts:
            blocks = -(-max(count, 1) // BLOCK_BITS)
            self.places.append((at, at + count, at + count + blocks * BLOCK_BITS // 8))
            at = self.places[-1][2] + 8 * blocks

    def token(self, i: int) -> int:
        """The i-th id: one chunk, one block of bits and one rank for every level it has."""
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        value = 0
        for k, (chunks, bits, ranks) in enumerate(self.places):
            value |= self.file.read_at(1, chunks + i)[0] << (8 * k)
            block, inside = divmod(i, BLOCK_BITS)
            word = int.from_bytes(self.file.read_at(BLOCK_BITS // 8, bits + block * BLOCK_BITS // 8), "little")
            if not word >> inside & 1:
                break
            rank = struct.unpack("<q", self.file.read_at(8, ranks + 8 * block))[0]
            i = rank + (word & ((1 << inside) - 1)).bit_count()
        return value

    def document(self, k: int) -> list[int]:
        """The ids of the k-th document, read one by one."""
        return [self.token(i) for i in range(int(self.starts[k]), int(self.starts[k + 1]))]

    def all(self) -> np.ndarray:
        levels = []
        for count, (chunks, bits, ranks) in zip(self.counts, self.places):
            own = np.frombuffer(self.file.read_at(count, chunks), np.uint8)
            levels.append(Level(own, np.frombuffer(self.file.read_at(ranks - bits, bits), np.uint8), None))
        return decode_levels(levels)


def open_shard(path: str) -> Shard:
    system, place = pafs.FileSystem.from_uri(path)
    return Shard(system.open_input_file(place))


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the token ids of all texts below ``folder`` (a URI every executor can write); returns the manifest.

    Rows are dealt by ranges of doc_id, so shards in the order (part, shard) hold ascending documents.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(tokenizer)
        part = TaskContext.get().partitionId()
        system, place = pafs.FileSystem.from_uri(folder)
        system.create_dir(place)
        end = np.array([end_id], dtype="<u4").tobytes()
        doc_ids, lengths, ids, size, shard = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            name = f"{part:06d}-{shard:04d}-{uuid.uuid4().hex}.dac"
            body = pack_shard(doc_ids, np.array(lengths), np.frombuffer(b"".join(ids), dtype="<u4"))
            with system.open_output_stream(f"{place}/{name}") as out:
                out.write(body)
            row = [part, shard, len(doc_ids), size, f"{folder}/{name}"]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string())
            return pa.record_batch([pa.array([v], k) for v, k in zip(row, kinds)], names=["part", "shard", "documents", "tokens", "path"])

        for piece in pieces(batches):
            for doc_id, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                own = b"".join(map(code.words.__getitem__, code.split(text))) + end
                doc_ids.append(doc_id)
                ids.append(own)
                lengths.append(len(own) // 4)
                size += lengths[-1]
                if size >= SHARD_TOKENS:
                    yield flush()
                    doc_ids, lengths, ids, size, shard = [], [], [], 0, shard + 1
        if doc_ids:
            yield flush()

    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select("doc_id", "text").repartitionByRange(parts, F.col("doc_id").asc_nulls_first())
    found = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text").mapInArrow(write, MANIFEST)
    found.write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32 of every document, from the files."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard file
    placed = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = open_shard(path)
                ids = shard.all().astype("<u4")
                starts = shard.starts
                crcs = [zlib.crc32(ids[a:b].data) for a, b in zip(starts[:-1], starts[1:])]
                yield pa.record_batch(
                    [pa.array(shard.doc_ids, pa.int64()), pa.array(starts[:-1] + base), pa.array(np.diff(starts)), pa.array(crcs, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    files = max(1, min(manifest.count(), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    spread = placed.select("path", "base").repartition(files)
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
