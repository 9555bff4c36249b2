"""Conversation prefix trie: every distinct sequence of first turns is a node of a table of minimal perfect hashes.

Conversations are rebuilt first: c begins with the first h turns of conversation c - c % 100 (h = crc32 of the decimal c,
modulo 6), then come its own turns after its first h.

1. *Digests.* A turn is a 128-bit number t; the first d turns have the digest sum of t_i * BASE^i modulo 2^127 - 1. Turns are sorted
   by range over (conv_id, turn, ...), each task sums its own, and one row per task tells the next ones what a
   conversation brings along, so a conversation with a third of all rows is spread over many tasks.
2. *Nodes.* Pairs (conversation, depth, digest) are aggregated by digest: members and the smallest one, its owner. Equal
   digests are verified to have one depth, one parent digest and one last turn.
3. *Pieces.* What only one conversation has is a bare chain, known without a table. The other nodes fall into levels by the
   order of magnitude of their members and bands of depth; a connected part of a level and band is a piece. A piece has
   at most LEVEL_BASE tips, whatever the trie's width, and one shard holds whole pieces.
4. *Tables.* A shard's digests get slots by a minimal perfect hash (verified: a slot holds its digest). Counts are
   scattered into flat arrays by slot, and children add to their parents through an array of parents' slots, deepest
   first. Sums of a piece's root are passed, added up by parent, to the level and band above. There are as many rounds
   as orders of magnitude times bands: a handful.

Defined results: turns are ordered by (turn, null first), ties by a digest of role and text; null roles and texts are empty; repeated rows
are turns of their own; rows without conv_id belong to no conversation; extra columns are ignored; an empty table has no
nodes. Negative ids have c % 100 of their sign, as in SQL.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lagloom.llm.batches import GOLDEN, mix64
from lagloom.llm.staging import arrow_schema, staged

MODULUS = (1 << 127) - 1
BASE = 0x5DEECE66D1B3C2A49F0E7D6C5B4A3921
_INVERSE = pow(BASE, -1, MODULUS)
#: Turns that a conversation takes over at most.
MOST_TAKEN = 5
LEVEL_BASE = 1000
BAND = 1 << 16
#: Nodes of a shard, about.
SHARD_NODES = 200_000

_EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()


@lru_cache(maxsize=1 << 16)
def power(n: int) -> int:
    return pow(BASE if n >= 0 else _INVERSE, abs(n), MODULUS)


def taken(conv_id: int) -> int:
    return zlib.crc32(str(conv_id).encode()) % (MOST_TAKEN + 1)


def turn_number(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()


def measured(turns: DataFrame) -> DataFrame:
    """conv_id, turn, a 128-bit number of role and text, and the text's code points."""
    kind = turns.schema["turn"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            numbers = [turn_number(r or "", t or "") for r, t in zip(roles, texts)]
            sizes = [len(t or "") for t in texts]
            columns = [batch.column(0), batch.column(1), pa.array(numbers, pa.binary()), pa.array(sizes, pa.int32())]
            yield pa.record_batch(columns, names=["conv_id", "turn", "number", "chars"])

    own = turns.where("conv_id is not null").select(F.col("conv_id").cast("long"), "turn", "role", "text")
    return own.mapInArrow(run, f"conv_id long, turn {kind}, number binary, chars int")


SUMMED = "conv_id long, part int, place long, total binary, number binary, chars int, edge boolean"


def summed_parts(turns: DataFrame) -> DataFrame:
    """Per turn its place in its conversation and the sum so far, both within its task; edge rows end a task's conversation."""
    schema = arrow_schema(SUMMED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        open_id, place, total, power, held = None, 0, 0, 1, None
        for batch in batches:
            rows = []
            for conv, number, chars in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if conv != open_id:
                    if held:
                        rows.append((*held, True))
                    open_id, place, total, power = conv, 0, 0, 1
                elif held:
                    rows.append((*held, False))
                place, power = place + 1, power * BASE % MODULUS
                total = (total + int.from_bytes(number) * power) % MODULUS
                held = conv, part, place, total.to_bytes(16), number, chars
            if rows:
                yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        if held:
            yield pa.record_batch([pa.array([v], f.type) for v, f in zip((*held, True), schema)], schema=schema)

    # equal rows are interchangeable; the last column lets many of them be spread too
    keys = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("number"), F.col("_row")]
    spread = turns.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    return spread.select("conv_id", "number", "chars").mapInArrow(run, SUMMED)


def carried(spark: SparkSession, parts: DataFrame) -> dict[int, tuple[int, int, int]]:
    """For each task that goes on with a conversation: its id, and the turns and sum that it had before.

    A conversation of several tasks ends one and begins the next, so a task tells no more than its smallest and
    largest id here: two rows a task reach the driver.
    """
    ends = parts.where("edge").groupBy("part").agg(F.min("conv_id").alias("first"), F.max("conv_id").alias("last"))
    own = parts.where("edge").join(F.broadcast(ends), "part").where("conv_id = first or conv_id = last")
    found, open_id, place, total = {}, None, 0, 0
    for row in own.select("part", "conv_id", "place", "total").orderBy("part", "conv_id").toLocalIterator():
        if row.conv_id == open_id:
            found[row.part] = (open_id, place, total)
        else:
            open_id, place, total = row.conv_id, 0, 0
        total = (total + power(place) * int.from_bytes(row.total)) % MODULUS
        place += row.place
    return found


def own_sums(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """conv_id, place (from 1), total (sum of all turns so far), number and chars of the turn."""
    parts = staged(summed_parts(staged(measured(turns), "trie-turns")), "trie-sums")
    before = spark.sparkContext.broadcast(carried(spark, parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            convs, own, places, totals = (batch.column(i).to_pylist() for i in range(4))
            for i, (conv, part) in enumerate(zip(convs, own)):
                start = before.value.get(part)
                if start and start[0] == conv:
                    totals[i] = ((start[2] + power(start[1]) * int.from_bytes(totals[i])) % MODULUS).to_bytes(16)
                    places[i] += start[1]
            columns = [batch.column(0), pa.array(places, pa.int64()), pa.array(totals, pa.binary()), *batch.columns[4:]]
            yield pa.record_batch(columns, names=["conv_id", "place", "total", "number", "chars"])

    own = parts.select("conv_id", "part", "place", "total", "number", "chars")
    return own.mapInArrow(run, "conv_id long, place long, total binary, number binary, chars int")


BEGUN = "conv_id long, skipped int, taken int, size long, add binary, lent array<struct<total:binary,number:binary,chars:int>>"


def beginnings(sums: DataFrame) -> DataFrame:
    """Per conversation: own turns left out, turns taken over (and these), rebuilt turns, what to add to its own sums."""
    first = F.when(F.col("place") <= MOST_TAKEN, F.struct("place", "total", "number", "chars"))
    own = sums.groupBy("conv_id").agg(F.count("*").alias("turns"), F.array_sort(F.collect_list(first)).alias("own"))
    asked = own.withColumn("leader", F.col("conv_id") - F.col("conv_id") % 100)
    asked = asked.join(own.select(F.col("conv_id").alias("leader"), F.col("own").alias("lent")), "leader", "left")
    schema = arrow_schema(BEGUN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, turns, own, lent in zip(*(batch.column(i).to_pylist() for i in range(4))):
                h = taken(conv)
                lent = [{k: t[k] for k in ("total", "number", "chars")} for t in (lent or [])[:h]]
                last = int.from_bytes(lent[-1]["total"]) if lent else 0
                skipped = int.from_bytes(own[h - 1]["total"]) if 0 < h <= len(own) else 0
                add = (last - skipped * power(len(lent) - h)) % MODULUS
                rows.append((conv, h, len(lent), len(lent) + max(0, turns - h), add.to_bytes(16), lent))
            yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return asked.select("conv_id", "turns", "own", "lent").mapInArrow(run, BEGUN)


PAIRS = "conv_id long, depth long, hi long, lo long, up_hi long, up_lo long, chars int, last boolean"


def _halves(digests: list[int]) -> list[pa.Array]:
    values = np.frombuffer(b"".join(d.to_bytes(16) for d in digests), dtype=">i8").astype(np.int64).reshape(-1, 2)
    return [pa.array(values[:, 0]), pa.array(values[:, 1])]


def rebuilt_pairs(sums: DataFrame, begun: DataFrame) -> DataFrame:
    """PAIRS: a row for every turn of every rebuilt conversation, with the digests up to it and up to the one before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            convs, depths, totals, numbers, shifts, adds = (batch.column(i).to_pylist() for i in range(6))
            digests, above = [], []
            for depth, total, number, shift, add in zip(depths, totals, numbers, shifts, adds):
                digest = (int.from_bytes(add) + int.from_bytes(total) * power(shift)) % MODULUS
                digests.append(digest)
                above.append((digest - int.from_bytes(number) * power(depth)) % MODULUS)
            columns = [batch.column(0), batch.column(1), *_halves(digests), *_halves(above), batch.column(6), batch.column(7)]
            yield pa.record_batch(columns, names=[part.split()[0] for part in PAIRS.split(", ")])

    shift = (F.col("taken") - F.col("skipped")).alias("shift")
    own = sums.join(begun.select("conv_id", "skipped", "taken", "size", "add"), "conv_id").where("place > skipped")
    own = own.select("conv_id", (F.col("place") + shift).alias("depth"), "total", "number", shift, "add", "chars", "size")
    lent = begun.select("conv_id", F.posexplode("lent").alias("at", "t"), "size")
    nothing = F.lit(bytes(16)).alias("add")
    lent = lent.select("conv_id", (F.col("at") + 1).cast("long").alias("depth"), "t.total", "t.number", F.lit(0).alias("shift"), nothing, "t.chars", "size")
    rows = own.unionByName(lent).withColumn("last", F.col("depth") == F.col("size")).drop("size")
    return rows.mapInArrow(run, PAIRS)


def node_table(pairs: DataFrame) -> DataFrame:
    """A row per digest: members, owner (the smallest), depth, parent digest, code points of the last turn."""
    whole = ["depth", "up_hi", "up_lo", "chars"]
    least = [F.min(c).alias(c) for c in whole]
    most = [F.max(c).alias(f"most_{c}") for c in whole]
    found = pairs.groupBy("hi", "lo").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("owner"), F.max(F.col("last").cast("int")).alias("ends"), *least, *most
    )
    equal = F.expr(" and ".join(f"{c} = most_{c}" for c in whole))
    checked = F.when(equal, F.col("n_convs")).otherwise(F.raise_error(F.lit("two prefixes have one digest")).cast("long"))
    return found.withColumn("n_convs", checked).drop(*(f"most_{c}" for c in whole))


class PerfectHash:
    """Slots 0 … n-1 for n distinct 128-bit keys: a key keeps the first level at which no other key meets it."""

    def __init__(self, hi: np.ndarray, lo: np.ndarray) -> None:
        order = np.lexsort((lo, hi))
        if ((np.diff(hi[order]) == 0) & (np.diff(lo[order]) == 0)).any():
            raise ValueError("keys are not distinct")
        self.salt = 0
        while len(np.unique(self._fold(hi, lo))) < len(hi):
            self.salt += 1
        folded, self.levels, base = self._fold(hi, lo), [], 0
        while len(folded):
            size = 2 * len(folded)
            places = self._place(folded, len(self.levels), size)
            alone = np.bincount(places, minlength=size) == 1
            self.levels.append((size, alone, base + np.cumsum(alone) - 1))
            base += int(alone.sum())
            folded = folded[~alone[places]]
        self.hi, self.lo = np.zeros(base, dtype=np.int64), np.zeros(base, dtype=np.int64)
        slots = self._slots(hi, lo)
        self.hi[slots], self.lo[slots] = hi, lo
        if (self.find(hi, lo) < 0).any():
            raise AssertionError("a slot holds another key")

    def _fold(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        return mix64(hi.view(np.uint64) + np.uint64(self.salt)) ^ mix64(lo.view(np.uint64) * GOLDEN + np.uint64(1))

    @staticmethod
    def _place(folded: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(folded + np.uint64((level + 1) * int(GOLDEN) % 2**64)) % np.uint64(size)).astype(np.int64)

    def _slots(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        folded, slots = self._fold(hi, lo), np.zeros(len(hi), dtype=np.int64)
        left = np.arange(len(hi))
        for level, (size, alone, ranks) in enumerate(self.levels):
            places = self._place(folded[left], level, size)
            here = alone[places]
            slots[left[here]] = ranks[places[here]]
            left = left[~here]
        return slots

    def find(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The slot of every key, -1 for keys that the table doesn't hold."""
        if not len(self.hi):
            return np.full(len(hi), -1)
        slots = self._slots(hi, lo)
        return np.where((self.hi[slots] == hi) & (self.lo[slots] == lo), slots, -1)


#: What pieces pass up to the parents of their roots.
SUMS = ("n_children", "n_leaves", "saved_tokens")
#: A node with what its piece and the pieces below say of it; ``top`` nodes are their pieces' roots.
NODES = (
    "hi long, lo long, up_hi long, up_lo long, owner long, depth long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, top boolean"
)


def shard_sums(shard: pa.Table, schema: pa.Schema) -> pa.RecordBatch:
    """NODES of a shard of whole pieces; n_children, n_leaves and saved_tokens come in as sums of the pieces below."""
    get = lambda name: shard.column(name).to_numpy()
    table = PerfectHash(get("hi"), get("lo"))
    slots = table.find(get("hi"), get("lo"))
    flat = {}
    for name in ("up_hi", "up_lo", "owner", "depth", "n_convs", "chars", "n_children", "n_leaves", "saved_tokens"):
        flat[name] = np.zeros(len(slots), dtype=np.int64)
        flat[name][slots] = get(name)
    parents, depth = table.find(flat["up_hi"], flat["up_lo"]), flat["depth"]
    inner = np.flatnonzero(parents >= 0)
    np.add.at(flat["n_children"], parents[inner], 1)
    flat["n_leaves"][flat["n_children"] == 0] = 1
    flat["saved_tokens"] += (flat["n_convs"] - 1) * flat["chars"]
    inner = inner[np.argsort(-depth[inner], kind="stable")]
    for level in np.split(inner, np.flatnonzero(np.diff(depth[inner])) + 1):
        for name in ("n_leaves", "saved_tokens"):
            np.add.at(flat[name], parents[level], flat[name][level])
    columns = {"hi": table.hi, "lo": table.lo, **flat, "top": parents < 0}
    return pa.record_batch([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def shared_nodes(pairs: DataFrame, nodes: DataFrame, single_tops: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """NODES of what several conversations share, the sums that pieces pass up, and the ends (hi, lo, conv_id) there.

    ``single_tops`` (up_hi, up_lo): the parents of the chains that only one conversation has.
    """
    several = nodes.where("n_convs > 1")
    level = F.expr("(length(cast(n_convs as string)) - 1) div 3").alias("level")  # LEVEL_BASE = 10^3
    inside = pairs.join(several.select("hi", "lo", "n_convs", "owner"), ["hi", "lo"])
    inside = inside.select("*", level, F.expr(f"depth div {BAND}").alias("band"))
    ends = inside.where("last").select("hi", "lo", "conv_id")
    piece = Window.partitionBy("conv_id", "level", "band").orderBy("depth")  # at most BAND rows
    roots = inside.select("*", F.first("hi").over(piece).alias("root_hi"), F.first("lo").over(piece).alias("root_lo"))
    own = roots.where("conv_id = owner").drop("conv_id", "last")
    own = staged(own, "trie-shared")
    passed = single_tops.select("up_hi", "up_lo", F.lit(1).alias("n_children"), F.lit(1).alias("n_leaves"), F.lit(0).alias("saved_tokens"))
    passed = staged(passed.groupBy("up_hi", "up_lo").agg(*(F.sum(c).alias(c) for c in SUMS)), "trie-passed")
    schema = arrow_schema(NODES)

    def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if shard := [b for b in batches if b.num_rows]:
            yield shard_sums(pa.Table.from_batches(shard), schema)

    found = None
    rounds = own.groupBy("level", "band").count().orderBy("level", F.desc("band")).collect()  # orders of magnitude x bands
    for at in rounds:
        here = own.where((F.col("level") == at.level) & (F.col("band") == at.band))
        below = passed.groupBy("up_hi", "up_lo").agg(*(F.sum(c).alias(c) for c in SUMS)).withColumnsRenamed({"up_hi": "hi", "up_lo": "lo"})
        filled = here.join(below, ["hi", "lo"], "left").fillna(0, list(SUMS))
        columns = ["hi", "lo", "up_hi", "up_lo", "root_hi", "root_lo", "owner", "depth", "n_convs", "chars", *SUMS]
        shards = max(1, -(-at["count"] // SHARD_NODES))
        dealt = filled.select(*columns).repartition(shards, "root_hi", "root_lo")
        done = staged(dealt.mapInArrow(accumulate, NODES), "trie-nodes")
        up = done.where("top").select("up_hi", "up_lo", F.lit(1).alias("n_children"), "n_leaves", "saved_tokens")
        passed = passed.unionByName(up)
        found = done if found is None else found.unionByName(done)
    return found, passed, ends


ENDS = "hi long, lo long, ends_sha256 string"


def end_digests(spark: SparkSession, ends: DataFrame) -> DataFrame:
    """ENDS: SHA-256 of the ascending ids of each node. Ids are sorted and joined by many tasks; one hashes what they wrote."""

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hi, lo, convs = (batch.column(i).to_numpy() for i in range(3))
            cuts = np.flatnonzero((np.diff(hi) != 0) | (np.diff(lo) != 0)) + 1
            starts, stops = [0, *cuts], [*cuts, len(hi)]
            texts = [",".join(map(str, convs[a:b].tolist())) for a, b in zip(starts, stops)]
            columns = [pa.array(hi[starts]), pa.array(lo[starts]), pa.array(convs[starts]), pa.array(texts, pa.string())]
            yield pa.record_batch(columns, names=["hi", "lo", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_node, state = None, None
        for batch in batches:
            rows = []
            for hi, lo, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (hi, lo) != open_node:
                    if state:
                        rows.append((*open_node, state.hexdigest()))
                    open_node, state = (hi, lo), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if rows:
                yield pa.record_batch([pa.array(list(c)) for c in zip(*rows)], names=["hi", "lo", "ends_sha256"])
        if state:
            yield pa.record_batch([pa.array([v]) for v in (*open_node, state.hexdigest())], names=["hi", "lo", "ends_sha256"])

    keys = ["hi", "lo", "conv_id"]
    joined = ends.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(join_ids, "hi long, lo long, first long, ids string")
    lined = joined.repartition("hi", "lo").sortWithinPartitions("hi", "lo", "first").select("hi", "lo", "ids")
    return lined.mapInArrow(digest, ENDS)


def prefix_trie(turns: DataFrame) -> DataFrame:
    """Per node conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    ``turns`` has the columns conv_id, turn, role and text.
    """
    spark = turns.sparkSession
    sums = own_sums(spark, turns)
    begun = staged(beginnings(sums), "trie-begun")
    pairs = staged(rebuilt_pairs(sums, begun), "trie-pairs")
    nodes = staged(node_table(pairs), "trie-nodes")
    at = F.struct("depth", "up_hi", "up_lo")
    chains = nodes.groupBy("owner").agg(F.min(at).alias("own"), F.min(F.when(F.col("n_convs") == 1, at)).alias("single"))
    chains = staged(chains, "trie-chains")
    found, passed, ends = shared_nodes(pairs, nodes, chains.where("single is not null").select("single.up_hi", "single.up_lo"))

    whole = begun.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("owner")).first()
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    least, n_convs = F.lit(whole.owner).cast("long"), F.lit(whole.n_convs).cast("long")
    root = passed.where("up_hi = 0 and up_lo = 0").agg(*(F.coalesce(F.sum(c), zero).alias(c) for c in SUMS))
    root = root.select(
        zero.alias("hi"),
        zero.alias("lo"),
        least.alias("owner"),
        zero.alias("depth"),
        n_convs.alias("n_convs"),
        "n_children",
        F.greatest("n_leaves", one).alias("n_leaves"),
        "saved_tokens",
    ).where(n_convs > 0)
    turnless = begun.where("size = 0").select(zero.alias("hi"), zero.alias("lo"), "conv_id")
    several = root if found is None else root.unionByName(found.drop("up_hi", "up_lo", "top"))
    several = several.join(end_digests(spark, ends.unionByName(turnless)), ["hi", "lo"], "left").drop("hi", "lo")
    ended = F.when(F.col("ends") == one, F.sha2(F.col("owner").cast("string"), 256)).alias("ends_sha256")
    children = (1 - F.col("ends")).cast("long").alias("n_children")
    single = nodes.where("n_convs = 1").select(
        "owner", "depth", "n_convs", children, one.alias("n_leaves"), zero.alias("saved_tokens"), ended
    )
    # only the first node of an owner's own has another owner's parent
    above = nodes.select(F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), F.col("owner").alias("above"))
    first = chains.select("owner", "own.*").withColumnRenamed("depth", "from")
    deep = first.where("from > 1").join(above, ["up_hi", "up_lo"])
    flat = first.where("from = 1").withColumn("above", least)  # below the root
    begins = deep.unionByName(flat, allowMissingColumns=True).select("owner", "from", "above")
    every = several.unionByName(single).join(begins, "owner", "left")
    parent = F.when(F.col("depth") == 0, None).when(F.col("depth") > F.col("from"), F.col("owner")).otherwise(F.col("above"))
    return every.select(
        F.col("owner").alias("conv_id"),
        "depth",
        parent.alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_EMPTY_DIGEST)).alias("ends_sha256"),
    )
