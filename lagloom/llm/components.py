"""Connected components of an edge table: smallest label by neighbours, with shortcuts, in written rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagloom.llm.staging import staged_at
from lagloom.session import remove_path

#: Edges that a task holds at once while it reduces them.
HELD_EDGES = 200_000


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (smallest id of its component, id) that connect what the given edges connect: fewer than there are ids."""
    ids, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = places[: len(a)], places[len(a) :]
    label = np.arange(len(ids))
    while True:
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], least)
        np.minimum.at(new, label[right], least)
        while ((further := new[new]) != new).any():
            new = further
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(ids))
    return ids[label[other]], ids[other]


def spanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges (a, b) as stars, reduced again and again as they come."""
    a = b = np.zeros(0, dtype=np.int64)
    for batch in batches:
        a, b = np.concatenate([a, batch.column(0).to_numpy()]), np.concatenate([b, batch.column(1).to_numpy()])
        if len(a) > HELD_EDGES:
            a, b = stars(a, b)
            if 2 * len(a) > HELD_EDGES:
                yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])
                a, b = a[:0], b[:0]
    if len(a):
        a, b = stars(a, b)
        yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])


def contracted(edges: DataFrame) -> DataFrame:
    """Edges with the same components, about as many as there are ids: edges of one id meet in a task and become stars."""
    own = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return own.mapInArrow(spanning, "a long, b long").repartition("b").mapInArrow(spanning, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in the edges (a, b); the component is its smallest id.

    A round takes for every id the smallest label among its neighbours' and its own, then the label of that label. Both
    steps reduce per task before the shuffle, so an id with very many edges is no hot key; labels and edges are joined
    by equality, where adaptive execution splits large partitions. Each round is written to the shared folder.
    """
    spark = edges.sparkSession
    edges, first = staged_at(contracted(edges), "components-edges")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both, around = staged_at(both.where("a <> b").distinct(), "components-edges")
    remove_path(spark, first)
    labels = both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("label"))
    labels, written = staged_at(labels, "components-labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        near = labels.join(near, "id").select("id", "label", F.least("label", "near").alias("near"))
        roots = labels.select(F.col("id").alias("near"), F.col("label").alias("far"))
        following = near.join(roots, "near").select("id", F.least("near", "far").alias("next"), "label")
        following, path = staged_at(following, "components-labels")
        remove_path(spark, written)  # of the round before
        written = path
        moved = following.where("next <> label").limit(1).count()
        labels = following.select("id", F.col("next").alias("label"))
        if not moved:
            remove_path(spark, around)
            return labels.withColumnRenamed("label", "component")
