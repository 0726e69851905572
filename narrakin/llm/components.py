"""Connected components over an edge table, by alternating star rounds on Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrakin.session import settle

_EDGES = "a long, b long"


def forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the smallest node it reaches within these edges."""
    nodes, ends = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = ends[: len(left)], ends[len(left):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch of edges becomes a forest with the same components and no more edges than nodes."""
    for batch in batches:
        a, b = forest(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _large_star(edges: DataFrame, spark: SparkSession) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = settle(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low")), "star")
    return both.where("b > a").join(lowest, "a").where("b <> low").select(
        F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame, spark: SparkSession) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = settle(down.groupBy("a").agg(F.min("b").alias("low")), "star")
    moved = down.join(lowest, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(lowest.select("a", F.col("low").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Each node that has an edge to another, with the smallest node it can reach.

    edges: a long, b long, in either direction, repeats and loops allowed; rows with a null end
    are no edge. Returns node, component. No task holds the neighbours of a node: each star is a
    minimum per node and a join whose hot keys Spark may split. Every round is written to the
    shared folder, so a lost executor repeats one round at most. An empty edge table gives an
    empty result.
    """
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    edges = settle(edges.mapInArrow(_local, _EDGES).distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        edges = settle(_large_star(edges, spark), "edges")
        edges = settle(_small_star(edges, spark), "edges")
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = found.select("component").distinct().select(F.col("component").alias("node"), "component")
    return found.unionByName(roots)
