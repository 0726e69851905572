"""Sparse vectors in blocks, of which a search skips those that cannot hold a better target.

A posting is a piece of a target and its weight. Targets are numbered so that similar ones lie together,
and every BLOCK of them is a block. Each piece lists the blocks it occurs in, with its greatest weight
there. The sum of those, weighted by the query, bounds the similarity of every target of the block; of
blocks that are scored all postings are read, which lie one after another.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrakin.operators.blocks import DECIMALS, HALF_UNIT
from narrakin.session import in_slices, send, settle, slot_keys

BLOCK = 32
#: Blocks that are scored before the k-th best so far rules out others.
FIRST_BLOCKS = 16
#: Pieces by which targets are put in order.
ORDER_PIECES = 20
#: Postings of one part of the company side, and queries that meet it in one task.
PART_POSTINGS, PART_QUERIES = 8_000_000, 262_144
#: Meetings of a query and a part that are dealt out in one shuffle, if two tasks for each core do not take more.
SLICE_MEETINGS = 1 << 22
SPARSE = ["grams", "weights"]
_SLACK = 1e-9


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def _flat(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each row's pieces begin and end, all pieces, and their weights."""
    grams, weights = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (table.column("grams"), table.column("weights")))
    sizes = np.diff(grams.offsets.to_numpy()) if len(grams) else np.empty(0, np.int64)
    return np.concatenate([[0], np.cumsum(sizes)]), grams.flatten().to_numpy(), weights.flatten().to_numpy()


def _similar_together(owner: np.ndarray, code: np.ndarray, frequency: np.ndarray, size: int) -> np.ndarray:
    """A new number for each target, by its pieces from the most frequent on.

    What many targets share then lies in few blocks, so that most blocks lack most pieces of a query.
    """
    rank = np.empty(len(frequency), np.int32)
    rank[np.argsort(-frequency, kind="stable")] = np.arange(len(frequency), dtype=np.int32)
    rank = (np.sort(owner.astype(np.int64) << 32 | rank[code]) & 0xFFFFFFFF).astype(np.int32)
    start = np.searchsorted(owner, np.arange(size + 1))
    keys = np.full((ORDER_PIECES, size), len(frequency), np.int32)
    for i in range(ORDER_PIECES):
        has = start[:-1] + i < start[1:]
        keys[i, has] = rank[start[:-1][has] + i]
    place = np.empty(size, np.int64)
    place[np.lexsort(keys[::-1])] = np.arange(size)
    return place


class PostingBlocks:
    """Sparse vectors of targets in blocks, and for each piece the blocks that hold it with its greatest weight there."""

    def __init__(self, table: pa.Table):
        ends, flat, weight = _flat(table)
        sizes = np.diff(ends)
        self.size = len(sizes)
        self.ids = table.column("target")
        self.order = np.unique(self.ids.to_numpy(), return_inverse=True)[1] if self.size else np.empty(0, np.int64)
        encoded = pa.array(flat, pa.int64()).dictionary_encode()
        del flat
        self.codes, place = np.unique(encoded.dictionary.to_numpy(), return_inverse=True)
        code = place.astype(np.int32)[encoded.indices.to_numpy()]
        del encoded
        owner = np.repeat(np.arange(self.size, dtype=np.int32), sizes)
        place = _similar_together(owner, code, np.bincount(code, minlength=len(self.codes)), self.size)
        del owner
        self.number = np.argsort(place)
        sizes = sizes[self.number]
        at = _ranges(ends[:-1][self.number], sizes)
        self.code, self.weight = code[at], weight[at]
        del code, weight, at
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.blocks = -(-self.size // BLOCK)
        cell = self.code.astype(np.int64) * max(self.blocks, 1) + np.repeat(np.arange(self.size) // BLOCK, sizes)
        order = np.argsort(cell)
        cell = cell[order]
        first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.empty(0, np.int64)
        self.most = np.maximum.reduceat(self.weight[order], first) if len(first) else np.empty(0)
        cell = cell[first]
        self.block = cell % max(self.blocks, 1)
        self.cells = np.searchsorted(cell, np.arange(len(self.codes) + 1) * max(self.blocks, 1))
        self.read = 0  # postings of a query's pieces in the blocks that were scored

    def _score(self, asked: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and similarities of the targets of some blocks; asked has the query's weight of every piece."""
        numbers = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
        numbers = numbers[numbers < self.size]
        sizes = self.first[numbers + 1] - self.first[numbers]
        numbers, sizes = numbers[sizes > 0], sizes[sizes > 0]
        spans = list(zip(self.first[blocks * BLOCK].tolist(), self.first[np.minimum(blocks * BLOCK + BLOCK, self.size)].tolist()))
        products = asked.take(np.concatenate([self.code[a:b] for a, b in spans]))
        products *= np.concatenate([self.weight[a:b] for a, b in spans])
        self.read += np.count_nonzero(products)
        return numbers, np.add.reduceat(products, np.cumsum(sizes) - sizes)

    def best(self, pieces: np.ndarray, weights: np.ndarray, k: int, bar: float, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Targets, by their place in what was given, and similarities: all of the k best that reach the bar, and some more.

        pieces are places in codes; asked is zero for every piece, and is left so.
        """
        spans = list(zip(self.cells[pieces].tolist(), self.cells[pieces + 1].tolist()))
        none = np.empty(0, np.int64), np.empty(0)
        if not spans:
            return none
        worth = np.concatenate([self.most[a:b] * w for (a, b), w in zip(spans, weights.tolist())])
        bounds = np.bincount(np.concatenate([self.block[a:b] for a, b in spans]), worth, self.blocks)
        waiting = np.flatnonzero(bounds >= bar - _SLACK)
        if not len(waiting):
            return none
        np.add.at(asked, pieces, weights)
        found = []
        if len(waiting) > 2 * FIRST_BLOCKS:
            bounds = bounds[waiting]
            high = np.argpartition(bounds, -FIRST_BLOCKS)
            found.append(self._score(asked, waiting[high[-FIRST_BLOCKS:]]))
            scores = found[0][1]
            if len(scores) >= k:
                bar = max(bar, np.partition(scores, -k)[-k])
            high = high[:-FIRST_BLOCKS]
            waiting = waiting[high[bounds[high] >= bar - _SLACK]]
        if len(waiting):
            found.append(self._score(asked, waiting))
        asked[pieces] = 0.0
        numbers, scores = (np.concatenate(part) for part in zip(*found))
        keep = scores >= bar - _SLACK
        return self.number[numbers[keep]], scores[keep]

    def search(self, queries, k: int, floor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query rows, target rows and similarities, rounded, of the k best of each query; ties go to the smaller id.

        queries: grams, weights and, if they are known, bars that the similarities have to reach.
        """
        ends, codes, weights = _flat(queries)
        bars = queries.column("bar").to_numpy() if "bar" in queries.schema.names else np.full(len(ends) - 1, floor)
        at = np.minimum(np.searchsorted(self.codes, codes), max(len(self.codes) - 1, 0))
        known = self.codes[at] == codes if len(self.codes) else np.zeros(len(codes), bool)
        ends = np.concatenate([[0], np.cumsum(known)])[ends]
        pieces, weights, asked = at[known], weights[known], np.zeros(len(self.codes))
        found = [self.best(pieces[a:b], weights[a:b], k, bar - HALF_UNIT, asked) for a, b, bar in zip(ends[:-1].tolist(), ends[1:].tolist(), bars.tolist())]
        rows = np.repeat(np.arange(len(found)), [len(at) for at, _ in found])
        at, scores = (np.concatenate([f[i] for f in found]) if found else np.empty(0, t) for i, t in enumerate((np.int64, float)))
        values = np.round(scores, DECIMALS)
        keep = np.flatnonzero(values >= floor)
        keep = keep[np.lexsort((self.order[at[keep]], -values[keep], rows[keep]))]
        place = np.arange(len(keep)) - np.searchsorted(rows[keep], rows[keep], side="left")
        keep = keep[place < k]
        return rows[keep], at[keep], values[keep]


def _matches(postings: PostingBlocks, queries, key: str, k: int, floor: float):
    rows, at, values = postings.search(queries, k, floor)
    names = queries.column(key)
    ids = postings.ids.take(pa.array(at))
    return [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (names.take(pa.array(rows)), ids)] + [pa.array(values)]


def _schema(queries: DataFrame, targets: DataFrame, key: str) -> T.StructType:
    return T.StructType([T.StructField(key, queries.schema[key].dataType),
                         T.StructField("target", targets.schema["target"].dataType), T.StructField("similarity", T.DoubleType())])


def search_in_one_part(queries: DataFrame, targets: DataFrame, key: str, k: int, floor: float) -> DataFrame:
    """(key, target, similarity) of the k best targets, when the caller has checked that all targets fit in one part."""
    state = send(queries.sparkSession, PostingBlocks(targets.select("target", *SPARSE).toArrow()))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(_matches(state.value, batch, key, k, floor), names=[key, "target", "similarity"])

    return queries.select(key, *SPARSE).mapInArrow(match, _schema(queries, targets, key))


def search_in_parts(queries: DataFrame, targets: DataFrame, key: str, k: int, floor: float, postings: int,
                    part_postings: int | None = None) -> DataFrame:
    """The same for targets of any number: each part of them meets each part of the queries in a task.

    Targets are dealt to parts of equal size by hash, whatever pieces they share. A query first meets
    one part; the k-th best it finds there is the bar for all others, which rules out most of their
    blocks. A task works on one pair of parts and returns at most k targets per query. Those others are
    met in slices of the queries, so that the disk in use grows with queries, not with queries times parts.
    """
    spark = queries.sparkSession
    parts = max(1, -(-postings // (part_postings or PART_POSTINGS)))
    queries = settle(queries.select(key, *SPARSE), "query-vectors")
    tasks = 2 * spark.sparkContext.defaultParallelism
    n_queries = queries.count()
    own = F.pmod(F.xxhash64("target", F.lit(5)), F.lit(parts)).cast("int").alias("part")
    placed = settle(targets.select("target", *SPARSE, own), "target-parts")
    home = F.pmod(F.xxhash64(key, F.lit(6)), F.lit(parts)).cast("int")

    def match(left: pa.Table, held: pa.Table) -> pa.Table:
        if not len(left) or not len(held):
            columns = [left.column(key).slice(0, 0), held.column("target").slice(0, 0), pa.array([], pa.float64())]
        else:
            columns = _matches(PostingBlocks(held), left, key, k, floor)
        return pa.table(columns, names=[key, "target", "similarity"])

    def met(asked: DataFrame, part: Column, meetings: int) -> DataFrame:
        q_parts = max(1, -(-meetings // (PART_QUERIES * parts)), -(-tasks // parts))
        slots = slot_keys(spark, parts * q_parts)
        slot = lambda part, q_part: F.get(slots, part * q_parts + q_part).alias("slot")
        left = asked.select(key, *SPARSE, "bar", slot(part, F.pmod(F.xxhash64(key, F.lit(7)), F.lit(q_parts)).cast("int")))
        right = placed.withColumn("q_part", F.explode(F.sequence(F.lit(0), F.lit(q_parts - 1)))).select(
            "target", *SPARSE, slot(F.col("part"), F.col("q_part")))
        sides = (side.repartition(parts * q_parts, "slot").groupBy("slot") for side in (left, right))
        return next(sides).cogroup(next(sides)).applyInArrow(match, _schema(queries, targets, key))

    floored = F.lit(float(floor)).alias("bar")
    found = met(queries.select(key, *SPARSE, floored), home, n_queries)
    if parts == 1:
        return found
    found = settle(found, "first-part")
    reached = found.groupBy(key).agg(F.count("*").alias("n"), F.min("similarity").alias("least")).where(F.col("n") >= k)
    every = F.explode(F.filter(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: p != home)).alias("part")
    most = max(SLICE_MEETINGS, PART_QUERIES * tasks)

    def others(cut: Callable) -> DataFrame:
        rest = cut(queries).join(cut(reached), key, "left").select(key, *SPARSE, F.coalesce("least", floored).alias("bar"), every)
        return met(rest, F.col("part"), min(most, n_queries * (parts - 1)))

    return found.unionByName(in_slices(queries, key, others, "other-parts", max(1, most // (parts - 1))))
