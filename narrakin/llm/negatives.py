"""Hard negatives of anchors: vertical scans over dimensions that drop candidates by what can still come."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from narrakin.llm.whitening import all_finite
from narrakin.session import settle, ship_package

SCALE = 256
#: Scaled entries beyond this are taken as this, so that a score of 2,048 dimensions fits a long.
LARGEST = float(1 << 26)
POSITIVES, NEGATIVES = 5, 10
#: A negative has between so many hundredths of the positive's score.
WINDOW = (30, 90)
#: Numbers that one side of a block holds.
BLOCK_NUMBERS = 1_000_000
#: Dimensions read between two looks at the bounds.
READ = 8
_LAST = np.iinfo(np.int64).max


class Columns:
    """Vectors of a block turned round: one array per dimension, with its least and greatest entry."""

    def __init__(self, rows: np.ndarray):
        self.by_dim = np.ascontiguousarray(rows.T)
        self.least, self.most = rows.min(0), rows.max(0)

    def scan(self, anchor: np.ndarray, alive: np.ndarray, stays):
        """Positions and exact scores of the candidates that `stays` never drops.

        Dimensions are read in descending magnitude of the anchor's entries. After every few,
        `stays(lower, upper)` tells from the bounds of each score, which the least and greatest
        entries of the dimensions to come allow, which candidates of the bitmap `alive` remain.
        """
        order = np.argsort(-np.abs(anchor), kind="stable")
        to_come = _suffix(np.stack([anchor * self.least, anchor * self.most])[:, order])
        at, score = np.flatnonzero(alive), np.zeros(int(alive.sum()), np.int64)
        for start in range(0, len(order), READ):
            for dim in order[start:start + READ].tolist():
                column = self.by_dim[dim]
                score += anchor[dim] * (column if len(at) == len(column) else column[at])
            low, high = to_come[:, min(start + READ, len(order))]
            keep = stays(score + low, score + high)
            if not keep.all():
                at, score = at[keep], score[keep]
            if not len(at):
                break
        return at, score


def _suffix(ends: np.ndarray) -> np.ndarray:
    """Least and greatest sums of the contributions from each place on; zero after the last."""
    both = np.stack([ends.min(0), ends.max(0)])
    return np.concatenate([np.cumsum(both[:, ::-1], axis=1)[:, ::-1], np.zeros((2, 1), both.dtype)], axis=1)


def _kth(values: np.ndarray, k: int):
    """The k-th greatest, or None if there are fewer."""
    return np.partition(values, -k)[-k] if len(values) >= k else None


def highest(k: int):
    """Keeps what may be among the k highest scores, ties included."""
    def stays(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        bar = _kth(lower, k)
        return np.ones(len(lower), bool) if bar is None else upper >= bar
    return stays


def highest_within(k: int, windows: list[tuple[int, int]]):
    """Keeps what may be among the k highest scores of one of the windows, ties included."""
    def stays(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(lower), bool)
        for low, high in windows:
            sure = _kth(lower[(lower >= low) & (upper <= high)], k)
            keep |= (upper >= (low if sure is None else sure)) & (lower <= high)
        return keep
    return stays


def bounds(positive: int, window: tuple[int, int]) -> tuple[int, int]:
    """Least and greatest whole score of a negative of this positive; the first is above the second if there is none."""
    return -(-window[0] * positive // 100), window[1] * positive // 100


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(len(column), dim)


def _ids(group: pa.Table) -> np.ndarray:
    return group.column("vec_id").fill_null(_LAST).to_numpy()


def _result(found: list[tuple], group: pa.Table) -> pa.Table:
    """Rows (a, place, rid, vec_id, score) of the positions in `found`."""
    a, place, at, score = (np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(4))
    rows = pa.array(at.astype(np.int64))
    return pa.table({"a": pa.array(a.astype(np.int64)), "place": pa.array(place.astype(np.int32)), "rid": group.column("rid").take(rows),
                     "vec_id": group.column("vec_id").take(rows), "score": pa.array(score.astype(np.int64))})


def _sides(group: pa.Table) -> tuple[pa.Table, pa.Table]:
    asked = group.column("asked")
    return group.filter(asked), group.filter(pa.compute.invert(asked))


def _positive_finder(k: int):
    def find(key: tuple, group: pa.Table) -> pa.Table:
        anchors, rows = _sides(group)
        found = []
        if len(anchors) and len(rows):
            dim = key[0].as_py()
            columns, labels, rids, ids = Columns(_matrix(rows.column("x"), dim)), rows.column("label").to_numpy(), rows.column("rid").to_numpy(), _ids(rows)
            for anchor, label, rid in zip(_matrix(anchors.column("x"), dim), anchors.column("label").to_pylist(), anchors.column("rid").to_pylist()):
                at, score = columns.scan(anchor, (labels == label) & (rids != rid), highest(k))
                best = np.lexsort((rids[at], ids[at], -score))[:k]
                found.append((np.full(len(best), rid), np.zeros(len(best)), at[best], score[best]))
        return _result(found, rows)
    return find


def _negative_finder(k: int, window: tuple[int, int]):
    def find(key: tuple, group: pa.Table) -> pa.Table:
        anchors, rows = _sides(group)
        found = []
        if len(anchors) and len(rows):
            dim = key[0].as_py()
            columns, labels, rids, ids = Columns(_matrix(rows.column("x"), dim)), rows.column("label").to_numpy(), rows.column("rid").to_numpy(), _ids(rows)
            for anchor, label, rid, scores in zip(_matrix(anchors.column("x"), dim), anchors.column("label").to_pylist(),
                                                  anchors.column("rid").to_pylist(), anchors.column("scores").to_pylist()):
                windows = [bounds(s, window) for s in scores]
                at, score = columns.scan(anchor, labels != label, highest_within(k, windows))
                for place, (low, high) in enumerate(windows):
                    inside = np.flatnonzero((score >= low) & (score <= high))
                    best = inside[np.lexsort((rids[at[inside]], ids[at[inside]], -score[inside]))[:k]]
                    found.append((np.full(len(best), rid), np.full(len(best), place), at[best], score[best]))
        return _result(found, rows)
    return find


def _blocks(asked: DataFrame, rows: DataFrame, numbers: int) -> DataFrame:
    """Every block of anchors beside every block of rows of the same length, as groups (dim, i, j)."""
    per_block = F.greatest(F.lit(1), F.floor(F.lit(numbers) / F.greatest(F.lit(1), F.col("dim"))))
    count = lambda df, name: df.groupBy("dim").agg(F.ceil(F.count("*") / F.first(per_block)).cast("int").alias(name))
    grid = F.broadcast(settle(count(asked, "anchor_blocks").join(count(rows, "row_blocks"), "dim"), "negatives-grid"))
    own = lambda seed, blocks: F.pmod(F.xxhash64("rid", F.lit(seed)), F.col(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    columns = ["rid", "vec_id", "label", "x", "scores"]
    left = asked.join(grid, "dim").select("dim", own(1, "anchor_blocks").alias("i"), every("row_blocks").alias("j"), F.lit(True).alias("asked"), *columns)
    right = rows.withColumn("scores", F.lit(None).cast("array<long>")).join(grid, "dim").select(
        "dim", every("anchor_blocks").alias("i"), own(2, "row_blocks").alias("j"), F.lit(False).alias("asked"), *columns)
    return left.unionByName(right)


_FOUND = "a long, place int, rid long, vec_id long, score long"


def _first(found: DataFrame, keys: list[str], k: int, name: str) -> DataFrame:
    """The k best over all blocks; ties go to the smaller vec_id, then to the earlier row."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "rid")
    return found.withColumn(name, F.row_number().over(order).cast("int")).where(F.col(name) <= k)


def hard_negatives(spark: SparkSession, vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   window: tuple[int, int] = WINDOW, numbers: int = BLOCK_NUMBERS) -> DataFrame:
    """Rows of other labels that score nearly as high with an anchor as its own positives.

    vectors: vec_id, label (whole number), embedding array of numbers; is_anchor is a condition on
    these. Rows with a null label or vector, or with a null or non-finite entry, take no part. An
    entry x becomes floor(256 x), at most 2^26 either way; a score is an inner product. An anchor's
    positives are the best of the other rows of its label, its negatives for a positive the best of
    the rows of other labels with 30 to 90 hundredths of the positive's score. Ties go to the smaller
    vec_id (null last), then to the earlier row. Returns anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score. Vectors of different lengths are not compared; empty ones score
    0. Repeated rows are rows of their own, so a repeated anchor has its lines as often.

    Anchors and rows are cut into blocks by counts, and every block of anchors meets every block of
    rows of its length; a block returns at most k rows per anchor and window.
    """
    ship_package(spark)
    whole = lambda c: F.floor(F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), c * SCALE)))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("c"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    rows = settle(rows.where(F.col("label").isNotNull() & all_finite(F.col("c"))).select(
        F.monotonically_increasing_id().alias("rid"), "vec_id", "label", F.size("c").cast("long").alias("dim"),
        F.transform("c", whole).alias("x"), "anchor"), "negatives-rows")
    anchors, others = rows.where("anchor").drop("anchor"), rows.drop("anchor")
    asked = anchors.withColumn("scores", F.lit(None).cast("array<long>"))
    found = _blocks(asked, others, numbers).groupBy("dim", "i", "j").applyInArrow(_positive_finder(positives), _FOUND)
    best = settle(_first(found.drop("place"), ["a"], positives, "place"), "negatives-positives")
    scores = best.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("place", "score"))).alias("s")).select(
        F.col("a").alias("rid"), F.col("s.score").alias("scores"))
    asked = settle(anchors.join(scores, "rid"), "negatives-anchors")
    found = _blocks(asked, others, numbers).groupBy("dim", "i", "j").applyInArrow(_negative_finder(negatives, window), _FOUND)
    last = _first(found, ["a", "place"], negatives, "rank").select(
        "a", (F.col("place") + 1).alias("place"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = best.select("a", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return last.join(named, ["a", "place"]).join(asked.select(F.col("rid").alias("a"), F.col("vec_id").alias("anchor_id")), "a").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
