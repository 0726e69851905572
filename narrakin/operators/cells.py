"""Nearest vectors by way of stored cells: exact by bounds on angles, or in a few cells for a stated recall.

Vectors lie in cells around centres, in two levels: coarse groups, whose centres are sent to every task,
and the cells of each group, which are joined by group. A cell keeps the greatest angle between its
centre and its vectors. Angles obey the triangle inequality, so no vector of a cell can be more similar
to a query than the cosine of the query's angle to the centre less that radius.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrakin.operators.blocks import DECIMALS, SCORE_CELLS, TARGET_BLOCK, DenseTargets, bucket_search, unit_rows
from narrakin.session import in_slices, scratch_path, send, settle, temporary_tables

#: Vectors aimed at per cell, and cells per group.
CELL_ROWS, GROUP_CELLS = 1024, 128
#: The centres of groups are fitted on at most so many numbers (vectors times dimensions) chosen by
#: hash, those of the cells of a group on about so many of its vectors for each cell.
SAMPLE_NUMBERS, SAMPLE_ROWS = 2_000_000, 32
#: Rows of one side that are placed or ranked in one task.
PART_ROWS = 16_384
#: Cells that a query visits in each wave, in order of their bounds; the last wave takes all that can still matter.
WAVES = (2, None)
#: Stored vectors that the number of probes is measured on.
CALIBRATION_ROWS = 256
#: Pairs of a query and a cell, and of a query and a group, that queries searched in one slice may have, for every eight cores.
SLICE_PAIRS, SLICE_NEAR = 1 << 26, 1 << 22
_SLACK = 1e-9


@dataclass(frozen=True)
class CellIndex:
    """groups: group, centre, radius; cells: group, cell, centre, radius, n; rows: cell, target, vector."""

    groups: DataFrame
    cells: DataFrame
    rows: DataFrame

    def paths(self, folder: str) -> None:
        """Write all tables below a folder."""
        for name in ("groups", "cells", "rows"):
            getattr(self, name).write.mode("overwrite").parquet(f"{folder}/{name}")


def load_cells(spark: SparkSession, folder: str) -> CellIndex:
    return CellIndex(*[spark.read.parquet(f"{folder}/{name}") for name in ("groups", "cells", "rows")])


def spherical_means(sample: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Unit centres of unit vectors by spherical k-means, started from vectors at even steps of the sample."""
    centres = sample[np.linspace(0, len(sample) - 1, min(count, len(sample))).astype(np.int64)].copy()
    for _ in range(rounds):
        nearest = np.concatenate([(sample[i:i + 4096] @ centres.T).argmax(1) for i in range(0, len(sample), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 1e-12, sums / np.maximum(length, 1e-12), centres)
    return np.unique(centres, axis=0)


def _matrix(column) -> np.ndarray:
    """Lists of one length as a matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def best_possible(cosines: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """The greatest cosine a vector can have with a query whose cosine with its centre is known."""
    return np.cos(np.maximum(0.0, _angles(cosines) - radii))


def _lists(matrix: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(matrix) + 1) * matrix.shape[1], pa.int32()), pa.array(matrix.ravel()))


def _hash_sample(df: DataFrame, by: str, share) -> DataFrame:
    """About such a share of the rows, by the hash of a column."""
    return df.where(F.pmod(F.xxhash64(by, F.lit(11)), F.lit(1 << 30)) < F.lit(1 << 30) * share)


def _in_parts(rows: DataFrame, other: DataFrame, row: str) -> tuple[DataFrame, DataFrame]:
    """Rows, which are a stored table, of each group cut into parts by counts, and the group's other side repeated for each part."""
    sizes = F.broadcast(rows.groupBy("group").agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias("parts")))
    left = rows.join(sizes, "group").withColumn("part", F.pmod(F.xxhash64(row), F.col("parts")).cast("int")).drop("parts")
    right = other.join(sizes, "group").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    return left, right


def _coarse_placer(centres):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                near = unit_rows(_matrix(batch.column("vector"))) @ centres.value.T
                yield pa.RecordBatch.from_arrays([
                    batch.column("target"), batch.column("vector"), pa.array(near.argmax(1)), pa.array(_angles(near.max(1)))],
                    names=["target", "vector", "group", "away"])
    return place


def _cell_fitter(key: tuple, group: pa.Table) -> pa.Table:
    """Centres of the cells of a group from a sample of its vectors."""
    centres = spherical_means(unit_rows(_matrix(group.column("vector"))), group.column("wanted")[0].as_py())
    return pa.table({"group": pa.array(np.full(len(centres), key[0].as_py(), np.int64)),
                     "cell": pa.array(key[0].as_py() * GROUP_CELLS * 2 + np.arange(len(centres))), "centre": _lists(centres)})


def _slices(rows: int, cells: int) -> Iterator[slice]:
    """Rows in slices whose products with that many cells are of bounded size."""
    step = max(1, SCORE_CELLS // max(cells, 1))
    for start in range(0, rows, step):
        yield slice(start, start + step)


def _cell_placer(rows: pa.Table, cells: pa.Table) -> pa.Table:
    cells = cells.sort_by("cell")
    at, away = np.empty(len(rows), np.int64), np.empty(len(rows))
    if len(rows):
        vectors, centres = unit_rows(_matrix(rows.column("vector"))), unit_rows(_matrix(cells.column("centre")))
        for some in _slices(len(rows), len(cells)):
            near = vectors[some] @ centres.T
            at[some] = np.round(near, DECIMALS).argmax(1)
            away[some] = _angles(near[np.arange(len(near)), at[some]])
    return pa.table({"group": rows.column("group"), "cell": cells.column("cell").take(pa.array(at)), "target": rows.column("target"),
                     "vector": rows.column("vector"), "away": pa.array(away)})


def build_cells(companies: DataFrame, company_id: str = "company_id", vector: str = "vector", cell_rows: int = CELL_ROWS,
                path: str | None = None) -> CellIndex:
    """Place vectors, all of one length, in cells and store them. Null vectors are left out.

    The centres come from bounded samples; every vector is placed. No step sends the vectors
    through the driver or one task, however many lie in one cell.
    """
    path = path or scratch_path(companies.sparkSession, "cells")
    with temporary_tables(companies.sparkSession):
        return _build_cells(companies, company_id, vector, cell_rows, path)


def _build_cells(companies: DataFrame, company_id: str, vector: str, cell_rows: int, path: str) -> CellIndex:
    spark = companies.sparkSession
    given = companies.where(F.col(vector).isNotNull()).select(F.col(company_id).alias("target"), F.col(vector).cast("array<double>").alias("vector"))
    n, dim = given.agg(F.count("*"), F.max(F.size("vector"))).first()
    id_type = given.schema["target"].dataType.simpleString()
    budget = max(1, SAMPLE_NUMBERS // max(1, dim or 1))
    some = _hash_sample(given, "vector", min(1.0, budget / max(n, 1))).select("vector").toArrow()
    sample = unit_rows(_matrix(some.column(0))) if len(some) else np.zeros((1, dim or 1))
    wanted = -(-n // (cell_rows * GROUP_CELLS))
    centres = spherical_means(sample, max(1, min(wanted, len(sample) // 8)))
    state = send(spark, centres)
    grouped = settle(given.mapInArrow(_coarse_placer(state), f"target {id_type}, vector array<double>, group long, away double"), "grouped")
    sizes = settle(grouped.groupBy("group").agg(F.count("*").alias("n"), F.max("away").alias("radius")), "group-sizes")
    cells_wanted = F.least(F.lit(2 * GROUP_CELLS), F.ceil(F.col("n") / cell_rows)).cast("int")
    asked = grouped.join(F.broadcast(sizes.select("group", "n", cells_wanted.alias("wanted"))), "group")
    picked = _hash_sample(asked, "target", F.least(F.lit(1.0), F.col("wanted") * F.lit(SAMPLE_ROWS) / F.col("n")))
    one = asked.groupBy("group").agg(F.min(F.struct("vector", "wanted")).alias("o")).select("group", "o.*")  # no group goes without
    fitted = settle(picked.select("group", "vector", "wanted").unionByName(one).groupBy("group").applyInArrow(
        _cell_fitter, "group long, cell long, centre array<double>"), "fitted")
    left, right = _in_parts(grouped.drop("away"), fitted, "target")
    placed = left.groupBy("group", "part").cogroup(right.groupBy("group", "part")).applyInArrow(
        _cell_placer, f"group long, cell long, target {id_type}, vector array<double>, away double")
    placed = settle(placed.repartitionByRange("cell"), "placed")
    spread = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius"))
    of_group = spark.createDataFrame(pa.table({"group": pa.array(np.arange(len(centres))), "centre": _lists(centres)}))
    tables = {"groups": of_group.join(F.broadcast(sizes), "group").select("group", "centre", "radius"),
              "cells": fitted.join(spread, "cell").select("group", "cell", "centre", "radius", "n"),
              "rows": placed.select("cell", "target", "vector")}
    return CellIndex(*[settle(df, name, f"{path}/{name}") for name, df in tables.items()])


def cells_around(companies: DataFrame, centres: DataFrame, company_id: str = "company_id", vector: str = "vector",
                 path: str | None = None) -> CellIndex:
    """Cells around centres the caller supplies as (cell, vector), of a number that may be broadcast.

    A vector belongs to the centre with the highest cosine, rounded to nine digits, of equal ones to
    the smallest cell.
    """
    spark = companies.sparkSession
    given = companies.where(F.col(vector).isNotNull()).select(F.col(company_id).alias("target"), F.col(vector).cast("array<double>").alias("vector"))
    around = settle(centres.select(F.lit(0).cast("long").alias("group"), F.col("cell").cast("long").alias("cell"),
                                   F.col(vector).cast("array<double>").alias("centre")).orderBy("cell"), "centres")
    left, right = _in_parts(given.withColumn("group", F.lit(0).cast("long")), around, "target")
    placed = settle(left.groupBy("group", "part").cogroup(right.groupBy("group", "part")).applyInArrow(
        _cell_placer, f"group long, cell long, target {given.schema['target'].dataType.simpleString()}, vector array<double>, away double"), "placed")
    spread = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius"))
    held = settle(around.join(spread, "cell").select("group", "cell", "centre", "radius", "n"), "cells", f"{path}/cells" if path else None)
    # One group holds all: its radius rules nothing out.
    whole = held.groupBy("group").agg(F.first("centre").alias("centre"), F.lit(np.pi).alias("radius"))
    tables = {"groups": whole, "rows": placed.select("cell", "target", "vector")}
    groups, rows = (settle(df, name, f"{path}/{name}" if path else None) for name, df in tables.items())
    return CellIndex(groups, held, rows)


def _group_finder(state):
    """Groups that may hold something as similar to a query as it asks for."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, centres, radii = state.value
        for batch in batches:
            if len(batch):
                possible = best_possible(unit_rows(_matrix(batch.column("vector"))) @ centres.T, radii)
                rows, cols = np.nonzero(possible >= batch.column("least").to_numpy()[:, None] - _SLACK)
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).take(at) for i in range(3)] + [pa.array(groups[cols])], names=[*batch.schema.names, "group"])
    return find


def _cell_ranker(key: str, by_bound: bool, first: int | None):
    """Cells of a group that may hold something as similar as a query asks for, its first ones only if not all are wanted."""
    def some_ranked(vectors: np.ndarray, centres: np.ndarray, radii: np.ndarray, least: np.ndarray):
        near = vectors @ centres.T
        possible = best_possible(near, radii)
        sound = possible >= least[:, None] - _SLACK
        worth = np.round(possible if by_bound else near, DECIMALS)
        if first is not None and first < worth.shape[1]:
            bar = np.partition(np.where(sound, worth, -2.0), -first, axis=1)[:, -first]
            sound &= worth >= bar[:, None]
        at, cols = np.nonzero(sound)
        return at, cols, worth[at, cols]

    def rank(queries: pa.Table, cells: pa.Table) -> pa.Table:
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if len(queries) and len(cells):
            vectors, centres = unit_rows(_matrix(queries.column("vector"))), unit_rows(_matrix(cells.column("centre")))
            radii, least = cells.column("radius").to_numpy(), queries.column("least").to_numpy()
            for some in _slices(len(queries), len(cells)):
                at, cols, order = some_ranked(vectors[some], centres, radii, least[some])
                found.append((at + some.start, cols, order))
        at, cols, order = (np.concatenate(column) for column in zip(*found))
        return pa.table({key: queries.column(key).take(pa.array(at)), "cell": cells.column("cell").take(pa.array(cols)), "worth": pa.array(order)})
    return rank


def cells_in_order(asked: DataFrame, index: CellIndex, key: str, skip: int, take: int | None, by_bound: bool = True) -> DataFrame:
    """The next cells each query visits: (key, cell, place), best first, after the first `skip`.

    asked: key, vector, least. Cells that cannot hold a cosine of `least` are left out.
    """
    spark = asked.sparkSession
    known = index.groups.toArrow()
    if not len(known):
        return spark.createDataFrame([], T.StructType([asked.schema[key], T.StructField("cell", T.LongType()), T.StructField("place", T.IntegerType())]))
    state = send(spark, (known.column("group").to_numpy(), _matrix(known.column("centre")), known.column("radius").to_numpy()))
    kind = asked.schema[key].dataType.simpleString()
    near = settle(asked.select(key, "vector", "least").mapInArrow(
        _group_finder(state), f"{key} {kind}, vector array<double>, least double, group long"), "near-groups")
    left, right = _in_parts(near, index.cells.select("group", "cell", "centre", "radius"), key)
    ranked = left.groupBy("group", "part").cogroup(right.groupBy("group", "part")).applyInArrow(
        _cell_ranker(key, by_bound, None if take is None else skip + take), f"{key} {kind}, cell long, worth double")
    order = Window.partitionBy(key).orderBy(F.desc("worth"), "cell")
    placed = ranked.withColumn("place", F.row_number().over(order))
    if take is not None:
        placed = placed.where(F.col("place") <= skip + take)
    return placed.where(F.col("place") > skip).select(key, "cell", "place")


def _bundles(index: CellIndex) -> DataFrame:
    """(cell, bucket): neighbouring cells of a group that are searched together, so that a query's vector is sent once for all of them."""
    spark = index.cells.sparkSession
    n = index.cells.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = max(CELL_ROWS, min(TARGET_BLOCK, -(-n // (2 * spark.sparkContext.defaultParallelism))))
    before = F.sum("n").over(Window.partitionBy("group").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    bucket = F.col("group") * F.lit(1 << 20) + F.floor(F.coalesce(before, F.lit(0)) / rows)
    once = index.cells.groupBy("cell").agg(F.min("group").alias("group"), F.max("n").alias("n"))  # given cells may come twice
    return once.select("cell", bucket.alias("bucket"))


def _search(queries: DataFrame, pairs: DataFrame, index: CellIndex, key: str, k: int, floor: float) -> DataFrame:
    bundles = F.broadcast(settle(_bundles(index), "bundles"))
    wanted = pairs.repartition(key).join(bundles, "cell").groupBy(key, "bucket").agg(F.collect_list("cell").alias("cells"))
    asked = wanted.join(queries.select(key, "vector"), key)
    held = index.rows.join(bundles, "cell").select("bucket", "cell", "target", "vector")
    return bucket_search(asked, held, key, ["vector"], DenseTargets, k, floor)


def _best(found: DataFrame, key: str, k: int) -> DataFrame:
    order = Window.partitionBy(key).orderBy(F.desc("similarity"), F.asc("target"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _products(pairs: DataFrame, index: CellIndex) -> int:
    return pairs.join(index.cells.select("cell", "n"), "cell").agg(F.sum("n")).first()[0] or 0


def _slice_rows(index: CellIndex, per_query: int | None = None) -> int:
    """Queries of a slice, if each may visit so many cells, by default all."""
    most = max(1, index.cells.sparkSession.sparkContext.defaultParallelism // 8)
    return max(1, min(most * SLICE_PAIRS // max(1, per_query or index.cells.count()), most * SLICE_NEAR // max(1, index.groups.count())))


def cell_topk(queries: DataFrame, index: CellIndex, k: int, floor: float, key: str = "txn_id", vector: str = "vector",
              waves: Sequence[int | None] = WAVES, compared: list[int] | None = None) -> DataFrame:
    """The k most similar stored vectors of each query, exactly: (key, target, similarity, rank).

    Queries visit cells in order of their bounds, a few in each wave; after a wave only cells that
    can hold something better than the k-th best so far are visited. How many pairs of vectors each
    wave compares is counted if a list is given for it. Many queries are searched in slices, since the
    cells that all of them visit may grow with the square of the vectors.
    """
    queries = settle(queries.where(F.col(vector).isNotNull()).select(key, F.col(vector).cast("array<double>").alias("vector")), "cell-queries")
    counts = []

    def best(cut: Callable) -> DataFrame:
        counts.append(None if compared is None else [])
        return _best_in_waves(cut(queries), index, k, floor, key, waves, counts[-1])

    found = in_slices(queries, key, best, "cell-slices", _slice_rows(index))
    if compared is not None:
        compared += map(sum, zip(*counts))
    return found


def _best_in_waves(queries: DataFrame, index: CellIndex, k: int, floor: float, key: str, waves: Sequence[int | None], compared: list[int] | None) -> DataFrame:
    best, skip = None, 0
    for take in waves:
        asked = queries.withColumn("least", F.lit(float(floor)))
        if best is not None:
            reached = best.groupBy(key).agg(F.count("*").alias("have"), F.min("similarity").alias("kth")).where(F.col("have") >= k)
            asked = queries.join(reached, key, "left").select(key, "vector", F.greatest(F.lit(float(floor)), F.coalesce("kth", F.lit(-1.0))).alias("least"))
        pairs = settle(cells_in_order(asked, index, key, skip, take), "cell-pairs")
        if compared is not None:
            compared.append(_products(pairs, index))
        found = _search(queries, pairs, index, key, k, floor)
        found = found if best is None else found.unionByName(best.drop("rank"))
        best = _best(found, key, k)
        if take is not None:
            best, skip = settle(best, "cell-best"), skip + take
    return best


def probed_topk(queries: DataFrame, index: CellIndex, k: int, floor: float, probes: int, key: str = "txn_id",
                vector: str = "vector", compared: list[int] | None = None) -> DataFrame:
    """The k most similar vectors among those in the `probes` cells whose centres are nearest to a query.

    Similarities are exact. Cells that cannot hold a vector above the floor do not count as probes.
    How many pairs of vectors are compared is counted if a list is given for it.
    """
    queries = settle(queries.where(F.col(vector).isNotNull()).select(
        key, F.col(vector).cast("array<double>").alias("vector"), F.lit(float(floor)).alias("least")), "cell-queries")
    counts = []

    def best(cut: Callable) -> DataFrame:
        pairs = settle(cells_in_order(cut(queries), index, key, 0, probes, by_bound=False), "cell-pairs")
        counts.append(0 if compared is None else _products(pairs, index))
        return _best(_search(cut(queries), pairs, index, key, k, floor), key, k)

    found = in_slices(queries, key, best, "probe-slices", _slice_rows(index, probes))
    if compared is not None:
        compared.append(sum(counts))
    return found


def probes_for(index: CellIndex, recall: float, k: int, floor: float, rows: int = CALIBRATION_ROWS) -> int:
    """The least number of probes that finds such a share of true neighbours, measured on stored vectors.

    For a bounded sample of the stored vectors the exact search tells in which of their cells, in
    order of centres, their true neighbours lie, themselves left out. The share found has to exceed
    the recall by twice its standard error.
    """
    n = index.cells.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    picked = _hash_sample(index.rows, "target", min(1.0, rows / max(n, 1)))
    asked = settle(picked.select(F.monotonically_increasing_id().alias("_q"), F.col("target").alias("_own"), "vector",
                                 F.lit(float(floor)).alias("least")), "calibration")
    truth = cell_topk(asked.select("_q", "vector"), index, k + 1, floor, "_q").join(asked.select("_q", "_own"), "_q").where("target <> _own")
    order = cells_in_order(asked.drop("_own"), index, "_q", 0, None, by_bound=False)
    at = truth.join(index.rows.select("cell", "target"), "target").join(order, ["_q", "cell"]).groupBy("place").agg(F.count("*").alias("n")).orderBy("place").collect()
    total, found = sum(r["n"] for r in at), 0
    for r in at:
        found += r["n"]
        share = found / total
        if share - 2 * (share * (1 - share) / total) ** 0.5 >= recall:
            return r["place"]
    return max((r["place"] for r in at), default=1)
