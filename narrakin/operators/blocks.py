"""Top-k similarity join inside buckets, in blocks of bounded size.

Both sides carry a bucket: a shared text piece, a hash of a vector, or one constant
for an exhaustive search. Only rows of one bucket meet. A bucket is cut into parts
on both sides by hashing row keys, and each pair of parts is one small group that
returns at most k lines per query, so no bucket is ever held or emitted whole. Buckets
that need no cutting share groups, because a group of a few rows costs as much time
as one of thousands.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrakin.operators.skew import lookup_join
from narrakin.session import settle

#: Rows of one side that meet in one group, and the numbers their vectors may hold; smaller buckets share groups of about so many rows.
QUERY_BLOCK = TARGET_BLOCK = 32_768
BLOCK_NUMBERS = 1 << 21
SHARED_ROWS = 6144
SCORE_CELLS = 1 << 20
DECIMALS = 9
HALF_UNIT = 0.5 * 10.0 ** -DECIMALS


def best_targets(scores: np.ndarray, order: np.ndarray, k: int, floor: float):
    """Rows, columns and rounded scores of the k best targets of each row.

    Scores are rounded before ranking so that equal sums added up in another order
    tie, and ties go to the target that comes first in ``order``.
    """
    least = np.full(len(scores), floor - HALF_UNIT)
    if scores.shape[1] > k:
        least = np.maximum(least, np.partition(scores, -k, axis=1)[:, -k] - 2 * HALF_UNIT)
    rows, cols = np.nonzero(scores >= least[:, None])
    values = np.round(scores[rows, cols], DECIMALS)
    keep = values >= floor
    rows, cols, values = rows[keep], cols[keep], values[keep]
    order = np.lexsort((order[cols], -values, rows))
    rows, cols, values = rows[order], cols[order], values[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
    first = place < k
    return rows[first], cols[first], values[first]


def unit_rows(vectors) -> np.ndarray:
    matrix = (vectors if getattr(vectors, "ndim", 1) == 2 else np.stack(vectors)).astype(np.float64)
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)


class DenseTargets:
    def __init__(self, vectors):
        self.matrix = unit_rows(vectors)
        self.size = len(self.matrix)

    def scores(self, vectors) -> np.ndarray:
        return unit_rows(vectors) @ self.matrix.T


def search(payload: list[list], targets, target_ids: np.ndarray, k: int, floor: float):
    """Query rows, targets and similarities of a block, a slice of bounded size at a time.

    Target ids may be of any type that can be put in order.
    """
    order = np.unique(target_ids, return_inverse=True)[1]
    step = max(1, SCORE_CELLS // max(targets.size, 1))
    found = []
    for start in range(0, len(payload[0]), step):
        scores = targets.scores(*[p[start:start + step] for p in payload])
        rows, cols, values = best_targets(scores, order, k, floor)
        found.append((rows + start, target_ids[cols], values))
    return [np.concatenate(column) for column in zip(*found, strict=True)]


def _first_of_each(rows: np.ndarray, ids: np.ndarray, values: np.ndarray, k: int):
    """The k best lines of each row, ties to the smaller id."""
    order = np.lexsort((np.unique(ids, return_inverse=True)[1], -values, rows))
    rows, ids, values = rows[order], ids[order], values[order]
    first = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < k
    return rows[first], ids[first], values[first]


def search_cells(vectors: np.ndarray, wanted, targets: np.ndarray, cells: np.ndarray, target_ids: np.ndarray, make_targets: Callable, k: int, floor: float):
    """As search, but each query meets only the targets of the cells it wants."""
    rows = np.repeat(np.arange(len(wanted)), [len(w) for w in wanted])
    asked = np.concatenate([*wanted, np.empty(0, np.int64)]).astype(np.int64)
    order = np.argsort(asked, kind="stable")
    asked, rows = asked[order], rows[order]
    by_cell = np.argsort(cells, kind="stable")
    held, starts = np.unique(cells[by_cell], return_index=True)
    found, waiting = [], 0
    for cell, here in zip(held, np.split(by_cell, starts[1:])):
        mine = rows[np.searchsorted(asked, cell):np.searchsorted(asked, cell, side="right")]
        if len(mine):
            at, ids, values = search([vectors[mine]], make_targets(targets[here]), target_ids[here], k, floor)
            found.append((mine[at], ids, values))
            waiting += len(at)
            if waiting > SCORE_CELLS:
                found = [_first_of_each(*[np.concatenate(column) for column in zip(*found)], k)]
                waiting = 0
    return _first_of_each(*[np.concatenate(column) for column in zip(*found)], k) if found else None


def _result_schema(queries: DataFrame, targets: DataFrame, key: str) -> T.StructType:
    return T.StructType([
        T.StructField(key, queries.schema[key].dataType),
        T.StructField("target", targets.schema["target"].dataType), T.StructField("similarity", T.DoubleType())])


def bucket_search(queries: DataFrame, targets: DataFrame, key: str, payload: list[str],
                  make_targets: Callable, k: int, floor: float) -> DataFrame:
    """Best targets per query, bucket and target part: (key, target, similarity).

    ``queries`` has bucket, key and payload columns, ``targets`` bucket, target and
    the same payload columns. A bucket may be several cells: if targets have a cell and queries
    the list of cells they want, in ``cells``, only those of a bucket are compared.
    """
    by_cell = "cells" in queries.columns

    def rows(df: DataFrame, name: str, *more: Column) -> DataFrame:
        return df.groupBy("bucket").agg(F.count("*").alias(name), *more)

    def parts(name: str, most: int) -> Column:
        most = F.least(F.lit(most), F.greatest(F.lit(1), F.floor(F.lit(BLOCK_NUMBERS) / F.greatest(F.lit(1), F.col("size")))))
        return F.ceil(F.col(name) / most).cast("int")

    size = F.max(F.size(payload[0])).alias("size")
    grid = settle(rows(queries, "q_rows").join(rows(targets, "t_rows", size), "bucket").select(
        "bucket", parts("q_rows", QUERY_BLOCK).alias("q_parts"), parts("t_rows", TARGET_BLOCK).alias("t_parts"),
        (F.col("q_rows") + F.col("t_rows")).alias("n")), "grid")
    whole = (F.col("q_parts") == 1) & (F.col("t_parts") == 1)
    sizes = grid.agg(F.count("*").alias("buckets"), F.sum(F.when(whole, F.col("n"))).alias("rows")).first()
    shared = max(4 * queries.sparkSession.sparkContext.defaultParallelism,
                 -(-(sizes["rows"] or 0) // SHARED_ROWS))

    def place(df: DataFrame, row: str, own: str, other: str) -> DataFrame:
        df = df.select(*[F.col(c).alias(c) for c in df.columns])  # both sides may be one table
        df = lookup_join(df, grid.drop("n"), ["bucket"], sizes["buckets"], salt_on=[row])
        return (df.withColumn("bin", F.when(whole, F.pmod(F.xxhash64("bucket"), F.lit(shared)))
                              .otherwise(-1 - F.col("bucket")))
                .withColumn(own, F.pmod(F.xxhash64(row), F.col(f"{own}s")).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)))
                .drop("q_parts", "t_parts"))

    def match(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        found = []
        t_rows = t.groupby("bucket").indices
        for bucket, q_at in q.groupby("bucket").indices.items():
            t_at = t_rows.get(bucket)
            if t_at is None:
                continue
            if by_cell:
                vectors, held = (np.stack(side[payload[0]].to_numpy()[at]) for side, at in ((q, q_at), (t, t_at)))
                best = search_cells(vectors, q["cells"].to_numpy()[q_at], held, t["cell"].to_numpy()[t_at], t["target"].to_numpy()[t_at], make_targets, k, floor)
                if best is not None:
                    found.append((q[key].to_numpy()[q_at[best[0]]], *best[1:]))
                continue
            prepared = make_targets(*[t[c].to_numpy()[t_at] for c in payload])
            at, ids, values = search([q[c].to_numpy()[q_at] for c in payload], prepared,
                                     t["target"].to_numpy()[t_at], k, floor)
            found.append((q[key].to_numpy()[q_at[at]], ids, values))
        if not found:
            return pd.DataFrame({key: [], "target": [], "similarity": []})
        names, ids, values = [np.concatenate(column) for column in zip(*found, strict=True)]
        return pd.DataFrame({key: names, "target": ids, "similarity": values})

    block = ["bin", "q_part", "t_part"]
    return (place(queries, key, "q_part", "t_part").groupBy(*block)
            .cogroup(place(targets, "target", "t_part", "q_part").groupBy(*block))
            .applyInPandas(match, _result_schema(queries, targets, key)))


def broadcast_search(queries: DataFrame, targets: DataFrame, key: str, payload: list[str],
                     make_targets: Callable, k: int, floor: float) -> DataFrame:
    """Same result when the caller has checked that the targets fit in one block."""
    table = targets.select("target", *payload).toArrow()
    ids = table["target"].to_numpy()
    if len(ids) == 0:
        return queries.sparkSession.createDataFrame([], _result_schema(queries, targets, key))
    lists = [[np.asarray(v) for v in table[c].to_numpy()] for c in payload]
    index = queries.sparkSession.sparkContext.broadcast((ids, make_targets(*lists)))

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target_ids, prepared = index.value
        for batch in batches:
            if batch.empty:
                continue
            at, ids, values = search([batch[c].tolist() for c in payload], prepared, target_ids, k, floor)
            yield pd.DataFrame({key: batch[key].to_numpy()[at], "target": ids, "similarity": values})

    return queries.select(key, *payload).mapInPandas(match, _result_schema(queries, targets, key))
