"""The k most similar companies of each text or vector."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrakin.operators.blocks import DenseTargets, broadcast_search, bucket_search
from narrakin.operators.cells import build_cells, cell_topk
from narrakin.operators.postings import search_in_one_part, search_in_parts
from narrakin.operators.skew import company_join, fan_out_join

PART_ROWS = 100_000
#: Numbers of company vectors that one search broadcasts; more are placed in cells.
BROADCAST_NUMBERS = 8_000_000


def keep_best(found: DataFrame, key: str, target: str, k: int) -> DataFrame:
    """Rank candidates by similarity, ties by id, and keep the first k."""
    order = Window.partitionBy(key).orderBy(F.desc("similarity"), F.asc(target))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select(key, target, "similarity", "rank"))


def company_texts(companies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct matching texts under their smallest company id, and all their members.

    A member's place counts the smaller ids of its text that were dealt to the same
    part; a text of many companies is dealt to several parts, so that no task ranks
    it whole. The first k members of a text are among those with place k or less.
    """
    texts = companies.groupBy("match_text").agg(F.min("company_id").alias("target"), F.count("*").alias("n_rows"))
    counts = texts.select("match_text", "n_rows")
    placed = fan_out_join(companies.select("match_text", "company_id"), texts, counts, ["match_text"], ["company_id"])
    part = F.pmod(F.xxhash64("company_id"), F.ceil(F.col("n_rows") / PART_ROWS)).alias("part")
    order = Window.partitionBy("target", "part").orderBy("company_id")
    members = placed.select("target", "company_id", part).withColumn("place", F.row_number().over(order))
    return texts.select("match_text", "target"), members.select("target", "company_id", "place")


def sparse_topk(queries: DataFrame, targets: DataFrame, members: DataFrame, postings: int,
                member_bytes: int, k: int, floor: float, index_postings: int, key: str = "match_text") -> DataFrame:
    """Exact top-k companies per query text: (key, company_id, similarity, rank).

    ``postings`` is the measured number of text pieces on the company side; up to
    ``index_postings`` the company side is one part that is sent to every task.
    """
    if postings <= index_postings:
        found = search_in_one_part(queries, targets, key, k, floor)
    else:
        found = keep_best(search_in_parts(queries, targets, key, k, floor, postings), key, "target", k)
        found = found.select(key, "target", "similarity")
    first = members.filter(F.col("place") <= k).select("target", "company_id")
    return keep_best(company_join(found, first, "target", member_bytes, [key]).drop("target"), key, "company_id", k)


def dense_numbers(companies: DataFrame, vector: str = "vector") -> int:
    """How many numbers the vectors of a table hold."""
    return companies.agg(F.sum(F.size(vector).cast("long"))).first()[0] or 0


def dense_topk(queries: DataFrame, companies: DataFrame, k: int, floor: float,
               query_id: str = "txn_id", company_id: str = "company_id",
               vector: str = "vector", numbers: int = BROADCAST_NUMBERS) -> DataFrame:
    """Exact top-k over supplied vectors, for company sides of any size.

    A company side of at most ``numbers`` numbers, by count, is one block that is sent to
    every task; a larger one is placed in cells, of which queries visit those that bounds
    do not rule out, and never leaves the tasks.
    """
    queries, companies = (df.filter(F.col(vector).isNotNull()) for df in (queries, companies))
    if dense_numbers(companies, vector) <= numbers:
        targets = companies.select(F.col(company_id).alias("target"), vector)
        found = broadcast_search(queries, targets, query_id, [vector], DenseTargets, k, floor)
        return keep_best(found.withColumnRenamed("target", company_id), query_id, company_id, k)
    found = cell_topk(queries, build_cells(companies, company_id, vector), k, floor, query_id, vector)
    return found.withColumnRenamed("target", company_id).select(query_id, company_id, "similarity", "rank")


def lsh_tables(bits: int, floor: float, recall: float) -> int:
    """Tables that let a pair at the floor share a bucket with probability ``recall``, at any size.

    One plane leaves two vectors at angle a on one side with probability 1 - a/pi.
    """
    together = (1 - math.acos(floor) / math.pi) ** bits
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - together)))


def sign_planes(size: int, planes: int, seed: int) -> np.ndarray:
    """Planes with components 1 or -1 by the first hex digit of md5('seed|plane|dimension')."""
    digit = [[hashlib.md5(f"{seed}|{p}|{d}".encode()).hexdigest()[0] for p in range(planes)] for d in range(size)]
    return np.where(np.array(digit) < "8", 1.0, -1.0)


def sign_buckets(tables: int, bits: int, seed: int):
    """For each table, which sides of the planes through the origin a vector is on."""
    known: dict[int, np.ndarray] = {}

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def buckets(vectors: pd.Series) -> pd.Series:
        matrix = np.stack(vectors.tolist()).astype(np.float64)
        size = matrix.shape[1]
        if size not in known:
            known[size] = sign_planes(size, tables * bits, seed)
        above = ((matrix @ known[size]) > 0).reshape(len(matrix), tables, bits)
        codes = above @ (1 << np.arange(bits)) + (np.arange(tables) << bits)
        return pd.Series(list(codes.astype(np.int64)))

    return buckets


def lsh_topk(queries: DataFrame, companies: DataFrame, k: int, floor: float, tables: int, bits: int,
             seed: int, query_id: str = "txn_id", company_id: str = "company_id",
             vector: str = "vector") -> DataFrame:
    """Approximate top-k: only vectors that share a bucket in some table are compared.

    More tables find more true neighbours, more bits make buckets smaller; see
    ``lsh_tables``. The similarity of every returned pair is exact.
    """
    hashed = sign_buckets(tables, bits, seed)

    def bucketed(df: DataFrame, own_id: str, name: str) -> DataFrame:
        return df.filter(F.col(vector).isNotNull()).select(F.explode(hashed(F.col(vector))).alias("bucket"),
                         F.col(own_id).alias(name), vector)

    found = bucket_search(bucketed(queries, query_id, query_id), bucketed(companies, company_id, "target"),
                          query_id, [vector], DenseTargets, k, floor)
    distinct = found.groupBy(query_id, "target").agg(F.max("similarity").alias("similarity"))
    return keep_best(distinct.withColumnRenamed("target", company_id), query_id, company_id, k)
