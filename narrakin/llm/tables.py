"""Small helpers that the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def row_hash(column: Column) -> Column:
    """A number to spread rows by, from the content of the row."""
    return F.xxhash64(column)


def bounded_sample(df: DataFrame, key: Column, rows: int, of: int | None = None) -> DataFrame:
    """At most `rows` rows, those with the smallest hashes of a key: the same ones at every run.

    of: number of rows of df, counted if it is not given. Only rows below a hash that leaves a few
    more than wanted are put in order, so what the last task merges does not grow with the input.
    """
    of = df.count() if of is None else of
    share = min(1.0, (rows + 6 * rows ** 0.5 + 100) / max(of, 1))
    order = df.withColumn("_order", F.xxhash64(key, F.lit(20)))
    return order.where(F.col("_order") <= int(2 ** 63 * (2 * share - 1)) - 1).orderBy("_order").limit(rows).drop("_order")
