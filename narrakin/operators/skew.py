"""Lookups that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrakin.session import settle

# 500,000 keys of a few characters, with a few numbers, are some tens of megabytes.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
SALTS = 64
# Rows that a repeated table may have in all; one with more is not repeated, and adaptive joins split its hot keys.
SALTED_ROWS = 8_000_000
# A hot key is spread over one salt for so many of its rows.
SALT_ROWS = 200_000
HOT_SHARE = 0.001


def lookup_rows(names: DataFrame) -> int:
    """Rows of a table of names for lookup_join, or more than it broadcasts if their bytes are many."""
    size = sum(F.octet_length(F.col(c).cast("string")) for c in names.columns) + 32
    rows, size = names.agg(F.count("*"), F.sum(F.coalesce(size, F.lit(32)))).first()
    return rows if (size or 0) <= BROADCAST_BYTES else max(rows, BROADCAST_ROWS + 1)


def lookup_join(left: DataFrame, right: DataFrame, keys: Sequence[str], right_rows: int,
                salt_on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join to a dictionary-like table whose row count is known.

    Up to BROADCAST_ROWS it is broadcast. Beyond that it is repeated once per salt, as often as
    SALTED_ROWS allow, and the left rows of a key spread over the salts by a hash of ``salt_on``.
    The hint keeps it from being broadcast after all: estimates of sizes do not see that it is repeated.
    """
    if right_rows <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), list(keys), how)
    salts = max(1, min(SALTS, SALTED_ROWS // max(1, right_rows)))
    salted = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    return (left.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), F.lit(salts)).cast("int"))
            .join(salted, [*keys, "_salt"], how).drop("_salt"))


def fan_out_join(rows: DataFrame, results: DataFrame, counts: DataFrame, keys: Sequence[str],
                 salt_on: Sequence[str], how: str = "left") -> DataFrame:
    """Give every row what is known about its key.

    ``results`` has a few lines per key at most and ``counts`` the number of rows per
    key in ``n_rows``. A key is hot when it holds more than HOT_SHARE of all rows, so there
    are at most 1 / HOT_SHARE hot keys and broadcasting them is safe at any size.
    Their results are repeated per salt, of which there are more the more rows a key
    has; all other keys use salt 0.
    """
    keys = list(keys)
    total = counts.agg(F.sum("n_rows").alias("_total"))
    hot = F.broadcast(
        counts.select(*keys, "n_rows").join(F.broadcast(total), F.lit(True))
        .filter(F.col("n_rows") > F.col("_total") * HOT_SHARE)
        .select(*keys, F.greatest(F.lit(SALTS), F.ceil(F.col("n_rows") / SALT_ROWS)).cast("int").alias("_salts")))
    spread = F.pmod(F.xxhash64(*salt_on), F.col("_salts")).cast("int")
    left = (rows.join(hot, keys, "left")
            .withColumn("_salt", F.when(F.col("_salts").isNotNull(), spread).otherwise(0))
            .drop("_salts"))
    right = (results.join(hot, keys, "left")
             .withColumn("_salt", F.explode(F.sequence(
                 F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
             .drop("_salts"))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def company_join(rows: DataFrame, companies: DataFrame, key: str, n_bytes: int,
                 salt_on: Sequence[str]) -> DataFrame:
    """Inner join to a company table of known size, whose favourites may be hot."""
    if n_bytes <= BROADCAST_BYTES:
        return rows.join(F.broadcast(companies), key)
    rows = settle(rows, "rows")
    counts = rows.groupBy(key).agg(F.count("*").alias("n_rows"))
    return fan_out_join(rows, companies, counts, [key], salt_on, "inner")
