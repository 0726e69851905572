"""Best-fit packing of token sequences into bins of several permitted lengths."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrakin.llm.wordpiece import counter
from narrakin.session import settle, ship_package

#: Permitted sequence lengths, in tokens.
CAPACITIES = (512, 1024, 2048, 4096, 8192)
#: What a bin costs besides its tokens: setting up a sequence, in tokens.
BIN_COST = 16
#: Tokens that one shard packs. Shards are packed apart, so that none grows with the corpus.
SHARD_TOKENS = 8_000_000


def fill(sizes: list[int], capacities: tuple[int, ...], opening: int) -> list[tuple[int, list[int]]]:
    """Best-fit decreasing with bins opened at `opening`, or the least length that holds the item.

    Returns (length, item numbers) per bin, each bin shrunk to the least length for its contents.
    Open bins are kept by free room; one integer has a bit for each room in use, so the tightest
    bin is found by its lowest bit.
    """
    by_room: dict[int, list[int]] = {}
    rooms, bins = 0, []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[item]
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            stack = by_room[room]
            spot = stack.pop()
            if not stack:
                rooms ^= 1 << room
        else:
            room = next((c for c in capacities if c >= size and c >= opening), capacities[-1])
            spot = len(bins)
            bins.append([0, []])
        bins[spot][0] += size
        bins[spot][1].append(item)
        if room > size:
            by_room.setdefault(room - size, []).append(spot)
            rooms |= 1 << room - size
    return [(next(c for c in capacities if c >= used), items) for used, items in bins]


def best_fill(sizes: list[int], capacities: tuple[int, ...] = CAPACITIES, bin_cost: int = BIN_COST) -> list[tuple[int, list[int]]]:
    """The cheapest filling over all opening lengths; ties go to the shorter opening length.

    A bin costs its length plus bin_cost. Which length to open at is decided for the whole shard
    together, after the bins have been shrunk to their contents.
    """
    capacities = tuple(sorted(capacities))
    tries = [fill(sizes, capacities, opening) for opening in capacities]
    return min(tries, key=lambda bins: sum(c for c, _ in bins) + bin_cost * len(bins))


def _pack(capacities: tuple[int, ...], bin_cost: int):
    def shard(part: pa.Table) -> pa.Table:
        part = part.sort_by([("tokens", "descending"), ("doc_id", "ascending"), ("text_hash", "ascending"), ("piece", "ascending")])
        sizes = part.column("tokens").to_pylist()
        n = len(sizes)
        bins, length, offset = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for number, (capacity, items) in enumerate(best_fill(sizes, capacities, bin_cost)):
            at = 0
            for item in items:
                bins[item], length[item], offset[item] = number, capacity, at
                at += sizes[item]
        return pa.table({
            "doc_id": part.column("doc_id"), "piece": part.column("piece"), "piece_tokens": part.column("tokens"),
            "shard": part.column("shard"), "bin": bins, "bin_length": length, "bin_offset": offset})
    return shard


def pack(spark: SparkSession, docs: DataFrame, model_path: str, capacities: tuple[int, ...] = CAPACITIES,
         bin_cost: int = BIN_COST, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Place every document of docs (doc_id, text) into bins, by greedy word-piece tokens and an end token.

    A document longer than the longest permitted length is cut into pieces of that length and a
    rest; no token is dropped. Returns doc_id, piece (from 0), piece_tokens, shard, bin (numbered
    in its shard), bin_length, bin_offset: one row per piece. A null or empty text has its end token
    only. Repeated rows are placed each; equal sizes go by doc_id, then the hash of the text. Rows
    are dealt to shards by the hash of the row and a number drawn from it per repeat, so neither
    long nor repeated rows gather in one shard; the number of shards follows the tokens.
    """
    ship_package(spark)
    count = counter(spark, model_path)
    top = max(capacities)
    sized = settle(docs.select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        (count(F.coalesce("text", F.lit(""))).getField("n_tokens") + 1).alias("n")), "sizes")
    total, rows = sized.agg(F.sum("n"), F.count("*")).first()
    shards = max(1, -(-(total or 0) // shard_tokens))
    last = F.floor((F.col("n") - 1) / top)
    pieces = sized.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last))).select(
        "doc_id", "text_hash", "piece", F.least(F.lit(top).cast("long"), F.col("n") - F.col("piece") * top).alias("tokens"))
    return _deal(pieces, shards).groupBy("shard").applyInArrow(
        _pack(tuple(sorted(capacities)), bin_cost),
        "doc_id long, piece long, piece_tokens long, shard long, bin long, bin_length long, bin_offset long")


def _deal(pieces: DataFrame, shards: int) -> DataFrame:
    """A shard for each piece: by hash of document and piece, repeats of one row told apart."""
    if shards == 1:
        return pieces.withColumn("shard", F.lit(0).cast("long"))
    repeats = pieces.groupBy("doc_id", "text_hash", "piece").agg(F.count("*").alias("copies"), F.first("tokens").alias("tokens"))
    each = repeats.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return each.select("doc_id", "text_hash", "piece", "tokens",
                       F.pmod(F.xxhash64("doc_id", "text_hash", "piece", "copy"), F.lit(shards)).alias("shard"))
