"""SimHash fingerprints of word shingles and near-duplicate groups by bit-sliced comparison."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrakin.llm.components import connected_components
from narrakin.llm.tables import text_or_empty
from narrakin.session import settle, ship_package

SHINGLE = 4
SEED = 42
RADIUS = 4
#: Bits of the parts a fingerprint is cut into. At most RADIUS of them can differ, so any two
#: fingerprints within the radius agree on at least two parts.
PARTS = (11, 11, 11, 11, 10, 10)
#: Fingerprints of a bucket that one tile holds; fuller buckets are compared tile by tile.
TILE = 2048
#: 64-lane words compared in one step.
_STEP = 1 << 15


def shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """XXH64 of every word shingle, repeats included; of the whole sequence if it is shorter."""
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(words))
    pairs = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e], SEED) for s, e in pairs], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes; zero for none."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of UTF-8 text: a bit is one if it is set in over half of the shingle hashes."""
    return majority(shingle_hashes(data.lower().split(), shingle))


@F.arrow_udf(T.LongType())
def fingerprint_column(texts: pa.Array) -> pa.Array:
    values = np.array([fingerprint(t.as_py().encode()) for t in texts], np.uint64)
    return pa.array(values.view(np.int64))


def hex16(column: Column) -> Column:
    return F.lpad(F.lower(F.hex(column)), 16, "0")


def _keys(fp: Column) -> list[Column]:
    """One bucket key for every two parts of the fingerprint."""
    spots, at = [], 0
    for bits in PARTS:
        spots.append(F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << bits) - 1)))
        at += bits
    pairs = combinations(range(len(PARTS)), 2)
    return [F.struct(F.lit(n).alias("t"), F.shiftleft(spots[i], 11).bitwiseOR(spots[j]).alias("k"))
            for n, (i, j) in enumerate(pairs)]


def _within(groups: np.ndarray, prints: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Links within each run of equal group numbers: position, first position of 64 others, mask of those linked.

    Each group's fingerprints are turned into 64 bit planes, 64 fingerprints to a word. A query
    fingerprint is compared with a whole word at once: the differing bits of each plane are added
    to counter planes by carry-save steps, and a word is abandoned as soon as every lane of it has
    passed the radius.
    """
    bounds = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1], [True]]))
    sizes = np.diff(bounds)
    words = (sizes + 63) // 64
    first_word = np.concatenate([[0], np.cumsum(words)])
    group_of = np.repeat(np.arange(len(sizes)), sizes)
    lane = np.arange(len(prints)) - bounds[:-1][group_of]
    slot = first_word[:-1][group_of] * 64 + lane
    padded = np.zeros(first_word[-1] * 64, np.uint64)
    padded[slot] = prints
    used = np.zeros(len(padded), bool)
    used[slot] = True
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)
    filled = np.packbits(used, bitorder="little").view(np.uint64)
    per_row = words[group_of]
    row_ends = np.cumsum(per_row)
    begin = 0
    while begin < len(prints):
        end = max(begin + 1, int(np.searchsorted(row_ends, (row_ends[begin - 1] if begin else 0) + _STEP, "right")))
        row = np.repeat(np.arange(begin, end), per_row[begin:end])
        offset = np.arange(len(row)) - np.repeat(row_ends[begin:end] - per_row[begin:end] - (row_ends[begin] - per_row[begin]), per_row[begin:end])
        word = first_word[:-1][group_of[row]] + offset
        own = np.where(lane[row] // 64 == offset, np.uint64(1) << (lane[row] % 64).astype(np.uint64), np.uint64(0))
        alive = filled[word] & ~own
        counters = [np.zeros(len(row), np.uint64) for _ in range(radius.bit_length())]
        for plane in range(64):
            query = np.uint64(0) - ((prints[row] >> np.uint64(plane)) & np.uint64(1))
            carry = planes[plane][word] ^ query
            for i, counter in enumerate(counters):
                counters[i], carry = counter ^ carry, counter & carry
            alive &= ~carry
            if plane % 4 == 3:
                alive &= ~_over(counters, radius)
                stay = alive != 0
                if not stay.all():
                    row, word, offset, alive = row[stay], word[stay], offset[stay], alive[stay]
                    counters = [c[stay] for c in counters]
                    if not len(row):
                        break
        yield row, bounds[:-1][group_of[row]] + 64 * offset, alive
        begin = end


def near(groups: np.ndarray, prints: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Spanning edges (positions) of the links within each run of equal group numbers."""
    starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]])) if len(groups) else np.empty(0, np.int64)
    found: dict[int, list[tuple[int, int, int]]] = {}
    for row, first, alive in _within(groups, prints, radius):
        start = starts[np.searchsorted(starts, row, "right") - 1]
        for s, r, o, mask in zip(start.tolist(), row.tolist(), ((first - start) // 64).tolist(), alive.tolist()):
            found.setdefault(s, []).append((r, o, mask))
    edges = []
    for start, hits in found.items():
        edges += _span(hits, start)
    return edges


def _over(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count is above the radius: by comparison from the highest counter plane down."""
    above = np.zeros_like(counters[0])
    equal = ~above
    for place in reversed(range(len(counters))):
        if radius >> place & 1:
            equal = equal & counters[place]
        else:
            above |= equal & counters[place]
            equal = equal & ~counters[place]
    return above


def _span(hits: list[tuple[int, int, int]], start: int) -> list[tuple[int, int]]:
    """A spanning forest of one group's links: each position is visited once, over bit masks."""
    linked: dict[int, int] = {}
    for row, offset, mask in hits:
        linked[row - start] = linked.get(row - start, 0) | mask << (64 * offset)
    waiting, edges = 0, []
    for spot in linked:
        waiting |= 1 << spot
    for root in linked:
        if not waiting >> root & 1:
            continue
        waiting &= ~(1 << root)
        queue = [root]
        while queue:
            near_to = queue.pop()
            fresh = linked[near_to] & waiting
            waiting &= ~fresh
            while fresh:
                bit = fresh & -fresh
                fresh ^= bit
                spot = bit.bit_length() - 1
                edges.append((start + spot, start + near_to))
                queue.append(spot)
    return edges


def _whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of rows that come ordered by the first, their bucket, with all rows of a bucket together.

    Rows that are alone in their bucket are left out.
    """
    rest: list[np.ndarray] | None = None
    for batch in _and_last(batches):
        if batch is None:
            columns, whole = rest, len(rest[0]) if rest else 0
        else:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            columns = [np.concatenate(pair) for pair in zip(rest, columns)] if rest else columns
            g = columns[0]
            whole = int(np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))[-1]) if len(g) else 0
        if columns is None:
            continue
        rest = [c[whole:] for c in columns]
        g = columns[0][:whole]
        same = g[1:] == g[:-1]
        several = np.concatenate([same, [False]]) | np.concatenate([[False], same]) if whole else np.zeros(0, bool)
        if several.any():
            yield [c[:whole][several] for c in columns]


def _link_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning edges of the buckets of fingerprints: rows (g, fp)."""
    for g, prints in _whole_buckets(batches):
        edges = np.array(near(g, prints.view(np.uint64)), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(prints[edges[:, 0]]), pa.array(prints[edges[:, 1]])], names=["a", "b"])


def _and_last(batches):
    yield from batches
    yield None


def _dealt(keyed: DataFrame, tile: int) -> DataFrame:
    """Rows (key, ...) as (g, ...), dealt to the buckets g and ordered by them.

    A bucket of more than `tile` rows is dealt into tiles by the hash of its second column and every
    pair of tiles becomes a bucket of its own, so nothing is left out and no bucket outgrows two
    tiles.
    """
    rest = [c for c in keyed.columns if c != "key"]
    full = settle(keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > tile).select(
        "key", F.greatest(F.lit(2), F.ceil(F.col("n") / tile)).cast("int").alias("tiles")), "buckets")
    if full.isEmpty():
        grouped = keyed.select(F.col("key").alias("g"), *rest)
    else:
        own = F.pmod(F.xxhash64(rest[0], F.lit(7)), F.col("tiles")).cast("int")
        pairs = F.when(F.col("tiles").isNull(), F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
            F.transform(F.filter(F.sequence(F.lit(0), F.col("tiles") - 1), lambda o: o != own),
                        lambda o: F.struct(F.least(o, own).alias("i"), F.greatest(o, own).alias("j"))))
        grouped = keyed.join(full, "key", "left").select("key", *rest, F.explode(pairs).alias("p")).select(
            F.xxhash64("key", "p.i", "p.j").alias("g"), *rest)
    return grouped.repartition("g").sortWithinPartitions("g", rest[0])


def link_fingerprints(spark: SparkSession, prints: DataFrame, tile: int = TILE) -> DataFrame:
    """Edges a, b that join all fingerprints (fp long, distinct) within the radius of each other.

    Every two fingerprints within the radius share a bucket of two equal parts.
    """
    keyed = prints.select("fp", F.explode(F.array(*_keys(F.col("fp")))).alias("key")).select(
        F.shiftleft(F.col("key.t").cast("long"), 32).bitwiseOR(F.col("key.k")).alias("key"), "fp")
    return _dealt(keyed, tile).mapInArrow(_link_buckets, "a long, b long").distinct()


def _grouped(spark: SparkSession, marked: DataFrame, classes: DataFrame, key: str, links: DataFrame) -> DataFrame:
    """doc_id, text_hash, root, component_id and the key of every marked row, by the links between keys."""
    linked = connected_components(spark, links).select(F.col("node").alias(key), "component")
    found = settle(classes.join(linked, key, "left").withColumn("component", F.coalesce("component", key)), "simhash-found")
    lowest = settle(found.groupBy("component").agg(F.min("first_id").alias("component_id")), "simhash-lowest")
    groups = settle(found.join(lowest, "component").select(key, F.col("component").alias("root"), "component_id"), "simhash-groups")
    return marked.join(groups, key).select("doc_id", "text_hash", key, "root", "component_id")


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Group documents whose fingerprints are linked, directly or through others.

    docs: doc_id, text; other columns are ignored. Returns one row per input row: doc_id, text_hash,
    fp, root, component_id. text_hash tells rows apart whose doc_id is repeated; root is a
    fingerprint that names the group. A null text is empty; a text without words has fingerprint
    zero and is linked like any other. component_id is the smallest doc_id of the group; it is null
    only if all ids of the group are null. Equal fingerprints are compared once.
    """
    ship_package(spark)
    marked = settle(docs.select(
        F.col("doc_id").alias("doc_id"), F.xxhash64(text_or_empty()).alias("text_hash"),
        fingerprint_column(text_or_empty()).alias("fp")), "simhash")
    classes = settle(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-classes")
    return _grouped(spark, marked, classes, "fp", link_fingerprints(spark, classes.select("fp")))


def one_of_each_group(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One whole row of each group of near duplicates: that with the smallest doc_id, of repeated rows any one.

    All columns of docs are returned. A row without doc_id stays only if its group has no id.
    """
    key = F.struct(F.coalesce("doc_id", "text_hash").alias("_id"), F.col("doc_id").isNull().alias("_none"), F.col("text_hash").alias("_hash"))
    groups = near_duplicates(spark, docs).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stay = settle(groups.groupBy("root").agg(F.min(key).alias("k")).select("k.*"), "simhash-stay")
    rows = docs.select(F.struct("*").alias("_row"), "doc_id", F.xxhash64(text_or_empty()).alias("text_hash"))
    joined = rows.select("_row", key.alias("k")).select("_row", "k.*").join(stay, ["_id", "_none", "_hash"])
    any_one = Window.partitionBy("_id", "_none", "_hash").orderBy(F.lit(0))
    return joined.withColumn("_n", F.row_number().over(any_one)).where("_n = 1").select("_row.*")
