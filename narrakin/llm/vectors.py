"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrakin.llm.components import connected_components, forest
from narrakin.llm.tables import bounded_sample
from narrakin.session import in_turn, scratch_path, settle, ship_package, temporary_tables

THRESHOLD = 0.95
#: The cells are fitted on at most so many numbers (vectors times dimensions), chosen by hash.
SAMPLE_NUMBERS = 2_000_000
#: Distinct vectors aimed at per cell, and most cells.
CELL, MOST_CELLS = 64, 4096
#: What is added to the bound on visits for rounding.
ROUNDING = 1e-9
#: Vectors of one side of a block.
TILE = 512
#: Rows that blocks of one wave hold, or as many as there are distinct vectors if they are more.
WAVE_ROWS = 1 << 20


def fit_cells(sample: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Unit centres by spherical k-means; of centres closer than 0.9 one is kept, so that a dense
    group of near copies makes one cell, which is then compared in tiles."""
    if not len(sample):
        return np.empty((0, sample.shape[1]))
    random = np.random.default_rng(0)
    centres = sample[random.choice(len(sample), min(cells, len(sample)), replace=False)]
    for _ in range(rounds):
        nearest = np.concatenate([(sample[i:i + 4096] @ centres.T).argmax(1) for i in range(0, len(sample), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1)
        centres = np.where((norms > 1e-12)[:, None], sums / np.maximum(norms, 1e-12)[:, None], centres)
    stay: list[int] = []
    for i in range(len(centres)):
        if not stay or (centres[stay] @ centres[i]).max() < 0.9:
            stay.append(i)
    return centres[stay]


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, first by their largest component so that squares stay in range."""
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def visits(rows: np.ndarray, centres: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each unit vector, and all cells it is compared in, as a mask.

    Of two vectors at home in A and B, if u (A - B) > s |A - B| and v (B - A) > s |B - A|, then
    |u - v| > 2 s. Linked ones are at most sqrt(2 - 2 threshold) apart, so with s half of that at
    least one of the two visits the other's cell, and no link is lost.
    """
    near = rows @ centres.T
    home = near.argmax(1)
    apart = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (centres[home] @ centres.T)))
    behind = near[np.arange(len(rows)), home][:, None] - near
    return home, behind <= np.sqrt(max(0.0, (1.0 - threshold) / 2.0)) * apart + ROUNDING


def _assigner(centres, threshold: float):
    """(cid, embedding, m) -> (cid, m, dim, home, visits, vec): own cell, all cells to be compared in, the vector as it is."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column(1).offsets.to_numpy())
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.cumsum(sizes)
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                for part in np.array_split(at, max(1, len(at) // 2048)):
                    rows = unit(flat[(ends[part] - dim)[:, None] + np.arange(dim)])
                    if dim == centres.value.shape[1] and len(centres.value):
                        home, mask = visits(rows, centres.value, threshold)
                        visited, offsets = np.nonzero(mask)[1], np.concatenate([[0], np.cumsum(mask.sum(1))])
                    else:
                        home, visited, offsets = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64), np.arange(len(part) + 1)
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(part)), batch.column(2).take(pa.array(part)),
                        pa.array(np.full(len(part), dim, np.int64)), pa.array(home.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(visited.astype(np.int64))),
                        batch.column(1).take(pa.array(part)),
                    ], names=["cid", "m", "dim", "home", "visits", "vec"])
    return assign


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def block_links(left: pa.Table, right: pa.Table, cell: int, dim: int, threshold: float):
    """Links between the vectors that visit a cell and those at home in it: credits and a forest.

    A pair of two cells is met in either of them if both vectors visit the other's; it is then
    counted in the cell with the smaller number only.
    """
    a, b = left.column("cid").to_numpy(), right.column("cid").to_numpy()
    hit = unit(_matrix(left.column("vec"), dim)) @ unit(_matrix(right.column("vec"), dim)).T >= threshold
    hit &= a[:, None] != b[None, :]
    rows, cols = np.nonzero(hit)
    if not len(rows):
        return [], [], [], []
    homes = left.column("home").to_numpy()
    guest = homes[rows] != cell
    visits = right.column("visits").to_pylist()
    known = {h: np.array([h in v for v in visits]) for h in np.unique(homes[rows[guest]]).tolist()}
    elsewhere = np.zeros(len(rows), bool)
    for h, returned in known.items():
        elsewhere |= (homes[rows] == h) & returned[cols] & (h < cell)
    rows, cols, guest = rows[~elsewhere], cols[~elsewhere], guest[~elsewhere]
    many_a, many_b = left.column("m").to_numpy(), right.column("m").to_numpy()
    to_a = np.bincount(rows, many_b[cols], len(a)).astype(np.int64)
    to_b = np.bincount(cols[guest], many_a[rows[guest]], len(b)).astype(np.int64)
    ends = forest(a[rows], b[cols])
    ids, credits = np.concatenate([a, b]), np.concatenate([to_a, to_b])
    return ids[credits > 0], credits[credits > 0], ends[0], ends[1]


def _comparer(threshold: float):
    def compare(key: tuple, group: pa.Table) -> pa.Table:
        dim, cell = key[0].as_py(), key[1].as_py()
        is_left = group.column("left")
        left, right = group.filter(is_left), group.filter(pa.compute.invert(is_left))
        ids, credits, low, high = block_links(left, right, cell, dim, threshold) if len(left) and len(right) else ([], [], [], [])
        n, k = len(ids), len(low)
        return pa.table({
            "a": pa.array(np.concatenate([ids, low]).astype(np.int64)),
            "b": pa.array(np.concatenate([np.zeros(n), high]).astype(np.int64) if k else np.zeros(n, np.int64), mask=np.arange(n + k) < n),
            "n": pa.array(np.concatenate([credits, np.zeros(k)]).astype(np.int64))})
    return compare


def _tiles(placed: DataFrame, tile: int, most: int) -> DataFrame:
    """Into how many tiles the visitors of a cell and its own vectors are cut, and in which waves its blocks are compared.

    The tiles of a cell follow from counts, so no block outgrows two tiles by more than chance. Waves take
    cells in order, about `most` rows of blocks each; a cell of more is compared in several, by the tiles of its own vectors.
    """
    guests = placed.select("dim", F.explode("visits").alias("cell")).groupBy("dim", "cell").agg(F.count("*").alias("guests"))
    own = placed.groupBy("dim", F.col("home").alias("cell")).agg(F.count("*").alias("own"))
    cut = own.join(guests, ["dim", "cell"]).withColumns({"lefts": F.ceil(F.col("guests") / tile), "rights": F.ceil(F.col("own") / tile)})
    rows = F.col("guests") * F.col("rights") + F.col("own") * F.col("lefts")
    before = F.sum("rows").over(Window.orderBy("dim", "cell")) - F.col("rows")
    return cut.withColumn("rows", rows).select(
        "dim", "cell", "lefts", "rights", F.floor(before / most).alias("wave"), F.least("rights", F.ceil(F.col("rows") / most)).alias("waves"))


def _dealt(placed: DataFrame, tiles: DataFrame, wave: int, low: int, high: int) -> DataFrame:
    """Rows of every block of a wave, whose cells are from low to high: a tile of a cell's visitors against a tile of its own vectors.

    Only the cell's own vectors carry their visits.
    """
    tiles = F.broadcast(tiles.where((F.col("wave") <= wave) & (F.col("wave") + F.col("waves") > wave)))
    spread = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    mine = lambda n, seed: F.pmod(F.xxhash64("cid", F.lit(seed)), n)
    now = lambda j: F.col("wave") + j % F.col("waves") == wave
    columns = ["cid", "m", "home"]
    here = F.filter("visits", lambda v: v.between(low, high))
    left = placed.withColumn("cell", F.explode(here)).join(tiles, ["dim", "cell"]).select(
        "dim", "cell", mine(F.col("lefts"), 1).alias("i"), F.explode(F.filter(spread(F.col("rights")), now)).alias("j"), F.lit(True).alias("left"),
        *columns, F.array().cast("array<long>").alias("visits"), "vec")
    right = placed.withColumn("cell", F.col("home")).join(tiles, ["dim", "cell"]).withColumn("j", mine(F.col("rights"), 2)).where(now(F.col("j"))).select(
        "dim", "cell", F.explode(spread(F.col("lefts"))).alias("i"), "j", F.lit(False).alias("left"), *columns, "visits", "vec")
    return left.unionByName(right)


def near_vectors(spark: SparkSession, vectors: DataFrame, threshold: float = THRESHOLD, cell: int = CELL, tile: int = TILE) -> DataFrame:
    """Link vectors whose cosine, in double precision, is at least the threshold, and group them.

    vectors: vec_id long, embedding array of numbers; other columns are ignored. Returns one row per
    row: vec_id, n_links, component_id, kept. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing and are kept; vectors of different lengths link never.
    Equal vectors are compared once and counted each. component_id is the smallest vec_id reachable;
    rows without vec_id take part, but name no component unless all its ids are null.
    """
    ship_package(spark)
    given = vectors.schema["embedding"].dataType
    kind = "float" if isinstance(given, T.ArrayType) and isinstance(given.elementType, T.FloatType) else "double"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    sound = F.coalesce(
        F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0), F.lit(False))
    classes = settle(rows.where(sound).groupBy("embedding").agg(F.min("vec_id").alias("low"), F.count("*").alias("m")).select(
        F.monotonically_increasing_id().alias("cid"), "embedding", "low", "m"), "vector-classes")
    sizes = classes.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    if sizes is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    dim, n = sizes
    some = bounded_sample(classes.where(F.size("embedding") == dim), F.col("embedding"), max(1, SAMPLE_NUMBERS // dim), n).select("embedding").toArrow()
    sample = unit(_matrix(some.column(0), dim))
    cells = int(min(MOST_CELLS, max(1, n // cell), max(1, len(sample) // 8)))
    centres = spark.sparkContext.broadcast(fit_cells(sample, cells))
    links = scratch_path(spark, "vector-links")
    with temporary_tables(spark):
        placed = settle(classes.select("cid", "embedding", "m").mapInArrow(
            _assigner(centres, threshold), f"cid long, m long, dim long, home long, visits array<long>, vec array<{kind}>"), "vectors-placed")
        tiles = settle(_tiles(placed, tile, max(WAVE_ROWS, n)), "tiles")
        compare = lambda *wave: _dealt(placed, tiles, *wave).groupBy("dim", "cell", "i", "j").applyInArrow(_comparer(threshold), "a long, b long, n long")
        waves = tiles.select("cell", F.explode(F.sequence("wave", F.col("wave") + F.col("waves") - 1)).alias("wave")).groupBy("wave").agg(F.min("cell"), F.max("cell")).collect()
        links = in_turn(spark, "vector-links", [lambda wave=tuple(wave): compare(*wave) for wave in sorted(waves)], links)
    counts = links.where("b IS NULL").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("n"))
    joined = connected_components(spark, links.where("b IS NOT NULL").select("a", "b")).select(F.col("node").alias("cid"), "component")
    found = settle(classes.drop("embedding").join(joined, "cid", "left").join(counts, "cid", "left").select(
        "cid", "low", F.coalesce("component", "cid").alias("component"), (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links")), "vector-found")
    lowest = settle(found.groupBy("component").agg(F.min("low").alias("component_id")), "vector-lowest")
    grouped = settle(found.join(lowest, "component").select("cid", "n_links", "component_id"), "vector-groups")
    per_class = classes.select("cid", "embedding").join(grouped, "cid").drop("cid")
    told = rows.where(sound).join(per_class, "embedding").select("vec_id", "n_links", "component_id")
    lone = rows.where(~sound).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return told.unionByName(lone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
