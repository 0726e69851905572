import numpy as np
from pyspark.sql import functions as F

from narrakin.llm import vectors
from narrakin.llm.tables import bounded_sample


def plain(rows, threshold=0.95):
    """n_links and component_id of each row, by brute force in double precision."""
    sound = [i for i, (_, e) in enumerate(rows) if e and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    unit = {i: np.array(rows[i][1], float) / np.linalg.norm(np.array(rows[i][1], float)) for i in sound}
    links = {i: [j for j in sound if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in sound}
    label = {i: i for i in sound}
    for i in sound:
        queue, seen = [i], {i}
        while queue:
            for j in links[queue.pop()]:
                if j not in seen:
                    seen.add(j)
                    queue.append(j)
        label[i] = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
    return [(r[0], len(links.get(i, [])), label[i] if i in label else r[0]) for i, r in enumerate(rows)]


def mixed_rows(dim=24, groups=30, seed=2):
    random = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        centre = random.normal(size=dim)
        for _ in range(int(random.integers(1, 9))):
            rows.append((centre + random.normal(size=dim) * random.choice([0.0, 0.1, 0.2, 0.3])).tolist())
    dense = random.normal(size=dim)
    rows += [(dense + random.normal(size=dim) * 0.1).tolist() for _ in range(120)]
    return list(enumerate(rows))


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit(1)).withColumn("cid", F.lit("x"))


def test_links_equal_brute_force_in_many_cells_and_tiles(spark):
    rows = mixed_rows()
    for cell, tile in ((16, 16), (64, 512)):
        got = vectors.near_vectors(spark, frame(spark, rows), cell=cell, tile=tile).collect()
        assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == plain(rows)
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_one_end_of_every_link_visits_the_others_cell():
    """Pairs at the threshold in random directions, and along the line between two centres."""
    random = np.random.default_rng(7)
    data = vectors.unit(random.normal(size=(4000, 64)))
    centres = vectors.fit_cells(data, 64)
    v = data[:2000]
    w = random.normal(size=v.shape)
    w = vectors.unit(w - (w * v).sum(1, keepdims=True) * v)
    pairs = [(v, 0.95 * v + np.sqrt(1 - 0.95 ** 2) * w, centres)]
    for cosine in (0.9501, 0.97, 0.985, 0.9999):
        half = np.arccos(cosine) / 2
        at = np.array([[np.pi / 4 - half], [np.pi / 4 + half]])
        ends = np.hstack([np.cos(at), np.sin(at)])
        pairs.append((ends[:1], ends[1:], np.eye(2)))
    for a, b, centres in pairs:
        (home_a, met_a), (home_b, met_b) = vectors.visits(a, centres, 0.95), vectors.visits(b, centres, 0.95)
        at = np.arange(len(a))
        assert (met_a[at, home_b] | met_b[at, home_a]).all() and met_a[at, home_a].all()


def test_links_between_two_cells_are_counted(spark):
    """Two dense groups fix the centres; pairs either side of the middle are linked with each other only."""
    random = np.random.default_rng(8)
    rows = [(np.eye(2)[i % 2] + random.normal(size=2) * 0.03).tolist() for i in range(400)]
    for cosine in (0.951, 0.97, 0.985):
        half = np.arccos(cosine) / 2
        rows += [[float(np.cos(np.pi / 4 + s * half)), float(np.sin(np.pi / 4 + s * half))] for s in (-1, 1)]
    rows = list(enumerate(rows))
    got = vectors.near_vectors(spark, frame(spark, rows), cell=16).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == plain(rows)


def test_a_sample_is_bounded_and_the_same_at_every_run(spark):
    some = spark.range(100_000).repartition(5)
    first, again = ({r["id"] for r in bounded_sample(some, F.col("id"), n).collect()} for n in (500, 400))
    assert len(first) == 500 and len(again) == 400 and again < first
    assert bounded_sample(some.limit(30), F.col("id"), 500).count() == 30 and bounded_sample(some.limit(0), F.col("id"), 5).count() == 0


def test_odd_rows(spark):
    base = [1.0, 2.0, 3.0]
    rows = [
        (1, base), (2, base), (2, base), (3, [2.0, 4.0, 6.0]), (4, None), (5, []), (6, [0.0, 0.0, 0.0]), (7, [1.0, None, 3.0]),
        (8, [float("nan"), 1.0, 2.0]), (9, [float("inf"), 1.0, 2.0]), (None, base), (10, [1.0, 2.0]), (11, [-1.0, -2.0, -3.0]),
        (12, [1e300, 2e300, 3e300]), (13, [1e-300, 2e-300, 3e-300]), (None, None),
    ]
    got = vectors.near_vectors(spark, frame(spark, rows)).collect()
    want = {1: (6, 1), 2: (6, 1), 3: (6, 1), 12: (6, 1), 13: (6, 1)}
    assert len(got) == len(rows)
    for r in got:
        if r["vec_id"] is not None:
            assert (r["n_links"], r["component_id"]) == want.get(r["vec_id"], (0, r["vec_id"]))
    assert sorted(r["n_links"] for r in got if r["vec_id"] is None) == [0, 6]
    assert vectors.near_vectors(spark, frame(spark, []) if False else frame(spark, rows).limit(0)).count() == 0
    assert vectors.near_vectors(spark, frame(spark, rows).where("vec_id = 4")).collect()[0]["kept"]


def test_blocks_are_compared_in_waves_of_bounded_rows(spark, monkeypatch):
    """Vectors in all directions visit many cells, those of a dense group meet in many tiles; no wave holds all of it."""
    random = np.random.default_rng(5)
    dense = random.normal(size=6)
    rows = random.normal(size=(400, 6)).tolist() + [(dense + random.normal(size=6) * 0.1).tolist() for _ in range(200)]
    rows = list(enumerate(rows + rows[:50] + [[1.0, 2.0], [2.0, 4.1]]))
    dealt, held = vectors._dealt, []

    def counted(*wave):
        blocks = dealt(*wave)
        held.append(blocks.count())
        assert blocks.where("left AND size(visits) > 0").count() == 0
        return blocks

    monkeypatch.setattr(vectors, "_dealt", counted)
    monkeypatch.setattr(vectors, "WAVE_ROWS", 1)
    narrow = frame(spark, rows).withColumn("embedding", F.col("embedding").cast("array<float>"))
    for given in (frame(spark, rows), narrow):
        held.clear()
        got = vectors.near_vectors(spark, given, cell=16, tile=16).collect()
        exact = [(r["vec_id"], r["embedding"]) for r in given.orderBy("vec_id").collect()]
        assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == plain(exact)
        assert len(held) > 4 and max(held) <= 3 * 600 < sum(held) / 2
