import numpy as np
from pyspark.sql import functions as F

from narrakin.llm import negatives, queries

COLUMNS = "vec_id long, label int, embedding array<double>"


def plain(rows, anchor=lambda r: r[0] is not None and r[0] % 10 == 0, positives=5, count=10, window=(30, 90)):
    """All lines by scoring every pair; rows of (vec_id, label, vector)."""
    sound = [(v, l, [int(np.floor(256 * c)) for c in e]) for v, l, e in rows
             if l is not None and e is not None and all(c is not None and np.isfinite(c) for c in e)]
    order = lambda s: (-s[0], s[1] is None, s[1] or 0, s[2])
    out = []
    for i, (v, l, e) in enumerate(sound):
        if not anchor((v, l, e)):
            continue
        scored = [(sum(a * b for a, b in zip(e, f)), w, j, m) for j, (w, m, f) in enumerate(sound) if j != i and len(f) == len(e)]
        for p in sorted((s for s in scored if s[3] == l), key=order)[:positives]:
            inside = [s for s in scored if s[3] != l and window[0] * p[0] <= 100 * s[0] <= window[1] * p[0]]
            out += [(v, p[1], rank + 1, s[1], p[0], s[0]) for rank, s in enumerate(sorted(inside, key=order)[:count])]
    return sorted(out, key=str)


def mined(spark, rows, **options):
    frame = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "1 AS rid", "2 AS dim", "'x' AS x", "3 AS scores")
    got = negatives.hard_negatives(spark, frame, F.col("vec_id") % 10 == 0, **options).collect()
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted((tuple(r[c] for c in names) for r in got), key=str)


def clustered(n=240, dim=10, seed=1):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(4, dim))
    return [(i, int(random.integers(0, 3)), (centres[i % 4] + random.normal(size=dim) * 0.6).tolist()) for i in range(n)]


def test_equals_brute_force_in_one_block_and_in_many(spark):
    rows = clustered()
    want = plain(rows)
    assert len(want) > 300
    for numbers in (1_000_000, 400):
        assert mined(spark, rows, numbers=numbers) == want


def test_ties_and_copies(spark):
    rows = [(i, 0 if i % 3 else 1, [1.0, 0.5, -0.25 * (i % 2)]) for i in range(60)] + [(100 + i, 2, [0.5, 0.5, 0.0]) for i in range(40)]
    assert mined(spark, rows, numbers=60) == plain(rows)


def test_scores_below_zero_and_zero_have_exact_windows(spark):
    rows = [(0, 0, [1.0, 0.0]), (1, 0, [-1.0, 0.0]), (2, 0, [0.0, 1.0]), (3, 1, [-0.5, 0.0]), (4, 1, [0.0, 2.0]), (5, 1, [0.0, 0.0])]
    assert mined(spark, rows) == plain(rows)
    assert negatives.bounds(-100, (30, 90)) == (-30, -90) and negatives.bounds(7, (30, 90)) == (3, 6)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 0, [1.0, 2.0]), (None, 0, [1.0, 1.5]), (1, 0, [1.0, 2.0]), (None, 1, [0.5, 0.5]), (2, None, [1.0, 1.0]), (3, 1, None), (4, 1, [nan, 1.0]),
            (5, 1, [inf, 1.0]), (6, 1, [None, 1.0]), (7, 1, [0.5, 0.75]), (10, 1, [1.0, 1.0]), (11, 1, [2.0, 2.0, 2.0]), (20, 2, [1.0]), (8, 1, [0.5, 0.5]),
            (30, 3, []), (31, 3, []), (32, 4, [])]
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, [(0, 0, [1.0])]) == []
    assert spark.createDataFrame([], COLUMNS).transform(lambda d: negatives.hard_negatives(spark, d, F.lit(True))).count() == 0


def test_repeated_anchor_is_one_each(spark):
    rows = [(10, 0, [1.0, 1.0]), (10, 0, [1.0, 1.0]), (1, 1, [0.4, 0.4])]
    got = mined(spark, rows)
    assert got == [(10, 10, 1, 1, 131072, 52224)] * 2 and got == plain(rows)


def test_scan_drops_candidates_before_the_last_dimension():
    random = np.random.default_rng(2)
    data = (random.normal(size=(500, 64)) * np.geomspace(100, 1, 64)).astype(np.int64)
    seen = []
    keeps = negatives.highest(5)

    def stays(lower, upper):
        assert (lower <= upper).all()
        seen.append(len(lower))
        return keeps(lower, upper)

    at, score = negatives.Columns(data).scan(data[0], np.ones(500, bool), stays)
    exact = data @ data[0]
    assert set(np.argsort(-exact)[:5]) <= set(at) and (score == exact[at]).all()
    assert seen[0] == 500 and seen[-1] < 50


def test_query_on_the_given_table(spark):
    got = queries.op13_negatives(spark, "/root/testdata/sf0.001").collect()
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    rows = [(r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], r["embedding"]) for r in table]
    want = plain(rows, anchor=lambda r: r[0] % 100 == 0)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert want and sorted((tuple(r[c] for c in names) for r in got), key=str) == want
