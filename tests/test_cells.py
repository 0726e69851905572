import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from narrakin import session
from narrakin.operators import blocks, cells, topk
from narrakin.options import MatchOptions
from narrakin.plans import pipeline

K, FLOOR = 5, 0.3


def clustered(n, dim=12, seed=1, groups=25, noise=0.35):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(groups, dim))
    return centres[random.integers(0, groups, n)] + noise * random.normal(size=(n, dim))


def frame(spark, matrix, name, first=0):
    rows = [(first + i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} long, vector array<double>")


def exact(left, right, k=K, floor=FLOOR):
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    scores = np.round(unit(left) @ unit(right).T, 9)
    return {i: sorted(((-s, j) for j, s in enumerate(row) if s >= floor))[:k] for i, row in enumerate(scores)}


def as_lists(df, key="txn_id"):
    got = {}
    for r in df.orderBy(key, "rank").collect():
        got.setdefault(r[key], []).append((-r["similarity"], r["target"]))
    return got


def same(got, want):
    assert {q: [i for _, i in hits] for q, hits in got.items()} == {q: [i for _, i in hits] for q, hits in want.items() if hits}


def test_cell_search_is_exact_and_compares_less(spark):
    left, right = clustered(150, seed=1), clustered(1500, seed=1)
    index = cells.build_cells(frame(spark, right, "company_id"), cell_rows=32)
    compared = []
    found = cells.cell_topk(frame(spark, left, "txn_id"), index, K, FLOOR, compared=compared)
    same(as_lists(found), exact(left, right))
    assert sum(compared) < 0.5 * len(left) * len(right)


def test_two_levels_hot_cells_and_small_parts(spark, monkeypatch):
    monkeypatch.setattr(cells, "GROUP_CELLS", 4)
    monkeypatch.setattr(cells, "PART_ROWS", 50)
    monkeypatch.setattr(blocks, "QUERY_BLOCK", 20)
    monkeypatch.setattr(blocks, "TARGET_BLOCK", 30)
    left, right = clustered(60, seed=4), clustered(900, seed=4)
    right[:300] = right[0]  # a third of the rows are one vector
    index = cells.build_cells(frame(spark, right, "company_id"), cell_rows=16)
    assert index.groups.count() > 3 and index.cells.count() > 20
    assert index.rows.count() == 900 and index.cells.agg(F.sum("n")).first()[0] == 900
    found = cells.cell_topk(frame(spark, left, "txn_id"), index, K, FLOOR)
    same(as_lists(found), exact(left, right))


def test_queries_searched_in_slices_find_and_compare_the_same(spark, monkeypatch, tmp_path):
    left, right = clustered(90, seed=7), clustered(800, seed=7)
    index, asked = cells.build_cells(frame(spark, right, "company_id"), cell_rows=32), frame(spark, left, "txn_id")
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    whole, sliced, probed = [], [], [[], []]
    same(as_lists(cells.cell_topk(asked, index, K, FLOOR, compared=whole)), exact(left, right))
    near = as_lists(cells.probed_topk(asked, index, K, FLOOR, 2, compared=probed[0]))
    monkeypatch.setattr(cells, "SLICE_PAIRS", 30 * index.cells.count())
    monkeypatch.setattr(cells, "SLICE_NEAR", 30 * index.groups.count())
    for old in tmp_path.iterdir():
        old.rename(tmp_path.parent / f"{tmp_path.name}-{old.name}")
    same(as_lists(cells.cell_topk(asked, index, K, FLOOR, compared=sliced)), exact(left, right))
    assert as_lists(cells.probed_topk(asked, index, K, FLOOR, 2, compared=probed[1])) == near
    assert sliced == whole and probed[0] == probed[1]
    assert sorted(p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()) == ["cell-queries", "cell-queries", "cell-slices", "probe-slices"]


def test_radii_bound_every_similarity(spark):
    right = clustered(400, seed=6)
    index = cells.build_cells(frame(spark, right, "company_id"), cell_rows=20)
    held = {r["cell"]: r for r in index.cells.collect()}
    query = clustered(1, seed=9)[0]
    query /= np.linalg.norm(query)
    for r in index.rows.collect():
        vector = np.array(r["vector"]) / np.linalg.norm(r["vector"])
        cell = held[r["cell"]]
        bound = cells.best_possible(np.array([query @ np.array(cell["centre"])]), np.array([cell["radius"]]))[0]
        assert query @ vector <= bound + 1e-9


def test_odd_vectors(spark):
    right = np.array([[1.0, 0.0], [0.0, 0.0], [-1.0, 0.0], [1.0, 1e-9], [2.0, 0.0]])
    left = np.array([[1.0, 0.0], [0.0, 0.0], [0.5, 0.5]])
    index = cells.build_cells(frame(spark, right, "company_id").unionByName(
        spark.createDataFrame([(99, None)], "company_id long, vector array<double>")), cell_rows=2)
    found = cells.cell_topk(frame(spark, left, "txn_id"), index, 2, FLOOR)
    same(as_lists(found), exact(left, right, 2))
    none = frame(spark, right, "company_id").limit(0)
    empty = cells.build_cells(none)
    assert cells.cell_topk(frame(spark, left, "txn_id"), empty, 2, FLOOR).count() == 0
    assert cells.cell_topk(frame(spark, left, "txn_id").limit(0), index, 2, FLOOR).count() == 0
    one = cells.build_cells(frame(spark, right[:1], "company_id"))
    assert cells.cell_topk(frame(spark, left, "txn_id"), one, 2, FLOOR).count() == 2


def test_probes_from_a_stated_recall(spark):
    left, right = clustered(200, seed=2, dim=16), clustered(3000, seed=2, dim=16)
    index = cells.build_cells(frame(spark, right, "company_id"), cell_rows=24)
    probes = cells.probes_for(index, 0.9, K, FLOOR, rows=400)
    compared = []
    found = cells.probed_topk(frame(spark, left, "txn_id"), index, K, FLOOR, probes, compared=compared)
    truth = {(q, i) for q, hits in exact(left, right).items() for _, i in hits}
    got = {(q, i) for q, hits in as_lists(found).items() for _, i in hits}
    assert len(truth & got) >= 0.9 * len(truth)
    assert sum(compared) < 0.1 * len(left) * len(right)
    assert cells.probes_for(index, 0.99, K, FLOOR, rows=400) >= probes


def test_probed_similarities_are_exact(spark):
    left, right = clustered(50, seed=3), clustered(500, seed=3)
    index = cells.build_cells(frame(spark, right, "company_id"), cell_rows=25)
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    scores = unit(left) @ unit(right).T
    found = cells.probed_topk(frame(spark, left, "txn_id"), index, K, FLOOR, 2)
    rows = found.collect()
    assert rows and all(r["similarity"] == pytest.approx(scores[r["txn_id"], r["target"]], abs=2e-9) for r in rows)


def test_stored_cells_serve_a_run(spark, tmp_path):
    right = clustered(60, dim=6, seed=5)
    companies = spark.createDataFrame([(i, f"star motors {chr(97 + i % 26)}{i}") for i in range(60)], "company_id long, name string")
    txns = spark.createDataFrame([(i, f"NEFT/X/star motors {chr(97 + i % 26)}{i}") for i in range(60)], "txn_id long, narration string")
    asked = frame(spark, right, "txn_id").unionByName(frame(spark, right[:20], "txn_id", 100))  # equal vectors of several narrations
    results = {}
    for name, opts in {"block": MatchOptions(), "cells": MatchOptions(dense_numbers=10), "probed": MatchOptions(search="probed", probes=100)}.items():
        path = str(tmp_path / name)
        pipeline.build_company_index(companies, opts, "company_id", "name", frame(spark, right, "company_id"), path)
        index = pipeline.load_company_index(spark, path)
        assert (index.cells is not None) == (name != "block")
        found, used = pipeline.vector_candidates(asked, index, opts)
        assert used == ("probed" if name == "probed" else "exact")
        results[name] = sorted(map(tuple, found.collect()))
        if name == "cells":
            run = pipeline.match_transactions(txns, index, opts, "txn_id", "narration", txn_vectors=asked)
            assert run.results.where("company_id = txn_id").count() == 60
    assert results["block"] == results["cells"] == results["probed"] and len({r[0] for r in results["block"]}) == 80


def test_large_company_sides_are_placed_in_cells(spark):
    left, right = clustered(40, seed=7), clustered(300, seed=7)
    found = topk.dense_topk(frame(spark, left, "txn_id"), frame(spark, right, "company_id"), K, FLOOR, numbers=100)
    same(as_lists(found.withColumnRenamed("company_id", "target")), exact(left, right))


def test_ranking_many_cells_takes_bounded_products(monkeypatch):
    rng = np.random.default_rng(3)
    vectors, centres = rng.normal(size=(500, 6)), rng.normal(size=(40, 6))
    asked = pa.table({"q": np.arange(500), "vector": cells._lists(vectors), "least": np.full(500, 0.3)})
    held = pa.table({"cell": np.arange(40), "centre": cells._lists(centres), "radius": np.full(40, 0.4)})
    rows = pa.table({"group": np.zeros(500, np.int64), "target": np.arange(500), "vector": cells._lists(vectors)})
    rank = [cells._cell_ranker("q", by_bound, first) for by_bound, first in ((True, 3), (False, 3), (True, None))]
    wanted = [r(asked, held) for r in rank] + [cells._cell_placer(rows, held)]
    sizes = []
    possible = cells.best_possible
    monkeypatch.setattr(cells, "SCORE_CELLS", 400)
    monkeypatch.setattr(cells, "best_possible", lambda near, radii: (sizes.append(near.size), possible(near, radii))[1])
    assert [r(asked, held) for r in rank] + [cells._cell_placer(rows, held)] == wanted
    assert max(sizes) <= 400


def test_a_query_is_sent_once_for_neighbouring_cells(spark, monkeypatch):
    sent, seen = [], cells.bucket_search
    monkeypatch.setattr(cells, "bucket_search", lambda asked, *more: (sent.append(asked.count()), seen(asked, *more))[1])
    left, right = clustered(100, seed=7, noise=2.0), clustered(1500, seed=7, noise=2.0)
    index = cells.build_cells(frame(spark, right, "company_id"), cell_rows=16)
    found = cells.cell_topk(frame(spark, left, "txn_id"), index, K, FLOOR, waves=(None,))
    same(as_lists(found), exact(left, right))
    assert index.cells.count() > 60 and sent[0] <= 2 * len(left)


def test_given_cells_that_come_twice_change_nothing(spark):
    left, right = frame(spark, clustered(40, seed=8), "txn_id"), frame(spark, clustered(400, seed=8), "company_id")
    centres = right.where("company_id % 20 = 0").withColumnRenamed("company_id", "cell")
    held = cells.cells_around(right, centres)
    twice = cells.CellIndex(held.groups, held.cells.unionByName(held.cells), held.rows)
    best = [as_lists(cells._best(cells._search(left, left.select("txn_id").crossJoin(held.cells.select("cell")), index, "txn_id", K, FLOOR), "txn_id", K))
            for index in (held, twice)]
    assert best[0] == best[1]
