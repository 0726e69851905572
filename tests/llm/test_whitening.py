import numpy as np
import pytest

from narrakin.llm import queries, whitening

COLUMNS = "vec_id long, embedding array<double>"


def plain(vectors):
    """n, exact deviations, eigenvalues and whitened coordinates of every component, from the SVD of all rows."""
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(0)
    deviations = [int(sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums))) for row in x]
    centred = (n * x - sums) / n
    left, sizes, _ = np.linalg.svd(centred, full_matrices=False)
    return n, deviations, sizes ** 2 / n, left * np.sqrt(n)


def frame(spark, vectors, ids=None):
    rows = [(i, list(map(float, v)) if v is not None else None) for i, v in zip(ids or range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, COLUMNS).selectExpr("*", "'a' AS x", "1 AS n", "2 AS component")


def check(got, vectors, components):
    n, deviations, values, whitened = plain(vectors)
    by_row = {}
    for r in got:
        by_row.setdefault(r["vec_id"], {})[r["component"]] = r
    assert sorted(by_row) == list(range(n))
    for k in range(1, components + 1):
        column = np.array([by_row[i][k]["whitened"] for i in range(n)])
        sign = np.sign(column @ whitened[:, k - 1])
        assert np.allclose(column, sign * whitened[:, k - 1], atol=1e-8)
        assert by_row[0][k]["explained"] == pytest.approx(values[k - 1] / values.sum(), rel=1e-9)
    assert all(r["n"] == n and r["deviation"] == deviations[r["vec_id"]] for r in got)
    assert max(r["identity_error"] for r in got) < 1e-9


def test_components_equal_an_eigensolver(spark):
    random = np.random.default_rng(3)
    vectors = random.normal(size=(300, 12)) @ np.diag(np.geomspace(1, 0.01, 12))
    got = whitening.whiten(spark, frame(spark, vectors).repartition(7)).collect()
    assert len(got) == 300 * 8
    check(got, vectors, 8)


def test_badly_conditioned_dimensions(spark):
    """Columns that differ by hardly more than the rounding of the whole numbers still give orthonormal components."""
    random = np.random.default_rng(4)
    base = random.normal(size=(500, 1)) * 400
    vectors = np.hstack([base + random.normal(size=(500, 3)) * 0.01, random.normal(size=(500, 3)) * 0.02])
    check(whitening.whiten(spark, frame(spark, vectors)).collect(), vectors, 6)


def test_dependent_dimensions_have_no_variance(spark):
    random = np.random.default_rng(5)
    one = np.round(random.normal(size=(60, 2)) * 100)
    got = whitening.whiten(spark, frame(spark, np.hstack([one, one, np.ones((60, 1))]))).collect()
    live = [r for r in got if r["whitened"] is not None]
    assert {r["component"] for r in live} == {1, 2} and len(got) == 60 * 5
    assert all(r["explained"] < 1e-12 for r in got if r["component"] > 2)
    assert max(r["identity_error"] for r in got) < 1e-9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1, 2, 3], [1, 2, 4], [1, 2, 4], None, [1, None, 2], [nan, 1, 2], [inf, 1, 2], [], [5, 6], [1e300, 0, 0]]
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in enumerate(vectors)] + [(None, [2.0, 1.0, 7.0])]
    got = whitening.whiten(spark, spark.createDataFrame(rows, COLUMNS)).collect()
    assert {r["vec_id"] for r in got} == {0, 1, 2, 8, 9, None}
    assert all(r["n"] == (1 if r["vec_id"] == 8 else 5) for r in got)
    alone = [r for r in got if r["vec_id"] == 8]
    assert len(alone) == 2 and all(r["whitened"] is None and r["explained"] == 0 and r["deviation"] == 0 and r["identity_error"] == 0 for r in alone)
    assert [r for r in got if r["vec_id"] == 9][0]["deviation"] is None
    assert whitening.whiten(spark, frame(spark, [])).count() == 0
    same = whitening.whiten(spark, frame(spark, [[1, 2]] * 4)).collect()
    assert len(same) == 8 and all(r["whitened"] is None and r["explained"] == 0 for r in same)


def test_substitution_and_shift():
    random = np.random.default_rng(6)
    rows, upper = random.normal(size=(9, 5)), np.triu(random.normal(size=(5, 5))) + 3 * np.eye(5)
    assert np.allclose(whitening.solve_right(rows, upper) @ upper, rows)
    low = rows[:, :2] @ rows[:, :2].T
    factor = whitening.cholesky(low)
    assert np.allclose(factor.T @ factor, low, atol=1e-10)


def test_query_on_the_given_table(spark):
    got = queries.op11_whitening(spark, "/root/testdata/sf0.001").collect()
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").orderBy("vec_id").collect()
    assert [r["vec_id"] for r in table] == list(range(len(table))) and len(got) == 8 * len(table)
    check(got, [r["embedding"] for r in table], 8)
