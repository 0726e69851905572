import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from narrakin import session
from narrakin.functions import similarity
from narrakin.operators import fuzzy, ranking
from narrakin.options import MatchOptions
from narrakin.plans import pipeline


def texts(n, seed):
    rng = random.Random(seed)
    pool = ["star", "motors", "foods", "ramco", "asha", "chennai", "pune", "é", "xyz", "a", "ab1", "日本", "star-x"]
    out = [" ".join(rng.choices(pool, k=rng.randint(0, 4))) for _ in range(n)]
    return out + ["", " ", "  star  foods ", "".join(rng.choices("abcdef é", k=70))]


@pytest.fixture(scope="module")
def pairs(spark):
    rng = random.Random(3)
    a, b = texts(60, 1), texts(60, 2)
    rows = [(x, y) for x in a for y in rng.sample(b, 12)] + [(x, x) for x in a]
    return spark.createDataFrame(rows, "a string, b string").distinct()


def test_the_score_lies_between_its_bounds(pairs):
    rows = fuzzy.with_fuzzy_score(fuzzy.with_bounds(pairs, "a", "b"), "a", "b").collect()
    assert len(rows) > 500
    for r in rows:
        assert r["fuzzy_low"] - 1e-9 <= r["fuzzy_score"] <= r["fuzzy_high"] + 1e-9, r
    assert sum(r["fuzzy_high"] < 99 for r in rows) > len(rows) / 3


@pytest.mark.parametrize("boost", ["none", "random"])
def test_only_candidates_that_cannot_win_are_dropped(spark, pairs, boost):
    opts = MatchOptions()
    seeded = lambda n: (F.pmod(F.xxhash64("a", "b", F.lit(n)), F.lit(1000)) / 1000.0)
    given = pairs.withColumns({"similarity": F.round(0.3 + 0.7 * seeded(1), 9), "company_id": F.xxhash64("b")})
    left = ranking.contenders(fuzzy.with_bounds(given, "a", "b"), ["a"], opts)
    assert set(left.columns) == set(given.columns)
    city = F.lit(0.0) if boost == "none" else F.floor(seeded(2) * 4).cast("double")

    def best(rows):
        scored = ranking.with_scores(fuzzy.with_fuzzy_score(rows, "a", "b").withColumn("city_boost", city), opts)
        return {r["a"]: (r["company_id"], r["final_score"]) for r in ranking.best_candidate(scored, "a").collect()}

    assert best(left) == best(given)
    assert left.count() < 0.8 * given.count()


def test_ties_stay(spark):
    rows = [("star", "star", 0.9, 1), ("star", "star", 0.9, 2), ("star", "qqqq", 0.3, 3)]
    given = spark.createDataFrame(rows, "a string, b string, similarity double, company_id long")
    left = ranking.contenders(fuzzy.with_bounds(given, "a", "b"), ["a"])
    assert sorted(r["company_id"] for r in left.collect()) == [1, 2]


def test_letters_are_counted_for_many_pairs_at_once(spark, monkeypatch):
    kinds = lambda text: Counter(c if c in similarity.COUNTED else "" for c in text)
    a, b = texts(300, 5), texts(300, 6)
    wanted = [sum((kinds(x) & kinds(y)).values()) for x, y in zip(a, b)]
    for chars in (1, 50, 1 << 20):
        monkeypatch.setattr(similarity, "_COUNT_CHARS", chars)
        assert similarity.most_common(a, b).tolist() == wanted
    assert similarity.most_common([], []).tolist() == []
    given = spark.createDataFrame([("star", None), (None, "star"), ("star", "rats")], "a string, b string")
    found = fuzzy.with_bounds(given, "a", "b").select("a", "b", "fuzzy_high").collect()
    assert [r["fuzzy_high"] for r in found if r["a"] and r["b"]] == [100.0]


@pytest.mark.parametrize("rows, wanted", [(1, 30), (100_000, 9)])
def test_pairs_to_score_get_a_task_for_every_so_many(spark, monkeypatch, rows, wanted):
    companies = spark.createDataFrame([(i, f"STAR {x} MOTORS") for i, x in enumerate(("ASHA", "RAMCO", "PUNE"))], "id long, name string")
    txns = spark.createDataFrame([(i, f"STAR {x} MOTORS {i}") for i, x in enumerate(("ASHA", "RAMCO", "PUNE"))], "t long, Narration string")
    index = pipeline.build_company_index(companies, MatchOptions(), "id", "name")
    tasks, contenders = [], pipeline._contenders
    monkeypatch.setattr(session, "TASK_ROWS", rows)
    monkeypatch.setattr(pipeline, "_contenders", lambda pairs, *more: (tasks.append(pairs.rdd.getNumPartitions()), contenders(pairs, *more))[1])
    found = pipeline.match_transactions(txns, index, MatchOptions(), "t").results.collect()
    assert sorted((r["txn_id"], r["company_id"]) for r in found) == [(0, 0), (1, 1), (2, 2)]
    assert tasks == [wanted]
