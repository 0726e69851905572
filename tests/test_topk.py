import math
import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from narrakin import session
from narrakin.operators import blocks, postings, skew, topk, vectors
from narrakin.plans import pipeline
from narrakin.options import MatchOptions
from narrakin.session import slot_keys

K, FLOOR = 5, 0.3


def names(rng, n):
    pool = ["star", "motors", "foods", "ramco", "asha", "chennai", "pune", "é", "xyz"]
    return [" ".join(rng.choices(pool, k=rng.randint(1, 3))) for _ in range(n)]


def brute_force(company_texts, query_texts):
    """Plain TF-IDF cosine over every pair: {text: [(similarity, company_id), ...]}."""
    def grams(text):
        padded = f" {text} "
        return Counter(padded[i:i + 3] for i in range(len(text)))

    distinct = sorted(set(company_texts))
    df = Counter(g for t in distinct for g in grams(t))

    def unit(text):
        w = {g: n * (math.log((1 + len(distinct)) / (1 + df[g])) + 1) for g, n in grams(text).items()}
        size = math.sqrt(sum(v * v for v in w.values()))
        return {g: v / size for g, v in w.items()}

    sides = [(i, unit(t)) for i, t in enumerate(company_texts)]
    best = {}
    for q in set(query_texts):
        mine = unit(q)
        scored = [(round(sum(v * other.get(g, 0.0) for g, v in mine.items()), 9), i) for i, other in sides]
        best[q] = sorted([s for s in scored if s[0] >= FLOOR], key=lambda s: (-s[0], s[1]))[:K]
    return {q: hits for q, hits in best.items() if hits}


def as_lists(df, key="match_text"):
    got = {}
    for r in df.orderBy(key, "rank").collect():
        got.setdefault(r[key], []).append((r.similarity, r.company_id))
    return got


@pytest.mark.parametrize("path", ["broadcast", "joined", "joined in small parts"])
def test_sparse_search_is_exact_with_duplicates(spark, monkeypatch, path):
    rng = random.Random(5)
    company_texts = names(rng, 120) + ["star foods"] * 40  # a quarter share one name
    query_texts = names(rng, 60) + ["star foods", "qqq www", "s"]
    if path == "joined in small parts":
        monkeypatch.setattr(postings, "PART_POSTINGS", 300)
        monkeypatch.setattr(postings, "PART_QUERIES", 7)
    opts = MatchOptions(max_candidates=K, index_postings=10**9 if path == "broadcast" else 0)
    companies = spark.createDataFrame(list(enumerate(company_texts)), "company_id long, name string")
    index = pipeline.build_company_index(companies, opts, "company_id", "name")
    queries = spark.createDataFrame([(q,) for q in query_texts], "match_text string")
    got = as_lists(pipeline.sparse_candidates(queries, index, opts))
    wanted = brute_force(company_texts, query_texts)
    assert {q: [i for _, i in hits] for q, hits in got.items()} == {
        q: [i for _, i in hits] for q, hits in wanted.items()}
    for q, hits in wanted.items():
        assert [s for s, _ in got[q]] == pytest.approx([s for s, _ in hits], abs=2e-9)


def test_texts_searched_in_slices_find_the_same_and_leave_only_that(spark, monkeypatch, tmp_path):
    rng = random.Random(6)
    company_texts, query_texts = names(rng, 150), sorted(set(names(rng, 90)))
    opts = MatchOptions(max_candidates=K, index_postings=0)
    companies = spark.createDataFrame(list(enumerate(company_texts)), "company_id long, name string")
    index = pipeline.build_company_index(companies, opts, "company_id", "name")
    queries = spark.createDataFrame([(q,) for q in query_texts], "match_text string")
    monkeypatch.setattr(postings, "PART_POSTINGS", 300)
    monkeypatch.setattr(postings, "PART_QUERIES", 1)
    monkeypatch.setattr(postings, "SLICE_MEETINGS", 80)
    monkeypatch.setattr(session, "SLICE_ROWS", 30)
    monkeypatch.setattr(session, "SLICE_ROWS_PER_CORE", 1)
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    got = as_lists(pipeline.sparse_candidates(queries, index, opts))
    assert {q: [i for _, i in hits] for q, hits in got.items()} == {
        q: [i for _, i in hits] for q, hits in brute_force(company_texts, query_texts).items()}
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["candidates"]


def test_stored_tables_leave_no_shuffle_files(spark):
    files = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    held = lambda: {f for f in files() if "shuffle_" in f}
    before = held()
    rows = session.settle(spark.range(10_000).repartition(7, "id").groupBy((F.col("id") % 100).alias("k")).count(), "shuffled")
    until = time.time() + 20
    while held() - before and time.time() < until:
        time.sleep(0.2)
    assert not held() - before and rows.count() == 100
    assert spark.conf.get(session._CLEANUP) == "false"


def test_weights_have_unit_length(spark):
    texts = spark.createDataFrame([("star motors",), ("star foods",), ("aaa",)], "match_text string")
    counts = vectors.gram_counts(texts)
    frequencies = vectors.gram_frequencies(counts)
    rows = vectors.tfidf(counts, frequencies, frequencies.count(), 3).collect()
    for text in {r.match_text for r in rows}:
        assert sum(r.weight ** 2 for r in rows if r.match_text == text) == pytest.approx(1.0)


@pytest.mark.parametrize("chars", [1, 40, 1 << 20])
def test_texts_are_weighed_where_they_lie(spark, monkeypatch, chars):
    monkeypatch.setattr(vectors, "_STEP_CHARS", chars)
    stored = names(random.Random(7), 60) + ["aaaaa aaaa", "", "x", "\U0001f600 pune \U0001f600"]
    rows = spark.createDataFrame([(t, i) for i, t in enumerate(sorted(set(stored)))] + [(None, -1)], "match_text string, target long")
    frequencies = vectors.gram_frequencies(vectors.gram_counts(rows))
    pairs = lambda df: sorted((r["gram"], r["df"]) for r in df.collect())
    assert pairs(vectors.piece_frequencies(rows)) == pairs(frequencies)
    asked = rows.unionByName(spark.createDataFrame([("qqq \u00e9\u00e9 star", 99)], rows.schema))
    for known in (frequencies, frequencies.limit(0)):
        plain = {r["match_text"]: (r["grams"], r["weights"]) for r in vectors.pack(vectors.tfidf(vectors.gram_counts(asked), known, 9, 60)).collect()}
        for limit in (skew.BROADCAST_ROWS, 8):
            monkeypatch.setattr(skew, "BROADCAST_ROWS", limit)
            got = vectors.packed_tfidf(asked, known, 9, 60)
            assert got.columns == ["match_text", "target", "grams", "weights"]
            found = {r["match_text"]: r for r in got.collect()}
            assert {t: r["grams"] for t, r in found.items()} == {t: g for t, (g, _) in plain.items()}
            for t, (_, weights) in plain.items():
                assert found[t]["weights"] == pytest.approx(weights, abs=1e-12)
        monkeypatch.undo()
        monkeypatch.setattr(vectors, "_STEP_CHARS", chars)


def test_query_texts_are_not_taken_apart_into_rows(spark):
    companies = spark.createDataFrame(list(enumerate(names(random.Random(8), 30))), "company_id long, name string")
    index = pipeline.build_company_index(companies, MatchOptions(), "company_id", "name")
    plan = pipeline.query_vectors(companies.withColumnRenamed("name", "match_text"), index)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Window" not in plan


def test_parts_meet_in_no_more_tasks_than_their_queries_need(spark, monkeypatch):
    monkeypatch.setattr(postings, "PART_QUERIES", 100)
    keys, taken = postings.slot_keys, []
    monkeypatch.setattr(postings, "slot_keys", lambda session, n: (taken.append(n), keys(session, n))[1])
    held, asked = sparse_table(np.random.default_rng(9), 400, 200), sparse_table(np.random.default_rng(10), 3000, 200)
    held, asked = (spark.createDataFrame(t.to_pylist(), "target long, grams array<long>, weights array<double>") for t in (held, asked))
    found = postings.search_in_parts(asked.withColumnRenamed("target", "t"), held, "t", K, FLOOR, 3, 1)
    assert found.count() and taken == [3 * 10, 3 * 20]  # 3,000 meetings of a query and a part first, then 6,000


def dense_sides(spark, seed=6, n=400):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, 16))
    matrix = centres[rng.integers(0, 8, n)] + 0.4 * rng.normal(size=(n, 16))
    matrix[: n // 3] = matrix[0]  # a third of the rows are one vector
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    left = spark.createDataFrame(rows, "txn_id long, vector array<double>")
    return left, left.withColumnRenamed("txn_id", "company_id"), unit @ unit.T


def test_dense_search_is_exact_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(blocks, "QUERY_BLOCK", 50)
    monkeypatch.setattr(blocks, "TARGET_BLOCK", 60)
    left, right, cosine = dense_sides(spark)
    got = as_lists(topk.dense_topk(left, right, K, FLOOR), "txn_id")
    for i, row in enumerate(cosine):
        scored = sorted(((-round(s, 9), j) for j, s in enumerate(row) if round(s, 9) >= FLOOR))[:K]
        assert [j for _, j in got[i]] == [j for _, j in scored]


def test_lsh_finds_most_of_the_exact_neighbours(spark):
    left, right, _ = dense_sides(spark)
    exact = as_lists(topk.dense_topk(left, right, K, FLOOR), "txn_id")
    near = as_lists(topk.lsh_topk(left, right, K, FLOOR, 12, 6, 42), "txn_id")
    truth = {(q, i) for q, hits in exact.items() for _, i in hits}
    found = {(q, i) for q, hits in near.items() for _, i in hits}
    scores = {(q, i): s for q, hits in exact.items() for s, i in hits}
    assert len(truth & found) / len(truth) > 0.9
    assert all(s == scores[q, i] for q, hits in near.items() for s, i in hits if (q, i) in scores)


def test_model_vectors(spark):
    df = spark.createDataFrame([("ab",), ("abcd",)], "t string")

    def load():
        return lambda texts: [[len(t), 1.0] for t in texts]

    got = {r.t: r.vector for r in vectors.with_model_vectors(df, "t", load).collect()}
    assert got == {"ab": [2.0, 1.0], "abcd": [4.0, 1.0]}


def sparse_table(rng, n, pieces, first=0):
    rows = []
    for i in range(n):
        codes = rng.choice(pieces, size=int(rng.integers(0, 12)), replace=False, p=np.arange(pieces, 0, -1) / (pieces * (pieces + 1) / 2))
        weights = rng.random(len(codes))
        rows.append((first + i, codes.tolist(), (weights / max(np.linalg.norm(weights), 1e-12)).tolist()))
    return pa.table({"target": pa.array([r[0] for r in rows], pa.int64()), "grams": pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                     "weights": pa.array([r[2] for r in rows], pa.list_(pa.float64()))})


@pytest.mark.parametrize("size", [0, 1, 100, 3000])
def test_blocks_that_cannot_hold_a_better_target_are_skipped(size):
    rng = np.random.default_rng(size)
    held, asked = sparse_table(rng, size, 200), sparse_table(rng, 80, 260)
    index = postings.PostingBlocks(held)
    rows, at, values = index.search(asked, K, FLOOR)
    got = {}
    for r, t, v in zip(rows, at, values):
        got.setdefault(int(r), []).append((-v, int(t)))
    touched = 0
    for i in range(len(asked)):
        mine = dict(zip(asked["grams"][i].as_py(), asked["weights"][i].as_py()))
        scored = []
        for j in range(size):
            pairs = [(g, w) for g, w in zip(held["grams"][j].as_py(), held["weights"][j].as_py()) if g in mine]
            touched += len(pairs)
            score = round(sum(mine[g] * w for g, w in pairs), 9)
            if pairs and score >= FLOOR:
                scored.append((-score, j))
        assert [j for _, j in got.get(i, [])] == [j for _, j in sorted(scored)[:K]]
        assert [-s for s, _ in got.get(i, [])] == pytest.approx([-s for s, _ in sorted(scored)[:K]], abs=2e-9)
    assert index.read <= touched and (size < 3000 or index.read < touched)


def test_blocks_of_texts_from_few_words_are_mostly_skipped():
    rng = np.random.default_rng(4)
    word = lambda first, n: (first + 10 * rng.integers(n) + np.arange(6)).tolist()
    rare = rng.choice(90000, 60000, replace=False)
    codes = [word(0, 20) + word(1000, 12) + word(2000, 16) + [3000 + int(r) // 90, 10000 + int(r)] for r in rare]
    weights = np.array([1.0] * 18 + [2.0, 3.0])
    weights = [(weights / np.linalg.norm(weights)).tolist()] * len(codes)
    held = pa.table({"target": pa.array(range(len(codes)), pa.int64()), "grams": pa.array(codes, pa.list_(pa.int64())),
                     "weights": pa.array(weights, pa.list_(pa.float64()))})
    index = postings.PostingBlocks(held)
    index.search(held.slice(0, 100), K, FLOOR)
    touched = sum(np.bincount(np.concatenate(codes))[codes[i]].sum() for i in range(100))
    assert index.read < touched / 5


def test_tables_follow_from_bits_and_recall():
    assert topk.lsh_tables(4, 0.3, 0.9) == 17
    assert topk.lsh_tables(8, 0.3, 0.9) > 100 > topk.lsh_tables(8, 0.8, 0.9)


def test_every_pair_of_parts_is_a_task_of_its_own(spark):
    pairs = spark.range(45 * 3).withColumn("slot", F.get(slot_keys(spark, 45), (F.col("id") % 45).cast("int")))
    held = pairs.repartition(45, "slot").groupBy(F.spark_partition_id()).agg(F.count("*").alias("rows"), F.count_distinct("slot").alias("n"))
    assert [(r["rows"], r["n"]) for r in held.collect()] == [(3, 1)] * 45


def test_buckets_are_cut_by_the_numbers_they_hold(spark, monkeypatch):
    called = spark.sparkContext.accumulator(0)

    def targets(vectors):
        called.add(1)
        return blocks.DenseTargets(vectors)

    rows = spark.range(9000).select(F.lit(0).cast("long").alias("bucket"), F.col("id").alias("target"),
                                    F.array(F.lit(1.0), (F.col("id") / 9000).cast("double")).alias("vector"))
    asked = rows.withColumnRenamed("target", "txn_id")
    best = []
    for numbers, calls in ((blocks.BLOCK_NUMBERS, 1), (9000, 4)):
        monkeypatch.setattr(blocks, "BLOCK_NUMBERS", numbers)
        called.value = 0
        found = topk.keep_best(blocks.bucket_search(asked, rows, "txn_id", ["vector"], targets, K, FLOOR), "txn_id", "target", K)
        best.append(found.orderBy("txn_id", "rank").collect())
        assert called.value == calls
    assert best[0] == best[1]
