import random

import numpy as np
from frames import first_of_linked, no_docs, odd_docs, plain_components, plain_fingerprint
from pyspark.sql import Row

from narrakin.llm import components, simhash
from narrakin.llm.tables import table

SF = "/root/testdata/sf0.001"


def test_groups_equal_brute_force(spark):
    rows = table(spark, SF, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    prints = [plain_fingerprint(r["text"]) for r in rows]
    roots = plain_components(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    got = {r["doc_id"]: r for r in simhash.near_duplicates(spark, table(spark, SF, "documents")).collect()}
    assert len(got) == len(rows)
    for i, row in enumerate(rows):
        assert got[row["doc_id"]]["fp"] % (1 << 64) == prints[i]
        assert got[row["doc_id"]]["component_id"] == rows[roots[i]]["doc_id"]


def noisy(random_, centre, flips):
    for bit in random_.sample(range(64), flips):
        centre ^= 1 << bit
    return centre


def some_prints():
    random_ = random.Random(5)
    prints = {0, (1 << 64) - 1}
    for _ in range(40):
        centre = random_.getrandbits(64)
        prints |= {noisy(random_, centre, random_.randint(0, 9)) for _ in range(8)}
    return sorted(prints)


def test_bit_slices_find_every_link():
    prints = np.array(some_prints() * 1, np.uint64)
    edges = simhash.near(np.zeros(len(prints), np.int64), prints)
    links = [(i, j) for i in range(len(prints)) for j in range(i) if (int(prints[i]) ^ int(prints[j])).bit_count() <= 4]
    assert plain_components(len(prints), edges) == plain_components(len(prints), links)
    assert all((int(prints[a]) ^ int(prints[b])).bit_count() <= 4 for a, b in edges)


def test_buckets_and_tiles_lose_nothing(spark):
    prints = some_prints()
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    place = {p: i for i, p in enumerate(signed)}
    links = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    want = plain_components(len(prints), links)
    for tile in (simhash.TILE, 3):
        got = [(place[r["a"]], place[r["b"]]) for r in simhash.link_fingerprints(spark, frame, tile).collect()]
        assert plain_components(len(prints), got) == want


def test_odd_rows(spark):
    docs = odd_docs(spark)
    got = simhash.near_duplicates(spark, docs).collect()
    assert len(got) == docs.count()
    zero = {r["doc_id"] for r in got if r["fp"] == 0}
    assert zero == {2, 3, 4, None} and all(r["component_id"] == 2 for r in got if r["fp"] == 0)
    assert {r["component_id"] for r in got if r["doc_id"] == 8} == {1}
    stay = simhash.one_of_each_group(spark, docs)
    assert stay.columns == docs.columns
    kept = stay.collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept) == [(False, x) for x in (1, 1, 2, 5, 6, 7)] + [(True, 0)]


def test_empty_table(spark):
    assert simhash.near_duplicates(spark, no_docs(spark)).count() == 0
    assert simhash.one_of_each_group(spark, no_docs(spark)).columns == no_docs(spark).columns
    assert simhash.one_of_each_group(spark, no_docs(spark)).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 7), (7, 8), (8, 7), (8, 7)] + [(500, x) for x in range(501, 600)]
    frame = spark.createDataFrame(edges + [(None, 3)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(spark, frame).collect()}
    want = {i: 100 for i in range(100, 161)} | {7: 7, 8: 7} | {x: 500 for x in range(500, 600)}
    assert got == want
    assert components.connected_components(spark, frame.limit(0)).count() == 0


def test_wide_radius_finds_every_link():
    random_ = random.Random(7)
    prints = np.array([noisy(random_, random_.getrandbits(64) if i % 10 == 0 else 0x0F0F3C3C5A5A9669, random_.randint(0, 24)) for i in range(150)], np.uint64)
    groups = np.repeat([3, 8], [20, 130])
    for radius in (1, 4, 15, 16, 22):
        links = [(j, i) for i in range(150) for j in range(i) if groups[i] == groups[j] and (int(prints[i]) ^ int(prints[j])).bit_count() <= radius]
        got = simhash.near(groups, prints, radius)
        assert {tuple(sorted(e)) for e in got} <= set(links)
        assert plain_components(150, got) == plain_components(150, links)


def test_one_of_each_group_of_the_given_table(spark):
    docs = table(spark, SF, "documents")
    stay = simhash.one_of_each_group(spark, docs).collect()
    assert {r["doc_id"] for r in stay} == first_of_linked(docs.select("doc_id", "text").collect()) and len(stay) < docs.count()


def test_copies_of_an_article_leave_one(spark):
    random_ = random.Random(3)
    base = [f"w{random_.getrandbits(40)}" for _ in range(400)]
    texts = [base, base, [*base[:200], "other", *base[201:]], [f"w{random_.getrandbits(40)}" for _ in range(400)]]
    frame = spark.createDataFrame([Row(doc_id=i + 5, text=" ".join(t).upper() if i == 1 else " ".join(t)) for i, t in enumerate(texts)])
    assert {r["doc_id"] for r in simhash.one_of_each_group(spark, frame).collect()} == {5, 8}
