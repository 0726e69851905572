import random

from pyspark.sql import functions as F

from narrakin.functions import places
from narrakin.operators import locations


def one(spark, step, value):
    return spark.createDataFrame([(value,)], "v string").select(step(F.col("v")).alias("x")).first().x


def test_location_text(spark):
    assert one(spark, places.location_text, "NEFT/RAMCO-12345/VELLORE_ab COIMBATORE") == "ramco vellore"
    assert one(spark, lambda c: places.location_text(c, True), "UPI COIMBATORE ABCDE12345") == "coimbatore"
    assert one(spark, places.location_text, None) == ""


def test_suffixes_and_major_cities(spark):
    assert one(spark, places.suffix_locations, "tirupur pur tirupur kumbakot") == ["tirupur", "kumbakot"]
    assert one(spark, places.suffix_locations, "xpur xxpur xxxpur") == ["xxxpur"]
    assert one(spark, places.major_cities, "agrarian goods") == ["agra"]
    assert one(spark, places.major_cities, "pune chennai") == ["chennai", "pune"]


def test_gazetteer_keeps_text_order(spark):
    texts = spark.createDataFrame([("shop old town salem",), ("salem salem",), ("none",)], "loc_text string")
    table = spark.createDataFrame([("Salem",), ("old town",), ("town",), ("ab",)], "location string")
    got = {r.loc_text: r.gazetteer_locations for r in locations.gazetteer_hits(texts, table).collect()}
    assert got == {"shop old town salem": ["old town", "town", "salem"], "salem salem": ["salem"]}


def test_dictionary_hits_match_a_plain_scan(spark, monkeypatch):
    rng = random.Random(4)
    names = sorted({"".join(rng.choice("abn") for _ in range(rng.randint(3, 7))) for _ in range(60)})
    texts = sorted({" ".join("".join(rng.choice("abn") for _ in range(rng.randint(1, 9))) for _ in range(3))
                    for _ in range(120)})
    wanted = {t: hit for t in texts if (hit := [n for n in names if len(n) > 3 and n in t])}
    left = spark.createDataFrame([(t,) for t in texts], "loc_text string")
    right = spark.createDataFrame([(n,) for n in names], "location string")
    for limit in (500_000, 0):  # broadcast, then salted
        monkeypatch.setattr("narrakin.operators.skew.BROADCAST_ROWS", limit)
        got = {r.loc_text: r.known_locations for r in locations.dictionary_hits(left, right).collect()}
        assert got == wanted


def test_city_boost(spark):
    rows = [(["chennai"], ["chennai"], 3.0), ([], ["x"], 0.0), (["delhi"], ["pune"], 0.0),
            (["kancheepuram"], ["kanchipuram"], 2.0), (["cochin", "kochi"], ["kochin"], 2.0),
            (["salem"], ["sale", "zzz"], 2.0), (["vellore"], ["nellor"], 1.0), (["indore"], ["vadore"], 1.0)]
    df = spark.createDataFrame(rows, "a array<string>, b array<string>, wanted double")
    for r in df.withColumn("got", locations.city_boost(F.col("a"), F.col("b"))).collect():
        assert r.got == r.wanted, r


def test_dictionary_adds_to_prior_knowledge(spark):
    texts = locations.distinct_location_texts(spark.createDataFrame([("tirupur shop",), ("jaipur",)], "loc_text string"))
    prior = spark.createDataFrame([("oldtown",), ("jaipur",)], "location string")
    got = {r.location for r in locations.location_dictionary(texts, prior).collect()}
    assert got == {"tirupur", "jaipur", "oldtown"}


def test_gazetteer_entries_of_any_number_of_words(spark):
    texts = spark.createDataFrame([("to the andaman and nicobar islands by sea",)], "loc_text string")
    listed = spark.createDataFrame([("Andaman and Nicobar Islands",), ("sea",), ("by",)], "location string")
    assert locations.gazetteer_hits(texts, listed).first().gazetteer_locations == ["andaman and nicobar islands", "sea"]


def test_locations_that_rows_name(spark):
    rows = spark.createDataFrame([("a", [" Erode ", "ab", "ERODE", None]), ("a", ["Salem"]), ("b", None), ("b", ["x" * 30])], "loc_text string, e array<string>")
    assert [tuple(r) for r in locations.entity_locations(rows, "e").collect()] == [("a", ["erode", "salem"])]


def test_tasks_that_look_for_places_have_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr("narrakin.session.TASK_ROWS", 10)
    texts = spark.createDataFrame([(f"shop {i} nagarpur pune",) for i in range(400)] * 2, "loc_text string")
    found = locations.distinct_location_texts(texts)
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 400 and len(sizes) > 25 and max(sizes) < 40
    assert {tuple(r.major_cities) for r in found.collect()} == {("pune",)}
