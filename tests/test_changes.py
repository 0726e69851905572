import pytest
from pyspark.sql import functions as F

from narrakin.operators import locations
from narrakin.options import MatchOptions
from narrakin.plans import pipeline
from narrakin.session import scratch_path
from narrakin.sources import files

BASE = [(1, "STAR FOODS PUNE"), (2, "STAR FOODS PUNE"), (3, "ALPHA MOTORS"), (4, None), (5, ""), (6, "RAMCO SYSTEMS TIRUPUR"), (7, "ALPHA MOTORS")]
SCHEMA = "id long, name string"


def tables(index):
    """All stored tables as rows that can be compared; weights are rounded."""
    packed = [(r["target"], r["grams"], [round(w, 9) for w in r["weights"]]) for r in index.packed.collect()]
    plain = lambda df, *columns: sorted((tuple(map(str, r)) for r in df.select(*columns).collect()))
    return {
        "companies": plain(index.companies.withColumn("cities", F.array_sort("cities")), *sorted(index.companies.columns)),
        "members": plain(index.members, "target", "company_id", "place"), "frequencies": plain(index.frequencies, "gram", "df"),
        "packed": sorted(packed), "sizes": (index.n_texts, index.n_grams, index.postings, index.n_companies)}


CHANGES = {
    "another company with a text that is there": ([(0, "STAR FOODS PUNE")], []),
    "a company changes its name": ([(3, "BETA STEELS"), (2, "ALPHA MOTORS")], []),
    "some come, some go, one that never was": ([(10, "OMEGA PAPERS KUMBAKOT"), (11, None)], [1, 3, 7, 4, 6, 99]),
    "all go": ([], [1, 2, 3, 4, 5, 6, 7]),
}


@pytest.mark.parametrize("name", CHANGES)
def test_a_change_equals_building_anew(spark, name):
    added, withdrawn = CHANGES[name]
    path = scratch_path(spark, "changed")
    pipeline.build_company_index(spark.createDataFrame(BASE, SCHEMA), MatchOptions(), "id", "name", path=path)
    changed = pipeline.change_company_index(
        spark, path, MatchOptions(), spark.createDataFrame(added, SCHEMA) if added else None,
        spark.createDataFrame([(i,) for i in withdrawn], "id long") if withdrawn else None, "id", "name")
    replaced = {i for i, _ in added} | set(withdrawn)
    left = [r for r in BASE if r[0] not in replaced] + added
    fresh = pipeline.build_company_index(spark.createDataFrame(left, SCHEMA), MatchOptions(), "id", "name")
    assert tables(changed) == tables(fresh) == tables(pipeline.load_company_index(spark, path))


def test_many_changes_and_one_that_breaks_off(spark):
    path = scratch_path(spark, "changed")
    pipeline.build_company_index(spark.createDataFrame(BASE, SCHEMA), MatchOptions(), "id", "name", path=path)
    for i in range(2):
        pipeline.change_company_index(spark, path, added=spark.createDataFrame([(20 + i, f"NOVA {i} TRADERS")], SCHEMA), id_col="id", text_col="name")
    assert sorted(files.folders(spark, f"{path}/versions")) == ["1", "2"]
    before = tables(pipeline.load_company_index(spark, path))
    files.remove(spark, f"{path}/versions/2/complete")
    assert pipeline.load_company_index(spark, path).n_companies == len(BASE) + 1
    pipeline.change_company_index(spark, path, added=spark.createDataFrame([(21, "NOVA 1 TRADERS")], SCHEMA), id_col="id", text_col="name")
    assert tables(pipeline.load_company_index(spark, path)) == before
    pipeline.build_company_index(spark.createDataFrame(BASE, SCHEMA), MatchOptions(), "id", "name", path=path)
    assert pipeline.load_company_index(spark, path).n_companies == len(BASE)
    with pytest.raises(ValueError):
        pipeline.change_company_index(spark, scratch_path(spark, "nowhere"))


def test_vectors_change_with_their_companies(spark):
    path = scratch_path(spark, "changed")
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(1, 8)], "company_id long, vector array<double>")
    opts = MatchOptions(dense_numbers=4)
    pipeline.build_company_index(spark.createDataFrame(BASE, SCHEMA), opts, "id", "name", vectors, path)
    more = spark.createDataFrame([(3, [9.0, 9.0]), (8, [0.5, 2.0])], "company_id long, vector array<double>")
    pipeline.change_company_index(spark, path, opts, spark.createDataFrame([(3, "GAMMA"), (8, "DELTA")], SCHEMA),
                                  spark.createDataFrame([(1,)], "id long"), "id", "name", more)
    index = pipeline.load_company_index(spark, path)
    assert {r[0]: r[1] for r in index.vectors.collect()} == {i: [float(i), 1.0] for i in (2, 4, 5, 6, 7)} | {3: [9.0, 9.0], 8: [0.5, 2.0]}
    assert index.cells.rows.count() == 7


def test_parts_of_a_dictionary_add_up(spark):
    rows = [("omerode tirupur",), ("tirupur",), ("tirupur",), ("kumbakot",), ("plain words",), ("kumbakot tirupur tirupur",)]
    whole = spark.createDataFrame(rows, "loc_text string")
    counts = lambda df: {r["location"]: r["n"] for r in df.collect()}
    path = scratch_path(spark, "runs")
    assert files.read_location_runs(spark, path).count() == 0
    halves = spark.createDataFrame(rows[:3], "loc_text string"), spark.createDataFrame(rows[3:], "loc_text string")
    for run_id, part in (("a", halves[0]), ("b-2", halves[1]), ("a", halves[0])):
        files.add_location_run(locations.location_counts(part, F.lit(1)), path, run_id)
    want = counts(locations.location_counts(whole, F.lit(1)))
    assert want["tirupur"] == 4 and counts(files.read_location_runs(spark, path)) == want
    assert counts(files.read_location_runs(spark, path, without="a")) == counts(locations.location_counts(halves[1], F.lit(1)))
    with pytest.raises(ValueError):
        files.add_location_run(whole, path, "../a")


def test_a_run_knows_what_earlier_runs_found(spark):
    base = scratch_path(spark, "known")
    files.write_results(spark.createDataFrame([(1, "STAR FOODS")], SCHEMA), f"{base}/c.csv")
    opts = MatchOptions(company_column=("name",))
    done = []
    for run_id, text in (("one", "UPI/A/KUMARAN TIRUPUR"), ("two", "UPI/A/XTIRUPURX")):
        files.write_results(spark.createDataFrame([(1, text)], "t long, Narration string"), f"{base}/t.csv")
        out = pipeline.run(spark, f"{base}/c.csv", f"{base}/t.csv", f"{base}/o.csv", opts, locations_path=f"{base}/places",
                           company_id="id", txn_id="t", run_id=run_id)
        done.append(files.read_table(spark, out.path).first()["txn_cities"])
    assert done == ["tirupur"] * 2
    assert {r["location"]: (r["n"], r["runs"]) for r in files.read_location_runs(spark, f"{base}/places").collect()} == {"tirupur": (1, 1)}
