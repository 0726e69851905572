from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from narrakin import session
from narrakin.operators.skew import fan_out_join
from narrakin.options import MatchOptions
from narrakin.plans import fixtures, pipeline
from narrakin.session import scratch_path
from narrakin.sources import files

COMPANIES = [(1, "KUMARAN HARDWARE"), (2, "GANESH AGENCIES CHENNAI"), (3, "RAMCO SYSTEMS VELLORE"),
             (4, None), (5, "RAMCO SYSTEMS VELLORE"), (6, "")]
NARRATIONS = [(1, "NEFT/IQOV94360237845587/RAMCO SYSTEMS VELLORE"), (2, None), (3, "UPI/NUCF28468607902813/QQQQWWW"),
              (4, "IMPS/FIGP38418043050302/KUMARAN HARDWARE HDFC BANK"), (5, "")]


def run(spark, opts=MatchOptions(), narrations=NARRATIONS):
    index = pipeline.build_company_index(
        spark.createDataFrame(COMPANIES, "id long, name string"), opts, "id", "name")
    txns = spark.createDataFrame(narrations, "txn_id long, Narration string")
    return pipeline.match_transactions(txns, index, opts, "txn_id")


def test_every_narration_gets_exactly_one_line(spark):
    got = {r.txn_id: r for r in run(spark).results.collect()}
    assert sorted(got) == [1, 2, 3, 4, 5]
    assert (got[1].company_id, got[1].final_score, got[1].city_boost) == (3, 100.0, 3.0)
    assert got[4].company_name == "KUMARAN HARDWARE"
    for blank in (2, 3, 5):
        assert got[blank].company_name == "NO_MATCH" and got[blank].final_score == 0.0
    assert got[3].detected_company_name == "qqqqwww"


def test_texts_matched_in_slices_get_the_same_results(spark, monkeypatch):
    names = ["STAR FOODS PUNE", "RAMCO SYSTEMS VELLORE", "GANESH AGENCIES CHENNAI", "ANAND MOTORS SALEM"]
    companies = spark.createDataFrame([(i, f"{names[i % 4]} {chr(65 + i)}{chr(70 + i)}") for i in range(16)], "id long, name string")
    shown = [f"{names[i % 4]} {chr(65 + i % 14)}{chr(70 + i % 14)}" for i in range(40)] + ["QQQQWWW", None, "", "STAR FOODS"]
    txns = spark.createDataFrame([(i, t if t is None else f"NEFT/IQOV94360237845587/{t}") for i, t in enumerate(shown)], "txn_id long, Narration string")
    near = [(i, [float(i % 5), 1.0, float(i % 3)]) for i in range(44)]
    given = spark.createDataFrame(near[:16], "company_id long, vector array<double>")
    asked = spark.createDataFrame(near + [(3, [9.0, 1.0, 2.0])], "txn_id long, vector array<double>")  # one id has two vectors
    slices = []

    def results(**vectors):
        index = pipeline.build_company_index(companies, MatchOptions(), "id", "name", vectors_table=given if vectors else None)
        return sorted(map(str, pipeline.match_transactions(txns, index, MatchOptions(), "txn_id", **vectors).results.collect()))

    whole = results(), results(txn_vectors=asked)
    monkeypatch.setattr(session, "SLICE_ROWS", 3)
    monkeypatch.setattr(session, "SLICE_ROWS_PER_CORE", 0)
    turns = session.in_turn
    monkeypatch.setattr(session, "in_turn", lambda spark, name, steps, path=None: (slices.append((name, len(steps))), turns(spark, name, steps, path))[1])
    assert results() == whole[0]
    assert [n > 1 for name, n in slices if name == "winners"] == [True]
    monkeypatch.setattr(session, "SLICE_ROWS", 15)
    monkeypatch.setattr(pipeline, "_HASHES", {"_hash": lambda c: F.size(c), "_hash_too": lambda c: F.size(c)})  # all vectors have the same hashes
    assert results(txn_vectors=asked) == whole[1]
    assert [n > 1 for name, n in slices if name == "winners"] == [True, True]


def test_hot_narration_is_complete(spark):
    hot = [(i, NARRATIONS[0][1] if i % 3 == 0 else f"UPI/X/SHOP {i}") for i in range(3000)]
    results = run(spark, narrations=hot).results
    assert results.count() == 3000 and results.select("txn_id").distinct().count() == 3000
    assert results.filter(F.col("company_id") == 3).count() == 1000


def test_fan_out_join_keeps_every_row(spark):
    rows = spark.range(5000).select(F.col("id").alias("txn_id"), F.when(F.col("id") < 2000, 0).otherwise(F.col("id")).alias("k"))
    counts = rows.groupBy("k").agg(F.count("*").alias("n_rows"))
    results = counts.select("k", (F.col("k") * 2).alias("value"))
    got = fan_out_join(rows, results, counts, ["k"], ["txn_id"])
    assert got.count() == 5000 and got.filter(F.col("value") != F.col("k") * 2).count() == 0


def test_supplied_vectors_exact_and_lsh(spark):
    companies = spark.createDataFrame([(1, "ALPHA FOODS"), (2, "BETA MOTORS")], "id long, name string")
    side = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "company_id long, vector array<float>")
    txns = spark.createDataFrame([(1, "alpha"), (2, "beta")], "txn_id long, Narration string")
    asked = spark.createDataFrame([(1, [0.9, 0.1]), (2, [-1.0, 0.0])], "txn_id long, vector array<float>")
    for search, tag in (("auto", "exact"), ("lsh", "lsh")):
        opts = MatchOptions(search=search, lsh_tables=16)
        index = pipeline.build_company_index(companies, opts, "id", "name", side)
        got = {r.txn_id: r for r in pipeline.match_transactions(
            txns, index, opts, "txn_id", txn_vectors=asked).results.collect()}
        assert got[1].company_id == 1 and got[1].backend_used == tag
        assert got[2].company_name == "NO_MATCH"


def test_run_over_files_reuses_tables_and_locations(spark):
    base = scratch_path(spark, "files-test")
    files.write_results(spark.createDataFrame(COMPANIES[:3], "Company_ID long, Company_Name string"), f"{base}/c.csv")
    txns = NARRATIONS + [(6, "UPI/A/KUMARAN TIRUPUR")]
    files.write_results(spark.createDataFrame(txns, "Transaction_ID long, Narration string"), f"{base}/t.csv")
    opts = MatchOptions(company_column=("Company_Name",), output_columns={"backend_used": False})
    args = (f"{base}/c.csv", f"{base}/t.csv")
    first = pipeline.run(spark, *args, f"{base}/one.csv", opts, f"{base}/index", f"{base}/places.txt",
                         "Company_ID", "Transaction_ID")
    lines = [r.value for r in spark.read.text(f"{base}/places.txt").collect()]
    assert any(x.startswith("#") for x in lines) and "tirupur" in lines
    second = pipeline.run(spark, f"{base}/missing.csv", args[1], f"{base}/two.csv", opts, f"{base}/index",
                          f"{base}/places.txt", txn_id="Transaction_ID")
    one, two = (files.read_table(spark, p.path) for p in (first, second))
    assert "backend_used" not in one.columns
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, two.collect()), key=str)


def test_summary_is_counted_while_results_are_written(spark):
    base = scratch_path(spark, "summary-test")
    files.write_results(spark.createDataFrame(COMPANIES[:3], "Company_ID long, Company_Name string"), f"{base}/c.csv")
    files.write_results(spark.createDataFrame(NARRATIONS, "Transaction_ID long, Narration string"), f"{base}/t.csv")
    opts = MatchOptions(company_column=("Company_Name",), output_columns={"final_score": False})
    for sort in (True, False):
        out = pipeline.run(spark, f"{base}/c.csv", f"{base}/t.csv", f"{base}/o.csv", replace(opts, sort_by_score=sort),
                           company_id="Company_ID", txn_id="Transaction_ID")
        shown = files.read_table(spark, out.path)
        assert "final_score" not in shown.columns and "_score" not in shown.columns
        assert out.summary["total_results"] == shown.count() == len(NARRATIONS)
        assert out.summary["unmatched"] == shown.where("company_name = 'NO_MATCH'").count()
        assert out.summary["matched"] == sum(out.summary[f"{tier}_scores"] for tier in ("high", "medium", "low"))


def _files(spark, base, *texts):
    for n, text in enumerate(texts):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{base}/{n}")
    return f"{base}/*"


def test_rows_with_too_few_or_too_many_fields_are_set_aside(spark):
    base = scratch_path(spark, "rejects-test")
    path = _files(spark, base, 'id,name\n1,ALPHA FOODS\n2\n3,"B, C",x\n4,"D ""E"" F"\n5,')
    good, bad = files.read_csv_apart(spark, path)
    assert sorted(map(tuple, good.collect())) == [("1", "ALPHA FOODS"), ("4", 'D "E" F'), ("5", None)]
    assert sorted(r["line"] for r in bad.collect()) == ["2", '3,"B, C",x'] and base.split("/")[-1] in bad.first()["file"]
    assert sorted(r["id"] for r in good.select("id").collect()) == ["1", "4", "5"] and good.select("name").count() == 3
    kept = files.read_csv(spark, path)
    assert sorted(map(tuple, kept.collect()), key=str) == [("1", "ALPHA FOODS"), ("2", None), ("3", "B, C"), ("4", 'D "E" F'), ("5", None)]


def test_files_whose_header_differs_are_named(spark):
    base = scratch_path(spark, "headers-test")
    for other in ("name,id\nALPHA,1", "id,title\n1,ALPHA", "id,name,more\n1,ALPHA,x"):
        path = _files(spark, f"{base}/{abs(hash(other))}", "id,name\n1,ALPHA\n2,BETA", other)
        with pytest.raises(Exception, match="(?i)header"):
            files.read_csv(spark, path).collect()
    same = files.read_csv(spark, _files(spark, f"{base}/same", "id,name\n1,A", "id,name\n2,B"))
    assert same.count() == 2
    assert files.read_csv(spark, _files(spark, f"{base}/repeated", "id,id,\n1,A,B")).count() == 1
    assert files.read_csv(spark, _files(spark, f"{base}/only", "id,name")).count() == 0


def test_a_run_writes_what_it_rejects(spark):
    base = scratch_path(spark, "rejecting-run")
    for name, text in (("c.csv", "id,name\n1,ALPHA FOODS\n2,BETA MOTORS,x"), ("t.csv", "t,Narration\n1,NEFT/ALPHA FOODS\n2")):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{base}/{name}")
    out = pipeline.run(spark, f"{base}/c.csv", f"{base}/t.csv", f"{base}/o.csv", MatchOptions(company_column=("name",)), company_id="id",
                       txn_id="t", rejects_path=f"{base}/rejects")
    assert out.summary["rejected_rows"] == 2 and out.summary["total_results"] == 1
    assert sorted(r["line"] for r in spark.read.parquet(f"{base}/rejects").collect()) == ["2", "2,BETA MOTORS,x"]


def test_unreadable_input_fails(spark):
    with pytest.raises(Exception):
        files.read_table(spark, "/nonexistent/companies.csv")


def test_column_choice(spark):
    df = spark.createDataFrame([("1", "a", "b")], "Company_ID string, Memo string, Details string")
    assert files.company_text_column(df) == "Company_ID"
    assert files.company_text_column(df, ["Memo"]) == "Memo"
    assert files.company_text_column(df, ["None"]) == "Company_ID"
    assert files.narration_text_column(df) == "Details"
    assert files.narration_text_column(df, ["Memo"]) == "Memo"
    assert files.narration_text_column(df.drop("Memo", "Details")) == "Company_ID"


def test_ordinals_follow_the_order(spark):
    df = spark.range(1000).select((999 - F.col("id")).alias("v")).repartition(7)
    got = files.with_ordinal(df, ["v"], "n")
    assert got.filter(F.col("n") != F.col("v")).count() == 0 and got.count() == 1000


def test_pipe_text_round_trip(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],)], "x array<string>")
    back = files.text_columns_to_lists(files.list_columns_to_text(df, ["x"]), ["x"])
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_true_companies_are_found(spark):
    sf = "/root/testdata/sf0.001"
    index = pipeline.build_company_index(fixtures.companies(spark, sf), MatchOptions(), "company_id", "company_name")
    run = pipeline.match_transactions(fixtures.narrations(spark, sf), index, MatchOptions(), "txn_id", "narration")
    known = run.results.join(fixtures.narrations(spark, sf).select("txn_id", "true_company_id"), "txn_id").filter(
        F.col("txn_id") % 8 != 7)
    hit = known.agg(F.avg((F.col("company_id") == F.col("true_company_id")).cast("int")).alias("p")).first().p
    assert hit > 0.98


def test_shuffle_plans_give_the_broadcast_results(spark, monkeypatch):
    """A third of the narrations equal, and no side small enough to broadcast."""
    hot = [(i, "UPI/ZZ/RAMCO SYSTEMS VELLORE" if i % 3 == 0 else f"NEFT/Q/KUMARAN HARDWARE {i % 50}")
           for i in range(600)]
    plain = run(spark, narrations=hot).results.orderBy("txn_id").collect()
    monkeypatch.setattr("narrakin.operators.skew.BROADCAST_ROWS", 0)
    monkeypatch.setattr("narrakin.operators.skew.BROADCAST_BYTES", 0)
    monkeypatch.setattr("narrakin.operators.blocks.QUERY_BLOCK", 9)
    monkeypatch.setattr("narrakin.operators.blocks.TARGET_BLOCK", 2)
    shuffled = run(spark, MatchOptions(index_postings=0), hot).results.orderBy("txn_id").collect()
    assert len(plain) == 600 and plain == shuffled


def test_gazetteer_reaches_the_results(spark):
    companies = spark.createDataFrame([(1, "ALPHA FOODS ERODE")], "id long, name string")
    txns = spark.createDataFrame([(1, "UPI/1/ALPHA FOODS ERODE")], "txn_id long, Narration string")
    places = spark.createDataFrame([("erode",)], "location string")
    for detect, boost in ((True, 3.0), (False, 0.0)):
        opts = MatchOptions(enable_automated_city_detection=detect)
        index = pipeline.build_company_index(companies, opts, "id", "name")
        row = pipeline.match_transactions(txns, index, opts, "txn_id", gazetteer=places).results.first()
        assert row.city_boost == boost


def test_rows_without_an_id_are_numbered(spark):
    companies = spark.createDataFrame([("ALPHA FOODS",), ("BETA MOTORS",)], "name string")
    txns = spark.createDataFrame([("BETA MOTORS",), ("ALPHA FOODS",)], "Narration string")
    index = pipeline.build_company_index(companies)
    got = {r.transaction_text: (r.txn_id, r.company_id) for r in pipeline.match_transactions(txns, index).results.collect()}
    assert got == {"ALPHA FOODS": (0, 0), "BETA MOTORS": (1, 1)}


def test_text_ids_are_kept_apart(spark):
    companies = spark.createDataFrame([("01", "ALPHA FOODS"), ("1", "BETA MOTORS"), ("EC00002", "GAMMA STEELS")], "id string, name string")
    txns = spark.createDataFrame([("TXN1", "UPI/1/BETA MOTORS"), ("TXN01", "UPI/1/ALPHA FOODS"), ("x", "GAMMA STEELS")], "t string, Narration string")
    for postings in (MatchOptions().index_postings, 0):
        opts = MatchOptions(index_postings=postings)
        index = pipeline.build_company_index(companies, opts, "id", "name")
        got = {r.txn_id: r.company_id for r in pipeline.match_transactions(txns, index, opts, "t").results.collect()}
        assert got == {"TXN1": "1", "TXN01": "01", "x": "EC00002"}


def test_all_input_columns_are_returned(spark):
    companies = spark.createDataFrame([(1, "ALPHA FOODS")], "id long, name string")
    txns = spark.createDataFrame([(7, "UPI/1/ALPHA FOODS", "2024-05-26", 3.5, "99")], "t long, Narration string, Date string, `A.mount` double, final_score string")
    opts = MatchOptions(keep_input_columns=True)
    index = pipeline.build_company_index(companies, opts, "id", "name")
    row = pipeline.finish(pipeline.match_transactions(txns, index, opts, "t"), opts).first()
    assert (row["Date"], row["A.mount"], row["company_id"], row["txn_id"]) == ("2024-05-26", 3.5, 1, 7)


def test_stale_and_half_written_indexes_are_made_anew(spark):
    base = scratch_path(spark, "stale-test")
    path = f"{base}/index"
    first = spark.createDataFrame([(1, "ALPHA FOODS")], "id long, name string")
    pipeline.build_company_index(first, MatchOptions(), "id", "name", path=path)
    same = pipeline.manifest(first, MatchOptions(), "id", "name")
    assert pipeline.stored_index_fits(spark, path, MatchOptions(), same)
    assert not pipeline.stored_index_fits(spark, path, MatchOptions(keep_long_alpha_words=True), None)
    other = spark.createDataFrame([(1, "ALPHA FOODS"), (2, "BETA MOTORS")], "id long, name string")
    assert not pipeline.stored_index_fits(spark, path, MatchOptions(), pipeline.manifest(other, MatchOptions(), "id", "name"))
    files.write_results(other, f"{base}/c.csv")
    files.write_results(spark.createDataFrame([(1, "BETA MOTORS")], "t long, Narration string"), f"{base}/t.csv")
    opts = MatchOptions(company_column=("name",))
    out = pipeline.run(spark, f"{base}/c.csv", f"{base}/t.csv", f"{base}/o.csv", opts, path, company_id="id", txn_id="t")
    assert files.read_table(spark, out.path).first()["company_name"] == "BETA MOTORS"
    files.remove(spark, f"{path}/manifest")
    with pytest.raises(ValueError):
        pipeline.load_company_index(spark, path)


def test_more_candidates_than_the_index_was_built_with(spark):
    companies = spark.createDataFrame([(i, "STAR FOODS") for i in range(30)], "id long, name string")
    index = pipeline.build_company_index(companies, MatchOptions(max_candidates=3), "id", "name")
    texts = spark.createDataFrame([("star foods",)], "match_text string")
    got = pipeline.sparse_candidates(texts, index, MatchOptions(max_candidates=20)).collect()
    assert sorted(r.company_id for r in got) == list(range(20))


def test_vectors_are_worked_out_once_and_null_ids_stay(spark):
    counted = spark.sparkContext.accumulator(0)

    @F.udf("array<double>")
    def encode(n):
        counted.add(1)
        return [1.0, float(n)]

    companies = spark.createDataFrame([(i, f"FIRM {i} FOODS") for i in range(5)], "id long, name string")
    vectors = companies.select(F.col("id").alias("company_id"), F.array(F.lit(1.0), F.col("id").cast("double")).alias("vector"))
    txns = spark.createDataFrame([(None, "FIRM ONE"), (1, "FIRM TWO"), (2, "FIRM TWO")], "t long, Narration string")
    asked = spark.createDataFrame([(None, 3), (1, 4), (2, 0)], "txn_id long, n int").select("txn_id", encode("n").alias("vector"))
    for search, tag in (("auto", "exact"), ("lsh", "lsh")):
        opts = MatchOptions(search=search)
        index = pipeline.build_company_index(companies, opts, "id", "name", vectors)
        counted.value = 0
        rows = pipeline.match_transactions(txns, index, opts, "t", txn_vectors=asked).results.collect()
        assert counted.value == 3
        assert {r.txn_id for r in rows} == {None, 1, 2} and {r.backend_used for r in rows} == {tag}
        assert all(r.company_id is not None for r in rows)


def test_candidates_of_vectors_are_not_repeated_for_each_narration(spark, monkeypatch):
    companies = spark.createDataFrame([(i, f"FIRM {chr(65 + i) * 3} FOODS") for i in range(5)], "id long, name string")
    held = spark.createDataFrame([(i, [1.0, 0.2 * i]) for i in range(5)], "company_id long, vector array<double>")
    txns = spark.createDataFrame([(i, "NEFT/X/FIRM BBB") for i in range(40)] + [(40, "FIRM DDD"), (41, "FIRM DDD"), (42, None)], "t long, Narration string")
    asked = spark.createDataFrame([(i, [1.0, 0.2]) for i in range(41)] + [(40, [-1.0, 0.0]), (41, None), (42, [1.0, 0.0])],
                                  "txn_id long, vector array<double>")
    index = pipeline.build_company_index(companies, MatchOptions(), "id", "name", held)
    scored = []
    contenders = pipeline._contenders
    monkeypatch.setattr(pipeline, "_contenders", lambda pairs, *more: (scored.append(pairs.count()), contenders(pairs, *more))[1])
    rows = {r.txn_id: r for r in pipeline.match_transactions(txns, index, MatchOptions(), "t", txn_vectors=asked).results.collect()}
    assert scored == [5 * 3]
    assert [rows[i].company_id for i in range(41)] == [1] * 40 + [3]
    assert rows[41].company_name == "NO_MATCH" and len(rows) == 43


def test_a_vector_search_without_vectors_is_refused(spark):
    companies = spark.createDataFrame([(1, "ALPHA FOODS")], "id long, name string")
    txns = spark.createDataFrame([(1, "ALPHA FOODS")], "t long, Narration string")
    index = pipeline.build_company_index(companies, MatchOptions(), "id", "name")
    with pytest.raises(ValueError):
        pipeline.match_transactions(txns, index, MatchOptions(search="exact"), "t")
    with pytest.raises(ValueError):
        pipeline.match_transactions(txns, index, MatchOptions(), "t", txn_vectors=spark.createDataFrame([(1, [1.0])], "txn_id long, vector array<double>"))
