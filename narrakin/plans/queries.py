"""The queries that show each operation on the given tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from narrakin.functions import places, text
from narrakin.operators import cells, fuzzy, locations, ranking, topk, vectors
from narrakin.operators.preprocess import preprocess_companies, preprocess_narrations
from narrakin.options import MatchOptions
from narrakin.plans import fixtures, pipeline
from narrakin.session import in_slices, scratch_path, settle, ship_package, spread, tune
from narrakin.sources import files

OPTS = MatchOptions()


def _joined(c: str) -> Column:
    return F.array_join(c, "|").alias(c)


def _narrations(spark: SparkSession, sf: str) -> DataFrame:
    ship_package(tune(spark))
    return fixtures.narrations(spark, sf)


def _companies(spark: SparkSession, sf: str) -> DataFrame:
    ship_package(tune(spark))
    return fixtures.companies(spark, sf)


def _ready_narrations(spark: SparkSession, sf: str, opts: MatchOptions = OPTS) -> DataFrame:
    return preprocess_narrations(_narrations(spark, sf), "narration", opts)


def _query_texts(spark: SparkSession, sf: str) -> DataFrame:
    return settle(_ready_narrations(spark, sf).select("match_text").distinct(), "query-texts")


def _ready_companies(spark: SparkSession, sf: str) -> DataFrame:
    return preprocess_companies(_companies(spark, sf), "company_id", "company_name", OPTS)


def _text_step(step):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return _narrations(spark, sf).select("txn_id", step(F.col("narration")).alias("text"))
    return query


clean_noise = _text_step(lambda c: text.drop_noise(text.fold_case(c)))
clean_codes_dates = _text_step(lambda c: text.drop_separators(text.drop_dates(
    text.drop_codes(text.drop_accounts(text.fold_case(c))))))
clean_punct = _text_step(lambda c: text.punctuation_to_space(text.fold_case(c)))
clean_short_words = _text_step(lambda c: text.drop_short_words(text.punctuation_to_space(text.fold_case(c))))
remove_banks = _text_step(lambda c: text.drop_banks(text.fold_case(c)))
clean_narration = _text_step(text.clean_narration)
clean_narration_off = _text_step(lambda c: text.clean_narration(c, filtering=False))
detected_name = _text_step(lambda c: text.detected_name(text.fold_case(c)))
location_text = _text_step(places.location_text)


def clean_documents(spark: SparkSession, sf: str) -> DataFrame:
    ship_package(tune(spark))
    return fixtures.table(spark, sf, "documents").select(
        "doc_id", F.lower(text.punctuation_to_space(text.as_text(F.col("text")))).alias("text"))


def normalize_company(spark: SparkSession, sf: str) -> DataFrame:
    return _companies(spark, sf).select("company_id", text.normalize(F.col("company_name")).alias("text"))


def preprocess_companies_query(spark: SparkSession, sf: str) -> DataFrame:
    return _ready_companies(spark, sf).select(
        "company_id", "original_name", "cleaned_text", "normalized_text", "match_text", "loc_text",
        _joined("tokens"))


def preprocess_txns(spark: SparkSession, sf: str) -> DataFrame:
    return _ready_narrations(spark, sf).select(
        "txn_id", "original", "cleaned", "normalized", "match_text", "loc_text", _joined("tokens"))


def preprocess_txns_unfiltered(spark: SparkSession, sf: str) -> DataFrame:
    """Matching text with narration filtering switched off."""
    ready = _ready_narrations(spark, sf, replace(OPTS, enable_transaction_filtering=False))
    return ready.select("txn_id", "original", "cleaned", "normalized", "match_text", "loc_text")


def _location_texts(spark: SparkSession, sf: str) -> DataFrame:
    return locations.distinct_location_texts(_ready_narrations(spark, sf), _ready_companies(spark, sf))


def suffix_locations(spark: SparkSession, sf: str) -> DataFrame:
    return _location_texts(spark, sf).select("loc_text", _joined("suffix_locations"))


def major_cities(spark: SparkSession, sf: str) -> DataFrame:
    return _location_texts(spark, sf).select("loc_text", _joined("major_cities"))


def _gazetteer(spark: SparkSession, sf: str) -> DataFrame:
    """A supplied location table: the last one to six words of company names."""
    words = F.split(F.lower("company_name"), " ")
    last = F.transform(F.sequence(F.lit(1), F.least(F.lit(6), F.size(words))), lambda n: F.array_join(F.slice(words, -n, n), " "))
    return _companies(spark, sf).select(F.explode(last).alias("location")).distinct()


def gazetteer_lookup(spark: SparkSession, sf: str) -> DataFrame:
    hits = locations.gazetteer_hits(_location_texts(spark, sf), _gazetteer(spark, sf))
    return hits.select("loc_text", _joined("gazetteer_locations"))


def named_locations(spark: SparkSession, sf: str) -> DataFrame:
    """Locations that the rows name themselves: the words of each narration's company."""
    named = _ready_narrations(spark, sf).withColumn("entities", F.split(fixtures.company_name(F.col("true_company_id")), " "))
    return locations.entity_locations(named, "entities").select("loc_text", _joined("gazetteer_locations"))


def location_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return locations.location_dictionary(_location_texts(spark, sf))


def location_dictionary_learned(spark: SparkSession, sf: str) -> DataFrame:
    """Dictionary that adds to earlier knowledge and the hits of a supplied table."""
    texts = _location_texts(spark, sf)
    texts = texts.join(locations.gazetteer_hits(texts, _gazetteer(spark, sf)), "loc_text", "left")
    nations = fixtures.table(spark, sf, "nation").select(F.lower("n_name").alias("location"))
    return locations.location_dictionary(texts, nations)


def location_count(spark: SparkSession, sf: str) -> DataFrame:
    return location_dictionary(spark, sf).agg(F.count("*").alias("discovered_locations"))


def location_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Dictionary written as a text file and read back."""
    path = scratch_path(spark, "locations")
    files.write_locations(location_dictionary(spark, sf), path)
    return files.read_locations(spark, path)


def location_runs(spark: SparkSession, sf: str) -> DataFrame:
    """A dictionary kept between runs: two halves of the narrations, the first of them done twice."""
    path = scratch_path(spark, "location-runs")
    rows = settle(_ready_narrations(spark, sf).select("txn_id", "loc_text"), "loc-texts")
    for run_id, half in (("even", 0), ("odd", 1), ("even", 0)):
        files.add_location_run(locations.location_counts(rows.where(F.col("txn_id") % 2 == half), F.lit(1)), path, run_id)
    return files.read_location_runs(spark, path)


def discovered_lookup(spark: SparkSession, sf: str) -> DataFrame:
    texts = settle(_location_texts(spark, sf), "location-texts")
    hits = locations.dictionary_hits(texts, locations.location_dictionary(texts))
    return hits.select("loc_text", _joined("known_locations"))


def extract_locations(spark: SparkSession, sf: str) -> DataFrame:
    _, cities = pipeline.find_locations([_ready_narrations(spark, sf), _ready_companies(spark, sf)], OPTS)
    return cities.select("loc_text", _joined("cities"))


def _true_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Every narration beside the company it was made from."""
    own = settle(_ready_narrations(spark, sf).select(
        "txn_id", F.col("true_company_id").alias("company_id"), "match_text",
        F.col("loc_text").alias("txn_loc")), "narrations")
    other = _ready_companies(spark, sf).select(
        "company_id", F.col("match_text").alias("company_text"), F.col("loc_text").alias("company_loc"))
    return spread(own.join(other, "company_id"), "txn_id", own.count())


def _with_boost(pairs: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    _, cities = pipeline.find_locations([_ready_narrations(spark, sf), _ready_companies(spark, sf)], OPTS)
    for side in ("txn", "company"):
        pairs = pairs.join(cities.select(F.col("loc_text").alias(f"{side}_loc"),
                                         F.col("cities").alias(f"{side}_cities")), f"{side}_loc")
    return pairs.withColumn("city_boost", locations.city_boost(F.col("txn_cities"), F.col("company_cities")))


def city_boost(spark: SparkSession, sf: str) -> DataFrame:
    pairs = _with_boost(_true_pairs(spark, sf), spark, sf)
    return pairs.select("txn_id", _joined("txn_cities"), _joined("company_cities"), "city_boost")


def _ratio_query(*names: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return fuzzy.with_ratios(_true_pairs(spark, sf), "match_text", "company_text", *names).select(
            "txn_id", *names)
    return query


fuzzy_ratio = _ratio_query("ratio")
fuzzy_partial = _ratio_query("partial_ratio")
fuzzy_token_sort = _ratio_query("token_sort_ratio")
fuzzy_token_set = _ratio_query("token_set_ratio")


def fuzzy_max(spark: SparkSession, sf: str) -> DataFrame:
    return fuzzy.with_fuzzy_score(_true_pairs(spark, sf), "match_text", "company_text").select(
        "txn_id", "fuzzy_score")


def fuzzy_parts(spark: SparkSession, sf: str) -> DataFrame:
    """All ratios between each part's description and that of another part."""
    ship_package(tune(spark))
    parts = fixtures.table(spark, sf, "part").select(
        "p_partkey", F.lower(F.concat_ws(" ", "p_name", "p_type", "p_brand")).alias("a"))
    n = parts.count()
    other = parts.select(F.col("p_partkey").alias("other"), F.col("a").alias("b"))
    pairs = parts.withColumn("other", (F.col("p_partkey") * 7 + 3) % n).join(other, "other")
    return fuzzy.with_ratios(pairs, "a", "b").select("p_partkey", *fuzzy.RATIOS)


def _index(spark: SparkSession, sf: str, opts: MatchOptions = OPTS) -> pipeline.CompanyIndex:
    return pipeline.build_company_index(_companies(spark, sf), opts, "company_id", "company_name")


def tfidf_vectors(spark: SparkSession, sf: str) -> DataFrame:
    texts = settle(_ready_companies(spark, sf).select("match_text").distinct(), "texts")
    counts = vectors.gram_counts(texts)
    frequencies = settle(vectors.gram_frequencies(counts), "frequencies")
    rows = vectors.tfidf(counts, frequencies, frequencies.count(), texts.count())
    return rows.select("match_text", "gram", F.round("weight", 6).alias("weight"))


def topk_sparse(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.sparse_candidates(_query_texts(spark, sf), _index(spark, sf), OPTS)


def topk_sparse_joined(spark: SparkSession, sf: str) -> DataFrame:
    """The same search by joining on shared text pieces, as for a company side of any size."""
    opts = replace(OPTS, index_postings=0)
    return pipeline.sparse_candidates(_query_texts(spark, sf), _index(spark, sf), opts)


def _vectors(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ship_package(tune(spark))
    return fixtures.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias(name), F.col("embedding").alias("vector"))


def topk_dense(spark: SparkSession, sf: str) -> DataFrame:
    return topk.dense_topk(_vectors(spark, sf, "txn_id"), _vectors(spark, sf, "company_id"),
                           OPTS.max_candidates, OPTS.similarity_floor)


def topk_dense_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The same search by way of cells, as for a company side of any size."""
    return topk.dense_topk(_vectors(spark, sf, "txn_id"), _vectors(spark, sf, "company_id"),
                           OPTS.max_candidates, OPTS.similarity_floor, numbers=0)


def _given_cells(spark: SparkSession, sf: str) -> cells.CellIndex:
    """Cells around given centres: every fortieth vector, with the vectors that are nearest to it."""
    return cells.cells_around(_vectors(spark, sf, "company_id"), _vectors(spark, sf, "cell").where("cell % 40 = 0"))


def topk_probed(spark: SparkSession, sf: str) -> DataFrame:
    """The best among the vectors of the four cells nearest to each query, around given centres."""
    found = cells.probed_topk(_vectors(spark, sf, "txn_id"), _given_cells(spark, sf), OPTS.max_candidates, OPTS.similarity_floor, 4)
    return found.withColumnRenamed("target", "company_id").select("txn_id", "company_id", "similarity", "rank")


def topk_probed_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Share of the exact neighbours that the stated recall of 0.9 finds, and the share of all pairs compared."""
    queries = _vectors(spark, sf, "txn_id")
    index = cells.build_cells(_vectors(spark, sf, "company_id"), cell_rows=64)
    k, floor = OPTS.max_candidates, OPTS.similarity_floor
    compared, tried = [], []
    truth = cells.cell_topk(queries, index, k, floor, compared=compared)
    probes = cells.probes_for(index, OPTS.probe_recall, k, floor)
    found = cells.probed_topk(queries, index, k, floor, probes, compared=tried)
    pairs = queries.count() ** 2
    hit = truth.join(found.select("txn_id", "target", F.lit(1).alias("hit")), ["txn_id", "target"], "left")
    return hit.agg((F.count("hit") / F.count("*")).alias("recall")).select(
        "recall", F.lit(probes).alias("probes"), F.lit(sum(tried) / pairs).alias("probed_share"), F.lit(sum(compared) / pairs).alias("exact_share"))


def topk_lsh(spark: SparkSession, sf: str) -> DataFrame:
    tables = topk.lsh_tables(OPTS.lsh_bits, OPTS.similarity_floor, OPTS.lsh_recall)
    return topk.lsh_topk(_vectors(spark, sf, "txn_id"), _vectors(spark, sf, "company_id"), OPTS.max_candidates,
                         OPTS.similarity_floor, tables, OPTS.lsh_bits, OPTS.lsh_seed)


def candidates_enriched(spark: SparkSession, sf: str) -> DataFrame:
    index, texts = _index(spark, sf), _query_texts(spark, sf)
    return in_slices(texts, "match_text", lambda cut: pipeline.attach_companies(
        pipeline.sparse_candidates(cut(texts), index, OPTS), index).select(
            "match_text", "company_id", "similarity", "rank", "company_name", "company_text"), "enriched")


def score_tiers(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of every narration with the company it was made from."""
    found = pipeline.sparse_candidates(_query_texts(spark, sf), _index(spark, sf), OPTS)
    # Each step is stored, so that the shuffles of one at a time lie on disk.
    pairs = settle(fuzzy.with_fuzzy_score(_true_pairs(spark, sf), "match_text", "company_text").drop("company_text"), "fuzzy-pairs")
    pairs = settle(_with_boost(pairs, spark, sf).select("txn_id", "company_id", "match_text", "fuzzy_score", "city_boost"), "boosted-pairs")
    pairs = pairs.join(found, ["match_text", "company_id"], "left").withColumn("similarity", F.coalesce("similarity", F.lit(0.0)))
    return ranking.with_scores(pairs, OPTS).select(
        "txn_id", "similarity", "fuzzy_score", "city_boost", "base_score", "final_score")


def fuzzy_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Bounds of the fuzzy score of every narration with the company it was made from."""
    return fuzzy.with_bounds(_true_pairs(spark, sf), "match_text", "company_text").select("txn_id", "fuzzy_low", "fuzzy_high")


def contenders(spark: SparkSession, sf: str) -> DataFrame:
    """How many candidates each text has, and how many of them the bounds leave to be scored."""
    index, texts = _index(spark, sf), _query_texts(spark, sf)

    def counted(cut):
        found = settle(pipeline.attach_companies(pipeline.sparse_candidates(cut(texts), index, OPTS), index), "pairs")
        wide = spread(found, "match_text", found.count(), hashed=True)
        left = ranking.contenders(fuzzy.with_bounds(wide, "match_text", "company_text"), ["match_text"], OPTS)
        scored = left.groupBy("match_text").agg(F.count("*").alias("scored"))
        return found.groupBy("match_text").agg(F.count("*").alias("candidates")).join(scored, "match_text", "left")

    return in_slices(texts, "match_text", counted, "counted")


def _match(spark: SparkSession, sf: str, opts: MatchOptions = OPTS) -> pipeline.MatchRun:
    return pipeline.match_transactions(
        _narrations(spark, sf), _index(spark, sf, opts), opts, "txn_id", "narration")


def _with_plain_id(results: DataFrame) -> DataFrame:
    """-1 for no company, so that the id stays a whole number in every client."""
    return results.withColumn("company_id", F.coalesce("company_id", F.lit(-1)))


def full_match(spark: SparkSession, sf: str) -> DataFrame:
    return _with_plain_id(pipeline.finish(_match(spark, sf), OPTS))


def best_match(spark: SparkSession, sf: str) -> DataFrame:
    return _match(spark, sf).results.filter(F.col("company_name") != ranking.NO_MATCH).select(
        "txn_id", "company_id", "company_name", "final_score")


def no_match(spark: SparkSession, sf: str) -> DataFrame:
    return _match(spark, sf).results.filter(F.col("company_name") == ranking.NO_MATCH).select(
        "txn_id", "final_score", "txn_cities", "company_cities", "detected_company_name")


# The output columns shown and hidden in the usual setup.
USUAL_COLUMNS = {
    "backend_used": False, "txn_cities": False, "company_cities": False, "embedding_similarity": False,
    "fuzzy_score": False, "city_boost": False, "final_score": True, "detected_company_name": False,
}


def projected_output(spark: SparkSession, sf: str) -> DataFrame:
    opts = replace(OPTS, output_columns=USUAL_COLUMNS)
    return _with_plain_id(pipeline.finish(_match(spark, sf, opts), opts))


def ranked_results(spark: SparkSession, sf: str) -> DataFrame:
    """Results with their position by score."""
    scores = settle(_match(spark, sf).results.select("txn_id", "company_id", "final_score"), "scores")
    results = files.with_ordinal(scores.withColumn("order_key", -F.col("final_score")), ["order_key", "txn_id"], "position")
    return _with_plain_id(results.drop("order_key"))


def confidence_filter(spark: SparkSession, sf: str) -> DataFrame:
    opts = replace(OPTS, confidence_threshold=85.0)
    return _with_plain_id(_match(spark, sf, opts).results.select(
        "txn_id", "company_id", "company_name", "fuzzy_score", "final_score"))


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    done = _match(spark, sf)
    return ranking.run_summary(done.results, done.locations)


def match_by_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Matching on supplied vectors: embeddings are dealt out to companies and their narrations."""
    embeddings = _vectors(spark, sf, "vec_id")
    n = embeddings.count()
    dealt = F.col("company_id") % n
    own = _companies(spark, sf).select("company_id", dealt.alias("vec_id")).join(embeddings, "vec_id")
    index = pipeline.build_company_index(_companies(spark, sf), OPTS, "company_id", "company_name",
                                         own.select("company_id", "vector"))
    asked = _narrations(spark, sf).select("txn_id", (F.col("true_company_id") % n).alias("vec_id"))
    run = pipeline.match_transactions(_narrations(spark, sf), index, OPTS, "txn_id", "narration",
                                      txn_vectors=asked.join(embeddings, "vec_id").select("txn_id", "vector"))
    return _with_plain_id(pipeline.finish(run, OPTS))


def assign_ordinal(spark: SparkSession, sf: str) -> DataFrame:
    named = _companies(spark, sf).select("company_name")
    return files.with_ordinal(named, ["company_name"], "ordinal")


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Narrations through a CSV folder: every column comes back as text."""
    path = scratch_path(spark, "narrations") + ".csv"
    files.write_results(_narrations(spark, sf).select("txn_id", "amount", "narration"), path)
    return files.read_table(spark, path)


def resolve_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Which text column each given table resolves to, with its filled rows."""
    ship_package(tune(spark))
    found = []
    for name, renamed in (("part", "Memo"), ("customer", "Details"), ("supplier", None)):
        df = fixtures.table(spark, sf, name)
        df = df.withColumnRenamed(df.columns[1], renamed) if renamed else df
        column = files.narration_text_column(df, ["Transaction Particulars"])
        found.append(df.agg(
            F.lit(name).alias("table_name"), F.lit(column).alias("narration_column"),
            F.lit(files.company_text_column(df, ["Company_Name"])).alias("company_column"),
            F.count(column).alias("filled")))
    return found[0].unionByName(found[1]).unionByName(found[2])


def company_table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Company tables stored as Parquet and read back, with lists as pipe text on the way."""
    path = scratch_path(spark, "master")
    _, cities = pipeline.find_locations([_ready_narrations(spark, sf), _ready_companies(spark, sf)], OPTS)
    listed = pipeline.with_cities(_ready_companies(spark, sf), cities, "company_id")
    files.write_companies(files.list_columns_to_text(listed, ["cities", "tokens"]), path)
    stored = files.text_columns_to_lists(files.read_companies(spark, path), ["cities", "tokens"])
    return stored.select("company_id", "original_name", "cleaned_text", "normalized_text", _joined("cities"), _joined("tokens"))


def stored_index(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates from company tables loaded from their folder."""
    path = scratch_path(spark, "index")
    pipeline.build_company_index(_companies(spark, sf), OPTS, "company_id", "company_name", path=path)
    return pipeline.sparse_candidates(
        _query_texts(spark, sf), pipeline.load_company_index(spark, path), OPTS)


def stored_index_wider_k(spark: SparkSession, sf: str) -> DataFrame:
    """Twenty candidates from company tables that were stored with options for ten."""
    path = scratch_path(spark, "index")
    pipeline.build_company_index(_companies(spark, sf), OPTS, "company_id", "company_name", path=path)
    return pipeline.sparse_candidates(
        _query_texts(spark, sf), pipeline.load_company_index(spark, path), replace(OPTS, max_candidates=20))


def index_after_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates from stored company tables to which a fifth was added later, a seventh being withdrawn."""
    path = scratch_path(spark, "index")
    companies = _companies(spark, sf)
    late = F.col("company_id") % 5 == 0
    pipeline.build_company_index(companies.where(~late), OPTS, "company_id", "company_name", path=path)
    pipeline.change_company_index(spark, path, OPTS, added=companies.where(late))
    pipeline.change_company_index(spark, path, OPTS, withdrawn=companies.where("company_id % 7 = 3"))
    return pipeline.sparse_candidates(_query_texts(spark, sf), pipeline.load_company_index(spark, path), OPTS)


def run_files(spark: SparkSession, sf: str) -> DataFrame:
    """The whole run from CSV files to a CSV result, with all columns of the narration file."""
    base = scratch_path(spark, "run")
    files.write_results(_companies(spark, sf), f"{base}/companies.csv")
    files.write_results(_narrations(spark, sf).select(
        "txn_id", F.to_date("txn_date").alias("txn_date"), "amount", F.col("narration").alias("Narration")),
                        f"{base}/transactions.csv")
    opts = replace(OPTS, company_column=("company_name",), keep_input_columns=True)
    out = pipeline.run(spark, f"{base}/companies.csv", f"{base}/transactions.csv", f"{base}/matches.csv",
                       opts, f"{base}/index", f"{base}/locations.txt", "company_id", "txn_id")
    number = lambda c, kind: F.col(c).cast(kind).alias(c)
    return files.read_table(spark, out.path).select(
        number("txn_id", "long"), F.coalesce(F.col("company_id").cast("long"), F.lit(-1)).alias("company_id"), "transaction_text",
        "company_name", *[number(c, "double") for c in ranking.SCORES], "backend_used",
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("txn_cities", "company_cities", "detected_company_name")], "txn_date", "amount")


def run_files_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The summary that a whole run over files counts while it writes the results."""
    base = scratch_path(spark, "run")
    files.write_results(_companies(spark, sf), f"{base}/companies.csv")
    files.write_results(_narrations(spark, sf).select("txn_id", F.col("narration").alias("Narration")), f"{base}/transactions.csv")
    opts = replace(OPTS, company_column=("company_name",), output_columns={"final_score": False})
    out = pipeline.run(spark, f"{base}/companies.csv", f"{base}/transactions.csv", f"{base}/matches.csv", opts,
                       company_id="company_id", txn_id="txn_id")
    return spark.createDataFrame([out.summary], ", ".join(f"{name} long" for name in out.summary))


def rejected_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Narrations through CSV files in which some lines have a field too few or too many."""
    path = scratch_path(spark, "narrations") + ".csv"
    lines = _narrations(spark, sf).withColumn("txn_date", F.to_date("txn_date").cast("string")).select(F.when(F.col("txn_id") % 50 == 0, F.concat_ws(",", "txn_id", "narration"))
                                          .when(F.col("txn_id") % 50 == 1, F.concat_ws(",", "txn_id", "txn_date", "narration", F.lit("more")))
                                          .otherwise(F.concat_ws(",", "txn_id", "txn_date", "narration")).alias("txn_id,txn_date,narration"))
    lines.write.option("header", True).option("sep", "\u0001").csv(path)  # one column, whose commas part the fields
    good, bad = files.read_csv_apart(spark, path)
    none = F.lit(None).cast("string")
    return good.withColumn("line", none).unionByName(bad.select(
        *[none.alias(c) for c in ("txn_id", "txn_date", "narration")], "line")).select(
            *[F.coalesce(c, F.lit("")).alias(c) for c in ("txn_id", "txn_date", "narration", "line")])


def match_text_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids that are text, through CSV files and the whole run."""
    base = scratch_path(spark, "run")
    coded = lambda c, head: F.concat(F.lit(head), F.lpad(F.col(c).cast("string"), 9, "0")).alias(c)
    files.write_results(_companies(spark, sf).select(coded("company_id", "EC"), "company_name"), f"{base}/companies.csv")
    files.write_results(_narrations(spark, sf).select(coded("txn_id", "TXN"), F.col("narration").alias("Narration")), f"{base}/transactions.csv")
    opts = replace(OPTS, company_column=("company_name",))
    out = pipeline.run(spark, f"{base}/companies.csv", f"{base}/transactions.csv", f"{base}/matches.csv", opts,
                       company_id="company_id", txn_id="txn_id")
    return files.read_table(spark, out.path).select(
        "txn_id", F.coalesce("company_id", F.lit("none")).alias("company_id"), "company_name", F.col("final_score").cast("double"))


QUERIES = {
    "clean_noise": clean_noise,
    "clean_codes_dates": clean_codes_dates,
    "clean_punct": clean_punct,
    "clean_short_words": clean_short_words,
    "remove_banks": remove_banks,
    "clean_narration": clean_narration,
    "clean_narration_off": clean_narration_off,
    "clean_documents": clean_documents,
    "detected_name": detected_name,
    "normalize_company": normalize_company,
    "preprocess_companies": preprocess_companies_query,
    "preprocess_txns": preprocess_txns,
    "preprocess_txns_unfiltered": preprocess_txns_unfiltered,
    "location_text": location_text,
    "suffix_locations": suffix_locations,
    "major_cities": major_cities,
    "gazetteer_lookup": gazetteer_lookup,
    "named_locations": named_locations,
    "location_runs": location_runs,
    "discovered_lookup": discovered_lookup,
    "location_dictionary": location_dictionary,
    "location_dictionary_learned": location_dictionary_learned,
    "location_count": location_count,
    "location_roundtrip": location_roundtrip,
    "extract_locations": extract_locations,
    "city_boost": city_boost,
    "fuzzy_ratio": fuzzy_ratio,
    "fuzzy_partial": fuzzy_partial,
    "fuzzy_token_sort": fuzzy_token_sort,
    "fuzzy_token_set": fuzzy_token_set,
    "fuzzy_max": fuzzy_max,
    "fuzzy_parts": fuzzy_parts,
    "tfidf_vectors": tfidf_vectors,
    "topk_sparse": topk_sparse,
    "topk_sparse_joined": topk_sparse_joined,
    "topk_dense": topk_dense,
    "topk_dense_cells": topk_dense_cells,
    "topk_probed": topk_probed,
    "topk_probed_recall": topk_probed_recall,
    "topk_lsh": topk_lsh,
    "candidates_enriched": candidates_enriched,
    "score_tiers": score_tiers,
    "fuzzy_bounds": fuzzy_bounds,
    "contenders": contenders,
    "best_match": best_match,
    "no_match": no_match,
    "ranked_results": ranked_results,
    "projected_output": projected_output,
    "confidence_filter": confidence_filter,
    "run_summary": run_summary,
    "full_match": full_match,
    "match_by_vectors": match_by_vectors,
    "assign_ordinal": assign_ordinal,
    "csv_roundtrip": csv_roundtrip,
    "resolve_columns": resolve_columns,
    "company_table_roundtrip": company_table_roundtrip,
    "stored_index": stored_index,
    "stored_index_wider_k": stored_index_wider_k,
    "index_after_changes": index_after_changes,
    "run_files": run_files,
    "run_files_summary": run_files_summary,
    "rejected_rows": rejected_rows,
    "match_text_ids": match_text_ids,
}
