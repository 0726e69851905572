"""Building the company side, matching narrations, and the run over files."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from narrakin.operators import cells, fuzzy, locations, ranking, topk, vectors
from narrakin.operators.preprocess import preprocess_companies, preprocess_narrations
from narrakin.operators.skew import BROADCAST_BYTES, company_join, fan_out_join
from narrakin.options import MatchOptions
from narrakin.session import in_slices, scratch_path, settle, ship_package, spread, temporary_tables, together, tune
from narrakin.sources import files

MENTION = ["match_text", "loc_text"]


@dataclass(frozen=True)
class CompanyIndex:
    """Stored company tables and their measured sizes."""

    companies: DataFrame
    members: DataFrame
    frequencies: DataFrame
    packed: DataFrame
    n_texts: int
    n_grams: int
    postings: int
    n_companies: int
    company_bytes: int
    vectors: DataFrame | None = None
    cells: cells.CellIndex | None = None


def _sized(companies: DataFrame, members: DataFrame, frequencies: DataFrame, packed: DataFrame,
           dense: DataFrame | None, placed: cells.CellIndex | None = None) -> CompanyIndex:
    sparse = packed.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("grams")), F.lit(0)).alias("p")).first()
    width = sum(F.octet_length(c) for c in ("original_name", "match_text", "loc_text")) + 64
    table = companies.agg(F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return CompanyIndex(companies, members, frequencies, packed, sparse["n"], frequencies.count(),
                        sparse["p"], table["n"], table["b"], dense, placed)


def build_company_index(companies: DataFrame, opts: MatchOptions = MatchOptions(),
                        id_col: str | None = None, text_col: str | None = None,
                        vectors_table: DataFrame | None = None, path: str | None = None,
                        gazetteer: DataFrame | None = None) -> CompanyIndex:
    """Preprocess, vectorise and store a company master.

    Without an id column rows are numbered in the order of the text column.
    ``vectors_table`` may supply (company_id, vector). The manifest is written last, so a
    folder without one is not complete.
    """
    spark = tune(companies.sparkSession)
    ship_package(spark)
    path = (path or scratch_path(spark, "companies")).rstrip("/")
    text_col = text_col or files.company_text_column(companies, opts.company_column)
    made_of = manifest(companies, opts, id_col, text_col, vectors_table)
    if id_col is None:
        companies, id_col = files.with_ordinal(companies, [text_col]), "company_id"
    files.remove(spark, f"{path}/manifest")
    for stale in ("versions", "cells", "vectors"):
        files.remove(spark, f"{path}/{stale}")
    plain = settle(preprocess_companies(companies, id_col, text_col, opts), "companies-plain")
    texts, of_texts = topk.company_texts(plain)

    def located() -> DataFrame:
        _, cities = find_locations([plain], opts, gazetteer=gazetteer)
        return settle(with_cities(plain, cities, "company_id"), "companies", f"{path}/companies")

    def weighed() -> tuple[DataFrame, DataFrame]:
        stored = settle(texts, "texts", f"{path}/texts")
        frequencies = settle(vectors.piece_frequencies(spread(stored, "match_text")), "frequencies", f"{path}/frequencies")
        return frequencies, settle(_weighed(stored, frequencies), "packed", f"{path}/packed")

    table, members, (frequencies, packed), (dense, placed) = together(
        located, lambda: settle(of_texts, "members", f"{path}/members"), weighed, lambda: _placed_vectors(vectors_table, opts, path))
    settle(made_of, "manifest", f"{path}/manifest")
    return _sized(table, members, frequencies, packed, dense, placed)


def _weighed(texts: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Packed sparse vectors of company texts, by target."""
    return vectors.packed_tfidf(spread(texts, "match_text"), frequencies, frequencies.count(), texts.count()).drop("match_text")


def _placed_vectors(vectors_table: DataFrame | None, opts: MatchOptions, folder: str) -> tuple[DataFrame | None, cells.CellIndex | None]:
    """Supplied vectors stored below a folder, and in cells if they are many or probed."""
    if vectors_table is None:
        return None, None
    dense = settle(vectors_table.select("company_id", "vector"), "vectors", f"{folder}/vectors")
    by_cells = opts.search == "probed" or topk.dense_numbers(dense) > opts.dense_numbers
    return dense, cells.build_cells(dense, path=f"{folder}/cells") if by_cells else None


def change_company_index(spark: SparkSession, path: str, opts: MatchOptions = MatchOptions(), added: DataFrame | None = None,
                         withdrawn: DataFrame | None = None, id_col: str = "company_id", text_col: str = "company_name",
                         added_vectors: DataFrame | None = None, gazetteer: DataFrame | None = None) -> CompanyIndex:
    """Add companies to stored tables and withdraw others, without their source.

    ``withdrawn`` has the ids in ``id_col``; an added id that is already there replaces it. The
    outcome is that of building anew with the companies that are left. Only texts that a company
    joins or leaves are numbered anew, and piece frequencies change by those that appear or vanish;
    weights depend on the number of texts and are worked out again only if that, or a frequency,
    has changed. Each change is a version of its own below the path; the last complete one counts,
    so a change that breaks off leaves the one before it, which is kept until the next change.
    """
    ship_package(tune(spark))
    path = path.rstrip("/")
    last, folder = _version(spark, path)
    new = f"{path}/versions/{last + 1}"
    files.remove(spark, new)
    read = lambda name: spark.read.parquet(f"{folder}/{name}")
    companies, texts, members, frequencies = (read(name) for name in ("companies", "texts", "members", "frequencies"))
    kind = companies.schema["company_id"].dataType
    fresh = companies.drop("cities").limit(0) if added is None else preprocess_companies(added, id_col, text_col, opts).withColumn(
        "company_id", F.col("company_id").cast(kind))
    fresh = settle(fresh, "added")
    gone = fresh.select("company_id")
    if withdrawn is not None:
        gone = gone.unionByName(withdrawn.select(F.col(id_col).cast(kind).alias("company_id")))
    gone = settle(gone.distinct(), "gone")
    left = settle(companies.join(gone, "company_id", "left_semi"), "left")
    live = settle(companies.join(gone, "company_id", "left_anti").drop("cities").unionByName(fresh), "live")
    _, cities = find_locations([live], opts, gazetteer=gazetteer)
    table = settle(with_cities(live, cities, "company_id"), "companies", f"{new}/companies")
    touched = settle(left.select("match_text").unionByName(fresh.select("match_text")).distinct(), "touched")
    before = settle(texts.join(touched, "match_text", "left_semi"), "before")
    now, its_members = topk.company_texts(settle(live.join(touched, "match_text", "left_semi"), "touched-companies"))
    now = settle(now, "now")
    members = settle(members.join(before.select("target"), "target", "left_anti").unionByName(its_members), "members", f"{new}/members")
    texts = settle(texts.join(touched, "match_text", "left_anti").unionByName(now), "texts", f"{new}/texts")
    shift = lambda some, sign: vectors.gram_frequencies(vectors.gram_counts(some)).select("gram", (F.col("df") * sign).alias("df"))
    appeared, vanished = now.join(before, "match_text", "left_anti"), before.join(now, "match_text", "left_anti")
    same_texts = appeared.isEmpty() and vanished.isEmpty()
    if not same_texts:
        frequencies = frequencies.unionByName(shift(appeared, 1)).unionByName(shift(vanished, -1)).groupBy("gram").agg(
            F.sum("df").alias("df")).filter(F.col("df") > 0)
    frequencies = settle(frequencies, "frequencies", f"{new}/frequencies")
    if same_texts:
        renamed = before.join(now.withColumnRenamed("target", "now"), "match_text").select("target", "now")
        packed = read("packed").join(renamed, "target", "left").withColumn("target", F.coalesce("now", "target")).drop("now")
    else:
        packed = _weighed(texts, frequencies)
    packed = settle(packed, "packed", f"{new}/packed")
    dense = None
    if files.path_exists(spark, f"{folder}/vectors/_SUCCESS"):
        dense = read("vectors").join(gone, "company_id", "left_anti")
        if added_vectors is not None:
            dense = dense.unionByName(added_vectors.select(F.col("company_id").cast(kind).alias("company_id"), F.col("vector").cast(dense.schema["vector"].dataType).alias("vector")))
    dense, placed = _placed_vectors(dense, opts, new)
    settle(spark.createDataFrame([(last + 1,)], "version long"), "complete", f"{new}/complete")
    if last > 1:
        files.remove(spark, f"{path}/versions/{last - 1}")
    return _sized(table, members, frequencies, packed, dense, placed)


def _version(spark: SparkSession, path: str) -> tuple[int, str]:
    """Number and folder of the last complete version of stored company tables; 0 is the first one, as built."""
    if not files.path_exists(spark, f"{path}/manifest/_SUCCESS"):
        raise ValueError(f"{path} holds no complete company tables")
    complete = [n for n in map(int, files.folders(spark, f"{path}/versions")) if files.path_exists(spark, f"{path}/versions/{n}/complete/_SUCCESS")]
    return (max(complete), f"{path}/versions/{max(complete)}") if complete else (0, path)


def manifest(companies: DataFrame, opts: MatchOptions, id_col: str | None, text_col: str,
             vectors_table: DataFrame | None = None) -> DataFrame:
    """One row that tells what stored company tables were made of: options, rows and their checksum."""
    def mark(df: DataFrame, *columns: str) -> tuple[int, str]:
        total = F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
        n, checksum = df.agg(F.count("*"), total.cast("string")).first()
        return n, checksum or ""

    n, checksum = mark(companies, *([id_col] if id_col else []), text_col)
    dense = mark(vectors_table, "company_id", "vector") if vectors_table is not None else (-1, "")
    return companies.sparkSession.createDataFrame(
        [(opts.keep_long_alpha_words, opts.enable_automated_city_detection, n, checksum, *dense)],
        "keep_long_alpha_words boolean, city_detection boolean, n_companies long, companies string, n_vectors long, vectors string")


def stored_index_fits(spark: SparkSession, path: str, opts: MatchOptions, wanted: DataFrame | None) -> bool:
    """Whether the folder holds complete company tables, made with these options of this source.

    ``wanted`` is the manifest of the source, or none if there is no source to compare with.
    """
    folder = f"{path.rstrip('/')}/manifest"
    if not files.path_exists(spark, f"{folder}/_SUCCESS"):
        return False
    stored = spark.read.parquet(folder).first()
    if wanted is not None:
        return stored == wanted.first()
    return (stored.keep_long_alpha_words, stored.city_detection) == (
        opts.keep_long_alpha_words, opts.enable_automated_city_detection)


def load_company_index(spark: SparkSession, path: str) -> CompanyIndex:
    """Company tables stored by build_company_index."""
    ship_package(tune(spark))
    _, path = _version(spark, path.rstrip("/"))
    read = lambda name: spark.read.parquet(f"{path}/{name}")
    dense = read("vectors") if files.path_exists(spark, f"{path}/vectors/_SUCCESS") else None
    placed = cells.load_cells(spark, f"{path}/cells") if files.path_exists(spark, f"{path}/cells/rows/_SUCCESS") else None
    return _sized(files.read_companies(spark, f"{path}/companies"), read("members"), read("frequencies"), read("packed"), dense, placed)


def query_vectors(texts: DataFrame, index: CompanyIndex) -> DataFrame:
    """Packed sparse vectors of the distinct query texts, weighted by the company side."""
    distinct = spread(texts.select("match_text"), "match_text").distinct()
    return vectors.packed_tfidf(distinct, index.frequencies, index.n_grams, index.n_texts)


def sparse_candidates(texts: DataFrame, index: CompanyIndex, opts: MatchOptions) -> DataFrame:
    """(match_text, company_id, similarity, rank) for the distinct matching texts of a stored table.

    Many texts are searched in slices, each of which leaves no more than its candidates.
    """
    def found(cut: Callable) -> DataFrame:
        return topk.sparse_topk(query_vectors(cut(texts), index), index.packed, index.members, index.postings,
                                index.company_bytes, opts.max_candidates, opts.similarity_floor, opts.index_postings)

    return in_slices(texts, "match_text", found, "candidates")


#: Two hashes of a vector, by which rows are joined instead of by the vector itself.
_HASHES = {"_hash": F.xxhash64, "_hash_too": lambda c: F.xxhash64(F.lit(1), c, F.size(c))}


def _same_vector(distinct: DataFrame) -> list[str]:
    """Columns that tell distinct vectors apart: their hashes, or the vectors if two of them have the same hashes."""
    return [*_HASHES] if distinct.select(*_HASHES).distinct().count() == distinct.count() else ["vector"]


def _found_by_vectors(queries: DataFrame, index: CompanyIndex, opts: MatchOptions) -> tuple[DataFrame, DataFrame, DataFrame, str]:
    """Stored queries with a vector, their distinct vectors with numbers, what these find, and the search used.

    Each distinct vector is searched once.
    """
    # Stored before rows are left out, so that vectors which a function makes are worked out once.
    queries = settle(queries.withColumns({name: make(F.col("vector")) for name, make in _HASHES.items()}), "query-vectors").filter(F.col("vector").isNotNull())
    distinct = settle(queries.groupBy("vector", *_HASHES).agg(F.count("*").alias("n_rows")).withColumn("query", F.monotonically_increasing_id()), "distinct-vectors")
    found, used = _search_vectors(distinct.select("query", "vector"), index, opts)
    return queries, distinct, found, used


def vector_candidates(queries: DataFrame, index: CompanyIndex, opts: MatchOptions) -> tuple[DataFrame, str]:
    """(txn_id, company_id, similarity, rank) from supplied vectors, and the search used.

    The companies that a distinct vector finds are joined back to its narrations.
    """
    queries, distinct, found, used = _found_by_vectors(queries, index, opts)
    same = _same_vector(distinct)
    named = found.join(distinct.select("query", *same), "query").select(*same, "company_id", "similarity", "rank")
    back = fan_out_join(queries.select("txn_id", *same), named, distinct.select(*same, "n_rows"), same, ["txn_id"], "inner")
    return back.select("txn_id", "company_id", "similarity", "rank"), used


def _asked_candidates(queries: DataFrame, index: CompanyIndex, opts: MatchOptions) -> tuple[DataFrame, DataFrame, str]:
    """(_id, _no_id, _asked), (_asked, company_id, similarity, rank) and the search used.

    _asked holds the numbers of the distinct vectors supplied for an id, which are one as a rule; neither
    vectors nor candidates are repeated for each narration.
    """
    queries, distinct, found, used = _found_by_vectors(_keyed(queries.select("txn_id", "vector")).drop("txn_id"), index, opts)
    same = _same_vector(distinct)
    numbered = queries.select(*_KEY, *same).join(distinct.select(*same, "query"), same)
    asked = settle(numbered.groupBy(*_KEY).agg(F.array_sort(F.collect_set("query")).alias("_asked")), "asked")
    each = asked.select("_asked").distinct().withColumn("query", F.explode("_asked"))
    return asked, each.join(found, "query").select("_asked", "company_id", "similarity", "rank"), used


def _search_vectors(queries: DataFrame, index: CompanyIndex, opts: MatchOptions) -> tuple[DataFrame, str]:
    """(query, company_id, similarity, rank) by the search the options name, and its name."""
    k, floor, key = opts.max_candidates, opts.similarity_floor, "query"
    if opts.search == "lsh":
        tables = opts.lsh_tables or topk.lsh_tables(opts.lsh_bits, floor, opts.lsh_recall)
        return topk.lsh_topk(queries, index.vectors, k, floor, tables, opts.lsh_bits, opts.lsh_seed, key), "lsh"
    if opts.search != "probed" and index.cells is None:
        return topk.dense_topk(queries, index.vectors, k, floor, key, numbers=opts.dense_numbers), "exact"
    placed = index.cells or cells.build_cells(index.vectors)
    if opts.search == "probed":
        probes = opts.probes or cells.probes_for(placed, opts.probe_recall, k, floor)
        return cells.probed_topk(queries, placed, k, floor, probes, key).withColumnRenamed("target", "company_id"), "probed"
    return cells.cell_topk(queries, placed, k, floor, key).withColumnRenamed("target", "company_id"), "exact"


def company_side(index: CompanyIndex, company_cities: DataFrame | None = None) -> DataFrame:
    """What candidates show of their company: name, matching text and cities."""
    side = index.companies.select("company_id", F.col("original_name").alias("company_name"),
                                  F.col("match_text").alias("company_text"), "loc_text")
    if company_cities is not None:
        side = with_cities(side, company_cities, "company_id").withColumnRenamed("cities", "company_cities")
    return side.drop("loc_text")


def attach_companies(candidates: DataFrame, index: CompanyIndex, side: DataFrame | None = None, salt_on: str = "match_text") -> DataFrame:
    """Candidates with a company side, by default without cities; unknown ids are dropped."""
    return company_join(candidates, company_side(index) if side is None else side, "company_id", index.company_bytes, [salt_on])


def with_cities(rows: DataFrame, cities: DataFrame, salt_on: str) -> DataFrame:
    """Rows with the cities of their location text, which may be the same for many rows."""
    counts = rows.groupBy("loc_text").agg(F.count("*").alias("n_rows"))
    return fan_out_join(rows, cities, counts, ["loc_text"], [salt_on])


def fuzzy_pairs(pairs: DataFrame, salt_on: str) -> DataFrame:
    """Fuzzy score of each row, worked out once per distinct pair of texts."""
    texts = ["match_text", "company_text"]
    pairs = settle(pairs, "pairs")
    counts = pairs.groupBy(*texts).agg(F.count("*").alias("n_rows"))
    scored = fuzzy.with_fuzzy_score(counts.select(*texts), *texts)
    return fan_out_join(pairs, scored, counts, texts, [salt_on])


def _contenders(pairs: DataFrame, keys: list[str], opts: MatchOptions) -> DataFrame:
    """Candidates whose bounds let them win, which are the only ones worth scoring."""
    return ranking.contenders(fuzzy.with_bounds(pairs, "match_text", "company_text"), keys, opts)


def find_locations(texts: list[DataFrame], opts: MatchOptions, prior: DataFrame | None = None,
                   gazetteer: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Dictionary of all discovered locations, then the cities of every location text."""
    spark = texts[0].sparkSession
    paths = [scratch_path(spark, name) for name in ("dictionary", "cities")]
    with temporary_tables(spark):
        found = locations.distinct_location_texts(*texts)
        if gazetteer is not None and opts.enable_automated_city_detection:
            found = found.join(locations.gazetteer_hits(found, gazetteer), "loc_text", "left")
        found = settle(found, "location-texts")
        dictionary = settle(locations.location_dictionary(found, *([prior] if prior is not None else [])), "dictionary", paths[0])
        return dictionary, settle(locations.locate(found, dictionary), "cities", paths[1])


@dataclass(frozen=True)
class MatchRun:
    results: DataFrame
    locations: DataFrame
    mentions: DataFrame


_KEY = ["_id", "_no_id"]


def _keyed(df: DataFrame) -> DataFrame:
    """The narration id as a key that also joins rows without one."""
    kind = df.schema["txn_id"].dataType
    blank = F.lit("" if kind.simpleString() == "string" else 0).cast(kind)
    return df.withColumns({"_id": F.coalesce("txn_id", blank), "_no_id": F.col("txn_id").isNull()})


def match_transactions(txns: DataFrame, index: CompanyIndex, opts: MatchOptions = MatchOptions(),
                       txn_id: str | None = None, text_col: str | None = None,
                       prior_locations: DataFrame | None = None, gazetteer: DataFrame | None = None,
                       txn_vectors: DataFrame | None = None) -> MatchRun:
    """Best company per narration, all output columns, not yet sorted or projected.

    Equal narrations are scored once. With ``txn_vectors`` (txn_id, vector) the
    candidates come from the vectors, and narrations of equal text and vectors are scored once.
    """
    if opts.search in ("exact", "lsh", "probed") and txn_vectors is None:
        raise ValueError(f"search={opts.search!r} needs txn_vectors")
    if txn_vectors is not None and opts.search != "sparse" and index.vectors is None:
        raise ValueError("the company index was built without vectors_table")
    text_col = text_col or files.narration_text_column(txns, opts.narration_column)
    if txn_id is None:
        txns, txn_id = files.with_ordinal(txns, [text_col], "txn_id"), "txn_id"
    given = [F.struct(*[F.col(f"`{c}`") for c in txns.columns]).alias("_input")] if opts.keep_input_columns else []
    raw = txns.select(F.col(f"`{txn_id}`").alias("txn_id"), F.col(f"`{text_col}`").alias("transaction_text"), *given)
    rows = settle(_keyed(preprocess_narrations(raw, "transaction_text", opts)).select(
        "txn_id", "transaction_text", *_KEY, *MENTION, *(["_input"] if given else [])), "narrations")
    spark = txns.sparkSession
    by_vector = txn_vectors is not None and opts.search != "sparse"
    if by_vector:
        paths = [scratch_path(spark, name) for name in ("narrations-asked", "vector-candidates")]
        with temporary_tables(spark):
            asked, candidates, backend = _asked_candidates(txn_vectors, index, opts)
            candidates = settle(candidates, "vector-candidates", paths[1])
            rows = settle(rows.join(asked, _KEY, "left").withColumn(
                "_asked", F.coalesce("_asked", F.array().cast("array<long>"))), "narrations-asked", paths[0])
    keys = ["_asked", *MENTION] if by_vector else MENTION
    join_on = ["_asked", "match_text"] if by_vector else ["match_text"]
    mentions = settle(rows.groupBy(*keys).agg(F.count("*").alias("n_rows")), "mentions")
    dictionary, cities = find_locations([mentions, index.companies], opts, prior_locations, gazetteer)
    path = scratch_path(spark, "outcome")
    with temporary_tables(spark):
        texts = settle(mentions.select(*join_on).distinct(), "texts")
        placed = settle(with_cities(mentions.drop("n_rows"), cities, "match_text" if by_vector else keys[0]), "placed")
        side = company_side(index, cities)
        side = side if index.company_bytes <= BROADCAST_BYTES else settle(side, "company-side")
        if by_vector:
            named = settle(attach_companies(candidates, index, side, "company_id"), "named")

        def pairs(some: DataFrame) -> DataFrame:
            rows = some.count() * opts.max_candidates
            if not by_vector:
                found = sparse_candidates(some, index, opts)
                wide = spread(attach_companies(found, index, side), "match_text", rows, hashed=True)
                return fuzzy.with_fuzzy_score(_contenders(wide, join_on, opts), "match_text", "company_text")
            counts = some.groupBy("_asked").agg(F.count("*").alias("n_rows"))
            found = fan_out_join(spread(some, "match_text", rows), named, counts, ["_asked"], ["match_text"], "inner")
            return fuzzy_pairs(_contenders(found, join_on, opts), "company_id")

        def won(cut: Callable) -> DataFrame:
            scored = cut(placed).join(pairs(cut(texts)), join_on).withColumn(
                "city_boost", locations.city_boost(F.col("cities"), F.col("company_cities")))
            return ranking.best_candidate(ranking.with_scores(scored, opts), *keys).select(
                *keys, "company_id", "company_name", "similarity", "fuzzy_score", "city_boost", "final_score", "company_cities")

        # All that belongs to a text is worked out in the slice of the text, which leaves the winners only.
        winners = in_slices(texts, "match_text", won, "winners")
        outcome = settle(ranking.complete(placed, winners, keys, backend if by_vector else "sparse"), "outcome", path)
    results = fan_out_join(rows, outcome, mentions, keys, salt_on=["txn_id"]).drop(*_KEY, "_asked")
    results = ranking.apply_confidence(results.drop(*MENTION), opts)
    if given:
        taken = {c.lower() for c in results.columns}
        more = [c for c in txns.columns if c.lower() not in taken and c not in (text_col, txn_id)]
        results = results.select("*", *[F.col("_input").getField(c).alias(c) for c in more]).drop("_input")
    return MatchRun(results, dictionary, mentions)


def finish(run: MatchRun, opts: MatchOptions, observed: Observation | None = None) -> DataFrame:
    """Chosen columns, sorted if asked for.

    An observation gets the counts of the summary while the rows are written. It stands after the
    sort, which reads its input twice.
    """
    seen = [F.col("company_name").alias("_company"), F.col("final_score").alias("_score")] if observed else []
    shown = ranking.project(run.results, opts, ("txn_id", "company_id"), *seen)
    shown = ranking.sort_by_score(shown) if opts.sort_by_score else shown
    if observed is None:
        return shown
    return shown.observe(observed, *ranking.summary_counts(F.col("_company"), F.col("_score"))).drop("_company", "_score")


@dataclass(frozen=True)
class RunOutcome:
    """Where the results of a run lie, and what was counted while they were written."""

    path: str
    summary: dict[str, int]


def _read(spark: SparkSession, path: str, rejects: list[DataFrame] | None) -> DataFrame:
    """A table; rows of a CSV that have too few or too many fields go to the rejects, if these are asked for."""
    if rejects is None or not path.lower().endswith(".csv"):
        return files.read_table(spark, path)
    good, bad = files.read_csv_apart(spark, path)
    rejects.append(bad.select(F.lit(path).alias("source"), "file", "line"))
    return good


def run(spark: SparkSession, companies_path: str, transactions_path: str, results_path: str,
        opts: MatchOptions = MatchOptions(), index_path: str | None = None,
        locations_path: str | None = None, company_id: str | None = None,
        txn_id: str | None = None, gazetteer: DataFrame | None = None,
        vectors_table: DataFrame | None = None, txn_vectors: DataFrame | None = None,
        rejects_path: str | None = None, run_id: str | None = None) -> RunOutcome:
    """Whole run over files: stored company tables and known locations are reused.

    Stored tables that are not complete, or were made with other options or of other companies or
    vectors, are made anew; they are taken as they are if the company file is no longer there.
    Rows of CSV files with too few or too many fields are written to ``rejects_path`` as (source,
    file, line) and left out, if it is given. The summary is counted while the results are written.
    With ``run_id`` the locations path is a folder that keeps what each run found: earlier runs are
    known before, and a run done again takes its own place.
    Scratch tables are deleted at the end.
    """
    rejects = None if rejects_path is None else []
    with temporary_tables(spark):
        source = wanted = None
        if files.path_exists(spark, companies_path):
            source = _read(spark, companies_path, rejects)
            text_col = files.company_text_column(source, opts.company_column)
            wanted = manifest(source, opts, company_id, text_col, vectors_table) if index_path else None
        if index_path and stored_index_fits(spark, index_path, opts, wanted):
            index = load_company_index(spark, index_path)
        else:
            source = source if source is not None else _read(spark, companies_path, rejects)
            index = build_company_index(source, opts, company_id, vectors_table=vectors_table, path=index_path, gazetteer=gazetteer)
        prior = None
        if locations_path:
            prior = files.read_location_runs(spark, locations_path, run_id) if run_id else files.read_locations(spark, locations_path)
        done = match_transactions(_read(spark, transactions_path, rejects), index, opts, txn_id,
                                  prior_locations=prior, gazetteer=gazetteer, txn_vectors=txn_vectors)
        observed = Observation("results")
        files.write_results(finish(done, opts, observed), results_path)
        summary = {**observed.get, "discovered_locations": done.locations.count()}
        if rejects:
            counted = Observation("rejects")
            reduce(DataFrame.unionByName, rejects).observe(counted, F.count(F.lit(1)).alias("rejected_rows")).write.mode("overwrite").parquet(rejects_path)
            summary |= counted.get
        if locations_path and run_id:
            shown = done.mentions.select("loc_text", "n_rows").unionByName(index.companies.select("loc_text", F.lit(1).cast("long").alias("n_rows")))
            files.add_location_run(locations.location_counts(shown, F.col("n_rows"), gazetteer), locations_path, run_id)
        elif locations_path:
            files.write_locations(done.locations, locations_path)
    return RunOutcome(results_path, summary)
