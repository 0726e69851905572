"""Finding locations in texts, and the dictionary of discovered locations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrakin.functions import places, text
from narrakin.functions.similarity import closest_names
from narrakin.operators.skew import lookup_join, lookup_rows
from narrakin.session import settle, spread

_NONE = "array<string>"


def _no_names() -> Column:
    return F.array().cast(_NONE)


def distinct_location_texts(*tables: DataFrame) -> DataFrame:
    """Every location text once, with the places its own words show.

    The texts are stored first, so that their number and not their bytes sets how many tasks look for places.
    """
    texts = settle(reduce(DataFrame.unionByName, [t.select("loc_text") for t in tables]).distinct(), "distinct-location-texts")
    return spread(texts, "loc_text", texts.count()).withColumns({
        "suffix_locations": places.suffix_locations(F.col("loc_text")),
        "major_cities": places.major_cities(F.col("loc_text")),
    })


def _fit_names(names: DataFrame, column: str) -> DataFrame:
    return names.filter((F.length(column) > 2) & (F.length(column) < 30))


def entity_locations(rows: DataFrame, entities: str, key: str = "loc_text") -> DataFrame:
    """Locations that rows name themselves in a list column, by location text, in order.

    Names are trimmed and lower-cased, and kept if they have 3 to 29 characters. Rows of one text put
    their names together. The result can take the place of gazetteer_hits.
    """
    named = rows.select(key, F.posexplode(entities).alias("at", "name")).select(
        key, "at", F.lower(F.trim("name")).alias("name"))
    first = _fit_names(named, "name").groupBy(key, "name").agg(F.min("at").alias("at"))
    ordered = F.array_sort(F.collect_list(F.struct("at", "name")))
    return first.groupBy(key).agg(ordered.getField("name").alias("gazetteer_locations"))


def gazetteer_hits(texts: DataFrame, gazetteer: DataFrame, key: str = "loc_text") -> DataFrame:
    """Phrases that a supplied location table lists, in text order.

    Entries have 3 to 29 characters; the longest of them in words sets the length of the runs of
    words that are looked up.
    """
    names = settle(_fit_names(gazetteer.select(F.lower(F.trim("location")).alias("phrase")), "phrase").distinct(), "gazetteer")
    longest = names.agg(F.max(F.size(F.split("phrase", " ")))).first()[0] or 1
    token = text.words(F.col(key))
    runs = F.flatten(F.transform(token, lambda w, i: F.transform(
        F.filter(F.sequence(F.lit(1), F.lit(longest)), lambda n: i + n <= F.size(token)),
        lambda n: F.struct(i.alias("at"), n.alias("words"),
                           F.array_join(F.slice(token, i + 1, n), " ").alias("phrase")))))
    phrases = (texts.select(key, F.explode(runs).alias("run"))
               .select(key, "run.at", "run.words", "run.phrase"))
    found = lookup_join(_fit_names(phrases, "phrase"), names, ["phrase"], lookup_rows(names), salt_on=[key])
    ordered = F.array_sort(F.collect_list(F.struct("at", "words", "phrase")))
    return found.groupBy(key).agg(F.array_distinct(ordered.getField("phrase")).alias("gazetteer_locations"))


def location_dictionary(texts: DataFrame, *prior: DataFrame) -> DataFrame:
    """Distinct locations discovered in the texts or known before."""
    found = [F.col(c) for c in ("gazetteer_locations", "suffix_locations") if c in texts.columns]
    names = F.concat(*[F.coalesce(c, _no_names()) for c in found])
    known = texts.select(F.explode(names).alias("location"))
    return reduce(DataFrame.unionByName, [p.select("location") for p in prior], known).distinct()


def location_counts(rows: DataFrame, weight: Column, gazetteer: DataFrame | None = None) -> DataFrame:
    """How many rows show each location by their own words or the supplied table: (location, n).

    weight is the number of rows that a line stands for. Counts of parts of the rows add up to those
    of the whole.
    """
    counts = rows.groupBy("loc_text").agg(F.sum(weight).alias("n"))
    texts = distinct_location_texts(counts)
    if gazetteer is not None:
        texts = texts.join(gazetteer_hits(texts, gazetteer), "loc_text", "left")
    found = [F.coalesce(F.col(c), _no_names()) for c in ("gazetteer_locations", "suffix_locations") if c in texts.columns]
    shown = texts.select("loc_text", F.explode(F.array_distinct(F.concat(*found))).alias("location"))
    return shown.join(counts, "loc_text").groupBy("location").agg(F.sum("n").alias("n"))


def dictionary_hits(texts: DataFrame, dictionary: DataFrame, key: str = "loc_text") -> DataFrame:
    """Dictionary entries longer than three letters that occur inside each text.

    A contained location shows all its four-letter pieces, so joining on one of
    them finds every hit; the piece rarest in the dictionary keeps groups small.
    """
    def pieces(c: Column) -> Column:
        return F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.length(c) - 3), lambda i: F.substring(c, i, 4)))

    names = dictionary.filter(F.length("location") > 3).select("location").distinct()
    cut = names.select("location", F.explode(pieces(F.col("location"))).alias("piece"))
    rarity = cut.groupBy("piece").agg(F.count("*").alias("n"))
    anchors = (cut.join(rarity, "piece").groupBy("location")
               .agg(F.min_by("piece", F.struct("n", "piece")).alias("piece")))
    found = lookup_join(
        texts.filter(F.length(key) > 3).select(key, F.explode(pieces(F.col(key))).alias("piece")),
        anchors, ["piece"], lookup_rows(names), salt_on=[key])
    return (found.filter(F.col(key).contains(F.col("location")))
            .groupBy(key).agg(F.array_sort(F.collect_set("location")).alias("known_locations")))


def locate(texts: DataFrame, dictionary: DataFrame) -> DataFrame:
    """All locations of each distinct location text, without repeats."""
    hits = dictionary_hits(texts, dictionary)
    parts = ["gazetteer_locations", "suffix_locations", "major_cities", "known_locations"]
    joined = texts.join(hits, "loc_text", "left")
    names = [F.coalesce(F.col(c), _no_names()) for c in parts if c in joined.columns]
    return joined.select("loc_text", F.array_distinct(F.concat(*names)).alias("cities"))


def city_boost(txn_cities: Column, company_cities: Column) -> Column:
    """3 for a shared city, else 2 or 1 by the closest pair of names, else 0."""
    blank = (F.size(txn_cities) == 0) | (F.size(company_cities) == 0)
    shared = F.arrays_overlap(txn_cities, company_cities)
    settled = blank | shared
    closest = closest_names(*[
        F.when(~settled, c) for c in (txn_cities, company_cities)])
    return (F.when(blank, F.lit(0.0)).when(shared, F.lit(3.0))
            .when(closest >= 80, F.lit(2.0)).when(closest >= 60, F.lit(1.0)).otherwise(F.lit(0.0)))
