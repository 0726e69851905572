"""Fuzzy string scores of candidate pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrakin.functions import similarity as sim

RATIOS = ("ratio", "partial_ratio", "token_sort_ratio", "token_set_ratio")


def with_ratios(pairs: DataFrame, left: str, right: str, *names: str) -> DataFrame:
    """Add the named ratios of two text columns, all four by default.

    Word lists, then the strings to compare, then the ratios: each step is its own
    projection so that nothing is worked out twice.
    """
    names = names or RATIOS
    a, b = F.col(left), F.col(right)
    work = pairs
    if {"token_sort_ratio", "token_set_ratio"} & set(names):
        work = work.withColumns({"_a": sim.words_of(a), "_b": sim.words_of(b)})
    if "token_sort_ratio" in names:
        work = work.withColumns({"_sorted_a": F.array_join(F.array_sort("_a"), " "),
                                 "_sorted_b": F.array_join(F.array_sort("_b"), " ")})
    if "token_set_ratio" in names:
        work = work.withColumns({
            "_shared": F.array_join(F.array_intersect("_a", "_b"), " "),
            "_only_a": F.array_join(F.array_sort(F.array_except("_a", "_b")), " "),
            "_only_b": F.array_join(F.array_sort(F.array_except("_b", "_a")), " ")})
    ratios = {
        "ratio": lambda: sim.indel_ratio(a, b),
        "partial_ratio": lambda: sim.partial_ratio(a, b),
        "token_sort_ratio": lambda: sim.indel_ratio(F.col("_sorted_a"), F.col("_sorted_b")),
        "token_set_ratio": lambda: sim.word_set_ratio(
            F.col("_shared"), F.col("_only_a"), F.col("_only_b")),
    }
    return work.select(*[F.col(c) for c in pairs.columns], *[ratios[n]().alias(n) for n in names])


def with_fuzzy_score(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Add the highest of the four ratios."""
    scored = with_ratios(pairs, left, right)
    return scored.withColumn("fuzzy_score", F.greatest(*RATIOS)).drop(*RATIOS)


def with_bounds(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Add fuzzy_low and fuzzy_high, between which the highest of the four ratios lies.

    They come from lengths, letter counts and whole words, without comparing the order of letters:
    a common subsequence has no more of a letter than either text.
    """
    a, b = F.col(left), F.col(right)
    work = pairs.withColumns({"_a": sim.words_of(a), "_b": sim.words_of(b)}).withColumns({
        "_shared": F.length(F.array_join(F.array_intersect("_a", "_b"), " ")),
        "_only_a": F.array_join(F.array_except("_a", "_b"), " "),
        "_only_b": F.array_join(F.array_except("_b", "_a"), " ")})
    gaps = lambda words: F.greatest(F.size(words) - 1, F.lit(0))
    work = work.withColumns({
        "_common": sim.common_letters(a, b),
        "_common_only": sim.common_letters(F.col("_only_a"), F.col("_only_b")),
        "_blank": F.least(sim.blanks(a), sim.blanks(b))})
    none, n, na, nb = F.lit(0), F.col("_shared"), F.length("_only_a"), F.length("_only_b")
    sorted_length = lambda text, words: F.length(text) - sim.blanks(text) + gaps(words)
    bounds = {
        "fuzzy_low": sim.word_set_bound(none, n, na, nb),
        "fuzzy_high": F.greatest(
            sim.highest_ratio(F.col("_common"), F.length(a), F.length(b)),
            sim.highest_partial(F.col("_common"), F.length(a), F.length(b)),
            sim.highest_ratio(F.col("_common") - F.col("_blank") + F.least(gaps("_a"), gaps("_b")),
                              sorted_length(a, "_a"), sorted_length(b, "_b")),
            sim.word_set_bound(F.col("_common_only"), n, na, nb))}
    return work.select(*[F.col(c) for c in pairs.columns], *[c.alias(name) for name, c in bounds.items()])
