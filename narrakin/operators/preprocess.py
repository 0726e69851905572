"""Company master and narrations with their derived text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrakin.functions import places, text
from narrakin.options import MatchOptions


def _with_match_columns(df: DataFrame, cleaned: str, normalized: str) -> DataFrame:
    return (df.withColumn("match_text", text.matching_text(F.col(normalized), F.col(cleaned)))
            .withColumn("tokens", text.words(F.col("match_text"))))


def preprocess_companies(companies: DataFrame, id_col: str, text_col: str,
                         opts: MatchOptions = MatchOptions()) -> DataFrame:
    """One row per company; blanks and duplicates stay."""
    name = F.col("original_name")
    df = companies.select(F.col(id_col).alias("company_id"), text.as_text(F.col(text_col)).alias("original_name"))
    df = df.withColumns({
        "cleaned_text": F.lower(text.punctuation_to_space(name)),
        "normalized_text": text.normalize(name),
        "loc_text": places.location_text(name, opts.keep_long_alpha_words),
    })
    return _with_match_columns(df, "cleaned_text", "normalized_text")


def preprocess_narrations(txns: DataFrame, text_col: str, opts: MatchOptions = MatchOptions()) -> DataFrame:
    """Narrations with all input columns kept and the derived texts added."""
    filtered = F.col("filtered")
    df = txns.withColumns({
        "original": text.as_text(F.col(text_col)),
        "filtered": text.clean_narration(
            F.col(text_col), opts.enable_transaction_filtering, opts.keep_long_alpha_words),
    })
    df = df.withColumns({
        "cleaned": F.lower(text.punctuation_to_space(filtered)),
        "normalized": text.normalize(filtered),
        "loc_text": places.location_text(filtered, opts.keep_long_alpha_words),
    })
    return _with_match_columns(df, "cleaned", "normalized").drop("filtered")
