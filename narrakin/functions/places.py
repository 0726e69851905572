"""Location expressions over one text column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from narrakin.functions.lexicons import CHANNEL_PREFIXES, LOCATION_SUFFIXES, MAJOR_CITIES, longest_first
from narrakin.functions.text import SPACE, fold_case, single_blanks, words

_PREFIX = rf"(?iu)^(?:{'|'.join(longest_first(CHANNEL_PREFIXES))})(?:/|{SPACE})"
_SUFFIXED = rf"^.{{3,}}(?:{'|'.join(longest_first(LOCATION_SUFFIXES))})$"


def location_text(c: Column, keep_long_alpha_words: bool = False) -> Column:
    """Words of a text that may name a place, joined by blanks."""
    code = r"(?=[a-z]*[0-9])[a-z0-9]{10,}" if keep_long_alpha_words else r"[a-z0-9]{10,}"
    parts = F.regexp_replace(
        F.regexp_replace(fold_case(c), _PREFIX, ""), rf"(?:[/\-_]|{SPACE})+", " ")
    return single_blanks(F.regexp_replace(
        F.trim(parts), rf"(?iu)(?:^|(?<= ))(?:[^ ]{{1,2}}|[^ ]{{50,}}|\p{{Nd}}+|{code})(?= |$)", ""))


def suffix_locations(loc_text: Column) -> Column:
    """Words with a place-name ending and at least three letters before it."""
    return F.array_distinct(F.filter(
        words(loc_text), lambda w: (F.length(w) < 25) & w.rlike(_SUFFIXED)))


def major_cities(loc_text: Column) -> Column:
    """Major cities that occur anywhere in the text, alphabetically."""
    return F.array_compact(F.array(*[
        F.when(loc_text.contains(city), F.lit(city)) for city in sorted(MAJOR_CITIES)]))
