"""Cleaning and normalising of text columns, as Catalyst expressions.

Character classes are spelled out so that "word" means letters, numbers and the
underscore in every script, and white space means the Unicode set.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from narrakin.functions.lexicons import (
    ARTICLES, BANKS, COMPANY_SUFFIXES, LEGAL_WORDS, NOISE_PHRASES,
    longest_first, phrases_of,
)

WORD = r"[\p{L}\p{N}_]"
NOT_WORD_OR_SPACE = r"[^\p{L}\p{N}_\s\x1c-\x1f\x85\p{Z}]"
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
EDGE = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"


def _tree(phrases: list[str]) -> str:
    """Literal phrases as one alternation that reads common beginnings once and tries longer phrases first."""
    by_first: dict[str, list[str]] = {}
    for phrase in longest_first(phrases):
        by_first.setdefault(phrase[:1], []).append(phrase[1:])
    end = by_first.pop("", None) is not None
    branches = [head + (_tree(tails) if tails != [""] else "") for head, tails in by_first.items()] + [""] * end
    return branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"


def _whole(phrases: list[str]) -> str:
    """Phrases that start and end with a word character, as whole words; first a look at the next letter, which most places fail."""
    return rf"(?iu)(?=[{''.join(sorted({p[0] for p in phrases}))}])(?<!{WORD}){_tree(phrases)}(?!{WORD})"


NOISE = _whole(NOISE_PHRASES) + rf"(?:/|{SPACE})*"
BANK = _whole(BANKS)
# Patterns of account numbers, codes, dates and separator runs.
ACCOUNT = rf"(?iu){EDGE}[A-Z0-9]*\*{{3,}}[A-Z0-9]*{EDGE}"
CODE = rf"(?iu)(?<!{WORD})[A-Z0-9]{{10,}}(?!{WORD})"
CODE_WITH_DIGIT = rf"(?iu)(?<!{WORD})(?=[A-Z]*[0-9])[A-Z0-9]{{10,}}(?!{WORD})"
DATE = rf"(?<!{WORD})\p{{Nd}}{{1,2}}[-/]\p{{Nd}}{{1,2}}[-/]\p{{Nd}}{{2,4}}(?!{WORD})"
SEPARATORS = r"[/\-_]{2,}"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+$", "")


def squeeze(c: Column) -> Column:
    """Single blanks between words, none at the ends."""
    return F.trim(F.regexp_replace(c, rf"{SPACE}+", " "))


def single_blanks(c: Column) -> Column:
    """As squeeze, for text whose only white space is the blank."""
    return F.trim(F.regexp_replace(c, "  +", " "))


def as_text(c: Column) -> Column:
    """Null and empty become the empty string; anything else is trimmed text."""
    return strip(F.coalesce(c.cast("string"), F.lit("")))


def fold_case(c: Column) -> Column:
    return F.lower(as_text(c))


def drop_noise(c: Column) -> Column:
    return F.regexp_replace(c, NOISE, " ")


def drop_accounts(c: Column) -> Column:
    return F.when(c.contains("***"), F.regexp_replace(c, ACCOUNT, " ")).otherwise(c)


def drop_codes(c: Column, keep_long_alpha_words: bool = False) -> Column:
    return F.regexp_replace(c, CODE_WITH_DIGIT if keep_long_alpha_words else CODE, " ")


def drop_dates(c: Column) -> Column:
    return F.regexp_replace(c, DATE, " ")


def drop_separators(c: Column) -> Column:
    return F.regexp_replace(c, SEPARATORS, " ")


def _bank_word_runs() -> list[str]:
    """Runs of words the left-to-right bank scan removes, in the order it tries them.

    A two-word name moves the scan on before three-word names are tried, so after
    ``w x`` the three-word test reads ``w`` with the two words behind ``x``.
    """
    one, two, three = (phrases_of(BANKS, n) for n in (1, 2, 3))
    both = [
        f"{pair} {triple.split(' ', 1)[1]}"
        for pair in two for triple in three
        if pair.split(" ")[0] == triple.split(" ")[0]
    ]
    return both + two + three + one


BANK_RUN = "(?:^|(?<= ))(?:" + "|".join(_bank_word_runs()) + ")(?= |$)"


def drop_banks(c: Column) -> Column:
    """Remove bank names of one to three words, scanning words from the left."""
    return single_blanks(F.regexp_replace(squeeze(c), BANK_RUN, ""))


def punctuation_to_space(c: Column) -> Column:
    return squeeze(F.regexp_replace(c, NOT_WORD_OR_SPACE, " "))


def drop_short_words(c: Column) -> Column:
    """Drop words of one or two characters unless they are company suffixes."""
    kept = "|".join(w for w in COMPANY_SUFFIXES if len(w) <= 2)
    return single_blanks(F.regexp_replace(squeeze(c), f"(?:^|(?<= ))(?!(?:{kept})(?: |$))[^ ]{{1,2}}(?= |$)", ""))


def clean_narration(c: Column, filtering: bool = True, keep_long_alpha_words: bool = False) -> Column:
    """Narration without channels, accounts, codes, dates, banks and short words."""
    if not filtering:
        return as_text(c)
    c = drop_noise(fold_case(c))
    c = drop_codes(drop_accounts(c), keep_long_alpha_words)
    c = drop_banks(drop_separators(drop_dates(c)))
    return drop_short_words(punctuation_to_space(c))


def detected_name(c: Column) -> Column:
    """Text left of a narration once every bank name and channel word is deleted."""
    left = squeeze(F.regexp_replace(F.regexp_replace(as_text(c), BANK, ""), NOISE, ""))
    return F.when(F.length(left) < 3, F.lit("")).otherwise(left)


def normalize(c: Column) -> Column:
    """Lower-case name without legal words, conjunctions, articles and punctuation."""
    c = F.regexp_replace(fold_case(c), _whole(LEGAL_WORDS), "")
    conjunctions = F.regexp_replace(c, rf"(?<!{WORD})and(?!{WORD})|(?<={WORD})&(?={WORD})", "")
    c = F.when(c.contains("and") | c.contains("&"), conjunctions).otherwise(c)
    c = F.regexp_replace(c, _whole(ARTICLES), "")
    return punctuation_to_space(c)


def words(c: Column) -> Column:
    """Words of a squeezed text; the empty text has none."""
    return F.array_remove(F.split(c, " "), "")


def matching_text(normalized: Column, cleaned: Column) -> Column:
    return F.coalesce(F.nullif(normalized, F.lit("")), cleaned)
