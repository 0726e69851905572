import random

import pytest
from pyspark.sql import functions as F

from narrakin.functions import lexicons, text
from narrakin.functions.lexicons import BANKS


def apply(spark, step, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in df.select("i", step(F.col("v")).alias("out")).orderBy("i").collect()]


CASES = [
    (lambda c: text.clean_narration(c), "NEFT/IQOV94360237845587/OMERODE", "omerode"),
    (lambda c: F.trim(text.drop_accounts(text.fold_case(c))), "A****885 x", "x"),
    (lambda c: text.drop_accounts(text.fold_case(c)), "N095**** x", "n095**** x"),
    (lambda c: F.trim(text.drop_codes(c)), "ramcosystems vellore", "vellore"),
    (lambda c: F.trim(text.drop_codes(c, True)), "ramcosystems abcde12345 vellore", "ramcosystems   vellore"),
    (text.drop_banks, "union bank of india", "of india"),
    (text.drop_banks, "state bank of india", "state"),
    (text.drop_banks, "idfc first bank payroll", "payroll"),
    (text.drop_banks, "axis motors", "motors"),
    (text.drop_banks, "indian bank overseas bank shop", "shop"),
    (text.clean_narration, "NEFT/HDFC/X TRADERS", "hdfc traders"),
    (text.clean_narration, "RTGS/ABCDEF12345678/STAR & CO CHENNAI HDFC BANK", "star co chennai"),
    (lambda c: text.clean_narration(c, filtering=False), "  NEFT/Ab ", "NEFT/Ab"),
    (text.drop_short_words, "ab co traders", "co traders"),
    (text.detected_name, "hdfc", ""),
    (text.detected_name, "kotak mahindra bank asha foods", "asha foods"),
    (text.normalize, "The A&B Traders Pvt Ltd", "ab traders"),
    (text.normalize, "A & B Traders", "b traders"),
    (text.normalize, None, ""),
    (text.clean_narration, None, ""),
    (text.normalize, "CAFÉ the Ünal & Söhne", "café ünal söhne"),
    (text.normalize, "thé a café", "thé café"),
    (text.punctuation_to_space, "a b　c, d", "a b c d"),
    (text.drop_dates, "x 12-05-2024 y", "x   y"),
    (text.drop_dates, "x 112-05-2024 y", "x 112-05-2024 y"),
    (text.drop_separators, "a//b_c--d", "a b_c d"),
]


@pytest.mark.parametrize("step", range(len(CASES)))
def test_hand_cases(spark, step):
    function, given, wanted = CASES[step]
    assert apply(spark, function, [given]) == [wanted]


def scan_banks(line: str) -> str:
    """Word-by-word restatement of the bank scan."""
    words, kept, at = line.split(), [], 0
    while at < len(words):
        here, found = at, words[at] in BANKS
        if at + 1 < len(words) and f"{words[here]} {words[at + 1]}" in BANKS:
            found, at = True, at + 1
        if at + 2 < len(words) and f"{words[here]} {words[at + 1]} {words[at + 2]}" in BANKS:
            found, at = True, at + 2
        if not found:
            kept.append(words[here])
        at += 1
    return " ".join(kept)


def test_bank_scan_on_random_words(spark):
    rng = random.Random(7)
    pool = sorted({w for b in BANKS for w in b.split()}) + ["ramco", "foods"]
    lines = [" ".join(rng.choices(pool, k=rng.randint(1, 7))) for _ in range(1500)]
    lines += [" ".join(rng.choices(BANKS, k=3)) for _ in range(1500)]
    assert apply(spark, text.drop_banks, lines) == [scan_banks(x) for x in lines]


def test_cleaning_twice_changes_nothing_for_punctuation(spark):
    lines = ["a,b  c", "x--y", " p.q "]
    once = apply(spark, text.punctuation_to_space, lines)
    assert apply(spark, text.punctuation_to_space, once) == once


@pytest.mark.parametrize("phrases", [lexicons.BANKS, lexicons.NOISE_PHRASES, lexicons.LEGAL_WORDS, lexicons.ARTICLES])
def test_phrase_patterns_find_what_plain_alternatives_find(spark, phrases):
    rng = random.Random(3)
    words = [w for p in phrases for w in [p, *p.split(" ")]] + ["ſbi", "ıdfc", "Kotak", "x", "é", "and", "ań"]
    values = [rng.choice([" ", "/", "", "_", "  "]).join(rng.choices(words, k=rng.randint(1, 6))) for _ in range(600)]
    plain = rf"(?iu)(?<!{text.WORD})(?:{'|'.join(lexicons.longest_first(phrases))})(?!{text.WORD})"
    for c in (lambda c: c, F.upper):
        assert apply(spark, lambda v: F.regexp_replace(c(v), text._whole(phrases), "<>"), values) == apply(
            spark, lambda v: F.regexp_replace(c(v), plain, "<>"), values)
    assert text._tree(["ab", "a", "abc", "xy"]) == "(?:a(?:b(?:c|)|)|xy)"


def test_words_leave_out_empty_ones(spark):
    assert apply(spark, text.words, ["a  b", "", " a ", None]) == [["a", "b"], [], ["a"], None]
