import random

import pytest
from pyspark.sql import functions as F

from narrakin.functions.similarity import best_windows, lcs_lengths
from narrakin.operators import fuzzy


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def ratio(a, b):
    return 100.0 if not a and not b else 200.0 * lcs(a, b) / (len(a) + len(b))


def window(s, l):
    spans = [(max(i, 0), min(i + len(s), len(l))) for i in range(1 - len(s), len(l))]
    return max((ratio(s, l[a:b]) for a, b in spans if a < b), default=0.0)


def partial(a, b):
    if not a or not b:
        return 100.0 if a == b else 0.0
    s, l = sorted((a, b), key=len)
    return max(window(s, l), window(l, s)) if len(a) == len(b) else window(s, l)


def token_sort(a, b):
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a, b):
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not left or not right):
        return 100.0
    one, two = f"{both} {left}".strip(), f"{both} {right}".strip()
    own = len(left) + len(right) - 2 * lcs(left, right)
    scores = [100.0 * (1 - own / (len(one) + len(two)))]
    if both:
        scores += [ratio(both, one), ratio(both, two)]
    return max(scores)


def random_texts(rng, n, longest):
    return ["".join(rng.choice("abcdé ") for _ in range(rng.randint(0, longest))) for _ in range(n)]


def test_lcs_and_windows_match_plain_tables():
    rng = random.Random(1)
    for longest in (20, 150):
        a, b = random_texts(rng, 80, longest), random_texts(rng, 80, longest)
        assert lcs_lengths(a, b).tolist() == [lcs(x, y) for x, y in zip(a, b, strict=True)]
        pairs = [sorted(p, key=len) for p in zip(a, b, strict=True)]
        got = best_windows([p[0] for p in pairs], [p[1] for p in pairs])
        assert got.tolist() == [window(*p) for p in pairs]


def test_ratios_of_word_like_pairs(spark):
    rng = random.Random(2)
    pool = ["ab", "abc", "cde", "motors", "motor", "xyz", "chennai"]
    pairs = [(" ".join(rng.choices(pool, k=rng.randint(0, 4))), " ".join(rng.choices(pool, k=rng.randint(0, 4))))
             for _ in range(300)]
    pairs += [("", ""), ("a", ""), ("", "b"), ("ab cd", "cd ab"), ("a b", "a b c")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    for row in fuzzy.with_ratios(df, "a", "b").collect():
        a, b = pairs[row.i]
        wanted = {"ratio": ratio(a, b), "partial_ratio": partial(a, b),
                  "token_sort_ratio": token_sort(a, b), "token_set_ratio": token_set(a, b)}
        for name, value in wanted.items():
            assert row[name] == pytest.approx(value, abs=1e-9), (name, a, b)
            assert 0.0 <= row[name] <= 100.0


def test_fuzzy_score_is_symmetric_and_the_highest_ratio(spark):
    rng = random.Random(3)
    texts = random_texts(rng, 60, 18)
    df = spark.createDataFrame(list(zip(texts[:30], texts[30:], strict=True)), "a string, b string").select(
        F.trim(F.regexp_replace("a", " +", " ")).alias("a"), F.trim(F.regexp_replace("b", " +", " ")).alias("b"))
    there = fuzzy.with_fuzzy_score(df, "a", "b").orderBy("a", "b").collect()
    back = fuzzy.with_fuzzy_score(df, "b", "a").orderBy("a", "b").collect()
    assert there == back
    for row in there:
        assert row.fuzzy_score == pytest.approx(max(f(row.a, row.b) for f in (ratio, partial, token_sort, token_set)))
