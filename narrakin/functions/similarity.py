"""String ratios over pairs of text columns.

The only part Catalyst cannot express well is the longest common subsequence of
two strings, so that is an Arrow UDF working on whole batches at once; every
ratio is then column arithmetic on its result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BATCH_CELLS = 1 << 21
_ALL_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def _codepoints(texts: list[str], pad: int) -> np.ndarray:
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    matrix = np.full((len(texts), max(int(lengths.max()), 1)), pad, np.uint32)
    matrix[np.arange(matrix.shape[1]) < lengths[:, None]] = np.frombuffer(
        "".join(texts).encode("utf-32-le"), "<u4")
    return matrix


def _match_bits(short: list[str], long: list[str]) -> np.ndarray:
    """bits[pair, j, w]: positions in ``short`` equal to character j of ``long``."""
    s, l = _codepoints(short, 0xFFFFFFFF), _codepoints(long, 0xFFFFFFFE)
    bits = np.zeros((l.shape[0], l.shape[1], (s.shape[1] + 63) // 64), np.uint64)
    for i in range(s.shape[1]):
        bits[:, :, i // 64] |= (l == s[:, i, None]).astype(np.uint64) << np.uint64(i % 64)
    return bits


def _advance(state: np.ndarray, match: np.ndarray) -> None:
    """One character of the bit-parallel LCS recurrence, in place, for every row."""
    carry = np.zeros(len(state), np.uint64)
    for w in range(state.shape[1]):
        v, m = state[:, w], match[:, w]
        total = v + (v & m)
        overflow = total < v
        total = total + carry
        carry = (overflow | (total < carry)).astype(np.uint64)
        state[:, w] = total | (v & ~m)


def _lcs(state: np.ndarray) -> np.ndarray:
    return np.bitwise_count(~state).sum(axis=1).astype(np.int64)


def _row_batches(a: list[str], b: list[str]) -> Iterator[np.ndarray]:
    """Row numbers in batches of similar length whose bit tables fit in the cache."""
    la = np.fromiter(map(len, a), np.int64, len(a))
    lb = np.fromiter(map(len, b), np.int64, len(b))
    order = np.lexsort((la, lb))
    start = 0
    while start < len(order):
        stop = start + 1
        words = width = 1
        while stop <= len(order):
            row = order[stop - 1]
            words = max(words, (int(la[row]) + 63) // 64)
            width = max(width, int(lb[row]))
            if stop > start + 1 and (stop - start) * words * width > _BATCH_CELLS:
                break
            stop += 1
        yield order[start:max(stop - 1, start + 1)]
        start = max(stop - 1, start + 1)


def lcs_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of each pair."""
    out = np.zeros(len(a), np.int64)
    for rows in _row_batches(a, b):
        bits = _match_bits([a[i] for i in rows], [b[i] for i in rows])
        state = np.full((len(rows), bits.shape[2]), _ALL_ONES)
        for j in range(bits.shape[1]):
            _advance(state, bits[:, j])
        out[rows] = _lcs(state)
    return out


def best_windows(short: list[str], long: list[str]) -> np.ndarray:
    """Best indel ratio of ``short`` with a window of ``long`` of at most its length.

    Windows shorter than ``short`` only touch an end of ``long``.
    """
    best = np.zeros(len(short))
    for batch in _row_batches(short, long):
        size = np.fromiter((len(short[i]) for i in batch), np.int64, len(batch))
        rows = batch[np.argsort(-size, kind="stable")]
        size = -np.sort(-size, kind="stable")
        reach = np.fromiter((len(long[i]) for i in rows), np.int64, len(rows))
        bits = _match_bits([short[i] for i in rows], [long[i] for i in rows])
        found = np.zeros(len(rows))

        def score(state: np.ndarray, width: np.ndarray) -> None:
            n = len(state)
            total = size[:n] + width
            ratio = np.divide(200.0 * _lcs(state), total, out=np.zeros(n), where=total > 0)
            np.maximum(found[:n], ratio, out=found[:n])

        for start in range(bits.shape[1]):
            state = np.full((len(rows), bits.shape[2]), _ALL_ONES)
            for step in range(min(int(size[0]) if len(size) else 0, bits.shape[1] - start)):
                active = int(np.searchsorted(-size, -step, side="left"))
                _advance(state[:active], bits[:active, start + step])
                if start == 0:
                    score(state[:active], np.minimum(step + 1, reach[:active]))
            score(state, np.clip(np.minimum(size, reach - start), 0, None))
        best[rows] = found
    return best


@F.pandas_udf(T.LongType())
def lcs_length(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(lcs_lengths(a.tolist(), b.tolist()))


@F.pandas_udf(T.DoubleType())
def best_window(a: pd.Series, b: pd.Series) -> pd.Series:
    """Best window ratio with the shorter text sliding over the longer one."""
    pairs = list(zip(a, b, strict=True))
    short = [x if len(x) <= len(y) else y for x, y in pairs]
    long = [y if len(x) <= len(y) else x for x, y in pairs]
    best = best_windows(short, long)
    same = [i for i, (x, y) in enumerate(pairs) if len(x) == len(y) and best[i] < 100.0]
    if same:
        swapped = best_windows([long[i] for i in same], [short[i] for i in same])
        best[same] = np.maximum(best[same], swapped)
    return pd.Series(best)


@F.pandas_udf(T.DoubleType())
def closest_names(left: pd.Series, right: pd.Series) -> pd.Series:
    """Highest indel ratio between a name of one list and a name of the other.

    A null list on either side gives 0. Equal pairs of lists, and of names, are worked out once.
    """
    rows: dict[tuple, list[int]] = {}
    for i, (xs, ys) in enumerate(zip(left, right, strict=True)):
        if xs is not None and ys is not None:
            rows.setdefault((tuple(xs), tuple(ys)), []).append(i)
    pairs = list(dict.fromkeys((x, y) for xs, ys in rows for x in xs for y in ys))
    best = np.zeros(len(left))
    if pairs:
        xs, ys = [list(side) for side in zip(*pairs, strict=True)]
        total = np.fromiter((len(x) + len(y) for x, y in pairs), np.int64, len(pairs))
        ratio = dict(zip(pairs, 200.0 * lcs_lengths(xs, ys) / np.maximum(total, 1), strict=True))
        for (xs, ys), at in rows.items():
            best[at] = max((ratio[x, y] for x in xs for y in ys), default=0.0)
    return pd.Series(best)


def _share(common: Column, total: Column) -> Column:
    """Percentage 200*common/total; two empty texts are equal."""
    return F.when(total == 0, F.lit(100.0)).otherwise(F.lit(200.0) * common / total)


def indel_ratio(a: Column, b: Column) -> Column:
    return _share(lcs_length(a, b), F.length(a) + F.length(b))


def partial_ratio(a: Column, b: Column) -> Column:
    return (F.when((a == "") & (b == ""), F.lit(100.0))
            .when((a == "") | (b == ""), F.lit(0.0))
            .otherwise(best_window(a, b)))


def words_of(c: Column) -> Column:
    return F.array_remove(F.split(c, " "), "")


def word_set_ratio(shared: Column, only_a: Column, only_b: Column) -> Column:
    """Best ratio among the shared words and each side's shared plus own words.

    The arguments are the joined words both texts have and those only one has.
    """
    n, na, nb = F.length(shared), F.length(only_a), F.length(only_b)
    gap = F.when(n > 0, 1).otherwise(0)
    left, right = n + gap + na, n + gap + nb

    def kept(total: Column, dist: Column) -> Column:
        return F.lit(100.0) * (total - dist) / total

    rest = kept(left + right, na + nb - 2 * lcs_length(only_a, only_b))
    return (F.when((n + na == 0) | (n + nb == 0), F.lit(0.0))
            .when((n > 0) & ((na == 0) | (nb == 0)), F.lit(100.0))
            .when(n > 0, F.greatest(rest, kept(n + left, gap + na), kept(n + right, gap + nb)))
            .otherwise(rest))


#: Letters that are counted one by one for bounds; all other characters count together.
COUNTED = " abcdefghijklmnopqrstuvwxyz0123456789"


_OTHER = len(COUNTED)
_PLACE = np.array([COUNTED.find(chr(c)) % (_OTHER + 1) for c in range(128)])
#: Characters of one side that are counted in one step.
_COUNT_CHARS = 1 << 20


def letter_counts(texts: list[str]) -> np.ndarray:
    """How often each text has each counted letter, and how many other characters."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    cell = np.repeat(np.arange(len(texts)) * (_OTHER + 1), lengths) + _PLACE[np.minimum(codes, 127)]
    return np.bincount(cell, minlength=len(texts) * (_OTHER + 1)).reshape(len(texts), _OTHER + 1)


def most_common(a: list[str], b: list[str]) -> np.ndarray:
    """The most characters the two texts of each pair can have in common, in any order, by their letter counts."""
    out = np.zeros(len(a), np.int64)
    done = np.cumsum(np.fromiter((len(x) + len(y) for x, y in zip(a, b)), np.int64, len(a)))
    start = 0
    while start < len(a):
        stop = max(start + 1, int(np.searchsorted(done, (done[start - 1] if start else 0) + _COUNT_CHARS, side="right")))
        out[start:stop] = np.minimum(letter_counts(a[start:stop]), letter_counts(b[start:stop])).sum(axis=1)
        start = stop
    return out


@F.pandas_udf(T.LongType())
def common_letters(a: pd.Series, b: pd.Series) -> pd.Series:
    """most_common of two columns; null if either text is."""
    known = (a.notna() & b.notna()).to_numpy()
    if known.all():
        return pd.Series(most_common(a.tolist(), b.tolist()))
    out = pd.Series(pd.NA, range(len(a)), "Int64")
    out[known] = most_common(a[known].tolist(), b[known].tolist())
    return out


def blanks(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" ")))


def highest_ratio(common: Column, a: Column, b: Column) -> Column:
    """Bound of the indel ratio of two texts of lengths a and b."""
    return _share(F.least(common, a, b), a + b)


def highest_partial(common: Column, a: Column, b: Column) -> Column:
    """Bound of the best window: one that holds all common characters and no other."""
    short = F.least(a, b)
    return F.when((a == 0) & (b == 0), F.lit(100.0)).when(short == 0, F.lit(0.0)).otherwise(
        F.lit(200.0) * F.least(common, short) / (short + F.least(common, short)))


def word_set_bound(common: Column, n: Column, na: Column, nb: Column) -> Column:
    """The ratio by word sets if the words that one side has alone shared so many characters in order.

    n, na and nb are the lengths of the joined words that both have and that one has alone; with
    nothing in common it is the least the ratio can be.
    """
    gap = F.when(n > 0, 1).otherwise(0)
    left, right = n + gap + na, n + gap + nb
    kept = lambda total, dist: F.lit(100.0) * (total - dist) / total
    rest = kept(left + right, na + nb - 2 * F.least(common, na, nb))
    return (F.when((n + na == 0) | (n + nb == 0), F.lit(0.0))
            .when((n > 0) & ((na == 0) | (nb == 0)), F.lit(100.0))
            .when(n > 0, F.greatest(rest, kept(n + left, gap + na), kept(n + right, gap + nb)))
            .otherwise(rest))
