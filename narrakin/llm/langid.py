"""Language shares of each document, by expectation-maximisation over its tokens."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrakin.session import ship_package

#: Slots for hashed n-grams of bytes.
SLOTS = 1 << 16
GRAMS = (1, 2, 3, 4)
#: The model is fitted on about so many labelled documents of each language, chosen by hash.
SAMPLE_PER_LANGUAGE = 2000
MAX_LANGUAGES = 500
ROUNDS = 10
UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
#: Longest token taken as one; longer ones, as in scripts without spaces, are cut.
_TOKEN = 48
#: Tokens whose likelihoods a task remembers.
_MEMORY = 200_000
#: Tokens of the documents that are worked on together.
_STEP = 100_000


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    #: Log-likelihood of each n-gram slot in each language.
    weights: np.ndarray


def tokens(text: str) -> list[str]:
    """What white space parts; tokens of over 48 characters are cut into pieces of 48."""
    found = text.split()
    if max(map(len, found), default=0) > _TOKEN:
        return [t[i:i + _TOKEN] for t in found for i in range(0, len(t), _TOKEN)]
    return found


def letters(token: str) -> str:
    """The lower-cased runs of letters of a token, joined by spaces."""
    token = token.lower()
    if token.isalpha():
        return token
    runs = [r if r.isalpha() else "".join(filter(str.isalpha, r)) for r in _LETTERS.findall(token)]
    return " ".join(filter(None, runs))


def gram_slots(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all n-grams of bytes of the words, each padded by spaces, and the word of each."""
    data = np.frombuffer((" " + "  ".join(words) + " ").encode(), np.uint8).astype(np.uint64)
    sizes = np.fromiter((len(w.encode()) + 2 for w in words), np.int64, len(words))
    word = np.repeat(np.arange(len(words)), sizes)
    slots, owners = [], []
    code = np.zeros(len(data), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        code = code[: len(data) - n + 1] * np.uint64(257) + data[n - 1:] + np.uint64(1)
        if n in GRAMS:
            inside = word[: len(code)] == word[n - 1:]
            mixed = code[inside] * np.uint64(0x9E3779B97F4A7C15)
            slots.append((mixed >> np.uint64(48)).astype(np.int64) % SLOTS)
            owners.append(word[: len(code)][inside])
    return np.concatenate(slots), np.concatenate(owners)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-gram counts (lang, slot, n) of the task's documents; at most SLOTS rows per language."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        seen: dict[str, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            seen.setdefault(lang, Counter()).update(tokens(text.as_py() or ""))
        for lang, found in seen.items():
            total = counts.setdefault(lang, np.zeros(SLOTS))
            some = [(w, n) for w, n in ((letters(t), n) for t, n in found.items()) if w]
            if some:
                slots, owner = gram_slots([w for w, _ in some])
                total += np.bincount(slots, np.array([n for _, n in some], float)[owner], SLOTS)
    for lang, total in counts.items():
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int64()), pa.array(total[used].astype(np.int64))],
            names=["lang", "slot", "n"])


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel:
    """n-gram likelihoods of every language of docs (doc_id, text, lang), rows without lang left out.

    Counted on Spark over about `per_language` documents of each language, chosen by the hash of
    doc_id; languages are counted over all rows. Only the slot table reaches the driver: SLOTS rows
    per language, and more than MAX_LANGUAGES languages are refused.
    """
    labelled = docs.select("doc_id", "text", "lang").where("lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = tuple(sorted(sizes))
    if not languages:
        return LanguageModel((), np.zeros((SLOTS, 0)))
    limits = F.create_map(*[F.lit(x) for lang in languages for x in (lang, int(min(1.0, per_language / sizes[lang]) * 1_000_000) + 1)])
    chosen = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000)) < limits[F.col("lang")])
    counted = chosen.select("lang", "text").mapInArrow(_count, "lang string, slot long, n long")
    rows = counted.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    table = np.full((SLOTS, len(languages)), 0.5)
    place = {lang: i for i, lang in enumerate(languages)}
    columns = np.array([place[x] for x in rows.column("lang").to_pylist()], np.int64)
    table[rows.column("slot").to_numpy(), columns] += rows.column("n").to_numpy()
    return LanguageModel(languages, np.log(table / table.sum(0)))


def shares(likelihood: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Mixture shares of the languages in one document, and its log-likelihood.

    likelihood: tokens x languages; counts: how often each token stands in the document.
    """
    total = counts.sum()
    pi = np.full(likelihood.shape[1], 1 / likelihood.shape[1])
    for _ in range(ROUNDS):
        old = pi
        pi = np.maximum(pi * ((counts / (likelihood @ pi)) @ likelihood) / total, 1e-9)
        if np.abs(pi - old).max() < 1e-4:
            break
    return pi / pi.sum(), float(counts @ np.log(likelihood @ pi))


def highest(likelihood: np.ndarray, counts: np.ndarray, pi: np.ndarray) -> float:
    """No shares have a higher log-likelihood: that of the shares pi and what is left by its slope, as it is concave."""
    mixed = likelihood @ pi
    return float(counts @ np.log(mixed) + ((counts / mixed) @ likelihood).max() - counts.sum())


def choose(likelihood: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
    """The shares over the document's language set, and the size of the set.

    Languages are ranked by their shares over all of them; of the sets of the first one, two, three
    ..., the one with the highest likelihood less the Bayesian penalty for its size is taken. The
    highest likelihood over all languages bounds that of every set, so larger sets are tried only
    while that bound less their penalty beats the best set.
    """
    pi, _ = shares(likelihood, counts)
    bound = highest(likelihood, counts, pi)
    rank = np.argsort(-pi, kind="stable")
    best = float(counts @ np.log(likelihood[:, rank[0]]))
    best_pi, best_size = np.zeros(len(pi)), 1
    best_pi[rank[0]] = 1
    penalty = np.log(counts.sum() + 1)
    for size in range(2, len(pi) + 1):
        if bound - (size - 1) * penalty <= best:
            break
        part, fitted = shares(np.ascontiguousarray(likelihood[:, rank[:size]]), counts)
        if fitted - (size - 1) * penalty > best:
            best, best_size = fitted - (size - 1) * penalty, size
            best_pi = np.zeros(len(pi))
            best_pi[rank[:size]] = part
    return best_pi, best_size


class _Places(dict):
    """A place for every token; new tokens are numbered and noted as they come."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, token: str) -> int:
        self.fresh.append(token)
        place = self[token] = len(self)
        return place


class Predictor:
    """Predicts whole Arrow columns of texts; remembers the likelihoods of tokens."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.places = _Places()
        #: By place: likelihoods scaled to 1 at the likeliest language, and whether there are letters.
        self.rows, self.spelt = np.empty((0, len(self.model.languages))), np.empty(0, bool)

    def _learn(self) -> None:
        words = [letters(t) for t in self.places.fresh]
        self.places.fresh = []
        n = len(words)
        slots, owner = gram_slots(words)
        grams = np.bincount(owner, minlength=n)
        size = np.fromiter(map(len, words), float, n) + 1
        logs = np.stack([np.bincount(owner, self.model.weights[slots, j], n) for j in range(len(self.model.languages))], 1)
        logs *= (size / grams)[:, None]
        self.rows = np.concatenate([self.rows, np.maximum(np.exp(logs - logs.max(1, keepdims=True)), 1e-12)])
        self.spelt = np.concatenate([self.spelt, size > 1])

    def __call__(self, texts: pa.Array) -> tuple[list[str], list[float], list[int]]:
        """Language, score and the number of languages in the set, for each text."""
        out = ([UNKNOWN] * len(texts), [0.0] * len(texts), [0] * len(texts))
        if self.model.languages:
            held, size = [], 0
            for i, text in enumerate(texts):
                found = Counter(tokens(text.as_py() or ""))
                n = len(found)
                held.append((i, np.fromiter(map(self.places.__getitem__, found), np.int64, n), np.fromiter(found.values(), np.float64, n)))
                size += n
                if size > _STEP:
                    self._solve(held, out)
                    held, size = [], 0
            self._solve(held, out)
        return out

    def _solve(self, held: list[tuple[int, np.ndarray, np.ndarray]], out: tuple[list, list, list]) -> None:
        if self.places.fresh:
            self._learn()
        for i, spot, counts in held:
            used = self.spelt[spot]
            if used.any():
                spot, counts = spot[used], counts[used]
                pi, size = choose(self.rows[spot], counts)
                top, total = int(pi.argmax()), counts.sum()
                out[0][i], out[2][i] = self.model.languages[top], size
                out[1][i] = float(min(1.0, (pi[top] * total + 1 / len(pi)) / (total + 1)))
        if len(self.places) > _MEMORY:
            self._forget()


def predictor(spark: SparkSession, model: LanguageModel):
    """A column function text -> struct(lang_pred, score, n_langs); the model is broadcast once."""
    shared = spark.sparkContext.broadcast(model)
    held: list[Predictor] = []

    @F.arrow_udf("lang_pred string, score double, n_langs long")
    def predict(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(Predictor(shared.value))
        langs, scores, sizes = held[0](texts)
        return pa.StructArray.from_arrays(
            [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(sizes, pa.int64())], names=["lang_pred", "score", "n_langs"])

    return predict


def held_out():
    """Documents that the model never learns from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2


def identify(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_langs of every row of docs (doc_id, text, lang).

    Learns from rows with lang whose crc32(doc_id) mod 4 is not 2; a null doc_id is not learnt from
    and counts as held out. A text that is null or has no letter is `und` with score 0; so is every
    text if nothing can be learnt. score is the share of lang_pred in the mixture, drawn a little
    towards even shares by one pseudo-word. Ties go to the first language in order of name. Columns
    beyond the three are ignored.
    """
    ship_package(spark)
    held = F.coalesce(held_out(), F.lit(True))
    predict = predictor(spark, fit(docs.where(~held)))
    return docs.select("doc_id", held.alias("held_out"), predict(F.coalesce("text", F.lit(""))).alias("p")).select("doc_id", "held_out", "p.*")


def keep_identified(spark: SparkSession, docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Rows of docs, with all their columns, in one of the known languages by at least half."""
    ship_package(spark)
    predict = predictor(spark, fit(docs.where(~F.coalesce(held_out(), F.lit(True)))))
    marked = docs.select(F.struct("*").alias("_row"), predict(F.coalesce("text", F.lit(""))).alias("_p"))
    return marked.where((F.col("_p.lang_pred") != UNKNOWN) & (F.col("_p.score") >= least)).select("_row.*")
