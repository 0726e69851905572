"""Quality classifier: document evidence shrunk by host and path, by empirical Bayes."""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrakin.llm.tables import bounded_sample, text_or_empty
from narrakin.session import settle, ship_package

#: The document classifier is fitted on at most so many labelled documents.
LABELLED_SAMPLE = 20_000
BINS = 10
RIDGE = 1.0
#: Documents whose final probability of good quality is below this are rejected.
THRESHOLD = 0.4
#: Site rates are broadcast up to so many bytes, counted before; larger tables are joined by shuffle.
BROADCAST_BYTES = 8 << 20
_SPACES = frozenset(b" \t\n\r\x0b\x0c")
_MARKS = frozenset(b"#$%&*@^~=+<>{}[]\\_")
FEATURES = (
    "words", "word_length", "letters", "upper", "digits", "marks", "bars", "bangs", "stops", "other",
    "distinct_words", "repeated_words", "distinct_lines", "longest_word",
)


def evidence(text: str) -> list[float] | None:
    """Shape of a text: shares of kinds of characters, and of repeated words and lines."""
    data = text.encode()
    parts = data.split()
    if not parts:
        return None
    tally = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size = float(len(data))
    n = len(parts)
    lines = [x for x in data.split(b"\n") if x]
    share = lambda chars: float(tally[list(chars)].sum()) / size
    upper, lower = float(tally[65:91].sum()), float(tally[97:123].sum())
    return [
        np.log1p(n), size / n, (upper + lower) / size, upper / max(1.0, upper + lower), float(tally[48:58].sum()) / size,
        share(_MARKS), share(b"|"), share(b"!"), share(b".,;:?"), float(tally[128:].sum()) / size,
        len(set(parts)) / n, sum(map(operator.eq, parts, parts[1:])) / n, len(set(lines)) / max(1, len(lines)),
        float(np.log1p(max(map(len, parts)))),
    ]


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def evidence_column(texts: pa.Array) -> pa.Array:
    return pa.array([evidence(t.as_py()) for t in texts], pa.list_(pa.float64()))


@dataclass(frozen=True)
class QualityModel:
    """Logistic regression over binned evidence."""

    cuts: np.ndarray
    weights: np.ndarray

    def design(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), 1 + x.shape[1] * (BINS + 1)))
        out[:, 0] = 1
        for j in range(x.shape[1]):
            out[np.arange(len(x)), 1 + j * (BINS + 1) + np.searchsorted(self.cuts[j], x[:, j], "right")] = 1
        return out

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.design(x) @ self.weights


def fit_classifier(x: np.ndarray, y: np.ndarray) -> QualityModel:
    """Ridge logistic regression by Newton steps; bins are cut at quantiles of either class."""
    if not len(x):
        return QualityModel(np.zeros((len(FEATURES), BINS)), np.zeros(1 + len(FEATURES) * (BINS + 1)))
    steps = np.linspace(0, 1, BINS // 2 + 2)[1:-1]
    halves = [x[y == side] if (y == side).any() else x for side in (0, 1)]
    cuts = np.sort(np.concatenate([np.quantile(h, steps, axis=0) for h in halves]), axis=0).T
    model = QualityModel(cuts, np.zeros(1 + x.shape[1] * (cuts.shape[1] + 1)))
    a = model.design(x)
    ridge = np.full(a.shape[1], RIDGE)
    ridge[0] = 1e-6
    w = model.weights
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p) + 1e-9)[:, None]) + np.diag(ridge), a.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return QualityModel(cuts, w)


def train(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_SAMPLE) -> QualityModel:
    """Fit on at most `rows` labelled documents, chosen by hash; labels repeated for an id are averaged."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    known = bounded_sample(known, F.col("doc_id"), rows)
    picked = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(known), "doc_id")
    seen = picked.select(F.xxhash64("text", "doc_id").alias("h"), evidence_column("text").alias("x"), "quality").where("x IS NOT NULL")
    got = seen.orderBy("h").limit(rows).toArrow()
    x = np.array(got.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    return fit_classifier(x, (np.array(got.column("quality").to_pylist(), float) >= 0.5).astype(float))


def classifier(spark: SparkSession, model: QualityModel):
    """A column function text -> log-odds of good quality, null for a text without words."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def log_odds(texts: pa.Array) -> pa.Array:
        shapes = [evidence(t.as_py()) for t in texts]
        some = [i for i, s in enumerate(shapes) if s is not None]
        out: list[float | None] = [None] * len(shapes)
        if some:
            for i, z in zip(some, shared.value.logit(np.array([shapes[i] for i in some])).tolist()):
                out[i] = min(12.0, max(-12.0, z))
        return pa.array(out, pa.float64())

    return log_odds


def host_and_path(source: Column, section: Column) -> tuple[Column, Column]:
    """Host: the source up to its first slash; path: the rest of the source, then the section."""
    source = F.coalesce(source, F.lit(""))
    host = F.substring_index(source, "/", 1)
    rest = F.expr("substring(coalesce(source, ''), length(substring_index(coalesce(source, ''), '/', 1)) + 1)")
    return host, F.concat(rest, F.lit("/"), F.coalesce(section, F.lit("")))


def _odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def site_rates(sites: DataFrame) -> DataFrame:
    """Posterior rates of every host and path from its documents' probabilities.

    sites: host, path, n, s (sum of probabilities). Hosts are shrunk towards the rate of all
    documents, paths towards their host. The weight of a prior, in documents, follows from how much
    the rates below it vary beyond what their sizes explain; it is one number for hosts and one for
    paths, from grouped sums over all documents. Sums and prior weights come with the rates, so that
    a document can take itself out of them.
    """
    hosts = sites.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    whole = hosts.agg(F.sum("host_n"), F.sum("host_s")).first()
    rate = min(max((whole[1] or 0) / (whole[0] or 1), 1e-3), 1 - 1e-3)
    host_prior = _prior_weight(hosts.select(F.col("host_n").alias("n"), F.col("host_s").alias("s"), F.lit(rate).alias("m")))
    hosts = hosts.withColumn("host_rate", (F.col("host_s") + host_prior * rate) / (F.col("host_n") + host_prior))
    both = settle(sites.join(hosts, "host"), "sites")
    path_prior = _prior_weight(both.select("n", "s", F.col("host_rate").alias("m")))
    path_rate = (F.col("s") + path_prior * F.col("host_rate")) / (F.col("n") + path_prior)
    return both.select("host", "path", "host_rate", path_rate.alias("path_rate"), F.lit(rate).alias("rate"), "n", "s", "host_n", "host_s",
                       F.lit(host_prior).alias("host_prior"), F.lit(path_prior).alias("path_prior"))


def rate_of_others(p: Column) -> Column:
    """The rate of a document's path without the document, whose probability is p, itself."""
    host = (F.col("host_s") - p + F.col("host_prior") * F.col("rate")) / (F.col("host_n") - 1 + F.col("host_prior"))
    path = (F.col("s") - p + F.col("path_prior") * host) / (F.col("n") - 1 + F.col("path_prior"))
    return F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), path))


def _prior_weight(groups: DataFrame) -> float:
    """Beta prior weight by moments: between-group variance of rates beyond binomial noise."""
    got = groups.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col("m"), 2)).alias("q"),
                     F.sum(F.col("m") * (1 - F.col("m"))).alias("noise"), F.count("*").alias("k"),
                     F.sum(F.col("n") * F.col("m") * (1 - F.col("m"))).alias("v")).first()
    if not got["n"]:
        return 1.0
    spread = (got["q"] - got["noise"]) / got["n"]
    return float(min(max(got["v"] / got["n"] / spread - 1, 1.0), 10_000.0)) if spread > 0 else 10_000.0


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row of docs with its quality: struct columns _row (the input) and _q.

    _q: host, path, p_text (document alone), host_rate, path_rate, quality (final), keep. The document's
    log-odds are moved by how far the rate of the other documents of its path, shrunk to that of
    the others of its host, differs from that of all documents, so its own evidence counts once. A
    text without words, null or empty, has quality 0. Null source or lang counts as the empty name.
    """
    ship_package(spark)
    log_odds = classifier(spark, train(docs, labels))
    host, path = host_and_path(F.col("source"), F.col("lang"))
    rows = docs.select(F.struct("*").alias("_row"), host.alias("host"), path.alias("path"), log_odds(text_or_empty()).alias("z"))
    p_text = F.coalesce(1 / (1 + F.exp(-F.col("z"))), F.lit(0.0))
    sites = settle(rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(p_text).alias("s")), "sites")
    rates = settle(site_rates(sites), "site-rates")
    size = rates.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 112)).first()[0] or 0
    rates = F.broadcast(rates) if size <= BROADCAST_BYTES else rates
    final = F.when(F.col("z").isNull(), 0.0).otherwise(
        1 / (1 + F.exp(-(F.col("z") + _odds(rate_of_others(p_text)) - _odds(F.col("rate"))))))
    joined = rows.join(rates, ["host", "path"]).withColumn("quality", final)
    q = F.struct("host", "path", p_text.alias("p_text"), "host_rate", "path_rate", "quality", (F.col("quality") >= THRESHOLD).alias("keep"))
    return joined.select("_row", q.alias("_q"))


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the classifier does not reject, with all their columns."""
    return score(spark, docs, labels).where("_q.keep").select("_row.*")
