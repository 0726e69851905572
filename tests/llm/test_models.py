import numpy as np
from frames import no_docs, odd_docs
from pyspark.sql import functions as F

from narrakin.llm import langid, quality
from narrakin.llm.tables import table

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    docs = table(spark, SF, "documents")
    got = langid.identify(spark, docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert len(got) > 100
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_labels_of_held_out_rows_are_not_learnt(spark):
    docs = table(spark, SF, "documents")
    spoilt = docs.withColumn("lang", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, "xx").otherwise(F.col("lang")))
    a = {r["doc_id"]: r["lang_pred"] for r in langid.identify(spark, docs).collect()}
    b = {r["doc_id"]: r["lang_pred"] for r in langid.identify(spark, spoilt).collect()}
    assert a == b


def test_mixture_of_two_languages():
    likelihood = np.array([[1.0, 0.01, 0.01]] * 30 + [[0.01, 1.0, 0.01]] * 70)
    pi, size = langid.choose(likelihood, np.ones(100))
    assert size == 2 and abs(pi[0] - 0.3) < 0.02 and abs(pi[1] - 0.7) < 0.02 and pi[2] == 0
    pi, size = langid.choose(likelihood[:30], np.ones(30))
    assert size == 1 and pi[0] == 1


def test_mixtures_of_four_and_more_languages():
    for known, mixed in ((4, 4), (9, 6)):
        likelihood = np.repeat(np.where(np.eye(known) > 0, 1.0, 0.01)[:mixed], 100, axis=0)
        pi, size = langid.choose(likelihood, np.ones(100 * mixed))
        assert size == mixed and np.allclose(pi[:mixed], 1 / mixed, atol=0.02) and not pi[mixed:].any()


def test_no_shares_pass_the_highest_likelihood():
    random = np.random.default_rng(1)
    for _ in range(20):
        likelihood, counts = random.random((50, 7)) ** 3 + 1e-6, random.integers(1, 5, 50).astype(float)
        top = langid.highest(likelihood, counts, langid.shares(likelihood, counts)[0])
        assert all(counts @ np.log(likelihood @ random.dirichlet(np.full(7, 0.3))) <= top for _ in range(50))
        assert all(langid.shares(likelihood[:, random.permutation(7)[:k]], counts)[1] <= top for k in range(1, 8))


def test_odd_languages(spark):
    docs = odd_docs(spark)
    got = langid.identify(spark, docs).collect()
    assert len(got) == docs.count()
    assert all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in got if r["doc_id"] in (2, 3, 4, 5))
    assert all(r["lang_pred"] != "und" for r in got if r["doc_id"] in (1, 6, 7, 8))
    assert langid.identify(spark, no_docs(spark)).count() == 0
    assert {r["lang_pred"] for r in langid.identify(spark, docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    kept = langid.keep_identified(spark, docs)
    assert kept.columns == docs.columns and kept.where("doc_id IN (2, 3, 4, 5)").count() == 0


def test_quality_follows_the_labels(spark):
    labels = table(spark, SF, "labels")
    got = quality.score(spark, table(spark, SF, "documents"), labels).select("_row.doc_id", "_q.keep").join(labels, "doc_id").collect()
    good, bad = [r["keep"] for r in got if r["quality"] == 1], [r["keep"] for r in got if r["quality"] == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.15


def test_classifier_on_labels_it_has_not_seen(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    odd = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1
    got = quality.score(spark, docs, labels.where(odd)).select("_row.doc_id", "_q.keep").join(labels.where(~odd), "doc_id").collect()
    assert np.mean([r["keep"] == (r["quality"] == 1) for r in got]) >= 0.95


def test_sparse_sites_are_drawn_to_the_rate_above(spark):
    rows = [("big", "/a", 1000, 900.0), ("big", "/b", 2, 0.0), ("small", "/a", 1, 0.0), ("other", "/a", 1000, 300.0), ("other", "/b", 1000, 350.0)]
    got = {(r["host"], r["path"]): r for r in quality.site_rates(spark.createDataFrame(rows, "host string, path string, n long, s double")).collect()}
    assert abs(got["big", "/a"]["path_rate"] - 0.9) < 0.01
    assert got["big", "/b"]["path_rate"] > 0.2
    assert 0.2 < got["small", "/a"]["host_rate"] < got["small", "/a"]["rate"]


def test_odd_quality(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (1, 1, 0), (None, 1, 0), (6, None, 0), (99, 0, 1)], "doc_id long, quality int, toxic int")
    got = quality.score(spark, docs, labels).select("_row.*", "_q.quality").collect()
    assert len(got) == docs.count() and all(0 <= r["quality"] <= 1 for r in got)
    assert all(r["quality"] == 0 for r in got if r["doc_id"] in (2, 3, 4))
    assert quality.keep_good(spark, docs, labels).columns == docs.columns
    assert quality.score(spark, docs, labels.limit(0)).count() == docs.count()
    assert quality.keep_good(spark, no_docs(spark), labels).count() == 0


def plain_prior(n, s, m):
    """Beta prior weight of groups with n members, sums s and expected rates m."""
    q, noise, v = (n * (s / n - m) ** 2).sum(), (m * (1 - m)).sum(), (n * m * (1 - m)).sum()
    spread = (q - noise) / n.sum()
    return min(max(v / n.sum() / spread - 1, 1.0), 10_000.0) if spread > 0 else 10_000.0


def test_quality_equals_a_plain_restatement(spark):
    """Posterior of each document from those of the other documents of its path and host, row by row."""
    docs = table(spark, "/root/testdata/sf0.001", "documents").withColumn(
        "source", F.when(F.col("doc_id") % 41 == 3, F.concat(F.lit("lone"), F.col("doc_id"))).otherwise(F.concat("source", F.lit("/a"), F.col("doc_id") % 3)))
    got = quality.score(spark, docs, table(spark, "/root/testdata/sf0.001", "labels")).select("_row.*", "_q.*").toPandas()
    p = got["p_text"].to_numpy()
    rate = min(max(p.mean(), 1e-3), 1 - 1e-3)
    hosts = got.assign(p=p).groupby("host")["p"].agg(["count", "sum"])
    host_prior = plain_prior(hosts["count"], hosts["sum"], np.full(len(hosts), rate))
    paths = got.assign(p=p).groupby(["host", "path"])["p"].agg(["count", "sum"])
    at_host = hosts.loc[paths.index.get_level_values("host")]
    host_rate = ((at_host["sum"] + host_prior * rate) / (at_host["count"] + host_prior)).to_numpy()
    path_prior = plain_prior(paths["count"].to_numpy(), paths["sum"].to_numpy(), host_rate)
    odds = lambda x: np.log(x / (1 - x))
    for r in got.itertuples():
        host, path = hosts.loc[r.host], paths.loc[(r.host, r.path)]
        others = (host["sum"] - r.p_text + host_prior * rate) / (host["count"] - 1 + host_prior)
        others = (path["sum"] - r.p_text + path_prior * others) / (path["count"] - 1 + path_prior)
        want = 0.0 if r.p_text == 0 else 1 / (1 + np.exp(-(odds(r.p_text) + odds(min(1 - 1e-6, max(1e-6, others))) - odds(rate))))
        assert abs(r.quality - want) < 1e-7 and r.keep == (r.quality >= quality.THRESHOLD)


def test_a_document_alone_on_its_site_has_the_prior_of_all(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").withColumn("source", F.concat(F.lit("only"), F.col("doc_id")))
    got = quality.score(spark, docs, table(spark, "/root/testdata/sf0.001", "labels")).select("_q.*").where("p_text > 0").collect()
    assert max(abs(r["quality"] - r["p_text"]) for r in got) < 1e-7
