"""Plans of lookups and scans on tables that are larger than their estimates or files show."""

from pyspark.sql import functions as F

from narrakin.operators import skew
from narrakin.plans import fixtures


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_table_repeated_per_salt_is_not_broadcast(spark, monkeypatch):
    named = F.when(F.col("id") % 30 < 29, F.concat(F.lit("n"), F.col("id") % 30)).alias("phrase")
    names = spark.range(10, 30).select(named)
    texts = spark.range(90).select(F.col("id").alias("t"), named)
    near = skew.lookup_join(texts, names, ["phrase"], 20, ["t"]).collect()
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    for rows, left in ((20, "inner"), (10**9, "inner"), (20, "left")):
        far = skew.lookup_join(texts, names, ["phrase"], rows, ["t"], left)
        assert "Broadcast" not in plan(far)
        assert sorted(r.t for r in far.collect()) == (sorted(r.t for r in near) if left == "inner" else list(range(90)))


def test_scans_are_spread_by_rows(spark, monkeypatch):
    monkeypatch.setattr("narrakin.session.TASK_ROWS", 20)
    for table in (fixtures.narrations, fixtures.companies):
        df = table(spark, "/root/testdata/sf0.001")
        n, = df.agg(F.count("*")).first()
        assert df.rdd.getNumPartitions() * 20 >= n > 8 * 20 or df.rdd.getNumPartitions() == 8
