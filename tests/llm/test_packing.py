import random
from collections import defaultdict

import public_tokenizers
from frames import first_of_linked, no_docs, odd_docs

import __spark_entry__
import corpus_pipeline
from narrakin.llm import langid, packing, quality, wordpiece
from narrakin.llm.tables import table

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
CAPS = (64, 128, 256)


def check_bins(rows, capacities):
    bins = defaultdict(list)
    for r in rows:
        bins[r["shard"], r["bin"]].append(r)
    for members in bins.values():
        used = sum(r["piece_tokens"] for r in members)
        assert {r["bin_length"] for r in members} == {next(c for c in sorted(capacities) if c >= used)}
        at = 0
        for r in sorted(members, key=lambda r: r["bin_offset"]):
            assert r["bin_offset"] == at
            at += r["piece_tokens"]
    return bins


def test_bins_are_filled_and_shrunk():
    random_ = random.Random(4)
    for _ in range(50):
        sizes = [random_.randint(1, 256) for _ in range(random_.randint(0, 80))]
        bins = packing.best_fill(sizes, CAPS)
        assert sorted(i for _, items in bins for i in items) == list(range(len(sizes)))
        for length, items in bins:
            used = sum(sizes[i] for i in items)
            assert length == next(c for c in CAPS if c >= used)
        cost = lambda found: sum(c + packing.BIN_COST for c, _ in found)
        assert cost(bins) <= min(cost(packing.fill(sizes, CAPS, c)) for c in CAPS)


def test_best_fit_takes_the_tightest_bin():
    assert packing.fill([60, 50, 30, 14], (64,), 64) == [(64, [0]), (64, [1, 3]), (64, [2])]


def test_every_token_is_placed_once(spark):
    docs = table(spark, SF, "documents")
    counts = {r["doc_id"]: r["n_tokens"] + 1 for r in wordpiece.token_counts(spark, docs, MODEL).collect()}
    for shard_tokens in (packing.SHARD_TOKENS, 20_000):
        rows = packing.pack(spark, docs, MODEL, shard_tokens=shard_tokens).collect()
        check_bins(rows, packing.CAPACITIES)
        placed = defaultdict(int)
        for r in rows:
            placed[r["doc_id"]] += r["piece_tokens"]
        assert dict(placed) == counts


def test_odd_rows(spark):
    docs = odd_docs(spark)
    for shard_tokens in (packing.SHARD_TOKENS, 500):
        rows = packing.pack(spark, docs, MODEL, CAPS, shard_tokens=shard_tokens).collect()
        check_bins(rows, CAPS)
        assert sum(r["piece"] == 0 for r in rows) == docs.count()
        assert [r["piece_tokens"] for r in rows if r["doc_id"] == 2] == [1]
    assert packing.pack(spark, no_docs(spark), MODEL).count() == 0


def test_pipeline_equals_its_stages_done_plainly(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    good = {r["doc_id"] for r in quality.score(spark, docs, labels).select("_row.doc_id", "_q.keep").collect() if r["keep"]}
    first = docs.where(docs.doc_id.isin(sorted(good)))
    known = {r["doc_id"] for r in langid.identify(spark, first).collect() if r["lang_pred"] != "und" and r["score"] >= 0.5}
    second = docs.where(docs.doc_id.isin(sorted(known)))
    single = first_of_linked(second.select("doc_id", "text").collect())
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == single
    check_bins(rows, packing.CAPACITIES)


def test_stages_keep_the_columns(spark):
    docs = odd_docs(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == odd_docs(spark).columns
    assert docs.count() >= 1


def test_queries_are_registered():
    names = __spark_entry__.queries()
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in names)] == []
    assert "pipeline" in names and "op8_urls" in __spark_entry__.oracle_sql()
