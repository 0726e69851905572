import re
import zlib

import numpy as np
import pyarrow as pa
from frames import DOCS, no_docs, odd_docs

from narrakin.llm import brown, queries


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def plain_counts(rows):
    """Tokens by word, the end being None, of the rows that are learnt from."""
    counts = {}
    for doc_id, text in rows:
        if not is_held_out(doc_id):
            for w in [*words(text), None]:
                counts[w] = counts.get(w, 0) + 1
    return counts


def plain_base(rows):
    counts = plain_counts(rows)
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc_id, text in rows:
        seen = [counts.get(w, 0) for w in [*words(text), None]]
        out.append((doc_id, is_held_out(doc_id), len(seen), sum(c > 0 for c in seen), n, sum(np.log10((c + 1) / (n + v + 1)) for c in seen)))
    return out


def plain_score(model, counts, text):
    """The class model's log10 probability of a text, word by word from its tables."""
    vocabulary, total, before = model.vocabulary, 0.0, int(model.classes[-1])
    for w in [*words(text), None]:
        if w is None:
            t, inner = vocabulary.end, 0.0
        else:
            t = int(vocabulary.look_up(pa.array([w]))[0][0])
            n = counts.get(w, 0)
            inner = 0.0 if t < vocabulary.own else (np.log10(n) if n else model.log_unseen[t]) - model.log_total[t]
        total += model.transitions[before, model.classes[t]] + model.emissions[t] + inner
        before = int(model.classes[t])
    return total


def grammar(n, seed):
    """Texts in which word groups follow each other in turn, so that classes tell what comes next."""
    random = np.random.default_rng(seed)
    groups = [[f"{g}{i}x" for i in range(12)] for g in ("det", "adj", "noun", "verb")]
    return [(i, " ".join(str(random.choice(groups[p % 4])) for p in range(int(random.integers(4, 30))))) for i in range(n)]


def test_scores_equal_the_plain_model(spark):
    rows = grammar(60, 1) + [(100, "Det1x noun2x unknownword another\tDET1X\x0b\x0cadj2x \x1cadj2x É é"), (101, None), (102, "verb3x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = plain_counts(rows)
    for shares in ({"known_share": 0.0, "type_share": 0.0}, {"known_share": 0.02, "type_share": 0.03}, {"known_share": 2.0, "type_share": 3.0}):
        model, counted = brown.fit(spark, docs.where(~brown.held_out()), classes=6, endings=7, **shares)
        got = brown.score(spark, docs, model, counted).select("_row.doc_id", "n_tokens", "n_known", "base_score", "score").collect()
        base = {r[0]: r for r in plain_base(rows)}
        for r in got:
            text = dict(rows)[r["doc_id"]]
            assert (r["n_tokens"], r["n_known"]) == base[r["doc_id"]][2:4]
            assert abs(r["base_score"] - base[r["doc_id"]][5]) < 1e-9 * r["n_tokens"]
            assert abs(r["score"] - plain_score(model, counts, text)) < 1e-9 * r["n_tokens"]


def test_probabilities_of_all_that_can_come_add_up_to_one(spark):
    rows = grammar(40, 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model, _ = brown.fit(spark, docs.where(~brown.held_out()), classes=5, endings=6, type_share=0.03)
    counts, v = plain_counts(rows), model.vocabulary
    total_inside = np.zeros(v.end + 1)
    for w, n in counts.items():
        t = v.end if w is None else int(v.look_up(pa.array([w]))[0][0])
        total_inside[t] += 1.0 if t < v.own or t == v.end else 10.0 ** (np.log10(n) - model.log_total[t])
    total_inside[v.own:v.end] += 10.0 ** (model.log_unseen - model.log_total)[v.own:v.end]
    assert np.allclose(total_inside, 1.0)
    assert np.allclose(np.bincount(model.classes, 10.0 ** model.emissions), 1.0)
    assert np.allclose((10.0 ** model.transitions).sum(1), 1.0)


def test_gains_equal_the_likelihood_worked_out_anew():
    random = np.random.default_rng(3)
    types, classes = 15, 4
    pairs = random.integers(0, 6, (types, types)).astype(float)
    of = random.integers(0, classes, types)

    def table(assignment):
        out = np.zeros((classes, classes))
        np.add.at(out, (assignment[:, None].repeat(types, 1), assignment[None].repeat(types, 0)), pairs)
        return out

    for t in range(types):
        others = np.arange(types) != t
        before, after = np.bincount(of[others], pairs[others, t], classes), np.bincount(of[others], pairs[t, others], classes)
        tried = [brown.likelihood(table(np.where(others, of, c))) for c in range(classes)]
        without = table(of)
        without[:, of[t]] -= before
        without[of[t]] -= after
        without[of[t], of[t]] -= pairs[t, t]
        gains = brown.insertion_gains(without, before, after, pairs[t, t])
        assert np.allclose(gains - gains[0], np.array(tried) - tried[0])
        chosen = brown.best_class(table(of), int(of[t]), before, after, pairs[t, t], classes)
        assert np.isclose(tried[chosen], max(tried))


def test_exchange_raises_the_likelihood_and_keeps_groups_apart(spark):
    rows = grammar(400, 4)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    courses = []
    plain_exchange = brown.exchange

    def watched(*arguments):
        found = plain_exchange(*arguments)
        courses.append(found[2])
        return found

    brown.exchange = watched
    try:
        model, _ = brown.fit(spark, docs.where(~brown.held_out()), classes=8)
    finally:
        brown.exchange = plain_exchange
    assert courses[0][-1] > courses[0][0] and all(b >= a for a, b in zip(courses[0], courses[0][1:]))
    groups = {}
    for word, of in zip(model.vocabulary.words.to_pylist(), model.classes):
        groups.setdefault(int(of), set()).add(word[:3])
    assert all(len(g) == 1 for g in groups.values())


def test_held_out_texts_score_better_than_by_single_words(spark):
    rows = grammar(600, 5)
    got = brown.class_scores(spark, spark.createDataFrame(rows, "doc_id long, text string"), classes=8).where("held_out").collect()
    assert len(got) > 50
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got) + 0.3 * sum(r["n_tokens"] for r in got)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = brown.class_scores(spark, docs, classes=3).collect()
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    want = plain_base(rows)
    assert sorted((tuple(r[c] for c in names) for r in got), key=str) == sorted((w[:5] for w in want), key=str)
    assert np.allclose(sorted(r["base_score"] for r in got), sorted(w[5] for w in want))
    assert all(np.isfinite(r["score"]) and r["score"] <= 0 for r in got)
    assert brown.class_scores(spark, no_docs(spark)).count() == 0


def test_nothing_to_learn_from(spark):
    only = next(i for i in range(100) if is_held_out(i))
    got = brown.class_scores(spark, spark.createDataFrame([(only, "some words", None, None, 10)], DOCS)).collect()[0]
    assert (got["held_out"], got["n_tokens"], got["n_known"], got["train_tokens"], got["base_score"]) == (True, 3, 0, 0, 0.0)
    assert np.isfinite(got["score"])


def test_query_on_the_given_table(spark):
    got = queries.op12_class_scores(spark, "/root/testdata/sf0.001").collect()
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = {r[0]: r for r in plain_base(rows)}
    assert len(got) == len(rows)
    for r in got:
        w = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == w[1:5]
        assert abs(r["base_score"] - w[5]) < 1e-9 * r["n_tokens"]
    kept = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in kept) > sum(r["base_score"] for r in kept)
