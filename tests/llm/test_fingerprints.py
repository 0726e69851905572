import hashlib
import re

from frames import no_docs, odd_docs

from narrakin.llm import fingerprints
from narrakin.llm.tables import table

SF = "/root/testdata/sf0.001"
CHUNKS = re.compile(r"[^\n]{1,96}[^\n.!?]{0,96}[\n.!?]*|\n+")


def parts(text):
    return {p.strip(" ") for p in CHUNKS.findall(text)}


def alike(a, b):
    a, b = parts(a), parts(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_documents_against_plain_sets(spark):
    docs = table(spark, SF, "documents")
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: -r["doc_id"])
    got = {r["doc_id"]: r for r in fingerprints.fingerprints(spark, docs, piece_rows=20).collect()}
    assert len(got) == len(rows)
    for i, row in enumerate(rows):
        text, following = row["text"] or "", rows[(i + 1) % len(rows)]["text"] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        one = got[row["doc_id"]]
        assert one["n_chars"] == len(text)
        assert one["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(one["near_edited"] - alike(text, edited)) < 1e-9
        assert abs(one["near_next"] - alike(text, following)) < 1e-9
    by_text = {}
    for row in rows:
        by_text.setdefault(row["text"], set()).add(got[row["doc_id"]]["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())


def test_small_differences_are_peeled_from_the_first_sketch_and_large_ones_later(spark):
    sets = [
        (1, 0, list(range(1000, 1012)), list(range(1000, 1012))),
        (1, 1, list(range(1000, 1012)), list(range(1001, 1013))),
        (2, 0, list(range(5000)), list(range(2500, 7500))),
        (2, 1, [], list(range(3000))),
        (3, 0, [], []),
        (3, 1, [1], []),
    ]
    rows = [(i, [(s, _spread(a), _spread(b)) for j, s, a, b in sets if j == i]) for i in (1, 2, 3)]
    frame = spark.createDataFrame(rows, "id long, pairs array<struct<side: int, left: array<bigint>, right: array<bigint>>>")
    got = {(r["id"], r["side"]): r["n"] for r in fingerprints.differences(frame).collect() if r["n"]}
    assert got == {(1, 1): 2, (2, 0): 5000, (2, 1): 3000, (3, 1): 1}


def _spread(numbers):
    return [int.from_bytes(hashlib.sha256(str(n).encode()).digest()[:8], "big", signed=True) for n in numbers]


def test_odd_rows(spark):
    docs = odd_docs(spark)
    got = fingerprints.fingerprints(spark, docs, piece_rows=2).collect()
    assert len(got) == docs.count()
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert len({r["fingerprint"] for r in got if r["doc_id"] == 8} | {r["fingerprint"] for r in got if r["doc_id"] == 1}) == 2
    assert fingerprints.fingerprints(spark, no_docs(spark)).count() == 0
    one = fingerprints.fingerprints(spark, docs.where("doc_id = 6")).collect()[0]
    assert one["near_next"] == 1.0
