import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from frames import no_docs, odd_docs
from pyspark.sql import functions as F

from narrakin.llm import pieces, wordpiece
from narrakin.llm.tables import table

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def coder():
    with open(MODEL, "rb") as file:
        return pieces.PieceCoder(file.read())


def test_random_texts_and_ids_as_the_library(coder, library):
    random_ = random.Random(1)
    parts = ["a", "e", "th", "in", "The", " ", "  ", "\n", ".", "é", "日", "語", "𝔘", "ß", "0", "12", "▁", "<", ">", "s", "ing", "er", "!", "\t", "о", "ка", "̂", "​"]
    for _ in range(3000):
        text = "".join(random_.choice(parts) for _ in range(random_.randint(0, 25)))
        assert coder.encode(text) == library.encode(text)
        ids = [random_.randrange(32000) if random_.random() < 0.6 else random_.randrange(259) for _ in range(random_.randint(0, 12))]
        if 0 not in ids:
            assert coder.decode(ids) == library.decode(ids)


def test_runs_of_spaces(coder, library):
    for n in range(60):
        for word in ("", "word", "é𝔘", "\n"):
            assert coder.encode(" " * n + word) == library.encode(" " * n + word)


def test_documents_as_the_library(spark, library):
    docs = table(spark, SF, "documents")
    got = {r["doc_id"]: r for r in pieces.encoded_digests(spark, docs, MODEL).collect()}
    for row in docs.collect():
        ids = library.encode(row["text"] or "", add_eos=True)
        one = got[row["doc_id"]]
        assert one["n_tokens"] == len(ids)
        assert one["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert one["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_odd_rows_and_columns(spark, library):
    docs = odd_docs(spark)
    got = pieces.encoded_digests(spark, docs, MODEL).collect()
    assert len(got) == docs.count()
    assert {r["n_tokens"] for r in got if r["doc_id"] in (2, 3)} == {1}
    assert pieces.encoded_digests(spark, no_docs(spark), MODEL).count() == 0
    encode, decode = pieces.encode_column(spark, MODEL), pieces.decode_column(spark, MODEL)
    back = docs.select("text", decode(encode(F.coalesce("text", F.lit("")))).alias("again")).collect()
    assert all((r["text"] or "") == r["again"] for r in back)


def plain_count(starts, inner, word):
    at, n = 0, 0
    while at < len(word):
        pool = starts if at == 0 else inner
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pool), None)
        if end is None:
            return 1
        at, n = end, n + 1
    return n


def test_automaton_counts_greedy_pieces():
    random_ = random.Random(3)
    for _ in range(300):
        pool = ["".join(random_.choice("abc") for _ in range(random_.randint(1, 4))) for _ in range(12)]
        starts, inner = set(pool[:6]), set(pool[6:])
        automaton = wordpiece.Automaton(list(starts), list(inner))
        for _ in range(40):
            word = "".join(random_.choice("abcd" if random_.random() < 0.2 else "abc") for _ in range(random_.randint(1, 12)))
            assert automaton.count(word) == plain_count(starts, inner, word)


def test_token_counts_of_documents(spark):
    with open(MODEL, "rb") as file:
        starts, inner = map(set, wordpiece.vocabulary(file.read()))
    docs = table(spark, SF, "documents").limit(60)
    got = {r["doc_id"]: r for r in wordpiece.token_counts(spark, docs, MODEL).collect()}
    for row in docs.collect():
        words = (row["text"] or "").split()
        assert got[row["doc_id"]]["n_words"] == len(words)
        assert got[row["doc_id"]]["n_tokens"] == sum(plain_count(starts, inner, w) for w in words)


def test_token_counts_of_odd_rows(spark):
    got = wordpiece.token_counts(spark, odd_docs(spark), MODEL).collect()
    assert len(got) == 12 and all(r["n_tokens"] == 0 for r in got if r["doc_id"] in (2, 3, 4))
    assert wordpiece.token_counts(spark, no_docs(spark), MODEL).count() == 0
