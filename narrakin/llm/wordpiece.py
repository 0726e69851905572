"""Token counts by greedy longest match in linear time, without building the pieces."""

from __future__ import annotations

from collections import deque

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrakin.session import ship_package

#: Words whose counts a task remembers.
_MEMORY = 500_000


class Automaton:
    """Trie of a word-piece vocabulary with failure links and counts of popped pieces.

    starts: pieces that may begin a word; inner: pieces that may follow another. Reading a word
    moves through the trie; where it cannot go on, the failure link says how many whole pieces
    greedy longest match has taken by then and which inner prefix is left over. A state without a
    link cannot be completed: the word is unknown and counts as one token.
    """

    def __init__(self, starts: list[str], inner: list[str]):
        self.next: list[dict[str, int]] = [{}, {}]
        self.link, self.popped = [-1, -1], [0, 0]
        ends = {self._add(0, x) for x in starts if x} | {self._add(1, x) for x in inner if x}
        queue = deque([0, 1])
        while queue:
            state = queue.popleft()
            for char, child in self.next[state].items():
                queue.append(child)
                if child in ends:
                    self.link[child], self.popped[child] = 1, 1
                    continue
                back, popped = self.link[state], self.popped[state]
                while back >= 0 and char not in self.next[back]:
                    popped += self.popped[back]
                    back = self.link[back]
                if back >= 0:
                    self.link[child], self.popped[child] = self.next[back][char], popped

    def _add(self, state: int, piece: str) -> int:
        for char in piece:
            if char not in self.next[state]:
                self.next[state][char] = len(self.next)
                self.next.append({})
                self.link.append(-1)
                self.popped.append(0)
            state = self.next[state][char]
        return state

    def count(self, word: str) -> int:
        """Number of greedy pieces of a word; 1 for a word that greedy matching cannot finish."""
        state, taken = 0, 0
        for char in word:
            while char not in self.next[state]:
                if self.link[state] < 0:
                    return 1
                taken += self.popped[state]
                state = self.link[state]
            state = self.next[state][char]
        while state != 1:
            if self.link[state] < 0:
                return 1
            taken += self.popped[state]
            state = self.link[state]
        return taken


def vocabulary(model: bytes, mark: str = "▁") -> tuple[list[str], list[str]]:
    """Word-piece vocabulary of a sentencepiece model: marked pieces start words, others follow."""
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    plain = [sp.id_to_piece(i) for i in range(sp.vocab_size())
             if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    starts = [p[1:] for p in plain if p.startswith(mark) and len(p) > 1 and mark not in p[1:]]
    return starts, [p for p in plain if mark not in p]


class Counts:
    """Counts of whole texts, with the counts of words remembered."""

    def __init__(self, model: bytes):
        self.automaton, self.memory = Automaton(*vocabulary(model)), {}

    def tokens(self, text: str) -> tuple[int, int]:
        memory, words = self.memory, text.split()
        if len(memory) > _MEMORY:
            memory.clear()
        total = 0
        for word in words:
            n = memory.get(word)
            if n is None:
                n = memory[word] = self.automaton.count(word)
            total += n
        return len(words), total


def counter(spark: SparkSession, model_path: str):
    """A column function text -> struct(n_words, n_tokens). The model file is read by the driver
    and broadcast; it has a few hundred kilobytes."""
    with open(model_path, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())
    held: list[Counts] = []

    @F.arrow_udf("n_words long, n_tokens long")
    def count(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(Counts(shared.value))
        pairs = [held[0].tokens(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays(
            [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["n_words", "n_tokens"])

    return count


def token_counts(spark: SparkSession, docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_words, n_tokens of every row of docs (doc_id, text), whole texts.

    Words are parted by white space; each word is cut greedily into the longest pieces, and a word
    that cannot be cut counts as one unknown token. A null or empty text has no words and no tokens.
    Repeated rows are counted each; other columns are ignored.
    """
    ship_package(spark)
    count = counter(spark, model_path)
    return docs.select("doc_id", count(F.coalesce("text", F.lit(""))).alias("c")).select("doc_id", "c.n_words", "c.n_tokens")
