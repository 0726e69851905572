"""Exact sentencepiece merge encoding by backtracking over longest matches, and decoding."""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrakin.session import ship_package

MARK = "▁"
_SEGMENT = re.compile(f"{MARK}+[^{MARK}]*")
#: Segments whose encoding a task remembers, and the longest that it does.
_MEMORY = 400_000
_LONGEST = 64


class PieceCoder:
    """Encoder and decoder of a merge-type model with an identity normaliser.

    A sequence of pieces is what merging gives if every piece merges to itself and every two
    neighbours, merged anew together, stay as they are. So encoding takes the longest piece at each
    place, tries shorter ones where neighbours are not compatible, and steps back where none is
    left; a bit field of places from which no rest can be encoded keeps steps from being repeated.
    """

    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.end, self.unknown = sp.eos_id(), sp.unk_id()
        size = sp.vocab_size()
        self.bytes = {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(size) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.silent = {i for i in range(size) if sp.is_control(i)}
        self.piece_of = {i: sp.id_to_piece(i) for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
        self.id_of = {p: i for i, p in self.piece_of.items()}
        self.score = {p: sp.get_score(i) for p, i in self.id_of.items()}
        self.joins = {p[i:i + 2] for p in self.id_of for i in range(len(p) - 1)}
        self.matches = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for piece in self.id_of:
            if len(self.merge(piece)) == 1:
                self.matches.add_word(piece)
        self.matches.make_automaton()
        self.longest = max(map(len, self.id_of), default=1)
        #: For every prefix of a piece, the longest piece that it starts with.
        self.within: dict[str, str] = {}
        for piece in sorted(self.matches.keys(), key=len):
            for n in range(1, len(piece)):
                if piece[:n] not in self.within:
                    self.within[piece[:n]] = self.within.get(piece[:n - 1], piece[0])
            self.within[piece] = piece
        self.compatible: dict[tuple[str, str], bool] = {}
        self.memory: dict[str, tuple[int, str, str]] = {}
        self.parts: dict[str, tuple[int, str, str]] = {}

    def merge(self, text: str) -> list[str]:
        """Merge neighbours, the best score first and the leftmost of equals, until none is a piece."""
        parts, score, none = list(text), self.score.get, -float("inf")
        worth = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while worth:
            best = max(worth)
            if best == none:
                break
            i = worth.index(best)
            parts[i] += parts.pop(i + 1)
            del worth[i]
            if i < len(worth):
                worth[i] = score(parts[i] + parts[i + 1], none)
            if i:
                worth[i - 1] = score(parts[i - 1] + parts[i], none)
        return parts

    def _fit(self, left: str, right: str) -> bool:
        fits = self.compatible.get((left, right))
        if fits is None:
            if len(self.compatible) > _MEMORY:
                self.compatible.clear()
            fits = self.compatible[left, right] = self.merge(left + right) == [left, right]
        return fits

    def _match(self, text: str, pos: int) -> str:
        """The longest piece at a place, or the one character there."""
        ahead = text[pos:pos + self.longest]
        return self.within.get(ahead[:self.matches.longest_prefix(ahead)], ahead[0])

    def split(self, text: str) -> list[str]:
        """Pieces, and single characters outside the vocabulary, of a text with escaped spaces."""
        size, pos, dead = len(text), 0, 0
        out: list[str] = []
        piece: str | None = self._match(text, 0) if size else None
        while pos < size:
            while piece and (dead >> pos + len(piece) & 1 or out and not self._fit(out[-1], piece)):
                piece = self.within.get(piece[:-1], piece[0]) if len(piece) > 1 else None
            if piece:
                out.append(piece)
                pos += len(piece)
                piece = self._match(text, pos) if pos < size else None
            elif out:
                dead |= 1 << pos
                piece = out.pop()
                pos -= len(piece)
            else:
                raise ValueError("no sequence of pieces is stable under merging")
        return out

    def ids(self, pieces: list[str]) -> list[int]:
        out: list[int] = []
        for piece in pieces:
            known = self.id_of.get(piece)
            if known is not None:
                out.append(known)
            elif self.bytes:
                out.extend(self.bytes[b] for b in piece.encode())
            else:
                out.append(self.unknown)
        return out

    def _cut(self, segment: str) -> list[str]:
        """Parts between which no piece can reach: their two characters stand together in none."""
        parts, start = [], 0
        for i in range(1, len(segment)):
            if segment[i - 1:i + 1] not in self.joins:
                parts.append(segment[start:i])
                start = i
        parts.append(segment[start:])
        return parts

    def _part(self, part: str) -> tuple[int, str, str]:
        known = self.parts.get(part)
        if known is None:
            ids = self.ids(self.split(part))
            known = len(ids), " ".join(map(str, ids)), self._plain(ids)
            if len(part) <= _LONGEST:
                if len(self.parts) >= _MEMORY:
                    self.parts.clear()
                self.parts[part] = known
        return known

    def _segment(self, segment: str) -> tuple[int, str, str]:
        """Number of ids, the ids as text, and the decoded text of a segment."""
        known = self.memory.get(segment)
        if known is None:
            done = [self._part(p) for p in self._cut(segment)]
            known = done[0] if len(done) == 1 else (sum([d[0] for d in done]), " ".join([d[1] for d in done]), "".join([d[2] for d in done]))
            if len(segment) <= _LONGEST:
                if len(self.memory) >= _MEMORY:
                    self.memory.clear()
                self.memory[segment] = known
        return known

    def _segments(self, text: str) -> list[str]:
        return _SEGMENT.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, text: str) -> list[int]:
        """Ids of a text, without the end id."""
        return [int(i) for s in self._segments(text) for i in self._segment(s)[1].split()]

    def _plain(self, ids: list[int]) -> str:
        try:
            return "".join([self.piece_of[i] for i in ids]).replace(MARK, " ")
        except KeyError:
            pass
        out, pending = [], bytearray()
        for i in [*ids, None]:
            byte = self.byte_of.get(i)
            if byte is not None:
                pending.append(byte)
                continue
            if pending:
                out.append(_each_bad_byte(bytes(pending)))
                pending.clear()
            if i is not None and i not in self.silent:
                out.append(self.piece_of.get(i, " ⁇ ").replace(MARK, " "))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """Text of a sequence of ids; the space that encoding puts before a text is taken away."""
        text = self._plain(ids)
        first = next((i for i in ids if i not in self.silent), None)
        return text[1:] if first in self.piece_of and self.piece_of[first].startswith(MARK) else text

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids with the end id, SHA-256 of the ids, SHA-256 of the decoded text."""
        done = list(map(self._segment, self._segments(text)))
        ids = " ".join([d[1] for d in done] + [str(self.end)])
        decoded = "".join([d[2] for d in done])[1:]
        return sum([d[0] for d in done]) + 1, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def _each_bad_byte(data: bytes) -> str:
    """UTF-8, each byte that is part of no character becoming one replacement character."""
    out, at = [], 0
    while at < len(data):
        for width in (1, 2, 3, 4):
            try:
                out.append(data[at:at + width].decode())
            except UnicodeDecodeError:
                continue
            at += width
            break
        else:
            out.append("�")
            at += 1
    return "".join(out)


def coder(spark: SparkSession, model_path: str):
    """A column function text -> struct(n_tokens, ids_sha256, decoded_sha256). The driver reads the
    model file, of a few hundred kilobytes, and broadcasts it."""
    with open(model_path, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())
    held: list[PieceCoder] = []

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def encode(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(PieceCoder(shared.value))
        rows = [held[0].digest(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[i] for r in rows], pa.string()) for i in (1, 2))],
            names=["n_tokens", "ids_sha256", "decoded_sha256"])

    return encode


def encode_column(spark: SparkSession, model_path: str):
    """A column function text -> ids, the end id last."""
    with open(model_path, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())
    held: list[PieceCoder] = []

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(PieceCoder(shared.value))
        return pa.array([held[0].encode(t.as_py()) + [held[0].end] for t in texts], pa.list_(pa.int32()))

    return encode


def decode_column(spark: SparkSession, model_path: str):
    """A column function ids -> text."""
    with open(model_path, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())
    held: list[PieceCoder] = []

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        if not held:
            held.append(PieceCoder(shared.value))
        return pa.array([None if x is None else held[0].decode(x) for x in ids.to_pylist()], pa.string())

    return decode


def encoded_digests(spark: SparkSession, docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of docs (doc_id, text).

    A null text is empty; an empty text has the end id only. Repeated rows are encoded each, and
    other columns are ignored.
    """
    ship_package(spark)
    encode = coder(spark, model_path)
    return docs.select("doc_id", encode(F.coalesce("text", F.lit(""))).alias("p")).select("doc_id", "p.*")
