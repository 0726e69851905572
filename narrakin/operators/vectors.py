"""Sparse vectors: TF-IDF over the three-character pieces of a text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrakin.operators import skew
from narrakin.operators.skew import lookup_join
from narrakin.session import send

#: Characters whose pieces are worked on in one step.
_STEP_CHARS = 1 << 20


def gram_counts(texts: DataFrame, key: str = "match_text") -> DataFrame:
    """Pieces of each distinct text, padded with one blank at both ends, with counts."""
    padded = F.concat(F.lit(" "), F.col(key), F.lit(" "))
    pieces = F.transform(F.sequence(F.lit(1), F.length(key)), lambda i: F.substring(padded, i, 3))
    return (texts.filter(F.length(key) > 0).select(key, F.explode(pieces).alias("gram"))
            .groupBy(key, "gram").agg(F.count("*").alias("tf")))


def gram_frequencies(counts: DataFrame) -> DataFrame:
    """In how many texts each piece occurs."""
    return counts.groupBy("gram").agg(F.count("*").alias("df"))


def tfidf(counts: DataFrame, frequencies: DataFrame, n_grams: int, n_texts: int,
          key: str = "match_text") -> DataFrame:
    """Unit-length weights, one row per text and piece.

    A piece the company side never shows has frequency 0; it adds to the length of
    a text but matches nothing.
    """
    weight = F.col("tf") * (F.log((F.lit(1.0) + n_texts) / (F.lit(1.0) + F.col("df"))) + 1.0)
    rows = (lookup_join(counts, frequencies, ["gram"], n_grams, salt_on=[key], how="left")
            .withColumn("df", F.coalesce("df", F.lit(0)))
            .withColumn("weight", weight))
    whole = Window.partitionBy(key)
    return rows.withColumn("weight", F.col("weight") / F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(whole)))


def gram_code(gram: Column) -> Column:
    """A piece as one number: three code points of 21 bits each."""
    a, b, c = (F.ascii(F.substring(gram, i, 1)).cast("long") for i in (1, 2, 3))
    return F.shiftleft(a, 42) + F.shiftleft(b, 21) + c


def pack(rows: DataFrame, key: str = "match_text") -> DataFrame:
    """One line per text with its pieces and their weights as arrays, rarest first."""
    entry = F.struct("df", gram_code(F.col("gram")).alias("code"), "weight")
    packed = rows.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    return packed.select(key, F.col("entries.code").alias("grams"), F.col("entries.weight").alias("weights"))


def text_pieces(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, code and count of the distinct pieces of each text, by row and code; as gram_counts."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(f" {text} " for text in texts).encode("utf-32-le"), "<u4").astype(np.int64)
    row = np.repeat(np.arange(len(texts)), lengths)
    at = np.arange(len(row)) + 2 * row
    code = points[at] << 42 | points[at + 1] << 21 | points[at + 2]
    order = np.lexsort((code, row))
    row, code = row[order], code[order]
    first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (code[1:] != code[:-1])])) if len(row) else np.empty(0, np.int64)
    return row[first], code[first], np.diff(np.concatenate([first, [len(row)]]))


def _steps(batch: pa.RecordBatch, key: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch of bounded length in all, and their texts."""
    texts = batch.column(key).to_pylist()
    done = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(done, (done[start - 1] if start else 0) + _STEP_CHARS, side="right")))
        yield batch.slice(start, stop - start), texts[start:stop]
        start = stop


def piece_frequencies(texts: DataFrame, key: str = "match_text") -> DataFrame:
    """gram_frequencies(gram_counts(texts)) of distinct texts, which are counted in batches and not taken apart into rows."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in _steps(batch, key):
                codes, n = np.unique(text_pieces(part)[1], return_counts=True)
                points = np.stack([codes >> 42, codes >> 21 & 0x1FFFFF, codes & 0x1FFFFF], 1).astype("<u4")
                yield pa.RecordBatch.from_arrays([pa.array([p.tobytes().decode("utf-32-le") for p in points], pa.string()), pa.array(n)], names=["gram", "n"])

    counted = texts.filter(F.length(key) > 0).select(key).mapInArrow(count, "gram string, n long")
    return counted.groupBy("gram").agg(F.sum("n").alias("df"))


def packed_tfidf(texts: DataFrame, frequencies: DataFrame, n_grams: int, n_texts: int, key: str = "match_text") -> DataFrame:
    """Distinct texts with all their columns and, as pack(tfidf(gram_counts(texts), ...)) makes them, their pieces and weights.

    Frequencies of at most BROADCAST_ROWS pieces are sent to every task, and a text is weighed where it lies.
    """
    texts = texts.filter(F.length(key) > 0)
    if n_grams > skew.BROADCAST_ROWS:
        return texts.join(pack(tfidf(gram_counts(texts, key), frequencies, n_grams, n_texts, key), key), key)
    table = frequencies.select(gram_code(F.col("gram")).alias("code"), "df").orderBy("code").toArrow()
    state = send(texts.sparkSession, [table.column(c).to_numpy() for c in ("code", "df")])
    schema = T.StructType([*texts.schema, T.StructField("grams", T.ArrayType(T.LongType())), T.StructField("weights", T.ArrayType(T.DoubleType()))])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, df = state.value
        for batch in batches:
            for rows, part in _steps(batch, key):
                row, code, tf = text_pieces(part)
                seen = np.zeros(len(code), np.int64)
                if len(codes):
                    at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                    seen = np.where(codes[at] == code, df[at], 0)
                weight = tf * (np.log((1.0 + n_texts) / (1.0 + seen)) + 1.0)
                weight /= np.sqrt(np.bincount(row, weight * weight, len(part)))[row]
                order = np.lexsort((code, seen, row))
                ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(part)))]), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(values[order])) for values in (code, weight)]
                yield pa.RecordBatch.from_arrays([*rows.columns, *lists], names=schema.names)

    return texts.mapInArrow(weigh, schema)


def with_model_vectors(df: DataFrame, text_col: str, load_model: Callable[[], Callable],
                       name: str = "vector") -> DataFrame:
    """Dense vectors from a caller's model.

    ``load_model`` runs once per Python worker task and returns a function from a
    list of texts to a two-dimensional array.
    """
    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model()
        for batch in batches:
            yield pd.Series(list(np.asarray(model(batch.tolist()), np.float32)))

    return df.withColumn(name, encode(F.col(text_col)))
