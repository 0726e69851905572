"""Class-based bigram scores of texts, with word classes found by exchange (Brown clustering)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from narrakin.llm.tables import text_or_empty
from narrakin.session import settle, ship_package

#: Classes of words; the end of a text has one more of its own.
CLASSES = 64
#: Most rounds of exchange, and the gain in likelihood (relative) below which they stop.
ROUNDS, LEAST_GAIN = 8, 3e-4
#: A word with at least this share of all tokens is a type of its own; there are at most 100,000 of these.
#: All other words, unknown ones included, belong to one of so many types by their last three characters.
TYPE_SHARE, ENDINGS = 1e-5, 4096
#: Counts of words with at least this share (at most a million words) are sent to every task, others are joined.
KNOWN_SHARE = 1e-6
#: Bytes of text that are cut into words at a time.
STEP_BYTES = 2 << 20
#: Neighbouring types are summed in so many parts, by type; a task passes on what it has summed whenever it holds so many
#: pairs; and what over so many tasks pass on is summed in two steps.
LINK_PARTS, HELD_PAIRS, ONE_STEP = 256, 700_000, 512
#: Neighbours of types whose classes are looked up at a time.
STEP_LINKS = 500_000


def _pieces(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """First row and texts of slices of bounded size; a longer text is a slice of its own."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes), 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + STEP_BYTES, "right")))
        yield start, texts.slice(start, stop - start)
        start = stop


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the number of each token's word, and how many tokens each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat, rows = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    filled = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    coded = flat.filter(pa.array(filled)).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), np.bincount(rows[filled], minlength=len(texts))


def ending_types(words: pa.Array, first: int, endings: int) -> np.ndarray:
    """Type of each word by the hash of its last three characters."""
    tails = pc.utf8_slice_codeunits(words, start=-3).dictionary_encode()
    hashed = np.fromiter((xxhash.xxh64_intdigest(t.encode()) % endings for t in tails.dictionary.to_pylist()), np.int64, len(tails.dictionary))
    return first + hashed[tails.indices.to_numpy()]


@dataclass
class Vocabulary:
    """Frequent words with their counts, most frequent first; the first `own` of them are types of their own.

    Types are numbered: words of their own, then endings, then the end of a text.
    """

    words: pa.Array
    counts: np.ndarray
    own: int
    endings: int

    @property
    def end(self) -> int:
        return self.own + self.endings

    def look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Type and count of each word; the count is -1 for words that are not frequent."""
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)
        count = np.where(at >= 0, self.counts[at], -1) if len(self.counts) else np.full(len(words), -1)
        types = np.where((at >= 0) & (at < self.own), at, ending_types(words, self.own, self.endings))
        return types, count


def with_ends(values: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts' values in a row with an end after each text, and where the ends are."""
    ends = np.cumsum(sizes + 1) - 1
    out = np.full(len(values) + len(sizes), end, values.dtype)
    places = np.ones(len(out), bool)
    places[ends] = False
    out[places] = values
    return out, ends


def previous(types: np.ndarray, ends: np.ndarray, end: int) -> np.ndarray:
    """What stands before each token: the one before it in its text, or the end before the first."""
    before = np.concatenate([[end], types[:-1]])
    before[np.concatenate([[0], ends[:-1] + 1])] = end
    return before


def held_out() -> Column:
    """Whether a document is kept back: crc32 of its id as text leaves 2 by 7. One without id is learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2, F.lit(False))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, texts in _pieces(batch.column(0)):
            words, codes, _ = words_of(texts)
            yield pa.RecordBatch.from_arrays([words, pa.array(np.bincount(codes, minlength=len(words)))], names=["word", "n"])


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order, each once, with the sum of its counts."""
    keys, n = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _in_parts(part: np.ndarray, keys: np.ndarray, n: np.ndarray, parts: int) -> pa.RecordBatch:
    """One row per part: its keys in order and their counts, as bytes."""
    order = np.lexsort((keys, part))
    bounds = np.searchsorted(part[order], np.arange(parts + 1))
    keys, n = keys[order], n[order]
    filled = np.flatnonzero(np.diff(bounds))
    cut = lambda values: pa.array([values[bounds[p]:bounds[p + 1]].tobytes() for p in filled], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(filled.astype(np.int32)), cut(keys), cut(n)], names=["part", "keys", "n"])


def _count_links(vocabulary, parts: int):
    """How often types stand beside each other. A key is a type (times 2^33), a side and the other type.

    On side 0 the other type stands before the type, on side 1 behind it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        held, size = [], 0

        def passed_on() -> Iterator[pa.RecordBatch]:
            pairs, n = _merged(held)
            held.clear()
            a, b = pairs >> 32, pairs & 0xFFFFFFFF
            yield _in_parts(b % parts, b << 33 | a, n, parts)
            yield _in_parts(a % parts, a << 33 | 1 << 32 | b, n, parts)

        for batch in batches:
            for _, texts in _pieces(batch.column(0)):
                words, codes, sizes = words_of(texts)
                types, ends = with_ends(known.look_up(words)[0][codes], sizes, known.end)
                pairs, n = np.unique(previous(types, ends, known.end) << 32 | types, return_counts=True)
                held.append((pairs, n))
                size += len(pairs)
                if size >= HELD_PAIRS:
                    held[:] = [_merged(held)]
                    size = len(held[0][0])
                    if 2 * size >= HELD_PAIRS:
                        yield from passed_on()
                        size = 0
        if held:
            yield from passed_on()
    return run


def _sum_links(packed: bool):
    """Sums of the rows (part, keys, n) of each part: such rows again, or one row per type with its neighbours."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for part, keys, n in zip(*(batch.column(name).to_pylist() for name in ("part", "keys", "n"))):
                mine = held.setdefault(part, [])
                mine.append((np.frombuffer(keys, np.int64), np.frombuffer(n, np.int64)))
                if len(mine) > 1 and sum(len(k) for k, _ in mine[1:]) > max(len(mine[0][0]), HELD_PAIRS // 8):
                    held[part] = [_merged(mine)]
        for part in list(held):
            keys, n = _merged(held.pop(part))
            if not packed:
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([keys.tobytes()]), pa.array([n.tobytes()])], names=["part", "keys", "n"])
                continue
            types = keys >> 33
            first = np.flatnonzero(np.concatenate([[True], types[1:] != types[:-1]]))
            offsets = pa.array(np.append(first, len(keys)).astype(np.int32))
            codes = ((keys & 0xFFFFFFFF) << 1 | (keys >> 32 & 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(types[first]), pa.ListArray.from_arrays(offsets, pa.array(codes)),
                                              pa.ListArray.from_arrays(offsets, pa.array(n))], names=["t", "codes", "ns"])
    return run


def type_links(texts: DataFrame, vocabulary, parts: int = LINK_PARTS) -> DataFrame:
    """t, codes, ns: for each type its neighbours (twice their type, plus 1 for those behind it) and how often.

    Tasks sum what they read and pass on whole sorted runs, so rows of single pairs are never
    shuffled. Types are bounded in number by their share, and with them a row.
    """
    blobs = texts.mapInArrow(_count_links(vocabulary, parts), "part int, keys binary, n binary")
    tasks = texts.rdd.getNumPartitions()
    if tasks > ONE_STEP:
        salted = blobs.repartition(parts * (tasks // ONE_STEP + 1), "part", F.pmod(F.spark_partition_id(), F.lit(tasks // ONE_STEP + 1)))
        blobs = salted.mapInArrow(_sum_links(False), "part int, keys binary, n binary")
    return settle(blobs.repartition(parts, "part").mapInArrow(_sum_links(True), "t long, codes array<int>, ns array<long>"), "brown-links")


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def likelihood(table: np.ndarray) -> float:
    """Log-likelihood of the class bigrams, but for a part that no assignment changes."""
    return float(xlogx(table).sum() - xlogx(table.sum(1)).sum() - xlogx(table.sum(0)).sum())


def insertion_gains(table: np.ndarray, before: np.ndarray, after: np.ndarray, self_pairs: float) -> np.ndarray:
    """Change of the likelihood when a type is put into each class.

    table: class bigrams without the type; before and after: its counts by class of the neighbour,
    without pairs of the type with itself.
    """
    diagonal = np.diagonal(table)
    gain = np.zeros(len(table))
    for counts, cells in ((before, table), (after, table.T)):
        at = np.flatnonzero(counts)
        added = xlogx(cells[at] + counts[at, None]) - xlogx(cells[at])
        added[np.arange(len(at)), at] = 0
        gain += added.sum(0)
    gain += xlogx(diagonal + before + after + self_pairs) - xlogx(diagonal)
    for counts, totals in ((after, table.sum(1) + before), (before, table.sum(0) + after)):
        gain -= xlogx(totals + counts.sum() + self_pairs) - xlogx(totals)
    return gain


def best_class(table: np.ndarray, own: int, before: np.ndarray, after: np.ndarray, self_pairs: float, classes: int) -> int:
    """The class that gives the greatest likelihood, its own if no other is better by more than rounding.

    own is -1 for a type without class, whose counts are not in the table yet.
    """
    if own >= 0:
        table = table.copy()
        table[:, own] -= before
        table[own, :] -= after
        table[own, own] -= self_pairs
    gains = insertion_gains(table, before, after, self_pairs)[:classes]
    best = int(gains.argmax())
    return own if own >= 0 and gains[best] <= gains[own] + 1e-9 * abs(gains[own]) else best


def _class_counts(batch: pa.RecordBatch, of: np.ndarray, width: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Types of a batch, how often each has each class before (0) and behind it (1), and how often itself behind it.

    Pairs of a type with itself are among the first counts only if `same`; neighbours without class
    never. A batch is worked on some types at a time.
    """
    all_types, ends = batch.column("t").to_numpy(), batch.column("codes").offsets.to_numpy().astype(np.int64)
    all_codes, all_n = batch.column("codes").flatten().to_numpy(), batch.column("ns").flatten().to_numpy()
    ends, start = ends - ends[0], 0
    while start < len(all_types):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + STEP_LINKS, "right")) - 1)
        types, codes, n = all_types[start:stop], all_codes[ends[start]:ends[stop]], all_n[ends[start]:ends[stop]]
        row = np.repeat(np.arange(len(types)), np.diff(ends[start:stop + 1]))
        side, other = codes & 1, codes >> 1
        own = other == types[row]
        use = of[other] >= 0 if same else (of[other] >= 0) & ~own
        counts = np.bincount((2 * row[use] + side[use]) * width + of[other[use]], n[use], 2 * len(types) * width).reshape(len(types), 2, width)
        twice = own & (side == 1)
        yield types, counts, np.bincount(row[twice], n[twice], len(types))
        start = stop


def _tables(state):
    """Class bigrams of the types of a task: own class, class behind it, n."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, width = state.value
        total = np.zeros((width, width))
        for batch in batches:
            for types, counts, _ in _class_counts(batch, of, width, True):
                held = of[types] >= 0
                np.add.at(total, of[types[held]], counts[held, 1])
        a, b = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(total[a, b].astype(np.int64))], names=["a", "b", "n"])
    return run


def _mover(state, classes: int):
    """The best class of each type, all others staying: rows (t, c)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, table = state.value
        for batch in batches:
            for types, counts, twice in _class_counts(batch, of, len(table), False):
                moved = [best_class(table, int(of[t]), c[0], c[1], float(s), classes) for t, c, s in zip(types.tolist(), counts, twice.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(types), pa.array(moved, pa.int32())], names=["t", "c"])
    return run


def class_table(spark: SparkSession, links: DataFrame, of: np.ndarray, classes: int) -> np.ndarray:
    """Class bigrams under an assignment, in which -1 is no class."""
    state = spark.sparkContext.broadcast((of, classes + 1))
    sums = links.mapInArrow(_tables(state), "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((classes + 1, classes + 1))
    table[sums.column("a").to_numpy(), sums.column("b").to_numpy()] = sums.column("n").to_numpy()
    return table


def moves(spark: SparkSession, links: DataFrame, of: np.ndarray, table: np.ndarray, eligible: Column, classes: int) -> np.ndarray:
    """The assignment after every eligible type has gone to its best class, all others staying."""
    state = spark.sparkContext.broadcast((of, table))
    found = links.where((F.col("t") < len(of) - 1) & eligible).mapInArrow(_mover(state, classes), "t long, c int").toArrow()
    out = of.copy()
    out[found.column("t").to_numpy()] = found.column("c").to_numpy()
    return out


def exchange(spark: SparkSession, links: DataFrame, counts: np.ndarray, classes: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Classes of types by exchange clustering, the class bigrams, and the likelihood after each round.

    The last type is the end of a text and keeps class `classes`. The most frequent types start a
    class each and the others join the best of these; in each round a share of the types, by hash,
    then move to the class that raises the likelihood most. Moves of one round do not see each
    other, so a round that lowers the likelihood is taken back and the share halved. An assignment
    is one number per type, of which there is a bounded number, and is sent to every task.
    """
    types = len(counts) - 1
    order = np.argsort(-counts[:-1], kind="stable")
    of = np.full(len(counts), -1)
    of[order[:classes]] = np.arange(min(classes, types))
    of[-1] = classes
    if types > classes:
        of = moves(spark, links, of, class_table(spark, links, of, classes), F.lit(True), classes)
    of = np.where(of < 0, np.arange(len(of)) % classes, of)
    table = class_table(spark, links, of, classes)
    course, share = [likelihood(table)], 2
    for turn in range(rounds):
        eligible = F.pmod(F.xxhash64("t", F.lit(turn // share)), F.lit(share)) == turn % share
        new = moves(spark, links, of, table, eligible, classes)
        new_table = class_table(spark, links, new, classes)
        if likelihood(new_table) < course[-1]:
            course.append(course[-1])
            share *= 2
            continue
        course.append(likelihood(new_table))
        of, table = new, new_table
        if turn % share == share - 1 and course[-1] - course[-2] <= LEAST_GAIN * abs(course[-1]):
            break
    return of, table, course


@dataclass
class ClassModel:
    """Probabilities of types: log10 of class after class, and of a type within its class.

    mass is the share a type has beside its counted words for words that were never seen; the
    probability of a word within an ending is its count, or the mass if it is unknown, by the sum.
    """

    vocabulary: Vocabulary
    classes: np.ndarray
    transitions: np.ndarray
    emissions: np.ndarray
    log_total: np.ndarray
    log_unseen: np.ndarray
    tokens: int
    distinct: int
    texts: int

    def base(self, count):
        """log10 of the add-one share of a token seen so often."""
        return np.log10((count + 1.0) / (self.tokens + self.distinct + 1.0))


def probabilities(vocabulary: Vocabulary, classes: np.ndarray, table: np.ndarray, counts: np.ndarray, singles: np.ndarray,
                  tokens: int, distinct: int, texts: int) -> ClassModel:
    """Smoothed model: a class after another by Witten-Bell, falling back on how frequent classes are.

    Unseen words have as much mass in an ending as words seen once, plus one.
    """
    unseen = np.zeros(len(counts))
    unseen[vocabulary.own:vocabulary.end] = singles + 1.0
    total = counts + unseen
    total[-1] += 1.0
    of_class = np.bincount(classes, total, len(table))
    prior = of_class / of_class.sum()
    weight = np.maximum((table > 0).sum(1), 1)[:, None]
    transitions = (table + weight * prior) / (table.sum(1)[:, None] + weight)
    with np.errstate(divide="ignore"):
        return ClassModel(vocabulary, classes, np.log10(transitions), np.log10(total / of_class[classes]), np.log10(total), np.log10(unseen),
                          tokens, distinct, texts)


def _narrowed(docs: DataFrame) -> DataFrame:
    return docs.select(text_or_empty().alias("text"))


def fit(spark: SparkSession, learnt: DataFrame, classes: int = CLASSES, rounds: int = ROUNDS, type_share: float = TYPE_SHARE,
        endings: int = ENDINGS, known_share: float = KNOWN_SHARE) -> tuple[ClassModel, DataFrame]:
    """The model of all texts of `learnt`, and the table (word, n) of all their words."""
    texts = _narrowed(learnt)
    counted = settle(texts.mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "brown-words")
    n_texts = learnt.count()
    n_words, distinct = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    tokens = n_words + n_texts
    known = counted.where(F.col("n") >= max(1.0, tokens * known_share)).toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    counts = known.column("n").to_numpy()
    vocabulary = Vocabulary(known.column("word").combine_chunks().cast(pa.string()), counts, int((counts >= tokens * type_share).sum()), endings)
    state = spark.sparkContext.broadcast(vocabulary)
    links = type_links(texts, state)

    def single_endings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, n = np.unique(ending_types(batch.column(0), 0, endings), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["t", "n"])

    by_type, singles = np.zeros(vocabulary.end + 1), np.zeros(endings)
    before = F.filter(F.arrays_zip("codes", "ns"), lambda x: x["codes"] % 2 == 0)
    for out, rows in ((by_type, links.select("t", F.aggregate(before, F.lit(0).cast("long"), lambda n, x: n + x["ns"]).alias("n"))),
                      (singles, counted.where("n = 1").select("word").mapInArrow(single_endings, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")))):
        found = rows.toArrow()
        out[found.column("t").to_numpy()] = found.column("n").to_numpy()
    of, table, _ = exchange(spark, links, by_type, classes, rounds)
    return probabilities(vocabulary, of, table, by_type, singles, tokens, distinct + (n_texts > 0), n_texts), counted


_SUMMED = "rid long, n_tokens long, n_known long, base double, score double, rare array<struct<word:string,t:int,m:long>>"


def _scorer(state):
    """Sums of each text over what is known here, and its other words with their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = state.value
        vocabulary = model.vocabulary
        for batch in batches:
            for start, texts in _pieces(batch.column("text")):
                words, codes, sizes = words_of(texts)
                word_types, counts = vocabulary.look_up(words)
                types, ends = with_ends(word_types[codes], sizes, vocabulary.end)
                own = model.emissions[types]
                apart = (types >= vocabulary.own) & (types < vocabulary.end)
                count, _ = with_ends(counts[codes], sizes, model.texts)
                own[apart] -= model.log_total[types[apart]]
                frequent = apart & (count >= 0)
                own[frequent] += np.log10(np.maximum(count[frequent], 1))
                steps = own + model.transitions[model.classes[previous(types, ends, vocabulary.end)], model.classes[types]]
                rows = np.repeat(np.arange(len(sizes)), sizes + 1)
                seen = count >= 0
                sums = lambda values, where: np.bincount(rows[where], values[where], len(sizes))
                rare = np.flatnonzero(counts[codes] < 0)
                text_of = np.repeat(np.arange(len(sizes)), sizes)[rare]
                pairs, m = np.unique(text_of * max(len(words), 1) + codes[rare], return_counts=True)
                word = pairs % max(len(words), 1)
                offsets = np.searchsorted(pairs // max(len(words), 1), np.arange(len(sizes) + 1))
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.StructArray.from_arrays(
                    [words.take(pa.array(word)), pa.array((word_types[word] - vocabulary.own).astype(np.int32)), pa.array(m)], names=["word", "t", "m"]))
                yield pa.RecordBatch.from_arrays([
                    batch.column("rid").slice(start, len(texts)), pa.array(sizes + 1), pa.array(sums(count > 0, seen).astype(np.int64)),
                    pa.array(sums(model.base(np.maximum(count, 0)), seen)), pa.array(np.bincount(rows, steps, len(sizes))), lists,
                ], names=["rid", "n_tokens", "n_known", "base", "score", "rare"])
    return run


def score(spark: SparkSession, docs: DataFrame, model: ClassModel, counted: DataFrame) -> DataFrame:
    """The whole texts of docs under a model: _row (all columns), n_tokens, n_known, base_score, score.

    Words that are not among the frequent ones sent to every task are joined with `counted`, each
    once per text.
    """
    ship_package(spark)
    rows = settle(docs.select(F.monotonically_increasing_id().alias("rid"), F.struct("*").alias("_row")), "brown-rows")
    state = spark.sparkContext.broadcast(model)
    summed = settle(rows.select("rid", F.coalesce("_row.text", F.lit("")).alias("text")).mapInArrow(_scorer(state), _SUMMED), "brown-sums")
    unseen = spark.createDataFrame([(t, float(u)) for t, u in enumerate(model.log_unseen[model.vocabulary.own:model.vocabulary.end])], "t int, unseen double")
    apart = summed.select("rid", F.explode("rare").alias("r")).select("rid", "r.*").join(counted, "word", "left").join(F.broadcast(unseen), "t")
    n, m = F.coalesce("n", F.lit(0)), F.col("m")
    more = apart.groupBy("rid").agg(
        F.sum(F.when(n > 0, m).otherwise(0)).alias("more_known"),
        F.sum(m * F.log10((n + 1.0) / F.lit(model.tokens + model.distinct + 1.0))).alias("more_base"),
        F.sum(m * F.when(n > 0, F.log10(n)).otherwise(F.col("unseen"))).alias("more_score"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    told = summed.drop("rare").join(more, "rid", "left").select(
        "rid", "n_tokens", (F.col("n_known") + zero("more_known")).alias("n_known"),
        (F.col("base") + zero("more_base")).alias("base_score"), (F.col("score") + zero("more_score")).alias("score"))
    return rows.join(told, "rid").drop("rid")


def class_scores(spark: SparkSession, docs: DataFrame, classes: int = CLASSES) -> DataFrame:
    """Score all texts by a class bigram model learnt from those that are not held out.

    docs: doc_id, text; other columns are ignored. Tokens are the words, A to Z lower-cased, and one
    end per text; a null text is empty and has the end only. Returns per row doc_id, held_out, n_tokens,
    n_known (tokens seen in training), train_tokens, base_score (log10 of the add-one unigram model)
    and score (log10 probability by the class model, in which an unknown word is one of the unknown
    with its last three characters). Repeated rows are learnt from, and scored, as often as they
    come; a row without doc_id is learnt from. Without any row to learn from base_score is 0 for
    every text.
    """
    ship_package(spark)
    narrow = docs.select("doc_id", "text")
    model, counted = fit(spark, narrow.where(~held_out()), classes)
    told = score(spark, narrow, model, counted)
    return told.select("_row.doc_id", "n_tokens", "n_known", "base_score", "score").select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
