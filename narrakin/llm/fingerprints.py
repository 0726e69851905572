"""Document fingerprints that subtract: invertible Bloom lookup sketches of paragraph digests.

Everything here is Spark SQL expressions; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from narrakin.session import settle

#: A sketch has three rows of cells; each digest goes into one cell of each row. Cells of a row in
#: the first sketch, which is the fingerprint.
ROWS, WIDTH = 3, 8
#: Most digests of both sides that the first sketch is tried with.
FIRST = 12
#: Rounds of peeling, each over the three rows in turn. The digests left over after each row are
#: about the square of those before it, as a share, so six rows empty any sketch that can be emptied.
ROUNDS = 2
#: Later sketches have, in a row, so many cells for each digest of both sides. If none can be
#: peeled, the few digests that are left over are compared as they are.
RETRIES = (1, 16, 256)
#: Pairs to try again are found by broadcast up to so many, of two numbers each.
BROADCAST_PAIRS = 1_000_000
#: Digests that one task peels.
TASK_DIGESTS = 150_000
#: Documents of one piece of the order by doc_id, and most pieces that the order is cut into.
PIECE_ROWS, MOST_PIECES = 100, 65_536
#: A paragraph ends at a line break. A line of over 96 characters is cut where a sentence ends, or
#: after as many again; cuts depend on what stands before them in the line only.
_PARAGRAPHS = r"[^\n]{1,96}[^\n.!?]{0,96}[\n.!?]*|\n+"


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of a text's paragraphs."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_PARAGRAPHS), F.lit(0)), lambda p: F.xxhash64(F.trim(p))))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(17))


def _place(key: Column, row: int) -> Column:
    """Number that gives the cell of a digest in a row, by its lowest bits: 20 of the digest's."""
    return F.shiftrightunsigned(key, 20 * row).bitwiseAND(F.lit((1 << 20) - 1))


def _cell(n: Column, key: Column, check: Column) -> Column:
    return F.struct(n.alias("n"), key.alias("k"), check.alias("c"))


def sketch(keys: Column) -> Column:
    """The first sketch of a set of digests: in each cell their number, their xor and that of their checks."""
    empty = F.lit(0).cast("long")

    def add(cell: Column, key: Column) -> Column:
        return _cell(cell["n"] + 1, cell["k"].bitwiseXOR(key), cell["c"].bitwiseXOR(_check(key)))

    def cells(row: int) -> Column:
        place = lambda key: _place(key, row).bitwiseAND(F.lit(WIDTH - 1))
        return F.transform(F.sequence(F.lit(0), F.lit(WIDTH - 1)), lambda i: F.aggregate(
            keys, _cell(empty, empty, empty), lambda cell, key: F.when(place(key) == i, add(cell, key)).otherwise(cell)))

    return F.concat(*[cells(row) for row in range(ROWS)])


def printed(cells: Column) -> Column:
    """A sketch as text: per cell its count, its digests' xor and the low half of their checks', in hex."""
    return F.array_join(F.transform(cells, lambda c: F.concat_ws(
        ".", F.hex(c["n"]), F.hex(c["k"]), F.hex(c["c"].bitwiseAND(F.lit(0xFFFFFFFF))))), ":")


def peeled(cells: DataFrame, by: list[str]) -> DataFrame:
    """Take the digests out of subtracted sketches, cell by cell.

    cells: the columns `by`, width, row, cell, n, k, c, at most one row per cell, empty cells left
    out. A cell with one digest, by its count and check, gives it up: it is taken from its cells in
    the other rows, which may leave one digest in those. A row of cells is treated at a time, so a
    digest is found once. Returns `by`, n (digests found) and ok (nothing is left). Without an
    exchange if cells are dealt by a column of `by`.
    """
    keys = [*by, "width", "row", "cell"]
    for turn in range(ROWS * ROUNDS):
        row = turn % ROWS
        pure = (F.col("row") == row) & (F.abs("n") == 1) & (F.col("c") == _check(F.col("k")))
        other = [F.struct(F.lit(r).alias("row"), _place(F.col("k"), r).bitwiseAND(F.col("width") - 1).alias("cell"),
                          (-F.col("n")).alias("n"), "k", "c") for r in range(ROWS) if r != row]
        found = F.struct(F.lit(ROWS).alias("row"), F.lit(0).cast("long").alias("cell"), F.lit(1).cast("long").alias("n"),
                         F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("c"))
        moved = cells.select(*by, "width", F.explode(F.when(pure, F.array(*other, found)).otherwise(
            F.array(F.struct("row", "cell", "n", "k", "c")))).alias("x")).select(*by, "width", "x.*")
        cells = moved.groupBy(*keys).agg(F.sum("n").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("c").alias("c")).where(
            "n <> 0 OR k <> 0 OR c <> 0")
    return cells.groupBy(*by).agg(F.sum(F.when(F.col("row") == ROWS, F.col("n")).otherwise(0)).alias("n"),
                                  (F.max(F.when(F.col("row") < ROWS, 1).otherwise(0)) == 0).alias("ok"))


def _difference(rows: DataFrame, factor: int, tasks: int) -> DataFrame:
    """id, side, n, ok: digests that only one of a pair has, from its subtracted sketches.

    rows: id, pairs: array of struct(side, left, right). Cells are summed by key where the rows are
    dealt to, the right's with the opposite sign, so equal digests cancel before anything is peeled.
    """
    pair = rows.repartition(tasks, "id").select("id", F.explode("pairs").alias("p")).select("id", "p.*")
    total = (F.size("left") + F.size("right")).cast("long")
    large = F.least(F.lit(1 << 20), F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(total, F.lit(WIDTH)) * factor))).cast("long"))
    width = F.when(total <= FIRST, F.lit(WIDTH).cast("long")).otherwise(large) if factor == RETRIES[0] else large
    sign = lambda keys, s: F.transform(keys, lambda k: F.struct(F.lit(s).cast("long").alias("n"), k.alias("k")))
    dealt = pair.select("id", "side", width.alias("width"), F.explode(F.concat(sign(F.col("left"), 1), sign(F.col("right"), -1))).alias("x"))
    digest = dealt.select("id", "side", "width", "x.n", "x.k", _check(F.col("x.k")).alias("c"))
    rows_ = F.explode(F.array(*[F.struct(F.lit(r).alias("row"), _place(F.col("k"), r).bitwiseAND(F.col("width") - 1).alias("cell"))
                                for r in range(ROWS)]))
    celled = digest.select("*", rows_.alias("at")).select("id", "side", "width", "at.row", "at.cell", "n", "k", "c")
    cells = celled.groupBy("id", "side", "width", "row", "cell").agg(
        F.sum("n").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("c").alias("c")).where("n <> 0 OR k <> 0 OR c <> 0")
    return peeled(cells, ["id", "side"])


def differences(rows: DataFrame) -> DataFrame:
    """id, side, n: how many digests only one of each pair has; pairs without a difference are left out.

    rows: id long, unique, and pairs: array of struct(side int, left, right), arrays of distinct
    digests. Small sets are tried with the first sketch, larger ones with a sketch for their size;
    pairs that cannot be peeled are tried again with sketches many times as wide.
    """
    spark = rows.sparkSession
    done = spark.createDataFrame([], "id long, side int, n long")
    todo = rows
    for factor in RETRIES:
        size = todo.agg(F.sum(F.aggregate("pairs", F.lit(0), lambda a, p: a + F.size(p["left"]) + F.size(p["right"])))).first()[0]
        if size is None:
            return done
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // TASK_DIGESTS)
        got = settle(_difference(todo, factor, tasks), "peeled")
        done = done.unionByName(got.where("ok").select("id", "side", "n"))
        failed = got.where("NOT ok").groupBy("id").agg(F.collect_set("side").alias("failed"))
        failed = settle(failed, "unpeeled")
        failed = F.broadcast(failed) if failed.count() <= BROADCAST_PAIRS else failed
        todo = settle(todo.join(failed, "id").select(
            "id", F.filter("pairs", lambda p: F.array_contains("failed", p["side"])).alias("pairs")), "unpeeled")
    pair = todo.select("id", F.explode("pairs").alias("p")).select("id", "p.*")
    apart = F.size(F.array_except("left", "right")) + F.size(F.array_except("right", "left"))
    return done.unionByName(pair.select("id", "side", apart.cast("long").alias("n")))


def edited_text(text: Column, following: Column) -> Column:
    """The text with its last half, rounded down, replaced by as much of the start of another text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def _pieces(spark: SparkSession, docs: DataFrame, piece_rows: int) -> Column:
    """Number of the piece of the order by doc_id that a row is in.

    Cuts are quantiles of the ids: at most MOST_PIECES numbers, looked up in two steps.
    """
    rows = docs.count()
    wanted = min(MOST_PIECES, max(1, rows // piece_rows))
    cuts: list[int] = []
    if wanted > 1:
        shares = [i / wanted for i in range(1, wanted)]
        cuts = sorted(set(docs.select(F.percentile_approx("doc_id", shares, max(10_000, 10 * wanted))).first()[0] or []))
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    firsts = F.lit([g[0] for g in groups])
    nested = F.lit(groups)
    below = lambda cuts_, c: F.size(F.filter(cuts_, lambda x: x < c))
    outer = F.greatest(below(firsts, F.col("doc_id")), F.lit(1))
    piece = (outer - 1) * step + below(F.element_at(nested, outer), F.col("doc_id"))
    return F.coalesce(piece, F.lit(0))


def with_next(spark: SparkSession, docs: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """doc_id, text, digests of each row and those of the row after it by descending doc_id.

    After the last row comes the first. Rows with the same doc_id follow each other by text; rows
    without doc_id come last. The order is cut into pieces by quantiles of the ids; the last row of a
    piece meets the first of the next in that the row with the greatest id of each piece is also
    dealt to the piece before it. So the texts are shuffled once, and no task sees the whole order.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    piece = _pieces(spark, rows.select("doc_id"), piece_rows)
    ids = rows.select("doc_id", piece.alias("piece"))
    tops = ids.groupBy("piece").agg(F.max("doc_id").alias("top")).orderBy("piece").collect()  # at most MOST_PIECES rows
    places = [(r["top"], tops[i + 1]["piece"] if i + 1 < len(tops) else tops[0]["piece"], i + 1 == len(tops)) for i, r in enumerate(tops)]
    heads = F.broadcast(spark.createDataFrame(places, "top long, before long, wraps boolean"))
    own = F.struct(piece.cast("long").alias("piece"), F.lit(0).alias("turn"))
    guest = F.struct(F.col("before").alias("piece"), F.when(F.col("wraps"), 2).otherwise(1).alias("turn"))
    dealt = rows.join(heads, F.col("doc_id").eqNullSafe(F.col("top")), "left").select(
        "doc_id", "text", F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, guest))).alias("at"))
    met = dealt.select("at.piece", "at.turn", "doc_id", "text").repartition("piece").withColumn("keys", digests(F.col("text")))
    order = Window.partitionBy("piece").orderBy("turn", F.col("doc_id").desc_nulls_last(), "text")
    after = met.withColumn("next_text", F.lead("text").over(order)).withColumn("next_keys", F.lead("keys").over(order))
    return after.where("turn = 0").drop("turn")


def fingerprints(spark: SparkSession, docs: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Fingerprint every row of docs (doc_id, text), its edited text, and compare with the next row.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    Likeness is the number of paragraph digests in common over that of all, 1 for two empty texts;
    the number that differ is peeled out of subtracted sketches. A null text is empty. Equal texts
    have equal fingerprints; texts with the same set of paragraphs do too. The only row is its own
    next. Other columns are ignored; an empty table gives no rows.
    """
    rows = with_next(spark, docs, piece_rows)
    edited = rows.withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    keyed = edited.withColumn("edited_keys", digests(F.col("edited")))
    base = settle(keyed.select(
        F.monotonically_increasing_id().alias("id"), "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), "keys", "edited_keys", "next_keys"), "fingerprint-rows")
    side = lambda number, right: F.struct(F.lit(number).alias("side"), F.col("keys").alias("left"), F.col(right).alias("right"))
    pairs = base.select("id", F.array(side(0, "edited_keys"), side(1, "next_keys")).alias("pairs"))
    found = differences(pairs).groupBy("id").agg(
        *[F.sum(F.when(F.col("side") == s, F.col("n"))).alias(f"n{s}") for s in (0, 1)])
    joined = base.join(found, "id", "left")

    def likeness(right: str, n: str) -> Column:
        total = F.size("keys") + F.size(right)
        differ = F.coalesce(F.col(n), F.lit(0))
        return F.when(total == 0, F.lit(1.0)).otherwise((total - differ) / (total + differ))

    return joined.select(
        "doc_id", "n_chars", "edited_sha256", printed(sketch(F.col("keys"))).alias("fingerprint"),
        printed(sketch(F.col("edited_keys"))).alias("edited_fingerprint"),
        likeness("edited_keys", "n0").alias("near_edited"), likeness("next_keys", "n1").alias("near_next"))
