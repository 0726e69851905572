"""Reading inputs, choosing columns, numbering rows, writing results."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrakin.functions.lexicons import NARRATION_COLUMNS
from narrakin.session import shared_dir


def _csv_reader(spark: SparkSession, path: str, multi_line: bool) -> tuple[DataFrameReader, T.StructType]:
    """A reader and the columns that the header of one file names, every column as text.

    Files whose header differs are refused by name when they are read, unless the names
    cannot be compared because some are empty or repeated.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    names = reader.csv(path).columns
    line = spark.read.option("escape", '"').option("multiLine", multi_line).csv(path).first()
    plain = line is not None and [*line] == names
    return reader.option("enforceSchema", not plain), T.StructType([T.StructField(name, T.StringType()) for name in names])


def read_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV with a header line, every column as text.

    The header of one file decides the names, so a file of any size is read once; a file
    with another header, or the columns in another order, fails with its name. Missing
    fields of a row are null, fields beyond the header are left out. Texts with line breaks
    need ``multi_line``, which reads each file in one task.
    """
    reader, schema = _csv_reader(spark, path, multi_line)
    return reader.schema(schema).csv(path)


def read_csv_apart(spark: SparkSession, path: str, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """The rows of a CSV that have as many fields as its header, and (file, line) of all others."""
    reader, schema = _csv_reader(spark, path, multi_line)
    line = "_line" if "_line" not in schema.names else f"_line_{len(schema)}"
    rows = reader.schema(schema.add(line, T.StringType())).option("columnNameOfCorruptRecord", line).csv(path)
    # Lines are told apart by the columns that a plan reads, so the condition looks at all of them.
    whole = F.length(F.concat_ws("", *[F.col(f"`{name}`") for name in schema.names])) >= 0
    good, bad = rows.filter(F.col(line).isNull() & whole), rows.filter(F.col(line).isNotNull() & whole)
    return good.drop(line), bad.select(F.col("_metadata.file_path").alias("file"), F.col(line).alias("line"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """CSV by its ending, otherwise Parquet; an unreadable path fails here."""
    return read_csv(spark, path) if path.lower().endswith(".csv") else spark.read.parquet(path)


def company_text_column(df: DataFrame, wanted: Sequence[str] = ()) -> str:
    """First configured name if the table has it, else the first column."""
    return wanted[0] if wanted and wanted[0] in df.columns else df.columns[0]


def narration_text_column(df: DataFrame, wanted: Sequence[str] = ()) -> str:
    """First configured name if present, else a usual name, else the first column."""
    for name in [*wanted[:1], *NARRATION_COLUMNS]:
        if name in df.columns:
            return name
    return df.columns[0]


def with_ordinal(df: DataFrame, order_by: Sequence[str], name: str = "company_id") -> DataFrame:
    """Number rows from 0 in the order of the given columns, without one big task.

    Equal rows are numbered as they lie in the input, which also lets them be sorted by several
    tasks. Rows are range-sorted and checkpointed, so that a lost executor cannot move
    them; each partition then adds the number of rows before it. The offsets are
    one row per partition.
    """
    shared_dir(df.sparkSession)
    lying = df.withColumn("_lies", F.monotonically_increasing_id())
    placed = lying.orderBy(*order_by, "_lies").drop("_lies").withColumn("_place", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_place", 33)
    row = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).count()
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    return (placed.withColumn("_part", part)
            .join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_before") + row)
            .drop("_part", "_place", "_before"))


def write_results(df: DataFrame, path: str, file_format: str = "csv") -> None:
    """Results as CSV files with a header, or as Parquet."""
    writer = df.write.mode("overwrite")
    if file_format == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.parquet(path)


def list_columns_to_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lists as text joined by pipes, for files that hold only text."""
    return df.withColumns({c: F.array_join(c, "|") for c in columns})


def text_columns_to_lists(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Inverse of list_columns_to_text; null or empty text gives an empty list."""
    empty = F.array().cast("array<string>")
    return df.withColumns({
        c: F.when(F.coalesce(F.col(c), F.lit("")) == "", empty).otherwise(F.split(c, r"\|"))
        for c in columns})


def write_companies(companies: DataFrame, path: str) -> None:
    companies.write.mode("overwrite").parquet(path)


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    """Stored companies; an empty normalised text falls back to the cleaned one."""
    df = spark.read.parquet(path)
    return df.withColumn("normalized_text", F.coalesce(
        F.nullif(F.col("normalized_text"), F.lit("")), F.col("cleaned_text")))


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below a path, none if it is not there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in system.listStatus(target) if s.isDirectory()] if system.exists(target) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package has written, if it is there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def write_locations(locations: DataFrame, path: str, file_format: str = "text") -> None:
    """Sorted dictionary, one location per line under comment lines, or as Parquet."""
    if file_format == "parquet":
        locations.orderBy("location").write.mode("overwrite").parquet(path)
        return
    head = locations.agg(F.count("*").alias("n")).select(
        F.lit(0).alias("kind"),
        F.explode(F.array(
            F.lit("# Places found in names and narrations, one per line"),
            F.concat(F.lit("# Places: "), F.col("n")),
            F.concat(F.lit("# Written: "), F.date_format(F.now(), "yyyy-MM-dd HH:mm:ss")),
        )).alias("value"))
    lines = locations.select(F.lit(1).alias("kind"), F.col("location").alias("value"))
    head.union(lines).orderBy("kind", "value").select("value").write.mode("overwrite").text(path)


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    """Dictionary file without comments and blank lines; a missing file is empty."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "location string")
    line = F.trim("value")
    return (spark.read.text(path).select(line.alias("location"))
            .filter((F.col("location") != "") & ~F.col("location").startswith("#")).distinct())


def add_location_run(counts: DataFrame, path: str, run_id: str) -> None:
    """Keep what one run found, as (location, n), in a folder of its own; the same run again takes its place."""
    if not re.fullmatch(r"[\w.-]+", run_id):
        raise ValueError(f"a run id has letters, digits, dots, dashes and underscores only, not {run_id!r}")
    counts.select("location", F.col("n").cast("long").alias("n")).write.mode("overwrite").parquet(f"{path}/run={run_id}")


def read_location_runs(spark: SparkSession, path: str, without: str | None = None) -> DataFrame:
    """Locations of all complete runs but one: location, n (rows that showed it), runs (how many found it)."""
    runs = [name for name in folders(spark, path) if name.startswith("run=") and name != f"run={without}"
            and path_exists(spark, f"{path}/{name}/_SUCCESS")]
    if not runs:
        return spark.createDataFrame([], "location string, n long, runs long")
    found = spark.read.schema("location string, n long").parquet(*[f"{path}/{name}" for name in runs])
    return found.groupBy("location").agg(F.sum("n").alias("n"), F.count("*").alias("runs"))
