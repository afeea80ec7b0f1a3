"""File sources and sinks with declared schemas (CSV and Parquet, written by Spark's
distributed writers -- never through the driver)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillroll.schema import CLEAN_SCHEMA, RAW_SCHEMA, SUMMARY_SCHEMAS


class HeaderError(ValueError):
    """A file's header lacks a declared column."""


class MissingInputError(FileNotFoundError):
    """An input path does not exist (run the pipeline that produces it first)."""


def _guard(read, path: str, what: str) -> DataFrame:
    try:
        return read(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise MissingInputError(f"{what} not found at {path!r}; run the pipeline first.") from e
        raise


def _header(spark: SparkSession, path: str, what: str) -> list[str]:
    """The column names in the first line that the files have; none if they have no line."""
    names = spark.read.option("header", "true").option("inferSchema", "false")
    try:
        return _guard(names.csv, path, what).columns
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" in str(e):  # no file, or only hidden ones
            return []
        raise


def _bound(header: list[str], schema: StructType, what: str) -> tuple[StructType, list[tuple[str, str]]]:
    """The schema in the header's order, and each declared column with its name in the file.
    Columns that are not declared are strings and not read."""
    spelled = {name.lstrip("\ufeff").strip().lower(): name for name in reversed(header)}
    declared = {f.name.lower(): f for f in schema.fields}
    missing = [f.name for f in schema.fields if f.name.lower() not in spelled]
    if missing:
        raise HeaderError(f"{what}: no column {', '.join(missing)} in the header ({', '.join(header)})")
    of = {spelled[k]: f for k, f in declared.items()}
    order = [StructField(n, of[n].dataType if n in of else StringType(), True) for n in header]
    return StructType(order), [(f.name, spelled[f.name.lower()]) for f in schema.fields]


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    mode: str = "PERMISSIVE",
    what: str = "input",
    corrupt: str | None = None,
) -> DataFrame:
    """The declared columns of CSV files, bound by the names in their header: in whatever order
    they stand there, and whatever columns stand between them (capitals, blanks around a name
    and a byte order mark don't matter). A declared column that the header lacks is refused
    here; a file whose header differs from the first one's is refused when it is read. Files
    without any line give no rows. ``corrupt`` adds a column with the lines that don't parse.
    """
    header = _header(spark, path, what)
    in_file, names = _bound(header, schema, what) if header else (schema, [(n, n) for n in schema.fieldNames()])
    if corrupt:
        in_file, names = in_file.add(corrupt, StringType()), [*names, (corrupt, corrupt)]
    reader = (
        spark.read.schema(in_file)
        .option("header", "true")
        .option("enforceSchema", "false")  # the header of every file is compared with the names
        .option("mode", mode)
        .option("dateFormat", "yyyy-MM-dd")
    )
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    read = _guard(reader.csv, path, what)
    return read.select(*[F.col(f"`{at}`").alias(name) for name, at in names])


CORRUPT = "_corrupt_record"


def read_raw_csv(spark: SparkSession, path: str, mode: str = "PERMISSIVE", with_corrupt: bool = False) -> DataFrame:
    """Raw 13-column transactions. In PERMISSIVE mode a malformed field becomes NULL; with
    ``with_corrupt`` the line it stood in comes along as ``_corrupt_record``, for
    :func:`quarantine`."""
    return read_csv(spark, path, RAW_SCHEMA, mode, "raw transactions", CORRUPT if with_corrupt else None)


# Why a raw row is set aside, in the order in which it is asked.
REASONS = ("corrupt_record", "missing_id", "hour_out_of_range")


def rejection(df: DataFrame) -> Column:
    """The reason why a raw row is set aside; NULL for a good row."""
    why = F.when(F.col("transaction_id").isNull(), REASONS[1]).when(~F.col("hour").between(0, 23), REASONS[2])
    return F.when(F.col(CORRUPT).isNotNull(), REASONS[0]).otherwise(why) if CORRUPT in df.columns else why


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)`` raw rows; the rejected ones with their ``reason`` and, if it was
    read, the corrupt line."""
    marked = df.withColumn("reason", rejection(df))
    return marked.where(F.col("reason").isNull()).drop("reason", CORRUPT), marked.where(F.col("reason").isNotNull())


def read_cleaned_csv(spark: SparkSession, path: str) -> DataFrame:
    """The exported cleaned fact, with ``date`` parsed by the declared schema."""
    return read_csv(spark, path, CLEAN_SCHEMA, what="processed data")


def read_cleaned_parquet(spark: SparkSession, path: str) -> DataFrame:
    df = _guard(spark.read.schema(CLEAN_SCHEMA).parquet, path, "processed data")
    return df.select(*CLEAN_SCHEMA.fieldNames())


def read_footers(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet rows, for aggregates that the files' footers answer: ``count`` of rows or of a
    column, ``min`` and ``max`` of numbers and dates, grouped by partition columns at most. Such
    an aggregate reads no row group; any other query on the frame reads it as usual.

    The Parquet source takes aggregates only where it is read by its newer interface, which a
    session chooses; so the frame belongs to a session of its own, beside the caller's (same
    application, executors and catalog)."""
    own = spark.newSession()
    v1 = own.conf.get("spark.sql.sources.useV1SourceList").split(",")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(f for f in v1 if f.strip() != "parquet"))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return _guard(own.read.schema(schema).parquet, path, "Parquet input")


def read_summary(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """A published summary table, or None when it has not been written."""
    try:
        return read_csv(spark, path, SUMMARY_SCHEMAS[name], what=name)
    except MissingInputError:
        return None


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", "true").option("dateFormat", "yyyy-MM-dd").csv(path)
    return path


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    mode: str = "overwrite",
    cluster_by: tuple[str, ...] = (),
    sort_by: tuple[str, ...] = (),
    bloom: tuple[str, ...] = (),
) -> str:
    """With ``partition_by`` the rows are first rebalanced by that column (and ``cluster_by``):
    adaptive execution packs small values together and splits large ones, so a value gets a few
    files of the advisory size instead of one per task. ``sort_by`` orders the rows of a file,
    so that its row groups, and the pages in them, have narrow ranges of those columns, which a
    reader skips by their statistics; ``bloom`` columns get Bloom filters, for ``=`` and ``in``."""
    return write_laid_out(clustered(df, partition_by, cluster_by, sort_by), path, partition_by, mode, bloom)


def clustered(
    df: DataFrame, partition_by: str | None = None, cluster_by: tuple[str, ...] = (), sort_by: tuple[str, ...] = ()
) -> DataFrame:
    """Rows rebalanced and ordered as :func:`write_parquet` lays them out. Columns that are not
    needed for it are better derived from these rows: then they are neither moved nor sorted."""
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in (partition_by, *cluster_by)])
    if sort_by:
        df = df.sortWithinPartitions(*([partition_by] if partition_by else []), *sort_by)
    return df


def write_laid_out(
    df: DataFrame, path: str, partition_by: str | None = None, mode: str = "overwrite", bloom: tuple[str, ...] = ()
) -> str:
    """Writes rows as they come, from :func:`clustered`."""
    writer = df.write.mode(mode)
    for c in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return path


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns) of a frame as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("num_rows")).withColumn("num_columns", F.lit(len(df.columns)))
