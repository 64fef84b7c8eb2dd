"""Writing tables: partition replacement, appends, new versions, clustering, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from rosterline.functions.columns import file_safe
from rosterline.workspace import committed_children, sized


def replace_partitions(
    df: DataFrame, path: str, partition_cols: list[str], file_format: str = "parquet", rebalance: bool = True, **options
) -> None:
    """Replaces exactly the partitions that occur in ``df``; other partitions stay.

    Rows are rebalanced by partition value: a small partition gets one file, and the
    adaptive planner splits a partition that holds much of the data over many tasks.
    ``rebalance=False`` is for rows that the caller has dealt out and sorted, or of one partition only.
    ``options`` are the writer's, such as ``compression``.
    """
    (
        (df.hint("rebalance", *partition_cols) if rebalance else df)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols).format(file_format).options(**options).save(path)
    )


def append(df: DataFrame, path: str, partition_cols: list[str] | None = None) -> None:
    writer = df.write.mode("append")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)


def read_evolved(spark: SparkSession, path: str, declared: StructType | str | None = None) -> DataFrame:
    """A table whose later files have more columns; missing values are NULL.

    With the ``declared`` schema no file is opened to find the columns; without it all are.
    """
    if declared is not None:
        return spark.read.schema(declared).parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def write_version(df: DataFrame, base: str, columns: list[str] | None = None) -> int:
    """Writes a whole table, with whatever schema, as the next version below ``base``.

    The job may read the version before. ``columns`` puts them by name in the target's
    order. A version counts only once its job is committed, so readers never see half.
    """
    versions = committed_children(df.sparkSession, base, "version=")
    number = (versions[-1] if versions else 0) + 1
    (df.select(*columns) if columns else df).write.mode("overwrite").parquet(f"{base}/version={number}")
    return number


def read_version(spark: SparkSession, base: str, number: int | None = None) -> DataFrame:
    """The newest committed version, or the one given."""
    if number is None:
        versions = committed_children(spark, base, "version=")
        if not versions:
            raise FileNotFoundError(f"no committed version below {base}")
        number = versions[-1]
    return spark.read.parquet(f"{base}/version={number}")


def compact(df: DataFrame, path: str, keys: list[str], files: int | None = None) -> None:
    """Rewrites a table in few files, clustered by ``keys`` for file skipping.

    A hash of the row is the last clustering column, so one hot key is cut over many files.
    """
    spread = F.xxhash64(*df.columns)
    ordered = df.repartitionByRange(files, *keys, spread) if files else df.repartitionByRange(*keys, spread)
    ordered.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def report_folder(title: Column, shared: Column) -> Column:
    """A folder name: the file-safe title, with a hash of the title where that alone would not tell titles apart.

    ``shared`` says that another title has the same file-safe form. A title of nothing but
    removed characters, an empty and a NULL title have names too.
    """
    safe = F.coalesce(file_safe(title), F.lit(""))
    digest = F.left(F.sha2(F.coalesce(F.concat(F.lit("="), title), F.lit("")).cast("binary"), 256), F.lit(8))
    return F.when(safe == "", F.concat(F.lit("untitled-"), digest)).when(shared, F.concat_ws("-", safe, digest)).otherwise(safe)


def write_per_report(df: DataFrame, path: str, title: str) -> None:
    """One folder per report title; see :func:`report_folder`.

    A title gets the hash in its name when several titles of the table share a file-safe form, so rows
    of two reports never mix.
    """
    titles = df.select(F.col(title).alias("__title")).distinct().withColumn("__safe", F.coalesce(file_safe(F.col("__title")), F.lit("")))
    forms = titles.groupBy("__safe").agg(F.count(F.lit(1)).alias("__titles"))
    named = titles.join(forms, "__safe").select("__title", report_folder(F.col("__title"), F.col("__titles") > 1).alias("__report"))
    named = sized(named, "report-names")
    met = df.join(named, F.col(title).eqNullSafe(F.col("__title")), "left")
    replace_partitions(met.drop("__title").withColumnRenamed("__report", "report"), path, ["report"])
