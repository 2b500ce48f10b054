"""Delimited text files to Parquet tables, and readable previews of tables."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping
from functools import reduce
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from rootweave.functions.rules import table_name_of
from rootweave.workspace import Workspace


def list_inputs(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """(path, table_name) of the files in a folder, on any file system Spark can read.

    A missing folder and a folder without such files are errors.
    """
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(fs_path):
        raise FileNotFoundError(f"input folder does not exist: {folder}")
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(fs_path, pattern))
    paths = sorted(status.getPath().toString() for status in found)
    if not paths:
        raise FileNotFoundError(f"no {pattern} files in {folder}")
    files = spark.createDataFrame([(p, PurePosixPath(p).stem) for p in paths], "path string, stem string")
    return files.select("path", table_name_of(F.col("stem")).alias("table_name"))


def read_delimited(
    spark: SparkSession, path: str, schema: StructType | str | None = None, sep: str = "\t"
) -> DataFrame:
    """One delimited file (or a folder of parts) with a header.

    Without a schema the types are inferred, which reads the data twice. With one, the header must
    name its columns in order, and a value that does not fit its type fails the read.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)


def _distinct_inputs(spark: SparkSession, folder: str, pattern: str) -> list[tuple[str, str]]:
    """(path, table name) of the matching files, which must not lead to one table twice."""
    inputs = [tuple(row) for row in list_inputs(spark, folder, pattern).collect()]
    if clashes := [name for name, n in Counter(name for _, name in inputs).items() if n > 1]:
        raise ValueError(f"several files for one table: {', '.join(sorted(clashes))}")
    return inputs


def ingest_folder(
    spark: SparkSession,
    folder: str,
    database: str,
    schemas: Mapping[str, StructType | str] | None = None,
    sep: str = "\t",
    pattern: str = "*.csv",
) -> list[str]:
    """Load every matching file of a folder into ``database`` as a Parquet table each.

    Two files whose names lead to the same table are an error; nothing is loaded then.
    """
    schemas = schemas or {}
    tables = []
    for path, name in _distinct_inputs(spark, folder, pattern):
        table = f"{database}.{name}"
        read_delimited(spark, path, schemas.get(name), sep).write.mode("overwrite").format("parquet").saveAsTable(table)
        tables.append(table)
    return tables


CORRUPT = "_corrupt_record"
REJECTS = "__rejects"
REJECT_SCHEMA = "file STRING, line STRING"


def ingest_with_rejects(
    spark: SparkSession, folder: str, database: str, schemas: Mapping[str, StructType | str], ws: Workspace,
    sep: str = "\t", pattern: str = "*.csv",
) -> DataFrame:
    """Load a folder like :func:`ingest_folder`, but set lines aside that do not fit their schema instead of failing.

    A line with too few or too many fields, or with a value that is not of its type, goes whole to the table
    ``<name>__rejects(file, line)``. Returns (table_name, file, loaded, rejected), counted while each part of
    a file is parsed, which happens once; loaded and rejected add up to the lines below the headers that are not blank.
    """
    inputs = _distinct_inputs(spark, folder, pattern)
    if unknown := [name for _, name in inputs if name not in schemas]:
        raise ValueError(f"no schema for {', '.join(sorted(unknown))}")
    reports = []
    for path, name in inputs:
        kind = spark.createDataFrame([], schemas[name]).schema
        reader = spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", False)
        parsed = reader.schema(StructType([*kind.fields, StructField(CORRUPT, StringType())])).csv(path)
        rows = ws.stage(parsed.select("*", F.col("_metadata.file_path").alias("_file")), "parsed")
        write = {
            name: rows.filter(F.col(CORRUPT).isNull()).select(*kind.names),
            name + REJECTS: rows.filter(F.col(CORRUPT).isNotNull()).select(F.col("_file").alias("file"), F.col(CORRUPT).alias("line")),
        }
        for table, df in write.items():
            df.write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{table}")
        reports.append(rows.groupBy(F.col("_file").alias("file")).agg(
            F.count_if(F.col(CORRUPT).isNull()).alias("loaded"), F.count_if(F.col(CORRUPT).isNotNull()).alias("rejected")
        ).select(F.lit(name).alias("table_name"), "file", "loaded", "rejected"))
    return reduce(DataFrame.unionByName, reports)


def load_report(spark: SparkSession, tables: list[str]) -> DataFrame:
    """(table_name, row_count) per table, counted in one job."""
    counts = [
        spark.table(t).agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(t.split(".")[-1]).alias("table_name"), "row_count")
        for t in tables
    ]
    return reduce(DataFrame.unionByName, counts)


def temporal_to_string(df: DataFrame) -> DataFrame:
    """Show dates and timestamps as text, so that far-future sentinels survive any client."""
    temporal = (DateType, TimestampType, TimestampNTZType)
    return df.select(
        *[F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, temporal) else f.name
          for f in df.schema.fields]
    )


def preview(df: DataFrame, order_by: list[str], limit: int = 50) -> DataFrame:
    """The first rows in a stable order, readable in any client."""
    return temporal_to_string(df.orderBy(*order_by).limit(limit))
