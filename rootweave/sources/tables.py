"""Operations on catalog tables whose files cannot be changed in place."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rootweave.sources.fs import Folder
from rootweave.workspace import count_while_writing

STAGING = "__staging"
OLD = "__old"
BASELINE = "__baseline"


def ensure_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def ensure_table(spark: SparkSession, table: str, schema: StructType | str, partition: str | None = None) -> None:
    """Create an empty Parquet table with the given columns, one of which may partition it, unless it exists."""
    if isinstance(schema, StructType):
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = f" PARTITIONED BY (`{partition}`)" if partition else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING PARQUET{by}")


def create_as_select(spark: SparkSession, table: str, query: str) -> DataFrame:
    spark.sql(f"CREATE TABLE {table} USING PARQUET AS {query}")
    return spark.table(table)


def write_table(df: DataFrame, table: str) -> None:
    """Create or overwrite a Parquet table. It must not be one that ``df`` reads."""
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def append_rows(df: DataFrame, table: str) -> None:
    """Append by column name; columns are cast to the types of the table."""
    target = df.sparkSession.table(table).schema
    df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields]).write.insertInto(table)


def insert_if_absent(df: DataFrame, table: str, keys: list[str]) -> None:
    """Append the rows whose key the table does not have yet; safe to repeat.

    A null in a key equals a null. Of several new rows with one key the smallest is taken, null first,
    so columns must be of types that can be ordered.
    """
    known = df.sparkSession.table(table).select(*[F.col(k).alias(f"_known_{i}") for i, k in enumerate(keys)])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_known_{i}")) for i, k in enumerate(keys)])
    first = df.groupBy(*keys).agg(F.min(F.struct(*df.columns)).alias("_row")).select("_row.*")
    append_rows(first.join(known, same, "left_anti"), table)


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def drop_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}").select(F.col("tableName").alias("table_name"))


def use_database(spark: SparkSession, database: str) -> str:
    """Make a database the current one; the name of the one before."""
    before = spark.catalog.currentDatabase()
    spark.sql(f"USE {database}")
    return before


def swap_replace(spark: SparkSession, table: str, df: DataFrame) -> None:
    """Replace all rows of a table, possibly by rows computed from it.

    The new rows are written beside the table first. The old table is renamed away
    before the new one takes its name, so at any moment one complete version is left;
    :func:`recover_swap` puts things right after a crash in between.
    """
    stage_replacement(spark, table, df)
    finish_swap(spark, table)


def stage_replacement(spark: SparkSession, table: str, df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """First half of a swap: write the new rows to the staging table, counting them."""
    drop_table(spark, table + STAGING)
    counted, seen = count_while_writing(df, **metrics)
    counted.write.format("parquet").saveAsTable(table + STAGING)
    return spark.table(table + STAGING), seen.get


def finish_swap(spark: SparkSession, table: str) -> None:
    """Second half of a swap: let the staging table take over the name."""
    drop_table(spark, table + OLD)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {table + OLD}")
    spark.sql(f"ALTER TABLE {table + STAGING} RENAME TO {table}")
    drop_table(spark, table + OLD)
    spark.catalog.refreshTable(table)


def recover_swap(spark: SparkSession, table: str) -> None:
    """Undo or tidy up a swap that was cut short."""
    if not spark.catalog.tableExists(table) and spark.catalog.tableExists(table + OLD):
        spark.sql(f"ALTER TABLE {table + OLD} RENAME TO {table}")
    drop_table(spark, table + OLD)
    drop_table(spark, table + STAGING)


def swap_transform(spark: SparkSession, table: str, transform: Callable[[DataFrame], DataFrame]) -> None:
    """Replace a table by a DataFrame function of itself."""
    swap_replace(spark, table, spark.table(table).transform(transform))


UPDATING = "_update.json"
UPDATED = "_updated"


def update_where(spark: SparkSession, table: str, column: str, condition: Column, value: Column) -> int:
    """UPDATE ... SET column = value WHERE condition. Rows with a NULL condition stay.

    Only files that hold a row to change are rewritten, the others are not touched; returns how many were. The new
    files are complete before a small file announces the exchange; if it is cut short, :func:`recover_update` completes
    it. Partitioned tables are replaced as a whole.
    """
    recover_update(spark, table)
    changed = lambda df: df.withColumn(column, F.when(condition, value.cast(df.schema[column].dataType)).otherwise(F.col(column)))
    df = spark.table(table)
    hit = df.filter(condition).select("_metadata.file_path").distinct()
    files = [row[0] for row in hit.collect()]  # names of files, not rows
    if not files:
        return 0
    location, partitioned = table_location(spark, table)
    if partitioned:
        swap_replace(spark, table, changed(df))
        return len(files)
    folder = Folder(spark, location)
    folder.delete(UPDATED)
    # Rows of a file stay together, so that a small change does not spread over many files.
    changed(spark.read.schema(df.schema).parquet(*files)).write.mode("overwrite").parquet(f"{folder.path}/{UPDATED}")
    folder.save(UPDATING, [path.rpartition("/")[2] for path in files])
    recover_update(spark, table)
    return len(files)


def recover_update(spark: SparkSession, table: str) -> None:
    """Complete an update that was announced: its new files move in, the old ones go. Safe to repeat."""
    folder = Folder(spark, table_location(spark, table)[0])
    replaced = folder.load(UPDATING)
    if replaced is None:
        return
    for name in replaced:
        folder.delete(unquote(name))
    for name in Folder(spark, f"{folder.path}/{UPDATED}").names("part-*"):
        folder.move(f"{UPDATED}/{name}", name)
    folder.delete(UPDATING)
    folder.delete(UPDATED)
    spark.catalog.refreshTable(table)


def table_location(spark: SparkSession, table: str) -> tuple[str, bool]:
    """Where a table's files lie, and whether it is partitioned."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return rows["Location"], "# Partition Information" in rows


def snapshot_table(spark: SparkSession, table: str) -> str:
    """Keep a copy of a table as its baseline, replacing an older one."""
    swap_replace(spark, table + BASELINE, spark.table(table))
    return table + BASELINE


def restore_table(spark: SparkSession, table: str) -> None:
    """Bring a table back to its baseline."""
    swap_replace(spark, table, spark.table(table + BASELINE))


def reset_to_baseline(spark: SparkSession, tables: list[str], state_tables: list[str]) -> None:
    """Restore (or first take) the baselines and forget the state of earlier runs."""
    for table in tables:
        if spark.catalog.tableExists(table + BASELINE):
            restore_table(spark, table)
        else:
            snapshot_table(spark, table)
    for table in state_tables:
        drop_table(spark, table)


def empty_like(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """A relation with columns but no rows; a schema may come from its JSON form."""
    return spark.createDataFrame([], schema)


def rows_with_schema(spark: SparkSession, rows: list[tuple], schema_json: str) -> DataFrame:
    """A few given rows with a schema in its JSON form."""
    return spark.createDataFrame(rows, StructType.fromJson(json.loads(schema_json)))


def set_properties(spark: SparkSession, table: str, properties: dict[str, str]) -> None:
    pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def get_property(spark: SparkSession, table: str, name: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == name).collect()
    return rows[0].value if rows else None
