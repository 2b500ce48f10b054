"""What a refresh keeps between runs, in buckets of a hash of the rows.

* A **digest** per relation and bucket: how many rows its source has there and the sum of their hashes. Sums do
  not depend on the order of rows, so a scan with map-side sums finds the buckets that may have changed, and
  what moves is one row per task and bucket. Only buckets with another digest are read further.
* A **log** per relation, partitioned by bucket: rows with sign 1 when they came and -1 when they went. A run
  appends what changed. Once a bucket's log is longer than ``LONGEST`` times what it stands for, that bucket
  alone is rewritten.
* **Labels**, partitioned by bucket of the entity: a run overwrites the buckets it touches and no others.

Two sets of rows with one digest would be taken for equal: with 64 bits of sums beside the count that is
less likely than a fault of the disk that holds them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rootweave.sources.tables import append_rows
from rootweave.workspace import ROWS_PER_TASK, Workspace, count_while_writing, deal

BUCKET = "bucket"
LEAST_BUCKETS, MOST_BUCKETS = 16, 8_192
LONGEST = 2
SLICES = 8  # of a bucket when its log is first written
SLACK = 1_000  # rows of a log that are not worth a rewrite
OVERWRITE_SETTING = "spark.sql.sources.partitionOverwriteMode"
Digests = dict[tuple[str, int], tuple[int, int, int]]


def buckets_for(rows: int) -> int:
    """How many buckets: each should be work for one task. The number stays until the next full rebuild."""
    return max(LEAST_BUCKETS, min(MOST_BUCKETS, rows // ROWS_PER_TASK))


def bucket_of(columns: Iterable[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def with_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn(BUCKET, bucket_of(rows.columns, buckets))


def in_buckets(numbers: Iterable[int]) -> Column:
    """A test that prunes partitions where ``bucket`` is one."""
    return F.col(BUCKET).isin(sorted(numbers))


def digests(relations: Mapping[str, DataFrame], buckets: int) -> Digests:
    """Rows and hash sums by relation and bucket; the result is bounded by the number of buckets."""
    parts = []
    for name, rows in relations.items():
        h = F.xxhash64(*rows.columns, F.lit(name))
        parts.append(rows.select(
            F.lit(name).alias("relation"), bucket_of(rows.columns, buckets).alias(BUCKET),
            h.bitwiseAND(F.lit(0xFFFFFFFF)).alias("low"), F.shiftright(h, 32).alias("high"),
        ))
    found = reduce(DataFrame.unionByName, parts).groupBy("relation", BUCKET).agg(
        F.count(F.lit(1)).alias("n"), F.sum("low").alias("low"), F.sum("high").alias("high")
    )
    return as_digests(found)


def as_digests(table: DataFrame) -> Digests:
    return {(r["relation"], r[BUCKET]): (r["n"], r["low"], r["high"]) for r in table.collect()}


def digest_rows(spark: SparkSession, found: Digests) -> DataFrame:
    return spark.createDataFrame([(*key, *sums) for key, sums in found.items()], "relation string, bucket int, n bigint, low bigint, high bigint")


def changed_buckets(before: Digests, now: Digests, relations: Iterable[str]) -> list[int]:
    """Buckets in which one of the relations has another digest than before."""
    names = set(relations)
    return sorted({key[1] for key in before.keys() | now.keys() if key[0] in names and before.get(key) != now.get(key)})


def changes(log: DataFrame, rows: DataFrame, buckets: int, changed: list[int], ws: Workspace) -> tuple[DataFrame, dict]:
    """(..., sign, bucket): what came (1) and went (-1) in the changed buckets, staged, and how many rows of either kind.

    Both sides meet in one shuffle of their short texts, which are summed up by row.
    """
    columns = rows.columns
    now = with_bucket(rows, buckets).filter(in_buckets(changed)).select(*columns, F.lit(0).alias("sign"), F.lit(1).alias("now"))
    old = log.filter(in_buckets(changed)).select(*columns, "sign", F.lit(0).alias("now"))
    sums = old.unionByName(now).groupBy(*columns).agg(F.sum("sign").alias("was"), F.max("now").alias("now"))
    sign = (F.col("now") - F.col("was")).cast("int").alias("sign")
    moved = sums.filter(F.col("was") != F.col("now")).select(*columns, sign, bucket_of(columns, buckets).alias(BUCKET))
    return ws.stage_counted(moved, "changes", added=F.count_if(F.col("sign") > 0), removed=F.count_if(F.col("sign") < 0))


def whole_log(rows: DataFrame, buckets: int, number: int = 0) -> DataFrame:
    """The log of a relation that nothing is known of: its distinct rows, in one shuffle.

    A bucket is dealt in slices, so that no task gets several whole buckets. ``number`` is how many rows there are at most:
    if they are many, it decides on the tasks; what is short is merged by adaptive execution.
    """
    part = F.pmod(F.xxhash64(F.lit(2), *rows.columns), F.lit(SLICES)).cast("int")
    dealt = deal(with_bucket(rows, buckets).withColumn("_slice", part), number, BUCKET, "_slice")
    return dealt.distinct().drop("_slice").withColumn("sign", F.lit(1))


def compact(spark: SparkSession, table: str, touched: list[int]) -> list[int]:
    """Rewrite those of the touched buckets whose log has grown too long; which they were."""
    sizes = spark.table(table).filter(in_buckets(touched)).groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"), F.sum("sign").alias("net"))
    long = [r[BUCKET] for r in sizes.collect() if r["n"] > LONGEST * r["net"] + SLACK]
    if long:
        log = spark.table(table).filter(in_buckets(long))
        columns = [c for c in log.columns if c not in (BUCKET, "sign")]
        kept = log.groupBy(BUCKET, *columns).agg(F.sum("sign").cast("int").alias("sign")).filter("sign > 0")
        overwrite_buckets(kept, table, long)
    return long


def append_buckets(rows: DataFrame, table: str) -> None:
    append_rows(rows.repartition(BUCKET), table)


def overwrite_buckets(rows: DataFrame, table: str, touched: list[int]) -> None:
    """Replace the ``touched`` buckets of a table by ``rows``, which may be computed from it; other buckets keep their files."""
    spark = rows.sparkSession
    columns = spark.table(table).columns
    counted, seen = count_while_writing(rows.select(*columns), left=F.collect_set(BUCKET))
    with dynamic_overwrite(spark):
        counted.repartition(BUCKET).write.mode("overwrite").insertInto(table)
    for number in sorted(set(touched) - set(seen.get["left"])):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({BUCKET} = {number})")
    spark.catalog.refreshTable(table)


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(OVERWRITE_SETTING)
    spark.conf.set(OVERWRITE_SETTING, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_SETTING, before)
