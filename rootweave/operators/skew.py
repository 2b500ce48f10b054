"""Joins that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, TimestampNTZType, TimestampType

from rootweave.workspace import ROWS_PER_TASK, Workspace


# A key is hot when it holds more than one part in HOT_SHARE of all rows, or more rows than a task
# should have. There are at most HOT_SHARE, or rows / ROWS_PER_TASK, hot keys: a list to broadcast.
HOT_SHARE = 256
# Rows of a hot key are spread over this many groups, or more if these had more rows than a task should have.
SALTS = 64
# Key lists up to this many rows are broadcast outright.
BROADCAST_ROWS = 500_000
# A longer list is first broadcast as a filter of so many bits a key, in 64-bit words, of which there are at most MOST_WORDS.
# Rows it lets through are joined with the list itself, so a full filter costs time and nothing else.
FILTER_BITS = 8
MOST_WORDS = 1 << 19
# Items a sketch tracks for each key that may be hot; what it then misses of a count is far below the limit.
TRACKED = 16
SKETCHED = (DateType, IntegerType, LongType, StringType, TimestampNTZType, TimestampType)


def hot_limit(rows: int) -> int:
    return max(min(rows // HOT_SHARE, ROWS_PER_TASK), SALTS)


def salt_groups(count: str) -> Column:
    """``_groups``: over how many groups a key with ``count`` rows is spread."""
    return F.greatest(F.lit(SALTS), F.ceil(F.col(count) / ROWS_PER_TASK).cast("int")).alias("_groups")


def hot_keys(df: DataFrame, key: str, rows: int) -> DataFrame:
    """(key, groups) of the keys that hold more than their share of the ``rows`` rows of ``df``; mostly none.

    They are found by a sketch of frequent items, so no row is shuffled. Its counts are never too low: no hot key is missed, and
    one that is listed though it falls just short is spread without need. Nulls are left out, since they join with nothing.
    """
    if isinstance(df.schema[key].dataType, SKETCHED):
        most = 2 * max(HOT_SHARE, rows // ROWS_PER_TASK)
        top = F.call_function("approx_top_k", F.col(key), F.lit(most), F.lit(TRACKED * most))
        counts = df.filter(F.col(key).isNotNull()).agg(top.alias("top")).select(F.inline("top")).withColumnRenamed("item", key)
    else:
        counts = df.groupBy(key).count()
    return counts.filter(F.col("count") > hot_limit(rows)).select(key, salt_groups("count"))


def skew_join(big: DataFrame, other: DataFrame, key: str, hot: DataFrame | None, how: str = "inner") -> DataFrame:
    """Join ``big`` with ``other`` on ``key``, spreading the hot keys.

    Rows of ``big`` with a hot key are dealt to groups by a hash of the row, which is
    the same on every retry; the matching rows of ``other`` are copied to each group.
    A list without ``_groups`` (see :func:`hot_keys`) means SALTS groups a key. All other keys join as usual. ``how`` is inner, left, left_semi or
    left_anti. The size of ``hot`` is bounded, see :func:`hot_keys`; None says that
    counting has shown that there is no hot key.
    """
    if hot is None:
        return big.join(other, key, how)
    groups = F.col("_groups") if "_groups" in hot.columns else F.lit(SALTS)
    marks = F.broadcast(hot.select(key, groups.alias("_hot")))
    dealt = big.join(marks, key, "left").withColumn(
        "_salt",
        F.when(F.col("_hot") > 0, F.pmod(F.xxhash64(*big.columns), F.col("_hot")).cast("int")).otherwise(F.lit(0)),
    )
    copied = other.join(marks, key, "left").withColumn(
        "_salt",
        F.explode(F.sequence(F.lit(0), F.coalesce("_hot", F.lit(1)) - 1)),
    )
    return dealt.drop("_hot").join(copied.drop("_hot"), [key, "_salt"], how).drop("_salt")


class Keys(NamedTuple):
    """A one-column list without duplicates, and a number that its length cannot exceed."""

    frame: DataFrame
    rows: int


def stage_keys(df: DataFrame, ws: Workspace, label: str) -> Keys:
    frame, counted = ws.stage_counted(df.distinct(), label)
    return Keys(frame, counted["rows"])


def may_hold(keys: Keys, key: str) -> DataFrame:
    """(_word, _bits): a bitmap of the hashes of a long list, to be broadcast."""
    size = _words(keys)
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(64 * size))
    placed = keys.frame.filter(F.col(key).isNotNull()).select(
        F.shiftright(place, 6).alias("_word"), F.expr("1L").alias("_one"), place.bitwiseAND(F.lit(63)).cast("int").alias("_place"))
    return placed.groupBy("_word").agg(F.bit_or(F.expr("shiftleft(_one, _place)")).alias("_bits"))


def _words(keys: Keys) -> int:
    return max(1, min(MOST_WORDS, keys.rows * FILTER_BITS // 64))


def marked(big: DataFrame, keys: Keys, key: str) -> DataFrame:
    """``big`` with ``_maybe``: false where the key is certainly not in the long list ``keys``. No row is shuffled."""
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(64 * _words(keys)))
    placed = big.withColumns({"_word": F.shiftright(place, 6), "_place": place.bitwiseAND(F.lit(63)).cast("int")})
    found = placed.join(F.broadcast(may_hold(keys, key)), "_word", "left")
    maybe = F.coalesce(F.expr("shiftrightunsigned(_bits, _place) & 1") == 1, F.lit(False))
    return found.select(*big.columns, maybe.alias("_maybe"))


def semi_join(big: DataFrame, keys: Keys, key: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``big`` whose key is in ``keys``.

    A list known to be short is broadcast, so ``big`` is not moved at all. Of a long one a filter is broadcast; only rows that
    pass it are joined with the list by shuffle, with the hot keys spread, and the others are settled where they are.
    """
    if keys.rows <= BROADCAST_ROWS:
        return big.join(F.broadcast(keys.frame), key, how)
    if dict(big.dtypes)[key] != dict(keys.frame.dtypes)[key]:  # equal values of other types have other hashes
        return skew_join(big, keys.frame, key, hot_keys(big, key, big.count()), how)
    seen = marked(big, keys, key)
    near = seen.filter("_maybe").drop("_maybe")
    joined = skew_join(near, keys.frame, key, hot_keys(near, key, big.count()), how)
    if how == "left_semi":
        return joined
    return joined.unionByName(seen.filter("NOT _maybe").drop("_maybe"))


def anti_join(big: DataFrame, keys: Keys, key: str) -> DataFrame:
    """Rows of ``big`` whose key is not in ``keys``; see :func:`semi_join`."""
    return semi_join(big, keys, key, "left_anti")
