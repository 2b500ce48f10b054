"""Importance resampling towards a target: the documents whose words the target favours, by lot.

Features are all runs of 1 to ``max_run`` consecutive words, hashed to ``buckets``. A bucket's gain is
the logarithm of its smoothed share in the target over that in the documents. A document's weight is
the floored mean of the gains of its features; its score adds a Gumbel number drawn from its id, so
that the highest scores are a draw without replacement with odds by weight.

Weights. Each text is cut once; what is kept is the array of its buckets, two or four bytes a feature.
Counting and weighing read these arrays: counts are added up per batch, then by bucket, and a weight is
one look-up of the array in the array of gains, which has ``buckets`` entries whatever the input.

Draw. The k highest of N composite keys (score down, id up) are found by distributed quickselect.
Each round draws random pivot keys among the rows between the current bounds, partitions these rows in
three ways at them (below, at, above; all pivots at once) and counts each part exactly. Only pivots and
counts reach the driver. The part that holds the k-th key becomes the next range; it loses at least a
pivot each round, and a part at a pivot ends the search, so that ties need no further rounds. Winners alone are sorted, by ranges, and ranked by the
sizes of the ranges before them. Nothing is approximate.

Scale: one pass over the texts, no shuffle of them; the rounds read (id, score) only and push the bounds
into the scan. No row meets another, so no key is hot.

Defined cases: null text is empty text; documents without features have weight 0; only documents with
``least_words`` words take part in the draw, the others have a score and no rank; a null id is drawn
like the text ``null`` and ranked like the largest id there can be; rows that share an id have equal
draws and are ranked as rows of their own, in any order among equal scores; an empty target or no
documents are fine; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rootweave.llm.common import arrow_batches
from rootweave.workspace import Workspace

# Words of this operator: what stands between ASCII characters that are neither digits nor letters.
FEATURE_WORD = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
MEMO = 200_000  # hashes kept per task; results do not depend on it
PIVOTS = 15


class _Buckets(dict):
    """Bucket by word, or by run of words."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        found = self[feature] = zlib.crc32(feature.encode()) % self.buckets
        return found


def _cut(texts: DataFrame, max_run: int, buckets: int) -> DataFrame:
    """(_id, n_words, held): the buckets of all features as an array of little-endian numbers, for ``texts(_id, _text)``."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    kind = _width(buckets)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, bucket = re.compile(FEATURE_WORD).findall, _Buckets(buckets)
        for batch in batches:
            n_words, held = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                words = find(text.lower() if text.isascii() else text.translate(lower))
                n_words.append(len(words))
                runs = [words] + [[" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] for n in range(2, max_run + 1)]
                held.append(np.array([bucket[x] for run in runs for x in run], kind).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(held, pa.binary())], names=["_id", "n_words", "held"]
            )

    return texts.mapInArrow(rows, "_id long, n_words long, held binary")


def _width(buckets: int) -> np.dtype:
    return np.dtype("<u2" if buckets <= 1 << 16 else "<u4")


def _totals(cut: DataFrame, buckets: int) -> np.ndarray:
    """How many features each bucket has. The result has ``buckets`` numbers."""
    kind = _width(buckets)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for held in batch.column(0):
                total += np.bincount(np.frombuffer(held.as_py(), kind), minlength=buckets)
        (some,) = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    found = cut.select("held").mapInArrow(rows, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(buckets, np.int64)
    for row in found:
        total[row["bucket"]] = row["n"]
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of the smoothed share in the target over that in the source, floored."""
    buckets, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
        for s, t in zip(source.astype(float), target.astype(float))
    ], np.int64)


def _weight(cut: DataFrame, gain: np.ndarray, buckets: int) -> Column:
    shared, kind = cut.sparkSession.sparkContext.broadcast(gain), _width(buckets)

    @F.arrow_udf("long")
    def weigh(held: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in held:
            out = []
            for one in batch:
                features = np.frombuffer(one.as_py(), kind)
                out.append(int(shared.value[features].sum()) // len(features) if len(features) else 0)
            yield pa.array(out, pa.int64())

    return weigh("held")


def gumbel(seed: int, doc_id: str) -> Column:
    """Thousandths of a Gumbel number that the seed and the id decide, floored."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


# The composite key, smallest first: score down, then id up, null as the largest id.
KEY = ["-score AS s", f"coalesce(_id, {(1 << 63) - 1}) AS i"]


def _below(cut: tuple[int, int], at_too: bool = False) -> str:
    s, i = cut
    return f"(s < {s} OR s = {s} AND i {'<=' if at_too else '<'} {i})"


def select_kth(rows: DataFrame, k: int, pivots: int = PIVOTS) -> tuple[int, int]:
    """The k-th smallest key of ``rows(score, _id)``, from 1; there must be at least k rows."""
    low = high = None  # exclusive bounds
    below = 0  # keys that are not above ``low``
    turn = 0
    while True:
        kept = rows
        if low is not None:  # the comparisons with the score alone reach the Parquet reader
            kept = kept.filter(f"score <= {-low[0]}")
        if high is not None:
            kept = kept.filter(f"score >= {-high[0]}")
        kept = kept.selectExpr(*KEY)
        if low is not None:
            kept = kept.filter(f"NOT {_below(low, at_too=True)}")
        if high is not None:
            kept = kept.filter(_below(high))
        drawn = kept.select("s", "i", F.xxhash64("s", "i", F.lit(turn)).alias("lot")).orderBy("lot").limit(pivots).collect()
        cuts = sorted({(row["s"], row["i"]) for row in drawn})
        # Even parts lie between two pivots, odd ones are the rows at a pivot.
        cases = [f"WHEN {_below(c)} THEN {2 * j} WHEN s = {c[0]} AND i = {c[1]} THEN {2 * j + 1}" for j, c in enumerate(cuts)]
        part = F.expr(f"CASE {' '.join(cases)} ELSE {2 * len(cuts)} END") if cuts else F.lit(0)
        sizes = kept.groupBy(part.alias("part")).count().collect()
        for number, n in sorted(map(tuple, sizes)):
            if below + n >= k:
                break
            below += n
        else:
            raise ValueError(f"there is no key number {k}")
        if number % 2:
            return cuts[number // 2]
        low = cuts[number // 2 - 1] if number else low
        high = cuts[number // 2] if number // 2 < len(cuts) else high
        turn += 1


def ranked(winners: DataFrame, k: int, ws: Workspace) -> DataFrame:
    """``winners`` with ``rank`` 1 to k in the order of their keys; rows beyond k, ties of the last, have none.

    Rows are dealt to ranges and sorted there; a row's rank is its place in its range plus the sizes of the ranges before.
    """
    width = int(winners.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = winners.selectExpr("*", *KEY).repartitionByRange(width, "s", "i").sortWithinPartitions("s", "i").drop("s", "i")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = ws.stage(dealt.withColumn("_range", F.spark_partition_id()).withColumn("_place", place), "winners")
    # One row a range; their number is that of the shuffle's partitions.
    sizes = placed.groupBy("_range").count()
    before = sizes.select("_range", (F.sum("count").over(Window.orderBy("_range")) - F.col("count")).alias("_before"))
    rank = F.col("_before") + F.col("_place") + 1
    return placed.join(F.broadcast(before), "_range").withColumn("rank", F.when(rank <= k, rank)).drop("_range", "_place", "_before")


def resample(
    docs: DataFrame, target: DataFrame, ws: Workspace, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
    max_run: int = 1, buckets: int = 10_000, seed: int = 2024, least_words: int = 20, percent: int = 10, pivots: int = PIVOTS,
) -> DataFrame:
    """(``id_col``, n_features, weight, score, rank) for every row of ``docs``, all long.

    ``percent`` of the documents with ``least_words`` words are drawn (rounded down) and ranked from 1 by falling
    score; the others have no rank. Ids are whole numbers.
    """
    spark = docs.sparkSession
    with arrow_batches(spark):
        own = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
        cut = ws.stage(_cut(own, max_run, buckets), "cut")
        aims = _cut(target.select(F.lit(None).cast("long").alias("_id"), F.col(target_col).alias("_text")), max_run, buckets)
        gain = gains(_totals(cut, buckets), _totals(aims, buckets))
        weighed = cut.select("_id", "n_words", (F.octet_length("held") / _width(buckets).itemsize).cast("long").alias("n_features"), _weight(cut, gain, buckets).alias("weight"))
        scored, seen = ws.stage_counted(
            weighed.withColumn("score", F.col("weight") + gumbel(seed, "_id")), "scored", able=F.count_if(F.col("n_words") >= least_words)
        )
    able = F.col("n_words") >= least_words
    k = percent * seen["able"] // 100
    plain = [F.col("_id").alias(id_col), "n_features", "weight", "score"]
    if not k:
        return scored.select(*plain, F.lit(None).cast("long").alias("rank"))
    last = select_kth(scored.filter(able), k, pivots)
    keyed = scored.selectExpr("*", *KEY)
    won = able & F.expr(_below(last, at_too=True))
    winners = ranked(keyed.filter(won).drop("s", "i"), k, ws)
    return winners.select(*plain, "rank").unionByName(keyed.filter(~won).select(*plain, F.lit(None).cast("long").alias("rank")))
