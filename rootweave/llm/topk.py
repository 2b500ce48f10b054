"""Exact top-k by inner product over a bit-sliced index.

Components become whole numbers, floor(``scale`` * x), so that scores are exact.

Index. Vectors of one dimension are dealt to lanes by a hash of their id, and each lane is cut into
blocks. In a block each component is quantised to its highest ``bits`` bits above the block's minimum,
and kept as that many bitmaps over the rows (slices), beside the exact numbers and the norm of the
largest rounding error.

Search. A query's component is written in signed binary digits; each digit adds the slices of that
component, shifted, or their complements where the digit is negative. Bitmaps of one place value are
added three to two at a time (a full adder in bitmap arithmetic), which leaves one bitmap per bit of
the sum: the approximate scores of all rows of the block, up to a constant. In a lane's first block
counts of bits narrow, from the most significant slice downward, to the k-th largest sum; a second
descent marks the rows whose sum is not below it by more than twice the error bound (query norm times
the norm of the rounding error). Later blocks mark the rows whose sum can reach the k-th best score
found so far, which takes the error bound once. No other row can be among the best k, and ties of the
k-th are always marked. The marked rows are scored exactly, and the best k of all lanes are ranked.

Scale: a lane meets a chunk of queries in a tile. Vectors travel as single rows, sorted so that the
queries of a tile come first; a task then holds one chunk of queries with their best rows and one block,
both bounded in bytes, while the blocks of the lane pass by. No row that Spark handles is longer than a
vector, and no index is copied. With T tiles the vectors are sent once for each chunk and the queries
once for each lane; their numbers are chosen so that this grows with the root of T. Per lane and query k
rows go on, and ranks are cut before and after the last shuffle. The work is the number of queries times
the number of rows, a few word operations per 64 rows and slice, as the question asks for; nothing
depends on how many rows are alike.

Defined cases: vectors that are null or empty, hold null or non-finite components or components of
``LIMIT`` or more after scaling, and rows without id take no part; of rows that share an id the smallest
vector counts; vectors are compared with those of their own dimension only; with fewer than k
candidates all are returned; a query is not its own candidate; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rootweave.llm.common import arrow_batches
from rootweave.workspace import PARTITIONS_SETTING, Workspace

BITS = 6
BLOCK_BYTES = 8 << 20  # of a block's components at four bytes
CHUNK_BYTES = 32 << 20  # of a chunk of queries and their best rows
LEAST_CHUNK = 32  # queries that are worth a tile of their own
TILES_PER_CORE = 4
OUT_ROWS = 100_000  # in a batch of results
LIMIT = 1 << 26
DIGITS = 28  # binary digits of a component, and one for the carry


def _numbers(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(dim, _id, x): the vectors that take part, as whole numbers, one for each id."""
    c = F.transform(F.col(vector_col).cast("array<double>"), lambda v: v * scale)
    usable = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < LIMIT - 1))
    numbers = F.transform(c, lambda v: F.floor(v).cast("int"))
    taken = vectors.filter(usable & (F.size(vector_col) > 0) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("_id"), numbers.alias("x")
    )
    return taken.groupBy("_id").agg(F.min("x").alias("x")).select(F.size("x").alias("dim"), "_id", "x")


def _layout(sizes: DataFrame, k: int, tiles: int) -> DataFrame:
    """(dim, lanes, chunks) from ``sizes(dim, n, queries)``: some ``tiles`` a dimension, or more where chunks would be too large."""
    vector, n, queries = F.col("dim") * 4, F.col("n"), F.col("queries")
    by_size = F.ceil(queries * (vector + 16 * k) / CHUNK_BYTES)
    # The vectors are sent ``chunks`` times; the queries ``lanes`` times, and as often k rows of three numbers come back and are ranked.
    even = F.round(F.sqrt(tiles * queries * (vector + 48 * k) / (n * vector)))
    chunks = F.greatest(by_size, even, F.lit(1))
    lanes = F.greatest(F.least(F.ceil(n * vector / BLOCK_BYTES), F.ceil(tiles / chunks)), F.lit(1))
    spread = F.least(F.ceil(queries / LEAST_CHUNK), F.round(tiles / lanes))
    return sizes.select("dim", lanes.cast("int").alias("lanes"), F.greatest(chunks, spread).cast("int").alias("chunks"))


def _tiles(numbers: DataFrame, layout: DataFrame, asked: Column) -> DataFrame:
    """(dim, lane, chunk, asking, _id, x): each tile in one partition and in order, its queries (``asking``) before its vectors."""
    parts = layout.agg(F.max(F.col("lanes") * F.col("chunks"))).first()[0] or 1
    layout = F.broadcast(layout)
    each = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    dealt = lambda count, *seed: F.pmod(F.xxhash64("_id", *seed), F.col(count)).cast("int")
    numbers = numbers.join(layout, "dim")
    held = numbers.withColumn("lane", dealt("lanes")).withColumn("chunk", each("chunks")).withColumn("asking", F.lit(False))
    queries = numbers.filter(asked).withColumn("lane", each("lanes")).withColumn("chunk", dealt("chunks", F.lit(1))).withColumn("asking", F.lit(True))
    # Tiles of one dimension have partitions of their own.
    part = F.pmod(F.hash("dim").cast("long") + F.col("lane") * F.col("chunks") + F.col("chunk"), F.lit(parts)).cast("int")
    return (
        held.unionByName(queries).withColumn("part", part).repartitionById(parts, "part")
        .sortWithinPartitions("dim", "lane", "chunk", F.desc("asking")).select("dim", "lane", "chunk", "asking", "_id", "x")
    )


def signed_digits(x: np.ndarray) -> np.ndarray:
    """Digits -1, 0, 1 of whole numbers, lowest first, no two neighbours both set."""
    rest, out = x.astype(np.int64), np.zeros((len(x), DIGITS), np.int8)
    for j in range(DIGITS):
        odd = rest & 1
        digit = odd * (2 - (rest & 3))  # 1 before an even half, -1 before an odd one
        out[:, j] = digit
        rest = (rest - digit) >> 1
    return out


def add_bitmaps(places: dict[int, np.ndarray], words: int) -> list[np.ndarray]:
    """The sum of bitmaps, given as arrays (bitmap x word) by place value, as one bitmap per bit, lowest first."""
    total: list[np.ndarray] = []
    place, carried = 0, []
    last = max(places, default=-1)
    while place <= last or carried:
        held = [places[place]] if place in places else []
        column = np.concatenate(held + carried) if held or carried else np.zeros((1, words), np.uint64)
        carried = []
        while len(column) > 2:
            third = len(column) // 3
            a, b, c = column[:third], column[third : 2 * third], column[2 * third : 3 * third]
            differ = a ^ b
            carried.append((a & b) | (differ & c))
            column = np.concatenate([differ ^ c, column[3 * third :]])
        if len(column) == 2:
            carried.append(column[:1] & column[1:])
            column = column[:1] ^ column[1:]
        total.append(column[0])
        place += 1
    return total


def kth_sum(total: list[np.ndarray], rows: np.ndarray, k: int) -> int:
    """The k-th largest sum among the rows set in the bitmap ``rows``, which are k at least."""
    sure, open_, value = np.zeros_like(rows), rows, 0
    for i in range(len(total) - 1, -1, -1):
        with_bit = open_ & total[i]
        if int(np.bitwise_count(sure | with_bit).sum()) >= k:
            open_, value = with_bit, value | 1 << i
        else:
            sure, open_ = sure | with_bit, open_ & ~total[i]
    return value


def at_least(total: list[np.ndarray], rows: np.ndarray, limit: int) -> np.ndarray:
    """The bitmap of the rows whose sum is ``limit`` or more."""
    if limit <= 0:
        return rows
    if limit >> len(total):
        return np.zeros_like(rows)
    above, equal = np.zeros_like(rows), rows
    for i in range(len(total) - 1, -1, -1):
        if limit >> i & 1:
            equal = equal & total[i]
        else:
            above, equal = above | (equal & total[i]), equal & ~total[i]
    return above | equal


class Block:
    """One block of the index: the slices of its rows, and what is needed to bound and to resolve."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, bits: int):
        self.ids, self.x = ids, x
        self.low = x.min(axis=0).astype(np.int64)
        above = x - x.min(axis=0)
        size = int(above.max()).bit_length()
        self.shift, self.depth = max(0, size - bits), min(size, bits)
        self.middle = ((1 << self.shift) - 1) / 2
        # The largest norm of what the slices leave out, in parts: these numbers take eight bytes.
        rests = ((above[i : i + 4096] & (1 << self.shift) - 1) - self.middle for i in range(0, len(x), 4096))
        self.error = max(float(np.sqrt((rest * rest).sum(axis=1).max())) for rest in rests)
        above >>= self.shift
        self.words = -(-len(ids) // 64)
        slices = np.zeros((x.shape[1], self.depth, self.words * 8), np.uint8)
        for i in range(self.depth):
            packed = np.packbits((above >> i & 1).astype(np.uint8), axis=0, bitorder="little")
            slices[:, i, : len(packed)] = packed.T
        bitmaps = slices.view(np.uint64).reshape(-1, self.words)
        self.bitmaps = np.concatenate([bitmaps, ~bitmaps])
        rows = np.zeros(self.words * 64, np.uint8)
        rows[: len(ids)] = 1
        self.rows = np.packbits(rows, bitorder="little").view(np.uint64)

    def sums(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """The sums of the query's components times the quantised ones, as bitmaps, and what these are too large by."""
        component, digit = np.nonzero(digits := signed_digits(query))
        negative = digits[component, digit] < 0
        chosen = component * self.depth + negative * (len(query) * self.depth)
        places: dict[int, list[np.ndarray]] = {}
        for j in np.unique(digit):
            for i in range(self.depth):
                places.setdefault(int(j) + i, []).append(chosen[digit == j] + i)
        total = add_bitmaps({place: self.bitmaps[np.concatenate(found)] for place, found in places.items()}, self.words)
        return total, int((1 << digit[negative]).sum()) * ((1 << self.depth) - 1)

    def best(self, own: int, query: np.ndarray, k: int, least: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the best ``k`` rows for the query, not counting the row with its ``own`` id; none below ``least`` is needed."""
        query = query.astype(np.int64)
        if len(self.ids) > k + 1:
            total, excess = self.sums(query)
            reach = self.error * float(np.sqrt((query * query).sum())) / (1 << self.shift) * (1 + 1e-9)
            if least is None:
                limit = kth_sum(total, self.rows, k + 1) - int(2 * reach) - 1
            else:
                known = int(query @ self.low) + self.middle * int(query.sum())  # of every row's score
                limit = excess + math.floor((least - known) / (1 << self.shift) - reach) - 1
            marked = at_least(total, self.rows, limit)
            (at,) = np.nonzero(np.unpackbits(marked.view(np.uint8), bitorder="little"))
        else:
            at = np.arange(len(self.ids))
        at = at[self.ids[at] != own]
        scores = self.x[at].astype(np.int64) @ query
        first = np.lexsort((self.ids[at], -scores))[:k]
        return self.ids[at[first]], scores[first]


class Tile:
    """The queries of a chunk, whose best rows are kept while the blocks of a lane pass by."""

    def __init__(self, k: int, bits: int):
        self.k, self.bits = k, bits
        self.asked: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.rows = 0
        self.count = np.zeros(0, np.int64)  # of each query's best rows so far; their ids and scores
        self.ids = self.scores = np.zeros((0, k), np.int64)

    def ask(self, ids: np.ndarray, x: np.ndarray) -> None:
        self.asked.append((ids, x))

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        most = max(1, BLOCK_BYTES // (4 * x.shape[1])) if self.asked else 0
        while most and len(ids):
            taken = most - self.rows
            self.waiting.append((ids[:taken], x[:taken]))
            self.rows += len(ids[:taken])
            ids, x = ids[taken:], x[taken:]
            if self.rows == most:
                self.search()

    def search(self) -> None:
        """The queries' best rows, with those of the block that has come together."""
        if not self.rows:
            return
        block = Block(*(np.concatenate(part) for part in zip(*self.waiting)), self.bits)
        self.waiting, self.rows = [], 0
        if not len(self.count):
            self.count = np.zeros(sum(len(ids) for ids, _ in self.asked), np.int64)
            self.ids, self.scores = np.zeros((2, len(self.count), self.k), np.int64)
        for i, (own, query) in enumerate((own, query) for asking, queries in self.asked for own, query in zip(asking.tolist(), queries)):
            n = self.count[i]
            ids, scores = block.best(own, query, self.k, int(self.scores[i, -1]) if n == self.k else None)
            ids, scores = np.concatenate([self.ids[i, :n], ids]), np.concatenate([self.scores[i, :n], scores])
            first = np.lexsort((ids, -scores))[: self.k]
            self.count[i] = n = len(first)
            self.ids[i, :n], self.scores[i, :n] = ids[first], scores[first]

    def found(self) -> Iterator[pa.RecordBatch]:
        self.search()
        if not len(self.count):
            return
        queries, some = np.concatenate([ids for ids, _ in self.asked]), max(1, OUT_ROWS // self.k)
        for i in range(0, len(queries), some):
            count = self.count[i : i + some]
            filled = np.arange(self.k) < count[:, None]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(queries[i : i + some], count), pa.int64()),
                    pa.array(self.ids[i : i + some][filled], pa.int64()), pa.array(self.scores[i : i + some][filled], pa.int64()),
                ],
                names=["query_id", "vec_id", "score"],
            )


def _answers(k: int, bits: int):
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, at = None, None
        for batch in batches:
            columns = [batch[c].to_numpy(zero_copy_only=False) for c in ("dim", "lane", "chunk", "asking")]
            changes = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            for start, end in pairwise([0, *(np.nonzero(changes)[0] + 1).tolist(), batch.num_rows]):
                if start == end:
                    continue
                *name, asking = (c[start].item() for c in columns)
                if name != at:
                    if tile:
                        yield from tile.found()
                    tile, at = Tile(k, bits), name
                ids = batch["_id"][start:end].to_numpy()
                x = batch["x"][start:end].flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
                (tile.ask if asking else tile.add)(ids, x)
        if tile:
            yield from tile.found()

    return answer


def search(
    vectors: DataFrame, ws: Workspace, asked: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
    scale: int = 1024, bits: int = BITS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector with ``asked``, a condition on ``_id``, its best ``k`` others.

    Higher scores come first, smaller ids first among equal scores.
    """
    spark = vectors.sparkSession
    tiles = min(int(spark.conf.get(PARTITIONS_SETTING)), TILES_PER_CORE * spark.sparkContext.defaultParallelism)
    numbers = ws.stage(_numbers(vectors, id_col, vector_col, scale), "numbers")
    # One row for each length that vectors have: at most the root of twice the number of all components.
    sizes = numbers.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.count_if(asked).alias("queries")).filter("queries > 0")
    layout = ws.stage(_layout(sizes, k, tiles), "layout")
    with arrow_batches(spark):
        found = ws.stage(_tiles(numbers, layout, asked).mapInArrow(_answers(k, bits), "query_id long, vec_id long, score long"), "found")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
