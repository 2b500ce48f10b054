"""Sequences of token ids in training order, as shards of records with a fixed stride.

1. Token ids (bytes, ``width`` per id) are cut into sequences of ``length`` ids and staged. The place
   of a row in its staged file and the sizes of the files before it number the sequences 0..N-1
   without a shuffle; a file once written does not change, so retries see the same numbers.
2. A keyed Feistel permutation of the smallest even power of two above N, walked along its cycle
   until it falls below N, turns each number into a slot. It is a bijection computed row by row,
   and its inverse tells which sequence a slot holds.
3. Slots are dealt to shards by range: shard s holds the slots from s * ``per_shard`` on. A task puts
   the records of a shard, at most ``per_shard``, in order and writes one row with the shard's bytes.
   Record k of a shard starts at byte k * stride, so a reader seeks instead of searching, and
   training resumes at any slot by skipping whole shards.

A record is the id of the document (int64), the number of the sequence in it (int32), the number of
its ids (int32), and the ids, zero-filled to ``length``; all little-endian.

Defined cases: null or empty ids give no sequence; a null document id is stored as the smallest
int64 and read back as null; equal rows are separate sequences; an empty table gives no shard; other
columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rootweave.workspace import Workspace

ROUNDS = 4
NO_ID = -(1 << 63)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Permutation:
    """A bijection of 0..size-1 that depends on ``key``."""

    def __init__(self, size: int, key: int):
        self.size = size
        self.half = np.uint64(max(1, (max(size - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))

    def _once(self, x: np.ndarray, inverse: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys[::-1] if inverse else self.keys:
            if inverse:
                left, right = right ^ (_mix(left + key) & self.mask), left
            else:
                left, right = right, left ^ (_mix(right + key) & self.mask)
        return left << self.half | right

    def apply(self, numbers: np.ndarray, inverse: bool = False) -> np.ndarray:
        """Slots of the numbers, or numbers of the slots."""
        out = self._once(numbers.astype(np.uint64), inverse)
        outside = np.flatnonzero(out >= self.size)
        while len(outside):  # on the cycle of a number below the size there is always another one
            out[outside] = self._once(out[outside], inverse)
            outside = outside[out[outside] >= self.size]
        return out.astype(np.int64)


def stride(length: int, width: int) -> int:
    return 16 + length * width


def _numbered(sequences: DataFrame, ws: Workspace) -> tuple[DataFrame, int]:
    """``sequences``, staged, with ``number`` from 0 on, and how many there are."""
    path = f"{ws.path}/sequences-{uuid.uuid4().hex}"
    sequences.write.option("compression", "zstd").parquet(path)
    staged = sequences.sparkSession.read.schema(sequences.schema).parquet(path)
    placed = staged.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    # One row per file that was written.
    files = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("rows"))
    files = ws.stage(files.withColumn("until", F.sum("rows").over(Window.orderBy("_file"))), "files")
    total = files.agg(F.max("until")).first()[0] or 0
    starts = files.select("_file", (F.col("until") - F.col("rows")).alias("_start"))
    return placed.join(starts, "_file").withColumn("number", F.col("_start") + F.col("_row")).drop("_file", "_row", "_start"), total


def write(
    docs: DataFrame, ws: Workspace, path: str, id_col: str = "doc_id", ids_col: str = "ids",
    width: int = 4, length: int = 1_024, per_shard: int = 4_096, key: int = 0,
) -> int:
    """Write the sequences of ``docs`` as shards to the new folder ``path``; returns how many sequences there are."""
    size = length * width
    pieces = F.ceil(F.octet_length("_ids") / size).cast("int")
    sequences = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(ids_col).cast("binary").alias("_ids")).filter(
        F.octet_length("_ids") > 0
    ).select("_id", "_ids", F.explode_outer(F.sequence(F.lit(0), pieces - 1)).alias("piece")).select(
        "_id", "piece", F.substring(F.col("_ids"), F.col("piece") * size + 1, F.lit(size)).alias("part")
    )
    numbered, total = _numbered(sequences, ws)

    def slots(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        permutation = Permutation(total, key)
        for batch in batches:
            yield pa.array(permutation.apply(batch.to_numpy(zero_copy_only=False)), pa.int64())

    slotted = numbered.withColumn("slot", F.arrow_udf(slots, "long")(F.col("number"))).drop("number")
    slotted = slotted.withColumn("shard", F.floor(F.col("slot") / per_shard))

    def build(part: pa.Table) -> pa.Table:
        part = part.sort_by("slot")
        ids = part["_id"].fill_null(NO_ID).to_numpy()
        out = bytearray(len(part) * stride(length, width))
        for k, (number, data) in enumerate(zip(part["piece"].to_pylist(), part["part"].to_pylist())):
            at = k * stride(length, width)
            out[at : at + 8] = int(ids[k]).to_bytes(8, "little", signed=True)
            out[at + 8 : at + 12] = number.to_bytes(4, "little")
            out[at + 12 : at + 16] = (len(data) // width).to_bytes(4, "little")
            out[at + 16 : at + 16 + len(data)] = data
        shard = part["shard"][0].as_py()
        return pa.table({
            "shard": pa.array([shard], pa.int64()), "first_slot": pa.array([shard * per_shard], pa.int64()),
            "records": pa.array([len(part)], pa.int32()), "stride": pa.array([stride(length, width)], pa.int32()),
            "payload": pa.array([bytes(out)], pa.binary()),
        })

    shards = slotted.groupBy("shard").applyInArrow(build, "shard long, first_slot long, records int, stride int, payload binary")
    shards.write.option("compression", "zstd").parquet(path)
    return total


def read(spark: SparkSession, path: str, width: int = 4, from_slot: int = 0) -> DataFrame:
    """(slot, shard, offset, doc_id, piece, n_ids, ids) of the records from a slot on; whole shards before it are not read."""
    shards = spark.read.schema("shard long, first_slot long, records int, stride int, payload binary").parquet(path)
    wanted = shards.filter(F.col("first_slot") + F.col("records") > from_slot)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                step, data, first = row["stride"], row["payload"], row["first_slot"]
                head = np.frombuffer(data, np.uint8).reshape(row["records"], step)[:, :16]
                ids = np.ascontiguousarray(head[:, :8]).view(np.int64).ravel()
                piece, n = (np.ascontiguousarray(head[:, a : a + 4]).view(np.int32).ravel() for a in (8, 12))
                offset = np.arange(row["records"], dtype=np.int64) * step
                some = first + np.arange(row["records"]) >= from_slot
                parts = [data[o + 16 : o + 16 + k * width] for o, k in zip(offset[some], n[some])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((first + np.arange(row["records"]))[some], pa.int64()), pa.array(np.full(int(some.sum()), row["shard"]), pa.int64()),
                        pa.array(offset[some], pa.int64()), pa.array(ids[some], pa.int64(), mask=ids[some] == NO_ID),
                        pa.array(piece[some], pa.int32()), pa.array(n[some], pa.int32()), pa.array(parts, pa.binary()),
                    ],
                    names=["slot", "shard", "offset", "doc_id", "piece", "n_ids", "ids"],
                )

    return wanted.mapInArrow(records, "slot long, shard long, offset long, doc_id long, piece int, n_ids int, ids binary")
