"""Content-defined line chunks: multi-line passages that repeat anywhere are kept once.

A chunk ends after a line when a rolling hash over the digests of the last ``window`` lines falls
into a fixed part of its range, so boundaries depend on nearby lines only and meet again soon after
an insertion or a deletion. Chunks of two or more lines are counted by digest over all documents;
the texts of those that repeat are then compared byte by byte (they are grouped by their text), and
every occurrence but the first in order of (id, text digest, line) goes.

Scale: chunks are shuffled as digests; documents are shuffled once by their own key, together with
their repeated chunks, and staged; texts are shuffled again only for repeated chunks. The counts use
map-side aggregation. A chunk that stands in a third of all documents meets its one summary row in
sort-merge joins, whose large partitions adaptive execution splits. Nothing is collected.

Defined cases: null text stays null and has no lines; a text without a repeated chunk passes
unchanged; a text of which everything repeats becomes empty; chunks of white space only are left
alone; rows with the same id and the same text count as one document, so that neither loses to the
other; a null id is an id like any other, ordered first; all other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootweave.operators.skew import hot_limit, salt_groups, skew_join
from rootweave.workspace import Workspace

KEY = ("_id", "_digest")


def _chunks(docs: DataFrame, text: Column, window: int, mean_lines: int) -> DataFrame:
    """``docs`` with ``_chunks``, an array of (start, size, digest).

    Every intermediate array is also passed on, which keeps the optimizer from computing it anew
    for each element of the next one. For the same reason the caller explodes it as outer: else a
    test for empty arrays is inferred and, with all these expressions in it, pushed to the scan.
    """
    end_below = f"{256 // mean_lines:02x}"
    lines = docs.withColumn("_lines", F.transform(F.split(text, "\n", -1), F.md5))
    last = F.size("_lines") - 1
    ends = lines.withColumn("_ends", F.filter(
        F.sequence(F.lit(0), last),
        lambda i: (i == last) | (
            (i >= window - 1)
            & (F.substring(F.md5(F.array_join(F.slice("_lines", i - window + 2, window), "")), 1, 2) < end_below)
        ),
    ))
    bounds = ends.withColumn("_bounds", F.arrays_zip(
        F.concat(F.array(F.lit(0)), F.transform(F.slice("_ends", F.lit(1), F.size("_ends") - 1), lambda e: e + 1)).alias("start"),
        F.col("_ends").alias("end"),
    ))
    several = F.filter("_bounds", lambda b: b["end"] > b["start"])
    return bounds.withColumn("_chunks", F.transform(several, lambda b: F.struct(
        b["start"].alias("start"),
        (b["end"] - b["start"] + 1).alias("size"),
        F.md5(F.array_join(F.slice("_lines", b["start"] + 1, b["end"] - b["start"] + 1), "")).alias("chunk"),
    ))).drop("_ends", "_bounds")


def drop_repeated_lines(
    docs: DataFrame, ws: Workspace, id_col: str = "doc_id", text_col: str = "text",
    removed_col: str | None = None, window: int = 2, mean_lines: int = 4,
) -> DataFrame:
    """``docs`` with ``text_col`` shortened; ``removed_col`` (long) tells by how many lines.

    ``mean_lines`` (2 to 256) is the mean size of a chunk in lines. The result reads files of ``ws``.
    """
    # The user's columns travel as one, so that no name of theirs can be one of these.
    others = [c for c in docs.columns if c not in (text_col, removed_col)]
    keyed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in others)).alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text")
    ).withColumn("_digest", F.md5(F.col("_text").cast("binary")))
    found = _chunks(keyed.filter(F.instr("_text", "\n") > 0).select(*KEY, "_text"), F.col("_text"), window, mean_lines)
    # A digest for each chunk is all that is needed to tell which may repeat.
    found, counted = ws.stage_counted(found.select(*KEY, F.inline_outer("_chunks")).filter("chunk IS NOT NULL"), "chunks")
    repeated = ws.stage(found.groupBy("chunk").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "repeated")
    hot = repeated.filter(F.col("n") > hot_limit(counted["rows"])).select("chunk", salt_groups("n"))
    suspects = skew_join(found, repeated.select("chunk"), "chunk", hot, "left_semi").groupBy(*KEY).agg(
        F.collect_set(F.struct("start", "size", "chunk")).alias("_suspects")
    )
    whole = ws.stage(_on_key(keyed, suspects.hint("shuffle_hash")), "documents")

    some = whole.filter("_suspects IS NOT NULL").select(*KEY, F.split("_text", "\n", -1).alias("_lines"), "_suspects")
    texts = some.select(*KEY, "_lines", F.inline("_suspects")).select(
        *KEY, "start", "size", "chunk", F.array_join(F.slice("_lines", F.col("start") + 1, F.col("size")), "\n").alias("passage")
    ).filter(F.length(F.trim(F.translate("passage", "\n\t\r", "   "))) > 0)
    place = F.struct("_id", "_digest", "start")
    first = texts.groupBy("chunk", "passage").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first <> last")
    met = skew_join(texts, first.withColumnRenamed("passage", "known"), "chunk", hot).filter("passage = known")
    later = met.filter(~place.eqNullSafe(F.col("first")))
    removed = later.groupBy(*KEY).agg(
        F.array_distinct(F.flatten(F.collect_list(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)))).alias("_removed")
    )

    kept_text = F.array_join(F.transform("_left", lambda i: F.get("_lines", i)), "\n")
    shortened = (
        _on_key(whole.filter("_suspects IS NOT NULL"), removed.hint("shuffle_hash"))
        .withColumn("_lines", F.when(F.col("_removed").isNotNull(), F.split("_text", "\n", -1)))
        .withColumn("_left", F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_removed"))
        .withColumn("_text", F.when(F.col("_removed").isNull(), F.col("_text")).otherwise(kept_text))
        .withColumn("_gone", F.coalesce(F.size("_lines") - F.size("_left"), F.lit(0)).cast("long"))
    )
    rest = whole.filter("_suspects IS NULL").withColumn("_gone", F.lit(0).cast("long"))
    columns = [F.col("_text").alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in docs.columns if c != removed_col]
    if removed_col:
        columns.append(F.col("_gone").alias(removed_col))
    return shortened.select(*columns).unionByName(rest.select(*columns))


def _on_key(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on the key, where null ids and digests are equal to each other."""
    names = {name: f"{name}_r" for name in KEY}
    right = right.withColumnsRenamed(names)
    same = [F.col(name).eqNullSafe(F.col(other)) for name, other in names.items()]
    return left.join(right, same, "left").drop(*names.values())
