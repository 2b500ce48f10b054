"""Self-join of documents by the Jaccard similarity of their word shingles, over a token-group matrix.

Sets. Shingles are 64-bit hashes; documents with equal sets are one node from the start.

Tokens of the matrix. Sets at or above the threshold differ in at most H elements, H following from
their sizes. The hash range is cut into k > H parts; two such sets agree in at least k - H parts.
The content of a part, hashed, is a token: far rarer than a shingle, so that passages many documents
share link nobody. Sizes fall into classes with a common k; a set near the upper end of its class
also has the tokens of the next. Only tokens of two or more sets matter, and of each set only the
rarest, so many that a partner must share one of them.

Groups. Every set is compared with the one candidate it has most tokens in common with; links found
so make groups of similar documents. The matrix holds which tokens occur in which group: the union
of its members' tokens. A set that shares rare tokens with another group is bounded by the number of
its tokens in that union; groups below what the threshold needs stay closed. Groups grow by turns first: each set is
compared with one set of another group, as long as that finds many links; each token offers two sets a turn, drawn
anew, so a turn makes two rows a token and set at most. Then a group is opened
at one member per query, linked groups are merged, and what is still apart is opened
whole: every pair that may qualify and is not connected yet is compared exactly. Sets alone ask groups, not the other way
round, and are not met a second time by other sets alone: these were all compared. So no link between
components is lost, while a group of thousands of near copies costs a few comparisons per member.

Sketches. Thousands of variants of one text that are alike, but not alike enough to link, share
tokens and stay apart. Each set has a parity sketch of two bits or more per element: every element flips one bit. Two
sketches differ in at most as many bits as their sets in elements; a wider sketch is folded to the width of the other
by a parity of its halves. Into the join on the token goes a sketch that is folded as far as ``DENSE`` bits per element
and ``MOST_BITS`` bits allow, and a pair whose sketches differ in more than a link allows is dropped inside the join: no
row is made of it. Pairs that met under a token are compared by the wide sketch before groups are bounded and before any
set is moved: it has a thirtieth of a set's bytes. Neither sketch ever loses a link.

Scale: all steps are joins and aggregations by token, document or group; token lists are bounded by
the size of one text. Very frequent tokens are summarised per group before anything is joined to
them, and the sets of a token are dealt to parts of at most ``PART`` when they are compared. Key lists are broadcast only if counted short.

Defined cases: texts without words have no set and link with nothing; shorter ones than a shingle
are one shingle; rows without an id have no component; rows that share an id count as one document
in links; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootweave.llm.common import begin, small_batches
from rootweave.llm.graph import components
from rootweave.operators.skew import anti_join, semi_join, stage_keys
from rootweave.workspace import Workspace

MEMO = 200_000
GROWTH = 1.5  # of the size classes
BITS = 512  # of a sketch, at least
MOST_BITS = 2_048  # of a sketch that goes along with tokens
DENSE = 0.6  # bits per element that such a sketch has at least, unless that is more than the most
PART = 1_000
YIELD = 100  # turns go on while they find a link for one in so many sets,
LEAST = 100  # and at least so many links: what fewer would spare costs less than a turn


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """Hash by word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        found = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return found


class Shingles:
    """Sorted distinct shingle hashes of texts; A-Z are lower-cased, words stand between ASCII white space."""

    def __init__(self, size: int):
        self.size = size
        self.words = _Words()

    def of(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()
        if not words:
            return np.empty(0, np.uint64)
        hashes = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        if len(words) < self.size:  # the number of words keeps it apart from longer shingles
            out = np.array([len(words)], np.uint64)
            for h in hashes:
                out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h)
            return out
        n = len(words) - self.size + 1
        out = np.zeros(n, np.uint64)
        for i in range(self.size):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n])
        return np.unique(out)


class SizeClasses:
    """Size classes and, for each, the number of parts and how many of them two similar sets share."""

    def __init__(self, percent: int):
        self.percent = percent

    @staticmethod
    @cache
    def shared(percent: int) -> SizeClasses:
        """One table for all tasks of a worker."""
        return SizeClasses(percent)

    @cache
    def start(self, number: int) -> int:
        return 1 if number == 0 else max(self.start(number - 1) + 1, int(self.start(number - 1) * GROWTH))

    def of(self, n: int) -> list[int]:
        number = 0
        while self.start(number + 1) <= n:
            number += 1
        return [number, number + 1] if 100 * n >= self.percent * self.start(number + 1) else [number]

    @cache
    def parts(self, number: int) -> tuple[int, int, np.ndarray]:
        """(parts, least agreement, limits of the parts)."""
        differ = 2 * (self.start(number + 1) - 1) * (100 - self.percent) // (100 + self.percent)
        k = differ + differ // 8 + 1
        return k, k - differ, np.array([(i << 64) // k for i in range(k)], np.uint64)

    def tokens(self, hashes: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(how many a partner must share, tokens) for each class of the set."""
        found = []
        for number in self.of(len(hashes)):
            k, agree, limits = self.parts(number)
            starts = np.searchsorted(hashes, limits)
            filled = np.append(starts[1:], len(hashes)) > starts
            empty = k - int(filled.sum())
            content = np.zeros(k, np.uint64)
            content[filled] = np.add.reduceat(_mix(hashes + np.uint64(0x632BE59BD9B4E019)), starts[filled])
            tokens = _mix(_mix(content + limits) + np.uint64(number))
            # Parts that are empty in both sets also agree; they count only where they have to.
            found.append((max(1, agree - empty), tokens if empty >= agree else tokens[filled]))
        return found


def wide_sketch(hashes: np.ndarray) -> bytes:
    """A parity sketch whose width grows with the set: the power of two from twice its size on, at least ``BITS``."""
    width = max(BITS, 1 << (2 * len(hashes) - 1).bit_length())
    bits = (_mix(hashes + np.uint64(0xA24BAED4963EE407)) & np.uint64(width - 1)).astype(np.int64)
    return np.packbits(np.bincount(bits, minlength=width).astype(np.uint8) & 1).tobytes()


def least_apart(x: bytes, y: bytes) -> int:
    """In how many elements two sets differ at least, by their wide sketches."""
    a, b = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def sketch(wide: bytes, n: int) -> np.ndarray:
    """What of the wide sketch of a set of ``n`` elements goes along with tokens, as 64-bit numbers."""
    words = np.frombuffer(wide, np.int64)
    while 64 * len(words) > MOST_BITS or 32 * len(words) >= max(BITS, DENSE * n):
        words = words[: len(words) // 2] ^ words[len(words) // 2 :]
    return words


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """One row per document with its set's size, sketches and digest."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("jaccard")
        shingles = Shingles(size)
        for batch in batches:
            n, sketches, wide, digest = [], [], [], []
            for text in batch.column(1).to_pylist():
                hashes = shingles.of(text or "")
                n.append(len(hashes))
                wide.append(wide_sketch(hashes))
                sketches.append(sketch(wide[-1], len(hashes)))
                digest.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(n, pa.int64()), pa.array(sketches, pa.list_(pa.int64())),
                    pa.array(wide, pa.binary()), pa.array(digest, pa.binary()),
                ],
                names=["_id", "n", "sketch", "wide", "digest"],
            )

    return docs.mapInArrow(rows, "_id long, n long, sketch array<long>, wide binary, digest binary")


def _tokens(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(_id, side, token) of every set: ``side`` is twice the number of tokens that a partner must share, plus one
    for the tokens of the next class. They are derived from the texts when needed and never kept."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("jaccard")
        shingles, classes = Shingles(size), SizeClasses.shared(percent)
        for batch in batches:
            ids, sides, tokens = [], [], []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                hashes = shingles.of(text.as_py() or "")
                for i, (least, found) in enumerate(classes.tokens(hashes) if len(hashes) else []):
                    ids.append(np.full(len(found), row))
                    sides.append(np.full(len(found), 2 * least + i, np.int32))
                    tokens.append(found.view(np.int64))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (ids, sides, tokens)], names=["_id", "side", "token"])

    return docs.mapInArrow(rows, "_id long, side int, token long")


def _hashes(docs: DataFrame, size: int) -> DataFrame:
    """(_id, hashes): the sets themselves."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("jaccard")
        shingles = Shingles(size)
        for batch in batches:
            found = [shingles.of(text or "").view(np.int64) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["_id", "hashes"])

    return docs.mapInArrow(rows, "_id long, hashes array<long>")


def _similar(percent: int) -> Column:
    common = F.size(F.array_intersect("x", "y"))
    return 100 * common >= percent * (F.size("x") + F.size("y") - common)


def _close(percent: int) -> Column:
    """Whether sizes and sketches of ``x`` and ``y`` allow a link."""
    n, m, a, b = F.col("x.n"), F.col("y.n"), F.col("x.sketch"), F.col("y.sketch")
    width = F.least(F.size(a), F.size(b))
    narrow = sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(BITS // 64)), F.lit(0))
    apart = F.zip_with(_folded(a, width), _folded(b, width), lambda v, w: F.bit_count(v.bitwiseXOR(w)))
    bits = F.when(F.greatest(F.size(a), F.size(b)) == BITS // 64, narrow).otherwise(F.aggregate(apart, F.lit(0), lambda total, v: total + v))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * bits <= (100 - percent) * (n + m))


def _folded(words: Column, width: Column) -> Column:
    """A sketch that goes along with tokens, at ``width`` words: all of its own, half or a quarter of them."""

    def both(x: Column, y: Column) -> Column:
        return F.zip_with(x, y, lambda v, w: v.bitwiseXOR(w))

    part = [F.slice(words, i * width + 1, width) for i in range(4)]
    halves, quarters = both(part[0], part[1]), both(both(part[0], part[1]), both(part[2], part[3]))
    return F.when(F.size(words) > 2 * width, quarters).when(F.size(words) > width, halves).otherwise(words)


def _meet(asked: DataFrame, held: DataFrame, whole: bool, percent: int) -> DataFrame:
    """(_id, other, b), once per token: sets of ``asked`` with members ``b`` of groups ``other`` in ``held`` that they may link with.

    A link between two groups is looked for from the group with the larger name, but a set ``alone`` asks the larger groups.
    When groups are opened ``whole``, two sets that are alone have met before.
    """
    parts = F.ceil(F.col("sets") / PART).cast("int")
    x = asked.withColumn("part", F.pmod(F.xxhash64("_id"), parts).cast("int")).alias("x")
    y = held.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).alias("y")
    same, larger = (F.col("x.token") == F.col("y.token")) & (F.col("x.part") == F.col("y.part")), F.col("y.g") < F.col("x.g")
    alone = F.col("x.alone") & F.col("y.alone")
    asks = larger & ~alone if whole else F.when(F.col("x.alone") == F.col("y.alone"), larger).otherwise(F.col("x.alone"))
    return x.join(y, same & asks & _close(percent)).select("x._id", F.col("y.g").alias("other"), F.col("y._id").alias("b"))


def _near(pairs: DataFrame, drawn: DataFrame, a: str, b: str, percent: int) -> DataFrame:
    """The rows of ``pairs`` whose sets ``a`` and ``b`` may link by their sizes and wide sketches."""

    def allowed(n: pa.Array, x: pa.Array, m: pa.Array, y: pa.Array) -> pa.Array:
        sizes = zip(n.to_pylist(), m.to_pylist(), x, y)
        return pa.array([(100 + percent) * least_apart(v.as_py(), w.as_py()) <= (100 - percent) * (i + j) for i, j, v, w in sizes], pa.bool_())

    x = drawn.select(F.col("_id").alias(a), F.col("n").alias("_n"), F.col("wide").alias("_x"))
    y = drawn.select(F.col("_id").alias(b), F.col("n").alias("_m"), F.col("wide").alias("_y"))
    both = pairs.join(x, a).join(y, b).filter(100 * F.least("_n", "_m") >= percent * F.greatest("_n", "_m"))
    return both.filter(F.arrow_udf(allowed, "boolean")("_n", "_x", "_m", "_y")).select(*pairs.columns).distinct()


def _linked(pairs: DataFrame, docs: DataFrame, size: int, percent: int, ws: Workspace) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough. Only the texts of these pairs are read again."""
    pairs = ws.stage(pairs, "pairs")
    ids = stage_keys(pairs.select(F.explode(F.array("a", "b")).alias("_id")), ws, "ids")
    hashes = ws.stage(_hashes(semi_join(docs, ids, "_id"), size), "hashes")
    x = hashes.select(F.col("_id").alias("a"), F.col("hashes").alias("x"))
    y = hashes.select(F.col("_id").alias("b"), F.col("hashes").alias("y"))
    return pairs.join(x, "a").join(y, "b").filter(_similar(percent)).select("a", "b")


def _copies(sets: DataFrame, reps: DataFrame) -> DataFrame:
    """Ids whose sets all have another representative."""
    return sets.filter("n > 0 AND _id IS NOT NULL").select("_id").join(reps.select(F.col("rep").alias("_id")), "_id", "left_anti")


def _rare(tokens: DataFrame, ws: Workspace) -> tuple[DataFrame, DataFrame]:
    """(shared, rare): the tokens that several sets have, and of each set the rarest of these.

    ``shared(token, _id, side)`` is only kept for sets that share as many as a partner must. Most tokens occur
    once. They are dealt by token a single time: counts and the join with the counts read the same shuffle, which
    needs the same columns and filters on both sides, and that is why the counts look at the sides.
    """
    dealt = tokens.filter("token IS NOT NULL AND side IS NOT NULL").repartition("token")
    counts = dealt.groupBy("token").agg(F.count("_id").alias("sets"), F.min("side").alias("least")).filter("sets > 1 AND least > 0")
    least = F.shiftright("side", 1)
    lists = dealt.join(counts.select("token", "sets").hint("shuffle_hash"), "token").groupBy("_id", "side").agg(
        F.sort_array(F.collect_list(F.struct("sets", "token"))).alias("found")
    ).filter(F.size("found") >= least)
    lists = ws.stage(lists, "shared")
    shared = lists.select("_id", "side", F.explode("found.token").alias("token"))
    first = F.slice("found", F.lit(1), F.size("found") - least + 1)
    rare = lists.select("_id", F.explode(first).alias("found")).select("_id", "found.token", "found.sets")
    return shared, ws.stage(rare, "rare")


def _placed(rare: DataFrame, roots: DataFrame) -> DataFrame:
    """The rare tokens with the group ``g`` of their set, and whether it is ``alone`` there."""
    placed = rare.join(roots.withColumnRenamed("v", "_id"), "_id", "left")
    return placed.withColumns({"g": F.coalesce("root", "_id"), "alone": F.col("root").isNull()}).drop("root")


def _offered(placed: DataFrame, turn: int) -> DataFrame:
    """(a, b): each set with a set of another group, of those two of different groups that each of its tokens offers in this turn."""
    drawn = F.struct(F.xxhash64(F.lit(turn), "g").alias("h"), "g", F.xxhash64(F.lit(turn), "_id").alias("i"), "_id")
    ends = placed.groupBy("token").agg(F.min(drawn).alias("low"), F.max(drawn).alias("high")).filter("low.g <> high.g")
    offers = ends.select("token", F.explode(F.array("low", "high")).alias("end")).select("token", F.col("end.g").alias("other"), F.col("end._id").alias("b"))
    return _best(placed.join(offers, "token").filter("g <> other"))


def _best(pairs: DataFrame) -> DataFrame:
    """(a, b): of the candidates of each set, one row per common token, the one with most."""
    return pairs.groupBy("_id", "b").count().groupBy("_id").agg(F.max_by("b", F.struct("count", -F.col("b"))).alias("b")).select(
        F.col("_id").alias("a"), "b"
    )


def jaccard_components(
    docs: DataFrame, ws: Workspace, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """(``id_col``, n_shingles, component_id) for every row of ``docs``.

    Documents link when 100 * intersection >= ``percent`` * union of their sets of ``size``-word
    shingles; ``component_id`` is the smallest id that links lead to. Ids are whole numbers.
    """
    small_batches(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    sets = ws.stage(_sets(plain, size), "sets")
    reps = ws.stage(sets.filter("n > 0 AND _id IS NOT NULL").groupBy("digest").agg(F.min("_id").alias("rep")), "reps")
    # All rows but one of each set; texts move only if these are very many.
    copies = stage_keys(_copies(sets, reps), ws, "copies")
    own = anti_join(plain.filter("_id IS NOT NULL"), copies, "_id").select("_id", "_text")
    shared, rare = _rare(_tokens(own, size, percent), ws)

    ids = stage_keys(rare.select("_id"), ws, "ids")
    drawn = ws.stage(semi_join(sets.select("_id", "n", "sketch", "wide"), ids, "_id"), "drawn")
    ws.release()  # the tokens' shuffle is the largest of all

    # Groups: each set with the candidate it shares most rare tokens with, if sizes and sketches allow a link.
    heads = rare.groupBy("token").agg(F.min("_id").alias("b"))
    nearest = _best(rare.join(heads, "token").filter("_id <> b"))
    links, seen = ws.stage_counted(_linked(_near(nearest, drawn, "a", "b", percent), plain, size, percent, ws), "links")

    turn = 0
    while seen["rows"] >= LEAST and YIELD * seen["rows"] > ids.rows:
        turn += 1
        offered = _offered(_placed(rare, components(links, ws)), turn)
        found, seen = ws.stage_counted(_linked(_near(offered, drawn, "a", "b", percent), plain, size, percent, ws), "found")
        links = links.unionByName(found)
        ws.release()

    for whole in (False, True):
        roots = components(links, ws)
        placed = _placed(rare, roots)
        several = placed.groupBy("token").agg(F.min("g").alias("low"), F.max("g").alias("high"), F.every("alone").alias("alone"))
        several = several.filter("low < high AND NOT alone" if whole else "low < high").select("token")
        grouped = ws.stage(placed.join(several, "token", "left_semi").join(drawn.drop("wide"), "_id"), "grouped")
        # One member stands for its group under each token; the second time all do.
        held = grouped if whole else grouped.filter("alone").unionByName(grouped.filter("NOT alone").groupBy("token", "g").agg(
            F.min_by(F.struct("_id", "alone", "sets", "n", "sketch"), "_id").alias("head")
        ).select("token", "g", "head.*"))
        met = _meet(grouped, held, whole, percent).groupBy("_id", "other", "b").count()
        met = ws.stage(_near(met, drawn, "_id", "b", percent), "met")
        bound = _qualify(met.select("_id", "other").distinct(), shared, roots)
        opened = met.join(bound, ["_id", "other"], "left_semi")
        if not whole:
            opened = opened.groupBy("_id", "other").agg(
                F.max_by("b", F.struct("count", -F.col("b"))).alias("b")
            )
        pairs = opened.select(F.col("_id").alias("a"), "b").distinct()
        links = ws.stage(links.unionByName(_linked(pairs, plain, size, percent, ws)), "links")
        ws.release()

    roots = components(links, ws)
    named = reps.join(roots.withColumnRenamed("v", "rep"), "rep", "left").select("digest", F.coalesce("root", "rep").alias("component"))
    result = sets.select("_id", "n", "digest").join(named, "digest", "left")
    component = F.when((F.col("n") > 0) & F.col("_id").isNotNull(), F.col("component")).otherwise(F.col("_id"))
    return result.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))


def _qualify(near: DataFrame, shared: DataFrame, roots: DataFrame) -> DataFrame:
    """The (set, group) of ``near`` whose overlap with the union of the group's tokens is as large as a link needs."""
    groups = shared.join(roots.withColumnRenamed("v", "_id"), "_id", "left").select("token", F.coalesce("root", "_id").alias("other"))
    unions = groups.join(near.select("other").distinct(), "other", "left_semi").distinct()
    asked = near.join(shared, "_id")
    return asked.join(unions, ["token", "other"]).groupBy("_id", "other", "side").count().filter(
        F.col("count") >= F.shiftright("side", 1)
    ).select("_id", "other").distinct()
