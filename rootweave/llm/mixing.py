"""Mixing sources to target weights by temperature.

The share of a source in all tokens is raised to an exponent between 1 (natural shares) and 0 (equal
shares) and normalised. The exponent is found by bisection: the largest one whose weights reach a
target entropy, or the smallest one under which no source is repeated more often than allowed (this
limit wins). All candidates of a round, 1,024 steps of the bracket, are evaluated in one aggregation
over the sources.

A weight times the budget gives the tokens to take from a source: whole passes (epochs) over it and
a part of one more. Each epoch permutes the source's blocks (4,096 by a hash of the id), and
documents within a block, by keyed hashes. The part takes blocks in that order while they fit the
budget; the block that no longer fits is cut at a sub-block and that at a document. What is taken
is therefore all that sorts up to one document, so realising it needs one small row per source.

Scale: token counts are staged without the text; cumulative sums run over at most 4,096 blocks or
sub-blocks of a source at a time, never over its documents. Documents meet the row of their source
in a join that Spark broadcasts while that table is small; nothing is collected but two numbers a round.

Defined cases: a null source is a source of its own; null text has no tokens; documents without
tokens, and sources without any, come in every whole epoch, at least once if no budget is set; rows
with equal ids are taken or left together; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rootweave.llm.common import whole
from rootweave.workspace import Workspace

CANDIDATES = 1_024
ROUNDS = 5
HEX = 3  # digits of a hash that number a block, or a sub-block within a block


def n_words(text_col: str) -> Column:
    """Words between ASCII white space."""
    return F.size(F.array_remove(F.split(whole(text_col), r"[\x20\x09-\x0D]+"), "")).cast("long")


def _source(source_col: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("-"))


def exponent(totals: DataFrame, budget: int | None, target_entropy: float | None, max_repeats: float | None) -> float:
    """The exponent for ``totals(tokens)``; 1 without a target.

    An entropy above that of equal shares gives 0, a repetition limit below that of natural shares 1.
    """
    largest = totals.agg(F.max("tokens")).first()[0]
    if not largest:
        return 1.0
    shares = totals.filter("tokens > 0").select((F.col("tokens") / F.lit(float(largest))).alias("x"))

    def search(wanted: Column) -> tuple[float, float]:
        """The bracket of the exponent at which ``wanted`` turns from true to false or back."""
        low, width = 0.0, 1.0
        for _ in range(ROUNDS):
            tried = shares.select("x", F.explode(F.transform(
                F.sequence(F.lit(0), F.lit(CANDIDATES)), lambda k: F.struct(k.alias("k"), (F.lit(low) + k * F.lit(width / CANDIDATES)).alias("a"))
            )).alias("t")).select("x", "t.k", "t.a")
            power = F.pow("x", F.col("a"))
            seen = tried.groupBy("k", "a").agg(
                F.sum(power).alias("z"), F.sum(power * F.log("x")).alias("l"),
                F.max(F.pow("x", 1 - F.col("a"))).alias("cover"), F.max(F.pow("x", F.col("a") - 1)).alias("least"),
            ).select("k", wanted.alias("wanted"))
            at = seen.agg(F.max(F.when(F.col("wanted"), F.col("k"))), F.min(F.when(F.col("wanted"), F.col("k")))).first()
            found = at[1] if wanted is repeats else at[0]
            if found is None:  # nowhere
                return (1.0, 1.0) if wanted is repeats else (0.0, 0.0)
            found = max(found - 1, 0) if wanted is repeats else min(found, CANDIDATES - 1)
            low, width = low + found * (width / CANDIDATES), width / CANDIDATES
        return low, low + width

    entropy = F.log("z") - F.col("a") * F.col("l") / F.col("z") >= F.lit(target_entropy or 0.0)
    taken = F.lit(float(budget) / largest) if budget is not None else F.col("z") * F.col("cover")
    repeats = taken * F.col("least") / F.col("z") <= F.lit(max_repeats or 0.0) * (1 + 1e-12)
    chosen = 1.0
    if target_entropy is not None:
        chosen = search(entropy)[0]
    if max_repeats is not None:
        limit = search(repeats)[1]
        chosen = max(chosen, limit) if target_entropy is not None else limit
    return chosen


def _key(seed: str, *parts: Column | str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), *(F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts)))


def _places(seed: str) -> dict[str, Column]:
    """Block and sub-block of a document, and the keys that order them and it in epoch ``_part``."""
    digest = _key(seed, "_id")
    block, sub = F.substring(digest, 1, HEX), F.substring(digest, 1 + HEX, HEX)
    return {
        "_block": _key(seed, "_source", "_part", block),
        "_sub": _key(seed, "_source", "_part", F.concat(block, sub)),
        "_doc": _key(seed, "_source", "_part", F.concat(F.lit("doc"), F.coalesce(F.col("_id").cast("string"), F.lit("")))),
    }


def plan(
    docs: DataFrame, ws: Workspace, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    budget: int | None = None, target_entropy: float | None = None, max_repeats: float | None = None, seed: str = "mix",
) -> DataFrame:
    """One row per source: (_source, tokens, weight, take, _part, cut).

    ``take`` tokens are ``_part`` whole epochs and, of one more, the documents that sort up to ``cut``.
    Without ``budget`` it is the smallest under which every source is taken once in full.
    """
    counted = ws.stage(docs.select(
        F.col(id_col).alias("_id"), _source(source_col).alias("_source"), n_words(text_col).alias("tokens")
    ), "counted")
    totals = ws.stage(counted.groupBy("_source").agg(F.sum("tokens").alias("tokens")), "totals")
    alpha = exponent(totals, budget, target_entropy, max_repeats)
    sums = totals.agg(
        F.max("tokens").alias("top"), F.sum(F.pow(F.col("tokens").cast("double"), F.lit(alpha))).alias("z"),
        F.max(F.when(F.col("tokens") > 0, F.col("tokens") / F.pow(F.col("tokens").cast("double"), F.lit(alpha)))).alias("cover"),
    ).first()
    z, cover = float(sums["z"] or 1.0), float(sums["cover"] or 0.0)
    some = F.col("tokens") > 0
    weight = F.when(some, F.pow(F.col("tokens").cast("double"), F.lit(alpha)) / F.lit(z)).otherwise(F.lit(0.0))
    # Without a budget it is z * cover; dividing by z again would only add rounding.
    tokens = weight * F.lit(float(budget)) if budget is not None else weight * F.lit(z) * F.lit(cover)
    take = F.when(some, F.round(tokens).cast("long")).otherwise(F.lit(0))
    part = F.when(some, F.floor(F.col("take") / F.col("tokens"))).otherwise(F.lit(1 if budget is None else 0)).cast("int")
    budgets = totals.select("_source", "tokens", weight.alias("weight"), take.cast("long").alias("take")).withColumn("_part", part)
    budgets = ws.stage(budgets.withColumn("rest", F.col("take") - F.col("_part") * F.col("tokens")), "budgets")

    # The document at which the budget of the last epoch ends, found level by level.
    open_ = counted.join(budgets.filter("rest > 0").select("_source", "_part", "rest"), "_source")
    open_ = open_.withColumns(_places(seed))
    ends: DataFrame | None = None
    last = None
    for level in ("_block", "_sub", "_doc"):
        sizes = open_.groupBy("_source", "rest", level).agg(F.sum("tokens").alias("size"), F.max(F.struct("_block", "_sub", "_doc")).alias("place"))
        ordered = sizes.withColumn("until", F.sum("size").over(Window.partitionBy("_source").orderBy(level)))
        ordered = ws.stage(ordered, "ordered")
        fits = ordered.filter("until <= rest").groupBy("_source").agg(F.max_by("place", level).alias("cut"))
        ends = fits if ends is None else ends.join(fits.withColumnRenamed("cut", "deeper"), "_source", "full").select(
            "_source", F.coalesce("deeper", "cut").alias("cut")
        )
        last = ordered.filter("until > rest AND until - size <= rest").select("_source", level, (F.col("rest") - F.col("until") + F.col("size")).alias("left"))
        open_ = open_.join(last, ["_source", level]).drop("rest").withColumnRenamed("left", "rest")
    return ws.stage(budgets.drop("rest").join(ends, "_source", "left"), "plan")


def realise(
    docs: DataFrame, planned: DataFrame, id_col: str = "doc_id", source_col: str = "source", seed: str = "mix",
    epoch_col: str | None = "epoch", order_col: str | None = "order_key",
) -> DataFrame:
    """``docs``, each row as often as it is taken, with the epoch and a key; sorting by both gives the training order."""
    # The user's columns travel as one, so that no name of theirs can be one of these.
    kept = [c for c in docs.columns if c not in (epoch_col, order_col)]
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("_row"), F.col(id_col).alias("_id"), _source(source_col).alias("_source"))
    met = keyed.join(planned.select("_source", "_part", "cut"), "_source").withColumns(_places(seed))
    taken = F.coalesce(F.struct("_block", "_sub", "_doc") <= F.col("cut"), F.lit(False))
    epochs = F.filter(F.sequence(F.lit(0), F.col("_part")), lambda e: (e < F.col("_part")) | taken)
    # As outer, since else a test for empty arrays repeats all these hashes in the scan.
    rows = met.withColumn("_epoch", F.explode_outer(epochs)).filter("_epoch IS NOT NULL")
    columns = [F.col("_row").getField(c).alias(c) for c in kept]
    if epoch_col:
        columns.append(F.col("_epoch").alias(epoch_col))
    if order_col:
        block = F.substring(_key(seed, "_id"), 1, HEX)
        columns.append(_key(seed, "_source", "_epoch", block).alias(order_col))
    return rows.select(*columns)
