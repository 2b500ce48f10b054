"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per failed
rule, so that a policy (a named, versioned set of rules) is a mask and applying it is one AND. The
effect of each rule is found from the counts of the distinct masks alone: a document is lost to rule
r only if r is the only bit of the policy that it fails.

The measurements come from one Arrow pass without a shuffle. ``ablations`` shuffles at most
2^rules rows per task, after map-side counting.

Defined cases: null text has no words and fails ``few_words``; no rule divides, so empty texts are
ordinary; columns of the input that are named like a result are replaced; rows are never merged.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rootweave.llm.common import small_batches

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "n_letter_words")

_WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall
_NO_SYMBOLS = str.maketrans("", "", "#*$%&|<>")


@dataclass(frozen=True)
class Rule:
    """``fails`` is true for documents that the rule objects to; bits never change their meaning."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "short_words", "word_chars < 2 * n_words"),
    Rule(3, "long_words", "word_chars > 15 * n_words"),
    Rule(4, "symbols", "2 * n_symbols > n_words"),
    Rule(5, "repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule(6, "few_letters", "100 * n_letter_words < 50 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {rule.name: rule.bit for rule in RULES}
        return sum(1 << bits[name] for name in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
PROSE_1 = Policy("prose", 1, (*BASE.rules, "symbols", "repeated_lines"))
PROSE_2 = Policy("prose", 2, tuple(rule.name for rule in RULES))
POLICIES = (BASE, PROSE_1, PROSE_2)


def measure(text: str | None) -> tuple[int, ...]:
    """The numbers in ``MEASURES`` for one text."""
    if not text:
        return (0,) * len(MEASURES)
    words = _WORDS(text)
    n = len(words)
    n_symbols = len(text) - len(text.translate(_NO_SYMBOLS))
    lines = [line for line in text.split("\n") if _WORDS(line)] if "\n" in text else words[:1]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        seen, twice = set(), set()
        for window in windows:
            (twice if window in seen else seen).add(window)
        covered = 0
        for i, window in enumerate(windows):
            if window in twice:
                repeated += i + 3 - max(i, covered)
                covered = i + 3
    letters = sum(1 for word in words if word.isalpha() or any(map(str.isalpha, word)))
    return n, sum(map(len, words)), n_symbols, len(lines) - len(set(lines)), len(lines), repeated, letters


_SCHEMA = pa.struct([(name, pa.int64()) for name in MEASURES])


@F.arrow_udf(StructType([StructField(name, LongType()) for name in MEASURES]))
def _measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        rows = [measure(text.as_py()) for text in batch]
        columns = zip(*rows) if rows else [()] * len(MEASURES)
        yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(_SCHEMA))


def ledger(docs: DataFrame, text_col: str = "text", bits_col: str = "failed_bits") -> DataFrame:
    """``docs`` with the measurements and ``bits_col`` (long), one bit per failed rule."""
    small_batches(docs.sparkSession)
    measured = docs.withColumn("_measured", _measured.asNondeterministic()(F.col(text_col)))
    measured = measured.withColumns({name: F.col(f"_measured.{name}") for name in MEASURES}).drop("_measured")
    bits = [F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long") for rule in RULES]
    return measured.withColumn(bits_col, reduce(Column.bitwiseOR, bits))


def passes(policy: Policy, bits_col: str = "failed_bits") -> Column:
    """Whether a document of the ledger is kept under ``policy``."""
    return F.col(bits_col).bitwiseAND(F.lit(policy.mask)) == 0


def masks(rows: DataFrame, bits_col: str = "failed_bits") -> DataFrame:
    """(bits, documents): how often each combination of failures occurs; at most 2^rules rows."""
    return rows.groupBy(F.col(bits_col).alias("bits")).agg(F.count(F.lit(1)).alias("documents"))


def ablations(rows: DataFrame, policies: Iterable[Policy] = POLICIES, bits_col: str = "failed_bits") -> DataFrame:
    """Per policy and rule of it: documents that are kept, that fail the rule, and that only this rule removes.

    An empty ledger gives no rows.
    """
    bits = {rule.name: rule.bit for rule in RULES}
    cases = [
        F.struct(
            F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(p.mask).alias("mask"),
            F.lit(rule).alias("rule"), F.lit(1 << bits[rule]).alias("bit"),
        )
        for p in policies for rule in p.rules
    ]
    counted = masks(rows, bits_col).select("bits", "documents", F.inline(F.array(*cases)))
    failed = F.col("bits").bitwiseAND(F.col("mask"))
    total = lambda when: F.sum(F.when(when, F.col("documents")).otherwise(0))
    return counted.groupBy("policy", "version", "rule").agg(
        total(failed == 0).alias("kept"),
        total(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("failed"),
        total(failed == F.col("bit")).alias("only_this"),
    )
