"""Secrets in text: fixed patterns, and random strings found by two character Markov models.

Pattern spans come from regular expressions. Further spans are long tokens that a first-order
Markov model of random strings explains better than one of ordinary identifiers: their
log-likelihood ratio per character pair exceeds a threshold. Both models are trained on labelled
samples: strings the patterns call secrets against the other words of a sample of documents.

Everything is DataFrame functions. Scoring is one pass without a shuffle; training counts character
pairs (at most 67 x 67 per label), the only rows that reach the driver. The sample is bounded by
``train_docs``; every document is scored.

Defined cases: null text is empty and has no spans; without samples of both labels no span is added;
pattern spans always stay, and an added span never overlaps one; offsets count code points, the end
is exclusive; other columns pass through and are replaced if named like a result.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootweave.llm.common import unused, whole

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN = "[A-Za-z0-9+/_=-]"
KINDS = ("assign", "access", "hex", "random")
# Leftmost matches; a maximal run is a match of its own, so that minimum lengths can be part of two of them.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
SPAN = "struct<start: int, kind: int, end: int>"


def _spans(text: Column, found: Column, pattern: str, kind: int, keep: Column | None = None) -> Column:
    """Where the ``found`` matches of ``pattern`` stand: the lengths between and of them, added up."""
    steps = F.arrays_zip(
        F.slice(F.transform(F.split(text, pattern, -1), F.length), F.lit(1), F.size(found)).alias("gap"),
        F.transform(found, F.length).alias("size"),
        (F.transform(found, lambda _: F.lit(True)) if keep is None else keep).alias("keep"),
    )
    start = lambda state, step: state["at"] + step["gap"]
    placed = F.aggregate(
        steps,
        F.expr(f"named_struct('at', 0, 'spans', cast(array() AS array<{SPAN}>))"),
        lambda state, step: F.struct(
            (start(state, step) + step["size"]).alias("at"),
            F.when(step["keep"], F.concat(state["spans"], F.array(F.struct(
                start(state, step).alias("start"), F.lit(kind).alias("kind"), (start(state, step) + step["size"]).alias("end"),
            )))).otherwise(state["spans"]).alias("spans"),
        ),
        lambda state: state["spans"],
    )
    return F.when(F.size(found) > 0, placed).otherwise(F.expr(f"cast(array() AS array<{SPAN}>)"))


def pattern_spans(docs: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """``docs`` with the spans of the three patterns, ordered by start and kind."""
    text = whole(text_col)
    all_of = lambda pattern, group=0: F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    assign, access, hex_ = unused(docs, "_assign", "_access", "_hex")
    matched = docs.withColumns({assign: all_of(ASSIGN), access: all_of(ACCESS), hex_: all_of(HEX)})
    long_enough = F.transform(all_of(ASSIGN, 2), lambda value: F.length(value) >= 8)
    return matched.withColumn(spans_col, F.array_sort(F.concat(
        _spans(text, F.col(assign), ASSIGN, 0, long_enough),
        _spans(text, F.col(access), ACCESS, 1),
        _spans(text, F.col(hex_), HEX, 2),
    ))).drop(assign, access, hex_)


@dataclass(frozen=True)
class Models:
    """``ratio[first][second]``: log-likelihood ratio of a character pair, random against ordinary."""

    ratio: list[list[float]]

    def column(self) -> Column:
        """All ratios as one constant array, row by row."""
        text = ",".join(repr(x) for row in self.ratio for x in row)
        return F.split(F.lit(text), ",").cast("array<double>")


def train(samples: DataFrame, smoothing: float = 0.5, weight: float = 5.0) -> Models:
    """Models from ``samples(value string, label int)``; label 1 marks secrets.

    A pair's probability is its share among the pairs with the same first character, with ``weight``
    further observations spread like the second characters of all pairs (each ``smoothing`` at least).
    """
    clean = samples.select(F.regexp_replace("value", "[^A-Za-z0-9+/_=-]", "").alias("value"), "label").filter("length(value) > 1")
    pairs = clean.select("label", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("value") - 1), lambda i: F.substring(F.col("value"), i, F.lit(2))
    )).alias("pair"))
    counts: dict[int, dict[str, int]] = {0: defaultdict(int), 1: defaultdict(int)}
    for label, pair, n in pairs.groupBy("label", "pair").count().collect():  # bounded by the alphabet
        counts[label][pair] = n
    if not (counts[0] and counts[1]):
        return Models([[0.0] * len(ALPHABET) for _ in ALPHABET])

    def logs(label: int) -> list[list[float]]:
        of = [[counts[label].get(a + b, 0) for b in ALPHABET] for a in ALPHABET]
        single = [sum(row[j] for row in of) + smoothing for j in range(len(ALPHABET))]
        share = [n / sum(single) for n in single]
        return [[math.log((n + weight * p) / (sum(row) + weight)) for n, p in zip(row, share)] for row in of]

    return Models([[r - o for r, o in zip(*rows)] for rows in zip(logs(1), logs(0))])


def samples(docs: DataFrame, text_col: str = "text", train_docs: int = 20_000, id_col: str = "doc_id") -> DataFrame:
    """Labelled strings from about ``train_docs`` documents: pattern spans, and the words of at least eight characters outside."""
    share = min(1.0, train_docs / max(docs.count(), 1))
    # The sign of a hash decides, so that the sample is the same on every run.
    chosen = docs.filter(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)) < int(share * (1 << 30)))
    spans = pattern_spans(chosen.select(F.col(text_col).alias("_text")), "_text", "_spans")
    secret = F.transform("_spans", lambda s: F.struct(
        F.regexp_extract(F.substring(F.col("_text"), s["start"] + 1, s["end"] - s["start"]), "([A-Za-z0-9+/_.=-]+)$", 1).alias("value"),
        F.lit(1).alias("label"),
    ))
    other = F.transform(
        F.when(F.size("_spans") == 0, F.regexp_extract_all(whole("_text"), F.lit(f"{TOKEN}{{8,}}"), F.lit(0))).otherwise(F.array()),
        lambda w: F.struct(w.alias("value"), F.lit(0).alias("label")),
    )
    return spans.select(F.inline(F.concat(secret, other)))


def find(
    docs: DataFrame, models: Models, text_col: str = "text", spans_col: str = "spans", base_col: str = "base_spans",
    min_length: int = 20, threshold: float = 1.0,
) -> DataFrame:
    """``docs`` with ``base_col`` (pattern spans) and ``spans_col`` (these and the random strings), arrays of (start, kind, end).

    ``kind`` indexes ``KINDS``. A token of at least ``min_length`` characters is random if its mean ratio exceeds ``threshold``.
    """
    text, pattern = whole(text_col), f"{TOKEN}{{{min_length},}}"
    (tokens,) = unused(docs, "_tokens")
    base = pattern_spans(docs, text_col, base_col).withColumn(
        tokens, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    )
    ratios = models.column()
    place = lambda token, i: F.instr(F.lit(ALPHABET), F.substring(token, i, F.lit(1)))

    def is_random(token: Column) -> Column:
        total = F.aggregate(
            F.sequence(F.lit(1), F.length(token) - 1), F.lit(0.0),
            lambda sum_, i: sum_ + F.get(ratios, (place(token, i) - 1) * len(ALPHABET) + place(token, i + 1) - 1),
        )
        return total > threshold * (F.length(token) - 1)

    added = _spans(text, F.col(tokens), pattern, 3, F.transform(tokens, is_random))
    apart = F.filter(added, lambda s: ~F.exists(base_col, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return base.withColumn(spans_col, F.array_sort(F.concat(F.col(base_col), apart))).drop(tokens)


def written(spans: str) -> Column:
    """kind:start:end of all spans, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
